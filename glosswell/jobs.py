"""Command line: one query over comment lines or a comment table, as a table job or a stream.

    spark-submit --py-files glosswell.zip glosswell/jobs.py articles --lines IN --out OUT --size 24
    spark-submit ... glosswell/jobs.py daytime --kafka HOST:PORT --stream --out OUT --size 7
    spark-submit ... glosswell/jobs.py users --comments IN --stream --once --sink kafka --to HOST:PORT/TOPIC --out OUT

``--size`` counts hours for ``articles``, ``users`` and ``running`` and days for ``daytime``. ``authors`` keeps
the author record as a stream, and folds it together as a table job. ``throughput`` counts what queries take in per
tick: as a stream it keeps counts, as a table job it writes lines from stamped comments or from such counts.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from glosswell.operators.meters import tick_start
from glosswell.plans import articles, daytime, popularity, reports
from glosswell.session import checkpoint_root, prepare, use_state_store
from glosswell.sinks import kafka
from glosswell.sinks.authors import compact_authors, upsert_authors
from glosswell.sinks.files import (
    append_table, each_batch, each_batch_parts, print_lines, remove, write_batch, write_batch_lines, write_lines, write_table,
)
from glosswell.sources.lines import kafka_lines, read_lines, stream_kafka_lines, stream_lines
from glosswell.sources.parse import comments_of, parse_lines, rejects_of
from glosswell.streaming import metrics, popularity as live, threads as live_threads
from glosswell.streaming.watermarks import ascending, bounded

# A backlog is worked off in batches of at most this many messages or files.
MESSAGES_PER_TRIGGER = 5_000_000
FILES_PER_TRIGGER = 100

DEFAULT_SIZES = {"articles": 24, "daytime": 7, "users": 720, "running": 720}


def table_report(query: str, comments: DataFrame, size: int) -> DataFrame:
    """Result lines of a query over a comment table."""
    if query == "articles":
        return articles.article_top3_lines(comments, size)
    if query == "daytime":
        return daytime.slot_lines(comments, size)
    if query == "users":
        return popularity.user_lines(popularity.popular_users(comments, size))
    return popularity.user_lines(popularity.popular_users_running(comments, size))


def run_on(writer: DataStreamWriter):
    """Start a stream that goes on."""
    return writer.start()


def run_once(writer: DataStreamWriter):
    """Work off what there is; the next step finds all of it."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def batch_writer(sink: str, to: str | None = None):
    """What a micro-batch of result lines is written with: (lines, batch, folder of the stream)."""
    if sink == "kafka":
        servers, topic = to.rsplit("/", 1)
        return lambda lines, batch_id, path: kafka.send(kafka.batch_messages(lines, batch_id), servers, topic)
    if sink == "console":
        return lambda lines, batch_id, path: print_lines(lines)
    return write_batch_lines if sink == "text" else write_batch


def start_stream(query: str, comments: DataFrame, size: int, out: str, checkpoint: str, start=run_on, write=write_batch) -> list:
    """Start the stream(s) of a query; the result lines go to ``write`` per micro-batch.

    The user queries run as steps that hand over a table each: credits, then scores.
    """
    spark = comments.sparkSession
    if query == "authors":
        entries = live_threads.author_entries(bounded(comments))
        return [start(upsert_authors(entries, out, f"{checkpoint}/authors"))]
    if query == "throughput":
        return [start(metrics.count_input(metrics.stamp(comments), out, f"{checkpoint}/throughput"))]
    if query == "articles":
        counts = articles.article_counts(bounded(comments), size)
        return [start(each_batch(counts, articles.count_lines, out, f"{checkpoint}/articles", write))]
    if query == "daytime":
        slots = daytime.slot_counts(bounded(comments), size)
        report = lambda batch: daytime.row_lines(batch, daytime.SLOT_COLUMNS)
        return [start(each_batch(slots, report, out, f"{checkpoint}/daytime", write))]

    steps, credits = start_credits(comments, out, checkpoint, start)
    if query == "users":
        scores = live.window_scores(bounded(comments), credits, size)
        report = lambda batch: popularity.user_lines(popularity.rank_users(batch))
        steps.append(start(each_batch(scores, report, out, f"{checkpoint}/users", write)))
        return steps

    scores_path = f"{out}_scores"
    scores = live.running_scores(bounded(comments), credits, size)
    steps.append(start(append_table(scores, scores_path, f"{checkpoint}/scores")))
    running = bounded(spark.readStream.schema(scores.schema).parquet(scores_path), "at")
    report = lambda batch: popularity.user_lines(popularity.rank_running(batch, size))
    steps.append(start(each_batch(live.top_running(running, size), report, out, f"{checkpoint}/running", write)))
    return steps


def start_credits(comments: DataFrame, out: str, checkpoint: str, start=run_on) -> tuple[list, DataFrame]:
    """Start the two steps that find reply credits; these and the watermarked stream of credits."""
    spark = comments.sparkSession
    entries_path, credits_path = f"{out}_entries", f"{out}_credits"
    entry_rows = live_threads.author_entries(bounded(comments))
    steps = [start(append_table(entry_rows, entries_path, f"{checkpoint}/entries"))]
    # All entries and credits there are go into the next batch: files of one batch have no order.
    entries = bounded(spark.readStream.schema(entry_rows.schema).parquet(entries_path))
    credit_rows = live_threads.reply_credits(bounded(comments), entries)
    steps.append(start(append_table(credit_rows, credits_path, f"{checkpoint}/credits")))
    return steps, bounded(spark.readStream.schema(credit_rows.schema).parquet(credits_path))


def start_latency(query: str, comments: DataFrame, size: int, out: str, checkpoint: str, start=run_on, write=write_batch) -> list:
    """Start the latency stream(s) of a query: ``start_ms,latency_ms`` lines per closed window.

    That of ``users`` is over likes and replies, whose credits are steps of their own.
    """
    stamped = metrics.stamp(comments)
    steps = []
    if query == "articles":
        closed = reports.article_counts_stamped(bounded(stamped), size)
    elif query == "daytime":
        closed = reports.slot_totals_stamped(ascending(stamped), size)
    else:
        steps, credits = start_credits(stamped, out, checkpoint, start)
        closed = live.window_stamps(bounded(stamped), credits, size)
    report = lambda batch: reports.latency_lines(metrics.emission_latency(batch))
    return [*steps, start(each_batch(closed, report, out, f"{checkpoint}/latency_{query}", write))]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="glosswell.jobs")
    parser.add_argument("query", choices=[*DEFAULT_SIZES, "ingest", "authors", "throughput"])
    source = parser.add_mutually_exclusive_group()
    source.add_argument("--lines", help="text files of comment lines")
    source.add_argument("--comments", help="parquet table of comments, as written by ingest")
    source.add_argument("--kafka", help="bootstrap servers")
    source.add_argument("--counts", help="folder that a throughput stream keeps")
    parser.add_argument("--topic", help="topic of comment lines, needed with --kafka")
    parser.add_argument("--size", type=int)
    parser.add_argument("--out", required=True)
    parser.add_argument("--stream", action="store_true")
    parser.add_argument("--latency", action="store_true", help="stream window latency instead of results")
    parser.add_argument("--once", action="store_true", help="let streams work off what there is and end")
    parser.add_argument("--sink", choices=["text", "parquet", "kafka", "console"], default="text")
    parser.add_argument("--to", help="HOST:PORT/TOPIC, needed with --sink kafka")
    parser.add_argument("--checkpoint")
    parser.add_argument(
        "--per-trigger",
        type=int,
        help="most messages (Kafka) or files a micro-batch takes; bounds what one key can bring at once",
    )
    args = parser.parse_args(argv)
    compacts = args.query == "authors" and not args.stream
    if compacts == bool(args.lines or args.comments or args.kafka or args.counts):
        parser.error("one of --lines, --comments, --kafka or --counts is needed, but for folding authors together")
    if args.kafka and not args.topic:
        parser.error("--kafka needs --topic")
    if args.query == "ingest" and (args.comments or args.latency or args.size):
        parser.error("ingest takes lines or a topic, and neither --latency nor --size")
    if args.latency and args.query not in ("articles", "daytime", "users"):
        parser.error("--latency reports articles, daytime and users")
    if args.sink == "kafka" and "/" not in (args.to or ""):
        parser.error("--sink kafka needs --to HOST:PORT/TOPIC")
    if args.counts and (args.query != "throughput" or args.stream):
        parser.error("--counts is read by the throughput table job")
    if args.query == "authors" and args.size:
        parser.error("authors takes no --size")

    spark = prepare(SparkSession.builder.appName(f"glosswell-{args.query}").getOrCreate())
    size = args.size or DEFAULT_SIZES.get(args.query)
    if args.stream or args.latency:
        use_state_store(spark)
        checkpoint = args.checkpoint or checkpoint_root(spark)
        if not checkpoint:
            parser.error("--checkpoint is needed where spark.checkpoint.dir is not set")
        start = run_once if args.once else run_on
        if args.query == "ingest":
            start(start_ingest(parse_lines(_stream_lines(spark, args)), args.out, f"{checkpoint}/ingest"))
        else:
            work = start_latency if args.latency else start_stream
            comments = _stream_comments(spark, args)
            work(args.query, comments, size, args.out, checkpoint, start, batch_writer(args.sink, args.to))
        if not args.once:
            spark.streams.awaitAnyTermination()
    elif args.query == "ingest":
        ingest(spark, args, args.out)
    elif args.query == "authors":
        compact_authors(spark, args.out)
    elif args.query == "throughput":
        ticks = metrics.read_input(spark, args.counts) if args.counts else reports.input_ticks(_table_comments(spark, args))
        write_report(reports.throughput_lines(ticks).withColumn("window_start", tick_start(F.col("tick"))), args)
    else:
        write_report(table_report(args.query, _table_comments(spark, args), size), args)


def _table_comments(spark: SparkSession, args) -> DataFrame:
    """Comments as a table. Lines are read and parsed once, into tables beside the result."""
    return spark.read.parquet(args.comments or ingest(spark, args, f"{args.out}_ingest"))


def write_report(lines: DataFrame, args) -> None:
    """Result lines of a table job, to where ``--sink`` says."""
    if args.sink == "parquet":
        write_table(lines, args.out)
    elif args.sink == "kafka":
        kafka.send(kafka.batch_messages(lines, 0), *args.to.rsplit("/", 1))
    elif args.sink == "console":
        print_lines(lines)
    else:
        write_lines(lines, args.out)


def ingest(spark: SparkSession, args, out: str) -> str:
    """Lines to a table of comments, stamped with the time of the run, and one of rejects; the path of the
    first. One scan, one parse: what is parsed is a table until both are written, then it goes."""
    parsed = f"{out}/parsed-{uuid.uuid4().hex}"
    write_table(parse_lines(_lines(spark, args)), parsed)
    rows = spark.read.parquet(parsed)
    write_table(stamped_comments(rows), f"{out}/comments")
    write_table(rejects_of(rows), f"{out}/rejects")
    remove(spark, parsed)
    return f"{out}/comments"


def stamped_comments(parsed: DataFrame) -> DataFrame:
    """The comments among parsed lines, with the time they came in."""
    return comments_of(parsed).withColumn(reports.STAMP, F.current_timestamp())


def start_ingest(parsed: DataFrame, out: str, checkpoint: str):
    """The same as a stream: each micro-batch is parsed once."""
    return each_batch_parts(parsed, {f"{out}/comments": stamped_comments, f"{out}/rejects": rejects_of}, checkpoint)


def _lines(spark: SparkSession, args) -> DataFrame:
    return kafka_lines(spark, args.kafka, args.topic) if args.kafka else read_lines(spark, args.lines)


def _stream_comments(spark: SparkSession, args) -> DataFrame:
    if args.comments:
        files = args.per_trigger or FILES_PER_TRIGGER
        schema = spark.read.parquet(args.comments).schema
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(args.comments)
    return comments_of(parse_lines(_stream_lines(spark, args)))


def _stream_lines(spark: SparkSession, args) -> DataFrame:
    if args.kafka:
        messages = args.per_trigger or MESSAGES_PER_TRIGGER
        return stream_kafka_lines(spark, args.kafka, args.topic, messages)
    return stream_lines(spark, args.lines, args.per_trigger or FILES_PER_TRIGGER)


if __name__ == "__main__":
    main()
