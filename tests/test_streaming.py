"""Streams against the table plans: the same rows, less the windows still open."""

import time

import pytest
from helpers import comment, comments, rows_of
from pyspark.sql import functions as F

from glosswell import jobs
from glosswell.plans import articles, daytime, popularity, reports, threads
from glosswell.sinks.authors import _places, compact_authors, read_authors, upsert_authors
from glosswell.sinks.files import append_table, each_batch, to_console, write_batch_lines, write_lines
from glosswell.sinks.kafka import line_messages, messages
from glosswell.sources.events import lines_from_events, read_event_comments
from glosswell.sources.lines import kafka_values, read_lines, stream_lines
from glosswell.sources.parse import comments_of, parse_lines
from glosswell.streaming import metrics, popularity as live, threads as live_threads
from glosswell.streaming.state import SecondQueue, TimedRecord
from glosswell.streaming.watermarks import ascending, bounded

PARTS = 3


@pytest.fixture(scope="module")
def table(spark, small):
    return read_event_comments(spark, small).cache()


@pytest.fixture(scope="module")
def replay(table, tmp_path_factory):
    """Folder of comment files written one after another in event order."""
    folder = str(tmp_path_factory.mktemp("replay") / "comments")
    size = -(-table.count() // PARTS)
    for part in range(PARTS):
        chunk = table.where(F.floor(F.col("comment_id").cast("int") / size) == part)
        chunk.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)  # files are taken by modification time
    return folder


@pytest.fixture
def live_comments(spark, table, replay):
    def stream():
        return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(replay)

    return stream


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None


def credit_stream(spark, comments, folder):
    """Both steps of the credits, one after the other; the folder of the second."""
    run(append_table(live_threads.author_entries(bounded(comments())), f"{folder}/entries", f"{folder}/entries_at"))
    schema = spark.read.parquet(f"{folder}/entries").schema
    entries = bounded(spark.readStream.schema(schema).parquet(f"{folder}/entries"))
    run(append_table(live_threads.reply_credits(bounded(comments()), entries), f"{folder}/credits", f"{folder}/credits_at"))
    return f"{folder}/credits"


@pytest.fixture(scope="module")
def credits(spark, table, replay, tmp_path_factory):
    """Folder of the credits a stream found."""
    stream = lambda: spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(replay)
    return credit_stream(spark, stream, tmp_path_factory.mktemp("credits"))


def assert_closed_part(got, want, at="window_start"):
    """``got`` is ``want`` without the newest window."""
    last = want.agg(F.max(at)).first()[0]
    assert rows_of(got.select(*want.columns)) == rows_of(want.where(F.col(at) < F.lit(last)))
    assert got.count() > 0


def test_articles(spark, table, live_comments, tmp_path):
    counts = articles.article_counts(bounded(live_comments()), 24)
    run(each_batch(counts, articles.rank_articles, str(tmp_path / "o"), str(tmp_path / "ck")))
    assert_closed_part(spark.read.parquet(str(tmp_path / "o")), articles.article_top3(table, 24))


def test_daytime(spark, table, live_comments, tmp_path):
    run(append_table(daytime.slot_counts(ascending(live_comments()), 1), str(tmp_path / "o"), str(tmp_path / "ck")))
    assert_closed_part(spark.read.parquet(str(tmp_path / "o")), daytime.slot_counts(table, 1))


def passed(want, got):
    """What the table plan has up to the newest row that the stream has."""
    reached = got.agg(F.max("create_date")).first()[0]
    return want.where(F.col("create_date") <= F.lit(reached))


@pytest.mark.parametrize("files", [1, 2, 1_000])
def test_credits_do_not_depend_on_the_batch(spark, table, replay, tmp_path, files):
    stream = lambda: spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(replay)
    got = spark.read.parquet(credit_stream(spark, stream, tmp_path))
    want = threads.reply_credits(table, keep=(reports.STAMP,))
    assert rows_of(got.select(*want.columns)) == rows_of(passed(want, got))
    assert got.count() > 0.9 * want.count()


@pytest.mark.parametrize("files", [1, 2, 4])
def test_credits_by_event_time(spark, tmp_path, files):
    """A reply one batch before its parent, and parents younger than the reply."""
    folder = str(tmp_path / "c")
    rows = [
        comment("1", 1, "A", at=0),
        comment("4", 2, "D", "1", at=40),
        comment("2", 1, "B", at=30),
        comment("5", 2, "E", "2", at=20),
        comment("6", 2, "F", "4", at=50),
        comment("1", 1, "Z", at=45),
        comment("7", 2, "G", "1", at=44),
        comment("end", 1, "Q", at=10_000),
        comment("end2", 1, "Q", at=20_000),
    ]
    write_in_order(spark, folder, [rows[1], rows[4]], [rows[0], rows[3], rows[6]], [rows[2], rows[5]], [rows[7]], [rows[8]])
    schema = spark.read.parquet(folder).schema
    late = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder).where("create_date is not null")
    wide = lambda: late().withWatermark("create_date", "1 minute")
    run(append_table(live_threads.author_entries(wide()), f"{tmp_path}/e", f"{tmp_path}/k1"))
    entries = bounded(spark.readStream.schema(spark.read.parquet(f"{tmp_path}/e").schema).parquet(f"{tmp_path}/e"))
    run(append_table(live_threads.reply_credits(wide(), entries), f"{tmp_path}/o", f"{tmp_path}/k2"))
    got = spark.read.parquet(f"{tmp_path}/o")
    want = threads.reply_credits(spark.read.parquet(folder))
    assert rows_of(got.select("reply_id", "hop", "user_id")) == rows_of(want.select("reply_id", "hop", "user_id"))
    assert rows_of(want.select("reply_id", "user_id"))[:2] == [("4", "A"), ("6", "A")]


def test_popular_users(spark, table, live_comments, credits, tmp_path):
    credit_rows = bounded(spark.readStream.schema(spark.read.parquet(credits).schema).parquet(credits))
    scores = live.window_scores(bounded(live_comments()), credit_rows, 24)
    run(each_batch(scores, popularity.rank_users, str(tmp_path / "o"), str(tmp_path / "ck")))
    assert_closed_part(spark.read.parquet(str(tmp_path / "o")), popularity.popular_users(table, 24))


def test_running_popularity(spark, table, live_comments, credits, tmp_path):
    found = spark.read.parquet(credits)
    credit_rows = bounded(spark.readStream.schema(found.schema).parquet(credits))
    scores = live.running_scores(bounded(live_comments()), credit_rows, 24)
    run(append_table(scores, str(tmp_path / "s"), str(tmp_path / "ck1")))
    got = spark.read.parquet(str(tmp_path / "s"))
    want = popularity.running_user_scores(
        threads.reply_credits(table), popularity.like_scores(table, 24)
    )
    reached = got.agg(F.max("at")).first()[0]
    assert rows_of(got) == rows_of(want.where(F.col("at") <= F.lit(reached)))
    assert got.count() > 500

    running = bounded(spark.readStream.schema(got.schema).parquet(str(tmp_path / "s")), "at")
    rank = lambda batch: popularity.rank_running(batch, 24)
    run(each_batch(live.top_running(running, 24), rank, str(tmp_path / "o"), str(tmp_path / "ck2")))
    top = spark.read.parquet(str(tmp_path / "o"))
    assert_closed_part(top, popularity.popular_users_running(table, 24))


@pytest.mark.parametrize("files", [1, 2, 1_000])
def test_stamped_running_scores(spark, table, replay, tmp_path, files):
    """Score and latest stamp go together through likes and credits, however the replay is cut."""
    stream = lambda: spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(replay)
    found = credit_stream(spark, stream, tmp_path)
    credit_rows = lambda: bounded(spark.readStream.schema(spark.read.parquet(found).schema).parquet(found))
    table_credits = threads.reply_credits(table, keep=(reports.STAMP,))

    scores = live.running_scores(bounded(stream()), credit_rows(), 24, stamped=True)
    run(append_table(scores, str(tmp_path / "s"), str(tmp_path / "ck1")))
    got = spark.read.parquet(str(tmp_path / "s"))
    want = popularity.running_user_scores(table_credits, reports.like_scores_stamped(table, 24), stamp=reports.STAMP)
    reached = got.agg(F.max("at")).first()[0]
    assert rows_of(got.select(*want.columns)) == rows_of(want.where(F.col("at") <= F.lit(reached)))
    assert got.where("is_like = 1").count() > 0 and got.count() > 0.9 * table_credits.count()

    run(append_table(live.running_reply_scores(credit_rows(), stamped=True), str(tmp_path / "r"), str(tmp_path / "ck2")))
    got = spark.read.parquet(str(tmp_path / "r"))
    want = popularity.running_reply_scores(table_credits, stamp=reports.STAMP)
    assert rows_of(got.select(*want.columns)) == rows_of(passed(want, got))


def test_latency_of_users_is_over_likes_and_credits(spark, tmp_path):
    """Hour 1 has a reply and no direct comment; its window still has a latency."""
    folder, hour = str(tmp_path / "c"), 3600
    write_in_order(
        spark, folder,
        [comment("1", 1, "A", at=10, likes=5)], [comment("2", 2, "B", "1", at=hour + 10)],
        [comment("3", 1, "C", at=3 * hour), comment("6", 2, "D", "1", at=3 * hour)],
        [comment("4", 1, "C", at=4 * hour)], [comment("5", 1, "C", at=5 * hour)],
    )
    schema = spark.read.parquet(folder).schema
    stream = metrics.stamp(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder))
    for query in jobs.start_latency("users", stream, 1, str(tmp_path / "o"), str(tmp_path / "ck")):
        query.processAllAvailable()
    for query in spark.streams.active:
        query.processAllAvailable()
        query.stop()
    rows = [r.line.split(",") for r in spark.read.parquet(str(tmp_path / "o")).collect()]
    starts = sorted((int(start) // 1000 - 1_514_764_800) // hour for start, _ in rows)
    assert starts[:2] == [0, 1] and all(int(ms) >= 0 for _, ms in rows)


class FakeStore:
    """State in memory that counts the rows it hands out."""

    def __init__(self):
        self.maps, self.read, self.timers = {}, 0, set()

    def registerTimer(self, ms):
        self.timers.add(ms)

    def getMapState(self, name, key, value):
        store, held = self, {}

        class Map:
            getValue = staticmethod(lambda k: None if k not in held else (store.count(held[k][0]),))
            updateValue = staticmethod(lambda k, v: held.__setitem__(k, v))
            removeKey = staticmethod(lambda k: held.pop(k))

        self.maps[name] = held
        return Map

    def getValueState(self, name, schema):
        store, held = self, []

        class Value:
            exists = staticmethod(lambda: bool(held))
            get = staticmethod(lambda: (store.count(held[0][0]),))
            update = staticmethod(lambda v: held.__setitem__(slice(None), [v]))
            clear = staticmethod(held.clear)

        return Value

    def count(self, rows):
        self.read += len(rows)
        return rows


def test_lookup_reads_the_hours_it_asks_for():
    store = FakeStore()
    record = TimedRecord(store, "entries", "at_us bigint, user_id string")
    second = 1_000_000
    for hour in range(200):
        record.add([((hour * 7_200 + k) * second, f"{hour}.{k}") for k in range(500)])
    store.read = 0
    ask = [(150 * 7_200 + 20) * second, (150 * 7_200 + 5_000) * second, -1, 10**9 * second]
    assert [e and e[1] for e in record.as_of(ask)] == ["150.20", "150.499", None, "199.499"]
    assert store.read <= 2 * 500 + 20
    record.add([(20 * second, "b"), (20 * second, "a"), (20 * second, None)])
    assert record.as_of([20 * second])[0] == (20 * second, "b")


def test_a_timer_reads_the_rows_it_releases():
    store = FakeStore()
    queue = SecondQueue(store, "waiting", "at_us bigint, name string")
    queue.add([(k * 1_000_000 + 5, f"r{k}") for k in range(1000)])
    queue.add([(3_000_007, "again")])
    store.read = 0
    assert queue.release(700_000) == [(699_000_005, "r699")]
    assert store.read == 1 and queue.release(700_000) == []
    assert [n for _, n in queue.release(4_000)] == ["r3", "again"] and len(store.timers) == 1000


def test_a_comment_with_very_many_entries(spark, tmp_path):
    """100,000 entries of one id over 28 hours, and replies all along."""
    entries = spark.range(100_000).select(
        F.lit("hot").alias("comment_id"), F.timestamp_seconds(F.lit(1_514_764_800) + F.col("id")).alias("create_date"),
        F.lit(1).alias("depth"), F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.lit("0").alias("in_reply_to"),
    )
    replies = spark.range(400).select(
        F.concat(F.lit("r"), F.col("id")).alias("comment_id"), F.timestamp_micros((F.lit(1_514_764_800) + F.col("id") * 249) * 1_000_000 + 500_000).alias("create_date"),
        F.lit(2).alias("depth"), F.lit("x").alias("user_id"), F.lit("hot").alias("in_reply_to"),
    )
    end = spark.range(2).select(
        F.concat(F.lit("e"), F.col("id")).alias("comment_id"), F.timestamp_seconds(F.lit(1_514_964_800) + F.col("id") * 10_000).alias("create_date"),
        F.lit(1).alias("depth"), F.lit("y").alias("user_id"), F.lit("0").alias("in_reply_to"),
    )
    folder = str(tmp_path / "c")
    for part in (entries.where("id < 60000"), replies.unionByName(entries.where("id >= 60000")), end.where("id = 0"), end.where("id = 1")):
        part.coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    schema = spark.read.parquet(folder).schema
    late = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder).withWatermark("create_date", "2 days")
    offered = late().select("comment_id", "create_date", "user_id", F.lit(None).cast("string").alias("parent_user_id"))
    asked = late().where("depth = 2 or comment_id like 'e%'")
    run(append_table(live_threads.reply_credits(asked, offered), str(tmp_path / "o"), str(tmp_path / "k")))
    got = spark.read.parquet(str(tmp_path / "o"))
    want = threads.reply_credits(spark.read.parquet(folder))
    assert rows_of(got.select("reply_id", "user_id")) == [r for r in rows_of(want.select("reply_id", "user_id")) if r in set(rows_of(got.select("reply_id", "user_id")))]
    assert got.count() > 100


@pytest.mark.parametrize("keep", [None, 3600])
def test_state_may_expire(spark, tmp_path, keep):
    """A reply five hours after its parent finds it only where the record is kept for good."""
    folder, hour = str(tmp_path / "c"), 3600
    write_in_order(
        spark, folder,
        [comment("1", 1, "A", at=10), comment("2", 2, "B", "1", at=hour + 10)],
        [comment("3", 2, "C", "1", at=5 * hour), comment("4", 1, "D", at=5 * hour - 10)],
        [comment("5", 2, "E", "4", at=5 * hour + 20)],
        [comment("6", 1, "F", at=9 * hour)], [comment("7", 1, "F", at=10 * hour)], [comment("8", 1, "F", at=11 * hour)],
    )
    schema = spark.read.parquet(folder).schema
    stream = lambda: bounded(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder))
    run(append_table(live_threads.author_entries(stream(), keep), f"{tmp_path}/e", f"{tmp_path}/k1"))
    entries = lambda: bounded(spark.readStream.schema(spark.read.parquet(f"{tmp_path}/e").schema).parquet(f"{tmp_path}/e"))
    run(append_table(live_threads.reply_credits(stream(), entries(), keep), f"{tmp_path}/o", f"{tmp_path}/k2"))
    got = spark.read.parquet(f"{tmp_path}/o")
    credits = [("2", "A"), ("3", "A"), ("5", "D")] if keep is None else [("2", "A"), ("5", "D")]
    assert rows_of(got.select("reply_id", "user_id")) == credits

    credit_rows = bounded(spark.readStream.schema(got.schema).parquet(f"{tmp_path}/o").union(
        spark.readStream.schema(got.schema).parquet(f"{tmp_path}/o")))
    run(append_table(live.running_reply_scores(credit_rows, keep_seconds=keep), f"{tmp_path}/s", f"{tmp_path}/k3"))
    top = spark.read.parquet(f"{tmp_path}/s").agg(F.max("cents")).first()[0]
    assert top == (280 if keep is None else 140)


def write_in_order(spark, folder, *batches):
    for rows in batches:
        comments(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)


def test_late_rows_leave_windows_but_not_the_record(spark, tmp_path):
    """Hour 0 is closed when its late comment comes; a reply to that comment still counts."""
    folder = str(tmp_path / "c")
    hour = 3600
    write_in_order(
        spark,
        folder,
        [comment("1", 1, "A", at=10)],
        [comment("2", 1, "B", at=hour + 10)],
        [comment("5", 1, "B", at=hour + 20)],  # Spark drops by the watermark of the batch before
        [comment("late", 1, "L", at=20), comment("3", 2, "C", "late", at=2 * hour + 10)],
        [comment("4", 1, "D", at=4 * hour)],
        [comment("6", 1, "D", at=4 * hour + 10)],  # lets the entry of 4 go, and with it the reply
    )
    schema = spark.read.parquet(folder).schema

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    run(append_table(
        articles.article_counts(bounded(stream()), 1).select("window.start", "n"), str(tmp_path / "o"), str(tmp_path / "k1")
    ))
    assert [r.n for r in spark.read.parquet(str(tmp_path / "o")).orderBy("start").collect()] == [1, 2, 1]
    found = spark.read.parquet(credit_stream(spark, stream, tmp_path))
    assert [(r.reply_id, r.user_id) for r in found.collect()] == [("3", "L")]


def test_running_ranking_takes_late_rows_while_the_window_is_open(spark, tmp_path):
    folder = str(tmp_path / "s")
    batches = [[(600, 5)], [(1800, 7)], [(1900, 8)], [(300, 100)], [(10800, 1)], [(11000, 1)], [(1200, 1000), (14400, 1)], [(20000, 1)]]
    for rows in batches:
        frame = spark.createDataFrame([(t, f"r{t}", c) for t, c in rows], "t bigint, r string, c bigint")
        frame.select(
            F.timestamp_seconds("t").alias("at"),
            F.lit(0).alias("is_like"),
            F.col("r").alias("reply_id"),
            F.lit(1).alias("hop"),
            F.lit("u").alias("user_id"),
            F.col("c").cast("decimal(38,0)").alias("cents"),
        ).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(1.1)
    schema = spark.read.parquet(folder).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rank = lambda batch: popularity.rank_running(batch, 1)
    run(each_batch(live.top_running(bounded(stream, "at"), 1), rank, str(tmp_path / "o"), str(tmp_path / "ck")))
    first = spark.read.parquet(str(tmp_path / "o")).where("unix_seconds(window_start) = 0").orderBy("rank")
    assert [int(r.cents) for r in first.collect()] == [100, 8, 7, 5]


def test_author_record(spark, table, replay, tmp_path):
    """As a job: increments, a base of what changed, and increments on top of it."""
    stream = ["authors", "--comments", f"{tmp_path}/in", "--stream", "--once", "--checkpoint", f"{tmp_path}/ck", "--out", f"{tmp_path}/a"]
    read = lambda: read_authors(spark, f"{tmp_path}/a")
    chunks = [table.where(F.floor(F.col("comment_id").cast("int") / 250) == part) for part in range(4)]
    chunks[0].coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    jobs.main([*stream, "--per-trigger", "1"])
    for part in (1, 2):
        time.sleep(1.1)
        chunks[part].coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    jobs.main(stream)
    before = rows_of(read())
    jobs.main(["authors", "--out", f"{tmp_path}/a"])
    assert rows_of(read()) == before and compact_authors(spark, f"{tmp_path}/a") == 0
    first = {x for _, part, x in _places(spark, f"{tmp_path}/a", "base")}
    time.sleep(1.1)
    chunks[3].coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    jobs.main(stream)
    want = threads.latest_authors(passed(threads.author_versions(table), read()))
    assert rows_of(read().select("comment_id", "user_id", "parent_user_id")) == rows_of(want)
    assert read().count() > 0.9 * want.count()
    after = rows_of(read())
    assert 0 < compact_authors(spark, f"{tmp_path}/a") <= 64
    assert rows_of(read()) == after and first < {x for _, part, x in _places(spark, f"{tmp_path}/a", "base")}


def test_author_record_keeps_the_last_write(spark, tmp_path):
    write_in_order(spark, str(tmp_path / "c"), [comment("1", 1, "A", at=5)], [comment("1", 1, "Z", at=9)], [comment("2", 1, "Q", at=99)])
    schema = spark.read.parquet(str(tmp_path / "c")).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "c"))
    run(upsert_authors(live_threads.author_entries(bounded(stream)), str(tmp_path / "a"), str(tmp_path / "ck")))
    assert [(r.comment_id, r.user_id) for r in read_authors(spark, str(tmp_path / "a")).collect()] == [("1", "Z")]


def test_lines_in_and_lines_out(spark, small, tmp_path):
    """Raw lines through the job, as a table and as a stream."""
    events = spark.read.parquet(f"{small}/events.parquet").where("event_id % 17 not in (2, 16)")  # no line breaks inside
    lines_from_events(events).coalesce(1).write.text(str(tmp_path / "in"))
    jobs.main(["articles", "--lines", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--size", "24"])
    want = articles.article_top3_lines(comments_of(parse_lines(lines_from_events(events))), 24)
    texts = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert texts == [r.line for r in want.orderBy("window_start").collect()]

    stream = comments_of(parse_lines(stream_lines(spark, str(tmp_path / "in"))))
    started = jobs.start_stream("articles", stream, 24, str(tmp_path / "live"), str(tmp_path / "ck"))
    for query in started:
        query.processAllAvailable()
        query.stop()
    got = spark.read.parquet(str(tmp_path / "live")).orderBy("window_start")
    assert [r.line for r in got.collect()] == texts[:-1]


def test_ingest_job(spark, small, tmp_path):
    lines_from_events(spark.read.parquet(f"{small}/events.parquet")).where("value NOT LIKE '%\n'").write.text(
        str(tmp_path / "in")
    )
    jobs.main(["ingest", "--lines", str(tmp_path / "in"), "--out", str(tmp_path / "out")])
    good = spark.read.parquet(str(tmp_path / "out" / "comments")).count()
    bad = spark.read.parquet(str(tmp_path / "out" / "rejects")).count()
    lines = read_lines(spark, str(tmp_path / "in"))
    assert good + bad == lines.where("value NOT LIKE 'approveDate,%'").count()
    assert good > 0 and bad > 0


def test_ingest_stream_accounts_for_every_line(spark, small, tmp_path):
    lines = lines_from_events(spark.read.parquet(f"{small}/events.parquet")).where("value NOT LIKE '%\n'")
    lines.coalesce(2).write.text(str(tmp_path / "in"))
    parsed = parse_lines(stream_lines(spark, str(tmp_path / "in"), 1))
    run(jobs.start_ingest(parsed, str(tmp_path / "out"), str(tmp_path / "ck")))
    good, bad = (spark.read.parquet(str(tmp_path / "out" / x)).count() for x in ("comments", "rejects"))
    assert good + bad == lines.where("value NOT LIKE 'approveDate,%'").count() and good and bad
    with pytest.raises(Exception, match="another stream"):
        run(jobs.start_ingest(parsed, str(tmp_path / "out"), str(tmp_path / "other")))


@pytest.mark.parametrize(
    "flags",
    [
        ["ingest", "--comments", "x", "--out", "y"],
        ["ingest", "--lines", "x", "--out", "y", "--latency"],
        ["running", "--comments", "x", "--out", "y", "--latency"],
        ["articles", "--kafka", "host:1", "--out", "y"],
    ],
)
def test_flags_that_do_not_go_together(flags):
    with pytest.raises(SystemExit):
        jobs.main(flags)


def test_latency_stream(spark, live_comments, tmp_path):
    closed = reports.article_counts_stamped(bounded(metrics.stamp(live_comments().drop(reports.STAMP))), 24)
    run(each_batch(closed, metrics.emission_latency, str(tmp_path / "o"), str(tmp_path / "ck")))
    rows = spark.read.parquet(str(tmp_path / "o"))
    assert rows.count() == 29
    assert rows.where("latency_ms < 0").count() == 0


def test_lines_of_a_stream_as_text(spark, table, replay, tmp_path, capsys, monkeypatch):
    """One text file per micro-batch, on the console, as messages: the lines of the table up to the watermark."""
    want = [r.line for r in articles.article_top3_lines(table, 24).orderBy("window_start").collect()]
    args = ["articles", "--comments", replay, "--size", "24", "--stream", "--once", "--per-trigger", "1"]
    for sink in ("text", "parquet", "console", "kafka"):
        sent = []
        monkeypatch.setattr(jobs.kafka, "send", lambda rows, servers, topic: sent.append((rows.collect(), servers, topic)))
        capsys.readouterr()
        jobs.main([*args, "--sink", sink, "--to", "host:9092/metrics", "--out", f"{tmp_path}/{sink}", "--checkpoint", f"{tmp_path}/ck_{sink}"])
        if sink == "text":
            got = [r.value for r in spark.read.text(f"{tmp_path}/{sink}").collect()]
        elif sink == "parquet":
            got = [r.line for r in spark.read.parquet(f"{tmp_path}/{sink}").collect()]
        elif sink == "console":
            got = [x for x in capsys.readouterr().out.splitlines() if ", " in x]
        else:
            got = [r.value for rows, _, _ in sent for r in rows]
            assert {x[1:] for x in sent} == {("host:9092", "metrics")}
            heads = [[(h.key, bytes(h.value).decode()) for h in r.headers] for rows, _, _ in sent for r in rows]
            assert all(dict(h)["window"] == r.key for h, r in zip(heads, (r for rows, _, _ in sent for r in rows)))
        assert sorted(got) == sorted(want[:-1])
    with pytest.raises(SystemExit):
        jobs.main([*args, "--sink", "kafka", "--out", "x"])


def test_a_repeated_batch_replaces_its_file(spark, table, tmp_path):
    lines = articles.article_top3_lines(table, 24)
    for _ in range(2):
        write_batch_lines(lines, 3, f"{tmp_path}/o")
    assert spark.read.text(f"{tmp_path}/o").count() == lines.count()


def test_table_lines_to_every_sink(spark, table, tmp_path, capsys, monkeypatch):
    table.write.parquet(f"{tmp_path}/c")
    sent = []
    monkeypatch.setattr(jobs.kafka, "send", lambda rows, servers, topic: sent.extend(rows.collect()))
    want = sorted(r.line for r in reports.throughput_lines(reports.input_ticks(table)).collect())
    for sink in ("text", "parquet", "console", "kafka"):
        capsys.readouterr()
        jobs.main(["throughput", "--comments", f"{tmp_path}/c", "--sink", sink, "--to", "h:1/t", "--out", f"{tmp_path}/{sink}"])
        if sink == "console":
            assert sorted(x for x in capsys.readouterr().out.splitlines() if " , " in x) == want
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/text").collect()) == want
    assert sorted(r.line for r in spark.read.parquet(f"{tmp_path}/parquet").collect()) == want == sorted(r.value for r in sent)


def test_throughput_survives_a_restart(spark, table, tmp_path):
    """Counts of a stream that ended and went on are those of one that did not."""
    args = ["throughput", "--comments", f"{tmp_path}/in", "--stream", "--once", "--checkpoint", f"{tmp_path}/ck", "--out", f"{tmp_path}/n"]
    for part in range(2):
        table.where(F.col("comment_id").cast("int") % 2 == part).coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
        jobs.main([*args, "--per-trigger", "1"])
    got = metrics.read_input(spark, f"{tmp_path}/n").groupBy("stage").agg(F.sum("n")).collect()
    want = reports.input_ticks(table).groupBy("stage").agg(F.sum("n")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    jobs.main(["throughput", "--counts", f"{tmp_path}/n", "--out", f"{tmp_path}/lines"])
    last = {}
    for line in (r.value.split(" , ") for r in spark.read.text(f"{tmp_path}/lines").collect()):
        last[line[0]] = max(last.get(line[0], 0), int(line[2]))
    assert last == dict(map(tuple, want))


@pytest.mark.parametrize("files", [1, 1_000])
def test_minute_rates_of_a_stream(spark, table, replay, tmp_path, files):
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(replay)
    run(append_table(metrics.minute_rates(bounded(stream, reports.STAMP, 1_200)), f"{tmp_path}/o", f"{tmp_path}/ck"))
    got = {(r.stage, r.tick): (r.n, r.cumulative, r.rate) for r in spark.read.parquet(f"{tmp_path}/o").collect()}
    last = max(t for _, t in got)
    want = {(r.stage, r.tick): (r.n, r.cumulative, r.rate) for r in reports.throughput_rates(reports.input_ticks(table)).collect() if r.tick <= last}
    assert got.keys() == want.keys() and len(got) > 1_000
    assert all(got[k][:2] == want[k][:2] and abs(got[k][2] - want[k][2]) < 1e-9 for k in got)


def test_console(live_comments, tmp_path):
    run(to_console(live_comments().select("comment_id", "user_id"), str(tmp_path / "ck"), lines=1))


def test_kafka_shapes(spark, table):
    counts = articles.article_top3(table, 24)
    assert messages(counts).columns == ["value"]
    assert '"article_id"' in messages(counts).first().value
    lines = articles.article_top3_lines(table, 24)
    assert rows_of(line_messages(lines)) == rows_of(lines.select("line"))
    raw = spark.createDataFrame([(bytearray("é,1", "utf-8"),)], "value binary")
    assert kafka_values(raw).first().value == "é,1"


def test_write_lines_replaces(spark, table, tmp_path):
    path = str(tmp_path / "o")
    for _ in range(2):
        write_lines(daytime.slot_lines(table, 7), path)
    starts = [int(r.value.split(",")[0]) for r in spark.read.text(path).collect()]
    assert starts == sorted(starts) and len(starts) == 5
