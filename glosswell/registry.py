"""Named queries over the ``events`` test table, each with SQL for the same result.

Window starts and other times are epoch numbers here, so no zone or timestamp type gets between
the two engines. ``QUERIES`` take (spark, folder); ``ORACLES`` run where the tables are views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswell.functions.text import pack_author
from glosswell.operators.counts import start_rows
from glosswell.operators.filters import newest_approved
from glosswell.plans import articles, daytime, popularity, reports, threads
from glosswell.sources.events import lines_from_events, read_event_comments
from glosswell.sources.parse import comments_of, parse_lines, rejects_of

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _register(name: str, build, sql: str) -> None:
    QUERIES[name] = build
    ORACLES[name] = sql


def _epoch(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as epoch seconds."""
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


def _on_comments(plan, *args):
    """A plan over comments whose rows carry ``window_start``."""

    def build(spark: SparkSession, folder: str) -> DataFrame:
        rows = plan(read_event_comments(spark, folder), *args)
        if "window" in rows.columns:
            rows = start_rows(rows)
        return _epoch(rows, "window_start")

    return build


# SQL building blocks

COMMENTS = """
comments AS (
  SELECT CAST(event_id AS VARCHAR) AS comment_id,
         CAST(user_id AS VARCHAR) AS user_id,
         CAST(json_extract_string(props, '$.k') AS VARCHAR) AS article_id,
         CASE event_type WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 1 END AS depth,
         CAST(event_id - 1 - CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) AS in_reply_to,
         CAST(floor(value) AS BIGINT) AS recommendations,
         event_id % 10 = 0 AS editors_selection,
         epoch_us(ts) AS at_us,
         epoch_us(ts) + (event_id % 600) * 1000 AS ingest_us,
         (epoch_us(ts) + (event_id % 600) * 1000000) // 1000000 AS approve_s
  FROM events)
"""

CREDITS = """
record AS (SELECT * FROM comments WHERE depth IN (1, 2)),
parents AS (
  SELECT q.comment_id, q.at_us, q.user_id, q.depth, g.user_id AS parent_user_id,
         row_number() OVER (PARTITION BY q.comment_id, q.at_us ORDER BY g.at_us DESC NULLS LAST, g.user_id DESC) AS pick
  FROM record q
  LEFT JOIN record g ON q.depth = 2 AND g.comment_id = q.in_reply_to AND g.at_us <= q.at_us),
entries AS (SELECT * FROM parents WHERE pick = 1),
answered AS (
  SELECT r.comment_id AS reply_id, r.at_us, r.ingest_us, e.user_id, e.parent_user_id,
         row_number() OVER (PARTITION BY r.comment_id, r.at_us ORDER BY e.at_us DESC, e.user_id DESC) AS pick
  FROM comments r JOIN entries e ON e.comment_id = r.in_reply_to AND e.at_us <= r.at_us
  WHERE r.depth <> 1),
credits AS (
  SELECT reply_id, at_us, ingest_us, 1 AS hop, user_id FROM answered WHERE pick = 1
  UNION ALL
  SELECT reply_id, at_us, ingest_us, 2 AS hop, parent_user_id AS user_id
  FROM answered WHERE pick = 1 AND parent_user_id IS NOT NULL)
"""


def _start(size_seconds: int, at_us: str = "at_us") -> str:
    """Start of the epoch-aligned window around a time in microseconds, in seconds."""
    return f"({at_us} // {size_seconds * 1_000_000}) * {size_seconds}"


LIKE_CENTS = "recommendations * CASE WHEN editors_selection THEN 33 ELSE 30 END"


# Most commented articles

for _h in articles.WINDOW_HOURS:
    _counts = f"""
    counts AS (
      SELECT {_start(_h * 3600)} AS window_start, article_id, count(*) AS n
      FROM comments GROUP BY 1, 2)"""
    _top = """
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY n DESC, article_id) AS INTEGER) AS rank
      FROM counts QUALIFY rank <= 3)"""
    _register(
        f"article_counts_{_h}h",
        _on_comments(articles.article_counts, _h),
        f"WITH {COMMENTS}, {_counts} SELECT window_start, article_id, n FROM counts",
    )
    _register(
        f"article_top3_{_h}h",
        _on_comments(articles.article_top3, _h),
        f"WITH {COMMENTS}, {_counts}, {_top} SELECT window_start, rank, article_id, n FROM ranked",
    )
    _register(
        f"article_top3_lines_{_h}h",
        _on_comments(articles.article_top3_lines, _h),
        f"""WITH {COMMENTS}, {_counts}, {_top}
        SELECT window_start,
               CAST(window_start AS VARCHAR) || ', ' ||
               string_agg(article_id || ', ' || CAST(n AS VARCHAR), ', ' ORDER BY rank) AS line
        FROM ranked GROUP BY window_start""",
    )

# Direct comments by time of day

_TWO_HOURS = f"""
two_hours AS (
  SELECT {_start(7200)} AS slot_start, count(*) AS n FROM comments WHERE depth = 1 GROUP BY 1)"""

_register(
    "article_direct_counts_2h",
    _on_comments(daytime.article_direct_counts),
    f"""WITH {COMMENTS}
    SELECT {_start(7200)} AS window_start, article_id, count(*) AS n
    FROM comments WHERE depth = 1 GROUP BY 1, 2""",
)
_register(
    "direct_count_2h",
    _on_comments(daytime.direct_counts),
    f"""WITH {COMMENTS}, {_TWO_HOURS}
    SELECT slot_start AS window_start, CAST((slot_start // 3600) % 24 AS INTEGER) AS hour, n FROM two_hours""",
)

for _d in daytime.WINDOW_DAYS:
    _totals = f"""
    totals AS (
      SELECT (slot_start // {_d * 86400}) * {_d * 86400} AS window_start,
             CAST((slot_start // 3600) % 24 AS INTEGER) AS hour, CAST(sum(n) AS BIGINT) AS n
      FROM two_hours GROUP BY 1, 2)"""
    _columns = ", ".join(
        f"CAST(coalesce(sum(n) FILTER (hour = {h}), 0) AS BIGINT) AS h{h:02d}" for h in range(0, 24, 2)
    )
    _joined = " || ', ' || ".join(f"CAST(h{h:02d} AS VARCHAR)" for h in range(0, 24, 2))
    _register(
        f"slot_totals_{_d}d",
        _on_comments(daytime.slot_totals, _d),
        f"WITH {COMMENTS}, {_TWO_HOURS}, {_totals} SELECT window_start, hour, n FROM totals",
    )
    _register(
        f"slot_counts_{_d}d",
        _on_comments(daytime.slot_counts, _d),
        f"WITH {COMMENTS}, {_TWO_HOURS}, {_totals} SELECT window_start, {_columns} FROM totals GROUP BY 1",
    )
    _register(
        f"slot_lines_{_d}d",
        _on_comments(daytime.slot_lines, _d),
        f"""WITH {COMMENTS}, {_TWO_HOURS}, {_totals},
        spread AS (SELECT window_start, {_columns} FROM totals GROUP BY 1)
        SELECT window_start, CAST(window_start AS VARCHAR) || ', ' || {_joined} AS line FROM spread""",
    )

# Threads


def _comment_authors(spark: SparkSession, folder: str) -> DataFrame:
    return threads.latest_authors(threads.author_versions(read_event_comments(spark, folder)))


def _packed_authors(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack_author(F.col("user_id"), F.col("parent_user_id")).alias("author")
    return _comment_authors(spark, folder).select("comment_id", packed)


def _reply_credits(spark: SparkSession, folder: str) -> DataFrame:
    return threads.reply_credits(read_event_comments(spark, folder)).drop("create_date")


def _stamped_credits(spark: SparkSession, folder: str) -> DataFrame:
    credits = threads.reply_credits(read_event_comments(spark, folder), keep=(reports.STAMP,))
    return credits.select("reply_id", "hop", "user_id", "cents", F.unix_millis(reports.STAMP).alias("ingest_ms"))


_LAST_ENTRY = """
last_entry AS (
  SELECT comment_id, user_id, parent_user_id FROM entries
  QUALIFY row_number() OVER (PARTITION BY comment_id ORDER BY at_us DESC, user_id DESC) = 1)"""

_register(
    "comment_authors",
    _comment_authors,
    f"WITH {COMMENTS}, {CREDITS}, {_LAST_ENTRY} SELECT comment_id, user_id, parent_user_id FROM last_entry",
)
_register(
    "comment_authors_packed",
    _packed_authors,
    f"""WITH {COMMENTS}, {CREDITS}, {_LAST_ENTRY}
    SELECT comment_id, concat_ws(';', user_id, parent_user_id) AS author FROM last_entry""",
)
_register(
    "reply_credits",
    _reply_credits,
    f"""WITH {COMMENTS}, {CREDITS}
    SELECT reply_id, hop, user_id, CAST(70 AS BIGINT) AS cents FROM credits""",
)
_register(
    "stamped_reply_credits",
    _stamped_credits,
    f"""WITH {COMMENTS}, {CREDITS}
    SELECT reply_id, hop, user_id, CAST(70 AS BIGINT) AS cents, ingest_us // 1000 AS ingest_ms FROM credits""",
)

# Popular users


def _running_replies(spark: SparkSession, folder: str) -> DataFrame:
    credits = threads.reply_credits(read_event_comments(spark, folder))
    return popularity.running_reply_scores(credits).drop("create_date")


_register(
    "running_reply_scores",
    _running_replies,
    f"""WITH {COMMENTS}, {CREDITS}
    SELECT reply_id, hop, user_id,
           CAST(sum(70) OVER (PARTITION BY user_id ORDER BY at_us, reply_id, hop ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cents
    FROM credits""",
)


def _running_scores(window_hours: int):
    def build(spark: SparkSession, folder: str) -> DataFrame:
        comments = read_event_comments(spark, folder)
        scores = popularity.running_user_scores(
            threads.reply_credits(comments), popularity.like_scores(comments, window_hours)
        )
        return scores.select(
            F.unix_micros("at").alias("at_us"), "reply_id", "hop", "user_id", F.col("cents").cast("bigint").alias("cents")
        )

    return build


def _running_top(window_hours: int):
    def build(spark: SparkSession, folder: str) -> DataFrame:
        ranked = popularity.popular_users_running(read_event_comments(spark, folder), window_hours)
        # BIGINT in this report; a score past its range fails the cast instead of wrapping.
        return _epoch(ranked.withColumn("cents", F.col("cents").cast("bigint")), "window_start")

    return build


def _user_lines(spark: SparkSession, folder: str) -> DataFrame:
    ranked = popularity.popular_users(read_event_comments(spark, folder), 24)
    return _epoch(popularity.user_lines(ranked), "window_start")


def _running_lines(spark: SparkSession, folder: str) -> DataFrame:
    ranked = popularity.popular_users_running(read_event_comments(spark, folder), 24)
    return _epoch(popularity.user_lines(ranked), "window_start")


_LINES = """
SELECT window_start,
       CAST(window_start AS VARCHAR) || ', ' ||
       string_agg(user_id || ', ' || CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0'),
                  ', ' ORDER BY rank) AS line
FROM ranked GROUP BY window_start"""

for _h in popularity.WINDOW_HOURS:
    _scores = f"""
    scores AS (
      SELECT window_start, user_id, CAST(sum(cents) AS BIGINT) AS cents
      FROM (SELECT {_start(_h * 3600)} AS window_start, user_id, {LIKE_CENTS} AS cents FROM comments WHERE depth = 1
            UNION ALL
            SELECT {_start(_h * 3600)}, user_id, 70 FROM credits)
      GROUP BY 1, 2),
    ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY cents DESC, user_id) AS INTEGER) AS rank
      FROM scores QUALIFY rank <= 10)"""
    _like_totals = f"""
    like_totals AS (
      SELECT {_start(_h * 3600)} AS window_start, user_id, CAST(sum({LIKE_CENTS}) AS BIGINT) AS cents
      FROM comments WHERE depth = 1 GROUP BY 1, 2)"""
    _running = f"""
    replies_so_far AS (
      SELECT at_us, 0 AS is_like, reply_id, hop, user_id,
             sum(70) OVER (PARTITION BY user_id ORDER BY at_us, reply_id, hop ROWS UNBOUNDED PRECEDING) AS addend
      FROM credits),
    mixed AS (
      SELECT * FROM replies_so_far
      UNION ALL
      SELECT (window_start + {_h * 3600}) * 1000000 - 1, 1, '', 0, user_id, cents FROM like_totals),
    running AS (
      SELECT at_us, is_like, reply_id, hop, user_id,
             CAST(sum(addend) OVER (PARTITION BY user_id ORDER BY at_us, is_like, reply_id, hop
                                    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cents
      FROM mixed)"""
    _running_ranked = f"""
    ranked AS (
      SELECT {_start(_h * 3600)} AS window_start, user_id, cents,
             CAST(row_number() OVER (PARTITION BY {_start(_h * 3600)}
                                     ORDER BY cents DESC, at_us, is_like, reply_id, hop, user_id) AS INTEGER) AS rank
      FROM running QUALIFY rank <= 10)"""
    _register(
        f"like_score_{_h}h",
        _on_comments(popularity.like_scores, _h),
        f"WITH {COMMENTS}, {_like_totals} SELECT window_start, user_id, cents FROM like_totals",
    )
    _register(
        f"popular_users_{_h}h",
        _on_comments(popularity.popular_users, _h),
        f"WITH {COMMENTS}, {CREDITS}, {_scores} SELECT window_start, rank, user_id, cents FROM ranked",
    )
    _register(
        f"popular_users_running_{_h}h",
        _running_top(_h),
        f"""WITH {COMMENTS}, {CREDITS}, {_like_totals}, {_running}, {_running_ranked}
        SELECT window_start, rank, user_id, cents FROM ranked""",
    )
    if _h == 24:
        _register("popular_users_lines_24h", _user_lines, f"WITH {COMMENTS}, {CREDITS}, {_scores} {_LINES}")
        _register(
            "popular_users_running_lines_24h",
            _running_lines,
            f"WITH {COMMENTS}, {CREDITS}, {_like_totals}, {_running}, {_running_ranked} {_LINES}",
        )
        _register(
            "running_user_scores_24h",
            _running_scores(_h),
            f"""WITH {COMMENTS}, {CREDITS}, {_like_totals}, {_running}
            SELECT at_us, reply_id, hop, user_id, cents FROM running""",
        )

# Ingest


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse_lines(lines_from_events(spark.read.parquet(f"{folder}/events.parquet")))


def _ingest_comments(spark: SparkSession, folder: str) -> DataFrame:
    return _epoch(comments_of(_parsed(spark, folder)), "approve_date", "create_date")


def _ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return rejects_of(_parsed(spark, folder))


_SPOILED = """
spoiled AS (
  SELECT event_id, event_id % 17 AS variant, epoch_us(ts) // 1000000 AS created,
         epoch_us(ts) // 1000000 + event_id % 600 AS approved,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, user_id,
         CASE event_type WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 1 END AS depth,
         CAST(floor(value) AS INTEGER) AS likes, event_id % 10 = 0 AS picked
  FROM events)"""

_register(
    "ingest_comments",
    _ingest_comments,
    f"""WITH {_SPOILED}
    SELECT approved AS approve_date, CAST(k AS VARCHAR) AS article_id,
           CAST(k + 100 AS INTEGER) AS article_word_count, CAST(event_id AS VARCHAR) AS comment_id,
           event_type AS comment_type, created AS create_date, depth,
           CASE variant WHEN 10 THEN true WHEN 11 THEN false ELSE picked END AS editors_selection,
           CAST(event_id - 1 - k AS VARCHAR) AS in_reply_to, '' AS parent_user_display_name,
           likes AS recommendations,
           CASE WHEN variant = 1 THEN '"Arts, X"' ELSE 'section ' || CAST(k % 10 AS VARCHAR) END AS section_name,
           'user ' || CAST(user_id AS VARCHAR) AS user_display_name, CAST(user_id AS VARCHAR) AS user_id,
           CASE WHEN variant = 1 THEN '"Rome, ""IT\"""' ELSE 'UTC' END AS user_location
    FROM spoiled WHERE variant IN (0, 1, 2, 4, 7, 10, 11, 15)""",
)
_register(
    "ingest_rejects",
    _ingest_rejects,
    f"""WITH {_SPOILED}
    SELECT CASE variant
             WHEN 3 THEN CAST(event_id AS VARCHAR) || ',y'
             WHEN 13 THEN CAST(event_id AS VARCHAR) || ',"y'
             WHEN 16 THEN NULL
             ELSE concat_ws(',',
               CASE variant WHEN 5 THEN CAST(approved AS VARCHAR) || '.0' WHEN 9 THEN '' ELSE CAST(approved AS VARCHAR) END,
               CAST(k AS VARCHAR),
               CASE variant WHEN 8 THEN '3000000000' ELSE CAST(k + 100 AS VARCHAR) END,
               CAST(event_id AS VARCHAR), event_type, CAST(created AS VARCHAR),
               CASE variant WHEN 6 THEN ' ' || CAST(depth AS VARCHAR) || ' ' ELSE CAST(depth AS VARCHAR) END,
               CASE WHEN picked THEN 'True' ELSE 'False' END,
               CAST(event_id - 1 - k AS VARCHAR), '', CAST(likes AS VARCHAR),
               'section ' || CAST(k % 10 AS VARCHAR), 'user ' || CAST(user_id AS VARCHAR),
               CASE variant WHEN 12 THEN CAST(user_id AS VARCHAR) || 'a' ELSE CAST(user_id AS VARCHAR) END, 'UTC')
           END AS value,
           CASE variant WHEN 3 THEN 'tokens' WHEN 13 THEN 'tokens' WHEN 16 THEN 'tokens' WHEN 5 THEN 'approve_date' WHEN 9 THEN 'approve_date'
             WHEN 6 THEN 'depth' WHEN 8 THEN 'article_word_count' ELSE 'user_id' END AS reason
    FROM spoiled WHERE variant IN (3, 5, 6, 8, 9, 12, 13, 16)""",
)


def _newest(spark: SparkSession, folder: str) -> DataFrame:
    return _epoch(newest_approved(read_event_comments(spark, folder), 100), "approve_date")


_register(
    "newest_approved",
    _newest,
    f"""WITH {COMMENTS}
    SELECT comment_id, approve_s AS approve_date FROM comments
    ORDER BY at_us + (CAST(comment_id AS BIGINT) % 600) * 1000000 DESC, comment_id LIMIT 100""",
)

# Running scores with the latest ingest time behind them


def _running_replies_stamped(spark: SparkSession, folder: str) -> DataFrame:
    credits = threads.reply_credits(read_event_comments(spark, folder), keep=(reports.STAMP,))
    scores = popularity.running_reply_scores(credits, stamp=reports.STAMP)
    return scores.select("reply_id", "hop", "user_id", "cents", F.unix_millis(reports.STAMP).alias("ingest_ms"))


def _running_scores_stamped(spark: SparkSession, folder: str) -> DataFrame:
    comments = read_event_comments(spark, folder)
    scores = popularity.running_user_scores(
        threads.reply_credits(comments, keep=(reports.STAMP,)),
        reports.like_scores_stamped(comments, 24),
        stamp=reports.STAMP,
    )
    return scores.select(
        F.unix_micros("at").alias("at_us"),
        "reply_id",
        "hop",
        "user_id",
        F.col("cents").cast("bigint").alias("cents"),
        F.unix_millis(reports.STAMP).alias("ingest_ms"),
    )


_register(
    "running_reply_scores_stamped",
    _running_replies_stamped,
    f"""WITH {COMMENTS}, {CREDITS}
    SELECT reply_id, hop, user_id, CAST(sum(70) OVER w AS BIGINT) AS cents, max(ingest_us) OVER w // 1000 AS ingest_ms
    FROM credits
    WINDOW w AS (PARTITION BY user_id ORDER BY at_us, reply_id, hop ROWS UNBOUNDED PRECEDING)""",
)
_register(
    "running_user_scores_stamped_24h",
    _running_scores_stamped,
    f"""WITH {COMMENTS}, {CREDITS},
    like_totals AS (
      SELECT {_start(86400)} AS window_start, user_id, CAST(sum({LIKE_CENTS}) AS BIGINT) AS cents,
             max(ingest_us) AS ingest_us
      FROM comments WHERE depth = 1 GROUP BY 1, 2),
    mixed AS (
      SELECT at_us, 0 AS is_like, reply_id, hop, user_id, ingest_us,
             sum(70) OVER (PARTITION BY user_id ORDER BY at_us, reply_id, hop ROWS UNBOUNDED PRECEDING) AS addend
      FROM credits
      UNION ALL
      SELECT (window_start + 86400) * 1000000 - 1, 1, '', 0, user_id, ingest_us, cents FROM like_totals)
    SELECT at_us, reply_id, hop, user_id, CAST(sum(addend) OVER w AS BIGINT) AS cents,
           max(ingest_us) OVER w // 1000 AS ingest_ms
    FROM mixed
    WINDOW w AS (PARTITION BY user_id ORDER BY at_us, is_like, reply_id, hop ROWS UNBOUNDED PRECEDING)""",
)

# Operational reports


def _tick_report(ticks):
    def build(spark: SparkSession, folder: str) -> DataFrame:
        return reports.throughput(ticks(read_event_comments(spark, folder)))

    return build


_INPUT_ROWS = """
stage_rows AS (
  SELECT 'query1_in' AS stage, ingest_us FROM comments
  UNION ALL SELECT 'query2_in', ingest_us FROM comments WHERE depth = 1
  UNION ALL SELECT 'query3_in', ingest_us FROM comments)"""

_TICKS = """
ticks AS (SELECT stage, ingest_us // 5000000 AS tick, count(*) AS n FROM stage_rows GROUP BY 1, 2),
metered AS (
  SELECT *, CAST(sum(n) OVER (PARTITION BY stage ORDER BY tick ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative
  FROM ticks)"""

_STAGES = f"""
inner_slots AS (
  SELECT {_start(7200)} AS slot_start, article_id, min(ingest_us) AS ingest_us
  FROM comments WHERE depth = 1 GROUP BY 1, 2),
slots AS (SELECT slot_start, max(ingest_us) AS ingest_us FROM inner_slots GROUP BY 1),
like_stamps AS (
  SELECT {_start(86400)} AS window_start, user_id, max(ingest_us) AS ingest_us
  FROM comments WHERE depth = 1 GROUP BY 1, 2),
stage_rows AS (
  SELECT 'query1_window' AS stage, max(ingest_us) AS ingest_us
  FROM comments GROUP BY {_start(86400)}, article_id
  UNION ALL SELECT 'query2_inner_window', ingest_us FROM inner_slots
  UNION ALL SELECT 'query2_final_window', max(ingest_us) FROM slots
            GROUP BY slot_start // {7 * 86400}, (slot_start // 3600) % 24
  UNION ALL SELECT 'query3_likes', ingest_us FROM like_stamps
  UNION ALL SELECT 'query3_window', ingest_us FROM like_stamps
  UNION ALL SELECT 'query3_window', ingest_us FROM credits)"""

# The rate of each tick out of its own and all ticks before it, as a self-join on the tick.
_RATES = """
SELECT a.stage, a.tick, any_value(a.n) AS n,
       round(sum(b.n * CASE WHEN b.cumulative = b.n THEN 1 ELSE 1 - exp(-5.0 / 60) END
                 * exp((b.tick - a.tick) / 12.0)) / 5, 6) AS rate
FROM metered a JOIN metered b ON a.stage = b.stage AND b.tick <= a.tick
GROUP BY a.stage, a.tick"""



def _stamped(plan, *args):
    """A stamped plan with its stamp in milliseconds."""

    def build(spark: SparkSession, folder: str) -> DataFrame:
        rows = start_rows(plan(read_event_comments(spark, folder), *args))
        return _epoch(rows.withColumn("ingest_ms", F.unix_millis(reports.STAMP)).drop(reports.STAMP), "window_start")

    return build


_STAMPED_SLOTS = f"""
per_article AS (
  SELECT {_start(7200)} AS slot_start, article_id, count(*) AS n, min(ingest_us) AS ingest_us
  FROM comments WHERE depth = 1 GROUP BY 1, 2),
per_slot AS (
  SELECT slot_start, CAST((slot_start // 3600) % 24 AS INTEGER) AS hour, CAST(sum(n) AS BIGINT) AS n,
         max(ingest_us) AS ingest_us
  FROM per_article GROUP BY 1)"""

_register(
    "article_counts_stamped_24h",
    _stamped(reports.article_counts_stamped, 24),
    f"""WITH {COMMENTS}
    SELECT {_start(86400)} AS window_start, article_id, count(*) AS n, max(ingest_us) // 1000 AS ingest_ms
    FROM comments GROUP BY 1, 2""",
)
_register(
    "article_direct_counts_stamped_2h",
    _stamped(reports.article_direct_counts_stamped),
    f"""WITH {COMMENTS}, {_STAMPED_SLOTS}
    SELECT slot_start AS window_start, article_id, n, ingest_us // 1000 AS ingest_ms FROM per_article""",
)
_register(
    "direct_counts_stamped_2h",
    _stamped(reports.direct_counts_stamped),
    f"""WITH {COMMENTS}, {_STAMPED_SLOTS}
    SELECT slot_start AS window_start, hour, n, ingest_us // 1000 AS ingest_ms FROM per_slot""",
)
_register(
    "slot_totals_stamped_7d",
    _stamped(reports.slot_totals_stamped, 7),
    f"""WITH {COMMENTS}, {_STAMPED_SLOTS}
    SELECT (slot_start // 604800) * 604800 AS window_start, hour, CAST(sum(n) AS BIGINT) AS n,
           max(ingest_us) // 1000 AS ingest_ms
    FROM per_slot GROUP BY 1, 2""",
)
_register(
    "like_scores_stamped_24h",
    _stamped(reports.like_scores_stamped, 24),
    f"""WITH {COMMENTS}
    SELECT {_start(86400)} AS window_start, user_id, CAST(sum({LIKE_CENTS}) AS BIGINT) AS cents,
           max(ingest_us) // 1000 AS ingest_ms
    FROM comments WHERE depth = 1 GROUP BY 1, 2""",
)


def _rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = reports.throughput_rates(reports.input_ticks(read_event_comments(spark, folder)))
    return rates.select("stage", "tick", "n", F.round("rate", 6).alias("rate"))


_register(
    "input_throughput",
    _tick_report(reports.input_ticks),
    f"WITH {COMMENTS}, {_INPUT_ROWS}, {_TICKS} SELECT stage, tick, n, cumulative FROM metered",
)
_register(
    "stage_throughput",
    _tick_report(reports.stage_ticks),
    f"WITH {COMMENTS}, {CREDITS}, {_STAGES}, {_TICKS} SELECT stage, tick, n, cumulative FROM metered",
)
_register("ewma_rate", _rates, f"WITH {COMMENTS}, {_INPUT_ROWS}, {_TICKS} {_RATES}")


def _latency_sql(latest: str, size: int, delay_s: int, where: str) -> str:
    """Windows with the first ingest that puts the watermark into a later window."""
    return f"""
    latest AS ({latest}),
    reached AS (
      SELECT {_start(size, f"(at_us - {delay_s * 1_000_000})")} AS window_start, min(ingest_us) AS seen
      FROM comments WHERE {where} GROUP BY 1)
    SELECT l.window_start, min(r.seen) // 1000 - any_value(l.ingest_us) // 1000 AS latency_ms
    FROM latest l JOIN reached r ON r.window_start > l.window_start
    GROUP BY l.window_start"""


_register(
    "window_latency_q1",
    _on_comments(reports.article_latency, 24),
    f"WITH {COMMENTS}, "
    + _latency_sql(
        f"SELECT {_start(86400)} AS window_start, max(ingest_us) AS ingest_us FROM comments GROUP BY 1", 86400, 1, "true"
    ),
)


def _latency_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = reports.latency_lines(reports.article_latency(read_event_comments(spark, folder), 24))
    return _epoch(lines, "window_start")


_register(
    "latency_lines_q1",
    _latency_lines,
    f"WITH {COMMENTS}, rows AS (WITH "
    + _latency_sql(
        f"SELECT {_start(86400)} AS window_start, max(ingest_us) AS ingest_us FROM comments GROUP BY 1", 86400, 1, "true"
    )
    + """)
    SELECT window_start, CAST(window_start * 1000 AS VARCHAR) || ',' || CAST(latency_ms AS VARCHAR) AS line FROM rows""",
)
_register(
    "window_latency_q2",
    _on_comments(reports.slot_latency, 1),
    f"WITH {COMMENTS}, {CREDITS}, {_STAGES}, "
    + _latency_sql(
        "SELECT (slot_start // 86400) * 86400 AS window_start, max(ingest_us) AS ingest_us FROM slots GROUP BY 1",
        86400,
        0,
        "depth = 1",
    ),
)
_register(
    "window_latency_q3",
    _on_comments(reports.user_latency, 24),
    f"""WITH {COMMENTS}, {CREDITS},
    scored AS (
      SELECT user_id, at_us, ingest_us FROM comments WHERE depth = 1
      UNION ALL SELECT user_id, at_us, ingest_us FROM credits),
    stamps AS (SELECT {_start(86400)} AS window_start, user_id, max(ingest_us) AS ingest_us FROM scored GROUP BY 1, 2),
    kept AS (
      SELECT window_start, max(ingest_us) OVER (PARTITION BY user_id ORDER BY window_start) AS ingest_us FROM stamps), """
    + _latency_sql("SELECT window_start, max(ingest_us) AS ingest_us FROM kept GROUP BY 1", 86400, 1, "true"),
)
