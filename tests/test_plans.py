"""Properties of the results, and a plain model of the running ranking."""

import math
import random
import re
from collections import defaultdict

import pytest
from helpers import START, comment, comments, rows_of
from pyspark.sql import functions as F

from glosswell.functions.scores import like_cents, points
from glosswell.functions.text import pack_author, unpack_author
from glosswell.operators.later import least_later
from glosswell.operators.meters import ALPHA, one_minute_rates
from glosswell.operators.running import running_totals, time_slice
from glosswell.operators.slots import SLOT_COLUMNS
from glosswell.plans import articles, daytime, popularity, reports, threads
from glosswell.sources.events import read_event_comments


@pytest.fixture(scope="module")
def table(spark, small):
    return read_event_comments(spark, small)


def test_windows_start_at_the_epoch(spark):
    rows = [comment("1", 1, "A", at=0)]
    start = articles.article_top3(comments(spark, rows), 168).select(F.unix_seconds("window_start")).first()[0]
    assert start == 1_514_419_200
    month = daytime.slot_counts(comments(spark, rows), 30).select(F.unix_seconds("window_start")).first()[0]
    assert month == 1_513_728_000


def test_lines(spark):
    rows = [comment(str(i), 1, f"u{i % 2}", at=i, likes=1, article=a) for i, a in enumerate("aabbc")]
    table = comments(spark, rows)
    assert articles.article_top3_lines(table, 24).first().line == f"{START}, a, 2, b, 2, c, 1"
    assert daytime.slot_lines(table, 1).first().line == f"{START}, 5" + ", 0" * 11
    users = popularity.user_lines(popularity.popular_users(table, 24))
    assert users.first().line == f"{START}, u0, 0.90, u1, 0.60"


def test_points_are_exact(spark):
    cents = [0, 5, 70, 12345, -70, 2**62, 10**30]
    frame = spark.createDataFrame([(str(c),) for c in cents], "c string").select(F.col("c").cast("decimal(38,0)").alias("c"))
    got = [r[0] for r in frame.select(points(F.col("c"))).collect()]
    assert got == [f"{'-' if c < 0 else ''}{abs(c) // 100}.{abs(c) % 100:02d}" for c in cents]


def test_like_cents(spark):
    frame = spark.createDataFrame([(3, True), (3, False), (2_000_000_000, True)], "n int, e boolean")
    assert [r[0] for r in frame.select(like_cents(F.col("n"), F.col("e"))).collect()] == [99, 90, 66_000_000_000]


def test_author_packing(spark):
    frame = spark.createDataFrame([("a", None), ("a", "b"), ("a", "b;c")], "u string, p string")
    packed = frame.select(pack_author(F.col("u"), F.col("p")).alias("x"))
    assert [r.x for r in packed.collect()] == ["a", "a;b", "a;b;c"]
    own, parent = unpack_author(F.col("x"))
    assert [tuple(r) for r in packed.select(own, parent).collect()] == [("a", None), ("a", "b"), ("a", "b")]


def test_direct_counts_equal_article_counts_summed(table):
    per_article = daytime.article_direct_counts(table).groupBy("window").agg(F.sum("n").alias("n"))
    assert rows_of(per_article) == rows_of(daytime.direct_counts(table).select("window", "n"))


def test_slots_roll_up(table):
    def total(days):
        return [daytime.slot_counts(table, days).agg(*[F.sum(c) for c in SLOT_COLUMNS]).first()]

    assert total(1) == total(7) == total(30)
    assert sum(total(1)[0]) == table.where("depth = 1").count()


def test_ranks_have_no_gaps(table):
    for ranked, k in [
        (articles.article_top3(table, 24), 3),
        (popularity.popular_users(table, 24), 10),
        (popularity.popular_users_running(table, 24), 10),
    ]:
        ranks = defaultdict(list)
        for row in ranked.collect():
            ranks[row.window_start].append(row.rank)
        assert all(sorted(r) == list(range(1, len(r) + 1)) and len(r) <= k for r in ranks.values())


def test_scores_are_likes_plus_replies(table):
    credits = threads.reply_credits(table)
    rows = popularity.likes(table).unionByName(credits.select("create_date", "user_id", "cents"))
    total = popularity.user_scores(rows, 168).agg(F.sum("cents")).first()[0]
    assert total == popularity.likes(table).agg(F.sum("cents")).first()[0] + 70 * credits.count()


def test_running_scores_follow_a_plain_walk(table):
    """Add running reply totals and like totals up, row by row, per user."""
    credits = threads.reply_credits(table)
    totals = popularity.like_scores(table, 24)
    rows = [(r.create_date, 0, r.reply_id, r.hop, r.user_id, 70) for r in credits.collect()]
    ends = totals.select(F.window_time("window").alias("at"), "user_id", "cents").collect()
    rows += [(r.at, 1, "", 0, r.user_id, r.cents) for r in ends]
    replied, score, want = defaultdict(int), defaultdict(int), []
    for at, is_like, reply, hop, user, cents in sorted(rows):
        if not is_like:
            replied[user] += cents
            cents = replied[user]
        score[user] += cents
        want.append((at, is_like, reply, hop, user, score[user]))
    for seconds in (3_600, 86_400, 10**9):
        got = popularity.running_user_scores(credits, totals, seconds)
        assert sorted((*r[:5], int(r.cents)) for r in got.collect()) == sorted(want)


def test_running_score_outgrows_bigint(spark):
    n = 10**10
    frame = spark.createDataFrame([(n, 5)], "n bigint, l bigint")
    from glosswell.functions.scores import compounded_cents

    assert int(frame.select(compounded_cents(F.col("n"), F.col("l"))).first()[0]) == 35 * n * (n + 1) + 5


def test_running_totals_do_not_depend_on_slices(spark):
    frame = spark.range(500).select(
        (F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 700).alias("at"), "id", (F.col("id") - 250).alias("x")
    )

    def total(seconds):
        return rows_of(running_totals(frame, ["k"], ["at", "id"], {"t": "x"}, time_slice(F.col("at"), seconds)))

    assert total(1_000) == total(86_400) == total(10**9)


def test_rates_follow_the_recurrence(spark):
    ticks = [0, 1, 2, 5, 40, 41, 300, 719, 720, 721, 800, 1500]
    counts = {t: 1 + t % 7 for t in ticks}
    rate, want = None, {}
    for t in range(max(ticks) + 1):
        plain = counts.get(t, 0) / 5
        rate = plain if rate is None else rate + ALPHA * (plain - rate)
        want[t] = rate
    so_far, rows = 0, []
    for t in ticks:
        so_far += counts[t]
        rows.append(("s", t, counts[t], so_far))
    frame = spark.createDataFrame(rows, "stage string, tick bigint, n bigint, cumulative bigint")
    got = {r.tick: r.rate for r in one_minute_rates(frame).collect()}
    assert got.keys() == counts.keys()
    assert all(math.isclose(got[t], want[t], abs_tol=1e-5) for t in got)


def test_rate_forgets_no_burst(spark):
    """A thousand million rows in one tick still weigh after any number of ticks."""
    ticks = [(0, 10**9), (169, 1), (1_500, 1), (40_000, 1)]
    frame = spark.createDataFrame(
        [("s", t, n, 10**9 + i) for i, (t, n) in enumerate(ticks)], "stage string, tick bigint, n bigint, cumulative bigint"
    )
    got = {r.tick: r.rate for r in one_minute_rates(frame).collect()}
    assert math.isclose(got[169], 2e8 * (1 - ALPHA) ** 169 + ALPHA / 5, rel_tol=1e-9)
    assert round(got[169], 2) == 153.02
    assert math.isclose(got[1_500], ALPHA / 5 + 2e8 * math.exp(-125), rel_tol=1e-9)
    assert got[40_000] == ALPHA / 5


def test_input_throughput_counts_every_comment(table):
    last = reports.throughput(reports.input_ticks(table)).groupBy("stage").agg(F.max("cumulative"))
    assert dict(map(tuple, last.collect())) == {
        "query1_in": table.count(),
        "query2_in": table.where("depth = 1").count(),
        "query3_in": table.count(),
    }


def test_throughput_lines(table):
    lines = reports.throughput_lines(reports.input_ticks(table))
    assert re.fullmatch(r"query\d_in , \d{13} , \d+ , \d.*", lines.first().line)
    assert lines.count() == reports.input_ticks(table).count()


def test_latency_leaves_out_the_open_window(table):
    rows = reports.article_latency(table, 24)
    assert rows.count() == articles.article_top3(table, 24).select("window_start").distinct().count() - 1
    assert rows.where("latency_ms < 0").count() == 0
    assert re.fullmatch(r"\d{13},\d+", reports.latency_lines(rows).first().line)


def test_least_later_value(spark):
    rng = random.Random(6)
    rows = [(n, rng.choice([None, rng.randrange(1000)])) for n in {rng.randrange(-3_000_000, 3_000_000) for _ in range(400)} | {0, -1, 1, 1023, 1024}]
    rows.append((5_000_000, None))
    frame = spark.createDataFrame(rows, "n bigint, v bigint")
    got = {r.n: r.x for r in least_later(frame, "n", "v", "x").collect()}
    assert got == {n: min((v for m, v in rows if m > n and v is not None), default=None) for n, _ in rows}


def final_plan(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def test_latency_has_no_window_in_one_task(table):
    for df in (reports.article_latency(table, 24), reports.slot_latency(table, 7), reports.user_latency(table, 24)):
        assert "SinglePartition" not in final_plan(df) + plan_of(df)


def test_credits_come_from_two_scans(spark, small, tmp_path):
    read_event_comments(spark, small).write.parquet(str(tmp_path / "c"))
    rows = spark.read.parquet(str(tmp_path / "c"))
    for df in (threads.reply_credits(rows), threads.reply_credits(rows, keep=(reports.STAMP,)), threads.reply_credits(rows).select("user_id", "cents")):
        plan = final_plan(df)
        assert len(re.findall(r"\bFileScan\b", plan)) == 2
        assert len(re.findall(r"\bExchange hash", plan)) - len(re.findall("ReusedExchange", plan)) <= 5


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rankings_limit_rows_before_the_shuffle(table):
    assert plan_of(articles.article_top3(table, 24)).count("WindowGroupLimit") == 2
    assert plan_of(popularity.popular_users(table, 720)).count("WindowGroupLimit") == 2


def test_no_python_and_no_cross_joins_in_table_plans(table):
    for df in (
        articles.article_top3(table, 24),
        daytime.slot_counts(table, 7),
        popularity.popular_users(table, 24),
        popularity.popular_users_running(table, 24),
        reports.user_latency(table, 24),
    ):
        plan = plan_of(df)
        for word in ("Python", "CartesianProduct", "BroadcastNestedLoop"):
            assert word not in plan


def test_scans_read_only_what_is_needed(table):
    plan = plan_of(daytime.slot_counts(table, 7))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "ts:timestamp_ntz,event_type:string"
