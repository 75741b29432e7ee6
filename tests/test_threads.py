import random

import pytest
from helpers import comment, comments, rows_of

from glosswell.plans import threads


def credits(spark, rows, *width):
    out = threads.reply_credits(comments(spark, rows), (), *width)
    return sorted((r.reply_id, r.hop, r.user_id) for r in out.collect())


SHAPES = {
    "direct only": ([("1", 1, "A", "0")], []),
    "reply": ([("1", 1, "A", "0"), ("2", 2, "B", "1")], [("2", 1, "A")]),
    "reply to reply": (
        [("1", 1, "A", "0"), ("2", 2, "B", "1"), ("3", 3, "C", "2")],
        [("2", 1, "A"), ("3", 1, "B"), ("3", 2, "A")],
    ),
    "reply to depth 3": (
        [("1", 1, "A", "0"), ("2", 2, "B", "1"), ("3", 3, "C", "2"), ("4", 4, "D", "3")],
        [("2", 1, "A"), ("3", 1, "B"), ("3", 2, "A")],
    ),
    "depth 2 under depth 2": (
        [("1", 1, "A", "0"), ("2", 2, "B", "1"), ("5", 2, "E", "2"), ("6", 3, "F", "5")],
        [("2", 1, "A"), ("5", 1, "B"), ("5", 2, "A"), ("6", 1, "E"), ("6", 2, "B")],
    ),
    "orphan": ([("7", 2, "G", "99"), ("8", 3, "H", "7")], [("8", 1, "G")]),
    "self reply": ([("1", 1, "A", "0"), ("9", 2, "A", "1")], [("9", 1, "A")]),
    "same user twice": (
        [("1", 1, "A", "0"), ("2", 2, "A", "1"), ("3", 3, "C", "2")],
        [("2", 1, "A"), ("3", 1, "A"), ("3", 2, "A")],
    ),
    "parent later": ([("2", 2, "B", "1"), ("1", 1, "A", "0")], []),
    "depth 0": ([("1", 1, "A", "0"), ("10", 0, "K", "1")], [("10", 1, "A")]),
    "repeated id": (
        [("1", 1, "A", "0"), ("2", 2, "B", "1"), ("1", 1, "Z", "0"), ("3", 2, "C", "1")],
        [("2", 1, "A"), ("3", 1, "Z")],
    ),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_thread_shapes(spark, shape):
    rows, expected = SHAPES[shape]
    made = [comment(i, depth, user, to, at=n) for n, (i, depth, user, to) in enumerate(rows)]
    assert credits(spark, made) == expected


def test_entries_of_the_same_instant_are_visible(spark):
    assert credits(spark, [comment("1", 1, "A"), comment("2", 2, "B", "1")]) == [("2", 1, "A")]


def test_null_keys_find_nothing(spark):
    rows = [comment("1", 1, "A"), comment("2", 2, "B", None, at=1), comment("3", 3, "C", "2", at=2)]
    assert credits(spark, rows) == [("3", 1, "B")]
    authors = threads.latest_authors(threads.author_versions(comments(spark, rows)))
    assert rows_of(authors) == [("1", "A", None), ("2", "B", None)]


def crowded(n=1500):
    """Most replies go to one comment, and that comment keeps changing its author."""
    rng = random.Random(3)
    rows = []
    for i in range(n):
        draw = rng.random()
        at = i * 45.0 + rng.random()
        if draw < 0.2:
            rows.append(comment("hot", rng.choice([1, 2]), f"h{i}", "hot", at=at))
        elif draw < 0.6:
            rows.append(comment(f"r{i}", rng.choice([2, 3]), f"u{rng.randrange(9)}", "hot", at=at))
        elif draw < 0.8:
            rows.append(comment(f"d{i}", 1, f"u{rng.randrange(9)}", at=at))
        else:
            rows.append(comment(f"s{i}", 2, f"u{rng.randrange(9)}", f"{rng.choice('drs')}{rng.randrange(i)}", at=at))
    return rows


def fold(rows):
    """Credits by walking the comments in order with a plain dictionary per question."""
    def latest(key, at):
        seen = [r for r in rows if r[3] == key and r[6] in (1, 2) and r[5] <= at]
        return max(seen, key=lambda r: (r[5], r[13])) if seen else None

    out = []
    for r in rows:
        if r[6] == 1:
            continue
        parent = latest(r[8], r[5])
        if parent is None:
            continue
        out.append((r[3], 1, parent[13]))
        above = latest(parent[8], parent[5]) if parent[6] == 2 else None
        if above is not None:
            out.append((r[3], 2, above[13]))
    return sorted(out)


@pytest.mark.parametrize("width", [1, 60, 3_600, 86_400, 10**9])
def test_bucket_width_moves_no_result(spark, width):
    rows = crowded(400)
    assert credits(spark, rows, width) == fold(rows)


def test_many_replies_in_one_instant(spark):
    rows = [comment("1", 1, "A"), comment("1", 1, "B", at=3_599)]
    rows += [comment(f"r{i}", 2, "C", "1", at=3_600) for i in range(200)]
    assert credits(spark, rows) == sorted((f"r{i}", 1, "B") for i in range(200))


def test_building_a_plan_runs_no_job(spark):
    table = comments(spark, crowded(50))
    spark.sparkContext.setJobGroup("build", "plans only")
    try:
        threads.reply_credits(table)
        threads.latest_authors(threads.author_versions(table))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
