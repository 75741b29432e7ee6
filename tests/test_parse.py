import random

import pytest
from helpers import START
from pyspark.sql import functions as F

from glosswell.schema import COMMENT_SCHEMA
from glosswell.sources.parse import MARK, QUOTED_SPLIT, comments_of, parse_lines, rejects_of, split_line

GOOD = [
    "1514764800", "5a49", "100", "25", "comment", "1514764801", "1", "True", "0", "", "3",
    '"Arts, X"', "Bob", "123", '"Rome, ""IT"""',
]


def line(**changes):
    """The good line with some fields, by position, replaced: ``line(f6=" 1 ")``."""
    fields = list(GOOD)
    for name, value in changes.items():
        fields[int(name[1:])] = value
    return ",".join(fields)


def parsed(spark, *lines):
    return parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


def test_good_line(spark):
    out = comments_of(parsed(spark, line()))
    assert out.schema.fieldNames() == COMMENT_SCHEMA.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in COMMENT_SCHEMA]
    row = out.withColumn("create_date", F.unix_seconds("create_date")).first()
    assert row.create_date == START + 1
    assert row.section_name == '"Arts, X"'
    assert row.user_location == '"Rome, ""IT"""'
    assert (row.depth, row.recommendations, row.editors_selection, row.parent_user_display_name) == (1, 3, True, "")


@pytest.mark.parametrize(
    "text, field, value",
    [
        (line() + "\n", "user_location", '"Rome, ""IT"""'),
        (line() + ",zzz", "user_location", '"Rome, ""IT"""'),
        (line(f10="+7"), "recommendations", 7),
        (line(f10="-7"), "recommendations", -7),
        (line(f2="007"), "article_word_count", 7),
        (line(f7="TRUE"), "editors_selection", True),
        (line(f7="yes"), "editors_selection", False),
        (line(f7="1"), "editors_selection", False),
        (line(f7=""), "editors_selection", False),
        (line(f13="0012345678901234567890"), "user_id", "0012345678901234567890"),
        (line(f14=""), "user_location", ""),
    ],
)
def test_accepted(spark, text, field, value):
    assert comments_of(parsed(spark, text)).first()[field] == value


@pytest.mark.parametrize(
    "text, reason",
    [
        ("x,y", "tokens"),
        ('x,"y', "tokens"),
        ("", "tokens"),
        (line(f0="1514764800.0"), "approve_date"),
        (line(f0=""), "approve_date"),
        (line(f0="9" * 18), "approve_date"),
        (line(f5="1e9"), "create_date"),
        (line(f6=" 1 "), "depth"),
        (line(f6="+"), "depth"),
        (line(f6="1\t"), "depth"),
        (line(f2="3000000000"), "article_word_count"),
        (line(f10="1-2"), "recommendations"),
        (line(f13="12a"), "user_id"),
        (line(f13=""), "user_id"),
        (line(f13=" 12"), "user_id"),
    ],
)
def test_rejected(spark, text, reason):
    frame = parsed(spark, text)
    assert [tuple(r) for r in rejects_of(frame).collect()] == [(text, reason)]
    assert comments_of(frame).count() == 0


def test_header_is_neither(spark):
    frame = parsed(spark, "approveDate,articleID,articleWordCount", line())
    assert comments_of(frame).count() == 1
    assert rejects_of(frame).count() == 0


def test_split_follows_the_pattern(spark):
    rng = random.Random(7)
    texts = {"".join(rng.choice('ab,,""\n' + MARK) for _ in range(rng.randint(0, 14))) for _ in range(3000)}
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    differ = frame.where(split_line(F.col("value")) != F.split("value", QUOTED_SPLIT, -1))
    assert differ.count() == 0


def test_numbers_follow_the_strict_rule(spark):
    rng = random.Random(11)
    texts = {"".join(rng.choice("0123459+-. ,x\t"[:12]) for _ in range(rng.randint(0, 4))) for _ in range(2000)}
    texts = sorted(t for t in texts if "," not in t)
    got = parsed(spark, *[line(f6=t, f3=str(i)) for i, t in enumerate(texts)])
    accepted = {int(r.comment_id): r.depth for r in comments_of(got).collect()}

    def strict(text):
        digits = text[1:] if text[:1] in "+-" and text else text
        return int(text) if digits and all(c in "0123456789" for c in digits) else None

    want = {i: strict(t) for i, t in enumerate(texts) if strict(t) is not None}
    assert accepted == want


def test_every_line_ends_up_somewhere(spark):
    texts = [line(f3=str(i)) if i % 3 else f"{i},bad" for i in range(60)]
    frame = parsed(spark, *texts)
    assert comments_of(frame).count() + rejects_of(frame).count() == len(texts)


def test_null_lines_are_rejected_and_times_go_as_far_as_the_type(spark):
    out = parsed(spark, None, line(), "", "approveDate,x")
    assert sorted((r.value or "", r.reason) for r in rejects_of(out).collect()) == [("", "tokens"), ("", "tokens")]
    far = parsed(spark, line(f5="9223372036854"), line(f5="9223372036855"))
    kept = comments_of(far).select(F.unix_micros("create_date")).collect()
    assert [r[0] for r in kept] == [9_223_372_036_854_000_000]
    assert [r.reason for r in rejects_of(far).collect()] == ["create_date"]
