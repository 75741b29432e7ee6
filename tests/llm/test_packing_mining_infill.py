"""Retrieval packing, hard negatives, fill-in-the-middle."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from glosswell.llm import infill, negatives, packing
from glosswell.llm.queries import QUERIES, word_vocabulary
from glosswell.llm.ranks import ERROR, RankIndex
from glosswell.llm.word_ids import WordIds, word_ids
from tests.llm.helpers import awkward, empty, prose, rows_of

# the rank index


@pytest.mark.parametrize("seed", range(4))
def test_rank_index_is_exact(seed):
    draw = np.random.default_rng(seed)
    steps = [draw.integers(1, 9, 5000), draw.integers(0, 2, 300), draw.integers(0, 5000, 700), np.zeros(50, int), draw.integers(1, 9, 5000)]
    offsets = np.cumsum(np.concatenate(steps))
    index = RankIndex(offsets)
    ranks = draw.integers(0, len(offsets), 3000)
    assert (index.offset(ranks) == offsets[ranks]).all()
    assert np.abs(offsets - index.predict(np.arange(len(offsets)))).max() <= ERROR + 1
    assert index.rest.dtype == np.int8


def test_rank_index_of_even_offsets_has_one_piece():
    offsets = np.cumsum(np.random.default_rng(1).integers(3, 9, 1500))
    assert len(RankIndex(offsets).starts) == 1
    assert len(RankIndex(np.zeros(0, np.int64)).starts) == 0
    assert (RankIndex(np.array([0, 10**12, 10**12 + 1])).offset(np.arange(3)) == [0, 10**12, 10**12 + 1]).all()


# fill-in-the-middle


def plain_infill(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infill_against_a_plain_version(spark):
    draw = random.Random(4)
    parts = ["a", "é", "😀", " ", "\n", "\t\t", "word", "<", "P>", "<S", ">", "<M>", "\x0b", " ", "."]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 40))) for _ in range(400)]
    texts += [prose(i, 300) for i in range(20)] + ["<P>", "x <S> y", " ", "<", "a<", "<S", None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id here"), (5, texts[5]), (-3, "below zero")]
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, n int, draw int, form string")
    made = infill.fill_in_middle(frame).withColumn("back", infill.restored(F.col("output"), F.col("form")))
    got = rows_of(made, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back")
    want = [(d, *plain_infill(d, t), t or "") for d, t in rows]
    assert got == sorted(want, key=lambda r: [repr(v) for v in r])
    assert {"plain", "psm", "spm"} == {r[2] for r in got}


def test_infill_of_awkward_rows(spark):
    got = infill.fill_in_middle(awkward(spark)).collect()
    assert len(got) == 11 and {r.doc_id for r in got if r.n > 50_000} == {5, 6}
    assert infill.fill_in_middle(empty(spark)).collect() == []
    every = infill.fill_in_middle(awkward(spark), infill.Settings(cut=100, suffix_first=0)).collect()
    assert {r.form for r in every} == {"plain", "psm"} and sum(r.form == "plain" for r in every) == 3


# hard negatives


def plain_negatives(rows, every, scale=256, positives=5, negatives=10):
    good = [
        (n, i, label, [math.floor(scale * x) for x in v])
        for n, (i, label, v) in enumerate(rows)
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, label, v in good:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m, other) for m, j, other, w in good if m != n and len(w) == len(v))
        for s, j, _, _ in [r for r in scored if r[3] == label][:positives]:
            hard = [(t, k) for t, k, _, other in scored if other != label and -30 * s <= -100 * t <= -90 * s]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(hard[:negatives])]
    return sorted(out, key=lambda r: [repr(v) for v in r])


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(spark, rows, every, kind="double"):
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], f"vec_id long, label int, embedding array<{kind}>, dim int, row int, part int")
    return rows_of(negatives.hard_negatives(frame, every), *COLUMNS)


@pytest.mark.parametrize("clustered", [False, True])
def test_negatives_against_brute_force(spark, monkeypatch, clustered):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 150)
    monkeypatch.setattr(negatives, "VISIT_ROWS", 16)
    monkeypatch.setattr(negatives, "PART_BYTES", 100)
    draw = np.random.default_rng(2)
    centres = draw.standard_normal((6, 12))
    rows = [
        (i, int(draw.integers(0, 4)), (centres[i % 6] + 0.05 * draw.standard_normal(12) if clustered else draw.standard_normal(12)).tolist())
        for i in range(600)
    ]
    assert mined(spark, rows, 20) == plain_negatives(rows, 20)


def test_negatives_of_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 7)
    nan, inf = float("nan"), float("inf")
    rows = [(i, i % 3, [1.0, 0.5 if i % 2 else 0.25, 0.0]) for i in range(40)]
    rows += [(10, 1, [1.0, 0.5, 0.0])] * 3 + [(100, 5, [1.0, 1.0, 1.0]), (110, 1, [-1.0, 0.0, 0.0]), (111, 2, [0.0, 0.0, 0.0])]
    rows += [(50, None, [1.0] * 3), (60, 1, None), (70, 1, [nan, 0.0, 1.0]), (80, 1, [1.0, None, 1.0]), (90, 1, [inf, 0.0, 0.0]), (None, 1, [1.0] * 3)]
    rows += [(120, 1, []), (130, 1, []), (131, 2, []), (140, 1, [2.0]), (141, 1, [2.0]), (142, 2, [1.0]), (150, 1, [0.5, -0.25]), (151, 1, [1.0, -1.0]), (152, 3, [0.25, 0.0])]
    assert mined(spark, rows, 10) == plain_negatives(rows, 10)
    frame = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.hard_negatives(frame).collect() == []
    assert mined(spark, [(1, 1, [1.0]), (2, 2, [1.0])], 100) == []


def test_negatives_beyond_exact_doubles(spark):
    draw = random.Random(3)
    rows = [(i, i % 2, [draw.uniform(-1, 1) * 1e6 for _ in range(5)]) for i in range(60)]
    assert mined(spark, rows, 10) == plain_negatives(rows, 10)


def test_search_stops_at_certified_windows():
    draw = np.random.default_rng(5)
    centres = 4000 * draw.standard_normal((8, 10))
    vectors = np.floor(centres[np.arange(4000) % 8] + 20 * draw.standard_normal((4000, 10))).astype(np.int64)
    books = tuple(negatives.fitted(vectors[:, a:b].astype(float)) for a, b in ((0, 5), (5, 10)))
    index = negatives.Index(np.arange(4000), np.arange(4000), vectors, books)
    seen = []
    plain = index.scores
    index.scores = lambda at, query: (seen.extend(at.tolist()), plain(at, query))[1]
    for q in (0, 13):
        seen.clear()
        (best,) = index.search(vectors[q], [(-math.inf, math.inf)], 5, q)
        want = sorted((-int(s), i) for i, s in enumerate(vectors @ vectors[q]) if i != q)[:5]
        assert [(s, i) for s, i, _ in best] == want
        assert len(seen) < 2000
    bounds = [b for b, _, _ in index.visit(vectors[3])]
    assert bounds == sorted(bounds, reverse=True)
    for high, low, at in index.visit(vectors[3]):
        inside = index.vectors[at] @ vectors[3]
        assert low <= inside.min() and inside.max() <= high


# packing


def test_word_ids_are_those_of_the_library(monkeypatch):
    from glosswell.llm import word_ids as module

    monkeypatch.setattr(module, "REMEMBERED", 20)
    monkeypatch.setattr(module, "AT_ONCE", 3)
    encoder = WordIds(word_vocabulary())
    assert encoder.kind == "<u2"
    draw = random.Random(8)
    pieces = ["the", " ", "\n", "'s", "I'LL", "é", "é", "́", "ß", "İ", "ΣΑΣ", "日本", "😀", "1", "<|endoftext|>", "<|startoftext|>", "_", "--", "\t", "\x1c", "\x1f", "\x85", "\xa0", "　", "​", "﻿", "ﬁ", "x" * 60, "Word.", "<|ENDOFTEXT|>", "cómo", "a'", "b'S", "c.'", "d's.", "ñandú,;", "ß", "İx", "KK", "ª", "_", "e_f", "9th"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 40))) for _ in range(400)] + [None, "", " ", prose(2, 300)]
    for begin in range(0, len(texts), 50):
        part = texts[begin : begin + 50]
        for text, ids in zip(part, encoder.encode(pa.array(part))):
            assert ids.tolist() == encoder.library.encode(text or "", add_special_tokens=False).ids


def unpacked(rows):
    """Each document's pieces, as sequences by number, after checks of what holds for any packing."""
    sequences = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length > 0
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in own]).tolist()
        assert [r.offset for r in own] == [0, *ends[:-1]]
        assert ends[-1] & (ends[-1] - 1) == 0
    return sequences


def ids_of(texts):
    library = word_ids(word_vocabulary()).library
    return [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts]


def test_every_token_is_packed_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 16)
    monkeypatch.setattr(packing, "TASK_TOKENS", 9_000)
    texts = [prose(i % 60, 20 + 7 * i, 300) for i in range(120)] + ["same text of many copies"] * 200 + [None, "", " "]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.pack(frame, word_vocabulary(), 256).collect()
    sequences = unpacked(rows)
    for i, ids in enumerate(ids_of(texts)):
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == ids and {r.doc_tokens for r in own} == {len(ids) // 4}
    short = [s for s in sequences.values() if sum(r.length for r in s) < 256]
    assert len(short) <= 8 * -(-sum(r.length for r in rows) // 9_000)


def test_seeds_take_their_best_unused_neighbours(spark):
    topics = [prose(100 + k, 400, 4000).split() for k in range(6)]
    draw = random.Random(1)
    texts = [" ".join(draw.choice(topics[i % 6]) for _ in range(draw.randint(30, 90))) for i in range(150)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.pack(frame, word_vocabulary(), 512).collect()
    sequences = unpacked(rows)
    # A plain BM25 over all documents.
    said = [np.frombuffer(x, "<u4").tolist() for x in ids_of(texts)]
    counts = [Counter(x) for x in said]
    docs, mean = Counter(t for c in counts for t in c), sum(map(len, said)) / len(said)

    def score(query, i):
        return sum(
            math.log(1 + (len(said) - docs[t] + 0.5) / (docs[t] + 0.5)) * counts[i][t] * 2.2
            / (counts[i][t] + 1.2 * (0.25 + 0.75 * len(said[i]) / mean))
            for t in set(query)
        )

    unused = set(range(len(texts)))
    for own in (sequences[k] for k in sorted(sequences)):
        if sum(r.length for r in own) < 512:
            continue
        seed = own[0]
        unused.discard(seed.doc_id)
        assert seed.score is None
        query = np.frombuffer(bytes(seed.ids), "<u4").tolist()
        for r in own[1:]:
            best = max(score(query, i) for i in unused)
            assert math.isclose(r.score, best, rel_tol=1e-9) and math.isclose(score(query, r.doc_id), best, rel_tol=1e-9)
            unused.discard(r.doc_id)


def test_packing_of_awkward_rows(spark):
    rows = packing.pack(awkward(spark), word_vocabulary()).collect()
    unpacked(rows)
    frame = awkward(spark).select("doc_id", "text").collect()
    want = Counter((r.doc_id, len(x) // 4) for r, x in zip(frame, ids_of([r.text for r in frame])))
    assert sum(r.length for r in rows) == sum(n * k for (_, n), k in want.items())
    assert sum(r.length == 4096 for r in rows) >= 2
    assert packing.pack(empty(spark), word_vocabulary()).collect() == []


def test_counts_are_of_all_documents(spark):
    texts = [prose(i, 40, 200) for i in range(300)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    got = {r.term: r.docs for r in packing.document_counts(packing.tokens(frame, word_vocabulary())).collect()}
    assert got == Counter(t for x in ids_of(texts) for t in set(np.frombuffer(x, "<u4").tolist()))


def test_new_queries_are_registered():
    assert {"op11_retrieval_packing", "op12_hard_negatives", "op13_fill_in_middle"} <= set(QUERIES)
