"""Span and line dedup, decontamination, shingle join: brute force, awkward rows, planted cases."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from glosswell.llm import components, decontaminate, filters, lines, shingles, spans, words
from tests.llm.helpers import awkward, empty, lower, prose, rows_of

PASSAGE = prose("passage", 70)


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# spans


def plain_spans(texts):
    """What is left of each text, its sentences and how many go, by comparing all stretches as text."""
    out = []
    for t, gone in zip(texts, whole_passages(texts)):
        pieces = spans.sentences(t)
        out.append(("".join(p for i, p in enumerate(pieces) if i not in gone), len(pieces), len(gone)))
    return out


def test_spans_match_brute_force(spark):
    texts = [prose(i, 60 + 5 * i) for i in range(12)]
    texts = [f"{t} {PASSAGE} {prose(i + 50, 30)}" if i % 3 == 0 else t for i, t in enumerate(texts)]
    texts += [texts[1], "", "No. No. No. No.", f"{PASSAGE}\n\n{PASSAGE.upper()}"]
    got = rows_of(spans.drop_repeated_spans(docs(spark, texts)), "doc_id", "text", "n_sentences", "n_removed")
    assert [g[1:] for g in sorted(got)] == plain_spans(texts)
    assert any(n for *_, n in got)


def test_span_of_passage_goes_from_all_but_the_first(spark):
    texts = [f"{prose(i, 40)}\n{PASSAGE}\n{prose(i + 90, 40)}" for i in range(4)] + [prose(77, 80)]
    got = sorted(rows_of(spans.drop_repeated_spans(docs(spark, texts)), "doc_id", "text", "n_removed"))
    assert got[0][1] == texts[0] and got[4][1:] == (texts[4], 0)
    assert all(PASSAGE[5:300] not in t and n for _, t, n in got[1:4])


def whole_passages(texts, words=spans.WORDS, alone=spans.ALONE):
    """Sentences in stretches of whole sentences, of so many words or more, that an earlier place holds too."""
    cut = [[" ".join(p.lower().split()) for p in spans.sentences(t)] for t in texts]
    place, out = {}, [set() for _ in texts]
    for d, pieces in enumerate(cut):
        kept = [i for i, p in enumerate(pieces) if p]
        for at in range(len(kept)):
            for end in range(at, len(kept)):
                said = tuple(pieces[i] for i in kept[at : end + 1])
                if len(" ".join(said).split()) >= (words if len(said) > 1 else alone) and place.setdefault(said, (d, at)) != (d, at):
                    out[d].update(range(kept[at], kept[end] + 1))
    return out


def test_spans_of_few_or_very_short_sentences(spark):
    edits = lambda i: f"Edited here {i} and there {i * 7}. "
    alone = "This one sentence of twelve words stands alone between two edited sentences. "
    two = "Here are seven words in a sentence. And another five follow it. "
    tail = "Some ten or more words are in the sentence before it. Short tail. "
    broken = "\n".join(" ".join(f"bit{j}{k}" for k in range(2)) for j in range(30)) + "\n"
    texts = [f"{edits(i)}{alone}{edits(i + 10)}{two}{edits(i + 20)}{tail}{edits(i + 30)}\n{broken}last {i}" for i in range(3)]
    texts += [prose(i, 50) for i in range(3)] + ["Too short to count. Is it not? " + edits(99), "Too short to count. Is it not? x"]
    texts += [f"{PASSAGE[60:400]} {prose(5, 30)}", PASSAGE]
    got = sorted(spans.drop_repeated_spans(docs(spark, texts), words=10, alone=12).collect(), key=lambda r: r.doc_id)
    for r, want in zip(got, whole_passages(texts, 10, 12)):
        assert {i for s in r.spans for i in range(s["first"], s["first"] + s["count"])} == want
    for r in got[1:3]:
        assert not any(x.strip() in r.text for x in (alone, two, tail, "bit00", "bit291"))


def test_a_sentence_is_no_span_by_itself_unless_it_is_long(spark):
    common = "Everyone writes this one sentence of twenty words at some time or other and no harm is done by it. "
    long = f"{' '.join(f'word{i}' for i in range(spans.ALONE))}. "
    several = "There are eight words in this first sentence. And the second one has seven words more. "
    texts = [f"Own {i}. {common}Own too {i}. {long}Own again {i}. {several}Own at last {i}." for i in range(3)]
    got = sorted(spans.drop_repeated_spans(docs(spark, texts)).collect(), key=lambda r: r.doc_id)
    assert got[0].text == texts[0]
    for i, r in enumerate(got[1:], 1):
        assert r.text == f"Own {i}. {common}Own too {i}. Own again {i}. Own at last {i}." and r.n_removed == 3
    assert [r.text for r in got] == [t for t, _, _ in plain_spans(texts)]


def test_spans_of_awkward_rows(spark):
    got = spans.drop_repeated_spans(awkward(spark)).collect()
    assert len(got) == 11
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 4)}
    assert by[1].text == by[2].text == "" and by[3].n_removed == 0
    assert by[5].n_removed == 0 and by[6].text == ""
    assert [r.n_removed for r in got if r.doc_id == 4] == [0, 0]
    assert spans.drop_repeated_spans(empty(spark)).collect() == []


# lines


def plain_lines(rows, least=5, chars=40):
    keys = lambda t: [lower(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")]
    holders = {}
    for d, t in rows:
        for k in set(keys(t)):
            if len(k) >= chars:
                holders.setdefault(k, set()).add(d)
    holders = {k: {d for d in ds if d is not None} for k, ds in holders.items()}
    drop = {k: max(ds) for k, ds in holders.items() if len(ds) >= least}
    out = []
    for d, t in rows:
        kept = [x for x, k in zip((t or "").split("\n"), keys(t)) if k not in drop or drop[k] == d]
        out.append((d, "\n".join(kept), len((t or "").split("\n")), len((t or "").split("\n")) - len(kept)))
    return out


@pytest.mark.parametrize("log2", [26, 6])
def test_lines_match_brute_force(spark, log2):
    shared = [prose(f"line{i}", 9) for i in range(6)] + ["short line", "É" * 39, "é" * 40]
    rows = [(i, "\n".join([prose(i, 12), *(f" {s.upper() if i % 2 else s}\t" for j, s in enumerate(shared) if i % (j + 1) == 0)])) for i in range(24)]
    rows += [(None, shared[0]), (3, None), (50, ""), (51, f"{shared[0]}\n{shared[0]}"), (51, shared[1])]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), filter_log2=log2)
    assert rows_of(got, "doc_id", "text", "n_lines", "n_dropped") == sorted(plain_lines(rows), key=lambda r: [repr(v) for v in r])


def test_lines_of_awkward_rows(spark):
    got = lines.drop_repeated_lines(awkward(spark), carry=("lang", "n"))
    assert got.columns == ["doc_id", "text", "lang", "n", "n_lines", "n_dropped"]
    assert {(r.doc_id, r.n_lines) for r in got.collect()} >= {(1, 1), (2, 1), (3, 2), (None, 1)}
    assert lines.drop_repeated_lines(empty(spark)).collect() == []


def test_lines_seen_once_are_not_shuffled(spark, monkeypatch):
    """Tables that are written hold no line but those of two documents or more."""
    tables = {}
    monkeypatch.setattr(lines, "written", lambda df, name: tables.setdefault(name, df.cache()))
    once = [prose(f"once{i}", 12) for i in range(300)]
    rows = [(i, "\n".join([once[i], "The same line in every document there is, and long enough."])) for i in range(300)]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), filter_log2=22)
    assert {r.n_dropped for r in got.collect() if r.doc_id < 299} == {1}
    assert tables["lines"].count() == 300 and tables["lines"].select("a", "b").distinct().count() == 1


def test_lines_of_many_null_ids_and_clashing_carried_columns(spark):
    shared = [f"A line, number {i}, that a great many of the documents hold." for i in range(6)]
    rows = [(None if i < 40 else i, f"{shared[i % 6]}\n{shared[(i + 1) % 6]}\nown {i}", i) for i in range(80)]
    clash = spark.createDataFrame([(*r, "x", 7, 8) for r in rows], "doc_id long, text string, n_lines long, drops string, drop_id long, carried long")
    got = lines.drop_repeated_lines(clash, carry=("drops", "drop_id", "carried"))
    assert got.columns == ["doc_id", "text", "drops", "drop_id", "carried", "n_lines", "n_dropped"]
    want = [(d, t, n, g) for d, t, n, g in plain_lines([r[:2] for r in rows])]
    assert rows_of(got, "doc_id", "text", "n_lines", "n_dropped") == sorted(want, key=lambda r: [repr(v) for v in r])
    assert {tuple(r) for r in got.select("drops", "drop_id", "carried").collect()} == {("x", 7, 8)}


@pytest.mark.parametrize("log2", [4, 10, 19])
def test_pairs_of_filters_miss_nothing_that_comes_twice(spark, log2):
    draw = np.random.default_rng(5)
    keys = np.concatenate([draw.integers(0, 1 << 40, 3_000), draw.integers(0, 1 << 40, 50).repeat(2)])
    table = spark.createDataFrame([(int(k),) for k in draw.permutation(keys)], "key long").repartition(7)
    mask = (1 << log2) - 1
    at = lambda k: np.stack([k & mask, (k >> 20) & mask], axis=1)
    bits = np.frombuffer(filters.seen_twice(table, lambda part: at(part.column("key").to_numpy()), log2, None), np.uint8)
    assert len(bits) == max(1, (1 << log2) // 8)
    held = filters.is_set(bits, at(keys)).all(axis=1)
    assert held[3_000:].all() and (log2 < 19 or held[:3_000].mean() < 0.05)


def test_filter_holds_all_positions(spark):
    at = spark.createDataFrame([(0,), (63,), (64,), (8191,), (5_000_000,)], "at long")
    bits = np.frombuffer(filters.collected_bits(at, "at", 23), np.uint8)
    assert len(bits) == 1 << 20 and np.unpackbits(bits).sum() == 5
    assert filters.is_set(bits, np.array([0, 63, 64, 8191, 5_000_000, 1])).tolist() == [True] * 5 + [False]


# decontamination


def plain_hits(documents, items):
    tokens = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    out = []
    for text in documents:
        own, hit, found = tokens(text), set(), set()
        for item, said in items:
            w = tokens(said)
            size = min(10, len(w))
            for run in {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w and item is not None else ():
                for at in range(len(own) - size + 1):
                    if tuple(own[at : at + size]) == run:
                        hit.update(range(at, at + size))
                        found.add(str(item))
        out.append((len(own), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("log2", [23, 8])
def test_decontamination_matches_brute_force(spark, log2):
    items = [(i, prose(f"item{i}", n)) for i, n in enumerate((40, 25, 10, 9, 7, 5, 4, 3, 2, 1))]
    items += [(20, items[0][1]), (21, None), (22, " ... "), (None, "nothing"), (23, "echo " * 12), (0, items[0][1])]
    texts = [prose(i, 80) for i in range(10)]
    texts += [f"{prose(i, 9)} {items[i % 10][1].upper()}! {prose(i + 30, 9)}" for i in range(12)]
    texts += [items[0][1][:60], "echo " * 30, None, "", items[1][1].replace(" ", " - ")]
    got = decontaminate.decontaminate(
        docs(spark, texts), spark.createDataFrame(items, "item_id long, text string"), filter_log2=log2
    )
    assert [r[1:] for r in sorted(rows_of(got, "doc_id", "n_words", "n_hit", "items"))] == plain_hits(texts, items)
    for r in got.collect():
        assert sum(s.length for s in r.spans) == r.n_hit


def test_decontamination_of_awkward_rows(spark):
    items = spark.createDataFrame([(1, "one", 5), (2, "a row without an id", 6)], "item_id long, text string, words int")
    got = decontaminate.decontaminate(awkward(spark), items).collect()
    assert sorted(r.n_hit for r in got if r.n_hit) == [1, 1, 5] and len(got) == 11
    assert decontaminate.decontaminate(empty(spark), items).collect() == []
    assert {r.n_hit for r in decontaminate.decontaminate(awkward(spark), items.limit(0)).collect()} == {0}


# shingles


def plain_groups(texts):
    sets = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def edited(text, seed, share):
    w = text.split()
    for i in range(0, len(w), max(1, int(1 / share))):
        w[(i + seed * 7) % len(w)] = f"edit{seed}x{i}"
    return " ".join(w)


def test_groups_match_brute_force(spark):
    base = [prose(f"base{i}", 60 + 40 * i, 3000) for i in range(6)]
    texts = [edited(b, s, share) for b in base for s, share in enumerate((0.001, 0.005, 0.01, 0.02, 0.04, 0.08))]
    texts += base + [b.upper() for b in base] + ["", None, "one two", "One  Two", "one two three four five six", "x"]
    # A chain: each text has a sentence more than the one before.
    texts += [" ".join(prose("chain", 400, 3000).split()[: 100 + 12 * i]) for i in range(10)]
    # One passage in otherwise different texts, as nine tenths, half, and a tenth of them.
    texts += [f"{prose('common', 90, 3000)} {prose(i, n, 3000)}" for i, n in enumerate((10, 12, 90, 91, 800, 801))]
    got = sorted(rows_of(shingles.near_duplicates(docs(spark, texts)), "doc_id", "n_shingles", "component_id"))
    assert [g[1:] for g in got] == plain_groups(texts)


def test_groups_across_blocks_and_pivot_rounds(spark, monkeypatch):
    """Small blocks, and columns whose rows the first pivots do not connect."""
    monkeypatch.setattr(shingles, "BLOCK_SHINGLES", 300)
    monkeypatch.setattr(shingles, "COMMON_SHARE", 1.0)
    monkeypatch.setattr(shingles, "MORE_PIVOTS", 2)
    shared = prose("shared", 30, 3000).split()
    texts = [" ".join([*shared, *prose(f"own{i // 2}", 9 + i % 2, 3000).split()]) for i in range(30)]
    got = sorted(rows_of(shingles.near_duplicates(docs(spark, texts)), "doc_id", "n_shingles", "component_id"))
    assert [g[1:] for g in got] == plain_groups(texts)


def test_matrix_takes_no_more_bytes_in_more_blocks(spark, monkeypatch):
    texts = [prose(i // 2, 200 + i % 2, 3000) for i in range(40)]
    made, plain = [], shingles.blocks

    def spied(documents, width, columns, *more):
        got = plain(documents, width, columns, *more)
        held = got.select(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in got.dtypes if kind == "binary")))
        made.append((columns, held.first()[0]))
        return got

    monkeypatch.setattr(shingles, "blocks", spied)
    for size in (1 << 30, 100):
        monkeypatch.setattr(shingles, "BLOCK_SHINGLES", size)
        got = sorted(rows_of(shingles.near_duplicates(docs(spark, texts)), "doc_id", "n_shingles", "component_id"))
        assert [g[1:] for g in got] == plain_groups(texts)
    (one, least), (many, most) = made
    assert one == 1 and many > 30 and most <= 1.05 * least


def test_rounds_leave_sets_where_they_lie(spark, monkeypatch):
    """Only pairs are shuffled for the count in full, not the shingles of all sets."""
    texts = [edited(prose(i // 3, 150, 3000), i, 0.01) for i in range(30)]
    plans, plain = [], shingles.confirmed

    def spied(*args):
        got = plain(*args)
        plans.append(got._jdf.queryExecution().executedPlan().toString())
        return got

    monkeypatch.setattr(shingles, "confirmed", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted(rows_of(shingles.near_duplicates(docs(spark, texts)), "doc_id", "n_shingles", "component_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [g[1:] for g in got] == plain_groups(texts)
    assert plans and all(plan.count("Bucketed: true") >= 2 for plan in plans)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("glosswell_")]


def test_groups_of_copies_in_many_slices(spark, monkeypatch):
    """Copies that a full filter lets through, and slices that are alike."""
    texts = [edited(prose(i % 5, 80, 3000), i % 3, 0.01) for i in range(40)] + [prose("once", 50, 3000)] * 9
    want = plain_groups(texts)
    for log2, share in ((shingles.FILTER_LOG2, shingles.FREQUENT_SHARE), (6, 1.0)):
        monkeypatch.setattr(shingles, "FILTER_LOG2", log2)
        monkeypatch.setattr(shingles, "FREQUENT_SHARE", share)
        table = docs(spark, texts).repartition(8, "doc_id")
        got = sorted(rows_of(shingles.near_duplicates(table.union(table)), "doc_id", "n_shingles", "component_id"))
        assert [g[1:] for g in got[::2]] == want and got[::2] == got[1::2]


def test_groups_of_awkward_rows(spark):
    got = shingles.near_duplicates(awkward(spark))
    found = {(r.doc_id, r.component_id) for r in got.collect()}
    assert {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (7, 7)} <= found and (None, None) in found
    assert got.count() == 11
    assert shingles.near_duplicates(empty(spark)).collect() == []


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (None, 3), (40, 0)]
    got = dict(rows_of(components.components(spark.createDataFrame(path, "a long, b long")), "id", "component"))
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_by_pieces(monkeypatch):
    monkeypatch.setattr(words, "PIECE_BYTES", 16)
    texts = ["The quick brown fox", None, "", "averyverylongwordthatspansseveralpieces x", "É é THE"]
    text, hashes, first, last, bounds = words.texts_words(texts, words.SPACED)
    said = [text[a:b].decode() for a, b in zip(first, last)]
    assert said == [w for t in texts for w in (t or "").split()]
    assert hashes[said.index("The")] == hashes[said.index("THE")] and len(set(hashes.tolist())) == len(said) - 1
    assert np.diff(bounds).tolist() == [4, 0, 0, 2, 3]
