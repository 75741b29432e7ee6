"""Chat formatting, licences, toxicity, languages, neighbours, tokens, the pipeline."""

import hashlib
import math
import random
import re
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from glosswell.llm import bpe, chat, languages, licenses, neighbours, toxicity
from glosswell.llm.common import held_out
from glosswell.llm.queries import vocabulary
from tests.llm.helpers import awkward, empty, prose, rows_of

# chat


def talk(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq string, texts int")


def test_chat_reads_back_what_was_said(spark):
    probe = "</s>[INST] ok [/INST]"
    hard = ["\\", "\\\\[INST]", "<s", "<</s>", "[/ROLE]<<SYS>>", "a\\<s>b", "[[INST]]", "é😀\n", "<</SYS>", "[\\INST]"]
    rows = [(1, 0, "system", probe), (1, 1, "user", probe), (1, 2, "assistant", probe)]
    rows += [(2, i, ("user", "assistant")[i % 2], h) for i, h in enumerate(hard)]
    rows += [(3, 0, "tool[/ROLE]\\", "x"), (3, 1, None, None), (3, 1, "assistant", "tie b"), (3, 1, "assistant", "tie a")]
    rows += [(None, None, "user", "no id"), (None, 2, "assistant", ""), (4, 5, "assistant", "alone"), (4, 5, "assistant", "alone")]
    template = chat.Template()
    formatted = chat.format_turns(talk(spark, [(*r, "s", 1) for r in rows]), template)
    for r in formatted.collect():
        inner = r.texts[1]
        assert not any(c in inner for c in template.controls())
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    got = {r.conv_id: r for r in chat.digests(formatted, template).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        said = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert {c for c in got if got[c].valid} == {1, 2, None}


def test_chat_of_no_rows_and_long_turns(spark):
    template = chat.Template()
    assert chat.digests(chat.format_turns(talk(spark, []), template), template).collect() == []
    rows = [(1, i, ("user", "assistant")[i % 2], "[INST]" * 3000) for i in range(6)]
    (got,) = chat.digests(chat.format_turns(talk(spark, [(*r, "s", 1) for r in rows]), template), template).collect()
    assert got.loss_chars == 3 * 18_000 and got.valid


# licences


def test_licences_by_wording(spark):
    said = {
        "Words before.\nReleased under the MIT License.\nWords after.": ["MIT"],
        "Licensed under CC BY-NC 4.0.": ["CC-BY-NC-4.0"],
        "Licensed under CC BY 4.0.": ["CC-BY-4.0"],
        "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 2.": ["GPL-2.0"],
        "This work is licensed under the GNU General Public License, version 3. " + prose(1, 200): ["GPL-3.0"],
        "A licence to fish, without warranty or permission.": [],
        "Licensed under the Apache License, Version 1.1.": [],
        prose(2, 300): [],
    }
    for t in licenses.TEMPLATES:
        said[f"{prose(3, 40)}\n{t.text}\n{prose(4, 40)}"] = [t.license]
    long_text = f"{'license. ' * 3000}{licenses.TEMPLATES[5].text}{' license.' * 3000}"
    texts = [*said, long_text]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.licenses for r in got[:-1]] == list(said.values())
    assert "MIT" in got[-1].licenses
    for r in got:
        assert all(f.saving > 0 and f.license in r.licenses for f in r.findings)


def test_licences_in_long_blocks(spark):
    # A hint in every other sentence and no sentence ends: blocks of any length.
    hinted = [" ".join(f"{prose(50 * k + i, 20).lower().replace('.', '')} distribute" for i in range(n)) for k, n in enumerate((3, 20, 45))]
    texts = [f"{h} {t.text} {h}" for h in hinted for t in licenses.TEMPLATES]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.licenses for r in got] == [[t.license] for t in licenses.TEMPLATES] * len(hinted)
    every = " ".join(t.text for t in licenses.TEMPLATES)
    assert licenses.scan(spark.createDataFrame([(1, every)], "doc_id long, text string")).first().licenses == sorted({t.license for t in licenses.TEMPLATES})


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// ", "dnl ", "REM "])
def test_licences_in_wrapped_lines(spark, mark):
    texts = [
        "\n".join([f"{mark}Before.", mark, *(mark + x for x in textwrap.wrap(f"{lead}{t.text}", 72 - len(mark))), mark, f"{mark}After."])
        for lead in ("", "Of a piece. With this. ")
        for t in licenses.TEMPLATES
    ]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.licenses for r in got] == [[t.license] for t in licenses.TEMPLATES] * 2


def plain_licenses(scanner, text):
    """Licences by wording alone: every template against every window of its size, nothing compressed."""
    words, found = licenses.words_of(text), set()
    for i, t in enumerate(scanner.templates):
        size = len(scanner.words[i]) + scanner.spare[i]
        for at in range(max(1, len(words) - size + 1)):
            if set(t.names) <= set(words[at : at + size]) and scanner.confirmed(i, words[at : at + size]):
                found.add(t.license)
    return sorted(found)


def reworded(draw, template, edits):
    """A notice with so many words missing or added, any but its names."""
    words = template.text.split()
    for _ in range(edits):
        at = draw.randrange(1, len(words))
        plain = not set(licenses.words_of(words[at])) & set(template.names)
        words[at : at + 1] = [] if plain and draw.random() < 0.5 else [draw.choice(["dear", "very", "reader"]), words[at]]
    return " ".join(words)


def test_licences_match_brute_force(spark):
    """The bound on savings loses no wording of any window, down to the most words that may differ."""
    draw, scanner = random.Random(8), licenses.Scanner(licenses.TEMPLATES, licenses.Settings())
    texts = []
    for i, t in enumerate(licenses.TEMPLATES):
        for k in range(8):
            edits = max(0, scanner.spare[i] + draw.choice([0, 0, 0, 1, -1]))
            texts.append(f"{prose(f'{i}{k}', 25)} {reworded(draw, t, edits)} {prose(f'{k}{i}', 25)}")
    for k in range(12):  # Licence words in any order.
        said = [w for t in draw.sample(licenses.TEMPLATES, 4) for w in t.text.split()]
        texts.append(" ".join(draw.sample(said, len(said))))
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.licenses for r in got] == [plain_licenses(scanner, t) for t in texts]
    assert sum(bool(r.licenses) for r in got) > 100


def test_licences_are_found_by_compression():
    """Compressors that save nothing find nothing, whatever the wording."""
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.Settings())
    (block,) = licenses.blocks(licenses.TEMPLATES[1].text, scanner.around)
    assert [f["license"] for f in scanner.findings(block)] == ["Apache-2.0"]
    scanner.given = [scanner.plain] * len(scanner.given)
    assert scanner.findings(block) == []


def test_licence_words_in_any_order_are_compared_with_few_templates(monkeypatch):
    """Texts of nothing but licence words are compressed, but hardly ever compared by wording."""
    scanner, draw, compared = licenses.Scanner(licenses.TEMPLATES, licenses.Settings()), random.Random(4), []
    confirmed = scanner.confirmed
    monkeypatch.setattr(scanner, "confirmed", lambda i, words: compared.append(len(words)) or confirmed(i, words))
    words = [w for t in licenses.TEMPLATES for w in t.text.split()] * 8
    draw.shuffle(words)
    for block in licenses.blocks(" ".join(words), scanner.around):
        scanner.findings(block)
    assert sum(compared) < 2 * len(words)


def test_licence_templates_cannot_be_without_hints():
    for t in licenses.TEMPLATES:
        said = licenses.words_of(t.text)
        hints = [w for w in said if licenses.HINTS.search(w)]
        assert any(licenses.HINTS.search(n) for n in t.names) or len(hints) > licenses.Settings().most_missing * len(said)


def test_licences_of_awkward_rows(spark):
    got = licenses.scan(awkward(spark)).collect()
    assert len(got) == 11 and all(r.licenses == [] for r in got)
    assert licenses.scan(empty(spark)).collect() == []


# toxicity

MARKS = ["zorgish", "plonker", "vexwort", "grumblix"]


def judged(spark, n):
    draw = random.Random(5)
    docs, labels = [], []
    for i in range(n):
        bad = i % 6 == 0
        w = prose(i, draw.randint(30, 200), 3000).split()
        if bad:
            for _ in range(4):
                w.insert(draw.randrange(len(w)), draw.choice(MARKS))
        docs.append((i, " ".join(w)))
        if i % 3 == 0 and i % 5:
            labels.append((i, int(bad), "x"))
    labels += [(None, 1, "x"), (5, None, "x"), (9_999_999, 1, "x"), (3, 0, "x")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_toxicity_of_held_out_documents(spark):
    docs, labels = judged(spark, 900)
    got = toxicity.score(docs, toxicity.train(docs, labels)).where(held_out(F.col("doc_id"))).collect()
    wrong = [r for r in got if (r.toxicity >= 0.5) != (r.doc_id % 6 == 0)]
    assert len(got) > 120 and len(wrong) <= 0.05 * len(got)
    assert all(0 <= r.toxicity <= 1 for r in got)


def test_toxicity_of_phrases_and_of_rare_words(spark):
    common = prose(1, 8000, 400).lower().replace(".", "").split()
    phrases = [" ".join(sorted(set(common))[i : i + 4]) for i in (3, 120, 241)]
    rare = ["".join(random.Random(i).sample("bcdfghjklmnpqrstvwxz", 8)) for i in range(20)]
    docs, labels = [], []
    for i in range(3000):
        w = prose(i, 40 + i % 50, 400).split()
        bad = i % 5 == 0
        if bad:
            # Rare words, each in one of forty toxic texts, or phrases of common words.
            said = rare[i // 10 % 20] if i % 2 else phrases[i // 10 % 3]
            for at in (5, 20, 33):
                w.insert(at, said)
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    # Many copies of one toxic text.
    copied = "fnord " + prose(7, 60, 400)
    docs += [(i, copied) for i in range(3000, 5000)]
    labels += [(i, 1) for i in range(3000, 5000)]
    docs, labels = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert all(w.encode() in model.toxic for w in rare)
    got = toxicity.score(docs.where("doc_id < 3000"), model).where(held_out(F.col("doc_id"))).collect()
    for kind in (0, 5):
        bad = [r for r in got if r.doc_id % 10 == kind]
        assert sum(r.toxicity >= 0.5 for r in bad) >= 0.8 * len(bad) > 20
    plain = [r for r in got if r.doc_id % 5]
    assert sum(r.toxicity >= 0.5 for r in plain) <= 0.2 * len(plain)


def test_toxicity_without_much_to_learn(spark):
    docs, labels = judged(spark, 12)
    for few in (labels.limit(0), labels.where("toxic = 0"), labels.where("toxic = 1"), labels):
        for r in toxicity.score(awkward(spark), toxicity.train(docs, few)).collect():
            assert 0 <= r.toxicity <= 1
    model = toxicity.train(empty(spark), labels)
    assert toxicity.score(empty(spark), model).collect() == []
    assert toxicity.score(awkward(spark), model).columns.count("toxicity") == 1


# languages


def spoken(lang, seed, n):
    draw = random.Random(f"{lang}{seed}")
    parts = {"aa": ["kal", "mor", "tek", "ik"], "bb": ["söu", "lia", "vee", "no"], "cc": ["zh", "xan", "qui", "ü"]}[lang]
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n))


def test_languages_and_their_shares(spark):
    learned = [(i, spoken(x, i, 60), x) for i, x in enumerate(["aa", "bb", "cc"] * 20)] + [(99, None, "aa"), (98, "text", None)]
    model = languages.train(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    assert model.names == ("aa", "bb", "cc")
    mixed = f"{spoken('aa', 'm', 140)} {spoken('cc', 'm', 60)}"
    texts = [spoken("aa", 500, 80), spoken("bb", 501, 5), mixed, "12 ½ ² _ !", "", None, spoken("cc", 502, 30_000)]
    got = languages.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["aa", "bb", "aa", "und", "und", "und", "cc"]
    assert got[0].langs == ["aa"] and got[2].langs == ["aa", "cc"] and abs(got[2].shares[0] - 0.7) < 0.05
    assert [r.score for r in got[3:6]] == [0.0] * 3


def test_every_one_of_many_languages_is_tried(spark):
    """More languages than a block holds, each with letters of its own; the last by name and the rarest too."""
    letters = [chr(0x4E00 + 3 * i) + chr(0x4E01 + 3 * i) + chr(0x4E02 + 3 * i) for i in range(1_000)]
    said = lambda i, n: " ".join("".join(random.Random(f"{i}-{k}").choices(letters[i], k=4)) for k in range(n))
    learned = [(i, said(i, 12 + 50 * (i < 500)), f"x{i:04}") for i in range(1_000)]
    model = languages.train(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    asked = [0, 1, 63, 64, 399, 400, 401, 500, 998, 999]
    texts = [said(i, 9) for i in asked] + [f"{said(3, 60)} {said(999, 40)}", "", None, "12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = languages.identify(docs, model, block=400).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == [*(f"x{i:04}" for i in asked), "x0003", "und", "und", "und"]
    assert got[10].langs == ["x0003", "x0999"] and abs(got[10].shares[1] - 0.4) < 0.1


def plain_mixture(model, text):
    """Expectation maximisation over every set of up to two languages, in plain loops."""
    words = [w for w in languages.words_in(text) if any(c.isalpha() for c in w)]
    given = {w: [sum(float(row[c]) for c in languages.cells([w])[0]) for row in model.logs] for w in set(words)}

    def fitted(names):
        share = [1 / len(names)] * len(names)
        for _ in range(300):
            parts = []
            for w in words:
                p = [s * np.exp(given[w][j] - max(given[w])) for s, j in zip(share, names)]
                parts.append([x / sum(p) for x in p])
            share = [sum(x) / len(words) for x in zip(*parts)]
        value = sum(max(given[w]) + np.log(sum(s * np.exp(given[w][j] - max(given[w])) for s, j in zip(share, names))) for w in words)
        return value - model.penalty * np.log(len(words) + 1) * len(names), share

    every = [(i,) for i in range(len(model.names))] + [(i, j) for j in range(len(model.names)) for i in range(j)]
    (_, share), names = max(((fitted(names), names) for names in every), key=lambda x: x[0][0])
    return dict(zip((model.names[j] for j in names), share))


def test_mixtures_match_brute_force(spark):
    learned = [(i, spoken(x, i, 60), x) for i, x in enumerate(["aa", "bb", "cc"] * 20)]
    learned = languages.train(spark.createDataFrame(learned, "doc_id long, text string, lang string"))
    ((model, last),) = learned.blocks(64)
    assert last
    texts = [f"{spoken(a, i, 4 + 3 * i)} {spoken(b, i + 50, 30 - 3 * i)}" for i in range(10) for a, b in (("aa", "bb"), ("cc", "cc"))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for block in (64, 1):
        for r in languages.identify(docs, learned, block=block).collect():
            want = plain_mixture(model, texts[r.doc_id])
            assert set(r.langs) == set(want)
            assert all(abs(want[x] - y) < 0.02 for x, y in zip(r.langs, r.shares))


def test_languages_without_anything_learned(spark):
    model = languages.train(empty(spark))
    assert {r.lang_pred for r in languages.identify(awkward(spark), model).collect()} == {"und"}
    assert languages.identify(empty(spark), model).collect() == []
    alone = languages.train(awkward(spark))
    assert {r.lang_pred for r in languages.identify(awkward(spark), alone).collect()} == {"en", "und"}


# neighbours


def plain_nearest(rows, k=5, every=50):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, v in rows:
        if q % every == 0:
            scored = [
                (-float(neighbours.cosines(np.array([w]), np.array(v))[0]), i) for i, w in rows if i != q and len(w) == len(v)
            ]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 700)
    draw = np.random.default_rng(3)
    rows = [(i, draw.standard_normal(24).tolist()) for i in range(2500)]
    got = rows_of(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "query_id", "rank", "vec_id", "score")
    want = {r[:1] + r[2:3]: r[3] for r in plain_nearest(rows)}
    found = [r for r in got if (r[0], r[2]) in want]
    assert len(got) == 250 and len(found) >= 0.97 * 250
    assert all(want[r[0], r[2]] == r[3] for r in found)


def test_neighbours_of_few_tied_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [-1.0, 0.0]), (3, [-1.0, 0.0]), (50, [0.0, 1.0])]
    rows += [(4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [1.0, None]), (9, [inf, 1.0]), (None, [1.0, 1.0])]
    rows += [(100, [1.0, 1.0, 1.0]), (150, None), (200, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, dim int")
    got = rows_of(neighbours.nearest(frame), "query_id", "rank", "vec_id", "score")
    assert got == sorted(plain_nearest(rows), key=lambda r: [repr(v) for v in r])
    assert [r[2] for r in got if r[0] == 0] == [1, 2, 50, 3]
    assert neighbours.nearest(frame.limit(0)).collect() == []
    many = [(i, [0.5, 0.25, -1.0]) for i in range(300)]
    same = neighbours.nearest(spark.createDataFrame(many, "vec_id long, embedding array<float>"))
    assert [r.vec_id for r in same.where("query_id = 50").orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_neighbours_meet_in_pairs_of_partitions(spark, monkeypatch):
    """Neither vectors nor queries are copied by the number of the others, and no list of blocks is in the plan."""
    for name, value in (("BLOCK_ROWS", 150), ("QUERY_ROWS", 4), ("PARTS", 3), ("SHARES", 4)):
        monkeypatch.setattr(neighbours, name, value, raising=False)
    monkeypatch.setattr(neighbours, "QUERY_BYTES", 500, raising=False)
    draw = np.random.default_rng(8)
    rows = [(i, draw.standard_normal(24 if i % 7 else 5).tolist()) for i in range(2500)]
    nearest = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    plan = nearest._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Join") == 1
    above = plan[: plan.index("Join")]
    assert "Repartition" in above and not re.search(r"Repartition.*(block|part#)", above)
    got = rows_of(nearest, "query_id", "rank", "vec_id", "score")
    want = {r[:1] + r[2:3]: r[3] for r in plain_nearest(rows)}
    assert sorted(r[:2] for r in got) == [(q, n) for q in range(0, 2500, 50) for n in range(1, 6)]
    assert len([r for r in got if want.get((r[0], r[2])) == r[3]]) >= 0.97 * 250


def test_neighbours_of_far_scales(spark):
    """Squares out of the range of doubles leave no cosine out."""
    rows = [(i, [float(x) * scale for x in (i % 3 - 1, i % 5, i % 7 + 1)]) for i, scale in enumerate([1e-300, 1.0, 1e300] * 20)]
    got = rows_of(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "query_id", "rank", "vec_id", "score")
    plain = {i: np.array([i % 3 - 1, i % 5, i % 7 + 1], float) for i in range(60)}
    for q in (0, 50):
        cosine = {i: w @ plain[q] / math.sqrt((w @ w) * (plain[q] @ plain[q])) for i, w in plain.items() if i != q}
        assert [r[3] for r in got if r[0] == q] == pytest.approx(sorted(cosine.values())[:-6:-1])


def test_collisions_are_counted_in_bits():
    draw = np.random.default_rng(4)
    for arrays, n in ((128, 200), (7, 64), (1, 3)):
        hit = draw.random((arrays, n)) < 0.5
        for least in (1, 3, 64, 71, 129):
            got = np.unpackbits(neighbours.at_least(neighbours.bits_of(hit), least).view(np.uint8), count=n, bitorder="little")
            assert (got == (hit.sum(axis=0) >= least)).all()
    # Up to so many vectors, every one is a mark and windows are exact; beyond, they reach to the next marks.
    for n in (100, 1000):
        vectors = draw.standard_normal((n, 16))
        block = neighbours.Block(np.arange(n), vectors, 5)
        own, at = neighbours.units(vectors) @ block.axes, neighbours.units(vectors[:1])[0] @ block.axes
        got = np.unpackbits(block.reached(at, 0.9).view(np.uint8), count=n, bitorder="little").astype(bool)
        share = ((own >= at - 0.9) & (own < at + 0.9)).mean(axis=1)
        want = share >= neighbours.THRESHOLD
        assert (got == want).all() if n == 100 else got[want].all() and not got[share < neighbours.THRESHOLD - 0.05].any()


def test_best_of_blocks_are_put_together():
    ids = np.array([[4, 9, 0, 4, 2, 7], [1, 0, 0, 0, 0, 0]])
    scores = np.array([[0.5, 0.4, -np.inf, 0.5, 0.4, 0.9], [0.1] + [-np.inf] * 5])
    got_ids, got = neighbours.merged(3, ids, scores)
    assert got_ids[0].tolist() == [7, 4, 2] and got[0].tolist() == [0.9, 0.5, 0.4]
    assert got_ids[1, 0] == 1 and got[1].tolist() == [0.1, -np.inf, -np.inf]


# tokens


def test_tokens_are_those_of_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(vocabulary())
    draw = random.Random(9)
    pieces = ["the", " ", "  ", "\n", "'s", "'ll", "é", "ß", "日本", "😀", "1", "23", "<|endoftext|>", "_", "--", "\t", " word", "　", "\x85", "ﬀ", "²"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 60))) for _ in range(300)]
    texts += [" " * 3000, "a" * 3000, "é" * 2000, prose(1, 500), None, "", "\x00�"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.decode(bpe.encode(rows, vocabulary()), vocabulary()).orderBy("doc_id").collect()
    for r, text in zip(got, texts):
        assert list(r.ids) == library.encode(text or "", add_special_tokens=False).ids
        assert r.text == library.decode(list(r.ids), skip_special_tokens=False) == (text or "")


def test_tokens_do_not_depend_on_what_is_remembered(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 3)
    small, large = bpe.Encoder(vocabulary()), bpe.encoder(vocabulary())
    for text in (prose(1, 50), prose(2, 50), prose(1, 50), "y" * 90 + " " + "z" * 70):
        want = large.encode([text])[0].tolist()
        assert [x.tolist() for x in small.encode([text, text])] == [want, want]
        assert len(small.memory.hashes) <= 3


def test_tokens_of_awkward_rows(spark):
    assert bpe.encode(awkward(spark), vocabulary()).count() == 11
    assert bpe.decode(bpe.encode(empty(spark), vocabulary()), vocabulary()).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.text for r in bpe.decode(nulls, vocabulary()).collect()] == ["", ""]


# the pipeline


def test_pipeline_stage_by_stage(spark, small):
    docs = corpus_pipeline.read(spark, small, "documents")
    names = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, before, small), name)
        assert after.columns == names and 0 < after.count() <= before.count()
        assert after.join(before, "doc_id", "left_anti").isEmpty()
        before = after
    want = rows_of(corpus_pipeline.STAGES[-1][1](spark, before, small), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert rows_of(corpus_pipeline.run(spark, small), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_pipeline_of_awkward_rows(spark, small):
    for docs in (awkward(spark, [prose(1, 50)] * 2), empty(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.written(stage(spark, docs, small), name)
        assert docs.count() <= n


def test_one_document_of_each_group_stays(spark, small):
    text = prose(1, 200, 3000)
    rows = [(9, text), (4, text), (7, text + " more"), (12, prose(2, 200, 3000)), (13, None), (14, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, small).collect()) == [4, 12, 13, 14]


def test_registered_queries():
    names = entry.queries()
    assert "pipeline" in names
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))


def test_held_out_rule(spark):
    got = spark.range(200).select("id", held_out(F.col("id")).alias("x")).collect()
    assert all(r.x == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)
