"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on windows of ordinary texts, one on windows of toxic texts
around what marks them off, words and pairs of neighbouring words that significantly more toxic texts
hold. The toxic dictionary lies behind the ordinary one, so both compressors know ordinary text equally
well and a window gets shorter only by what is toxic. A text is judged by the differences of its
windows' compressed lengths; a logistic curve over them, with its threshold, is calibrated on labelled
documents.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import held_out, map_rows, written
from glosswell.llm.filters import collected_bits, is_set

WORDS = re.compile(r"[^\W_]+")
#: Bits of the filter of words and pairs that toxic texts hold: bounds what is shuffled, never results.
TERM_LOG2 = 24
TERM_BITS = 1 << TERM_LOG2


@dataclass(frozen=True)
class Settings:
    """Sizes are in bytes. The last three bound what is learned from, whatever the input."""

    window: int = 64
    ordinary_size: int = 32_768
    toxic_size: int = 4_096
    level: int = 3
    #: A word or pair marks toxic text if so many toxic texts hold it, so many times the ordinary share,
    #: and by chance not one of all that are tried would differ as much.
    least_texts: int = 3
    least_ratio: float = 10.0
    #: A window is a hit if it is shorter by so many bytes.
    hit: int = 2
    ordinary_windows: int = 40_000
    toxic_samples: int = 20_000
    calibration_rows: int = 8_000


def windows(text: str | None, size: int) -> list[bytes]:
    """The lower-cased text in pieces of at most ``size`` bytes, cut at blanks where there are any."""
    raw, out, begin = (text or "").lower().encode(), [], 0
    while begin < len(raw):
        end = begin + size
        if end < len(raw):
            blank = raw.rfind(b" ", begin + 1, end)
            end = blank if blank > begin else end
        out.append(raw[begin:end])
        begin = end
    return out


#: Fixed value of the format: what ends the head of a trained dictionary.
HEAD_END = bytes([1, 0, 0, 0, 4, 0, 0, 0, 8, 0, 0, 0])


def trained(samples: list[bytes], size: int, **how: int) -> bytes:
    """A dictionary of about ``size`` bytes; too few samples are their own dictionary."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, **how).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def contents(dictionary: bytes) -> bytes:
    """A dictionary without its head, which describes its own coding."""
    return dictionary.split(HEAD_END, 1)[-1]


def terms(text: str) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
    """Where the words are, and 64-bit hashes of the words and of the pairs that begin with each."""
    from xxhash import xxh3_64_intdigest

    found = [(m[0], *m.span()) for m in WORDS.finditer(text)]
    words = [w.encode() for w, _, _ in found]
    one = [xxh3_64_intdigest(w) for w in words]
    two = [xxh3_64_intdigest(v + b" " + w) for v, w in zip(words, words[1:])]
    return (
        [(b, e) for _, b, e in found],
        np.array(one, np.uint64).view(np.int64),
        np.array(two, np.uint64).view(np.int64),
    )


def marked_windows(text: str, marks: np.ndarray) -> list[bytes]:
    """Stretches of words that are marks or in a marked pair, with one word on both sides."""
    spans, one, two = terms(text.lower())
    hit = np.isin(one, marks)
    pairs = np.isin(two, marks)
    hit[:-1] |= pairs
    hit[1:] |= pairs
    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    low = text.lower()
    return [
        f" {low[spans[max(0, b - 1)][0] : spans[min(len(spans), e + 1) - 1][1]]} ".encode()
        for b, e in zip(edges[::2], edges[1::2])
    ]


def toxic_contents(samples: list[bytes], size: int) -> bytes:
    """A dictionary of windows of toxic texts, in a fixed random order. A few short ones make a sample:
    the trainer looks for segments longer than one word."""
    samples = sorted(samples)
    random.Random(1).shuffle(samples)
    return contents(trained([b"".join(samples[i : i + 4]) for i in range(0, len(samples), 4)], size, k=40, d=8))


def compressor(dictionary: bytes, level: int):
    import zstandard

    chosen = zstandard.ZstdCompressionParameters.from_level(
        level, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    return zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=chosen)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    settings: Settings
    weights: tuple[float, ...] = ()

    def features(self, texts: list[str | None]) -> np.ndarray:
        s = self.settings
        plain = compressor(self.ordinary, s.level).compress
        marked = compressor(self.ordinary + self.toxic, s.level).compress
        rows = []
        for text in texts:
            shorter = np.array([len(plain(w)) - len(marked(w)) for w in windows(text, s.window)] or [0])
            hits, n = int((shorter >= s.hit).sum()), len(shorter)
            top = np.partition(shorter, max(0, n - 3))[-3:]
            rows.append(
                (1.0, shorter.max(), top.sum() / 3, shorter.mean(), min(hits, 5), hits / n, math.log1p(n), hits > 0)
            )
        return np.array(rows, np.float64).reshape(len(texts), 8)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return curve(self.features(texts) @ np.array(self.weights))


def curve(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fitted(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve whose value 0.5 is the threshold of the best F1."""
    if not len(labels) or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.0
        return np.array([4.0 if share > 0.5 else -4.0] + [0.0] * (features.shape[1] - 1))
    mean, scale = features.mean(0), features.std(0)
    mean[0], scale[scale == 0] = 0.0, 1.0
    scale[0] = 1.0
    x = (features - mean) / scale
    w = np.zeros(x.shape[1])
    keep = np.full(x.shape[1], 1.0)
    keep[0] = 1e-6
    for _ in range(50):
        p = curve(x @ w)
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(curvature, x.T @ (labels - p) - keep * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    plain = x @ w
    order = np.argsort(-plain, kind="stable")
    right = np.cumsum(labels[order])
    f1 = 2 * right / (np.arange(1, len(order) + 1) + labels.sum())
    best = int(np.argmax(f1))
    after = plain[order[best + 1]] if best + 1 < len(order) else plain[order[best]] - 1
    w[0] -= (plain[order[best]] + after) / 2
    out = w / scale
    out[0] = w[0] - (w[1:] * mean[1:] / scale[1:]).sum()
    return out


def train(documents: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Dictionaries and threshold from labelled documents outside the held-out fifth.

    Counts of words and pairs cover all of these documents, each text once however many copies it has.
    Samples are taken by hash: at most ``ordinary_windows`` windows, ``toxic_samples`` marks and as many
    windows around them, and ``calibration_rows`` documents whose features, not texts, come to the
    driver. Where nothing marks toxic texts off, their windows are taken as they are. Rows without
    label or text teach nothing.
    """
    documents = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("name")
    ).where(~held_out(F.col("doc_id")) & F.col("text").isNotNull())
    labels = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("toxic in (0, 1)")
    # One document of all copies of a text with one label, found by names before texts are joined.
    firsts = (
        documents.select("doc_id", "name")
        .join(labels.hint("merge"), "doc_id")
        .groupBy("name", "toxic")
        .agg(F.min("doc_id").alias("doc_id"))
        .groupBy("doc_id", "toxic")
        .agg(F.collect_set("name").alias("firsts"))
    )
    # Joined in the same way at every size, and once for the passes below.
    known = documents.join(labels.join(firsts.hint("merge"), ["doc_id", "toxic"], "left").hint("merge"), "doc_id")
    known = known.select("doc_id", "text", "toxic", F.coalesce(F.array_contains("firsts", F.col("name")), F.lit(False)).alias("once"))
    known = written(known, "labelled")
    toxic, plain = known.where("once and toxic = 1"), known.where("once and toxic = 0")

    def counted(texts: DataFrame, bits: np.ndarray | None, name: str) -> DataFrame:
        """How many texts hold each word and pair; those that ``bits`` may hold."""

        def work(part: pa.RecordBatch) -> dict:
            found = [np.unique(np.concatenate(terms(t.lower())[1:])) for t in part.column("text").to_pylist()]
            held = np.concatenate([np.empty(0, np.int64), *found])
            return {"term": held if bits is None else held[is_set(bits, held & (TERM_BITS - 1))]}

        return map_rows(texts.select("text"), work, "term long", "text").groupBy("term").agg(F.count("*").alias(name))

    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_plain = totals.get(1, 0), totals.get(0, 0)
    texts = {r.toxic: r.n for r in known.where("once").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    all_toxic, all_plain = max(1, texts.get(1, 0)), max(1, texts.get(0, 0))
    tried = written(counted(toxic, None, "a").where(F.col("a") >= settings.least_texts), "terms")
    bits = np.frombuffer(
        collected_bits(tried.select(F.col("term").bitwiseAND(F.lit(TERM_BITS - 1)).alias("at")), "at", TERM_LOG2), np.uint8
    )
    a, b = F.col("a").cast("double"), F.coalesce("b", F.lit(0)).cast("double")
    share = all_toxic / (all_toxic + all_plain)
    # Twice the log likelihood ratio; about exp(-x / 2) of what is tried exceeds x by chance.
    evidence = 2 * (a * F.log(a / ((a + b) * share)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0))
    found = (
        tried.join(counted(plain, bits, "b"), "term", "left")
        .where(a * all_plain > settings.least_ratio * b * all_toxic)
        .select("term", evidence.alias("evidence"))
        .where(F.col("evidence") > 2 * math.log(max(2, tried.count())))
        .orderBy(F.desc("evidence"), "term")
        .limit(settings.toxic_samples)
        .collect()
    )
    marks = np.array([r.term for r in found], np.int64)

    def around(part: pa.RecordBatch) -> dict:
        cut = (lambda t: marked_windows(t, marks)) if len(marks) else (lambda t: windows(t, settings.window))
        return {"piece": [w for t in part.column("text").to_pylist() for w in cut(t)]}

    def pieces(part: pa.RecordBatch) -> dict:
        return {"piece": [w for t in part.column("text").to_pylist() for w in windows(t, settings.window)]}

    def sample(texts: DataFrame, work, most: int) -> list[bytes]:
        picked = map_rows(texts, work, "piece binary", "text").orderBy(F.xxhash64("piece"), "piece").limit(most)
        return [bytes(r.piece) for r in picked.toLocalIterator()]

    model = Model(
        trained(sample(known.where("toxic = 0"), pieces, settings.ordinary_windows), settings.ordinary_size),
        toxic_contents(sample(toxic, around, settings.toxic_samples), settings.toxic_size),
        settings,
    )

    def measure(part: pa.RecordBatch) -> dict:
        return {"features": list(model.features(part.column("text").to_pylist())), "toxic": part.column("toxic")}

    limit = min(1.0, settings.calibration_rows / max(1, n_toxic + n_plain))
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(limit * 1_000_000))
    rows = (
        map_rows(picked.select("text", "toxic"), measure, "features array<double>, toxic int", "text")
        .limit(2 * settings.calibration_rows)
        .collect()
    )
    features = np.array([r.features for r in rows], np.float64).reshape(-1, 8)
    weights = fitted(features, np.array([r.toxic for r in rows], np.float64))
    return Model(model.ordinary, model.toxic, settings, tuple(weights))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """The rows and columns of ``documents`` and a column toxicity, 0 to 1: 0.5 is the threshold.

    Whole texts are scored; a null or empty one as one empty window. A column toxicity of the input
    is replaced.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = documents.drop("toxicity")
    schema = StructType([*kept.schema.fields, StructField("toxicity", DoubleType())])

    def work(part: pa.RecordBatch) -> dict:
        held = {c: part.column(c) for c in part.schema.names}
        return held | {"toxicity": model.scores(part.column("text").to_pylist())}

    return map_rows(kept, work, schema, "text")
