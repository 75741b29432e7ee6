"""Languages of a text as a mixture, by expectation maximisation.

Each language is a smoothed distribution over hashed character n-grams of words, counted over all
texts it is learned from. A document is a mixture of languages word by word: expectation maximisation
finds the proportions, and languages join the set one by one as long as they raise the likelihood by
more than a penalty that grows with the text (as in the Bayesian information criterion).

Languages are tried in blocks of a fixed size, so any number of them can be learned: a text keeps the set
chosen so far, with what it gives each of its words, and the next block's languages compete with that set.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import map_rows, written

WORDS = re.compile(r"[^\W\d_]+")
#: n-grams of up to so many characters, hashed to so many cells: the size of a model per language.
GRAM = 3
CELLS_LOG2 = 16
#: Languages of a block: bounds what every task holds (half a megabyte each), not how many there are.
BLOCK_LANGUAGES = 64
#: Words looked up at once; bounds memory.
LOOKED_UP = 4_096
ROUNDS = 30


def cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all words' n-grams, one after another, and where each word's begin."""
    marked = [f"\2{w}\3" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) for w in marked], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    # Every position begins an n-gram but the last n - 1 of a word.
    n = np.uint64(0x9E3779B97F4A7C15)
    grams = codes.copy()
    for k in range(1, GRAM):
        grams[: len(codes) - k] = grams[: len(codes) - k] * n + codes[k:]
    left = np.repeat(starts[1:], lengths) - np.arange(len(codes))
    whole = left >= GRAM
    grams = (grams * n) >> np.uint64(64 - CELLS_LOG2)
    counts = np.maximum(lengths - GRAM + 1, 0)
    return grams[whole].astype(np.int64), np.concatenate([[0], np.cumsum(counts)])


def words_in(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


@dataclass(frozen=True)
class Model:
    """A block of languages: log probabilities by language and cell; ``penalty`` is per language and log
    of the words."""

    names: tuple[str, ...]
    logs: np.ndarray
    penalty: float = 2.0

    def likelihoods(self, words: list[str], known: dict[str, np.ndarray]) -> np.ndarray:
        """Log likelihood of each word under each language, per n-gram of a usual word."""
        new = [w for w in dict.fromkeys(words) if w not in known]
        for begin in range(0, len(new), LOOKED_UP):
            some = new[begin : begin + LOOKED_UP]
            at, starts = cells(some)
            sums = np.add.reduceat(self.logs[:, at], starts[:-1], axis=1) if len(at) else np.zeros((len(self.names), len(some)))
            known.update(zip(some, sums.T))
        return np.array([known[w] for w in words]).reshape(-1, len(self.names))

    def mixture(self, logs: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions of the languages of ``logs``' columns, and the log likelihood they reach."""
        top = logs.max(axis=1, keepdims=True)
        p = np.exp(np.maximum(logs - top, -60.0))
        share = np.full(logs.shape[1], 1 / logs.shape[1])
        total = weights.sum()
        for _ in range(ROUNDS if logs.shape[1] > 1 else 0):
            joint = p * share
            new = (weights / joint.sum(axis=1)) @ joint / total
            done = np.abs(new - share).max() < 1e-4
            share = new
            if done:
                break
        return share, float(weights @ (np.log((p * share).sum(axis=1)) + top[:, 0]))

    def languages(
        self, text: str | None, known: dict[str, np.ndarray], names: tuple[str, ...] = (), held: np.ndarray | None = None
    ) -> tuple[tuple[str, ...], np.ndarray, np.ndarray]:
        """The languages chosen among those of this block and ``names``, in order, with their proportions and
        what each gives the text's distinct words; none without letters. ``held`` is the last of ``names``."""
        counted: dict[str, int] = {}
        for w in words_in(text):
            counted[w] = counted.get(w, 0) + 1
        counted = {w: n for w, n in counted.items() if w.isalpha() or any(c.isalpha() for c in w)}
        every = (*names, *self.names)
        if not counted or not every:
            return (), np.zeros(0), np.zeros((0, 0))
        logs, weights = self.likelihoods(list(counted), known), np.array(list(counted.values()), np.float64)
        if names:
            logs = np.hstack([np.reshape(held, (len(counted), len(names))), logs])
        single = weights @ logs
        chosen = [int(np.argmax(single))]
        share, reached = np.ones(1), float(single[chosen[0]])
        cost = self.penalty * math.log(weights.sum() + 1)
        while len(chosen) < len(every):
            # No mixture does better than the best language of each word.
            best = logs[:, chosen].max(axis=1, keepdims=True)
            most = weights @ np.maximum(logs, best) - reached
            rest = [j for j in np.flatnonzero(most > cost).tolist() if j not in chosen]
            if not rest:
                break
            tried = [(self.mixture(logs[:, [*chosen, j]], weights), j) for j in rest]
            (more, value), j = max(tried, key=lambda x: (x[0][1], -x[1]))
            if value - reached <= cost:
                break
            chosen.append(j)
            share, reached = more, value
        order = np.argsort(chosen)
        chosen = [chosen[i] for i in order]
        return tuple(every[j] for j in chosen), share[order], logs[:, chosen]


@dataclass(frozen=True)
class Learned:
    """All languages learned, as a written table: lang, logs (doubles by cell)."""

    table: DataFrame

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(r.lang for r in self.table.select("lang").orderBy("lang").toLocalIterator())

    def blocks(self, size: int) -> Iterator[tuple[Model, bool]]:
        """The languages in order, ``size`` at a time, and whether these are the last; one block at least."""
        rest = self.table
        while True:
            rows = rest.orderBy("lang").limit(size + 1).collect()
            own, last = rows[:size], len(rows) <= size
            logs = np.array([np.frombuffer(r.logs, "<f8") for r in own]).reshape(len(own), 1 << CELLS_LOG2)
            yield Model(tuple(r.lang for r in own), logs), last
            if last:
                return
            rest = self.table.where(F.col("lang") > own[-1].lang)


def densities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, logs of each language from its cells' counts, which come one language after another."""

    def row(name: str, own: np.ndarray) -> pa.RecordBatch:
        logs = np.log(own / own.sum()).astype("<f8")
        return pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([logs.tobytes()], pa.binary())], ["lang", "logs"])

    name, own = None, np.zeros(0)
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        at, times = (batch.column(c).to_numpy() for c in ("cell", "times"))
        edges = [0, *(np.flatnonzero(langs[1:] != langs[:-1]) + 1).tolist(), len(langs)]
        for begin, end in zip(edges, edges[1:]):
            if begin == end:
                continue
            if langs[begin] != name:
                if name is not None:
                    yield row(name, own)
                name, own = langs[begin], np.full(1 << CELLS_LOG2, 0.05)
            own[at[begin:end]] += times[begin:end]
    if name is not None:
        yield row(name, own)


def train(documents: DataFrame) -> Learned:
    """Counts n-grams over all texts with a language; text and lang are read.

    Rows whose lang or text is null teach nothing, nor do texts without words. Counts are summed where they
    arise; a language brings its task at most 2 ** CELLS_LOG2 rows, and nothing is collected.
    """
    known = documents.select(F.col("text").cast("string"), F.col("lang").cast("string")).where(
        "text is not null and lang is not null"
    )

    def count(part: pa.RecordBatch) -> dict:
        out: dict = {"lang": [], "cell": [], "times": []}
        langs = np.array(part.column("lang").to_pylist(), object)
        texts = np.array(part.column("text").to_pylist(), object)
        for lang in sorted(set(langs)):
            words = [w for t in texts[langs == lang] for w in words_in(t)]
            at, times = np.unique(cells(words)[0] if words else np.zeros(0, np.int64), return_counts=True)
            out["lang"] += [lang] * len(at)
            out["cell"].append(at)
            out["times"].append(times)
        return out | {c: np.concatenate(out[c]) if out[c] else np.zeros(0, np.int64) for c in ("cell", "times")}

    counted = map_rows(known, count, "lang string, cell int, times long", "text").groupBy("lang", "cell").agg(
        F.sum("times").alias("times")
    )
    dense = counted.repartition("lang").sortWithinPartitions("lang").mapInArrow(densities, "lang string, logs binary")
    return Learned(written(dense, "languages"))


def identify(documents: DataFrame, learned: Learned, block: int = BLOCK_LANGUAGES) -> DataFrame:
    """doc_id, lang_pred, score, langs, shares: the main language of each whole text, its proportion,
    and all languages found with theirs, largest first; equal ones by name.

    Every language learned is tried, ``block`` of them at a time; between two blocks each text's set is
    written. The best single language of a text is never lost; one that joins no set when its block comes
    is not tried again.

    ``und`` with score 0 and no languages if a text is null or has no letter, or if nothing was
    learned. One row per row of ``documents``; only doc_id and text are read.
    """
    spark = documents.sparkSession
    state = documents.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.lit(None).cast("array<string>").alias("names"),
        F.lit(None).cast("array<double>").alias("held"),
    )

    def chosen(part: pa.RecordBatch, model: Model) -> Iterator[tuple]:
        known: dict[str, np.ndarray] = {}
        names, held = part.column("names").to_pylist(), part.column("held")
        for i, text in enumerate(part.column("text").to_pylist()):
            before = held[i].values.to_numpy() if held[i].is_valid else None
            yield model.languages(text, known, tuple(names[i] or ()), before)

    for model, last in learned.blocks(block):
        shared = spark.sparkContext.broadcast(model)
        if last:
            break

        def narrowed(part: pa.RecordBatch, shared=shared) -> dict:
            found = list(chosen(part, shared.value))
            return {
                "doc_id": part.column("doc_id"),
                "text": part.column("text"),
                "names": [list(names) for names, _, _ in found],
                "held": [np.ravel(logs) for _, _, logs in found],
            }

        state = written(map_rows(state, narrowed, state.schema, "text"), "mixtures")
        shared.unpersist()

    def work(part: pa.RecordBatch) -> dict:
        found = [
            sorted(zip(names, shares.tolist()), key=lambda x: (-x[1], x[0])) for names, shares, _ in chosen(part, shared.value)
        ]
        return {
            "doc_id": part.column("doc_id"),
            "lang_pred": [x[0][0] if x else "und" for x in found],
            "score": [min(1.0, x[0][1]) if x else 0.0 for x in found],
            "langs": [[name for name, _ in x] for x in found],
            "shares": [[share for _, share in x] for x in found],
        }

    return map_rows(state, work, "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>", "text")
