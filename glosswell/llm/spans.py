"""Passages that documents repeat: spans of sentences, joined over all documents.

Every run of several consecutive sentences that has enough words, and every sentence that is long enough
by itself, is hashed where it stands. Runs are counted by hash, with
the first place of each; the runs that stand elsewhere too go back to their documents, which lose the
sentences under them. The most frequent run costs each task one row when counted, and meets one row
when joined.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import map_rows, written

#: Words that a run of several sentences has at least, and a sentence that is a run by itself.
WORDS = 15
ALONE = 25
#: A sentence with the blanks behind it: up to . ! ? before a blank, or the end of a line.
SENTENCES = re.compile(r"[^\n]*?(?:[.!?][\"')\]]*(?=\s)\s+|\n\s*|$)", re.S)


def sentences(text: str | None) -> list[str]:
    """The text cut after sentences and lines; joined, the pieces are the text."""
    return [s for s in SENTENCES.findall(text or "") if s]


def runs(pieces: list[str], words: int, alone: int) -> list[tuple[int, int, bytes]]:
    """(first sentence, sentences, 128-bit hash) of all runs; case and blanks do not count, nor do
    pieces without words.

    A run has two sentences or more with ``words`` words, or ``alone`` words. From every sentence on, and up
    to every sentence, the shortest one. Any passage of whole sentences that is a run is covered by runs
    that lie in it.
    """
    from xxhash import xxh3_128

    cut = [(i, w) for i, p in enumerate(pieces) if (w := p.lower().split())]
    joined = [" ".join(w).encode() + b"\n" for _, w in cut]
    found, begin, seen = set(), 0, 0
    for end, (_, w) in enumerate(cut):
        seen += len(w)
        # Runs that begin before ``end`` and get their words by it; the last is the shortest up to it.
        while begin <= end and (seen >= alone or (seen >= words and begin < end)):
            found.add((begin, end))
            seen -= len(cut[begin][1])
            begin += 1
        if begin:
            found.add((begin - 1, end))
    return [
        (cut[at][0], cut[end][0] - cut[at][0] + 1, xxh3_128(b"".join(joined[at : end + 1])).digest())
        for at, end in sorted(found)
    ]


def drop_repeated_spans(documents: DataFrame, words: int = WORDS, alone: int = ALONE) -> DataFrame:
    """doc_id, text, n_sentences, n_removed, spans: documents without repeated passages.

    A run is the fewest consecutive sentences, two at least, with ``words`` words or more, from one of them
    on or up to one, or a sentence with ``alone`` words, so every repeated passage of whole sentences with as
    many is found. Of all places of the same run (case and blanks aside), the first stays: the
    smallest doc_id, then the place in the text. Sentences covered by any other place are removed;
    ``spans`` are their ranges (first sentence, number), ``text`` is what is left, unchanged.

    One row per row of ``documents``. Null and empty texts have no sentences and give an empty text.
    Rows that share id and text are one document and repeat nothing among themselves; rows that share
    an id only are different documents, in the order of their texts' hashes. Null ids come last.
    Further columns are not read.
    """
    documents = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("text_hash")
    )

    def places(part: pa.RecordBatch) -> dict:
        rows, firsts, counts, hashes = [], [], [], []
        for i, text in enumerate(part.column("text").to_pylist()):
            for first, count, name in runs(sentences(text), words, alone):
                rows.append(i)
                firsts.append(first)
                counts.append(count)
                hashes.append(name)
        names = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
        pick = pa.array(rows, pa.int64())
        return {
            "a": names[:, 0],
            "b": names[:, 1],
            "doc_id": part.column("doc_id").take(pick),
            "text_hash": part.column("text_hash").take(pick),
            "first": firsts,
            "count": counts,
        }

    found = map_rows(documents, places, "a long, b long, doc_id long, text_hash long, first int, count int", "text")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "first")
    repeated = (
        found.groupBy("a", "b")
        .agg(F.min(place).alias("stays"), F.max(place).alias("last"))
        .where(~F.col("stays").eqNullSafe(F.col("last")))
        .select("a", "b", "stays")
    )
    # A table of its own, so that the join may split a run that most documents hold.
    repeated = written(repeated, "repeated")
    gone = (
        found.join(repeated, ["a", "b"])
        .where(~place.eqNullSafe(F.col("stays")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("first", "count")).alias("gone"))
        .toDF("gone_id", "gone_hash", "gone")
    )

    def cut(part: pa.RecordBatch) -> dict:
        out: dict = {"doc_id": part.column("doc_id"), "text": [], "n_sentences": [], "n_removed": [], "spans": []}
        for text, gone in zip(part.column("text").to_pylist(), part.column("gone").to_pylist()):
            pieces = sentences(text)
            covered = np.zeros(len(pieces) + 1, bool)
            for g in gone or []:
                covered[g["first"] : g["first"] + g["count"]] = True
            edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
            out["text"].append("".join(p for p, c in zip(pieces, covered) if not c) if gone else text or "")
            out["n_sentences"].append(len(pieces))
            out["n_removed"].append(int(covered.sum()))
            out["spans"].append([{"first": int(b), "count": int(e - b)} for b, e in zip(edges[::2], edges[1::2])])
        return out

    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & F.col("text_hash").eqNullSafe(F.col("gone_hash"))
    return map_rows(
        documents.join(gone, same, "left").select("doc_id", "text", "gone"),
        cut,
        "doc_id long, text string, n_sentences long, n_removed long, spans array<struct<first:long,count:long>>",
        "text",
    )
