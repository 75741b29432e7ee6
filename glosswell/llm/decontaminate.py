"""Passages of benchmark items inside documents: a prefix-filtered set join.

A window of an item is a run of words. All its shingles (short runs) have to be in a document that
contains it, so for a join on whole containment one shingle is the necessary prefix: the rarest.
Shingles are ranked by how often they occur in all documents; a window with a shingle that occurs
nowhere is out at once. What shares a prefix shingle has to fit by position and length, and is then
compared word by word.

Documents are read once: a filter of the benchmark's shingles, of fixed size, leaves the regions of a
text where a window may lie. Only these are written, shuffled and joined; if the benchmark outgrows
the filter, more of the text is taken along, with the same results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import map_rows, written
from glosswell.llm.filters import collected_bits, is_set
from glosswell.llm.words import ALPHANUMERIC, runs, texts_words

#: Bits of the filter that every task holds: 2 ** 23 bits are 1 MB. Size moves work, never results.
FILTER_LOG2 = 23


def lowered(raw: bytes) -> str:
    return raw.lower().decode()  # bytes.lower: A-Z alone


def windows_of(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """item_id, words, shingles: every window of every item, its words joined by blanks, and the
    hashes of its shingles in order. An item of fewer words is one window, one of none has none."""

    def work(part: pa.RecordBatch) -> dict:
        text, hashes, first, last, bounds = texts_words(part.column("text").to_pylist(), ALPHANUMERIC)
        rows, words, found = [], [], []
        for i in range(part.num_rows):
            begin, end = bounds[i], bounds[i + 1]
            length = min(window, end - begin)
            if length == 0:
                continue
            width = min(shingle, length)
            own, _ = runs(hashes[begin:end], np.array([0, end - begin]), width)
            names = [lowered(text[a:b]) for a, b in zip(first[begin:end], last[begin:end])]
            for at in range(len(names) - length + 1):
                rows.append(i)
                words.append(" ".join(names[at : at + length]))
                found.append(own[at : at + length - width + 1].astype(np.int64))
        return {"item_id": part.column("item_id").take(pa.array(rows, pa.int64())), "words": words, "shingles": found}

    return map_rows(
        items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where("item_id is not null"),
        work,
        "item_id string, words string, shingles array<long>",
        "text",
    ).distinct()


def regions_of(documents: DataFrame, bits: bytes, log2: int, window: int, shingle: int) -> DataFrame:
    """doc_id, n_words, regions: parts of each text that hold all its places where a window may lie,
    as the number of the first word and the words joined by blanks."""
    held = documents.sparkSession.sparkContext.broadcast(bits)
    mask = np.uint64((1 << log2) - 1)

    def work(part: pa.RecordBatch) -> dict:
        seen = np.frombuffer(held.value, np.uint8)
        text, hashes, first, last, bounds = texts_words(part.column("text").to_pylist(), ALPHANUMERIC)
        doc_of = lambda at: np.searchsorted(bounds, at, "right") - 1
        spans = []
        for width in range(1, shingle + 1):
            own, at = runs(hashes, bounds, width)
            at = at[is_set(seen, (own & mask).astype(np.int64))]
            reach = window - width if width == shingle else 0
            doc = doc_of(at)
            spans.append(np.stack([np.maximum(at - reach, bounds[doc]), np.minimum(at + width + reach, bounds[doc + 1])], 1))
        found = np.concatenate(spans)
        found = found[np.argsort(found[:, 0], kind="stable")]
        docs = doc_of(found[:, 0])
        # A region ends where the next span begins behind all before it, or in another text.
        reached = np.maximum.accumulate(found[:, 1]) if len(found) else found[:, 1]
        opens = np.ones(len(found), bool)
        opens[1:] = (found[1:, 0] > reached[:-1]) | (docs[1:] != docs[:-1])
        begins = np.flatnonzero(opens)
        ends = reached[np.append(begins[1:], len(found)) - 1] if len(found) else begins
        regions: list[list] = [[] for _ in range(part.num_rows)]
        for begin, end, doc in zip(found[begins, 0], ends, docs[begins]):
            words = " ".join(lowered(text[a:b]) for a, b in zip(first[begin:end], last[begin:end]))
            regions[doc].append({"start": int(begin - bounds[doc]), "words": words})
        return {"doc_id": part.column("doc_id"), "n_words": np.diff(bounds), "regions": regions}

    return map_rows(
        documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        work,
        "doc_id long, n_words long, regions array<struct<start:long,words:string>>",
        "text",
    )


def shingles_of(regions: DataFrame, bits: bytes, log2: int, shingle: int) -> DataFrame:
    """row, region, at, room, hash: the regions' shingles that may be the benchmark's; ``room`` is
    how many words of the region follow the first word of the shingle."""
    held = regions.sparkSession.sparkContext.broadcast(bits)
    mask = np.uint64((1 << log2) - 1)

    def work(part: pa.RecordBatch) -> dict:
        seen = np.frombuffer(held.value, np.uint8)
        _, hashes, _, _, bounds = texts_words(part.column("words").to_pylist(), ALPHANUMERIC)
        found = []
        for width in range(1, shingle + 1):
            own, at = runs(hashes, bounds, width)
            kept = is_set(seen, (own & mask).astype(np.int64))
            found.append((own[kept], at[kept]))
        own, at = (np.concatenate(x) for x in zip(*found))
        where = np.searchsorted(bounds, at, "right") - 1
        pick = pa.array(where)
        return {
            "row": part.column("row").take(pick),
            "region": part.column("region").take(pick),
            "at": at - bounds[where],
            "room": bounds[where + 1] - at,
            "hash": own.astype(np.int64),
        }

    return map_rows(
        regions.select("row", F.posexplode("regions").alias("region", "r")).select("row", "region", "r.words"),
        work,
        "row long, region int, at long, room long, hash long",
        "words",
    )


def decontaminate(
    documents: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 5, filter_log2: int = FILTER_LOG2
) -> DataFrame:
    """doc_id, n_words, n_hit, spans, items: where benchmark items occur in documents.

    Words are maximal runs of a-z, 0-9 and characters beyond ASCII, after lower-casing A-Z. A window
    is ``window`` consecutive words of an item, or a shorter item as a whole. ``n_hit`` counts the
    document's words inside any occurrence of a window, ``spans`` are their maximal ranges (start,
    length in words), ``items`` the ids, as strings in order, of all items with an occurring window.

    One row per row of ``documents``, repeated or not. Null and empty texts have no words. Items
    without words or id match nothing; repeated items count once. Further columns are not read.
    """
    windows = written(windows_of(benchmark, window, shingle), "windows")
    masked = F.expr(f"hash & {(1 << filter_log2) - 1}")
    bits = collected_bits(
        windows.select(F.explode("shingles").alias("hash")).select(masked.alias("at")), "at", filter_log2
    )
    scanned = written(
        regions_of(documents, bits, filter_log2, window, shingle).withColumn("row", F.monotonically_increasing_id()),
        "regions",
    )
    occurring = written(shingles_of(scanned.where("size(regions) > 0"), bits, filter_log2, shingle), "shingles")

    ranked = (
        windows.select("words", "shingles").distinct()
        .select("words", F.size(F.split("words", " ")).alias("length"), F.posexplode("shingles").alias("offset", "hash"))
        .join(occurring.groupBy("hash").agg(F.count("*").alias("times")), "hash", "left")
    )
    prefixes = (
        ranked.groupBy("words")
        .agg(F.min(F.struct(F.coalesce("times", F.lit(0)).alias("times"), "hash", "offset", "length")).alias("p"))
        .select("words", "p.*")
        .where("times > 0")
    )
    candidates = (
        occurring.join(prefixes, "hash")
        .where("at >= offset and room >= length - offset")
        .select("row", F.struct("region", (F.col("at") - F.col("offset")).alias("at"), "length", "words").alias("c"))
        .groupBy("row")
        .agg(F.collect_set("c").alias("candidates"))
    )

    def confirm(part: pa.RecordBatch) -> dict:
        out: dict = {"row": part.column("row"), "spans": [], "found": []}
        for regions, candidates in zip(part.column("regions").to_pylist(), part.column("candidates").to_pylist()):
            words = [r["words"].split(" ") for r in regions]
            hits, found = set(), set()
            for c in candidates:
                if words[c["region"]][c["at"] : c["at"] + c["length"]] == c["words"].split(" "):
                    begin = regions[c["region"]]["start"] + c["at"]
                    hits.add((begin, begin + c["length"]))
                    found.add(c["words"])
            spans: list[list[int]] = []
            for begin, end in sorted(hits):
                if spans and begin <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([begin, end])
            out["spans"].append([{"start": b, "length": e - b} for b, e in spans])
            out["found"].append(sorted(found))
        return out

    confirmed = map_rows(
        candidates.join(scanned.select("row", "regions"), "row"),
        confirm,
        "row long, spans array<struct<start:long,length:long>>, found array<string>",
    )
    confirmed = written(confirmed.where("size(spans) > 0"), "confirmed")
    items = (
        confirmed.select("row", F.explode("found").alias("words"))
        .join(windows.select("words", "item_id"), "words")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    none = F.expr("cast(array() as array<struct<start:bigint,length:bigint>>)")
    return (
        scanned.select("row", "doc_id", "n_words")
        .join(confirmed.select("row", "spans"), "row", "left")
        .join(items, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce(F.expr("aggregate(spans, 0L, (n, s) -> n + s.length)"), F.lit(0)).alias("n_hit"),
            F.coalesce("spans", none).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )
