"""Lines that many documents repeat: all but one document lose them.

Two Bloom filters over the lines of all documents: seen once, and seen twice. Every task fills its own
pair, and pairs are merged by place (seen by both is seen twice), so no line is shuffled for them. Only
lines all of whose positions were seen twice are suspects and are shuffled; their 128-bit keys are then
counted exactly. Filters are sized by the bytes of all texts up to a bound; a full one only makes more
lines suspects.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glosswell.llm.common import map_rows, written
from glosswell.llm.filters import is_set, seen_twice

#: Bits of a filter at most: 2 ** 28 bits are 32 MB, and a task that fills has two. Size moves work, never results.
MOST_LOG2 = 28
#: Bits for each line that the texts can hold by their bytes; lines are usually a few times as long.
BITS_PER_LINE = 8
BLANKS = b" \t\n\x0b\x0c\r"


def keys_of(text: str | None, min_chars: int) -> Iterator[tuple[int, bytes]]:
    """(line number, key) of the lines long enough to count."""
    for i, line in enumerate((text or "").encode().split(b"\n")):
        if len(line) >= min_chars:
            key = line.strip(BLANKS).lower()
            if len(key) >= min_chars and (key.isascii() or len(key.decode()) >= min_chars):
                yield i, key


def hashed(texts: list[str | None], min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hashes of each document's distinct keys, as pairs of integers, and their rows."""
    from xxhash import xxh3_128_digest

    found, rows = [], []
    for i, text in enumerate(texts):
        own = {xxh3_128_digest(key) for _, key in keys_of(text, min_chars)}
        found += own
        rows += [i] * len(own)
    return np.frombuffer(b"".join(found), "<i8").reshape(-1, 2), np.array(rows, np.int64)


def filter_size(documents: DataFrame, min_chars: int) -> int:
    """log2 of the bits that the lines of ``documents`` need: there are no more than bytes / ``min_chars``."""
    bytes_ = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(MOST_LOG2, max(10, int(BITS_PER_LINE * bytes_ / max(1, min_chars)).bit_length()))


def drop_repeated_lines(
    documents: DataFrame,
    min_docs: int = 5,
    min_chars: int = 40,
    filter_log2: int | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, text, n_lines, n_dropped: the documents without lines that others keep.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys of at least
    ``min_chars`` code points found in at least ``min_docs`` different ids stay only in the largest
    of these ids, there as often as they occur. Lines end at \\n and are joined by it again.

    One row per row of ``documents``. A null or empty text is one empty line. Rows that share an id
    are one document when counting. Null ids are not counted and never the one that keeps a line.
    Further columns are not read, but for those named in ``carry``, which come along unchanged.

    ``filter_log2`` is the size of the filters; by default that of the table (``filter_size``).
    """
    # Columns that come along are put away, so that none clashes with those made here.
    whole = documents.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.struct(F.lit(0).alias("none"), *carry).alias("carried"),
    )
    # Rows with the same id lie by their texts too, so that no id (null, say) gathers those of many texts.
    documents = whole.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    log2 = filter_log2 or filter_size(documents, min_chars)
    mask = (1 << log2) - 1

    def positions(part: pa.RecordBatch) -> np.ndarray:
        return hashed(part.column("text").to_pylist(), min_chars)[0] & mask

    bits = documents.sparkSession.sparkContext.broadcast(seen_twice(documents.select("text"), positions, log2, "text"))

    def suspects(part: pa.RecordBatch) -> dict:
        hashes, rows = hashed(part.column("text").to_pylist(), min_chars)
        seen = np.frombuffer(bits.value, np.uint8)
        at = hashes & mask
        both = is_set(seen, at).all(axis=1)
        return {
            "a": hashes[both, 0],
            "b": hashes[both, 1],
            "doc_id": part.column("doc_id").take(pa.array(rows[both])),
            "text_hash": part.column("text_hash").take(pa.array(rows[both])),
        }

    suspected = written(map_rows(documents, suspects, "a long, b long, doc_id long, text_hash long", "text"), "lines")
    keepers = (
        suspected.groupBy("a", "b")
        .agg(F.count_distinct("doc_id").alias("docs"), F.max("doc_id").alias("keeper"))
        .where(F.col("docs") >= min_docs)
    )
    # A table of its own, so that the join may split a key that most documents hold.
    keepers = written(keepers, "keepers")
    drops = (
        suspected.join(keepers, ["a", "b"])
        .where("doc_id is null or doc_id <> keeper")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("a", "b")).alias("drops"))
        .toDF("drop_id", "drop_hash", "drops")
    )

    def cut(part: pa.RecordBatch) -> dict:
        from xxhash import xxh3_128_digest

        out = {c: part.column(c) for c in ("doc_id", "carried")} | {"text": [], "n_lines": [], "n_dropped": []}
        drops = part.column("drops")
        for i, text in enumerate(part.column("text").to_pylist()):
            lines, gone = (text or "").split("\n"), []
            if drops[i].is_valid:
                pairs = drops[i].values
                own = np.stack([pairs.field("a").to_numpy(), pairs.field("b").to_numpy()], axis=1)
                wanted = set(map(bytes, own.astype("<i8")))
                gone = [n for n, key in keys_of(text, min_chars) if xxh3_128_digest(key) in wanted]
            left = set(gone)
            out["text"].append("\n".join(x for n, x in enumerate(lines) if n not in left) if gone else text or "")
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(gone))
        return out

    schema = StructType(whole.schema.fields).add("n_lines", "long").add("n_dropped", "long")
    same = F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.xxhash64("text") == F.col("drop_hash"))
    marked = whole.join(drops, same, "left").drop("drop_id", "drop_hash")
    kept = map_rows(marked, cut, schema, "text")
    return kept.select("doc_id", "text", *(F.col(f"carried.`{c}`") for c in carry), "n_lines", "n_dropped")
