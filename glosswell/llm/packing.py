"""Lexical retrieval packing: sequences filled with documents that a BM25 index finds for a seed.

Tokens are the index's terms, so what is counted over all documents is bounded by the vocabulary. Whole
windows of a long document are sequences by themselves; what is left of every document is a piece. Pieces
are put in order of their most telling terms and cut into shards of bounded size, each with its own
inverted index. In a shard a seed asks for unused neighbours, best first, until its window is full; the
one that no longer fits is cut, and its rest is the next seed. What stays open at the end of a shard goes
on in the next one; at the end of a task it is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from glosswell.llm.common import map_rows, slices, written
from glosswell.llm.word_ids import word_ids

WINDOW, END = 4_096, 2
#: Fixed values of BM25: saturation of term counts, weight of lengths.
K1, B = 1.2, 0.75
#: Pieces of a shard, and tokens of a task's share; bounds of memory and work.
SHARD_PIECES, TASK_TOKENS = 2_048, 2_000_000
#: Terms that say where a piece stands.
TELLING = 3
PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, score double, ids binary"


def tokens(documents: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n, ids: the tokens of each whole text and the end token, as little-endian integers that have
    the smallest width that does for the vocabulary."""

    def work(part: pa.RecordBatch) -> dict:
        encoder = word_ids(vocabulary)
        end = np.array([END], encoder.kind).tobytes()
        ids = [x.tobytes() + end for x in encoder.encode(part.column("text"))]
        return {"doc_id": part.column("doc_id"), "n": [len(x) // len(end) for x in ids], "ids": ids}

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(chosen, work, "doc_id long, n long, ids binary", "text")


def flat(ids: list[bytes], n: int) -> np.ndarray:
    """All ids of the lists, n in number."""
    raw = b"".join(ids)
    return np.frombuffer(raw, f"<u{len(raw) // n}" if n else "<u2")


def terms_of(ids: list[bytes], lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each list's distinct terms in order, how often they occur, and where each list's begin. ``lengths``
    are the lists' numbers of ids."""
    keys = np.repeat(np.arange(len(ids), dtype=np.int64) << 32, lengths) | flat(ids, sum(lengths)).astype(np.int64)
    keys, times = np.unique(keys, return_counts=True)
    return keys & 0xFFFFFFFF, times, np.searchsorted(keys >> 32, np.arange(len(ids) + 1))


def document_counts(made: DataFrame) -> DataFrame:
    """term, docs: in how many documents each term is. A task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for part in slices(batches, "ids"):
            own = np.bincount(terms_of(part.column("ids").to_pylist(), part.column("n").to_pylist())[0])
            if len(own) > len(total):
                own, total = total, own
            total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["term", "docs"])

    return made.select("n", "ids").mapInArrow(count, "term long, docs long").groupBy("term").agg(F.sum("docs").alias("docs"))


class Statistics:
    """Of all documents: how telling each term is, and the mean length."""

    def __init__(self, counts: DataFrame, documents: int, length: float):
        held = counts.collect()  # one row per term of the vocabulary
        self.rarity = np.zeros(max((r.term for r in held), default=0) + 1)
        self.shared = np.zeros(len(self.rarity), bool)
        for r in held:
            self.rarity[r.term] = math.log(1 + (documents - r.docs + 0.5) / (r.docs + 0.5))
            self.shared[r.term] = r.docs > 1
        self.length = max(length, 1.0)

    def weights(self, terms: np.ndarray, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """BM25 of one occurrence of a term in a query and ``times`` in a piece of so many tokens."""
        return self.rarity[terms] * times * (K1 + 1) / (times + K1 * (1 - B + B * lengths / self.length))


def pieces(made: DataFrame, statistics: Statistics, window: int) -> DataFrame:
    """Whole windows of documents (``whole``), and what is left of each with its most telling terms.

    Only terms that two documents have are telling; the rarest and most frequent in the piece come first.
    """
    held = made.sparkSession.sparkContext.broadcast(statistics)

    def work(part: pa.RecordBatch) -> dict:
        stats, rows, ids = held.value, [], []
        for i, (n, x) in enumerate(zip(part.column("n").to_pylist(), part.column("ids").to_pylist())):
            for at in range(0, n, window):
                rows.append((i, at, min(window, n - at)))
                wide = len(x) // n
                ids.append(x[wide * at : wide * (at + window)])
        which, starts, lengths = (np.array(c, np.int64) for c in zip(*rows))
        out = {c: part.column(c).take(pa.array(which)) for c in ("doc_id", "n")}
        out |= {"start": starts, "length": lengths, "ids": pa.array(ids, pa.binary())}
        terms, times, cuts = terms_of(ids, lengths.tolist())
        weights = stats.weights(terms, times, np.repeat(lengths, np.diff(cuts))) * stats.shared[terms]
        owner = np.repeat(np.arange(len(ids)), np.diff(cuts))
        order = np.lexsort((terms, -weights, owner))
        for k in range(TELLING):
            at = np.minimum(cuts[:-1] + k, cuts[1:] - 1)
            out[f"term_{k}"] = terms[order[at]]
        return out

    keys = ", ".join(f"term_{k} long" for k in range(TELLING))
    return map_rows(made, work, f"doc_id long, n long, start long, length long, ids binary, {keys}", "ids")


class Shard:
    """Pieces with an inverted index: for each term the pieces that hold it, and its weight there."""

    def __init__(self, rows: list[dict], statistics: Statistics):
        lengths = [r["length"] for r in rows]
        terms, times, cuts = terms_of([r["ids"] for r in rows], lengths)
        owner = np.repeat(np.arange(len(rows)), np.diff(cuts))
        weights = statistics.weights(terms, times, np.array(lengths)[owner])
        order = np.argsort(terms, kind="stable")
        self.pieces, self.weights = owner[order], weights[order]
        self.listed, begin = np.unique(terms[order], return_index=True)
        self.begin = np.append(begin, len(order))
        self.unused = np.ones(len(rows), bool)
        self.indexed = len(rows)

    def prune(self) -> None:
        """Take used pieces out of the index once they are half of it."""
        if 2 * np.count_nonzero(self.unused) <= self.indexed:
            kept = self.unused[self.pieces]
            self.begin = np.concatenate([[0], np.cumsum(kept)])[self.begin]
            self.pieces, self.weights = self.pieces[kept], self.weights[kept]
            self.indexed = int(np.count_nonzero(self.unused))

    def neighbours(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unused pieces by falling score for a query of distinct terms, ties in order, and all scores."""
        self.prune()
        place = np.searchsorted(self.listed[:-1], terms)
        place = place[self.listed[place] == terms]
        begin, size = self.begin[place], self.begin[place + 1] - self.begin[place]
        upto = np.cumsum(size)
        at = np.repeat(begin - upto + size, size) + np.arange(upto[-1] if len(upto) else 0)
        scores = np.bincount(self.pieces[at], self.weights[at], len(self.unused))
        left = np.flatnonzero(self.unused)
        return left[np.argsort(-scores[left], kind="stable")], scores


def parted(row: dict, room: int) -> tuple[dict, dict | None]:
    """The first ``room`` tokens of a piece, and the others if there are any."""
    if row["length"] <= room:
        return row, None
    wide = len(row["ids"]) // row["length"]
    return (
        row | {"length": room, "ids": row["ids"][: wide * room]},
        row | {"start": row["start"] + room, "length": row["length"] - room, "ids": row["ids"][wide * room :]},
    )


class Packer:
    """Fills windows shard by shard."""

    def __init__(self, statistics: Statistics, window: int, first_id: int):
        self.statistics, self.window, self.sequence = statistics, window, first_id
        self.open: list[dict] = []
        self.filled = 0

    def put(self, row: dict, score: float | None) -> dict | None:
        """Append a piece to the open window; what does not fit is given back."""
        room = self.window - self.filled
        taken, rest = parted(row, room)
        self.open.append(taken | {"score": score})
        self.filled += taken["length"]
        return rest

    def sequences(self, cuts: list[int]) -> Iterator[dict]:
        """The open window's pieces as sequences of the given lengths."""
        rows = list(reversed(self.open))
        for room in cuts:
            offset = 0
            while offset < room:
                row, rest = parted(rows.pop(), room - offset)
                yield row | {"sequence_id": self.sequence, "offset": offset}
                offset += row["length"]
                if rest:
                    rows.append(rest)
            self.sequence += 1
        self.open, self.filled = [], 0

    def pack(self, rows: list[dict]) -> Iterator[dict]:
        """All windows that the pieces of a shard fill; the last one may stay open."""
        shard = Shard(rows, self.statistics)
        rest: dict | None = None
        upto = 0
        while True:
            if not self.open:
                if rest is None:
                    while upto < len(rows) and not shard.unused[upto]:
                        upto += 1
                    if upto == len(rows):
                        return
                    rest, shard.unused[upto] = rows[upto], False
                rest = self.put(rest, None)
            order, scores = shard.neighbours(np.unique(flat([self.open[0]["ids"]], self.open[0]["length"])).astype(np.int64))
            for i in order.tolist():
                if self.filled == self.window:
                    break
                shard.unused[i] = False
                rest = self.put(rows[i], float(scores[i]))
            if self.filled < self.window:
                return
            yield from self.sequences([self.window])

    def end(self) -> Iterator[dict]:
        """What is open, in powers of two."""
        yield from self.sequences([1 << b for b in reversed(range(self.filled.bit_length())) if self.filled >> b & 1])


def pack(documents: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset, score, ids: every document's tokens, packed.

    A document's tokens are those of its whole text and one end token; a null or empty text has the end
    token alone. Each token lies in exactly one piece: ``length`` tokens of the document from ``start``, at
    ``offset`` of a sequence. A sequence has ``window`` (a power of two) tokens, or a smaller power of two at the
    end of a task's share, so none needs padding. ``score`` is the BM25 score of the piece for the seed of its sequence,
    null for seeds. ``ids`` are little-endian 32-bit integers.

    Every row of ``documents`` is a document, also repeated rows and those without an id, and ids may share
    rows. Ties go by place. Which documents meet depends on how rows are dealt; that all tokens are packed
    does not. An empty table gives no rows. Further columns are not read.

    A task holds one shard of at most SHARD_PIECES pieces of less than a window, whatever their terms:
    pieces with the same telling terms are spread by id over as many shards as they need.
    """
    made = written(tokens(documents, vocabulary), "tokens")
    total = made.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    statistics = Statistics(document_counts(made), total.docs, total.tokens / max(1, total.docs))
    cut = written(pieces(made, statistics, window), "pieces")
    keys = [*[f"term_{k}" for k in range(TELLING)], "spread", "doc_id", "start"]
    left = cut.where(F.col("length") < window).withColumn("spread", F.xxhash64("doc_id", "n", "start"))
    shares = max(1, -(-total.tokens // TASK_TOKENS))
    held = documents.sparkSession.sparkContext.broadcast(statistics)
    schema = to_arrow_schema(StructType.fromDDL(PIECE))

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        named = [r | {"doc_tokens": r["n"], "ids": flat([r["ids"]], r["length"]).astype("<u4").tobytes()} for r in rows]
        return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in named], f.type) for f in schema], schema=schema)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(held.value, window, TaskContext.get().partitionId() << 33)
        rows: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                rows.append(row)
                if len(rows) == SHARD_PIECES:
                    if out := list(packer.pack(rows)):
                        yield batch_of(out)
                    rows = []
        out = [*(packer.pack(rows) if rows else ()), *packer.end()]
        if out:
            yield batch_of(out)

    mixed = (
        left.repartitionByRange(shares, *keys)
        .sortWithinPartitions(*keys, "ids")
        .select("doc_id", "n", "start", "length", "ids")
        .mapInArrow(fill, PIECE)
    )
    def widened(part: pa.RecordBatch) -> dict:
        columns = {c: part.column(c) for c in part.schema.names}
        ids = [flat([x], window).astype("<u4").tobytes() for x in part.column("ids").to_pylist()]
        return columns | {"ids": ids, "offset": [0] * len(ids), "score": [None] * len(ids)}

    # Odd numbers are whole windows of one document, even ones are sequences of several.
    number = (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id")
    whole = cut.where(F.col("length") == window).select("doc_id", "start", "length", F.col("n").alias("doc_tokens"), number, "ids")
    return map_rows(whole, widened, PIECE, "ids").unionByName(mixed.withColumn("sequence_id", F.col("sequence_id") * 2))
