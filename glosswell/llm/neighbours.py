"""Nearest vectors by cosine: collision counting over sorted projections.

Each block of vectors is projected onto a fixed set of random directions, one sorted array per
direction. A query opens a window around its own projection in every array and widens all of them
step by step, which rehashes virtually: a vector collides in an array once the window reaches it.
Vectors that collide in enough arrays are verified on their original values. A query is done in a block
when a vector as near as its k-th best would have been verified almost surely; where fewer than k have
been found, windows open until all vectors have.

A sorted array is kept as the sets, in bits, of the vectors before each of its marks. A window is the
difference of two of them, to the marks around it, and collisions of all vectors are counted at once, in binary
numbers whose digits lie in one set each.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from glosswell.llm.common import hand_back, written

ARRAYS = 128
#: Share of the arrays in which a vector has to collide.
THRESHOLD = 0.55
#: Standard deviations by which a vector as near as the k-th best should be over the threshold.
MARGIN = 1.0
WIDTHS = 0.7 * 1.12 ** np.arange(20)
#: Marks of a sorted array, and vectors of a block that show at which width searches begin.
MARKS, TRIED = 128, 8
#: A block has at most so many rows, on average, and bytes; up to SPREAD blocks, so many rows at least.
BLOCK_ROWS, BLOCK_BYTES, LEAST_ROWS, SPREAD = 32_768, 16 << 20, 8_192, 32
#: Rows and bytes of a part of queries, parts that meet a block in one task, and partitions of blocks at most.
QUERY_ROWS, QUERY_BYTES, PARTS, SHARES = 1_024, 1 << 20, 64, 256


@functools.lru_cache(maxsize=4)
def directions(dim: int) -> np.ndarray:
    """ARRAYS unit directions, orthogonal in groups; the same for all blocks."""
    width = min(dim, ARRAYS)
    drawn = np.random.default_rng(dim)
    bases = [np.linalg.qr(drawn.standard_normal((dim, width)))[0] for _ in range(-(-ARRAYS // dim))]
    return np.concatenate(bases, axis=1)[:, :ARRAYS] * math.sqrt(dim)


def surely(width: float, distance: float) -> bool:
    """Whether a vector at this distance collides in enough arrays, by MARGIN deviations."""
    p = math.erf(width / max(distance, 1e-9) / math.sqrt(2))
    return p - MARGIN * math.sqrt(p * (1 - p) / ARRAYS) >= THRESHOLD


def level(vectors: np.ndarray) -> np.ndarray:
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0.0))[1])


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in the same order of operations, so equal vectors have equal cosines. Powers of two are
    taken out first, which changes nothing but what would leave the range of doubles."""
    vectors, query = level(vectors), level(query[None])[0]
    dots = (vectors * query).sum(axis=1)
    return dots / (np.sqrt((vectors * vectors).sum(axis=1)) * math.sqrt((query * query).sum()))


def at_least(rows: np.ndarray, least: int) -> np.ndarray:
    """Bits that are set in ``least`` rows or more. Rows are added in pairs, as numbers of growing length."""
    digits, count = [rows], len(rows)
    while count > 1:
        if count % 2:
            digits, count = [np.concatenate([d, np.zeros_like(d[:1])]) for d in digits], count + 1
        count //= 2
        summed, carry = [], None
        for d in digits:
            a, b = d[:count], d[count:]
            either, both = a ^ b, a & b
            summed.append(either if carry is None else either ^ carry)
            carry = both if carry is None else both | (either & carry)
        digits = [*summed, carry]
    more, same = np.zeros_like(rows[0]), ~np.zeros_like(rows[0])
    if least >> len(digits):
        return more
    for i in reversed(range(len(digits))):
        d = digits[i][0]
        if least >> i & 1:
            same = same & d
        else:
            more, same = more | (same & d), same & ~d
    return more | same


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = level(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def bits_of(flags: np.ndarray) -> np.ndarray:
    """The last axis of ``flags`` in words of 64 bits."""
    packed = np.packbits(flags, axis=-1, bitorder="little")
    wide = np.zeros((*packed.shape[:-1], -(-packed.shape[-1] // 8) * 8), np.uint8)
    wide[..., : packed.shape[-1]] = packed
    return wide.view(np.uint64)


def merged(k: int, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The k best of every row, ties to smaller ids; what has both in common counts once. Free places are -inf."""
    order = np.lexsort((ids, -scores))
    ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    scores[:, 1:][(ids[:, 1:] == ids[:, :-1]) & (scores[:, 1:] == scores[:, :-1])] = -np.inf
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


class Block:
    """The index of some vectors, for searches of their k best."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        n, dim = vectors.shape
        self.axes = directions(dim)
        unit = units(vectors.astype(float))
        # Rough cosines are within half of this of exact ones.
        self.unit, self.slack = unit.astype(np.float32), (dim + 4) * 2.0**-22
        projected = (unit @ self.axes).T.copy()
        del unit
        marks = min(n, MARKS)
        at = np.arange(marks + 1) * n // marks
        self.fine = marks == n
        self.edges = np.empty((ARRAYS, marks))
        self.sets = np.zeros((ARRAYS, marks + 1, -(-n // 64)), np.uint64)
        piece = np.empty(n, np.int16)
        for j, own in enumerate(projected):
            order = np.argsort(own, kind="stable")
            self.edges[j] = own[order[at[:-1]]]
            piece[order] = np.repeat(np.arange(marks, dtype=np.int16), np.diff(at))
            self.sets[j, 1:] = bits_of(piece < np.arange(1, marks + 1, dtype=np.int16)[:, None])
        self.lines = np.arange(ARRAYS) * (marks + 1)
        self.sets = self.sets.reshape(ARRAYS * (marks + 1), -1)
        self.first = 1
        tried = np.linspace(0, n - 1, min(n, TRIED)).astype(int)
        # One step before half of them are done; what is wider than a search needs verifies more, never less.
        self.first = max(1, int(np.median([self.walk(ids[i], vectors[i].astype(float))[2] for i in tried])) - 1)

    def reached(self, at: np.ndarray, width: float) -> np.ndarray:
        """Bits of the vectors that collide in enough arrays."""
        low, high = ((self.edges < (at + side)[:, None]).sum(axis=1) for side in (-width, width))
        if not self.fine:  # the mark before where the window begins
            low = np.maximum(low - 1, 0)
        windows = self.sets.take(self.lines + high, axis=0)
        windows ^= self.sets.take(self.lines + low, axis=0)
        return at_least(windows, math.ceil(THRESHOLD * ARRAYS))

    def walk(self, query_id: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Places and cosines of the k best that were found, and the step at which the search was done."""
        n, k = len(self.ids), self.k
        unit = units(query[None])[0]
        at, rough = unit @ self.axes, unit.astype(np.float32)
        every = bits_of(np.ones(n, bool))
        seen = bits_of(self.ids == query_id)
        found, scores = np.zeros(0, np.int64), np.zeros(0)
        last = len(WIDTHS) + 1
        for step in range(self.first, last + 1):
            new = (self.reached(at, WIDTHS[step - 1]) if step < last else every) & ~seen
            seen = seen | new
            places = np.flatnonzero(np.unpackbits(new.view(np.uint8), count=n, bitorder="little"))
            if len(places) > k:
                near = self.unit.take(places, axis=0) @ rough
                least = float(np.partition(near, -k)[-k])
                if len(found) == k:
                    least = max(least, float(scores.min()))
                places = places[near >= least - self.slack]
            found = np.concatenate([found, places])
            scores = np.concatenate([scores, cosines(self.vectors[places].astype(float), query)])
            if len(found) > k:
                best = np.lexsort((self.ids[found], -scores))[:k]
                found, scores = found[best], scores[best]
            if len(found) == k and step < last and surely(WIDTHS[step - 1], math.sqrt(max(0.0, 2 - 2 * scores.min()))):
                break
        return found, scores, step

    def search(self, query_id: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the block's k best, ties to smaller ids."""
        found, scores, _ = self.walk(query_id, query)
        best = np.lexsort((self.ids[found], -scores))
        return self.ids[found[best]], scores[best]


def narrow(vectors: DataFrame) -> bool:
    kind = vectors.schema["embedding"].dataType
    return isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v, dim: rows that take part, repeated rows once. v is float[] where it was, else double[]."""
    v = F.col("embedding").cast(f"array<{'float' if narrow(vectors) else 'double'}>")
    return (
        vectors.select(F.col("vec_id").cast("long"), v.alias("v"))
        .where("vec_id is not null and v is not null and size(v) > 0")
        .where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
        .distinct()
        .withColumn("dim", F.size("v"))
    )


def packed(rows: DataFrame, name: str, group: str) -> DataFrame:
    """One row per (dim, group): the ids and vectors as binary."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("vec_id")
        values = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return pa.table(
            {
                "dim": pa.array([table.column("dim")[0].as_py()], pa.int32()),
                group: pa.array([table.column(group)[0].as_py()], pa.int64()),
                f"{name}_ids": [table.column("vec_id").to_numpy().astype("<i8").tobytes()],
                f"{name}_vectors": [values.astype(values.dtype.newbyteorder("<")).tobytes()],
            }
        )

    return rows.groupBy("dim", group).applyInArrow(
        pack, f"dim int, {group} long, {name}_ids binary, {name}_vectors binary"
    )


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors, by cosine, of every vector whose vec_id
    ``every`` divides, among all others.

    Nearest first, ties to smaller ids; fewer than k only if there are fewer candidates. Scores are
    exact, in double precision, on the original values; which vectors are verified is subject to the
    index, with a recall of about 0.99. Rows whose id or embedding is null, or whose embedding is
    empty, all zeros, or holds a null or a value that is not finite take no part. Repeated rows count
    once; a query's own id is never its neighbour. Vectors meet those of their own length only. An
    empty table gives no rows. Further columns are not read.

    The query set grows with the table. A task holds one block of vectors at a time, builds its index once,
    has queries streamed to it and keeps the best of its blocks. Partitions of blocks and of queries meet in
    pairs: neither is shuffled again for the others, and no more than SHARES times k rows a query leave the tasks.
    """
    spark = vectors.sparkSession
    kind, size = ("<f4", 4) if narrow(vectors) else ("<f8", 8)
    rows = written(usable(vectors), "vectors")
    count, values = rows.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    blocks = max(1, -(-count // BLOCK_ROWS), -(-values * size // BLOCK_BYTES), min(-(-count // LEAST_ROWS), SPREAD))
    dealt = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))
    shares = min(blocks, SHARES)
    indexed = packed(rows.withColumn("block", dealt), "own", "block")
    indexed = indexed.repartitionById(shares, (F.col("block") % shares).cast("int"))

    asked = rows.where(F.col("vec_id") % every == 0)
    count, values = asked.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    parts = max(1, -(-count // QUERY_ROWS), -(-values * size // QUERY_BYTES))
    queries = packed(asked.withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts))), "query", "part")
    queries = queries.withColumnRenamed("dim", "query_dim")
    # Each partition of queries has one more row, which comes first and brings a block's vectors.
    folders = -(-parts // PARTS)
    first = spark.range(folders).select(F.lit(-1).cast("long").alias("part"), F.col("id").alias("folder"))
    queries = queries.withColumn("folder", F.floor(F.col("part") / PARTS)).unionByName(first, allowMissingColumns=True)
    asking = queries.repartitionById(folders, F.col("folder").cast("int"))
    met = indexed.join(asking, (F.col("part") < 0) | (F.col("dim") == F.col("query_dim")))
    brought = [F.when(F.col("part") < 0, F.col(c)).alias(c) for c in ("own_ids", "own_vectors")]
    met = met.select("dim", "block", "part", *brought, "query_ids", "query_vectors").sortWithinPartitions("dim", "block", "part")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, own, block = None, None, None
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

        def told() -> Iterator[pa.RecordBatch]:
            for asked, ids, scores in best.values():
                there = scores > -np.inf
                columns = [np.broadcast_to(asked[:, None], ids.shape)[there], ids[there], scores[there]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])
            best.clear()

        for batch in batches:
            for row in (batch.slice(i, 1) for i in range(batch.num_rows)):
                dim, number, part = (row.column(c)[0].as_py() for c in ("dim", "block", "part"))
                value = lambda c, kind: np.frombuffer(row.column(c)[0].as_py(), kind)
                if part < 0:
                    if name != (dim, number):
                        if name and name[0] != dim:
                            yield from told()
                        name, block = (dim, number), None
                        own = value("own_ids", "<i8"), value("own_vectors", kind).reshape(-1, dim)
                    continue
                if name != (dim, number):
                    raise RuntimeError("queries came before the vectors of their block")
                if block is None:
                    block = Block(*own, k)
                asked = value("query_ids", "<i8")
                ids, scores = np.zeros((len(asked), k), np.int64), np.full((len(asked), k), -np.inf)
                for i, (q, v) in enumerate(zip(asked, value("query_vectors", kind).reshape(-1, dim).astype(float))):
                    near, cosine = block.search(q, v)
                    ids[i, : len(near)], scores[i, : len(near)] = near, cosine
                if part in best:
                    ids, scores = merged(k, np.hstack([best[part][1], ids]), np.hstack([best[part][2], scores]))
                best[part] = asked, ids, scores
        yield from told()
        del own, block
        hand_back()

    # One shuffle by query serves what follows.
    found = met.mapInArrow(search, "query_id long, vec_id long, score double").repartition("query_id").distinct()
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
