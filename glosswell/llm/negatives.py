"""Hard negatives by inner product: exact search in an inverted multi-index.

Both halves of a vector have a codebook of their own; the pair of nearest codes is its cell. For a query,
no vector of code c scores more in a half than query . c + |query| radius(c). The two lists of these
bounds, best first, are walked as a multi-sequence: a heap gives the cells by falling sum of both. Once
the next sum is below what is still wanted, the rest need not be looked at, so results are exact.

Vectors are dealt into blocks of bounded size, and each block has an index, built once per search. Queries
are streamed to the blocks in small parts; each block answers with its own best, which are then ranked.
Positives are searched first; their scores are the windows in which negatives are looked for.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glosswell.llm.common import written

#: Codes of each half, fitted on this many vectors of a length, the first by hash; all are indexed.
CODES, SAMPLE_ROWS, ROUNDS = 16, 8_192, 8
#: Vectors of a block, bytes of a part of queries, and vectors that are scored at once.
BLOCK_ROWS, PART_BYTES, VISIT_ROWS = 4_096, 4_096, 512
#: Below this, sums of products are exact as doubles.
EXACT = float(1 << 53)


def fitted(values: np.ndarray) -> np.ndarray:
    """Up to CODES centres of ``values`` by Lloyd's rounds, from evenly spaced rows."""
    if not values.shape[1]:
        return np.zeros((1, 0))
    centres = np.unique(values, axis=0)
    centres = centres[np.linspace(0, len(centres) - 1, min(CODES, len(centres))).astype(int)].astype(float)
    for _ in range(ROUNDS):
        code = nearest_code(values, centres)
        for c in range(len(centres)):
            if (own := values[code == c]).size:
                centres[c] = own.mean(axis=0)
    return centres


def nearest_code(values: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(axis=1) - 2 * (values @ centres.T), axis=1)


class Half:
    """One half of the vectors of an index: codes in use, with centres and radii."""

    def __init__(self, values: np.ndarray, centres: np.ndarray):
        used, self.code = np.unique(nearest_code(values, centres), return_inverse=True)
        self.centres = centres[used]
        away = np.sqrt(((values - self.centres[self.code]) ** 2).sum(axis=1))
        self.radii = np.zeros(len(used))
        np.maximum.at(self.radii, self.code, away)
        self.largest = float(np.sqrt((values * values).sum(axis=1)).max(initial=0.0))

    def bounds(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes by falling upper bound of their scores, the bounds, and lower bounds of the same codes.
        A little is added for rounding."""
        length = math.sqrt(float(query @ query))
        middle, spread = self.centres @ query, self.radii * length
        slack = 1e-9 * length * (self.largest + float(self.radii.max(initial=0.0))) + 1e-6
        order = np.argsort(-(middle + spread), kind="stable")
        return order, (middle + spread + slack)[order], (middle - spread - slack)[order]


class Index:
    """Rows by cell. ``dim`` halves are the first dim // 2 components and the others."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, centres: tuple[np.ndarray, np.ndarray]):
        cut = vectors.shape[1] // 2
        values = vectors.astype(float)
        self.halves = Half(values[:, :cut], centres[0]), Half(values[:, cut:], centres[1])
        self.cut, self.width = cut, len(self.halves[1].centres)
        cell = self.halves[0].code * self.width + self.halves[1].code
        order = np.argsort(cell, kind="stable")
        self.rows, self.ids, self.vectors = rows[order], ids[order], vectors[order]
        self.values = values[order]
        self.starts = np.searchsorted(cell[order], np.arange(len(self.halves[0].centres) * self.width + 1)).tolist()
        self.peak = float(np.abs(values).max(initial=0.0))

    def scores(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products; beyond what doubles hold exactly, as Python's integers."""
        if len(query) * self.peak * float(np.abs(query.astype(float)).max(initial=0.0)) < EXACT:
            return (self.values[at] @ query.astype(float)).astype(np.int64)
        return self.vectors[at].astype(object) @ query.astype(object)

    def visit(self, query: np.ndarray) -> Iterator[tuple[float, float, np.ndarray]]:
        """Cells by falling bound: no row of this or any later cell scores more than the first number, none
        of this cell less than the second; its rows by place."""
        (x_code, x_high, x_low), (y_code, y_high, y_low) = (
            half.bounds(part) for half, part in zip(self.halves, (query[: self.cut].astype(float), query[self.cut :].astype(float)))
        )
        x_code, x_high, x_low, y_code, y_high, y_low = (v.tolist() for v in (x_code, x_high, x_low, y_code, y_high, y_low))
        heap = [(-x_high[0] - y_high[0], 0, 0)] if x_code and y_code else []
        while heap:
            bound, x, y = heapq.heappop(heap)
            if y + 1 < len(y_code):
                heapq.heappush(heap, (-x_high[x] - y_high[y + 1], x, y + 1))
            if y == 0 and x + 1 < len(x_code):
                heapq.heappush(heap, (-x_high[x + 1] - y_high[0], x + 1, 0))
            cell = x_code[x] * self.width + y_code[y]
            if self.starts[cell] < self.starts[cell + 1]:
                yield -bound, x_low[x] + y_low[y], np.arange(self.starts[cell], self.starts[cell + 1])

    def search(self, query: np.ndarray, windows: list[tuple[float, float]], k: int, own: int) -> list[list[tuple]]:
        """For each window (least, most) of scores, the first k (-score, id, row) in it by score, then
        id, then row, without the row ``own``."""
        best: list[list[tuple]] = [[] for _ in windows]
        cells, held, size = self.visit(query), [], 0
        ceiling = max((most for _, most in windows), default=-math.inf)
        for bound, floor, places in cells:
            # Rows still held back are scored before the bound of what comes next may end the search.
            if size >= VISIT_ROWS or all(self.certified(b, w, k, bound) for b, w in zip(best, windows)):
                self.take(np.concatenate(held) if held else places[:0], query, windows, best, k, own)
                held, size = [], 0
                if all(self.certified(b, w, k, bound) for b, w in zip(best, windows)):
                    return best
            if floor <= ceiling:
                held.append(places)
                size += len(places)
        if held:
            self.take(np.concatenate(held), query, windows, best, k, own)
        return best

    @staticmethod
    def certified(best: list[tuple], window: tuple[float, float], k: int, bound: float) -> bool:
        """Whether no row under ``bound`` can be among the first k of a window any more."""
        return bound < window[0] or window[0] > window[1] or (len(best) == k and bound < -best[-1][0])

    def take(self, at: np.ndarray, query: np.ndarray, windows: list, best: list[list[tuple]], k: int, own: int) -> None:
        at = at[self.rows[at] != own]
        scores = self.scores(at, query)
        for i, (least, most) in enumerate(windows):
            inside = (scores >= least) & (scores <= most)
            if len(best[i]) == k:
                inside &= scores >= -best[i][-1][0]
            new = at[inside]
            if len(new):
                found = zip((-scores[inside]).tolist(), self.ids[new].tolist(), self.rows[new].tolist())
                best[i] = heapq.nsmallest(k, [*best[i], *found])


class Block:
    """The vectors of a block; an index for those of a label, and one for those of any other."""

    def __init__(self, row: dict, dim: int):
        self.rows, self.ids, self.labels = (np.frombuffer(row[c], "<i8") for c in ("rows", "ids", "labels"))
        self.vectors = unpacked(row, dim)
        halves = (np.frombuffer(row[c], "<f8") for c in ("one", "two"))
        self.centres = tuple(x.reshape(-1, w) if w else np.zeros((1, 0)) for x, w in zip(halves, (dim // 2, dim - dim // 2)))
        self.known: dict[tuple[int, bool], Index] = {}

    def index(self, label: int, same: bool) -> Index:
        if (found := self.known.get((label, same))) is None:
            at = np.flatnonzero((self.labels == label) == same)
            if len(self.known) >= CODES:
                self.known.clear()
            found = self.known[label, same] = Index(self.rows[at], self.ids[at], self.vectors[at], self.centres)
        return found


def unpacked(row: dict, dim: int) -> np.ndarray:
    return np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(len(row["rows"]) // 8, dim).astype(np.int64)


def usable(vectors: DataFrame, scale: int) -> DataFrame:
    """row, vec_id, label, v, dim: rows that take part, with whole numbers as components."""
    v = F.col("embedding").cast("array<double>")
    return (
        vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), v.alias("v"))
        .where("vec_id is not null and label is not null and v is not null")
        .where("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
        .select(
            F.monotonically_increasing_id().alias("row"),
            "vec_id",
            "label",
            F.transform("v", lambda x: F.floor(x * scale)).alias("v"),
            F.size("v").alias("dim"),
        )
    )


PACKED = "dim int, part long, rows binary, ids binary, labels binary, vectors binary, width int"


def packed(rows: DataFrame, part: Column) -> DataFrame:
    """One row per length and part: rows, ids, labels and vectors as binaries, in the smallest integers that do."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        dim = table.column("dim")[0].as_py()
        values = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        peak = max(-int(values.min()), int(values.max()) + 1) if len(values) else 0
        width = next(w for w in (2, 4, 8) if peak <= 1 << (8 * w - 1))
        raw = lambda c: table.column(c).to_numpy().astype("<i8").tobytes()
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "part": pa.array([table.column("part")[0].as_py()], pa.int64()),
                "rows": [raw("row")],
                "ids": [raw("vec_id")],
                "labels": [raw("label")],
                "vectors": [values.astype(f"<i{width}").tobytes()],
                "width": pa.array([width], pa.int32()),
            }
        )

    return rows.withColumn("part", part).groupBy("dim", "part").applyInArrow(pack, PACKED)


def codebooks(rows: DataFrame) -> DataFrame:
    """dim, one, two: centres of both halves, per length of vectors."""

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        dim = table.column("dim")[0].as_py()
        values = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dim).astype(float)
        made = [fitted(values[:, a:b]).tobytes() for a, b in ((0, dim // 2), (dim // 2, dim))]
        return pa.table({"dim": pa.array([dim], pa.int32()), "one": [made[0]], "two": [made[1]]})

    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vec_id", "v"), "row"))
    sample = rows.withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS).select("dim", "row", "v")
    return sample.groupBy("dim").applyInArrow(fit, "dim int, one binary, two binary")


FOUND = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, vec_id long, score long"


def searched(blocks: DataFrame, n_blocks: int, asked: DataFrame, k: int, least: int | None = None, most: int = 0) -> DataFrame:
    """What every block has for every query of ``asked`` (dim, row, vec_id, label, v, positives).

    With ``least`` and ``most`` rows of other labels, for each positive those whose score is between so
    many hundredths of the positive's; without, rows of the same label."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block = None, None
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["kind"] == 0:
                    name, block = (row["dim"], row["part"]), Block(row, row["dim"])
                    continue
                if name != (row["dim"], row["part"]):
                    continue  # the block has no vectors of this length
                ids, labels, queries = (np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), unpacked(row, row["dim"]))
                for a, anchor, label, query, positives in zip(np.frombuffer(row["rows"], "<i8").tolist(), ids.tolist(), labels.tolist(), queries, row["positives"]):
                    if least is None:
                        (best,) = block.index(label, True).search(query, [(-math.inf, math.inf)], k, a)
                        out.extend((a, anchor, None, None, None, r, v, -s) for s, v, r in best)
                        continue
                    windows = [(-(-least * p["score"] // 100), most * p["score"] // 100) for p in positives]
                    for p, best in zip(positives, block.index(label, False).search(query, windows, k, a)):
                        out.extend((a, anchor, p["row"], p["vec_id"], p["score"], r, v, -s) for s, v, r in best)
            if out:
                names = [f.split(" ")[0] for f in FOUND.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)

    none = F.lit(None).cast("binary")
    kind = "array<array<struct<score:long,vec_id:long,row:long>>>"
    columns = ["dim", "part", "kind", "rows", "ids", "labels", "vectors", "width", "one", "two", "positives"]
    held = blocks.withColumns({"kind": F.lit(0), "positives": F.lit(None).cast(kind)}).select(*columns)
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))
    asking = asked.withColumns({"part": every, "kind": F.lit(1), "one": none, "two": none}).select(*columns)
    met = held.unionByName(asking).repartition(n_blocks, "dim", "part").sortWithinPartitions("dim", "part", "kind")
    return met.mapInArrow(search, FOUND)


def parts_of(anchors: DataFrame, count: int) -> DataFrame:
    """Anchors (dim, row, vec_id, label, v, positives) in parts of about PART_BYTES of vectors."""
    size = F.greatest(F.lit(1), F.floor(F.lit(PART_BYTES) / (2 * F.greatest(F.col("dim"), F.lit(1)))))
    part = F.pmod(F.xxhash64("row"), F.greatest(F.lit(1), F.ceil(F.lit(count) / size)).cast("long"))
    plain = packed(anchors.drop("positives"), part)
    listed = anchors.withColumn("part", part).groupBy("dim", "part").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("row", "positives"))), lambda x: x["positives"]).alias("positives")
    )
    return plain.join(listed, ["dim", "part"]).drop("part")


def hard_negatives(
    vectors: DataFrame, every: int = 100, scale: int = 256, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x) and scores are integer inner products of these. Anchors are rows
    whose vec_id ``every`` divides. An anchor's positives are its first ``positives`` other rows of the
    same label, by falling score, then vec_id; for each, negatives are the first ``negatives`` rows of other
    labels whose score is at least ``least`` and at most ``most`` hundredths of the positive's (none, where
    that is below zero). ``rank`` counts from 1.

    Rows with a null vec_id, label or embedding, or with a null or non-finite component take no part. Every
    other row does, also where several have one vec_id; such rows are told apart and tie in any order.
    Vectors meet those of their own length only; empty ones score 0. Components beyond a long are cut to
    one, scores beyond a long fail. An empty table gives no rows. Further columns are not read.
    """
    rows = written(usable(vectors, scale), "vectors")
    n_blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    blocks = packed(rows, F.pmod(F.xxhash64("row"), F.lit(n_blocks))).join(codebooks(rows), "dim")
    blocks = written(blocks, "blocks")
    anchors = rows.where(F.col("vec_id") % every == 0)
    count = anchors.count()
    no_positives = F.lit(None).cast("array<struct<score:long,vec_id:long,row:long>>")
    near = searched(blocks, n_blocks, parts_of(anchors.withColumn("positives", no_positives), count), positives)
    place = F.row_number().over(Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id", "row"))
    own = (
        near.withColumn("place", place)
        .where(F.col("place") <= positives)
        .groupBy(F.col("anchor_row").alias("row"))
        .agg(F.collect_list(F.struct("score", "vec_id", "row")).alias("positives"))
    )
    asked = written(parts_of(anchors.join(own, "row"), count), "anchors")
    far = searched(blocks, n_blocks, asked, negatives, least, most)
    place = F.row_number().over(Window.partitionBy("anchor_row", "positive_row").orderBy(F.desc("score"), "vec_id", "row"))
    return (
        far.withColumn("rank", place)
        .where(F.col("rank") <= negatives)
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )
