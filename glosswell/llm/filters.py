"""Bit filters of a fixed size that every task may hold."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswell.llm.common import hand_back, slices

#: Bits of one row that is sent to the driver.
CHUNK_LOG2 = 20
#: The same of a pair of filters; their chunks are merged by as many tasks as there are partitions.
PAIR_LOG2 = 17


class SeenOnceTwice:
    """Two Bloom filters of 2 ** ``log2`` bits: positions seen, and positions seen again.

    ``add`` takes one row of positions per thing; a thing added twice has all its positions in ``twice``.
    """

    def __init__(self, log2: int):
        self.once = np.zeros(max(1, (1 << log2) // 8), np.uint8)
        self.twice = np.zeros_like(self.once)

    def add(self, positions: np.ndarray) -> None:
        at, times = np.unique(positions, return_counts=True)
        again = at[(times > 1) | is_set(self.once, at)]
        for bits, new in ((self.twice, again), (self.once, at)):
            np.bitwise_or.at(bits, new >> 3, np.uint8(1) << (new & 7).astype(np.uint8))

    def merge(self, once: np.ndarray, twice: np.ndarray, begin: int) -> None:
        """Take in a stretch of another pair: what both have seen is seen twice."""
        held = slice(begin, begin + len(once))
        self.twice[held] |= twice | (self.once[held] & once)
        self.once[held] |= once


def seen_twice(df: DataFrame, positions: Callable[[pa.RecordBatch], np.ndarray], log2: int, sized: str) -> bytes:
    """The filter of positions seen twice in ``df``, of 2 ** ``log2`` bits; its size is all that is collected.

    Every task fills a pair of filters of its own; their chunks are compressed, dealt by place and merged
    as they come, so a task holds its own chunks however many tasks there were.
    """
    chunk_log2 = min(PAIR_LOG2, max(3, log2))
    size = (1 << chunk_log2) // 8
    kinds = pa.schema([("chunk", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pair, pack = SeenOnceTwice(log2), zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches, sized):
            pair.add(positions(part))
        for chunk in np.flatnonzero(pair.once.reshape(-1, size).any(axis=1)).tolist():
            own = slice(chunk * size, (chunk + 1) * size)
            made = [[chunk], [pack(pair.once[own].tobytes())], [pack(pair.twice[own].tobytes())]]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(made, kinds)], schema=kinds)
        del pair
        hand_back()

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, held = zstandard.ZstdDecompressor().decompress, {}
        for batch in batches:
            for chunk, *packed in zip(*(batch.column(c).to_pylist() for c in kinds.names)):
                pair = held.setdefault(chunk, SeenOnceTwice(chunk_log2))
                pair.merge(*(np.frombuffer(unpack(x), np.uint8) for x in packed), 0)
        for chunk, pair in held.items():
            if pair.twice.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([pair.twice.tobytes()])], ["chunk", "bits"])

    filled = df.mapInArrow(fill, "chunk int, once binary, twice binary").repartition("chunk")
    out = bytearray(max(1, (1 << log2) // 8))
    for row in filled.mapInArrow(join, "chunk int, bits binary").collect():
        out[row.chunk * size : (row.chunk + 1) * size] = row.bits
    return bytes(out)


def collected_bits(positions: DataFrame, column: str, log2: int) -> bytes:
    """A filter of 2 ** ``log2`` bits with the given positions set; its size is all that is collected.

    Positions are joined to words of 64 bits before they are shuffled.
    """
    words = (
        positions.select(F.col(column).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    )
    per_row = 1 << (min(CHUNK_LOG2, log2) - 6)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            at, bits = (batch.column(c).to_numpy() for c in ("word", "bits"))
            for chunk in np.unique(at // per_row):
                own = at // per_row == chunk
                held.setdefault(int(chunk), np.zeros(per_row, "<i8"))[at[own] % per_row] |= bits[own]
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int64()), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                ["chunk", "bits"],
            )

    parts = -(-(1 << log2) // (1 << CHUNK_LOG2))
    packed = words.repartition(min(parts, 64), F.expr(f"word div {per_row}")).mapInArrow(pack, "chunk long, bits binary")
    out = bytearray(max(1, (1 << log2) // 8))
    for row in packed.toLocalIterator():
        out[row.chunk * per_row * 8 : (row.chunk + 1) * per_row * 8] = row.bits
    return bytes(out)


def is_set(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether each position of ``at`` is set in a filter read as bytes."""
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
