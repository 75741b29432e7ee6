"""Near duplicates: a Jaccard join over word shingles, as a blocked sparse matrix product.

The matrix has a row per distinct set of shingles and a column per shingle; copies are left out before
it is made, but for what a filter lets through. It is dealt into column blocks, each of which tells its
rows how often their shingles occur; what occurs once cannot overlap and is left out. An entry names its
row by slice and place, so it takes the same few bytes whatever the number of blocks. By size, a pair
that is similar enough shares one of the few rarest shingles of either side, so the product is formed
over these columns alone. Pairs are discarded by bounds from sizes and positions, what is left is counted
in full. Sets lie in buckets by id, so a round shuffles pairs and not all sets.

Only components are wanted, so the pairs of a column are not all formed. Columns take their rows
against one pivot, the one with the fewest shingles of its own, then against more each round, and
leave out what is already known to be connected. A group of any number of near copies costs about one pair each; a pair that
no chain of links connects is still compared, at the latest when every row has been a pivot.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glosswell.llm.common import dropped, hand_back, map_rows, written, written_by
from glosswell.llm.components import components
from glosswell.llm.filters import collected_bits, is_set
from glosswell.llm.words import SPACED, runs, texts_words

WIDTH, PERCENT = 5, 75
#: Shingles of a column block, on average.
BLOCK_SHINGLES = 2_500_000
#: Shingles for each bucket of sets, as long as there are fewer buckets than shuffle partitions.
BUCKET_SHINGLES = 20_000
#: A shingle in this share of all documents is counted beside the blocks; at most 1 / share times
#: the shingles of a mean document are, and all others are at most this share of a block's rows.
COMMON_SHARE = 0.005
#: Copies beyond this share of all documents are left out of the matrix where they arise; at most
#: 1 / share sets have so many.
FREQUENT_SHARE = 0.001
#: Pivots of a column: one, then so many times more each round.
MORE_PIVOTS = 16
#: Shingles of each row in the first round, which connects most copies.
FIRST_SHINGLES = 4
LOW_BITS = 48
#: Bits of the filter of first copies for each set, and as a power of two at most (32 MB). Size moves work, never results.
FILTER_BITS, FILTER_LOG2 = 8, 28
#: More sets than this with a shingle count as so many; the number only puts shingles in order.
MOST_TIMES = (1 << 16) - 1


def sets_of(texts: list[str | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles in order, one after another, and where each text's begin. A
    text of fewer words is one shingle."""
    _, hashes, _, _, bounds = texts_words(texts, SPACED)
    found, at = runs(hashes, bounds, width)
    rows = np.searchsorted(bounds, at, "right") - 1
    counts = np.diff(bounds)
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        own, _ = runs(hashes[bounds[i] : bounds[i + 1]], np.array([0, counts[i]]), int(counts[i]))
        found, rows = np.append(found, own), np.append(rows, i)
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])
    found, rows = found[first], rows[first]
    return found, np.searchsorted(rows, np.arange(len(texts) + 1))


def prints(found: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 128-bit name of each set, as two integers."""
    names = b"".join(blake2b(found[a:b].tobytes(), digest_size=16).digest() for a, b in zip(starts, starts[1:]))
    return np.frombuffer(names, "<i8").reshape(-1, 2)


def outlines(documents: DataFrame, width: int) -> DataFrame:
    """doc_id, n, a, b, common: set sizes and names; each slice's frequent shingles with their
    number of sets at its first row."""

    def work(part: pa.RecordBatch) -> dict:
        found, starts = sets_of(part.column("text").to_pylist(), width)
        names = prints(found, starts)
        _, kept = np.unique(names, axis=0, return_index=True)
        chosen = np.concatenate([found[starts[i] : starts[i + 1]] for i in kept])
        keys, times = np.unique(chosen, return_counts=True)
        often = times >= max(3, COMMON_SHARE * len(kept))
        common: list = [None] * part.num_rows
        common[0] = [{"key": int(k), "times": int(t)} for k, t in zip(keys[often].astype(np.int64), times[often])]
        return {"doc_id": part.column("doc_id"), "n": np.diff(starts), "a": names[:, 0], "b": names[:, 1], "common": common}

    return map_rows(documents, work, "doc_id long, n long, a long, b long, common array<struct<key:long,times:long>>", "text")


def column_of(found: np.ndarray, columns: int) -> np.ndarray:
    return ((found >> np.uint64(LOW_BITS)) * np.uint64(columns) >> np.uint64(64 - LOW_BITS)).astype(np.int64)


def binaries(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of ``values``, one binary from each cut to the next."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype("<i4")), pa.py_buffer(raw)])


def joined(table: pa.Table, column: str, kind: str) -> np.ndarray:
    """A binary column's rows as one array, without a Python object for each."""
    chunks = [c.buffers()[2] for c in table.column(column).chunks if len(c)]
    spans = [
        (np.frombuffer(c.buffers()[1], "<i4")[c.offset], np.frombuffer(c.buffers()[1], "<i4")[c.offset + len(c)])
        for c in table.column(column).chunks
        if len(c)
    ]
    return np.frombuffer(b"".join(memoryview(x)[a:z] for x, (a, z) in zip(chunks, spans) if z > a), kind)


def low_bytes(keys: np.ndarray) -> np.ndarray:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : LOW_BITS // 8]


def from_low_bytes(raw: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(raw) // (LOW_BITS // 8), 8), np.uint8)
    keys[:, : LOW_BITS // 8] = raw.reshape(-1, LOW_BITS // 8)
    return keys.view("<u8")[:, 0]


def first_copies(classes: DataFrame, log2: int) -> bytes:
    """A filter of 2 ** ``log2`` bits of each set's name with its smallest document."""
    doc, mask = F.coalesce("first", F.lit(-1)), (1 << log2) - 1
    at = F.array(*(F.col(c).bitwiseXOR(doc).bitwiseAND(F.lit(mask)) for c in "ab"))
    return collected_bits(classes.select(F.explode(at).alias("at")), "at", log2)


class Sets:
    """The sets of a slice that go into the matrix, by place: one of each name, that of the smallest
    document. Of copies in other slices the filter lets some through, but none of a frequent set."""

    def __init__(self, part: pa.RecordBatch, width: int, frequent: dict, first: np.ndarray, log2: int):
        found, starts = sets_of(part.column("text").to_pylist(), width)
        names, sizes = prints(found, starts), np.diff(starts)
        ids = pc.fill_null(part.column("doc_id"), -1).to_numpy(zero_copy_only=False)
        wanted = (sizes > 0) & is_set(first, (names ^ ids[:, None]) & ((1 << log2) - 1)).all(axis=1)
        if frequent:
            for i, (name, doc) in enumerate(zip(map(tuple, names.tolist()), part.column("doc_id").to_pylist())):
                if name in frequent:
                    wanted[i] &= doc == frequent[name]
        own = np.flatnonzero(wanted)
        own = np.sort(own[np.unique(names[own], axis=0, return_index=True)[1]])
        self.names, self.sizes = names[own], sizes[own]
        place = np.full(len(sizes), -1)
        place[own] = np.arange(len(own))
        rows = np.repeat(place, sizes)
        self.found, self.rows = found[rows >= 0], rows[rows >= 0]


MATRIX = "block long, slice long, names binary, sizes binary, low binary, high binary, keys binary, times binary"


def blocks(documents: DataFrame, width: int, columns: int, common: np.ndarray, times: np.ndarray, frequent: dict, first: bytes, log2: int) -> DataFrame:
    """The matrix by column blocks and slices: of each entry its set's place in the slice, a column for
    each byte of it, and the low bits of its shingle. Each slice has a head besides, under a negative
    block: names and sizes of its sets, and its common shingles with their numbers of sets."""
    held = documents.sparkSession.sparkContext.broadcast((common, times, frequent, first))

    def work(part: pa.RecordBatch) -> dict | None:
        shingles, known, frequent, bits = held.value
        sets = Sets(part, width, frequent, np.frombuffer(bits, np.uint8), log2)
        if not len(sets.found):
            return None
        names = sets.names.astype("<i8").tobytes()
        # By content: what is read again in the same order has the same name, and a repeated slice counts once.
        name = int.from_bytes(blake2b(names, digest_size=8).digest(), "little", signed=True)
        often = np.isin(sets.found, shingles)
        found, rows = sets.found[~often], sets.rows[~often]
        column = column_of(found, columns)
        order = np.argsort(column, kind="stable")
        found, rows, column = found[order], rows[order], column[order]
        cuts = np.flatnonzero(np.diff(column, prepend=-1, append=-1)) if len(column) else np.zeros(1, np.int64)
        n, extra = len(cuts) - 1, sets.found[often]
        places = np.concatenate([rows, sets.rows[often]]).astype("<u2")
        keys = (extra & np.uint64((1 << LOW_BITS) - 1)) | (column_of(extra, columns) << LOW_BITS).astype(np.uint64)
        raw = np.concatenate([low_bytes(found).reshape(-1), keys.astype("<u8").view(np.uint8)])
        entries = np.append(cuts, len(places))
        return {
            "block": np.append(column[cuts[:-1]], -1 - name % columns),
            "slice": np.full(n + 1, name),
            "names": [None] * n + [names],
            "sizes": [None] * n + [sets.sizes.astype("<i4").tobytes()],
            "low": binaries((places & 255).astype(np.uint8), entries),
            "high": binaries((places >> 8).astype(np.uint8), entries),
            "keys": binaries(raw, np.append(cuts * (LOW_BITS // 8), len(raw))),
            "times": [None] * n + [np.minimum(known[np.searchsorted(shingles, extra)], MOST_TIMES).astype("<u2").tobytes()],
        }

    return map_rows(documents, work, MATRIX, "text")


def counted(table: pa.Table) -> pa.Table:
    """Counts a column block: by slices, the shingles of each set that another set has too, and in
    how many sets they are. Heads go on as they are."""
    block = table.column("block")[0].as_py()
    if block < 0:
        return table
    names, kept = np.unique(table.column("slice").to_numpy(), return_index=True)
    if len(kept) < table.num_rows:
        table = table.take(pa.array(kept))
    else:
        names = table.column("slice").to_numpy()
    keys = from_low_bytes(joined(table, "keys", np.uint8))
    again, times = np.unique(keys, return_counts=True)
    again, times = again[times > 1], times[times > 1]
    at = np.minimum(np.searchsorted(again, keys), max(len(again) - 1, 0))
    shared = again[at] == keys if len(again) else np.zeros(len(keys), bool)
    keys, times = keys[shared], times[at[shared]] if len(again) else at[shared]
    del again, at
    rows = np.repeat(np.arange(table.num_rows), pc.binary_length(table.column("low")).to_numpy())[shared]
    own = np.unique(rows)
    cuts = np.append(np.searchsorted(rows, own), len(rows))
    none = pa.nulls(len(own), pa.binary())
    made = pa.table(
        {
            "block": pa.array(np.full(len(own), block), pa.int64()),
            "slice": pa.array(names[own], pa.int64()),
            "names": none,
            "sizes": none,
            "low": binaries(joined(table, "low", np.uint8)[shared], cuts),
            "high": binaries(joined(table, "high", np.uint8)[shared], cuts),
            "keys": binaries(low_bytes(keys), cuts * (LOW_BITS // 8)),
            "times": binaries(np.minimum(times, MOST_TIMES).astype("<u2"), cuts * 2),
        }
    )
    del table, keys, times, rows, shared
    hand_back()
    return made


def needed(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles that a set of each size has to share at least."""
    return -(-percent * size // 100)


def candidates_of(percent: int):
    """Puts a slice together: sets whose rarest shingles are not all their own. ``keys`` are those
    of other sets too, the rarest first; ``prefix`` the first of them, of which a similar set has to
    share one."""

    def work(table: pa.Table) -> pa.Table:
        is_head = pc.less(table.column("block"), 0)
        heads, rest = table.filter(is_head), table.filter(pc.invert(is_head))
        if not heads.num_rows:
            raise ValueError("a task that was run again got the documents in another order: write them first")
        head = heads.slice(0, 1)  # slices of the same name are alike
        names, sizes = joined(head, "names", "<i8").reshape(-1, 2), joined(head, "sizes", "<i4").astype(np.int64)
        block = np.repeat(rest.column("block").to_numpy(), pc.binary_length(rest.column("low")).to_numpy())
        keys = from_low_bytes(joined(rest, "keys", np.uint8)) | (block << LOW_BITS).astype(np.uint64)
        both = pa.concat_tables([rest, head])
        rows = joined(both, "low", np.uint8) | joined(both, "high", np.uint8).astype(np.int64) << 8
        keys = np.concatenate([keys, joined(head, "keys", "<u8")]).view("<i8")
        times = joined(both, "times", "<u2")
        order = np.lexsort((keys, times, rows))
        rows, keys = rows[order], keys[order]
        once = np.ones(len(rows), bool)
        once[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
        rows, keys = rows[once], keys[once]
        out: dict = {"a": [], "b": [], "n": [], "keys": [], "prefix": []}
        cuts = np.searchsorted(rows, np.arange(len(names) + 1))
        own = sizes - np.diff(cuts)  # come first
        length = sizes - needed(sizes, percent) + 1 - own
        for i in np.flatnonzero(length > 0).tolist():
            held = keys[cuts[i] : cuts[i + 1]]
            for c, v in zip(out, (int(names[i, 0]), int(names[i, 1]), int(sizes[i]), held, held[: length[i]])):
                out[c].append(v)
        made = pa.table({c: pa.array(v, pa.int64() if c in "abn" else pa.list_(pa.int64())) for c, v in out.items()})
        del out, keys, times, rows
        hand_back()
        return made

    return work


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (low, high) whose sets are similar enough, counted in full."""

    def work(part: pa.RecordBatch) -> dict:
        keys, others, n, m = (part.column(c) for c in ("keys", "keys_2", "n", "n_2"))
        right = []
        for i in range(part.num_rows):
            shared = len(np.intersect1d(keys[i].values.to_numpy(), others[i].values.to_numpy(), assume_unique=True))
            right.append(100 * shared >= percent * (n[i].as_py() + m[i].as_py() - shared))
        kept = pa.array(right, pa.bool_())
        return {c: part.column(c).filter(kept) for c in ("low", "high")}

    one = sets.select(F.col("id").alias("low"), "n", "keys")
    two = sets.select(F.col("id").alias("high"), F.col("n").alias("n_2"), F.col("keys").alias("keys_2"))
    return map_rows(pairs.join(one, "low").join(two, "high"), work, "low long, high long")


def linked(sets: DataFrame, percent: int) -> DataFrame:
    """id, component of the sets (id, n, keys, prefix) that are similar to another one, directly or by a
    chain. ``sets`` is best written by id."""
    known = sets.select("id", F.col("id").alias("component"))
    columns = ["own", "id", "n", "component", "shared", "at"]
    entries = sets.select(
        (F.col("n") - F.size("keys")).alias("own"),
        "id",
        "n",
        F.size("keys").alias("shared"),
        F.posexplode("prefix").alias("at", "key"),
    )
    low, high, width = 0, 1, FIRST_SHINGLES
    while True:
        rows = entries.where(F.col("at") < width).join(known, "id")
        # Columns whose rows are not all connected yet.
        open_keys = (
            rows.groupBy("key")
            .agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows"))
            .where("x <> y")
        )
        open_keys = written(open_keys.where(F.col("rows") > low), "columns")
        if open_keys.isEmpty():
            if width != FIRST_SHINGLES:
                return known
            low, high, width = 0, 1, 1 << 30
            continue
        live = written(rows.join(open_keys.select("key"), "key", "left_semi"), "rows")
        if width != FIRST_SHINGLES:
            # No column opens again, and none of which all rows have been pivots.
            entries = live.drop("component")
        if high == 1:
            ranked = live.groupBy("key").agg(F.min(F.struct(*columns)).alias("p")).select("key", "p.*")
        else:
            place = F.row_number().over(Window.partitionBy("key").orderBy("own", "id"))
            ranked = live.withColumn("place", place).where((F.col("place") <= high) & (F.col("place") > low)).drop("place")
        pivots = ranked.select("key", *(F.col(c).alias(f"p_{c}") for c in columns))
        pairs = (
            live.join(pivots, "key")
            .where("(own > p_own or own = p_own and id > p_id) and component <> p_component")
            .where(f"100 * least(n, p_n) >= {percent} * greatest(n, p_n)")
            # For the first shingle that both have, all they can share is what follows it in both.
            .where(f"{100 + percent} * least(shared - at, p_shared - p_at) >= {percent} * (n + p_n)")
            .select(F.col("p_id").alias("low"), F.col("id").alias("high"))
            .distinct()
        )
        links = written(confirmed(pairs, sets, percent), "similar")
        if not links.isEmpty():
            ends = known.withColumnRenamed("component", "c")
            joined = (
                links.join(ends.toDF("low", "a"), "low").join(ends.toDF("high", "b"), "high").select("a", "b")
            )
            merged = components(joined).toDF("component", "to")
            known = written(
                known.join(merged, "component", "left").select("id", F.coalesce("to", "component").alias("component")),
                "components",
            )
        if width == FIRST_SHINGLES:
            low, high, width = 0, 1, 1 << 30
        else:
            low, high = high, MORE_PIVOTS * high


def near_duplicates(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: groups of documents linked by similar shingle sets.

    Words are what blanks (space, \\t to \\r) part, A-Z lower-cased. A set has the distinct runs of
    ``width`` words, or of all if there are fewer. Two documents link if their shared shingles are at
    least ``percent`` hundredths of all shingles of both. ``component_id`` is the smallest doc_id
    that links reach, the document's own included.

    One row per row of ``documents``. Null, empty and blank texts have no shingles and link with
    nothing. Rows that share an id are compared like others; null ids count as larger than any.
    Further columns are not read.
    """
    documents = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    outline = written(outlines(documents, width), "outlines")
    docs = outline.select("doc_id", "n", "a", "b")
    classes = docs.where("n > 0").groupBy("a", "b", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    classes = written(classes, "distinct")
    total = classes.agg(F.sum("n"), F.count("*")).first()
    columns = max(1, min(1 << 64 - LOW_BITS, math.ceil((total[0] or 0) / BLOCK_SHINGLES)))
    common = (
        outline.select(F.explode("common").alias("c"))
        .groupBy("c.key")
        .agg(F.sum("c.times").alias("times"))
        .where(F.col("times") >= COMMON_SHARE * total[1])
        .collect()
    )
    pairs = sorted((r.key % (1 << 64), r.times) for r in common)
    keys, times = np.array([k for k, _ in pairs], np.uint64), np.array([t for _, t in pairs], np.int64)

    often = classes.where(F.col("copies") >= max(2.0, FREQUENT_SHARE * outline.count())).select("a", "b", "first").collect()
    frequent = {(r.a, r.b): r.first for r in often}

    log2 = min(FILTER_LOG2, max(10, math.ceil(math.log2(FILTER_BITS * (total[1] + 1)))))

    matrix = (
        blocks(documents, width, columns, keys, times, frequent, first_copies(classes, log2), log2)
        .repartition(columns, "block")
        .groupBy("block")
        .applyInArrow(counted, MATRIX)
    )
    found = matrix.repartition(columns, "slice").groupBy("slice").applyInArrow(
        candidates_of(percent), "a long, b long, n long, keys array<long>, prefix array<long>"
    )
    # Groups come by name, so ids are the same when a task is run again.
    parallel = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(columns, min(parallel, math.ceil((total[0] or 0) / BUCKET_SHINGLES)))
    sets, table = written_by(found.withColumn("id", F.monotonically_increasing_id()), "sets", "id", buckets)
    known = linked(sets, percent)
    named = sets.select("id", "a", "b").join(known, "id").join(classes.select("a", "b", "first"), ["a", "b"])
    smallest = named.groupBy("component").agg(F.min("first").alias("smallest"))
    # A set that the filter let through more than once has its copies in one component.
    labels = named.join(smallest, "component").groupBy("a", "b").agg(F.min("smallest").alias("smallest"))
    named_classes = classes.join(labels, ["a", "b"], "left").select(
        "a", "b", F.coalesce("smallest", "first").alias("component_id")
    )
    # A table of its own, so that the join may split a name that many copies have.
    named_classes = written(named_classes, "classes")
    dropped(documents.sparkSession, table)
    return docs.join(named_classes, ["a", "b"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
