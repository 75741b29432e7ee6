"""What several operators share: Arrow maps in bounded slices, written tables, the held-out rule."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of one slice that a task works on at once: bounds memory, never results.
SLICE_ROWS = 2_000
SLICE_BYTES = 4_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see. Where the session names none, a temporary one, on one machine only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines see")
        named = f"file://{tempfile.mkdtemp(prefix='glosswell-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/glosswell/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, column: str, buckets: int) -> tuple[DataFrame, str]:
    """Like ``written``, in buckets by ``column``: joins by that column leave the table where it lies.
    Also returns the table's name, for ``dropped`` once nothing new is read from it."""
    spark = df.sparkSession
    table = f"glosswell_{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, column).write.option("compression", "zstd").bucketBy(buckets, column)
    writer.option("path", f"{shared_folder(spark)}/glosswell/{table}").format("parquet").saveAsTable(table)
    return spark.table(table), table


def dropped(spark: SparkSession, table: str) -> None:
    """Take a table of ``written_by`` out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE {table}")


def slices(batches: Iterable[pa.RecordBatch], sized: str | None = None) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of at most SLICE_ROWS rows and about SLICE_BYTES of column ``sized``."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            if sized is None or part.column(sized).nbytes <= SLICE_BYTES:
                yield part
                continue
            begin, held = 0, 0
            for i, size in enumerate(pc.binary_length(part.column(sized)).to_pylist()):
                if held and held + (size or 0) > SLICE_BYTES:
                    yield part.slice(begin, i - begin)
                    begin, held = i, 0
                held += size or 0
            yield part.slice(begin)


def hand_back() -> None:
    """Give freed memory back at the end of a task: a worker outlives it, and other stages need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:
        pass  # another C library than glibc


def map_rows(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str | StructType, sized: str | None = None
) -> DataFrame:
    """``work`` on every slice of ``df``; it returns the columns of ``schema`` or None."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, sized):
            made = work(part)
            if made is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], f.type) if not isinstance(made[f.name], pa.Array) else made[f.name].cast(f.type) for f in kinds],
                    schema=kinds,
                )
        hand_back()

    return df.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """True for the fifth of documents that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
