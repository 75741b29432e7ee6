"""From raw documents to tokens: five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next one's docs. All but the last return the columns of ``documents``; n_chars is that of the
text as it then is.

Rows are kept or dropped as rows: repeated rows go the same way. Rows with a null doc_id are scored,
cut and tokenised like others; only where one document of a group stays, all of a group's null ids
go if another id is in it. Null texts are clean, have no lines to drop, link with nothing and give no
tokens. Further columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswell.llm import decontaminate, lines, shingles, toxicity
from glosswell.llm.common import read, written
from glosswell.llm.queries import token_digests

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under the calibrated threshold; learned from labelled ones among them."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs.select(*COLUMNS), model).where("toxicity < 0.5").select(*COLUMNS)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that five or more share, but for the one that keeps them. One that
    loses all its lines stays, with an empty text."""
    kept = lines.drop_repeated_lines(docs.select(*COLUMNS), carry=("lang", "source", "n_chars"))
    return kept.select(
        "doc_id",
        "text",
        "lang",
        "source",
        F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"),
    )


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    grouped = shingles.near_duplicates(docs)
    gone = grouped.where("component_id is not null and not doc_id <=> component_id").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone.toDF("gone_id"), F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti")


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    found = decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    gone = found.where("n_hit > 0").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone.toDF("gone_id"), F.col("doc_id").eqNullSafe(F.col("gone_id")), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document left."""
    return token_digests(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmarks),
    ("tokens", tokens),
]

#: Scores of a trained model are not SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
