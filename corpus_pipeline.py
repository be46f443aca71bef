"""Corpus pipeline: raw documents -> packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``; the first four
return the columns of their input, the last one the packed pieces.

1. ``quality_rules``: documents that the base rules or the classifier reject go.
2. ``line_dedup``: later copies of repeated line runs are deleted from the texts;
   a document of which no word is left goes.
3. ``jaccard_join``: one document of each group of near-duplicates stays (that
   with the smallest doc_id); five-word shingles, similarity 0.8 or more.
4. ``decontaminate``: documents that contain a benchmark item go.
5. ``packing``: the rest, packed into sequences of 2048 tokens.

A learned classifier decides in the first stage, so SQL cannot give the rows:
``ORACLE_SQL`` is None, and the tests hold every stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripstream.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from tripstream.llm.common import ready, row_key, scratch_scope, table, written

ORACLE_SQL = None

_BLANKS = " \t\n\x0b\x0c\r"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.train_quality(docs, table(spark, sf_dir, "labels"))
    # the verdict is carried beside the row, so that no column name can clash
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      F.col("text").alias("text"))
    kept = quality.judge_quality(row, model, carry=["row"]).where("kept")
    return kept.select("row.*")


def line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.where(F.btrim("text", F.lit(_BLANKS)) != "")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    found = written(jaccard_join.near_components(docs), "pipeline-components")
    gone = found.where("r != first").select("r", "doc_id")
    # the row as one struct: no column name can clash; a row goes by its key and its doc_id
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(docs).alias("key"))
    same = (rows["key"] == gone["r"]) & F.col("row.doc_id").cast("long").eqNullSafe(gone["doc_id"])
    return rows.join(gone, same, "left_anti").select("row.*")


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_runs),
    ("jaccard_join", near_duplicates),
    ("decontaminate", leaks),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; what a stage wrote on the way goes once its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch_scope(spark) as scratch:
            docs = scratch.keep(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
    return docs
