"""The corpus pipeline: stages over ``documents``, each written as Parquet and reread as the next one's input.

Each stage calls one operator of ``streamweave.llm`` and applies its decisions to all rows that came in; all but the
last return the columns they got. Null and empty texts, repeated rows, null ids and further columns pass through as
the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamweave.llm.common import scratch, stored
from streamweave.llm.decontam import contaminated_spans
from streamweave.llm.line_dedup import drop_repeated_runs
from streamweave.llm.near_dedup import near_duplicates
from streamweave.llm.packing import packed
from streamweave.llm.quality import quality_model, quality_scores
from streamweave.llm.queries import THRESHOLD, TOKENIZER


def passed(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from an operator's rows, which carry their own row: ids may be null or shared."""
    return rows.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns))


def others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, each row by its own text."""
    model = quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return passed(quality_scores(docs, model, keep=others(docs)).where(F.col("score") >= THRESHOLD), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and with them documents that lose all their lines."""
    new = drop_repeated_runs(docs, keep=docs.columns).where("n_deleted = 0 or n_deleted < n_lines")
    return passed(new, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near-duplicates stays (5-word shingles, similarity 0.8), once."""
    own = "hash_of_text_" + "_" * max(map(len, docs.columns))  # no column of the table has so long a name
    kept = near_duplicates(docs).where("kept").select("doc_id", F.col("text_hash").alias(own)).distinct()
    keys = ["doc_id", own]
    # The join's rows are sorted by both keys, so repeated rows go without another sort.
    named = docs.withColumn(own, F.xxhash64("text")).join(kept, keys, "left_semi").dropDuplicates(keys)
    return named.select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go, each row by its own text."""
    hits = contaminated_spans(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=others(docs))
    return passed(hits.where(F.size("spans") == 0), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents' token sequences, each with its place."""
    path, ranks = map(public_tokenizers.path, TOKENIZER)
    return packed(docs, path, keep_ids=False, ranks=ranks).drop("ids")


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL can't express the stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
