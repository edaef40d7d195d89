"""The registered queries of the operators: thin callers over whole tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from streamweave.llm import chat, decontam, oracles, runs
from streamweave.llm.ann import nearest
from streamweave.llm.compression import compression_verdicts
from streamweave.llm.line_dedup import drop_repeated_runs
from streamweave.llm.near_dedup import near_duplicates
from streamweave.llm.packing import packed
from streamweave.llm.pii import pseudonymized
from streamweave.llm.quality import held_out, quality_model, quality_scores
from streamweave.llm.secret_scan import scan_secrets
from streamweave.llm.sharding import sharded
from streamweave.llm.whitening import whitened

#: A score from this on predicts label 1.
THRESHOLD = 0.3
#: The queries' key; a deployment passes its own secret.
KEY = b"registered queries"

#: The tokenizer that fixes the ids, and its vocabulary as ranks: the same ids of plain text, four times as fast.
TOKENIZER = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontam.contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontam.digest(hits)


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    probe = spark.sql(f"values (-7L, 0L, 'user', '{own}'), (-7L, 1L, 'assistant', '{own}') as t(conv_id, turn, role, text)")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    return chat.digest(chat.formatted(chat.table_turns(rows)))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, over=85, under=100).drop("text_hash")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ranks = map(public_tokenizers.path, TOKENIZER)
    return packed(table(spark, sf_dir, "documents"), path, keep_ids=False, ranks=ranks).drop("ids")


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"), n=10)


def op6_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), shards=8)


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymized(table(spark, sf_dir, "documents"), KEY)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    return (quality_scores(docs, model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted")))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_runs(table(spark, sf_dir, "documents"))


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_verdicts(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))


def made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text) as the query's contract fixes it: where h % 10 = 0, word i >= a becomes word a + (i - a) % p."""
    docs = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    docs = docs.withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    docs = docs.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    turned = F.expr("array_join(transform(sequence(0, n - 1), i -> get(words, int(if(i < a, i, a + (i - a) % p)))), ' ')")
    return docs.select("doc_id", F.when(F.col("n") > 0, turned).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(made_periodic(table(spark, sf_dir, "documents"))))


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_chat_formatting, op3_minhash_near_dedup, op4_packing, op5_permutation_index,
    op6_kd_tree_sharding, op7_pii_pseudonyms, op8_quality_classifier, op9_secret_scan, op10_line_dedup, op11_quality_rules,
    op12_embedding_whitening, op13_periodic_runs)}

#: The other queries are held against brute force, a round trip or held-out accuracy in tests/llm.
ORACLES = {"op1_benchmark_decontamination": oracles.OP1, "op2_chat_formatting": oracles.OP2,
           "op3_minhash_near_dedup": oracles.OP3}
