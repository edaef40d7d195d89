"""Views of the reference's record types over the driver tables.

readings   events -> SensorReading(id, timestamp ms, temperature, seq)
behaviors  events -> UserBehavior(userId, itemId, categoryId, behavior, timestamp s, seq)
logins     events -> LoginEvent(userId, ip, loginState, timestamp s, seq)
pageviews  behaviors of one kind, filtered on the raw column (pushed down)
lines      documents -> text lines (doc_id, line_no, value)
words      lines -> one row per word (doc_id, line_no, pos, word), D1
readings_shuffled  readings in a permuted arrival order (late data tests)

All time conversions are time-zone independent (NTZ arithmetic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from streamweave.functions.time import epoch_ms, epoch_seconds
from streamweave.operators.transforms import split_words

# Fixed values shared with the SQL oracles: the arrival permutation used for
# late-data tests.
SHUFFLE_MULT = 7919
SHUFFLE_MOD = 61


EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                 "props string")
DOCUMENTS_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


def readings_of(ev: DataFrame) -> DataFrame:
    """readings over an events DataFrame (batch or stream)."""
    return ev.select(
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        epoch_ms(F.col("ts"), is_ntz=True).alias("timestamp"),
        F.col("value").alias("temperature"),
        F.col("event_id").alias("seq"))


def shuffled_seq(event_id):
    """Arrival order (e + e*7919 % 61, e) folded into one bigint."""
    d = (event_id * F.lit(SHUFFLE_MULT)) % F.lit(SHUFFLE_MOD)
    return (event_id + d) * F.lit(64) + F.lit(SHUFFLE_MOD - 1) - d


def readings_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_shuffled_of(table(spark, sf_dir, "events"))


def readings_shuffled_of(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.concat(F.lit("sensor_"), F.col("user_id").cast("string")).alias("id"),
        epoch_ms(F.col("ts"), is_ntz=True).alias("timestamp"),
        F.col("value").alias("temperature"),
        shuffled_seq(F.col("event_id")).alias("seq"),
        F.col("event_id"))


def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviors_of(table(spark, sf_dir, "events"))


def behaviors_of(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("user_id").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("itemId"),
        F.lit(None).cast("int").alias("categoryId"),
        F.when(F.col("event_type") == "view", F.lit("pv")).otherwise(F.col("event_type")).alias("behavior"),
        epoch_seconds(F.col("ts"), is_ntz=True).alias("timestamp"),
        F.col("event_id").alias("seq"))


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logins_of(table(spark, sf_dir, "events"))


def logins_of(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("user_id").alias("userId"),
        F.lit(None).cast("string").alias("ip"),
        F.when(F.col("event_type") == "error", F.lit("fail")).otherwise(F.lit("success")).alias("loginState"),
        epoch_seconds(F.col("ts"), is_ntz=True).alias("timestamp"),
        F.col("event_id").alias("seq"))


def pageviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pageviews_of(table(spark, sf_dir, "events"))


def pageviews_of(ev: DataFrame) -> DataFrame:
    """behaviors whose behavior is ``pv``. The raw values that map to it are
    filtered first, so the Parquet scan skips row groups without them."""
    return behaviors_of(ev.where(F.col("event_type").isin("view", "pv")))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(table(spark, sf_dir, "documents"))


def lines_of(docs: DataFrame) -> DataFrame:
    return (docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "value"))
            .select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "value"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words_of(lines(spark, sf_dir))


def words_of(ln: DataFrame) -> DataFrame:
    return split_words(ln, keep=("doc_id", "line_no"))
