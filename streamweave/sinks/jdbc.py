"""K6 JDBC insert and K7 JDBC upsert.

K6 appends (name, gender) <- (id, temperature text) with Spark's JDBC
writer (one connection per task, batched inserts). K7 is an update-or-insert
per key: per micro-batch, the newest row per key is written to a staging
table of that sink and batch and merged into the target with the
database's own statement; replaying a batch merges the same rows again, so
the sink is idempotent, and two streams never share a staging table. The
statements run over a JDBC connection opened on the driver; only they, not
data, pass through it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def student_rows(df: DataFrame) -> DataFrame:
    """Row shape of the insert: name = id, gender = temperature."""
    return df.select(F.col("id").alias("name"), F.col("temperature").cast("string").alias("gender"))


def student_columns(name: int = 128, gender: int = 64) -> str:
    """Column types for created tables; a longer value fails the write, so
    pass the widths your ids need."""
    return f"name VARCHAR({int(name)}), gender VARCHAR({int(gender)})"


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict | None = None,
                column_types: str | None = None) -> None:
    """K6: append (name, gender) rows; creates the table with
    ``column_types`` if it does not exist."""
    (student_rows(df).write.option("createTableColumnTypes", column_types or student_columns())
     .jdbc(url, table, mode="append", properties=properties or {}))


#: Identifier quote of each dialect; other databases follow the SQL standard.
QUOTES = {"mysql": "`", "mariadb": "`"}


def dialect_of(url: str) -> str:
    """``jdbc:<dialect>:...``"""
    return url.split(":")[1].lower()


def upsert_statement(dialect: str, table: str, stage: str, key: str, value: str) -> str:
    """The statement that merges ``stage`` (one row per key) into ``table``.

    MySQL and MariaDB have no MERGE: their insert updates on a duplicate
    key, which needs a unique index on the key; PostgreSQL and SQLite
    insert on conflict, likewise; other databases MERGE."""
    q = QUOTES.get(dialect, '"')
    k, v = f"{q}{key}{q}", f"{q}{value}{q}"
    if dialect in ("mysql", "mariadb"):
        return (f"INSERT INTO {table} ({k}, {v}) SELECT s.{k}, s.{v} FROM {stage} s "
                f"ON DUPLICATE KEY UPDATE {v} = s.{v}")
    if dialect in ("postgresql", "sqlite"):
        return (f"INSERT INTO {table} ({k}, {v}) SELECT s.{k}, s.{v} FROM {stage} s WHERE true "
                f"ON CONFLICT ({k}) DO UPDATE SET {v} = EXCLUDED.{v}")
    return (f"MERGE INTO {table} t USING {stage} s ON t.{k} = s.{k} "
            f"WHEN MATCHED THEN UPDATE SET {v} = s.{v} "
            f"WHEN NOT MATCHED THEN INSERT ({k}, {v}) VALUES (s.{k}, s.{v})")


def _execute(spark: SparkSession, url: str, statements: list[str], properties: dict | None = None) -> None:
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        st = conn.createStatement()
        for s in statements:
            st.execute(s)
        st.close()
    finally:
        conn.close()


class JdbcUpsert:
    """foreachBatch sink: the newest row per key into ``table``.

    ``name`` tells the staging tables of streams into one table apart."""

    def __init__(self, url: str, table: str, key: str = "name", value: str = "gender", order: str = "seq",
                 properties: dict | None = None, column_types: str | None = None, name: str | None = None):
        self.url, self.table, self.key, self.value, self.order = url, table, key, value, order
        self.properties = properties or {}
        self.column_types = column_types or student_columns()
        self.name = name or uuid.uuid4().hex[:8]

    def stage(self, batch_id: int) -> str:
        return f"{self.table}_STAGE_{self.name}_{int(batch_id)}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        latest = batch.groupBy(self.key).agg(F.max_by(F.col(self.value), F.col(self.order)).alias(self.value))
        stage = self.stage(batch_id)
        (latest.write.option("createTableColumnTypes", self.column_types)
         .jdbc(self.url, stage, mode="overwrite", properties=self.properties))
        _execute(batch.sparkSession, self.url,
                 [upsert_statement(dialect_of(self.url), self.table, stage, self.key, self.value), f"DROP TABLE {stage}"],
                 self.properties)
