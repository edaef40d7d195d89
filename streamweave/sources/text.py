"""S3/S4 text files as lines, S5-S7 line parsers, S11 CSV tables, S12.

A line's place is (file, block, line): Spark reads each file block in order, so
that order needs no shuffle, and operators that take several order columns use
it as it is. A global line number (``seq``, exact across the input in (file,
offset) order) is made on request: blocks are counted in a first pass, only that
summary (one row per block) is ordered globally, and the reading task adds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from streamweave import schemas
from streamweave.functions.text import java_trim
from streamweave.session import scratch, stored


#: The order columns of unnumbered lines.
PLACE = ("file", "block", "line")


def line_blocks(raw: DataFrame) -> DataFrame:
    """(file, block, first, before) for each file block: the id of its first line in its reading task, and the lines
    of all blocks before it. Counted in one pass over the byte ranges (no text leaves it), ordered as a table of one
    row per block, and written to the shared folder."""
    counts = raw.groupBy("file", "block").agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.select("file", "block", "first", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return stored(blocks, scratch(raw.sparkSession), "blocks")


def read_lines(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """``readTextFile``: (value, file, seq), seq = 0-based global line number;
    with ``numbered`` off (value, file, block, line) in one pass.

    Numbers come from the stored ``line_blocks`` and are added where a line is read: the plan holds one scan of the
    text, and lines are shuffled only if the table of blocks is over Spark's broadcast threshold. Files that change
    after the count, or a session that cuts them otherwise when it reads, fail the job instead of numbering wrongly.
    Files count in the order of their paths, compared as strings; an input without lines gives no rows."""
    raw = (spark.read.text(path)
           .select("value",
                   F.col("_metadata.file_path").alias("file"),
                   F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("line")))
    if not numbered:
        return raw
    # An id's upper bits are the reading task's number, the lower ones the line's place in it.
    same_task = F.shiftright("line", 33) == F.shiftright("first", 33)
    changed = F.raise_error(F.concat(F.lit("input or its blocks changed since they were counted: "), "file"))
    seq = F.when(same_task & (F.col("line") >= F.col("first")), F.col("before") + F.col("line") - F.col("first"))
    return (raw.join(line_blocks(raw), ["file", "block"], "left")
            .select("value", "file", seq.otherwise(changed.cast("bigint")).alias("seq")))


def _fields(line: Column, n: int) -> list[Column]:
    parts = F.split(line, ",", -1)
    # A short line fails the job, as the reference's array access does.
    checked = F.when(F.size(parts) >= n, parts).otherwise(
        F.raise_error(F.concat(F.lit("malformed line: "), line)))
    return [F.get(checked, i) for i in range(n)]


def _strict(value: Column, typ: str, pattern: str | None = None) -> Column:
    """Cast that fails the job on bad input, whatever the ANSI setting."""
    ok = value.try_cast(typ)
    cond = ok.isNull()
    if pattern is not None:
        cond = cond | ~value.rlike(pattern)
    return F.when(cond, F.raise_error(F.concat(F.lit(f"cannot parse {typ}: "), F.coalesce(value, F.lit("null"))))).otherwise(ok)


_JAVA_LONG = r"^[+-]?[0-9]+$"


def parse_sensor(lines: DataFrame, col: str = "value") -> DataFrame:
    """``id,timestamp,temperature`` with every field trimmed Java-style."""
    f = _fields(F.col(col), 3)
    return lines.select(
        java_trim(f[0]).alias("id"),
        _strict(java_trim(f[1]), "bigint", _JAVA_LONG).alias("timestamp"),
        _strict(java_trim(f[2]), "double").alias("temperature"),
        *[c for c in lines.columns if c == "seq"])


def parse_login(lines: DataFrame, col: str = "value") -> DataFrame:
    """``userId,ip,loginState,timestamp`` (no trim, as in the reference)."""
    f = _fields(F.col(col), 4)
    return lines.select(
        _strict(f[0], "bigint", _JAVA_LONG).alias("userId"), f[1].alias("ip"), f[2].alias("loginState"),
        _strict(f[3], "bigint", _JAVA_LONG).alias("timestamp"),
        *[c for c in lines.columns if c == "seq"])


def parse_user_behavior(lines: DataFrame, col: str = "value") -> DataFrame:
    """``userId,itemId,categoryId,behavior,timestamp`` (no trim)."""
    f = _fields(F.col(col), 5)
    return lines.select(
        _strict(f[0], "bigint", _JAVA_LONG).alias("userId"), _strict(f[1], "bigint", _JAVA_LONG).alias("itemId"),
        _strict(f[2], "int", _JAVA_LONG).alias("categoryId"), f[3].alias("behavior"),
        _strict(f[4], "bigint", _JAVA_LONG).alias("timestamp"),
        *[c for c in lines.columns if c == "seq"])


def register_csv_table(spark: SparkSession, path: str, name: str,
                       schema: StructType = schemas.CSV_SENSOR_TABLE) -> DataFrame:
    """CSV with a declared schema, registered under ``name``.

    FAILFAST makes a bad row fail the read, as the reference's CSV format
    does; the schema is never inferred.
    """
    df = spark.read.schema(schema).option("mode", "FAILFAST").option("ignoreLeadingWhiteSpace", "true") \
        .option("ignoreTrailingWhiteSpace", "true").csv(path)
    df.createOrReplaceTempView(name)
    return spark.table(name)


def register_csv_stream(spark: SparkSession, path: str, name: str,
                        schema: StructType = schemas.CSV_SENSOR_TABLE) -> DataFrame:
    """S11 streaming: the same table over files arriving in a folder."""
    df = spark.readStream.schema(schema).option("mode", "FAILFAST").option("ignoreLeadingWhiteSpace", "true") \
        .option("ignoreTrailingWhiteSpace", "true").csv(path)
    df.createOrReplaceTempView(name)
    return df


def stream_to_table(df: DataFrame, name: str | None = None) -> DataFrame:
    """S12 ``fromDataStream``: a DataFrame already is a table; optionally name it."""
    if name:
        df.createOrReplaceTempView(name)
    return df


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = 64) -> DataFrame:
    """S3 streaming: lines of files in a folder (use ``availableNow`` to read once),
    ``max_files_per_trigger`` files in a micro-batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path).select("value", F.col("_metadata.file_path").alias("file"))
