"""Text helpers that reproduce Java string behaviour with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def java_trim(col: Column) -> Column:
    """Java ``String.trim``: strip every char <= U+0020 at both ends."""
    return F.regexp_replace(col, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def java_split_words(col: Column) -> Column:
    """Java ``line.split(" ")`` as an array.

    Inner and leading empty strings stay, trailing ones go; an empty line
    gives one empty word; a non-empty line of spaces gives none.
    """
    stripped = F.rtrim(col)
    return (F.when((col != F.lit("")) & (stripped == F.lit("")), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, " ", -1)))


def java_length(col: Column) -> Column:
    """Java ``String.length()``: UTF-16 code units, not code points."""
    return (F.octet_length(F.encode(col, "UTF-16BE")) / F.lit(2)).cast("int")


def _java_double(col: Column) -> Column:
    # Spark's double -> string cast prints like Java's Double.toString
    # (1.0, 35.5, 1.0E7), which is what the reference's text forms show.
    return col.cast("string")


def sensor_text(id_col: Column, ts_col: Column, temp_col: Column) -> Column:
    """``SensorReading(id=…, timestamp=…, temperature=…)``."""
    return F.concat(F.lit("SensorReading(id="), id_col, F.lit(", timestamp="), ts_col.cast("string"),
                    F.lit(", temperature="), _java_double(temp_col), F.lit(")"))


def user_behavior_text(user: Column, item: Column, category: Column, behavior: Column, ts: Column) -> Column:
    return F.concat(F.lit("UserBehavior{userId="), user.cast("string"), F.lit(", itemId="), item.cast("string"),
                    F.lit(", categoryId="), F.coalesce(category.cast("string"), F.lit("null")),
                    F.lit(", behavior='"), behavior, F.lit("', timestamp="), ts.cast("string"), F.lit("}"))


def item_view_count_text(item: Column, window_end: Column, count: Column) -> Column:
    return F.concat(F.lit("ItemViewCount{itemId="), item.cast("string"), F.lit(", windowEnd="),
                    window_end.cast("string"), F.lit(", count="), count.cast("string"), F.lit("}"))
