"""Record types of the reference as Spark schemas.

Every record carries ``seq bigint``: its arrival position. Streams are
ordered and rolling results depend on that order; a DataFrame is not.
"""

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, MapType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


SENSOR_READING = _s(("id", StringType()), ("timestamp", LongType()), ("temperature", DoubleType()))
SENSOR_READING_SEQ = _s(("id", StringType()), ("timestamp", LongType()), ("temperature", DoubleType()),
                        ("seq", LongType()))

LOGIN_EVENT = _s(("userId", LongType()), ("ip", StringType()), ("loginState", StringType()),
                 ("timestamp", LongType()))
LOGIN_EVENT_SEQ = _s(*[(f.name, f.dataType) for f in LOGIN_EVENT.fields], ("seq", LongType()))

LOGIN_FAIL_WARNING = _s(("userId", LongType()), ("firstFailTime", LongType()), ("lastFailTime", LongType()),
                        ("warningMsg", StringType()))

USER_BEHAVIOR = _s(("userId", LongType()), ("itemId", LongType()), ("categoryId", IntegerType()),
                   ("behavior", StringType()), ("timestamp", LongType()))
USER_BEHAVIOR_SEQ = _s(*[(f.name, f.dataType) for f in USER_BEHAVIOR.fields], ("seq", LongType()))

ITEM_VIEW_COUNT = _s(("itemId", LongType()), ("windowEnd", LongType()), ("count", LongType()))

WORD_COUNT = _s(("word", StringType()), ("count", LongType()))

TEMP_CHANGE_ALERT = _s(("id", StringType()), ("lastTemp", DoubleType()), ("temperature", DoubleType()))

CSV_SENSOR_TABLE = _s(("id", StringType()), ("timestamp", LongType()), ("temp", DoubleType()))

DOCUMENT = _s(("index", StringType()), ("type", StringType()), ("source", MapType(StringType(), StringType())))
