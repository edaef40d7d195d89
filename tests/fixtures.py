"""Fixture rows of FIXTURES.md (seq = 1-based line number)."""

from streamweave import schemas
from streamweave.sources.collection import from_collection

# F1 sensor readings: two sensors at one instant, equal readings, a fall and a rise inside one instant.
T0 = 1_700_000_100_000
SENSOR = [
    ("sensor_2", T0, 20.5), ("sensor_1", T0 + 3000, 18.0), ("sensor_2", T0 + 7000, 21.5), ("sensor_3", T0 + 7000, 30.0),
    ("sensor_2", T0 + 12000, 21.0), ("sensor_3", T0 + 21000, 41.0), ("sensor_1", T0 + 21000, 18.0),
    ("sensor_4", T0 + 30000, 9.25), ("sensor_4", T0 + 30000, 9.25), ("sensor_4", T0 + 30000, -3.5),
    ("sensor_4", T0 + 30000, 12.0), ("sensor_2", T0 + 31000, 35.0),
]
SENSOR_LINES = [f"{i},{t},{v:g}" for i, t, v in SENSOR]

# F2 words: repeated words, a trailing blank
WORD_LINES = ["oak 1", "elm 2", "oak 3", "oak 4", "elm 5", "oak 1 ", "ash 2", "pine", "willow", "wych elm"]
WORD_COUNTS = {"oak": 4, "elm": 3, "1": 2, "2": 2, "3": 1, "4": 1, "5": 1, "ash": 1, "pine": 1, "willow": 1, "wych": 1}

# F3 logins (userId, ip, loginState, timestamp s): two failures in one second, a success between failures and one
# before a failure in the same second, a failure that comes after a later success, late lines
L0 = 1_700_000_000
LOGINS = [
    (101, "10.0.0.1", "success", 0), (102, "10.0.0.2", "fail", 1), (103, "10.0.0.3", "fail", 4),
    (103, "10.0.0.3", "success", 9), (104, "10.0.0.4", "fail", 10), (104, "10.0.0.4", "fail", 10),
    (104, "10.0.0.5", "fail", 12), (105, "10.0.0.6", "fail", 20), (105, "10.0.0.6", "success", 21),
    (105, "10.0.0.6", "fail", 21), (105, "10.0.0.6", "fail", 24), (106, "10.0.0.7", "success", 30),
    (106, "10.0.0.7", "fail", 29), (102, "10.0.0.2", "fail", 3),
]
LOGIN_LINES = [f"{u},{ip},{s},{L0 + t}" for u, ip, s, t in LOGINS]

# F4 user behaviour (item -> second after the base)
BEHAVIOR_BASE = 1_700_000_000
BEHAVIOR_RUN1 = [(11, 1), (22, 2), (33, 3), (44, 4), (55, 5), (66, 6), (88, 7), (99, 8)]
BEHAVIOR_RUN2 = [(11, 1), (22, 2), (33, 3), (44, 4), (55, 6), (66, 6), (88, 7), (99, 8)]


def sensor_df(spark):
    return from_collection(spark, SENSOR, schemas.SENSOR_READING)


def lines_df(spark, lines):
    from pyspark.sql.types import StringType, StructField, StructType
    return from_collection(spark, [(v,) for v in lines], StructType([StructField("value", StringType())]))


def behavior_df(spark, run=BEHAVIOR_RUN1):
    rows = [(1, item, 1, "pv", BEHAVIOR_BASE + off) for item, off in run]
    return from_collection(spark, rows, schemas.USER_BEHAVIOR)
