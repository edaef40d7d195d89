"""Registry of runnable queries over the driver tables, with SQL oracles.

Every query reads whole tables (or views Spark derives from them) and runs
the library's operator on all of it. Durations are the reference's scaled
to the 30-day ``events`` table (SURVEY §7.1): 5 s/2 s -> 5 h/2 h,
15 s -> 1 h, 1 min session -> 1 h, 2 s login -> 12 h, 10 s rise -> 1 day,
300 ms delay -> 30 min, 1 min lateness -> 2 h.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from streamweave import oracles as O
from streamweave.plans import hot_items as hot
from streamweave.sources import testdata as td

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


H = 3_600_000

# ---------------------------------------------------------------- E1 / ST13
_COUNTS_5H_2H = f"""
pv AS (SELECT itemId, timestamp * 1000 AS t FROM behaviors WHERE behavior = 'pv'),
w AS (SELECT itemId, {O.sliding_starts('t', 5 * H, 2 * H)} AS ws FROM pv),
c AS (SELECT itemId, ws + {5 * H} AS windowEnd, count(*) AS count FROM w GROUP BY 1, 2)"""


@register("hot_items_top5", O.with_views(f"""{_COUNTS_5H_2H},
r AS (SELECT windowEnd, row_number() OVER (PARTITION BY windowEnd ORDER BY count DESC, itemId) AS rank,
             itemId, count FROM c)
SELECT windowEnd, rank, itemId, count FROM r WHERE rank <= 5""", "behaviors"))
def q_hot_items(spark, sf):
    return hot.hot_items(td.pageviews(spark, sf))


@register("hot_items_text", O.with_views(f"""{_COUNTS_5H_2H},
r AS (SELECT windowEnd, row_number() OVER (PARTITION BY windowEnd ORDER BY count DESC, itemId) AS rank,
             itemId, count FROM c)
SELECT windowEnd, string_agg(CAST(windowEnd AS VARCHAR) || '-' || CAST(itemId AS VARCHAR) || ':' ||
                             CAST(count AS VARCHAR) || ';', '' ORDER BY rank) AS value
FROM r WHERE rank <= 5 GROUP BY windowEnd""", "behaviors"))
def q_hot_items_text(spark, sf):
    return hot.hot_items_lines(td.pageviews(spark, sf))


@register("hot_items_distinct_seconds", O.with_views(f"""
pv AS (SELECT itemId, timestamp FROM behaviors WHERE behavior = 'pv'),
w AS (SELECT itemId, timestamp, {O.sliding_starts('timestamp * 1000', 5 * H, 2 * H)} AS ws FROM pv),
c AS (SELECT itemId, ws + {5 * H} AS windowEnd, count(DISTINCT timestamp // 1000) AS count FROM w GROUP BY 1, 2),
r AS (SELECT windowEnd, row_number() OVER (PARTITION BY windowEnd ORDER BY count DESC, itemId) AS rank,
             itemId, count FROM c)
SELECT windowEnd, rank, itemId, count FROM r WHERE rank <= 5""", "behaviors"))
def q_hot_items_distinct(spark, sf):
    return hot.hot_items_distinct_seconds(td.pageviews(spark, sf))


@register("dedup_hot_items", O.with_views(f"""
pv AS (SELECT itemId, timestamp, seq FROM behaviors WHERE behavior = 'pv'),
d AS (SELECT itemId, timestamp * 1000 AS t FROM (
        SELECT *, row_number() OVER (PARTITION BY itemId, timestamp ORDER BY seq) AS k FROM pv) WHERE k = 1),
w AS (SELECT itemId, {O.sliding_starts('t', 5 * H, 2 * H)} AS ws FROM d),
c AS (SELECT itemId, ws + {5 * H} AS windowEnd, count(*) AS count FROM w GROUP BY 1, 2),
r AS (SELECT windowEnd, row_number() OVER (PARTITION BY windowEnd ORDER BY count DESC, itemId) AS rank,
             itemId, count FROM c)
SELECT windowEnd, rank, itemId, count FROM r WHERE rank <= 5""", "behaviors"))
def q_dedup_hot_items(spark, sf):
    return hot.dedup_hot_items(td.pageviews(spark, sf))


@register("item_view_counts", O.with_views(f"""{_COUNTS_5H_2H}
SELECT itemId, windowEnd, count FROM c""", "behaviors"))
def q_item_view_counts(spark, sf):
    from streamweave.operators.windows import item_view_counts
    pv = td.pageviews(spark, sf)
    return item_view_counts(pv, "5 hours", "2 hours")


@register("dedup_item_timestamp", O.with_views("""
SELECT userId, itemId, categoryId, behavior, timestamp, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY itemId, timestamp ORDER BY seq) AS k
  FROM behaviors WHERE behavior = 'pv') WHERE k = 1""", "behaviors"))
def q_dedup(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.state import dedup_first
    # The kind is one constant: without it all columns have a fixed width.
    b = td.pageviews(spark, sf)
    return dedup_first(b.drop("behavior"), ["itemId", "timestamp"]).withColumn("behavior", F.lit("pv")).select(b.columns)


# ---------------------------------------------------------------- sources
@register("parse_sensor_lines", O.with_views("SELECT id, timestamp, temperature, seq FROM readings", "readings"))
def q_parse_sensor(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.sources.text import parse_sensor
    r = td.readings(spark, sf)
    lines = r.select(F.concat(F.col("id"), F.lit(", "), F.col("timestamp").cast("string"), F.lit(" ,\t"),
                              F.col("temperature").cast("string"), F.lit(" ")).alias("value"), "seq")
    return parse_sensor(lines)


@register("numbered_lines", O.with_views(
    "SELECT row_number() OVER (ORDER BY seq) - 1 AS seq, id || ',' || CAST(timestamp AS VARCHAR) AS value FROM readings",
    "readings"))
def q_numbered_lines(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.session import scratch
    from streamweave.sources.text import read_lines
    folder = scratch(spark)
    (td.readings(spark, sf).orderBy("seq").select(F.concat_ws(",", "id", F.col("timestamp").cast("string")).alias("value"))
     .write.text(folder))
    return read_lines(spark, folder).select("seq", "value")


@register("parse_user_behavior_lines", O.with_views(
    "SELECT userId, itemId, 1 AS categoryId, behavior, timestamp, seq FROM behaviors", "behaviors"))
def q_parse_behavior(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.sources.text import parse_user_behavior
    b = td.behaviors(spark, sf)
    lines = b.select(F.concat_ws(",", F.col("userId").cast("string"), F.col("itemId").cast("string"), F.lit("1"),
                                 "behavior", F.col("timestamp").cast("string")).alias("value"), "seq")
    return parse_user_behavior(lines)


@register("parse_login_lines", O.with_views(
    "SELECT userId, '10.0.0.' || CAST(userId AS VARCHAR) AS ip, loginState, timestamp, seq FROM logins", "logins"))
def q_parse_login(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.sources.text import parse_login
    b = td.logins(spark, sf)
    lines = b.select(F.concat_ws(",", F.col("userId").cast("string"),
                                 F.concat(F.lit("10.0.0."), F.col("userId").cast("string")),
                                 "loginState", F.col("timestamp").cast("string")).alias("value"), "seq")
    return parse_login(lines)


# ---------------------------------------------------------------- P1-P14
_UTF16_LEN = ("length(value) + length(regexp_replace(value, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))")


@register("line_length", O.with_views(f"SELECT doc_id, line_no, CAST({_UTF16_LEN} AS INTEGER) AS length FROM lines",
                                      "lines"))
def q_line_length(spark, sf):
    from streamweave.operators.transforms import line_length
    return line_length(td.lines(spark, sf))


@register("split_words", O.with_views("SELECT doc_id, line_no, pos, word FROM words", "words"))
def q_split_words(spark, sf):
    from streamweave.operators.transforms import split_words
    return split_words(td.lines(spark, sf), keep=("doc_id", "line_no"))


@register("words_with_prefix_w", O.with_views(
    "SELECT doc_id, line_no, pos, word FROM words WHERE starts_with(word, 'w')", "words"))
def q_prefix(spark, sf):
    from streamweave.operators.transforms import starts_with
    return starts_with(td.words(spark, sf), "w", col="word")


@register("behavior_pv", O.with_views(
    "SELECT userId, itemId, categoryId, behavior, timestamp, seq FROM behaviors WHERE behavior = 'pv'", "behaviors"))
def q_pv(spark, sf):
    from streamweave.operators.transforms import field_equals
    return field_equals(td.pageviews(spark, sf), "behavior", "pv")


@register("table_select_where", O.with_views(
    "SELECT id, temperature FROM readings WHERE id = 'sensor_4'", "readings"))
def q_table_select(spark, sf):
    from streamweave.plans.table_sql import table_api
    # The id is derived from user_id: the raw predicate reaches the scan.
    raw = td.table(spark, sf, "events").where("user_id = 4")
    return table_api(td.readings_of(raw), "id,temperature", "id = 'sensor_4'")


@register("sql_not_equal", O.with_views(
    "SELECT id, temperature FROM readings WHERE id <> 'sensor_4'", "readings"))
def q_sql(spark, sf):
    from streamweave.plans.table_sql import sql_api
    raw = td.table(spark, sf, "events").where("user_id <> 4")
    return sql_api(spark, td.readings_of(raw), "sensor", "select id,temperature from sensor where id <> 'sensor_4'")


_HIGH = 250.0


@register("split_high_low", O.with_views(
    f"SELECT seq, temperature, CASE WHEN temperature > {_HIGH} THEN 'high' ELSE 'lower' END AS branch FROM readings",
    "readings"))
def q_split(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.transforms import high_low
    return high_low(td.readings(spark, sf), _HIGH).select("seq", "temperature",
                                                           F.explode("branches").alias("branch"))


@register("select_high_and_lower", O.with_views("SELECT id, timestamp, temperature, seq FROM readings", "readings"))
def q_select_branches(spark, sf):
    from streamweave.operators.transforms import high_low, select_branches
    return select_branches(high_low(td.readings(spark, sf), _HIGH), ["high", "lower"])


@register("side_output", O.with_views(
    "SELECT seq, CASE WHEN temperature > 5 THEN 'main' ELSE 'side' END AS output FROM readings", "readings"))
def q_side(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.transforms import tag_side_output
    return tag_side_output(td.readings(spark, sf), F.col("temperature") > 5).select("seq", "output")


@register("connect_comap", O.with_views(f"""
SELECT id, temperature, 'high temp warning' AS info, 1 AS stream FROM readings WHERE temperature > {_HIGH}
UNION ALL
SELECT id, CAST(NULL AS DOUBLE) AS temperature, 'normal' AS info, 2 AS stream FROM readings
WHERE NOT (temperature > {_HIGH})""", "readings"))
def q_connect(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.transforms import connect_map, high_low, select_branches
    r = high_low(td.readings(spark, sf), _HIGH)
    return connect_map(
        select_branches(r, ["high"]), select_branches(r, ["lower"]),
        lambda d: d.select("id", "temperature", F.lit("high temp warning").alias("info")),
        lambda d: d.select("id", F.lit(None).cast("double").alias("temperature"), F.lit("normal").alias("info")))


@register("union_high_lower_all", O.with_views(f"""
SELECT id, timestamp, temperature, seq FROM readings WHERE temperature > {_HIGH}
UNION ALL SELECT id, timestamp, temperature, seq FROM readings WHERE NOT (temperature > {_HIGH})
UNION ALL SELECT id, timestamp, temperature, seq FROM readings""", "readings"))
def q_union(spark, sf):
    from streamweave.operators.transforms import high_low, select_branches, union_all
    r = high_low(td.readings(spark, sf), _HIGH)
    return union_all(select_branches(r, ["high"]), select_branches(r, ["lower"]), r.drop("branches"))


@register("sensor_text", O.with_views(
    "SELECT seq, 'SensorReading(id=' || id || ', timestamp=' || CAST(timestamp AS VARCHAR) || ', temperature=' || "
    "CAST(temperature AS VARCHAR) || ')' AS value FROM readings", "readings"))
def q_sensor_text(spark, sf):
    from streamweave.operators.transforms import sensor_to_text
    return sensor_to_text(td.readings(spark, sf))


@register("behavior_event_time", O.with_views(
    "SELECT seq, timestamp, timestamp * 1000 AS event_time_ms FROM behaviors", "behaviors"))
def q_event_time(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.transforms import with_event_time
    b = with_event_time(td.behaviors(spark, sf), unit="s")
    return b.select("seq", "timestamp", F.unix_millis("event_time").alias("event_time_ms"))


# ---------------------------------------------------------------- A1-A11
@register("word_count", O.with_views("SELECT word, count(*) AS count FROM words GROUP BY word", "words"))
def q_word_count(spark, sf):
    from streamweave.operators.aggregates import word_count
    return word_count(td.words(spark, sf))


@register("rolling_word_count", O.with_views(
    "SELECT word, doc_id, line_no, pos, count(*) OVER (PARTITION BY word ORDER BY doc_id, line_no, pos) AS count "
    "FROM words", "words"))
def q_rolling_word_count(spark, sf):
    from streamweave.operators.aggregates import rolling_word_count
    return rolling_word_count(td.words(spark, sf))


_RUN = "OVER (PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@register("rolling_max_by", O.with_views(f"""
SELECT seq AS input_seq, b.id AS id, b.ts AS timestamp, b.v AS temperature, b.s AS seq FROM (
  SELECT seq, max({{'v': temperature, 'n': -seq, 'id': id, 'ts': timestamp, 's': seq}}) {_RUN} AS b FROM readings)""",
                                          "readings"))
def q_rolling_max_by(spark, sf):
    from streamweave.operators.aggregates import rolling_max_by
    return rolling_max_by(td.readings(spark, sf))


@register("rolling_max", O.with_views(f"""
SELECT seq AS input_seq, id, first_value(timestamp) {_RUN} AS timestamp,
       max(temperature) {_RUN} AS temperature FROM readings""", "readings"))
def q_rolling_max(spark, sf):
    from streamweave.operators.aggregates import rolling_max
    return rolling_max(td.readings(spark, sf))


@register("rolling_reduce", O.with_views(f"""
SELECT seq AS input_seq, id, timestamp, max(temperature) {_RUN} AS temperature FROM readings""", "readings"))
def q_rolling_reduce(spark, sf):
    from streamweave.operators.aggregates import rolling_reduce
    return rolling_reduce(td.readings(spark, sf))


@register("window_min_by_1h", O.with_views(f"""
SELECT window_start, window_start + {H} AS window_end, id, timestamp, temperature, seq FROM (
  SELECT *, timestamp - timestamp % {H} AS window_start,
         row_number() OVER (PARTITION BY id, timestamp - timestamp % {H} ORDER BY temperature, seq) AS k
  FROM readings) WHERE k = 1""", "readings"))
def q_window_min_by(spark, sf):
    from streamweave.operators.aggregates import window_min_by
    return window_min_by(td.readings(spark, sf), "1 hour")


@register("window_sum_1h", O.with_views(f"""
SELECT timestamp - timestamp % {H} AS window_start, timestamp - timestamp % {H} + {H} AS window_end, id,
       CAST(sum(CAST(temperature AS DECIMAL(18,2))) AS DOUBLE) AS sum_temperature
FROM readings GROUP BY 1, 2, 3""", "readings"))
def q_window_sum(spark, sf):
    from streamweave.operators.aggregates import window_sum
    return window_sum(td.readings(spark, sf), "1 hour", scale=2)  # the data has two decimals


@register("window_distinct_seconds", O.with_views(f"""
SELECT ws AS window_start, ws + {5 * H} AS window_end, itemId, count(DISTINCT timestamp // 1000) AS count FROM (
  SELECT itemId, timestamp, {O.sliding_starts('timestamp * 1000', 5 * H, 2 * H)} AS ws
  FROM behaviors WHERE behavior = 'pv') GROUP BY 1, 2, 3""", "behaviors"))
def q_window_distinct(spark, sf):
    from streamweave.operators.aggregates import window_distinct_buckets
    pv = td.pageviews(spark, sf)
    return window_distinct_buckets(pv, "5 hours", "itemId", slide="2 hours")


@register("daily_active_users", O.with_views("""
SELECT (timestamp // 86400) * 86400 AS bucket_start, count(DISTINCT userId) AS users
FROM behaviors GROUP BY 1""", "behaviors"))
def q_dau(spark, sf):
    from streamweave.operators.aggregates import distinct_per_bucket
    return distinct_per_bucket(td.behaviors(spark, sf))


def _hourly_users(spark, sf):
    from streamweave.operators.distinct import pane_sets
    from streamweave.session import scratch, stored
    return stored(pane_sets(td.behaviors(spark, sf).select("userId", "timestamp"), "userId", "1 hour"), scratch(spark), "hours")


@register("daily_users_from_hours", O.with_views(f"""
SELECT (timestamp // 86400) * 86400000 AS window_start, (timestamp // 86400 + 1) * 86400000 AS window_end,
       count(DISTINCT userId) AS users FROM behaviors GROUP BY 1, 2""", "behaviors"))
def q_daily_users_from_hours(spark, sf):
    """Hourly sets, stored once, merged into days; no row is counted again."""
    from streamweave.operators.distinct import window_set_sizes
    return window_set_sizes(_hourly_users(spark, sf), "1 hour", "1 day")


@register("users_3d_by_12h", O.with_views(f"""
SELECT ws AS window_start, ws + {72 * H} AS window_end, count(DISTINCT userId) AS users FROM (
  SELECT userId, {O.sliding_starts('timestamp * 1000', 72 * H, 12 * H)} AS ws FROM behaviors) GROUP BY 1, 2""", "behaviors"))
def q_users_sliding(spark, sf):
    """Distinct users of sliding windows from the same hourly sets."""
    from streamweave.operators.distinct import window_set_sizes
    return window_set_sizes(_hourly_users(spark, sf), "1 hour", "3 days", "12 hours")


@register("rollup_hourly_to_daily", O.with_views(f"""
SELECT (timestamp * 1000) - (timestamp * 1000) % {24 * H} AS window_start, itemId, count(*) AS count,
       (timestamp * 1000) - (timestamp * 1000) % {24 * H} + {24 * H} AS window_end
FROM behaviors WHERE behavior = 'pv' GROUP BY 1, 2, 4""", "behaviors"))
def q_rollup(spark, sf):
    from streamweave.operators.aggregates import rollup_counts, window_count
    pv = td.pageviews(spark, sf)
    hourly = window_count(pv, "1 hour", "itemId", unit="s")
    return rollup_counts(hourly, "itemId", 24 * H)


# ---------------------------------------------------------------- windows
@register("window_size_1h", O.with_views(f"""
SELECT id, ws AS window_start, ws + {H} AS window_end, count(*) AS size,
       id || CAST(ws + {H} AS VARCHAR) || CAST(count(*) AS VARCHAR) AS value
FROM (SELECT id, timestamp - timestamp % {H} AS ws FROM readings) GROUP BY id, ws""", "readings"))
def q_window_size(spark, sf):
    from streamweave.operators.windows import window_size
    return window_size(td.readings(spark, sf), "1 hour")


@register("session_windows_1h", O.with_views(f"""
SELECT id, min(timestamp) AS session_start, max(timestamp) + {H} AS session_end, count(*) AS count FROM (
  SELECT *, sum(CASE WHEN prev IS NULL OR timestamp - prev > {H} THEN 1 ELSE 0 END)
              OVER (PARTITION BY id ORDER BY timestamp, seq) AS sid FROM (
    SELECT *, lag(timestamp) OVER (PARTITION BY id ORDER BY timestamp, seq) AS prev FROM readings))
GROUP BY id, sid""", "readings"))
def q_sessions(spark, sf):
    from streamweave.operators.windows import session_windows
    return session_windows(td.readings(spark, sf), "id", "1 hour")


@register("count_window_10_2", O.with_views("""
SELECT id, seq, size, min_temperature, max_temperature, id || CAST(size AS VARCHAR) AS value FROM (
  SELECT id, seq, row_number() OVER w AS rn, count(*) OVER f AS size,
         min(temperature) OVER f AS min_temperature, max(temperature) OVER f AS max_temperature
  FROM readings WINDOW w AS (PARTITION BY id ORDER BY seq),
                       f AS (PARTITION BY id ORDER BY seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
WHERE rn % 2 = 0""", "readings"))
def q_count_window(spark, sf):
    from streamweave.operators.windows import count_window
    return count_window(td.readings(spark, sf), "id", 10, 2)


@register("early_firing_every_3", O.with_views(f"""
SELECT id, window_start, window_start + {H} AS window_end, seq AS fired_at_seq, count, max_temperature FROM (
  SELECT id, seq, timestamp - timestamp % {H} AS window_start,
         count(*) OVER w AS count, max(temperature) OVER w AS max_temperature
  FROM readings WINDOW w AS (PARTITION BY id, timestamp - timestamp % {H} ORDER BY seq
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
WHERE count % 3 = 0""", "readings"))
def q_early_firing(spark, sf):
    from streamweave.operators.windows import early_firing
    return early_firing(td.readings(spark, sf), "1 hour", 3)


@register("keep_last_2_per_window", O.with_views(f"""
SELECT id, window_start, window_start + {H} AS window_end, count(*) AS kept, min(temperature) AS min_temperature,
       CAST(sum(CAST(temperature AS DECIMAL(18,2))) AS DOUBLE) AS sum_temperature FROM (
  SELECT *, timestamp - timestamp % {H} AS window_start,
         row_number() OVER (PARTITION BY id, timestamp - timestamp % {H} ORDER BY seq DESC) AS k FROM readings)
WHERE k <= 2 GROUP BY id, window_start""", "readings"))
def q_keep_last(spark, sf):
    from streamweave.operators.windows import keep_last
    return keep_last(td.readings(spark, sf), "1 hour", 2, scale=2)  # the data has two decimals


# ---------------------------------------------------------------- lateness
_DELAY, _LATENESS = 30 * 60_000, 2 * H
_CLASSIFIED = f"""
wm AS (SELECT *, max(timestamp) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_DELAY}
                 AS watermark, timestamp - timestamp % {H} AS window_start FROM readings_shuffled),
cl AS (SELECT *, window_start + {H} AS window_end,
       CASE WHEN watermark IS NULL OR watermark < window_start + {H} - 1 THEN 'on_time'
            WHEN watermark < window_start + {H} - 1 + {_LATENESS} THEN 'late' ELSE 'too_late' END AS arrival
       FROM wm)"""


@register("late_router", O.with_views(f"""{_CLASSIFIED}
SELECT id, timestamp, temperature, seq, event_id, watermark, window_start, window_end, arrival FROM cl""",
                                      "readings_shuffled"))
def q_late_router(spark, sf):
    from streamweave.operators.lateness import classify_arrivals
    return classify_arrivals(td.readings_shuffled(spark, sf), "1 hour", "30 minutes", "2 hours")


@register("late_side_output", O.with_views(f"""{_CLASSIFIED}
SELECT id, timestamp, temperature, seq, event_id, watermark, window_start, window_end FROM cl
WHERE arrival = 'too_late'""", "readings_shuffled"))
def q_late_output(spark, sf):
    from streamweave.operators.lateness import late_output
    return late_output(td.readings_shuffled(spark, sf), "1 hour", "30 minutes", "2 hours")


@register("firing_changelog_min", O.with_views(f"""{_CLASSIFIED},
ont AS (SELECT id, window_start, window_end, max(seq) AS trigger_seq,
               min({{'v': temperature, 's': seq, 't': timestamp}}) AS m
        FROM cl WHERE arrival = 'on_time' GROUP BY 1, 2, 3),
lt AS (SELECT id, window_start, window_end, seq AS trigger_seq,
              min({{'v': temperature, 's': seq, 't': timestamp}})
                OVER (PARTITION BY id, window_start ORDER BY seq) AS lm
       FROM cl WHERE arrival = 'late'),
fired AS (
  SELECT id, window_start, window_end, 'on_time' AS firing, trigger_seq, m FROM ont
  UNION ALL
  SELECT lt.id, lt.window_start, lt.window_end, 'late', lt.trigger_seq,
         CASE WHEN ont.m IS NULL OR lt.lm < ont.m THEN lt.lm ELSE ont.m END
  FROM lt LEFT JOIN ont ON lt.id = ont.id AND lt.window_start = ont.window_start)
SELECT id, window_start, window_end, firing, trigger_seq, m.t AS timestamp, m.v AS temperature, m.s AS seq
FROM fired""", "readings_shuffled"))
def q_firing_changelog(spark, sf):
    from streamweave.operators.lateness import firing_changelog_min_by
    return firing_changelog_min_by(td.readings_shuffled(spark, sf), "1 hour", "30 minutes", "2 hours")


# ---------------------------------------------------------------- state
@register("running_count", O.with_views(
    "SELECT id, timestamp, temperature, seq, row_number() OVER (ORDER BY seq) AS count FROM readings", "readings"))
def q_running_count(spark, sf):
    from streamweave.operators.state import running_count
    return running_count(td.readings(spark, sf))


@register("count_per_key", O.with_views(
    "SELECT id, timestamp, temperature, seq, count(*) OVER (PARTITION BY id ORDER BY seq) AS count FROM readings",
    "readings"))
def q_count_per_key(spark, sf):
    from streamweave.operators.state import count_per_key
    return count_per_key(td.readings(spark, sf))


@register("list_state_size", O.with_views(
    "SELECT id, timestamp, temperature, seq, count(*) OVER (PARTITION BY id ORDER BY seq) - 1 AS list_size_before "
    "FROM readings", "readings"))
def q_list_state(spark, sf):
    from streamweave.operators.state import last_values
    return last_values(td.readings(spark, sf)).drop("values")


@register("list_state_values", O.with_views("""
SELECT id, seq, count(*) OVER f AS kept, first_value(temperature) OVER f AS oldest, last_value(temperature) OVER f AS newest
FROM readings WINDOW f AS (PARTITION BY id ORDER BY seq ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""", "readings"))
def q_list_values(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.state import last_values
    v = F.col("values")
    return last_values(td.readings(spark, sf), 3).select(
        "id", "seq", F.size(v).cast("bigint").alias("kept"), F.get(v, F.lit(0)).alias("oldest"),
        F.get(v, F.size(v) - 1).alias("newest"))


@register("temperature_jumps", O.with_views("""
SELECT id, lastTemp, temperature, seq FROM (
  SELECT id, temperature, seq, lag(temperature, 1, 0.0) OVER (PARTITION BY id ORDER BY seq) AS lastTemp
  FROM readings) WHERE abs(temperature - lastTemp) >= 10.0""", "readings"))
def q_jumps(spark, sf):
    from streamweave.operators.state import temperature_jumps
    return temperature_jumps(td.readings(spark, sf), 10.0)


def _rise_oracle(n_ms: int) -> str:
    body = f"""
r AS (SELECT id, timestamp AS t, temperature AS temp,
             row_number() OVER (PARTITION BY id ORDER BY timestamp, seq) AS rn FROM readings),
s AS (
  SELECT id, CAST(0 AS BIGINT) AS rn, CAST(4.9e-324 AS DOUBLE) AS last, CAST(NULL AS BIGINT) AS armed,
         CAST(NULL AS BIGINT) AS alert FROM (SELECT DISTINCT id FROM r)
  UNION ALL
  SELECT r.id, r.rn, r.temp,
    CASE WHEN (CASE WHEN s.armed IS NOT NULL AND r.t > s.armed THEN NULL ELSE s.armed END) IS NULL
              AND r.temp > s.last THEN r.t + {n_ms}
         WHEN (CASE WHEN s.armed IS NOT NULL AND r.t > s.armed THEN NULL ELSE s.armed END) IS NOT NULL
              AND r.temp < s.last THEN NULL
         ELSE (CASE WHEN s.armed IS NOT NULL AND r.t > s.armed THEN NULL ELSE s.armed END) END,
    CASE WHEN s.armed IS NOT NULL AND r.t > s.armed THEN s.armed END
  FROM s JOIN r ON r.id = s.id AND r.rn = s.rn + 1),
ends AS (SELECT id, max(rn) AS rn FROM r GROUP BY id)
SELECT id, alert AS alert_time FROM s WHERE alert IS NOT NULL
UNION ALL
SELECT s.id, s.armed FROM s JOIN ends ON s.id = ends.id AND s.rn = ends.rn WHERE s.armed IS NOT NULL"""
    return O.with_views(body, "readings").replace("WITH ", "WITH RECURSIVE ", 1)


@register("rising_alerts_1d", _rise_oracle(24 * H))
def q_rising(spark, sf):
    from streamweave.operators.folds import rising_alerts
    return rising_alerts(td.readings(spark, sf), "1 day")


def _login_oracle(window_s: int, max_fails: int, label: str) -> str:
    body = f"""
r AS (SELECT userId, timestamp AS t, loginState = 'fail' AS fail,
             row_number() OVER (PARTITION BY userId ORDER BY timestamp, seq) AS rn FROM logins),
s AS (
  SELECT userId, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS st, CAST(NULL AS BIGINT) AS lst,
         CAST(0 AS BIGINT) AS cnt, CAST(NULL AS BIGINT) AS e_first, CAST(NULL AS BIGINT) AS e_last,
         CAST(NULL AS BIGINT) AS e_cnt FROM (SELECT DISTINCT userId FROM r)
  UNION ALL
  SELECT r.userId, r.rn,
    CASE WHEN r.fail THEN (CASE WHEN s.st IS NULL OR r.t > s.st + {window_s} THEN r.t ELSE s.st END) END,
    CASE WHEN r.fail THEN r.t END,
    CASE WHEN r.fail THEN (CASE WHEN s.st IS NULL OR r.t > s.st + {window_s} THEN 1 ELSE s.cnt + 1 END) ELSE 0 END,
    CASE WHEN s.st IS NOT NULL AND r.t > s.st + {window_s} THEN s.st END,
    CASE WHEN s.st IS NOT NULL AND r.t > s.st + {window_s} THEN s.lst END,
    CASE WHEN s.st IS NOT NULL AND r.t > s.st + {window_s} THEN s.cnt END
  FROM s JOIN r ON r.userId = s.userId AND r.rn = s.rn + 1),
ends AS (SELECT userId, max(rn) AS rn FROM r GROUP BY userId),
closed AS (
  SELECT userId, e_first AS f, e_last AS l, e_cnt AS c FROM s WHERE e_first IS NOT NULL
  UNION ALL
  SELECT s.userId, s.st, s.lst, s.cnt FROM s JOIN ends ON s.userId = ends.userId AND s.rn = ends.rn
  WHERE s.st IS NOT NULL)
SELECT userId, f AS firstFailTime, l AS lastFailTime,
       'login fail in {label} for ' || CAST(c AS VARCHAR) || ' times' AS warningMsg
FROM closed WHERE c >= {max_fails}"""
    return O.with_views(body, "logins").replace("WITH ", "WITH RECURSIVE ", 1)


for _m in (1, 2, 3):
    def _mk(m):
        def q(spark, sf):
            from streamweave.operators.folds import login_fail_warnings
            return login_fail_warnings(td.logins(spark, sf), "12 hours", m)
        return q
    register(f"login_fail_12h_max{_m}", _login_oracle(12 * 3600, _m, "43200s"))(_mk(_m))


# ---------------------------------------------------------------- partitioning and sinks
@register("partition_custom", O.with_views(
    "SELECT id, seq, CAST((((CAST(split_part(id, '_', 2) AS INTEGER) - 1) % 8) + 8) % 8 AS INTEGER) AS partition "
    "FROM readings", "readings"))
def q_partition_custom(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.partitioning import partition_custom, sensor_number_partition
    r = td.readings(spark, sf).select("id", "seq")
    # Sensor numbers are wrapped to 1..8 first; the operator checks the range.
    number = F.pmod(F.split("id", "_").getItem(1).cast("int") - 1, F.lit(8)) + 1
    r = r.withColumn("wrapped", F.concat(F.lit("sensor_"), number.cast("string")))
    out = partition_custom(r, 8, sensor_number_partition(8, "wrapped"))
    return out.select("id", "seq", F.spark_partition_id().alias("partition"))


@register("subtask_index", O.with_views(
    "SELECT id, CAST(1 AS BIGINT) AS subtasks, count(*) AS rows FROM readings GROUP BY id", "readings"))
def q_subtask(spark, sf):
    from streamweave.operators.partitioning import key_placement
    return key_placement(td.readings(spark, sf), 4)


# ---------------------------------------------------------------- order by (partition, offset)
_TOPIC = """topic AS (SELECT id, timestamp, temperature, CAST(seq % 2 AS INTEGER) AS part, seq // 2 AS off FROM readings)"""


def _topic(spark, sf):
    """readings as two partitions of a topic, with equal offsets in both."""
    from pyspark.sql import functions as F
    return td.readings(spark, sf).select("id", "timestamp", "temperature", (F.col("seq") % 2).cast("int").alias("part"),
                                         F.expr("seq div 2").alias("off"))


@register("topic_count_per_key", O.with_views(f"""{_TOPIC}
SELECT *, count(*) OVER (PARTITION BY id ORDER BY part, off) AS count FROM topic""", "readings"))
def q_topic_count(spark, sf):
    from streamweave.operators.state import count_per_key
    return count_per_key(_topic(spark, sf), order=("part", "off"))


@register("topic_count_window", O.with_views(f"""{_TOPIC}
SELECT id, part, off, size, min_temperature, max_temperature, id || CAST(size AS VARCHAR) AS value FROM (
  SELECT id, part, off, row_number() OVER w AS rn, count(*) OVER f AS size,
         min(temperature) OVER f AS min_temperature, max(temperature) OVER f AS max_temperature
  FROM topic WINDOW w AS (PARTITION BY id ORDER BY part, off),
                    f AS (PARTITION BY id ORDER BY part, off ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
WHERE rn % 2 = 0""", "readings"))
def q_topic_count_window(spark, sf):
    from streamweave.operators.windows import count_window
    return count_window(_topic(spark, sf), "id", 10, 2, order=("part", "off"))


@register("topic_dedup_per_day", O.with_views(f"""{_TOPIC}
SELECT id, day, part, off, temperature FROM (
  SELECT *, row_number() OVER (PARTITION BY id, day ORDER BY part, off) AS k
  FROM (SELECT *, timestamp // {24 * H} AS day FROM topic)) WHERE k = 1""", "readings"))
def q_topic_dedup(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.operators.state import dedup_first
    t = _topic(spark, sf).select("id", F.expr(f"timestamp div {24 * H}").alias("day"), "part", "off", "temperature")
    return dedup_first(t, ["id", "day"], order=("part", "off"))


@register("topic_late_router", O.with_views(f"""{_TOPIC},
wm AS (SELECT *, max(timestamp) OVER (ORDER BY part, off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_DELAY}
                 AS watermark, timestamp - timestamp % {H} AS window_start FROM topic)
SELECT id, part, off, watermark,
       CASE WHEN watermark IS NULL OR watermark < window_start + {H} - 1 THEN 'on_time'
            WHEN watermark < window_start + {H} - 1 + {_LATENESS} THEN 'late' ELSE 'too_late' END AS arrival
FROM wm""", "readings"))
def q_topic_late(spark, sf):
    from streamweave.operators.lateness import classify_arrivals
    c = classify_arrivals(_topic(spark, sf), "1 hour", "30 minutes", "2 hours", order=("part", "off"))
    return c.select("id", "part", "off", "watermark", "arrival")


# ---------------------------------------------------------------- user functions
@register("window_median_1d", O.with_views(f"""
SELECT id, timestamp - timestamp % {24 * H} + {24 * H} AS window_end, count(*) AS n, median(temperature) AS median_temperature
FROM readings GROUP BY 1, 2""", "readings"))
def q_window_median(spark, sf):
    """The median of each key's day, by distributed selection."""
    from streamweave.operators.selection import window_median
    return window_median(td.readings(spark, sf).select("id", "timestamp", "temperature"), "1 day")


@register("temperature_quartiles", O.with_views("""
SELECT count(*) AS n, quantile_cont(temperature, 0.25) AS low, median(temperature) AS middle, quantile_cont(temperature, 0.75) AS high,
       substr(id, 1, 7) AS kind FROM readings GROUP BY kind""", "readings"))
def q_quartiles(spark, sf):
    """W7 on one group of all rows: no task holds it."""
    from pyspark.sql import functions as F
    from streamweave.operators.selection import order_statistics
    r = td.readings(spark, sf).select(F.substring("id", 1, 7).alias("kind"), "temperature")
    q = order_statistics(r, ["kind"], "temperature", [0.25, 0.5, 0.75])
    return q.select("n", *(F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("low", "middle", "high"))), "kind")


@register("user_aggregate_max", O.with_views(
    "SELECT id, max(temperature) AS top FROM readings GROUP BY id", "readings"))
def q_user_aggregate(spark, sf):
    """A Python aggregate whose states are combined in each task."""
    import pandas as pd

    from streamweave.functions.udf import aggregate

    def top(v: pd.Series) -> float:
        return float(v.max())

    return aggregate(td.readings(spark, sf), "id", "temperature", top, top, "double", name="top")


@register("user_aggregate_mean", O.with_views(
    "SELECT itemId, CAST(sum(timestamp) AS DOUBLE) / count(timestamp) AS mean_time FROM behaviors GROUP BY itemId", "behaviors"))
def q_user_aggregate_mean(spark, sf):
    """Create, add, merge, result over a struct state."""
    from streamweave.functions.udf import aggregate

    def partial(v: pd.Series) -> dict:
        return {"total": int(v.sum()), "n": int(v.count())}

    def merge(states: pd.Series) -> dict:
        return {"total": sum(s["total"] for s in states), "n": sum(s["n"] for s in states)}

    return aggregate(td.behaviors(spark, sf), "itemId", "timestamp", partial, merge, "double", name="mean_time",
                     state_type="struct<total: bigint, n: bigint>", result=lambda s: s["total"] / s["n"] if s["n"] else None)


@register("keyed_upsert_latest", O.with_views(
    "SELECT id, arg_max(temperature, seq) AS temperature FROM readings GROUP BY id", "readings"))
def q_upsert(spark, sf):
    from streamweave.sinks.keyed import latest_per_key
    return latest_per_key(td.readings(spark, sf), "id", "temperature")


@register("jdbc_rows", O.with_views(
    "SELECT id AS name, CAST(temperature AS VARCHAR) AS gender FROM readings", "readings"))
def q_jdbc_rows(spark, sf):
    from streamweave.sinks.jdbc import student_rows
    return student_rows(td.readings(spark, sf))


@register("keyed_merge_log", ORACLES["keyed_upsert_latest"])
def q_keyed_merge_log(spark, sf):
    """The readings in four batches of ascending seq, compacted in between."""
    from pyspark.sql import functions as F
    from streamweave.session import scratch
    from streamweave.sinks.merge_log import MergeLog
    r = td.readings(spark, sf)
    low, high = r.agg(F.min("seq"), F.max("seq")).first()
    log = MergeLog(scratch(spark), "id", "temperature")
    part = F.floor((F.col("seq") - F.lit(low)) * 4 / F.lit((high or 0) - (low or 0) + 1))
    for n in range(4):
        log.write_batch(r.where(part == n), n)
    log.compact(spark)
    return log.read(spark)


@register("keyed_strings", O.with_views(
    "SELECT CAST(seq AS VARCHAR) AS key, id || CAST(timestamp AS VARCHAR) AS value FROM readings", "readings"))
def q_keyed_strings(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.sinks.keyed import keyed_strings
    return keyed_strings(td.readings(spark, sf), "seq", F.concat("id", F.col("timestamp").cast("string")))


@register("document_rows", O.with_views(
    "SELECT 'sensor' AS index, 'readingdata' AS type, id, CAST(timestamp AS VARCHAR) AS ts FROM readings", "readings"))
def q_document_rows(spark, sf):
    from streamweave.sinks.shaping import document_rows
    return document_rows(td.readings(spark, sf)).selectExpr("index", "type", "source['id'] AS id", "source['ts'] AS ts")


@register("item_view_count_text", O.with_views(f"""{_COUNTS_5H_2H}
SELECT itemId, windowEnd, 'ItemViewCount{{itemId=' || CAST(itemId AS VARCHAR) || ', windowEnd=' ||
       CAST(windowEnd AS VARCHAR) || ', count=' || CAST(count AS VARCHAR) || '}}' AS value FROM c""", "behaviors"))
def q_item_view_count_text(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.functions.text import item_view_count_text
    from streamweave.operators.windows import item_view_counts
    c = item_view_counts(td.pageviews(spark, sf), "5 hours", "2 hours")
    return c.select("itemId", "windowEnd",
                    item_view_count_text(F.col("itemId"), F.col("windowEnd"), F.col("count")).alias("value"))


@register("user_behavior_text", O.with_views("""
SELECT seq, 'UserBehavior{userId=' || CAST(userId AS VARCHAR) || ', itemId=' || CAST(itemId AS VARCHAR) ||
       ', categoryId=null, behavior=''' || behavior || ''', timestamp=' || CAST(timestamp AS VARCHAR) || '}' AS value
FROM behaviors""", "behaviors"))
def q_user_behavior_text(spark, sf):
    from pyspark.sql import functions as F
    from streamweave.functions.text import user_behavior_text
    b = td.behaviors(spark, sf)
    return b.select("seq", user_behavior_text(F.col("userId"), F.col("itemId"), F.col("categoryId"),
                                              F.col("behavior"), F.col("timestamp")).alias("value"))


@register("rolling_max_by_final", O.with_views("""
SELECT id, timestamp, temperature, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY temperature DESC, seq) AS k FROM readings) WHERE k = 1""",
                                                "readings"))
def q_rolling_max_by_final(spark, sf):
    from streamweave.operators.aggregates import rolling_max_final
    return rolling_max_final(td.readings(spark, sf))


@register("window_count_1h", O.with_views(f"""
SELECT timestamp - timestamp % {H} AS window_start, timestamp - timestamp % {H} + {H} AS window_end, id,
       count(*) AS count FROM readings GROUP BY 1, 2, 3""", "readings"))
def q_window_count(spark, sf):
    from streamweave.operators.aggregates import window_count
    return window_count(td.readings(spark, sf), "1 hour", "id")
