from pyspark.sql import functions as F

from streamweave.operators import aggregates as A
from streamweave.operators.transforms import split_words
from streamweave.operators.windows import keep_last
from streamweave.sources import testdata as td
from tests.fixtures import SENSOR, T0, WORD_COUNTS, WORD_LINES, lines_df, sensor_df

TOPS = [20.5, 18, 21.5, 30, 21.5, 41, 18, 9.25, 9.25, 9.25, 12, 35]  # each sensor's maximum so far


def by_seq(df, col, seq="input_seq"):
    return [r[col] for r in df.orderBy(seq).collect()]


def words(spark):
    return split_words(lines_df(spark, WORD_LINES))


def test_word_count(spark):
    got = {r.word: r["count"] for r in A.word_count(words(spark)).collect()}
    assert got == WORD_COUNTS


def test_rolling_word_count_chunked(spark):
    for chunk in (1 << 20, 1000, 3):
        rc = A.rolling_word_count(words(spark), order=("seq", "pos"), per_chunk=chunk)
        assert [r["count"] for r in rc.where("word = 'oak'").orderBy("seq").collect()] == [1, 2, 3, 4]


def test_rolling_max_by_keeps_first_tie(spark):
    for chunk in (1 << 20, 2):
        out = A.rolling_max_by(sensor_df(spark), chunk_rows=chunk)
        assert by_seq(out, "seq") == [1, 2, 3, 4, 3, 6, 2, 8, 8, 8, 11, 12]


def test_rolling_reduce_and_max(spark):
    for chunk in (1 << 20, 3):
        out = A.rolling_reduce(sensor_df(spark), chunk_rows=chunk)
        assert by_seq(out, "temperature") == TOPS
        assert by_seq(out, "timestamp") == [r[1] for r in SENSOR]
        m = A.rolling_max(sensor_df(spark), chunk_rows=chunk)
        # other fields stay from the key's first record
        assert set(r.timestamp for r in m.where("id = 'sensor_3'").collect()) == {T0 + 7000}
        assert by_seq(m, "temperature") == TOPS


def test_final_forms(spark):
    f = {r.id: r.seq for r in A.rolling_max_final(sensor_df(spark)).collect()}
    assert f == {"sensor_1": 2, "sensor_2": 12, "sensor_3": 6, "sensor_4": 11}


def test_window_min_by_15s(spark):
    out = A.window_min_by(sensor_df(spark), "15 seconds")
    got = sorted(((r.window_start - T0) // 1000, r.id, r.seq) for r in out.collect())
    assert got == [(0, "sensor_1", 2), (0, "sensor_2", 1), (0, "sensor_3", 4), (15, "sensor_1", 7), (15, "sensor_3", 6),
                   (30, "sensor_2", 12), (30, "sensor_4", 10)]


def test_window_sum_and_count(spark):
    at = lambda r: ((r.window_start - T0) // 1000, r.id)
    s = {at(r): r.sum_temperature for r in A.window_sum(sensor_df(spark), "15 seconds").collect()}
    assert s[(30, "sensor_4")] == 27.0
    c = {at(r): r["count"] for r in A.window_count(sensor_df(spark), "15 seconds", "id").collect()}
    assert c[(30, "sensor_4")] == 4 and c[(15, "sensor_3")] == 1


def test_sums_keep_all_decimals_and_any_size(spark):
    df = spark.createDataFrame([("a", 0, 0.004, 1), ("a", 1, 0.004, 2), ("b", 0, 1e17, 3)],
                               "id string, timestamp long, temperature double, seq long")
    assert {r.id: r.sum_temperature for r in A.window_sum(df, "1 second").collect()} == {"a": 0.008, "b": 1e17}
    kept = keep_last(df, "1 second", 2)
    assert {r.id: r.sum_temperature for r in kept.collect()} == {"a": 0.008, "b": 1e17}


def test_word_order_by_columns_has_no_caps(spark):
    """Documents far apart, and a line of more words than any packed position would hold."""
    big = 2 ** 30 + 5
    docs = spark.createDataFrame([(5, "a a\na"), (big, "a\nb a"), (2 ** 60, " ".join(["a"] * 140_000))], "doc_id long, text string")
    rc = A.rolling_word_count(td.words_of(td.lines_of(docs)))
    assert rc.count() == 3 + 3 + 140_000 and rc.select("doc_id", "line_no", "pos").distinct().count() == rc.count()
    got = [r["count"] for r in rc.where("word = 'a' and doc_id <= " + str(big)).orderBy("doc_id", "line_no", "pos").collect()]
    assert got == [1, 2, 3, 4, 5]
    ends = rc.where("word = 'a' and doc_id > " + str(big)).agg(F.min("count"), F.max("count"), F.max("pos")).first()
    assert tuple(ends) == (6, 140_005, 139_999)
    last = rc.where("pos = 139999").first()
    assert last["count"] == 140_005


def test_distinct_and_rollup(spark):
    r = sensor_df(spark).withColumn("userId", F.col("id")).withColumn("timestamp", F.col("timestamp") / 1000)
    r = r.withColumn("timestamp", F.col("timestamp").cast("bigint"))
    d = A.distinct_per_bucket(r, "userId", bucket_s=86400).collect()
    assert [x.users for x in d] == [4]
    counts = A.window_count(sensor_df(spark), "15 seconds", "id")
    roll = {r.id: r["count"] for r in A.rollup_counts(counts, "id", 60_000).collect()}
    assert roll == {"sensor_1": 2, "sensor_2": 4, "sensor_3": 2, "sensor_4": 4}
