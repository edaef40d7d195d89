from pyspark.sql import functions as F

from streamweave.functions.text import java_split_words
from streamweave.operators import transforms as T
from tests.fixtures import T0, WORD_LINES, lines_df, sensor_df


def seqs(df):
    return sorted(r.seq for r in df.select("seq").collect())


def test_length_and_prefix(spark):
    df = lines_df(spark, WORD_LINES)
    assert [r.length for r in T.line_length(df).orderBy("seq").collect()] == [5] * 5 + [6, 5, 4, 6, 8]
    assert [r.value for r in T.starts_with(df, "w").collect()] == ["willow", "wych elm"]


def test_java_split_edge_cases(spark):
    df = lines_df(spark, ["a b  ", "  a", "", "   ", "a  b"])
    got = {r.seq: r.w for r in df.select("seq", java_split_words(F.col("value")).alias("w")).collect()}
    assert got == {1: ["a", "b"], 2: ["", "", "a"], 3: [""], 4: [], 5: ["a", "", "b"]}
    words = T.split_words(df)
    assert words.count() == 2 + 3 + 1 + 0 + 3


def test_branches_and_side_output(spark):
    r = sensor_df(spark)
    b = T.high_low(r, 20.0)
    assert seqs(T.select_branches(b, ["high"])) == [1, 3, 4, 5, 6, 12]
    assert seqs(T.select_branches(b, ["lower"])) == [2, 7, 8, 9, 10, 11]
    assert seqs(T.select_branches(b, ["high", "lower"])) == list(range(1, 13))
    main, side = T.side_output(r, F.col("temperature") > 21)
    assert seqs(main) == [3, 4, 6, 12] and seqs(side) == [1, 2, 5, 7, 8, 9, 10, 11]


def test_multi_label_split(spark):
    r = sensor_df(spark)
    b = T.split_branches(r, [("hot", F.col("temperature") > 21), ("even", F.col("seq") % 2 == 0)])
    assert seqs(T.select_branches(b, ["hot", "even"])) == [2, 3, 4, 6, 8, 10, 12]


def test_union_is_a_bag(spark):
    r = sensor_df(spark)
    b = T.high_low(r, 20.0)
    u = T.union_all(T.select_branches(b, ["high"]), T.select_branches(b, ["lower"]), r)
    assert u.count() == 24
    assert all(c == 2 for c in [x["count"] for x in u.groupBy("seq").count().collect()])


def test_connect_map(spark):
    r = sensor_df(spark)
    b = T.high_low(r, 20.0)
    out = T.connect_map(T.select_branches(b, ["high"]), T.select_branches(b, ["lower"]),
                        lambda d: d.select("id", "temperature", F.lit("high temp warning").alias("info")),
                        lambda d: d.select("id", F.lit(None).cast("double").alias("temperature"),
                                           F.lit("normal").alias("info")))
    assert out.count() == 12


def test_table_where_and_sql(spark):
    r = sensor_df(spark)
    assert T.where(T.project(r, "id,temperature"), "id='sensor_4'").count() == 4
    assert T.sql_on_view(spark, r, "sensor", "select id,temperature from sensor where id <> 'sensor_4'").count() == 8


def test_text_form(spark):
    t = T.sensor_to_text(sensor_df(spark)).where("seq = 1").first().value
    assert t == "SensorReading(id=sensor_2, timestamp=1700000100000, temperature=20.5)"


def test_event_time(spark):
    r = T.with_event_time(sensor_df(spark))
    assert r.where("seq = 1").select(F.unix_millis("event_time").alias("m")).first().m == T0
