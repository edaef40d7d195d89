import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from streamweave import schemas
from streamweave.sources import collection, external, generator, text
from tests.fixtures import LOGIN_LINES, SENSOR_LINES, lines_df


def test_from_collection_and_elements(spark):
    df = collection.from_collection(spark, [("s_1", 1001, 4.5), ("s_2", 1002, 5.5)],
                                    schemas.SENSOR_READING)
    assert [tuple(r) for r in df.orderBy("seq").collect()] == [("s_1", 1001, 4.5, 1), ("s_2", 1002, 5.5, 2)]
    el = collection.from_elements(spark, [1, 2, 3, 4, 5], IntegerType())
    assert [r.value for r in el.orderBy("seq").collect()] == [1, 2, 3, 4, 5]


def test_read_lines_global_seq(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(SENSOR_LINES) + "\n")
    (tmp_path / "b.txt").write_text("x\ny\n")
    df = text.read_lines(spark, str(tmp_path))
    rows = df.orderBy("seq").collect()
    assert [r.seq for r in rows] == list(range(14))
    assert [r.value for r in rows if r.file.endswith("a.txt")] == SENSOR_LINES
    assert [r.value for r in rows if r.file.endswith("b.txt")] == ["x", "y"]


def test_parse_sensor_trims_like_java(spark):
    df = lines_df(spark, [" sensor_1 ,\t1700000000000 , 1 ", "sensor_2,1700000004000,2"])
    got = [tuple(r) for r in text.parse_sensor(df).orderBy("seq").collect()]
    assert got == [("sensor_1", 1700000000000, 1.0, 1), ("sensor_2", 1700000004000, 2.0, 2)]


@pytest.mark.parametrize("bad", ["sensor_1,abc,1", "sensor_1,1700000000000", "sensor_1,1.5,1"])
def test_parse_sensor_bad_row_fails(spark, bad):
    with pytest.raises(Exception):
        text.parse_sensor(lines_df(spark, [bad])).collect()


def test_parse_login_no_trim(spark):
    df = text.parse_login(lines_df(spark, LOGIN_LINES))
    assert df.count() == 14
    assert df.where("loginState = 'fail'").count() == 10
    assert text.parse_login(lines_df(spark, ["1, 2.2.2.2,fail,12"])).first().ip == " 2.2.2.2"
    with pytest.raises(Exception):
        text.parse_login(lines_df(spark, ["1,ip,fail, 12"])).collect()


def test_parse_user_behavior(spark):
    df = text.parse_user_behavior(lines_df(spark, ["7,42,3,pv,1700000000"]))
    assert tuple(df.first()) == (7, 42, 3, "pv", 1700000000, 1)


def test_csv_table_registered(spark, tmp_path):
    p = tmp_path / "sensor.csv"
    p.write_text("\n".join(SENSOR_LINES) + "\n")
    t = text.register_csv_table(spark, str(p), "sensor_csv")
    assert t.schema == schemas.CSV_SENSOR_TABLE
    assert spark.sql("select count(*) c from sensor_csv where id = 'sensor_4'").first().c == 4
    bad = tmp_path / "bad.csv"
    bad.write_text("sensor_1,notanumber,1\n")
    with pytest.raises(Exception):
        text.register_csv_table(spark, str(bad), "bad_csv").collect()


def test_generated_readings(spark):
    df = generator.generated_readings(spark, 1000)
    assert df.count() == 1000
    r = df.agg(F.min("temperature").alias("lo"), F.max("temperature").alias("hi"),
               F.min(F.expr("id like 'senor_%'").cast("int")).alias("ok")).first()
    assert 0.0 <= r.lo and r.hi < 1.0 and r.ok == 1
    assert df.collect() == generator.generated_readings(spark, 1000).collect()


def test_kafka_options():
    o = external.kafka_source_options("localhost:9092", "sensor", group_id="consumer-group")
    assert o["subscribe"] == "sensor" and o["startingOffsets"] == "earliest"
    assert o["kafka.group.id"] == "consumer-group"


def test_read_lines_across_many_blocks(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 17) for i in range(2000)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = text.read_lines(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10
        got = [(r.seq, r.value) for r in df.orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == list(enumerate(lines))


def test_numbers_are_added_in_one_scan_without_moving_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(500)))
    plan = text.read_lines(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_numbers_of_empty_files_and_empty_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    (tmp_path / "b.txt").write_text("\n\nx\n")
    (tmp_path / "c.txt").write_text("last, no line end")
    rows = text.read_lines(spark, str(tmp_path)).orderBy("seq").collect()
    assert [(r.seq, r.value) for r in rows] == [(0, ""), (1, ""), (2, "x"), (3, "last, no line end")]
    empty = tmp_path / "none"
    empty.mkdir()
    (empty / "a.txt").write_text("")
    assert text.read_lines(spark, str(empty)).count() == 0


def test_blocks_cut_otherwise_after_the_count_fail_the_job(spark, tmp_path):
    (tmp_path / "big.txt").write_text("".join(f"line {i}\n" for i in range(2000)))
    df = text.read_lines(spark, str(tmp_path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        with pytest.raises(Exception, match="changed since they were counted"):
            df.select("seq", "value").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
