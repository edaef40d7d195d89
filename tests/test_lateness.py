from streamweave.operators import lateness as L
from streamweave.sources import testdata as td

# (id, timestamp ms, temperature, seq = arrival)
ARRIVALS = [("a", 1000, 5.0, 1), ("a", 12000, 3.0, 2), ("a", 9000, 4.0, 3), ("a", 16000, 1.0, 4),
            ("a", 8000, 2.0, 5), ("a", 21000, 7.0, 6), ("a", 15000, 0.5, 7)]


def df(spark):
    return spark.createDataFrame(ARRIVALS, "id string, timestamp long, temperature double, seq long")


def test_classes(spark):
    for chunk in (1 << 20, 2):
        c = L.classify_arrivals(df(spark), "10 seconds", "0 ms", "5 seconds", chunk_rows=chunk)
        assert [r.arrival for r in c.orderBy("seq").collect()] == [
            "on_time", "on_time", "late", "on_time", "too_late", "on_time", "late"]
    assert [r.seq for r in L.late_output(df(spark), "10 seconds", "0 ms", "5 seconds").collect()] == [5]


def test_firing_changelog(spark):
    out = L.firing_changelog_min_by(df(spark), "10 seconds", "0 ms", "5 seconds", chunk_rows=2)
    got = sorted((r.window_start // 1000, r.firing, r.trigger_seq, r.temperature, r.seq) for r in out.collect())
    assert got == [(0, "late", 3, 4.0, 3), (0, "on_time", 1, 5.0, 1), (10, "late", 7, 0.5, 7),
                   (10, "on_time", 4, 1.0, 4), (20, "on_time", 6, 7.0, 6)]


def test_classes_on_events(spark, sf_dir):
    c = L.classify_arrivals(td.readings_shuffled(spark, sf_dir), "1 hour", "30 minutes", "2 hours")
    counts = {r.arrival: r["count"] for r in c.groupBy("arrival").count().collect()}
    assert sum(counts.values()) == 1000 and set(counts) <= {"on_time", "late", "too_late"}
    small = L.classify_arrivals(td.readings_shuffled(spark, sf_dir), "1 hour", "30 minutes", "2 hours",
                                chunk_rows=64)
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, small.collect()))
