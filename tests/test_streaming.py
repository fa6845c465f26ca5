from pyspark.sql import functions as F

from tramline.operators import visits
from tramline.streaming import polls as p

SCHEMA = "feed string, ts long, ord long, digest string"


def stream(spark, tmp_path, rows, schema, make, mode="append"):
    """Two files, so two batches; what the stream gives."""
    path, half = str(tmp_path / "in"), len(rows) // 2
    for part in (rows[:half], rows[half:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)
    query = make(source).writeStream.format("memory").queryName("out").outputMode(mode).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.table("out").collect()


def test_a_b_a_keeps_all_three(spark, tmp_path):
    rows = [("f", i, i, d) for i, d in enumerate("AABBABBB")] + [("g", 1, 1, "A")]
    want = sorted((r["feed"], r["ts"]) for r in p.changed(spark.createDataFrame(rows, SCHEMA)).collect())
    assert want == [("f", 0), ("f", 2), ("f", 4), ("f", 5), ("g", 1)]
    got = stream(spark, tmp_path, rows, SCHEMA, p.changed_stream)
    assert sorted((r["feed"], r["ts"]) for r in got) == want


def test_windows(spark, tmp_path):
    rows = [("f", t, i, d) for i, (t, d) in enumerate([(0, "A"), (10, "B"), (20, "A"), (301, "A"), (5000, "Z")])]
    batch = {(r["feed"], r["window_start"], r["digest"], r["polls"]) for r in p.windowed(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert batch == {("f", 0, "A", 2), ("f", 0, "B", 1), ("f", 300, "A", 1), ("f", 4800, "Z", 1)}
    got = stream(spark, tmp_path, rows + [("f", 5001, 9, "Z")], SCHEMA, lambda s: p.windowed_stream(s.withColumn("at", F.timestamp_seconds("ts"))))
    closed = {(r["feed"], int(r["window_start"].timestamp()), r["digest"], r["polls"]) for r in got}
    assert closed == {("f", 0, "A", 2), ("f", 0, "B", 1), ("f", 300, "A", 1)}


def test_backoff(spark):
    rows = [("f", i, i, ok) for i, ok in enumerate([True, False, False, False, False, False, True, False])]
    got = p.backoff(spark.createDataFrame(rows, "feed string, ts long, ord long, ok boolean")).orderBy("ts").collect()
    assert [(r["failures"], r["wait_s"]) for r in got] == [(0, 15), (1, 15), (2, 30), (3, 60), (4, 120), (5, 3600), (0, 15), (1, 15)]


def test_dwells_as_a_stream_equal_the_batch(spark, tmp_path):
    schema = "vehicle string, ts long, ord long, stop_id string, status string"
    rows = [(f"v{k}", 10 * i, i, "AAB"[i // 3 % 3], "STOPPED_AT" if i % 5 else "IN_TRANSIT_TO") for i in range(20) for k in (1, 2)] + [(f"v{k}", 999, 999, None, "IN_TRANSIT_TO") for k in (1, 2)]
    df = spark.createDataFrame(rows, schema)
    want = visits.fold_runs(visits.runs(df, ["vehicle"], "status"), ["vehicle"], ["ord"])
    want = sorted((r["vehicle"], r["stop_id"], r["arrival_ts"], r["departure_ts"], r["ping_count"]) for r in want.collect())
    got = stream(spark, tmp_path, rows, schema, p.dwell_stream)
    assert sorted(tuple(r) for r in got) == want


def test_latest_as_a_stream(spark, tmp_path):
    rows = [("f", i, i, d) for i, d in enumerate("ABCD")]
    got = stream(spark, tmp_path, rows, SCHEMA, lambda s: p.latest_stream(s, ["feed"], "ts"), "complete")
    assert [(r["feed"], r["digest"]) for r in got] == [("f", "D")]
