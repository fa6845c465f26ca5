"""Steps whose shuffles or memory once grew faster than the input: their plans, without broadcasts, and odd inputs."""

import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tramline.operators import schedule, segments
from tramline.plans import inputs, scheduled

#: Most exchanges of the executed plan; the lines and the orders are shuffled once each.
EXCHANGES = {"daily_series_pivot": 5, "daily_otp": 3, "agency_compare": 4, "worst_stops_topk": 3, "adherence_fact": 2, "adherence_tallies": 3, "period_delta": 4, "route_day_otp": 4, "route_fold_export": 4, "stop_day_otp": 3}


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", EXCHANGES)
def test_facts_shuffle_lines_and_orders_once(spark, tiny, no_broadcast, name):
    text = plan(entry.queries()[name](spark, tiny))
    assert text.count("Exchange") <= EXCHANGES[name], text
    assert text.count("SortMergeJoin") == 1 and "lineitem" in text


def test_adherence_meets_only_whole_keys_and_near_dates(spark):
    day = date(2024, 3, 5)
    visits = spark.createDataFrame(
        [("T", "S", "v", day, "R", 0, 1709640000, 1709640010), ("T", None, "v", day, "R", 0, 1709640000, 1709640010), ("T", "S", "v", None, "R", 0, 1709640000, 1709640010),
         (None, "S", "v", day, "R", 0, 1709640000, 1709640010), ("T", "X", "v", day, "R", 0, 1709640000, 1709640010), ("T", "Y", "v", day, "R", 0, 1709640000, 1709640010)],
        "trip_id string, stop_id string, vehicle string, local_date date, route_id string, direction_id int, arrival_ts long, departure_ts long",
    )
    # stop X has schedules two days before and the day after only, Y one without times at its own date and one the day before
    rows = spark.createDataFrame(
        [(day, "T", "S", 43200, 43230, "R", 0, 1), (day, "T", "S", 43100, 43230, "R", 0, 1), (day, "T", None, 43200, 43230, "R", 0, 1), (None, "T", "S", 43200, 43230, "R", 0, 1), (day, None, "S", 43200, 43230, "R", 0, 1),
         (date(2024, 3, 3), "T", "X", 43200, 43230, "R", 0, 1), (date(2024, 3, 6), "T", "X", 43200, 43230, "R", 0, 1), (day, "T", "Y", None, None, "R", 0, 1), (date(2024, 3, 4), "T", "Y", 129600, 129630, "R", 0, 1)],
        "service_date date, trip_id string, stop_id string, arrival_s int, departure_s int, route_id string, direction_id int, stop_sequence int",
    )
    got = schedule.adherence(visits, rows, F.lit("UTC")).collect()
    assert sorted((r["stop_id"], r["service_date"], r["arrival_delay_s"]) for r in got) == [("S", day, 0), ("Y", date(2024, 3, 4), 0)]


@pytest.mark.parametrize("name", EXCHANGES)
def test_facts_are_sorted_once_and_no_row_is_repeated(spark, tiny, no_broadcast, name):
    text = plan(entry.queries()[name](spark, tiny))
    assert text.count(" Sort [l_orderkey") == 3 and "Generate" not in text, text  # two for the join, one for all windows


@pytest.mark.parametrize("name", EXCHANGES)
def test_facts_look_up_no_time_zone_for_each_line(spark, tiny, name):
    text = entry.queries()[name](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" in text
    assert "convert_timezone" not in text, text


@pytest.mark.parametrize("name", EXCHANGES)
def test_facts_are_dealt_out_by_tasks_of_bounded_pieces(spark, tiny, monkeypatch, name):
    monkeypatch.setattr(inputs, "SPLIT_BYTES", 20_000)
    monkeypatch.setattr(inputs, "PART_BYTES", 10_000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        leaves = entry.queries()[name](spark, tiny)._jdf.queryExecution().executedPlan().collectLeaves()
        tasks = {}
        for i in range(leaves.size()):
            scan = leaves.apply(i)
            tasks[scan.relation().location().rootPaths().head().getName()] = scan.inputRDD().getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for file, n in tasks.items():
        assert n >= os.path.getsize(f"{tiny}/{file}") / 20_000, tasks
    assert set(tasks) == {"lineitem.parquet", "orders.parquet"}


def test_pieces_hold_all_rows_and_leave_the_session_alone(spark, tiny, monkeypatch):
    monkeypatch.setattr(inputs, "SPLIT_BYTES", 20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = inputs.pieces(spark, tiny, "lineitem")
    whole = inputs.table(spark, tiny, "lineitem")
    assert rows.rdd.getNumPartitions() > whole.rdd.getNumPartitions()
    assert rows.schema == whole.schema and rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()
    assert rows.sparkSession is spark and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert inputs.pieces(spark, tiny, "lineitem").rdd.getNumPartitions() > rows.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_facts_are_those_of_the_search_in_the_schedule(spark, tmp_path):
    """Orders of several days, near and far, twice on one day or without one; lines far from the order's day, repeated, without a number, route or order."""
    first = datetime(2024, 3, 5)
    days = {1: [0], 2: [0, 1], 3: [0, 2, 3], 4: [0, 0], 5: [None, 0, 1], 6: [None], 7: [0, 1], 10: [0, 1, 5], 13: [1, -1], 35: [0, 1]}
    orders = [(k, None if n is None else first + timedelta(n)) for k, each in days.items() for n in each]
    numbers = [1, 1, 2, 70, 110, 200, 250, 500, -40, -200, None]
    lines = [(k, 17 * i + k % 3 + p, 9 * (i % 3) + k, n, float(i), "ANR"[(i + p) % 3] if i % 4 else None, "FO"[(i + k) % 2]) for k in (*days, 99) for i, n in enumerate(numbers) for p in (0, 2, 450)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    d = str(tmp_path)
    want = schedule.adherence(inputs.line_visits(spark, d), inputs.schedule(spark, d), F.lit("UTC")).withColumn("service_date", F.col("service_date").cast("string"))
    show = lambda df: sorted(map(str, df.select(*scheduled.COLUMNS).collect()))
    got = show(scheduled.facts(spark, d))
    assert len(got) > 250 and got == show(want)


def test_segments_meet_stops_without_a_shuffle(spark, tiny, no_broadcast):
    text = plan(scheduled.transit(spark, tiny))
    assert text.count("Exchange hashpartitioning(l_orderkey") == 2 and text.count("SortMergeJoin") == 1, text
    assert "from_stop_id" not in "".join(line for line in text.splitlines() if "Exchange" in line), text


def test_more_stops_than_are_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([("A", "B"), ("A", None), ("B", "X")], "from_stop_id string, to_stop_id string")
    stops = spark.createDataFrame([("A", 1.0, 2.0), ("B", 3.0, 4.0)], "stop_id string, lat double, lon double")
    want = [("A", "B", 1.0, 2.0, 3.0, 4.0)]
    columns = ["from_stop_id", "to_stop_id", "from_lat", "from_lon", "to_lat", "to_lon"]
    assert list(map(tuple, segments.with_coords(rows, stops).select(*columns).collect())) == want
    monkeypatch.setattr(segments, "MAX_STOPS", 1)
    assert list(map(tuple, segments.with_coords(rows, stops).select(*columns).collect())) == want


def test_headways_by_distinct_times_are_those_of_all_rows(spark):
    rows = spark.createDataFrame(
        [("A", "S", 10, 1), ("A", "S", 10, 1), ("A", "S", 10, None), ("B", "S", 10, 2), ("B", "S", 25, 3), ("C", "S", 40, 1), ("D", "S", 7, 1), ("D", "S", 40, 2), ("E", "S", 50, 1), ("A", "Z", 90, 4), ("C", "S", None, 9)],
        "trip_id string, stop_id string, arrival_s int, stop_sequence int",
    )
    trips = spark.createDataFrame([("A", "R", 0), ("B", "R", 0), ("C", None, 1), ("D", None, 1), ("E", "R", None)], "trip_id string, route_id string, direction_id int")
    order = W.partitionBy("route_id", "direction_id", "stop_id").orderBy("arrival_s", "trip_id", "stop_sequence")
    plain = rows.join(trips, "trip_id").withColumn("w", F.when(F.col("arrival_s").isNotNull() & F.col("direction_id").isNotNull(), F.col("arrival_s") - F.lag("arrival_s").over(order)))
    plain = plain.withColumn("w", F.when(F.col("trip_id").isin("C") & (F.col("arrival_s") == 40), 33).otherwise(F.col("w")))  # the row without a time takes no part
    columns = ["trip_id", "stop_id", "arrival_s", "stop_sequence"]
    show = lambda df, c: sorted(map(str, df.select(*columns, c).collect()))
    got = schedule.scheduled_stops(rows, trips)
    assert [x.replace("scheduled_headway", "w") for x in show(got, "scheduled_headway")] == show(plain, "w")


def test_no_window_over_all_rows_of_a_stop(spark, tiny, no_broadcast):
    df = entry.queries()["scheduled_headway"](spark, tiny)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.splitlines() if "Window [lag(arrival_s" in line]
    assert windows and all("trip_id" not in w.split("ASC NULLS FIRST")[0] for w in windows)
    assert not any("trip_id" in w and "route_id" in w for w in windows), windows
