from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tramline.functions import geo, stats
from tramline.functions import timeutil as t

ZONES = ["America/New_York", "America/Los_Angeles", "UTC", "Europe/Berlin", "Asia/Kolkata"]
INSTANTS = [0, 1710053999, 1710054000, 1730609999, 1730610000, 1730613600, 1716220800, 951782400]


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()[0]


def test_local_time_for_each_zone(spark):
    df = spark.createDataFrame([(u, z) for u in INSTANTS for z in ZONES], "u long, z string")
    for r in df.select("u", "z", t.service_date("u", "z").alias("d"), t.fmt_local("u", "z").alias("f")).collect():
        want = datetime.fromtimestamp(r["u"], ZoneInfo(r["z"]))
        assert r["d"] == want.date().isoformat()
        assert r["f"] == want.isoformat(sep=" ")


def test_service_midnight_is_noon_less_twelve_hours(spark):
    days = ["2024-03-10", "2024-11-03", "2024-07-01"]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    for r in df.select("d", t.service_midnight("d", F.lit("America/New_York")).alias("m")).collect():
        noon = datetime.fromisoformat(r["d"] + "T12:00").replace(tzinfo=ZoneInfo("America/New_York"))
        assert r["m"] == int(noon.timestamp()) - 43200


@pytest.mark.parametrize("text, want", [("00:00:00", 0), ("25:10:05", 90605), (" 7:05:09 ", 25509), ("7:05", None), ("a:00:00", None), ("", None), (None, None), ("1:2:3:4", None)])
def test_hms(spark, text, want):
    assert one(spark, t.hms_seconds(F.lit(text).cast("string"))) == want


def test_naive_clocks_take_the_candidate_near_the_poll(spark):
    z = F.lit("America/New_York")
    fold = "2024-11-03T01:30:00"
    assert one(spark, t.naive_local_to_utc(F.lit(fold), z, F.lit(1730611800))) == 1730611800
    assert one(spark, t.naive_local_to_utc(F.lit(fold), z, F.lit(1730615400))) == 1730615400
    assert one(spark, t.naive_local_to_utc(F.lit("2024-07-01 12:00:00"), z, F.lit(0))) == int(datetime(2024, 7, 1, 16, tzinfo=ZoneInfo("UTC")).timestamp())
    assert one(spark, t.naive_local_to_utc(F.lit("nonsense"), z, F.lit(0))) is None


def test_other_clocks(spark):
    z = F.lit("America/New_York")
    at = one(spark, t.meridian_to_utc(F.lit("05/08/2026 4:35:20 PM"), z))
    assert at == int(datetime(2026, 5, 8, 16, 35, 20, tzinfo=ZoneInfo("America/New_York")).timestamp())
    late = int(datetime(2026, 5, 8, 23, 59, 0, tzinfo=ZoneInfo("America/New_York")).timestamp())
    assert one(spark, t.clock_near(F.lit("12:01:00 AM"), F.lit(late), z, True)) == late + 120
    early = int(datetime(2026, 5, 8, 0, 1, 0, tzinfo=ZoneInfo("America/New_York")).timestamp())
    assert one(spark, t.clock_near(F.lit("11:59 PM"), F.lit(early), z, False)) == early - 120
    assert one(spark, t.clock_near(F.lit("x"), F.lit(early), z, False)) is None
    assert one(spark, t.iso_offset_to_utc(F.lit("2024-05-20T12:00:00-04:00"))) == 1716220800
    assert one(spark, t.iso_offset_to_utc(F.lit("2024-05-20T16:00:00Z"))) == 1716220800
    assert one(spark, t.iso_offset_to_utc(F.lit("2024-05-20T16:00:00"))) is None


def test_percentiles_round_half_to_even(spark):
    df = spark.createDataFrame([(60,), (120,), (180,), (240,), (None,)], "x long")
    r = df.agg(stats.pct_int("x", 50), stats.pct_int("x", 90)).first()
    assert tuple(r) == (150, 222)
    assert spark.createDataFrame([(1,), (2,)], "x long").agg(stats.pct_int("x", 50)).first()[0] == 2
    assert spark.createDataFrame([(2,), (3,)], "x long").agg(stats.pct_int("x", 50)).first()[0] == 2
    assert df.filter("x is null").agg(stats.pct_int("x", 50)).first()[0] is None
    assert spark.createDataFrame([(5,)], "x long").agg(stats.cov("x")).first()[0] is None


def test_clean(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (0.25,), (0.35,)], "x double")
    assert [r[0] for r in df.select(stats.clean("x", 1)).collect()] == [None, None, 0.2, 0.4]


def test_projection_onto_a_bent_shape(spark):
    shape = spark.createDataFrame([("s", 1, 40.0, -74.0), ("s", 2, 40.0, -73.99), ("s", 3, 40.01, -73.99), ("p", 1, 0.0, 0.0)], "shape_id string, seq int, lat double, lon double")
    stops = spark.createDataFrame([("s", "a", 40.0, -74.0), ("s", "b", 40.0001, -73.995), ("s", "c", 40.02, -73.99), ("p", "a", 0.0, 0.0), ("s", "none", None, None)], "shape_id string, stop_id string, stop_lat double, stop_lon double")
    got = {(r[0], r[1]): r[2] for r in geo.project(shape, stops).collect()}
    first = one(spark, geo.haversine_m(*map(F.lit, (40.0, -74.0, 40.0, -73.99))))
    second = one(spark, geo.haversine_m(*map(F.lit, (40.0, -73.99, 40.01, -73.99))))
    assert got["s", "a"] == 0 and abs(got["s", "b"] - first / 2) < 0.01 and abs(got["s", "c"] - first - second) < 0.01
    assert got["p", "a"] is None and got["s", "none"] is None
    assert one(spark, geo.haversine_m(*map(F.lit, (None, -74.0, 40.0, -73.99)))) is None


def test_line_wkt(spark):
    line = F.array(F.struct(F.lit(2).alias("seq"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon")), F.struct(F.lit(1).alias("seq"), F.lit(0.5).alias("lat"), F.lit(3.0).alias("lon")))
    assert one(spark, geo.line_wkt(line)) == "LINESTRING(3.0 0.5, 2.5 1.5)"
