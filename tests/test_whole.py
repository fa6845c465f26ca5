"""Queries that give all of their rows."""

from pyspark.sql import functions as F

from tramline.plans import feeds, scheduled, serving
from tramline.plans.inputs import table


def test_compare_has_every_day_and_those_without_a_share_last(spark, tiny):
    got = serving.compare(spark, tiny).collect()
    assert len(got) == serving.daily_otp(spark, tiny).count() > 40
    shares = [r["on_time_pct"] for r in got]
    known = [x for x in shares if x is not None]
    assert known == sorted(known, reverse=True) and 0 < len(known) < len(shares)
    assert shares[len(known) :] == [None] * (len(shares) - len(known))


def test_daily_counts_every_error(spark, tiny):
    errors = table(spark, tiny, "events").filter("event_type = 'error' and ts >= '2023-12-25' and ts < '2024-02-11'").count()
    assert sum(r["alerts"] for r in feeds.daily(spark, tiny).collect()) == errors > 0


def test_snapshots_have_every_stop_and_its_least_name(spark, tiny):
    e = table(spark, tiny, "events").selectExpr("cast(floor((unix_seconds(cast(ts as timestamp)) - 1704067200) / 259200) as int) as snap", "cast(user_id as string) as stop_id", "cast(regexp_extract(props, '[0-9]+', 0) as long) % 2 as odd")
    want = e.groupBy("snap", "stop_id").agg(F.min(F.col("odd").cast("string")).alias("name"))
    got = feeds.snapshots(spark, tiny)
    assert got.count() == want.count() and want.exceptAll(got).count() == 0


def test_exceptions_come_from_every_order(spark, tiny):
    o = table(spark, tiny, "orders").selectExpr("concat('S', o_orderkey % 25) as service_id", "cast(o_orderdate as date) as date").distinct()
    assert scheduled.exceptions(spark, tiny).select("service_id", "date").distinct().exceptAll(o).count() == 0
    assert o.exceptAll(scheduled.exceptions(spark, tiny).select("service_id", "date").distinct()).count() == 0
