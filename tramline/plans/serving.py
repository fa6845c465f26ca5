"""Queries of the serving layer that join marts, versions and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions.stats import weighted_mean
from tramline.operators import catalogue as ct

from tramline.operators import visits as v
from tramline.plans.feeds import INTERVAL, NEWEST, geometries, newest, pointers
from tramline.plans.inputs import SCHEDULE, STOPS, line_visits, schedule, stops, table
from tramline.plans.scheduled import FACTS, SEGMENTS, facts, segments
from tramline.plans.transit import ROUTE_DAY, STOP_DAY, route_day, stop_day


def mart_of_latest(s, d):
    """The rows of each feed's latest version; feeds without one have none."""
    return geometries(s, d).join(ct.latest_version(pointers(s, d)).select("feed", "version"), ["feed", "version"], "left_semi")


def named(s, d):
    """Both ends' names, the id where there is none."""
    rows = segments(s, d)
    for end in ("from", "to"):
        n = stops(s, d).filter("stop_id <> '4'").select(F.col("stop_id").alias(f"{end}_stop_id"), F.col("name").alias("__n"))
        rows = rows.join(n, f"{end}_stop_id", "left").withColumn(f"{end}_name", F.coalesce("__n", f"{end}_stop_id")).drop("__n")
    return rows.select("route_id", "direction_id", "from_name", "to_name", "service_date", "speed_p50_mph")


def daily_otp(s, d):
    """The on-time share of each day."""
    return facts(s, d).groupBy("service_date").agg(F.round(F.count_if("on_time") * 100 / F.count(F.lit(1)), 4).alias("on_time_pct"), F.count(F.lit(1)).alias("matched"))


def trips_of(s, d):
    """Stop times of the trips of one route and direction, by semi-join."""
    t = line_visits(s, d).filter("route_id = 'A' and direction_id = 1").select("trip_id").distinct()
    return schedule(s, d).join(t, "trip_id", "left_semi").groupBy("stop_id").agg(F.count(F.lit(1)).alias("times"), F.min("arrival_s").alias("first_s"))


def recent_routes(s, d):
    """Each route's last day within fourteen days of the last day of all."""
    rows = stop_day(s, d).select("route_id", F.col("service_date").cast("date").alias("day"))
    last = rows.agg(F.max("day").alias("last"))
    return rows.crossJoin(F.broadcast(last)).filter("day > date_sub(last, 14)").groupBy("route_id").agg(F.max("day").cast("string").alias("last_day"))


def versions_started(s, d):
    """P20: the versions that start in a range, the first of each slug."""
    n = F.col("n_nationkey")
    rows = table(s, d, "nation").select(F.concat(F.lit("v"), n % 6).alias("slug"), F.date_add(F.lit("1995-06-01").cast("date"), n * 60).alias("start"), n.alias("ord"))
    first = rows.filter("start between date'1996-01-01' and date'1998-06-30'")
    return first.groupBy("slug").agg(F.min_by("ord", F.struct("start", "ord")).alias("ord"), F.min("start").cast("string").alias("start"))


def type_minutes(s, d):
    """The summary as a map, unpivoted again, largest first."""
    rows = newest(s, d).groupBy("type").agg(F.sum(F.coalesce("minutes", F.lit(0))).alias("m"))
    one = rows.agg(F.map_from_entries(F.collect_list(F.struct("type", "m"))).alias("by_type"))
    return one.select(F.explode("by_type").alias("type", "minutes")).orderBy(F.desc("minutes"), "type")


def compare(s, d):
    """Routes by on-time share, those without one last."""
    return daily_otp(s, d).withColumn("on_time_pct", F.when(F.col("matched") >= 3, F.col("on_time_pct"))).orderBy(F.desc_nulls_last("on_time_pct"), "service_date")


def route_page(s, d):
    """Means over a route's days, nulls skipped, weighted by visits."""
    return route_day(s, d).groupBy("route_id").agg(F.round(weighted_mean(F.col("headway_p50_s").cast("double"), F.col("visit_count")), 9).alias("headway_s"), F.countDistinct("service_date").alias("days"))


def variable_stops(s, d):
    """T5: the stops whose headways vary most."""
    return stop_day(s, d).filter("headway_cov is not null").orderBy(F.desc("headway_cov"), "route_id", "stop_id", "service_date", "direction_id").limit(25).select("route_id", "stop_id", "service_date", "headway_cov")


def latest_orders(s, d):
    """A3 at a coarser key: the newest order of each customer."""
    o = table(s, d, "orders")
    return v.dedup_latest(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


QUERIES = {
    "version_mart_read": (mart_of_latest, f"WITH {INTERVAL}, lt AS (SELECT feed, arg_max(feed_version, (day, feed_version)) AS version FROM iv GROUP BY feed) SELECT n_nationkey % 3 AS feed, n_name AS version, n_nationkey AS shape_id, 'G' || n_nationkey AS geom FROM nation JOIN lt ON lt.feed = n_nationkey % 3 AND lt.version = n_name"),
    "name_join": (named, f"WITH {SEGMENTS}, {STOPS}, nm AS (SELECT stop_id, name FROM stops WHERE stop_id <> '4') SELECT route_id, direction_id, coalesce(a.name, from_stop_id) AS from_name, coalesce(b.name, to_stop_id) AS to_name, service_date, speed_p50_mph FROM segs LEFT JOIN nm a ON a.stop_id = from_stop_id LEFT JOIN nm b ON b.stop_id = to_stop_id"),
    "daily_otp": (daily_otp, f"WITH {FACTS} SELECT sd AS service_date, round(count(*) FILTER (status = 'on_time') * 100 / count(*), 4) AS on_time_pct, count(*) AS matched FROM f2 GROUP BY sd"),
    "route_trip_semi_join": (trips_of, f"WITH {SCHEDULE} SELECT stop_id, count(*) AS times, min(arrival_s) AS first_s FROM sched WHERE trip_id IN (SELECT trip_id FROM obs WHERE route_id = 'A' AND direction_id = 1) GROUP BY stop_id"),
    "recent_routes": (recent_routes, f"WITH {STOP_DAY}, r AS (SELECT route_id, CAST(service_date AS DATE) AS day FROM stop_day) SELECT route_id, CAST(max(day) AS VARCHAR) AS last_day FROM r WHERE day > (SELECT max(day) FROM r) - 14 GROUP BY route_id"),
    "versions_started": (versions_started, "WITH r AS (SELECT 'v' || (n_nationkey % 6) AS slug, CAST(DATE '1995-06-01' + n_nationkey * 60 AS DATE) AS s, n_nationkey AS ord FROM nation) SELECT slug, arg_min(ord, (s, ord)) AS ord, CAST(min(s) AS VARCHAR) AS start FROM r WHERE s BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' GROUP BY slug"),
    "type_minutes": (type_minutes, f"WITH {NEWEST} SELECT type, CAST(sum(coalesce(minutes, 0)) AS BIGINT) AS minutes FROM nx GROUP BY type"),
    "agency_compare": (compare, f"WITH {FACTS}, o AS (SELECT sd AS service_date, CASE WHEN count(*) >= 3 THEN round(count(*) FILTER (status = 'on_time') * 100 / count(*), 4) END AS on_time_pct, count(*) AS matched FROM f2 GROUP BY sd) SELECT * FROM o ORDER BY on_time_pct DESC NULLS LAST, service_date"),
    "route_page_means": (route_page, f"WITH {ROUTE_DAY} SELECT route_id, round(sum(headway_p50_s * visit_count) / sum(CASE WHEN headway_p50_s IS NOT NULL THEN visit_count END), 9) AS headway_s, count(DISTINCT service_date) AS days FROM route_day GROUP BY route_id"),
    "variable_stops_topk": (variable_stops, f"WITH {STOP_DAY} SELECT route_id, stop_id, service_date, headway_cov FROM stop_day WHERE headway_cov IS NOT NULL ORDER BY headway_cov DESC, route_id, stop_id, service_date, direction_id NULLS FIRST LIMIT 25"),
    "latest_per_customer": (latest_orders, "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"),
}
