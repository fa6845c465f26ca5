"""Queries over visits: runs, headways, marts, events, serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions import timeutil
from tramline.operators import marts, serve
from tramline.operators import visits as v
from tramline.plans.inputs import GAP, PINGS, POSITION_RUNS, RUNS, VISITS, pings, table


def pi(x: str, q: int) -> str:
    return f"CAST(round_even(round(quantile_cont({x}, {q / 100}), 6), 0) AS INTEGER)"


def pf(x: str, q: int) -> str:
    return f"round(quantile_cont({x}, {q / 100}), 6)"


def day_visits(s, d):
    rows = v.visits(pings(s, d), GAP, "status")
    return rows.withColumns({"service_date": timeutil.service_date("arrival_ts", F.lit("UTC")), "feed_day": timeutil.service_date("arrival_ts", F.lit("UTC"))})


def dated(s, d):
    return pings(s, d).withColumn("instant", F.col("ts") + F.col("ord") % 365 * 86400)


OFFSET = "CASE WHEN instant >= 1710054000 AND instant < 1730613600 THEN -14400 WHEN instant >= 1741503600 AND instant < 1762063200 THEN -14400 ELSE -18000 END"
DATED = f"{PINGS}, dt AS (SELECT *, ts + ord % 365 * 86400 AS instant FROM pings), dz AS (SELECT *, {OFFSET} AS off FROM dt)"
NY = "America/New_York"

HEAD = f"""{VISITS},
routed AS (SELECT *, departure_ts - arrival_ts AS dwell_s FROM day_visits WHERE route_id IS NOT NULL AND route_id <> ''),
hw AS (SELECT *, arrival_ts - lag(arrival_ts) OVER (PARTITION BY route_id, direction_id, stop_id, service_date ORDER BY arrival_ts, departure_ts, vehicle, trip_id) AS headway_s FROM routed)"""
STOP_DAY = f"""{HEAD},
stop_day AS (SELECT service_date AS feed_day, route_id, direction_id, stop_id, service_date, count(*) AS visit_count, count(DISTINCT trip_id) AS trip_count, count(DISTINCT vehicle) AS distinct_vehicle_count,
  {pi('headway_s', 50)} AS headway_p50_s, {pi('headway_s', 90)} AS headway_p90_s, round(avg(headway_s), 6) AS headway_mean_s,
  round(CASE WHEN count(headway_s) >= 2 AND avg(headway_s) <> 0 THEN stddev_pop(headway_s) / avg(headway_s) END, 6) AS headway_cov,
  {pi('dwell_s', 50)} AS dwell_p50_s, {pi('dwell_s', 90)} AS dwell_p90_s, min(arrival_ts) AS first_service_unix, max(departure_ts) AS last_service_unix, max(departure_ts) - min(arrival_ts) AS service_span_s
  FROM hw GROUP BY route_id, direction_id, stop_id, service_date)"""
ROUTE_DAY = f"""{STOP_DAY},
rd AS (SELECT route_id, direction_id, service_date, count(*) AS visit_count, count(DISTINCT trip_id) AS trip_count, count(DISTINCT vehicle) AS distinct_vehicle_count, count(DISTINCT stop_id) AS distinct_stop_count,
  {pi('dwell_s', 50)} AS dwell_p50_s, {pi('dwell_s', 90)} AS dwell_p90_s, min(arrival_ts) AS first_service_unix, max(departure_ts) AS last_service_unix, max(departure_ts) - min(arrival_ts) AS service_span_s FROM routed GROUP BY ALL),
md AS (SELECT route_id, direction_id, service_date, {pi('headway_p50_s', 50)} AS headway_p50_s FROM stop_day GROUP BY ALL),
route_day AS (SELECT rd.service_date AS feed_day, rd.*, md.headway_p50_s FROM rd JOIN md ON rd.route_id = md.route_id AND rd.service_date = md.service_date AND rd.direction_id IS NOT DISTINCT FROM md.direction_id)"""

START, END = "2024-01-05", "2024-01-20"


def tracks(s, d):
    """Countdowns: a train for each user, a station for each kind of event."""
    p = pings(s, d)
    return p.select(F.concat(F.lit(" T"), F.col("vehicle_id"), F.lit(" ")).alias("train"), F.col("stop_id").alias("station"), F.concat(F.lit("Dest "), F.col("k") % 3).alias("destination"), "ts", (F.col("ts") + F.col("k") * 60).alias("next_arr"), F.col("k").alias("waiting_seconds"), "ord")


APPROACH = f"""{PINGS},
tr AS (SELECT 'T' || vehicle AS train, stop_id AS station, 'Dest ' || (k % 3) AS destination, ts, ts + k * 60 AS next_arr, k AS waiting_seconds, ord FROM pings),
t1 AS (SELECT *, CASE WHEN abs(next_arr - lag(next_arr) OVER w) > 200000 THEN 1 ELSE 0 END AS new FROM tr WINDOW w AS (PARTITION BY train, station, destination ORDER BY ts, ord)),
t2 AS (SELECT *, sum(new) OVER (PARTITION BY train, station, destination ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS approach FROM t1),
t3 AS (SELECT *, row_number() OVER (PARTITION BY train, station, destination, approach ORDER BY waiting_seconds, ts, ord) AS rn FROM t2),
arrivals AS (SELECT train, station, destination, CAST(approach AS BIGINT) AS approach, max(CASE WHEN rn = 1 THEN ts END) AS arrival_ts, min(waiting_seconds) AS least_wait, count(*) AS pings FROM t3 GROUP BY ALL HAVING min(waiting_seconds) <= 40)"""


def arrivals(s, d):
    return v.approaches(tracks(s, d), jump=200_000, max_wait=40)


def updates(s, d):
    p = pings(s, d)
    return p.select(
        F.col("vehicle_id").alias("trip_id"), "stop_id", F.col("ts").alias("feed_timestamp"), F.when(F.col("k") % 5 != 0, "SCHEDULED").when(F.col("k") % 10 == 0, "SKIPPED").alias("schedule_relationship"),
        F.when(F.col("k") % 3 != 0, F.col("ts") + 60).alias("arrival_time"), F.when(F.col("k") % 4 != 0, F.col("ts") + 90).alias("departure_time"), F.when(F.col("k") % 2 == 0, F.lit("")).otherwise(F.col("route_id")).alias("vehicle_id"),
        F.col("route_id").alias("vehicle_label"), "ord",
    )


UPDATES = f"""{PINGS},
up AS (SELECT vehicle AS trip_id, stop_id, ts AS feed_timestamp, CASE WHEN k % 5 <> 0 THEN 'SCHEDULED' WHEN k % 10 = 0 THEN 'SKIPPED' END AS rel, CASE WHEN k % 3 <> 0 THEN ts + 60 END AS a, CASE WHEN k % 4 <> 0 THEN ts + 90 END AS dep,
  CASE WHEN k % 2 = 0 THEN '' ELSE route_id END AS vid, route_id AS label, ord FROM pings),
usable AS (SELECT * FROM up WHERE coalesce(rel = 'SCHEDULED', true) AND (a IS NOT NULL OR dep IS NOT NULL)),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trip_id, stop_id ORDER BY feed_timestamp DESC, ord DESC) AS rn FROM usable) WHERE rn = 1)"""


def stop_day(s, d):
    return marts.stop_day(day_visits(s, d))


def route_day(s, d):
    return marts.route_day(day_visits(s, d))


def flat(rows):
    return rows.drop("by_status", "__first")


QUERIES = {
    "stop_day": (stop_day, f"WITH {STOP_DAY} SELECT * FROM stop_day"),
    "route_day": (route_day, f"WITH {ROUTE_DAY} SELECT * FROM route_day"),
    "runs_islands": (lambda s, d: v.fold_runs(v.runs(v.valid_pings(pings(s, d)), ["vehicle"], "status"), ["vehicle"], v.CARRIED), f"WITH {RUNS} SELECT vehicle, CAST(run AS BIGINT) AS run, stop_id, arrival_ts, departure_ts, ping_count, route_id, trip_id, direction_id FROM raw_visits"),
    "visits_position_mode": (lambda s, d: v.visits(pings(s, d), 0, "position").drop("run"), f"WITH {POSITION_RUNS} SELECT vehicle, stop_id, departure_ts AS arrival_ts, departure_ts, ping_count, route_id, trip_id, direction_id FROM raw_visits"),
    "visits_merged": (lambda s, d: v.visits(pings(s, d), GAP, "status"), f"WITH {VISITS} SELECT vehicle, stop_id, arrival_ts, departure_ts, ping_count, route_id, trip_id, direction_id FROM visits"),
    "headways": (lambda s, d: marts.with_headways(marts.routed(day_visits(s, d))).select("route_id", "direction_id", "stop_id", "service_date", "vehicle", "arrival_ts", "headway_s"), f"WITH {HEAD} SELECT route_id, direction_id, stop_id, service_date, vehicle, arrival_ts, headway_s FROM hw"),
    "dwell_percentiles": (lambda s, d: marts.stop_activity(day_visits(s, d)), f"""WITH {VISITS}, h AS (SELECT *, arrival_ts - lag(arrival_ts) OVER (PARTITION BY stop_id ORDER BY arrival_ts, departure_ts, vehicle) AS h FROM day_visits)
SELECT stop_id, count(*) AS visits, array_to_string(list_sort(list(DISTINCT route_id)), ',') AS routes, {pf('h', 50)} AS headway_p50, CAST(sum(departure_ts - arrival_ts) AS BIGINT) AS dwell_total FROM h GROUP BY stop_id"""),
    "headway_clip": (lambda s, d: marts.clipped_headways(day_visits(s, d), 30, 40_000), f"""WITH {HEAD} SELECT route_id, count(*) AS n, {pf('headway_s', 50)} AS p50, {pf('headway_s', 90)} AS p90, min(headway_s) AS low, max(headway_s) AS high FROM hw WHERE headway_s BETWEEN 30 AND 40000 GROUP BY route_id"""),
    "events_explode": (lambda s, d: marts.events(day_visits(s, d)).withColumn("service_date", timeutil.service_date("event_unix", F.lit(NY))), f"""WITH {VISITS}, e AS (SELECT route_id, direction_id, stop_id, trip_id, vehicle, 'ARR' AS event_type, arrival_ts AS event_unix FROM visits UNION ALL SELECT route_id, direction_id, stop_id, trip_id, vehicle, 'DEP', departure_ts FROM visits)
SELECT *, strftime(make_timestamp((event_unix - 18000) * 1000000), '%Y-%m-%d') AS service_date FROM e WHERE route_id <> ''"""),
    "trip_runs": (lambda s, d: v.trip_runs(pings(s, d)), f"""WITH {PINGS}, l AS (SELECT *, lag(trip_id) OVER (PARTITION BY vehicle ORDER BY ts, ord) AS b FROM pings)
SELECT vehicle, count(*) AS pings, count(*) FILTER (b IS NULL OR b <> trip_id) AS trip_runs, count(DISTINCT trip_id) AS trips FROM l GROUP BY vehicle"""),
    "service_date_tz": (lambda s, d: dated(s, d).select("ord", timeutil.service_date("instant", F.lit(NY)).alias("service_date")), f"WITH {DATED} SELECT ord, strftime(make_timestamp((instant + off) * 1000000), '%Y-%m-%d') AS service_date FROM dz"),
    "fmt_local": (lambda s, d: dated(s, d).select("ord", timeutil.fmt_local("instant", F.lit(NY)).alias("local_time")), f"WITH {DATED} SELECT ord, strftime(make_timestamp((instant + off) * 1000000), '%Y-%m-%d %H:%M:%S') || CASE WHEN off = -14400 THEN '-04:00' ELSE '-05:00' END AS local_time FROM dz"),
    "service_midnight_dst": (lambda s, d: dated(s, d).select("ord", timeutil.service_midnight(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("ord") % 700).cast("int")), F.lit(NY)).alias("midnight")), f"""WITH {PINGS}, m AS (SELECT ord, 1704067200 + (ord % 700) * 86400 + 43200 + 18000 AS instant FROM pings)
SELECT ord, instant - 43200 - 18000 - ({OFFSET}) AS midnight FROM m"""),
    "hms_seconds": (lambda s, d: pings(s, d).select("ord", timeutil.hms_seconds(F.concat_ws(":", F.col("k") % 30, F.when(F.col("k") % 13 == 0, "x").otherwise((F.col("ord") % 60).cast("string")), F.lpad((F.col("k") % 60).cast("string"), 2, "0"))).alias("seconds")), f"WITH {PINGS} SELECT ord, CASE WHEN k % 13 <> 0 THEN CAST((k % 30) * 3600 + (ord % 60) * 60 + k % 60 AS INTEGER) END AS seconds FROM pings"),
    "naive_local_fold": (lambda s, d: pings(s, d).select("ord", timeutil.naive_local_to_utc(F.concat(F.lit("2024-11-03T01:"), F.lpad((F.col("k") % 60).cast("string"), 2, "0"), F.lit(":00")), F.lit(NY), F.lit(1730611800) + F.col("ord") % 7200).alias("utc")), f"""WITH {PINGS}, c AS (SELECT ord, 1730610000 + (k % 60) * 60 AS f, 1730611800 + ord % 7200 AS near FROM pings)
SELECT ord, CASE WHEN abs(f + 3600 - near) < abs(f - near) THEN f + 3600 ELSE f END AS utc FROM c"""),
    "hour_bucket": (lambda s, d: pings(s, d).groupBy(timeutil.bucket("ts", 3600).alias("hour")).agg(F.count(F.lit(1)).alias("n")), f"WITH {PINGS} SELECT ts // 3600 AS hour, count(*) AS n FROM pings GROUP BY 1"),
    "dedup_latest": (lambda s, d: v.update_visits(updates(s, d), ["feed_timestamp", "ord"]), f"WITH {UPDATES} SELECT CASE WHEN vid = '' THEN label ELSE vid END AS vehicle, trip_id, stop_id, coalesce(a, dep) AS arrival_ts, coalesce(dep, a) AS departure_ts FROM last"),
    "compact_latest": (lambda s, d: v.dedup_latest(updates(s, d).filter(v.usable_update()), ["trip_id", "stop_id"], ["feed_timestamp", "ord"]).select("trip_id", "stop_id", "feed_timestamp", "arrival_time", "departure_time", "ord"), f"WITH {UPDATES} SELECT trip_id, stop_id, feed_timestamp, a AS arrival_time, dep AS departure_time, ord FROM last"),
    "approach_split": (arrivals, f"WITH {APPROACH} SELECT * FROM arrivals"),
    "destination_trips": (lambda s, d: v.destination_trips(arrivals(s, d)).select("train", "station", "destination", "arrival_ts", "trip_id", "stop_sequence"), f"""WITH {APPROACH},
d1 AS (SELECT *, CASE WHEN lag(destination) OVER w = destination THEN 0 ELSE 1 END AS new2 FROM arrivals WINDOW w AS (PARTITION BY train ORDER BY arrival_ts, station, destination)),
d2 AS (SELECT *, sum(new2) OVER (PARTITION BY train ORDER BY arrival_ts, station, destination ROWS UNBOUNDED PRECEDING) AS trip FROM d1)
SELECT train, station, destination, arrival_ts, train || '-' || lpad(CAST(trip AS BIGINT)::VARCHAR, 3, '0') || '-' || replace(upper(destination), ' ', '-') AS trip_id, CAST(row_number() OVER (PARTITION BY train, trip ORDER BY arrival_ts, station, destination) AS INTEGER) AS stop_sequence FROM d2"""),
    "trip_backfill": (lambda s, d: marts.backfill(day_visits(s, d).withColumn("route_id", F.when(F.col("arrival_ts") % 3 == 0, "").otherwise(F.col("route_id"))), day_visits(s, d).groupBy("trip_id").agg(F.min("route_id").alias("route_id"), F.min("direction_id").alias("direction_id"))).select("vehicle", "stop_id", "arrival_ts", "route_id", "direction_id"), f"""WITH {VISITS}, t AS (SELECT trip_id, min(route_id) AS r, min(direction_id) AS dd FROM visits GROUP BY trip_id),
b AS (SELECT vehicle, stop_id, arrival_ts, CASE WHEN arrival_ts % 3 = 0 THEN r ELSE route_id END AS route_id, coalesce(direction_id, dd) AS direction_id FROM visits LEFT JOIN t USING (trip_id)) SELECT * FROM b WHERE route_id IS NOT NULL AND direction_id IS NOT NULL"""),
    "read_kind_filter_limit": (lambda s, d: serve.read_kind(stop_day(s, d), START, END, {"route_id": ["R1", "R2"], "stop_id": ["click", "view"]}, 200, ["service_date", "route_id", "stop_id", "direction_id"]).select("route_id", "direction_id", "stop_id", "service_date", "visit_count"), f"WITH {STOP_DAY} SELECT route_id, direction_id, stop_id, service_date, visit_count FROM stop_day WHERE service_date BETWEEN '{START}' AND '{END}' AND route_id IN ('R1', 'R2') AND stop_id IN ('click', 'view') ORDER BY service_date, route_id, stop_id, direction_id NULLS FIRST LIMIT 200"),
    "route_means_skip": (lambda s, d: serve.route_means(route_day(s, d), False), f"WITH {ROUTE_DAY} SELECT route_id, round(avg(headway_p50_s), 4) AS headway_s, round(avg(dwell_p50_s), 4) AS dwell_s FROM route_day GROUP BY route_id"),
    "route_means_zero": (lambda s, d: serve.route_means(route_day(s, d), True), f"WITH {ROUTE_DAY} SELECT route_id, round(avg(coalesce(headway_p50_s, 0)), 4) AS headway_s, round(avg(dwell_p50_s), 4) AS dwell_s FROM route_day GROUP BY route_id"),
    "top_per_route_cap": (lambda s, d: serve.top_per_route(stop_day(s, d).filter("headway_cov is not null"), "route_id", -F.col("headway_cov"), 3, 10, ["stop_id", "service_date", "direction_id"]).select("route_id", "direction_id", "stop_id", "service_date", "headway_cov"), f"""WITH {STOP_DAY}, r AS (SELECT *, row_number() OVER (PARTITION BY route_id ORDER BY -headway_cov, stop_id, service_date, direction_id NULLS FIRST) AS rn FROM stop_day WHERE headway_cov IS NOT NULL)
SELECT route_id, direction_id, stop_id, service_date, headway_cov FROM r WHERE rn <= 3 ORDER BY -headway_cov, stop_id, service_date, direction_id NULLS FIRST LIMIT 10"""),
}
