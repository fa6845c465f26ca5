"""Transit-shaped inputs from the driver's tables, once for Spark and once as SQL for DuckDB.

events are pings and polls, lineitem with orders are scheduled and observed stops, supplier and nation are shapes
and stops, part and customer are alerts, routes and vehicles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.timeutil import unix

PART_BYTES = 4_000_000  # of files, for a task's share
SPLIT_BYTES = 4 * PART_BYTES  # of files, for a task that deals rows out to such shares
GAP = 50_000  # events of one user lie hours apart


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def parts(rows: DataFrame) -> int:
    """Tasks for a table by the size of its files."""
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))


def pieces(spark: SparkSession, d: str, name: str) -> DataFrame:
    """table, read by tasks of at most SPLIT_BYTES each, as a task that deals rows out to more than 200 parts holds all of its own.

    The bound is a setting of the session that lists the files, so a copy of the session lists them and the caller's is not touched.
    """
    own = spark._jsparkSession
    reader = own.cloneSession()
    bound = min(SPLIT_BYTES, own.sessionState().conf().filesMaxPartitionBytes())
    reader.conf().set("spark.sql.files.maxPartitionBytes", str(bound))
    plan = reader.read().parquet(f"{d}/{name}.parquet").logicalPlan()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(own, plan), spark)


def pings(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("long"))
    return e.select(
        F.col("event_id").alias("ord"), F.col("user_id").cast("string").alias("vehicle_id"), unix("ts").alias("ts"), F.col("event_type").alias("stop_id"),
        F.when(F.col("value") > 10, "STOPPED_AT").otherwise("IN_TRANSIT_TO").alias("status"), F.concat(F.lit("R"), F.col("k") % 7).alias("route_id"),
        F.when(F.col("k") % 11 == 0, None).otherwise((F.col("event_id") % 2).cast("int")).alias("direction_id"),
        F.concat_ws("-", "user_id", F.date_format("ts", "yyyy-MM-dd")).alias("trip_id"), "k", "value",
    )


PINGS = """pings AS (SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS vehicle, CAST(floor(epoch(ts)) AS BIGINT) AS ts, event_type AS stop_id,
  CASE WHEN value > 10 THEN 'STOPPED_AT' ELSE 'IN_TRANSIT_TO' END AS status, 'R' || (k % 7) AS route_id,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(event_id % 2 AS INTEGER) END AS direction_id, user_id || '-' || strftime(ts, '%Y-%m-%d') AS trip_id, k, value
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events))"""


def _runs(dwell: str) -> str:
    return f"""{PINGS},
dw AS (SELECT *, {dwell} AS dwell FROM pings),
lg AS (SELECT *, lag(dwell) OVER w AS ld, lag(stop_id) OVER w AS ls FROM dw WINDOW w AS (PARTITION BY vehicle ORDER BY ts, ord)),
rn AS (SELECT *, sum(CASE WHEN dwell AND NOT coalesce(ld AND ls = stop_id, false) THEN 1 ELSE 0 END) OVER (PARTITION BY vehicle ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS run FROM lg),
vs AS (SELECT vehicle, run, stop_id, min(ts) AS lo, max(ts) AS departure_ts, count(*) AS ping_count, arg_min(route_id, (ts, ord)) AS route_id, arg_min(trip_id, (ts, ord)) AS trip_id,
  min(ts * 100000000 + ord) AS firstkey FROM rn WHERE dwell GROUP BY vehicle, run, stop_id),
raw_visits AS (SELECT vs.*, lo AS arrival_ts, d.direction_id FROM vs JOIN (SELECT vehicle AS v2, ts * 100000000 + ord AS key, direction_id FROM pings) d ON d.v2 = vs.vehicle AND d.key = vs.firstkey)"""


RUNS = _runs("status = 'STOPPED_AT'")
POSITION_RUNS = _runs("true")
VISITS = f"""{RUNS},
mg AS (SELECT *, CASE WHEN lag(stop_id) OVER w = stop_id AND arrival_ts - lag(departure_ts) OVER w BETWEEN 0 AND {GAP} THEN 0 ELSE 1 END AS new FROM raw_visits WINDOW w AS (PARTITION BY vehicle ORDER BY arrival_ts, run)),
mr AS (SELECT *, sum(new) OVER (PARTITION BY vehicle ORDER BY arrival_ts, run ROWS UNBOUNDED PRECEDING) AS grp FROM mg),
hd AS (SELECT *, row_number() OVER (PARTITION BY vehicle, grp ORDER BY arrival_ts, run) AS rn FROM mr),
visits AS (SELECT vehicle, stop_id, min(arrival_ts) AS arrival_ts, max(departure_ts) AS departure_ts, CAST(sum(ping_count) AS BIGINT) AS ping_count,
  max(CASE WHEN rn = 1 THEN route_id END) AS route_id, max(CASE WHEN rn = 1 THEN trip_id END) AS trip_id, max(CASE WHEN rn = 1 THEN direction_id END) AS direction_id FROM hd GROUP BY vehicle, grp, stop_id),
day_visits AS (SELECT *, strftime(to_timestamp(arrival_ts) AT TIME ZONE 'UTC', '%Y-%m-%d') AS service_date FROM visits)"""
VISITS = VISITS.replace("strftime(to_timestamp(arrival_ts) AT TIME ZONE 'UTC', '%Y-%m-%d')", "strftime(make_timestamp(arrival_ts * 1000000), '%Y-%m-%d')")


def line_visits(spark: SparkSession, d: str) -> DataFrame:
    """Observed stops: a trip for each order, a stop for each line; some have no route or vehicle.

    The rows lie by l_orderkey, in as many parts as the lines need, so that what sorts a part needs no more memory for a larger table.
    They are read in pieces, so that neither does what deals them out, nor does it spill.
    """
    lines = pieces(spark, d, "lineitem")
    n = parts(lines)
    o = pieces(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("day")).repartition(n, "l_orderkey")
    rows = lines.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus").repartition(n, "l_orderkey").join(o, "l_orderkey")
    sched = F.lit(21600) + F.col("l_linenumber") * 600 + (F.col("l_orderkey") % 20) * 3600
    midnight = F.unix_date("day").cast("long") * 86400
    rows = rows.select(
        F.col("l_orderkey").cast("string").alias("trip_id"), F.col("l_linenumber").cast("string").alias("stop_id"), F.when(F.col("l_partkey") % 17 > 1, F.col("l_returnflag")).when(F.col("l_partkey") % 17 == 1, "").alias("route_id"),
        F.when(F.col("l_linestatus") == "F", 0).otherwise(1).alias("direction_id"), F.when(F.col("l_suppkey") % 9 == 0, "").otherwise(F.col("l_suppkey").cast("string")).alias("vehicle"), "day", "l_linenumber", "l_orderkey",
        sched.alias("sched_s"), (midnight + sched + F.col("l_partkey") % 901 - 200).alias("arrival_ts"), F.col("l_quantity").cast("long").alias("q"), (F.col("l_linenumber") + 100).cast("int").alias("stop_sequence"),
    )
    rows = rows.withColumn("departure_ts", F.col("arrival_ts") + F.col("q"))
    return rows.withColumns({"local_date": F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("arrival_ts") / 86400).cast("int")), "mode": F.when(F.col("route_id") == "A", "bus").otherwise("rail")})


LINES = """lv AS (SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_linenumber AS VARCHAR) AS stop_id, CASE WHEN l_partkey % 17 > 1 THEN l_returnflag WHEN l_partkey % 17 = 1 THEN '' END AS route_id, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 1 END AS direction_id,
  CASE WHEN l_suppkey % 9 = 0 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS vehicle, CAST(l_linenumber + 100 AS INTEGER) AS stop_sequence, CAST(o_orderdate AS DATE) AS day, l_linenumber, l_orderkey, 21600 + l_linenumber * 600 + (l_orderkey % 20) * 3600 AS sched_s,
  CAST(epoch(o_orderdate) AS BIGINT) + 21600 + l_linenumber * 600 + (l_orderkey % 20) * 3600 + l_partkey % 901 - 200 AS arrival_ts, CAST(l_quantity AS BIGINT) AS q
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
obs AS (SELECT *, row_number() OVER () AS rid, arrival_ts + q AS departure_ts, CAST(make_timestamp(arrival_ts * 1000000) AS DATE) AS local_date, CASE WHEN route_id = 'A' THEN 'bus' ELSE 'rail' END AS mode FROM lv)"""


def schedule(spark: SparkSession, d: str) -> DataFrame:
    """The same times on the order's day and the day before."""
    rows = line_visits(spark, d).groupBy("l_orderkey", "trip_id", "stop_id", "day", "sched_s", "l_linenumber").agg(F.min("route_id").alias("route_id"), F.min("direction_id").alias("direction_id"))
    rows = rows.withColumn("service_date", F.explode(F.array("day", F.date_sub("day", 1))))
    return rows.select("l_orderkey", "service_date", "trip_id", "stop_id", *planned("route_id", "direction_id"))


def planned(route: str, direction: str) -> list[Column]:
    """A schedule row's columns, of which some trips lack one; every seventh trip has no arrival time."""
    n = F.col("l_orderkey")
    return [
        F.when(n % 7 != 0, F.col("sched_s")).alias("arrival_s"), (F.col("sched_s") + 30).alias("departure_s"), F.when(n % 5 != 0, F.col(route)).alias("route_id"),
        F.col(direction).alias("direction_id"), F.when(n % 13 != 0, F.col("l_linenumber")).cast("int").alias("stop_sequence"),
    ]


def visits_and_schedule(spark: SparkSession, d: str) -> DataFrame:
    """line_visits, each with its row of schedule, for meet_own: both lie by order, so one shuffle and one sort serve all.

    l_orderkey and l_linenumber stand for the trip and the stop, whose names are their texts. Days are those of UTC, as
    in line_visits, so midnights are whole days since 1970 and no time zone is looked up for each line.
    """
    midnights = [(F.unix_date(F.date_sub("local_date", k)).cast("long") * 86400).alias(f"__m{k}") for k in (0, 1)]
    group = W.partitionBy("l_orderkey", "l_linenumber", "day")
    rows = line_visits(spark, d).withColumns({"__route": F.min("route_id").over(group), "__direction": F.min("direction_id").over(group)})
    return rows.select(
        "l_orderkey", "l_linenumber", F.col("day").alias("__from"), F.col("local_date").alias("__date"), F.struct(*planned("__route", "__direction")).alias("__due"),
        "vehicle", "route_id", "direction_id", "stop_sequence", "arrival_ts", "departure_ts", *midnights,
    )


SCHEDULE = f"""{LINES},
s0 AS (SELECT trip_id, stop_id, day, sched_s, l_linenumber, min(route_id) AS route_id, min(direction_id) AS direction_id FROM obs GROUP BY ALL),
sched AS (SELECT CAST(day - to_days(o) AS DATE) AS service_date, trip_id, stop_id, CASE WHEN CAST(trip_id AS BIGINT) % 7 = 0 THEN NULL ELSE sched_s END AS arrival_s, sched_s + 30 AS departure_s, CASE WHEN CAST(trip_id AS BIGINT) % 5 <> 0 THEN route_id END AS route_id, direction_id, CASE WHEN CAST(trip_id AS BIGINT) % 13 <> 0 THEN CAST(l_linenumber AS INTEGER) END AS stop_sequence
  FROM s0, (SELECT unnest([0, 1]) AS o))"""


ADHERENCE = f"""{SCHEDULE},
c AS (SELECT obs.*, n, CAST(local_date - to_days(CAST(n AS INTEGER)) AS DATE) AS service_date FROM obs, (SELECT unnest([0, 1]) AS n)),
j AS (SELECT c.rid, c.trip_id, c.stop_id, nullif(c.vehicle, '') AS vehicle, c.n, c.arrival_ts, c.departure_ts, c.service_date, coalesce(nullif(sched.route_id, ''), nullif(c.route_id, '')) AS route_id, coalesce(sched.direction_id, c.direction_id) AS direction_id, coalesce(sched.stop_sequence, c.stop_sequence) AS stop_sequence,
  CAST(epoch(c.service_date) AS BIGINT) + sched.arrival_s AS scheduled_arrival_unix, CAST(epoch(c.service_date) AS BIGINT) + sched.departure_s AS scheduled_departure_unix
  FROM c JOIN sched USING (service_date, trip_id, stop_id)),
k AS (SELECT *, arrival_ts - scheduled_arrival_unix AS arrival_delay_s, departure_ts - scheduled_departure_unix AS departure_delay_s FROM j),
m AS (SELECT *, coalesce(arrival_delay_s, departure_delay_s) AS basis FROM k),
p AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY abs(basis), n) AS rn FROM m WHERE basis IS NOT NULL),
facts AS (SELECT *, CASE WHEN basis < -60 THEN 'early' WHEN basis > 300 THEN 'late' ELSE 'on_time' END AS status FROM p WHERE rn = 1 AND route_id IS NOT NULL)"""


def stops(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("n_nationkey")
    return table(spark, d, "nation").select(n.cast("string").alias("stop_id"), (F.lit(40.0) + n * 0.01).alias("lat"), (F.lit(-74.0) + n * 7 % 25 * 0.01).alias("lon"), F.col("n_name").alias("name"))


STOPS = "stops AS (SELECT CAST(n_nationkey AS VARCHAR) AS stop_id, 40.0::DOUBLE + n_nationkey * 0.01::DOUBLE AS lat, -74.0::DOUBLE + n_nationkey * 7 % 25 * 0.01::DOUBLE AS lon, n_name AS name FROM nation)"


def shapes(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, d, "supplier").select((F.col("s_nationkey") % 5).cast("string").alias("shape_id"), s.alias("seq"), (F.lit(40.0) + s % 100 * 0.003).alias("lat"), (F.lit(-74.0) + s * 13 % 97 * 0.003).alias("lon"))


SHAPES = "shapes AS (SELECT CAST(s_nationkey % 5 AS VARCHAR) AS shape_id, s_suppkey AS seq, 40.0::DOUBLE + s_suppkey % 100 * 0.003::DOUBLE AS lat, -74.0::DOUBLE + s_suppkey * 13 % 97 * 0.003::DOUBLE AS lon FROM supplier)"


def hav(a: str, b: str, c: str, d: str) -> str:
    return f"2 * 6371000.0::DOUBLE * asin(sqrt(CASE WHEN ({a}) + ({b}) + ({c}) + ({d}) IS NOT NULL THEN least(1.0::DOUBLE, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)) END))"


ARCS = f"""{SHAPES},
a0 AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM shapes WINDOW w AS (PARTITION BY shape_id ORDER BY seq)),
a1 AS (SELECT *, coalesce({hav('plat', 'plon', 'lat', 'lon')}, 0) AS step FROM a0),
arcs AS (SELECT shape_id, seq, lat, lon, sum(step) OVER (PARTITION BY shape_id ORDER BY seq ROWS UNBOUNDED PRECEDING) AS dist_m FROM a1)"""

PROJECTED = f"""{ARCS}, {STOPS},
g0 AS (SELECT *, lead(lat) OVER w AS nlat, lead(lon) OVER w AS nlon, lead(dist_m) OVER w AS ndist, first_value(lat) OVER w AS lat0 FROM arcs WINDOW w AS (PARTITION BY shape_id ORDER BY seq)),
g1 AS (SELECT *, 6371000.0::DOUBLE * pi() / 180 AS k, cos(radians(lat0)) AS shrink FROM g0 WHERE nlat IS NOT NULL),
g2 AS (SELECT g1.shape_id, g1.seq, g1.dist_m, g1.ndist, stops.stop_id, (nlon - g1.lon) * k * shrink AS dx, (nlat - g1.lat) * k AS dy, (stops.lon - g1.lon) * k * shrink AS px, (stops.lat - g1.lat) * k AS py FROM g1, stops),
g3 AS (SELECT *, CASE WHEN dx * dx + dy * dy = 0 THEN 0.0 ELSE greatest(0.0, least(1.0, (px * dx + py * dy) / (dx * dx + dy * dy))) END AS t FROM g2),
g4 AS (SELECT *, pow(px - t * dx, 2) + pow(py - t * dy, 2) AS off, dist_m + t * (ndist - dist_m) AS along FROM g3),
projected AS (SELECT shape_id, stop_id, along AS along_m FROM (SELECT *, row_number() OVER (PARTITION BY shape_id, stop_id ORDER BY off, seq) AS rn FROM g4) WHERE rn = 1)"""


HEADS = ["Signal problem at", "Delays due to a DISABLED train near", "Police activity", "Snow and flooding", "Elevator out at", "Switch issue by", "Overheard wires and smoke at", "Brakes holding on", "Auto accident blocking the tracks at", "Single track for", "Sick passenger at"]
LEADS = ["expect delays of about ", "Delays of up to ", "running ", "no change ", "10-", "3 - "]
TAILS = [" minutes late", " minutes behind schedule", " min", " minutes"]


def alerts(spark: SparkSession, d: str) -> DataFrame:
    """Polls of alerts: a part is one poll of one of 97 alerts."""
    p = F.col("p_partkey")
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n + 1).cast("int"))
    cause = F.when(p % 4 == 0, "MAINTENANCE").when(p % 9 == 0, "STRIKE").when(p % 10 == 1, "UNKNOWN_CAUSE").when(p % 14 == 3, "HOLIDAY").when(p % 22 == 5, "SOMETHING_NEW").when(p % 15 == 7, "")
    effect = F.when(p % 7 == 0, "SIGNIFICANT_DELAYS").when(p % 7 == 1, "REDUCED_SERVICE").when(p % 7 == 2, "NO_SERVICE").when(p % 7 == 3, "OTHER_EFFECT").when(p % 7 == 4, "UNKNOWN_EFFECT")
    lead = pick(LEADS, p % 13 % 6)
    text = F.when(p % 31 != 0, F.concat(pick(HEADS, p % 11), F.lit(" "), F.col("p_name"), F.lit(" "), lead, F.lit(" "), lead, F.col("p_size").cast("string"), pick(TAILS, p % 17 % 4)))
    return table(spark, d, "part").select((p % 97).alias("alert_id"), (p % 1000).alias("fetched_at"), p.alias("ord"), cause.alias("cause"), effect.alias("effect"), text.alias("text"))


ALERTS = f"""polls AS (SELECT p_partkey % 97 AS alert_id, p_partkey % 1000 AS fetched_at, p_partkey AS ord,
  CASE WHEN p_partkey % 4 = 0 THEN 'MAINTENANCE' WHEN p_partkey % 9 = 0 THEN 'STRIKE' WHEN p_partkey % 10 = 1 THEN 'UNKNOWN_CAUSE' WHEN p_partkey % 14 = 3 THEN 'HOLIDAY' WHEN p_partkey % 22 = 5 THEN 'SOMETHING_NEW' WHEN p_partkey % 15 = 7 THEN '' END AS cause,
  CASE p_partkey % 7 WHEN 0 THEN 'SIGNIFICANT_DELAYS' WHEN 1 THEN 'REDUCED_SERVICE' WHEN 2 THEN 'NO_SERVICE' WHEN 3 THEN 'OTHER_EFFECT' WHEN 4 THEN 'UNKNOWN_EFFECT' END AS effect,
  CASE WHEN p_partkey % 31 <> 0 THEN {HEADS}[p_partkey % 11 + 1] || ' ' || p_name || ' ' || ph || ' ' || ph || p_size || {TAILS}[p_partkey % 17 % 4 + 1] END AS text
  FROM (SELECT *, {LEADS}[p_partkey % 13 % 6 + 1] AS ph FROM part))"""
