"""Queries over alerts, vendors' tables, polls, feeds and snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tramline.functions import geo, stats
from tramline.operators import alerts as al
from tramline.operators import catalogue as ct
from tramline.operators import normalize as nz
from tramline.operators import segments as sg
from tramline.operators import serve
from tramline.plans.inputs import ALERTS, ARCS, PINGS, SHAPES, STOPS, alerts, pings, shapes, stops, table
from tramline.plans.scheduled import OFFSETS, offsets
from tramline.streaming import polls as po


def classified(rows):
    delay = al.is_delay(F.col("effect"), F.col("text"))
    return rows.withColumns({"type": al.alert_type(F.col("cause"), F.col("text")), "delay": delay, "minutes": F.when(delay, al.delay_minutes(F.col("text")))})


def newest(s, d):
    return classified(al.latest(alerts(s, d), ["cause", "effect", "text"]))


# The rules in words of their own, so that they and the operators can disagree.
TYPE = r"""CASE WHEN coalesce(cause, '') NOT IN ('', 'UNKNOWN_CAUSE') THEN CASE cause WHEN 'TECHNICAL_PROBLEM' THEN 'mechanical_problem' WHEN 'ACCIDENT' THEN 'car_traffic' WHEN 'MAINTENANCE' THEN 'track_work' WHEN 'CONSTRUCTION' THEN 'track_work'
    WHEN 'POLICE_ACTIVITY' THEN 'police_activity' WHEN 'MEDICAL_EMERGENCY' THEN 'medical_emergency' WHEN 'WEATHER' THEN 'weather' WHEN 'STRIKE' THEN 'strike' WHEN 'DEMONSTRATION' THEN 'demonstration' ELSE 'other' END
  WHEN regexp_matches(lower(text), 'disabled (train|trolley|bus)|train (that was disabled|being (taken out of|removed from) service)') THEN 'disabled_vehicle'
  WHEN regexp_matches(lower(text), 'signal (problem|issue|repair|maintenance|work|department)') THEN 'signal_problem'
  WHEN regexp_matches(lower(text), 's?witch (problem|issue)|switching issue') THEN 'switch_problem'
  WHEN regexp_matches(lower(text), 'brake (issue|problem)|brakes (activated|holding|applied)') THEN 'brake_problem'
  WHEN regexp_matches(lower(text), 'power (problem|issue|department work)|over(head wire|heard? wires)|catenary wires|the overhead|wire (repair|maintenance|inspection|problem)|repairs to the wire|electrical problem|overhead catenary|third rail wiring') THEN 'power_problem'
  WHEN regexp_matches(lower(text), 'door (problem|issue)') THEN 'door_problem'
  WHEN regexp_matches(lower(text), 'track (issue|problem)|(cracked|broken) rail') THEN 'track_issue'
  WHEN regexp_matches(lower(text), 'medical (emergency|assistance|attention)|(ill|sick) passenger') THEN 'medical_emergency'
  WHEN contains(lower(text), 'flooding') THEN 'flooding' WHEN contains(lower(text), 'police') THEN 'police_activity' WHEN regexp_matches(lower(text), 'fire|smoke|burning') THEN 'fire'
  WHEN regexp_matches(lower(text), 'mechanical (problem|issue)|motor problem|pantograph (problem|issue)|issue with the heating system|air pressure problem') THEN 'mechanical_problem'
  WHEN regexp_matches(lower(text), 'track (work|maintenance|repair)|overnight (work|maintenance)|personnel performed maintenance|maintenance work|single track') THEN 'track_work'
  WHEN regexp_matches(lower(text), '(unauthorized|disabled) vehicle on the tracks|vehicle blocking the tracks|(auto|car|automobile) accident|car (on|blocking) the tracks|due to traffic|car (in|blocking) the track area|auto (that was blocking|blocking the track|was removed from the track)|accident blocking the tracks') THEN 'car_traffic'
  ELSE 'other' END"""
DELAY = """CASE WHEN effect IN ('SIGNIFICANT_DELAYS', 'REDUCED_SERVICE') THEN true WHEN effect IS NOT NULL AND effect NOT IN ('', 'UNKNOWN_EFFECT', 'OTHER_EFFECT') THEN false
  ELSE (contains(low, 'delays') AND contains(low, 'minutes')) OR contains(low, 'minutes late') OR contains(low, 'minutes behind schedule') OR contains(low, 'behind schedule') END"""
SIX = "['delays of about \\d+ minutes', 'delays of up to \\d+ minutes', '\\d+ minutes late', '\\d+ minutes behind schedule', '\\d+\\s*-\\s*\\d+ minutes behind schedule', '\\d+\\s*-\\s*\\d+ minutes late']"
LATE = f"CAST(list_max(list_transform(flatten(list_transform(flatten(list_transform({SIX}, lambda p: regexp_extract_all(low, p))), lambda m: regexp_extract_all(m, '\\d+'))), lambda x: CAST(x AS INTEGER))) AS INTEGER)"


def _classified(name: str, rows: str) -> str:
    return f"""{name}_l AS (SELECT *, lower(coalesce(text, '')) AS low FROM {rows}), {name}_d AS (SELECT *, {TYPE} AS type, {DELAY} AS delay FROM {name}_l), {name} AS (SELECT *, CASE WHEN delay THEN {LATE} END AS minutes FROM {name}_d)"""


NEWEST = f"""{ALERTS},
nw AS (SELECT alert_id, min(fetched_at) AS first_seen, max(fetched_at) AS last_seen, count(*) AS poll_count FROM polls GROUP BY alert_id),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY fetched_at DESC, ord DESC) AS rn FROM polls) WHERE rn = 1),
nj AS (SELECT nw.*, cause, effect, text FROM nw JOIN nb USING (alert_id)), {_classified("nx", "nj")}"""
POLLS = f"{ALERTS}, {_classified('px', 'polls')}"

LABELS = "disabled_vehicle signal_problem switch_problem brake_problem power_problem door_problem track_issue medical_emergency flooding police_activity fire mechanical_problem track_work car_traffic weather strike demonstration other"
SUMMARY = f"{NEWEST}, lb AS (SELECT unnest(string_split('{LABELS}', ' ')) AS type), sm AS (SELECT lb.type, count(alert_id) AS alert_count, CAST(coalesce(sum(minutes), 0) AS BIGINT) AS delay_minutes FROM lb LEFT JOIN nx USING (type) GROUP BY lb.type)"


def short_names(s, d):
    """Vendors' route names, as the two vendors that need rules write them."""
    p = F.col("p_partkey")
    pick = lambda values, n: F.element_at(F.array(*map(F.lit, values)), (n + 1).cast("int"))
    marks = F.concat(pick(["Wk Rt 0", "Rte ", "ROUTE  ", "Rt. 00", "Wk ", "", "Rt"], p % 7), F.col("p_size").cast("string"), pick(["", " Loop", "a", " b", "Xy"], p % 5))
    plain = F.concat(pick(["Route ", "route ", "Line ", ""], p % 4), F.col("p_size").cast("string"), pick([" North", " Loop", "", " south", " West "], p % 5))
    a, b, c = nz.strip_route_prefix(plain)
    return table(s, d, "part").select("p_partkey", nz.strip_route_marks(marks).alias("short_name"), a.alias("token"), b.alias("bare"), c.alias("without_direction"))


SHORT_NAMES = r"""WITH t AS (SELECT p_partkey, ['Wk Rt 0', 'Rte ', 'ROUTE  ', 'Rt. 00', 'Wk ', '', 'Rt'][p_partkey % 7 + 1] || p_size || ['', ' Loop', 'a', ' b', 'Xy'][p_partkey % 5 + 1] AS m,
  trim(['Route ', 'route ', 'Line ', ''][p_partkey % 4 + 1] || p_size || [' North', ' Loop', '', ' south', ' West '][p_partkey % 5 + 1]) AS q FROM part),
u AS (SELECT *, CASE WHEN p_partkey % 7 IN (4, 6) THEN NULL ELSE regexp_extract(m, '([0-9]+)([A-Za-z]?)', 1) END AS n, regexp_extract(m, '([0-9]+)([A-Za-z]?)', 2) AS x FROM t)
SELECT p_partkey, CAST(CAST(n AS INTEGER) AS VARCHAR) || upper(x) AS short_name, q AS token, CASE WHEN lower(q[1:6]) = 'route ' THEN trim(q[7:]) END AS bare,
  CASE WHEN string_split(q, ' ')[-1] IN ('South', 'North', 'East', 'West', 'Loop') AND contains(q, ' ') THEN trim(q[1:-(length(string_split(q, ' ')[-1]) + 2)]) END AS without_direction FROM u"""


def quality_notes(s, d):
    """A20 with F36: how often a supplier's parts name what, in percent."""
    k = F.col("p_partkey")
    share = lambda n: F.count_if(k % 211 < n) * 100 / F.count(F.lit(1))
    rows = table(s, d, "part").groupBy((F.col("p_size") % 50).alias("feed")).agg(F.count(F.lit(1)).alias("rows"), *[share(n).alias(c) for c, n in (("stop", 4), ("status", 3), ("route", 2), ("dir", 1))])
    return rows.select("feed", ct.notes(F.col("rows"), {c: F.col(c) for c in ("stop", "status", "route", "dir")}).alias("notes"))


QUALITY_NOTES = """WITH r AS (SELECT p_size % 50 AS feed, 100.0::DOUBLE * count(*) FILTER (p_partkey % 211 < 4) / count(*) AS stop, 100.0::DOUBLE * count(*) FILTER (p_partkey % 211 < 3) / count(*) AS status, 100.0::DOUBLE * count(*) FILTER (p_partkey % 211 < 2) / count(*) AS route, 100.0::DOUBLE * count(*) FILTER (p_partkey % 211 < 1) / count(*) AS dir FROM part GROUP BY 1)
SELECT feed, concat_ws('; ', CASE WHEN stop < 1 THEN 'no stop_id → use --source trip-updates' WHEN status < 1 THEN 'no current_status → position-based dwell' END, CASE WHEN route < 1 THEN 'no route_id' WHEN dir < 1 THEN 'no direction → GTFS backfill' END) AS notes FROM r"""


def stored(s, d):
    n = F.col("l_linenumber")
    return table(s, d, "lineitem").select(F.col("l_suppkey").alias("agency"), F.when(n % 3 == 0, "cold").when(n % 3 == 1, "hot").otherwise("landing").alias("tier"), (F.col("l_partkey") * 10_000_000).alias("bytes"), F.col("l_quantity").cast("long").alias("objects"), (n * 100).cast("long").alias("puts"), (n * 700).cast("long").alias("gets"))


STORED = """WITH o AS (SELECT l_suppkey AS agency, l_linenumber % 3 AS t, l_partkey * 10000000 AS b, CAST(l_quantity AS BIGINT) AS q, l_linenumber AS n FROM lineitem),
c AS (SELECT agency, CAST(sum(b) AS BIGINT) AS bytes, coalesce(sum(b) FILTER (t = 0), 0) / 1073741824.0::DOUBLE * 0.00099::DOUBLE AS cold_usd, coalesce(sum(b) FILTER (t = 1), 0) / 1073741824.0::DOUBLE * 0.023::DOUBLE + coalesce(sum(q) FILTER (t = 1), 0) / 1000 * 0.0025::DOUBLE AS hot_usd,
  coalesce(sum(b) FILTER (t = 2), 0) / 1073741824.0::DOUBLE * 0.023::DOUBLE AS landing_usd, sum(n * 100) * 0.000005::DOUBLE + sum(n * 700) * 0.0000004::DOUBLE AS requests_usd FROM o GROUP BY agency)
SELECT agency, bytes, round(cold_usd, 6) AS cold_usd, round(hot_usd, 6) AS hot_usd, round(landing_usd, 6) AS landing_usd, round(requests_usd, 6) AS requests_usd, round(cold_usd + hot_usd + landing_usd + requests_usd, 6) AS total_usd FROM c"""


def daily(s, d):
    rows = pings(s, d).filter("stop_id = 'error'")
    rows = rows.select(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.col("ts") / 86400).cast("int")).alias("day"), F.lit(1).cast("long").alias("alerts"), F.col("k").alias("minutes"))
    return al.dense_daily(rows, "day", "2023-12-25", "2024-02-10", ["alerts", "minutes"]).withColumn("day", F.col("day").cast("string"))


def vehicles(s, d):
    """One vendor's rows: a line for each ping, with its clock without offset and its speed in mph."""
    p = pings(s, d)
    return p.select(
        F.col("vehicle_id"), F.col("ts").alias("feed_timestamp"), F.concat(F.lit(" "), F.when(F.col("k") % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("Rt"), F.col("k") % 12)), F.lit(" ")).alias("raw_route"),
        F.col("value").alias("raw_speed"), F.when(F.col("k") % 3 == 0, "mph").when(F.col("k") % 3 == 1, "kmh").alias("speed_unit"), "ord",
    )


def index(s, d):
    """Tokens to routes by short and long names."""
    n = table(s, d, "nation")
    a = n.select(F.concat(F.lit("Rt"), F.col("n_nationkey") % 10).alias("token"), F.col("n_name").alias("canonical"), F.lit(0).alias("col_rank"), F.col("n_nationkey").alias("ord"))
    b = n.select(F.concat(F.lit(" Rt"), F.col("n_nationkey") % 14 - 3).alias("token"), F.concat(F.lit("L"), F.col("n_nationkey")).alias("canonical"), F.lit(1).alias("col_rank"), F.col("n_nationkey").alias("ord"))
    return nz.keep_first_index(a.union(b))


INDEX = """ix0 AS (SELECT 'Rt' || (n_nationkey % 10) AS token, n_name AS canonical, 0 AS r, n_nationkey AS o FROM nation UNION ALL SELECT 'Rt' || (n_nationkey % 14 - 3), 'L' || n_nationkey, 1, n_nationkey FROM nation),
ix AS (SELECT token, canonical FROM (SELECT *, row_number() OVER (PARTITION BY token ORDER BY r, o) AS rn FROM ix0) WHERE rn = 1)"""
VEHICLES = f"""{PINGS}, veh AS (SELECT vehicle, ts, CASE WHEN k % 9 = 0 THEN '' ELSE 'Rt' || (k % 12) END AS token, value AS raw_speed, CASE WHEN k % 3 = 0 THEN 'mph' WHEN k % 3 = 1 THEN 'kmh' END AS unit, ord FROM pings), {INDEX}"""


def polled(s, d):
    p = pings(s, d)
    return p.select(F.col("stop_id").alias("feed"), "ts", "ord", F.concat(F.lit("d"), F.col("k") % 3).alias("digest"), (F.col("value") > 15).alias("ok"), "k")


POLLED = f"{PINGS}, pl AS (SELECT stop_id AS feed, ts, ord, 'd' || (k % 3) AS digest, value > 15 AS ok, k FROM pings)"


def catalogue(s, d):
    n = F.col("n_nationkey")
    return table(s, d, "nation").select((n % 3).alias("feed"), F.date_add(F.lit("1995-06-01").cast("date"), n * 60).alias("feed_start_date"), F.date_add(F.lit("1995-10-01").cast("date"), n * 75).alias("feed_end_date"), F.col("n_name").alias("feed_version"))


def order_days(s, d):
    return table(s, d, "orders").select((F.col("o_orderkey") % 4).alias("feed"), F.col("o_orderdate").cast("date").alias("day")).distinct()


INTERVAL = """cg AS (SELECT n_nationkey % 3 AS feed, CAST(DATE '1995-06-01' + n_nationkey * 60 AS DATE) AS s, CAST(DATE '1995-10-01' + n_nationkey * 75 AS DATE) AS e, n_name AS feed_version FROM nation),
dy AS (SELECT DISTINCT o_orderkey % 4 AS feed, CAST(o_orderdate AS DATE) AS day FROM orders),
iv AS (SELECT * FROM (SELECT dy.feed, day, feed_version, row_number() OVER (PARTITION BY dy.feed, day ORDER BY s DESC, feed_version DESC) AS rn FROM dy JOIN cg ON dy.feed = cg.feed AND day BETWEEN s AND e) WHERE rn = 1)"""


def pointers(s, d):
    rows = ct.snapshot_for(order_days(s, d), catalogue(s, d))
    return rows.select("feed", F.col("day").cast("string").alias("service_date"), F.col("feed_version").alias("version"))


def geometries(s, d):
    n = F.col("n_nationkey")
    return table(s, d, "nation").select((n % 3).alias("feed"), F.col("n_name").alias("version"), n.alias("shape_id"), F.concat(F.lit("G"), n).alias("geom"))


def snapshots(s, d):
    return pings(s, d).select((F.floor((F.col("ts") - 1704067200) / 259200)).cast("int").alias("snap"), F.col("vehicle_id").alias("stop_id"), (F.col("k") % 2).cast("string").alias("name")).groupBy("snap", "stop_id").agg(F.min("name").alias("name"))


SNAPS = f"{PINGS}, ps AS (SELECT CAST((ts - 1704067200) // 259200 AS INTEGER) AS snap, vehicle AS stop_id, min(CAST(k % 2 AS VARCHAR)) AS name FROM pings GROUP BY 1, 2)"


def hops(s, d):
    o = offsets(s, d)
    rows = o.groupBy("shape_id").agg(F.expr("percentile(along_m, 0.2)").alias("from_m"), F.expr("percentile(along_m, 0.8)").alias("to_m"))
    return rows.select(F.col("shape_id").alias("hop"), "shape_id", "from_m", "to_m")


HOPS = f"{OFFSETS}, hp AS (SELECT shape_id AS hop, shape_id, quantile_cont(along_m, 0.2) AS from_m, quantile_cont(along_m, 0.8) AS to_m FROM offs GROUP BY shape_id)"


def feeds(s, d):
    c = F.col("c_custkey")
    scheme = F.when(c % 2 == 0, "https").otherwise("http")
    return table(s, d, "customer").select(c.alias("feed_id"), F.concat(F.lit("Agency"), c % 40).alias("agency"), F.concat(scheme, F.lit("://H"), F.when(c % 40 < 30, c % 40).otherwise(c % 3), F.lit(".org/feed"), c % 5, F.lit("?x="), c).alias("url"), F.when(c % 7 == 0, "deprecated").alias("status"), F.when(c % 5 == 1, 0).when(c % 11 == 0, 1).alias("auth"))


FEEDS = """fd AS (SELECT c_custkey AS feed_id, 'Agency' || (c_custkey % 40) AS agency, 'h' || (CASE WHEN c_custkey % 40 < 30 THEN c_custkey % 40 ELSE c_custkey % 3 END) || '.org' AS host, '/feed' || (c_custkey % 5) AS path,
  CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE 1 END AS plain FROM customer WHERE c_custkey % 7 <> 0 AND NOT (c_custkey % 5 <> 1 AND c_custkey % 11 = 0) AND c_custkey NOT IN (SELECT s_suppkey FROM supplier))"""

COVER = ["c_mktsegment", "c_name", "thin"]


def thin(s, d):
    return table(s, d, "customer").withColumn("thin", F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, F.col("c_name")))


HEX = "list_reduce(list_transform(range(1, 65), lambda i: CAST(strpos('0123456789abcdef', sha256(n_name)[i]) - 1 AS BIGINT)), lambda a, x: (a * 16 + x) % 7)"

QUERIES = {
    "alert_latest": (lambda s, d: al.latest(alerts(s, d), ["cause", "effect", "text"]), f"WITH {NEWEST} SELECT alert_id, cause, effect, text, first_seen, last_seen, poll_count FROM nx"),
    "alert_classify": (lambda s, d: classified(alerts(s, d)).select("ord", "type", "delay"), f"WITH {POLLS} SELECT ord, type, delay FROM px"),
    "delay_minutes": (lambda s, d: alerts(s, d).select("ord", al.delay_minutes(F.col("text")).alias("minutes")), f"WITH {POLLS} SELECT ord, {LATE} AS minutes FROM px"),
    "alert_summary": (lambda s, d: al.summary(newest(s, d)), f"WITH {SUMMARY} SELECT * FROM sm"),
    "alert_ranking": (lambda s, d: al.ranked(newest(s, d).withColumn("severity", F.element_at(F.array(*map(F.lit, ["SEVERE", "INFO", "UNKNOWN_SEVERITY", "WARNING", None])), (F.col("alert_id") % 5 + 1).cast("int"))).select("alert_id", "severity", "last_seen")),
        f"WITH {NEWEST}, sv AS (SELECT alert_id, ['SEVERE', 'INFO', 'UNKNOWN_SEVERITY', 'WARNING', NULL][alert_id % 5 + 1] AS severity, last_seen FROM nx) SELECT * FROM sv ORDER BY CASE severity WHEN 'SEVERE' THEN 0 WHEN 'WARNING' THEN 1 WHEN 'INFO' THEN 2 ELSE 3 END, last_seen DESC, alert_id LIMIT 50"),
    "alert_route_filter": (lambda s, d: al.of_route(alerts(s, d).withColumn("informed_entity", F.array(F.struct((F.col("alert_id") % 5).cast("string").alias("route_id")), F.struct((F.col("ord") % 7).cast("string").alias("route_id")))), "3").select("alert_id", "ord"), f"WITH {ALERTS} SELECT alert_id, ord FROM polls WHERE alert_id % 5 = 3 OR ord % 7 = 3"),
    "alert_fan_out": (lambda s, d: al.fan_out(alerts(s, d).withColumn("informed_entity", F.slice(F.array(F.lit("a"), F.lit("b")), 1, (F.col("ord") % 3).cast("int")))).select("ord", "entity"), f"WITH {ALERTS} SELECT ord, unnest(['a', 'b'][1:ord % 3]) AS entity FROM polls"),
    "dense_daily_series": (daily, f"WITH {PINGS}, dd AS (SELECT CAST(unnest(range(DATE '2023-12-25', DATE '2024-02-11', INTERVAL 1 DAY)) AS DATE) AS day), ev AS (SELECT CAST(make_timestamp(ts * 1000000) AS DATE) AS day, k FROM pings WHERE stop_id = 'error') SELECT CAST(dd.day AS VARCHAR) AS day, count(k) AS alerts, CAST(coalesce(sum(k), 0) AS BIGINT) AS minutes FROM dd LEFT JOIN ev USING (day) GROUP BY dd.day"),
    "route_resolve_exact": (lambda s, d: nz.resolve(vehicles(s, d), index(s, d), ids=table(s, d, "nation").select(F.concat(F.lit("Rt"), F.col("n_nationkey") % 3).alias("route_id"))).select("ord", "route_id", "resolution_status"),
        f"WITH {VEHICLES} SELECT ord, CASE WHEN veh.token IN ('Rt0', 'Rt1', 'Rt2') THEN veh.token ELSE canonical END AS route_id, CASE WHEN veh.token = '' THEN 'no_route' WHEN veh.token IN ('Rt0', 'Rt1', 'Rt2') THEN 'passthrough' WHEN canonical IS NULL THEN 'route_unresolved' ELSE 'resolved' END AS resolution_status FROM veh LEFT JOIN ix ON ix.token = veh.token"),
    "keepfirst_tokens": (index, f"WITH {INDEX} SELECT * FROM ix"),
    "route_resolve_fuzzy": (lambda s, d: nz.resolve_fuzzy(table(s, d, "part").select(F.element_at(F.split("p_name", " "), 2).alias("token")), table(s, d, "part").select(F.initcap("p_name").alias("name"), F.col("p_partkey").alias("route_id"))), """WITH t AS (SELECT DISTINCT string_split(p_name, ' ')[2] AS token FROM part), n AS (SELECT upper(string_split(p_name, ' ')[1][1]) || string_split(p_name, ' ')[1][2:] || ' ' || upper(string_split(p_name, ' ')[2][1]) || string_split(p_name, ' ')[2][2:] AS name, p_partkey AS route_id FROM part),
j AS (SELECT token, route_id, row_number() OVER (PARTITION BY token ORDER BY CASE WHEN starts_with(lower(name), token) THEN 0 ELSE 1 END, length(name), name, route_id) AS rn FROM t JOIN n ON contains(lower(name), token)) SELECT token, route_id FROM j WHERE rn = 1"""),
    "unit_convert": (lambda s, d: vehicles(s, d).select("ord", F.round(nz.to_mps(F.col("raw_speed"), F.col("speed_unit")), 6).alias("mps")), f"WITH {VEHICLES} SELECT ord, round(CASE WHEN unit = 'mph' THEN raw_speed * 0.44704::DOUBLE WHEN unit = 'kmh' THEN raw_speed * (1 / 3.6::DOUBLE) END, 6) AS mps FROM veh"),
    "field_coverage": (lambda s, d: ct.coverage(thin(s, d), ["c_nationkey"], COVER), "WITH t AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN c_name END AS thin FROM customer), f AS (SELECT c_nationkey, unnest(['c_mktsegment', 'c_name', 'thin']) AS field, unnest([c_mktsegment, c_name, thin]) AS v FROM t) SELECT c_nationkey, count(*) AS rows, field, count(*) FILTER (v IS NOT NULL AND v <> '') AS set_count, round(count(*) FILTER (v IS NOT NULL AND v <> '') * 100 / count(*), 4) AS pct FROM f GROUP BY c_nationkey, field"),
    "snapshot_interval_join": (lambda s, d: ct.snapshot_for(order_days(s, d), catalogue(s, d)).select("feed", F.col("day").cast("string").alias("day"), "feed_version"), f"WITH {INTERVAL} SELECT feed, CAST(day AS VARCHAR) AS day, feed_version FROM iv"),
    "latest_version": (lambda s, d: ct.latest_version(pointers(s, d)), f"WITH {INTERVAL} SELECT feed, feed_version AS version, CAST(day AS VARCHAR) AS service_date FROM (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY day DESC, feed_version DESC) AS r2 FROM iv) WHERE r2 = 1"),
    "edited_shape_view": (lambda s, d: ct.edited_shapes(geometries(s, d), geometries(s, d).filter("shape_id % 2 = 0").select("feed", "shape_id", F.concat(F.lit("E"), F.col("geom")).alias("geom")), pointers(s, d)), f"WITH {INTERVAL}, lt AS (SELECT feed, arg_max(feed_version, (day, feed_version)) AS version FROM iv GROUP BY feed) SELECT n_nationkey % 3 AS feed, n_name AS version, n_nationkey AS shape_id, CASE WHEN n_nationkey % 2 = 0 THEN 'EG' ELSE 'G' END || n_nationkey AS geom FROM nation JOIN lt ON lt.feed = n_nationkey % 3 AND lt.version = n_name"),
    "shard_mod": (lambda s, d: table(s, d, "nation").select("n_name", ct.shard(F.col("n_name"), 7).cast("long").alias("shard")), f"SELECT n_name, CAST({HEX} AS BIGINT) AS shard FROM nation"),
    "stop_diff": (lambda s, d: ct.diff(stops(s, d).filter("stop_id <> '3'"), stops(s, d).filter("stop_id <> '5'").withColumns({"lat": F.col("lat") + F.when(F.col("stop_id").cast("int") % 4 == 0, 0.01).otherwise(0.0), "name": F.when(F.col("stop_id").cast("int") % 6 == 0, "new").otherwise(F.col("name"))})), f"""WITH {STOPS}, j AS (SELECT CAST(stop_id AS INTEGER) AS n FROM stops WHERE stop_id NOT IN ('3', '5')) SELECT CAST(1 AS BIGINT) AS added, CAST(1 AS BIGINT) AS removed, count(*) AS common, count(*) FILTER (n % 6 = 0 AND n % 4 <> 0) AS renamed, count(*) FILTER (n % 4 = 0 AND n % 6 <> 0) AS moved, count(*) FILTER (n % 12 = 0) AS renamed_and_moved FROM j"""),
    "stop_flapping": (lambda s, d: ct.flapping(snapshots(s, d).withColumns({"lat": F.col("snap") % 3, "lon": F.lit(0)}), snapshots(s, d).select("snap").distinct()), f"""WITH {SNAPS}, g AS (SELECT s.snap, i.stop_id, ps.name FROM (SELECT DISTINCT snap FROM ps) s CROSS JOIN (SELECT DISTINCT stop_id FROM ps) i LEFT JOIN ps ON ps.snap = s.snap AND ps.stop_id = i.stop_id),
r AS (SELECT stop_id, CAST(sum(CASE WHEN name IS NOT NULL AND p IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS presence_runs FROM (SELECT *, lag(name) OVER (PARTITION BY stop_id ORDER BY snap) AS p FROM g) GROUP BY stop_id),
q AS (SELECT *, snap % 3 AS lat, lag(name) OVER w AS p, lag(snap % 3) OVER w AS pl FROM ps WINDOW w AS (PARTITION BY stop_id ORDER BY snap)),
c AS (SELECT stop_id, count(*) FILTER (p IS NULL OR p <> name) AS n, count(DISTINCT name) AS u, count(*) FILTER (pl IS NULL OR pl <> lat) AS m, count(DISTINCT lat) AS v FROM q GROUP BY stop_id)
SELECT stop_id, presence_runs, u < n AS name_returns, v < m AS place_returns FROM r JOIN c USING (stop_id) WHERE presence_runs >= 2 OR u < n OR v < m"""),
    "short_names": (short_names, SHORT_NAMES),
    "quality_notes": (quality_notes, QUALITY_NOTES),
    "schema_era_union": (lambda s, d: ct.conform(table(s, d, "customer").select("c_custkey", F.col("c_name").alias("vehicle.label")), {"id": "bigint", "label": "string", "route": "string"}, {"c_custkey": "id", "vehicle.label": "label"}).unionByName(ct.conform(table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("label"), F.col("s_nationkey").alias("route")), {"id": "bigint", "label": "string", "route": "string"})), "SELECT c_custkey AS id, c_name AS label, CAST(NULL AS VARCHAR) AS route FROM customer UNION ALL SELECT s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) FROM supplier"),
    "digest_earliest": (lambda s, d: ct.earliest(polled(s, d).withColumn("key", F.concat("feed", "digest")), "key", "ts"), f"WITH {POLLED} SELECT feed || digest AS key, min(ts) AS first_ts FROM pl GROUP BY 1"),
    "dup_vs_last": (lambda s, d: po.changed(polled(s, d)).select("feed", "ts", "ord", "digest"), f"WITH {POLLED} SELECT feed, ts, ord, digest FROM (SELECT *, lag(digest) OVER (PARTITION BY feed ORDER BY ts, ord) AS b FROM pl) WHERE b IS NULL OR b <> digest"),
    "tumbling_window_dedup": (lambda s, d: po.windowed(polled(s, d), 7200), f"WITH {POLLED} SELECT feed, ts // 7200 * 7200 AS window_start, digest, min(ts) AS first_ts, count(*) AS polls FROM pl GROUP BY 1, 2, 3"),
    "hourly_merge": (lambda s, d: po.hourly(po.windowed(polled(s, d), 300)), f"WITH {POLLED}, w AS (SELECT feed, ts // 300 AS w, digest, min(ts) AS f FROM pl GROUP BY 1, 2, 3) SELECT feed, f // 3600 * 3600 AS hour, count(*) AS frames FROM w GROUP BY 1, 2"),
    "backoff_streak": (lambda s, d: po.backoff(polled(s, d)).select("feed", "ord", F.col("failures").cast("long").alias("failures"), "wait_s"), f"""WITH {POLLED}, r AS (SELECT *, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY feed ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS r FROM pl),
f AS (SELECT *, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY feed, r ORDER BY ts, ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS failures FROM r)
SELECT feed, ord, failures, CAST(CASE WHEN failures = 0 THEN 15 WHEN failures >= 5 THEN 3600 ELSE least(600, 15 * pow(2, failures - 1)) END AS INTEGER) AS wait_s FROM f"""),
    "anti_join_missing": (lambda s, d: ct.missing(table(s, d, "customer").select(F.col("c_custkey").alias("k")), table(s, d, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("k")), ["k"]), "SELECT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"),
    "crosswalk_unpivot": (lambda s, d: ct.crosswalk(table(s, d, "part").select(F.col("p_partkey").alias("route_id"), F.when(F.col("p_partkey") % 3 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("p_brand"))).alias("route_short_name"), F.col("p_name").alias("route_long_name"))), "SELECT trim(p_brand) AS alias_token, 'route_short_name' AS alias_type, p_partkey AS route_id FROM part WHERE p_partkey % 3 <> 0 UNION ALL SELECT p_name, 'route_long_name', p_partkey FROM part"),
    "candidate_dedup": (lambda s, d: ct.candidates(feeds(s, d), table(s, d, "supplier").select(F.col("s_suppkey").alias("feed_id"))).select("feed_id", "agency", "host", "path", "name"), f"""WITH {FEEDS}, k AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY host, path ORDER BY plain, feed_id) AS rn FROM fd) WHERE rn = 1),
o AS (SELECT agency FROM k GROUP BY agency HAVING count(DISTINCT host) = 1), n AS (SELECT k.*, row_number() OVER (PARTITION BY lower(agency) ORDER BY feed_id) AS i FROM k JOIN o USING (agency))
SELECT feed_id, agency, host, path, lower(agency) || CASE WHEN i > 1 THEN '-' || i ELSE '' END AS name FROM n"""),
    "outcome_buckets": (lambda s, d: ct.outcomes(pings(s, d).select(F.when(F.col("k") % 10 == 0, None).when(F.col("k") % 10 == 1, 403).when(F.col("k") % 10 == 2, 500).when(F.col("k") % 10 == 3, 401).otherwise(200).alias("status_code"), F.when(F.col("k") % 7 < 5, F.col("k") % 7 > 0).alias("parsed"))),
        f"WITH {PINGS} SELECT CASE WHEN k % 10 IN (1, 3) THEN 'needs_auth' WHEN k % 10 IN (0, 2) THEN 'dead' WHEN k % 7 NOT IN (1, 2, 3, 4) THEN 'format_mismatch' ELSE 'ok' END AS outcome, count(*) AS polls FROM pings GROUP BY 1"),
    "storage_costs": (lambda s, d: ct.costs(stored(s, d), ["agency"]), STORED),
    "agency_feeds": (lambda s, d: ct.agencies(table(s, d, "nation").select(F.col("n_regionkey").alias("agency_id"), F.col("n_name").alias("feed"))), "SELECT n_regionkey AS agency_id, array_to_string(list_sort(list(DISTINCT n_name)), ',') AS feeds, count(*) AS n FROM nation GROUP BY 1"),
    "prefix_subset": (lambda s, d: ct.subset_by_prefix(stops(s, d).withColumn("parent_station", F.when(F.col("stop_id").cast("int") % 2 == 0, F.col("name"))), "1").unionByName(ct.subset_by_prefix(stops(s, d).withColumn("parent_station", F.when(F.col("stop_id").cast("int") % 2 == 0, F.col("name"))), "NATION_1")).select("stop_id", "parent_station"), f"WITH {STOPS}, p AS (SELECT stop_id, CASE WHEN CAST(stop_id AS INTEGER) % 2 = 0 THEN name END AS parent_station FROM stops) SELECT * FROM p WHERE starts_with(coalesce(parent_station, ''), '1') OR starts_with(stop_id, '1') UNION ALL SELECT * FROM p WHERE starts_with(coalesce(parent_station, ''), 'NATION_1') OR starts_with(stop_id, 'NATION_1')"),
    "covering_shape": (lambda s, d: sg.covering_shape(offsets(s, d).select("route_id", "direction_id", F.col("stop_id").alias("from_stop_id")).distinct().join(offsets(s, d).select("route_id", "direction_id", F.col("stop_id").alias("to_stop_id")).distinct(), ["route_id", "direction_id"]), offsets(s, d), sg.popularity(offsets(s, d))).select("route_id", "direction_id", "from_stop_id", "to_stop_id", "shape_id"), f"WITH {OFFSETS} SELECT a.route_id, a.direction_id, a.stop_id AS from_stop_id, b.stop_id AS to_stop_id, a.shape_id FROM offs a JOIN offs b USING (route_id, direction_id, shape_id) WHERE a.along_m < b.along_m"),
    "hop_expansion": (lambda s, d: sg.expand_hops(hops(s, d), offsets(s, d)).select("hop", "from_stop", "next_stop", F.round("start_m", 3).alias("start_m")), f"WITH {HOPS}, x AS (SELECT hop, stop_id AS from_stop, lead(stop_id) OVER (PARTITION BY hop ORDER BY along_m, stop_id) AS next_stop, round(along_m, 3) AS start_m FROM hp JOIN offs USING (shape_id) WHERE along_m >= from_m AND along_m <= to_m) SELECT * FROM x WHERE next_stop IS NOT NULL"),
    "bracket_geometry": (lambda s, d: sg.bracket(geo.arc_lengths(shapes(s, d), ["shape_id"]), hops(s, d)).select("hop", F.size("line").alias("points"), F.array_join(F.transform("line", lambda p: p["seq"].cast("string")), ",").alias("seqs")), f"WITH {HOPS} SELECT hop, CAST(count(*) AS INTEGER) AS points, string_agg(seq, ',' ORDER BY seq) AS seqs FROM hp JOIN arcs USING (shape_id) WHERE dist_m >= from_m AND dist_m <= to_m GROUP BY hop HAVING count(*) >= 2"),
    "timezone_cascade": (lambda s, d: ct.timezone_of(table(s, d, "customer").select("c_custkey", F.col("c_custkey").cast("int").alias("city"), F.col("c_nationkey").alias("region"), F.col("c_mktsegment").alias("country")), table(s, d, "supplier").filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("int").alias("city"), F.col("s_name").alias("tz")), table(s, d, "nation").filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("region"), F.col("n_name").alias("tz")), table(s, d, "customer").select(F.col("c_mktsegment").alias("country")).distinct().filter("country < 'F'").withColumn("tz", F.col("country"))).select("c_custkey", "tz"), "SELECT c_custkey, coalesce(s_name, n_name, CASE WHEN c_mktsegment < 'F' THEN c_mktsegment END) AS tz FROM customer LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON s_suppkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 3 = 0) ON n_nationkey = c_nationkey"),
    "version_slugs": (lambda s, d: table(s, d, "orders").select("o_orderkey", ct.version_slug(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".25Z"))).alias("slug")), "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%dT%H%M%S') AS slug FROM orders"),
    "shape_wkt": (lambda s, d: shapes(s, d).groupBy("shape_id").agg(F.array_sort(F.collect_list(F.struct("seq", F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon")))).alias("p")).select("shape_id", F.length(geo.line_wkt(F.col("p"))).alias("wkt_length"), F.size("p").alias("points")), None),
    "geojson_features": (lambda s, d: serve.geojson(shapes(s, d).groupBy("shape_id").agg(F.array_sort(F.collect_list(F.struct("seq", "lat", "lon"))).alias("line")), F.col("line"), ["shape_id"]), None),
    "static_bundle": (lambda s, d: serve.export_bundle({"regions": table(s, d, "region"), "nations": table(s, d, "nation")}), None),
    "clean_values": (lambda s, d: table(s, d, "customer").select("c_custkey", stats.clean(F.col("c_acctbal") / F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey").cast("double")), 1).alias("v")), "SELECT c_custkey, round_even(CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal / c_custkey END, 1) + 0.0::DOUBLE AS v FROM customer"),
}
