"""Vendor tables to one shape: ids resolved, SI units, UTC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.stats import true
from tramline.functions.timeutil import clock_near, iso_offset_to_utc, naive_local_to_utc

MPH_MPS, KPH_MPS = 0.44704, 1 / 3.6
OUT = ["vehicle_id", "ts_utc", "latitude", "longitude", "route_id", "trip_id", "stop_id", "speed_mps", "bearing", "raw_route", "raw_speed", "speed_unit", "resolution_status"]


def to_mps(value: Column, unit: Column) -> Column:
    """metres a second; null for NaN, null and unknown units."""
    v = value.try_cast("double")
    v = F.when(~F.isnan(v), v)
    return F.when(unit == "mph", v * MPH_MPS).when(unit == "kmh", v * KPH_MPS).when(unit == "mps", v)


def resolve(rows: DataFrame, index: DataFrame, tokens: list[Column] | None = None, ids: DataFrame | None = None) -> DataFrame:
    """The canonical id of the first token that has one, and how that went.

    index: (token, canonical), unique. tokens: candidates in turn, by default the trimmed raw_route. A raw_route that is a
    route's id itself (in ids: route_id) passes through before any candidate is looked up.
    """
    raw = true(F.trim("raw_route"))
    ids = (index.select(F.col("canonical").alias("route_id")) if ids is None else ids.select("route_id")).distinct()
    rows = rows.drop("route_id").join(ids.select(F.col("route_id").alias("__id")), raw == F.col("__id"), "left")
    found = []
    for k, token in enumerate(tokens or [raw]):
        i = index.select(F.col("token").alias(f"__t{k}"), F.col("canonical").alias(f"__c{k}"))
        rows = rows.withColumn(f"__w{k}", token).join(i, F.col(f"__w{k}") == F.col(f"__t{k}"), "left").drop(f"__w{k}", f"__t{k}")
        found.append(f"__c{k}")
    status = F.when(raw.isNull(), "no_route").when(F.col("__id").isNotNull(), "passthrough").when(F.coalesce(*found).isNull(), "route_unresolved").otherwise("resolved")
    return rows.withColumn("route_id", F.coalesce("__id", *found)).withColumn("resolution_status", status).drop("__id", *found)


def keep_first_index(rows: DataFrame) -> DataFrame:
    """Token to canonical id; an earlier column beats an earlier row. rows: (token, canonical, col_rank, ord)."""
    order = W.partitionBy("token").orderBy("col_rank", "ord")
    named = rows.withColumn("token", F.trim("token")).filter("token <> ''")
    return named.withColumn("__n", F.row_number().over(order)).filter("__n = 1").select("token", "canonical")


def resolve_fuzzy(tokens: DataFrame, names: DataFrame) -> DataFrame:
    """The route whose name starts with the token, else contains it; shortest, then first name.

    Case doesn't matter. It compares distinct tokens with all names, so give it those that an exact lookup left.
    """
    t, n = F.lower(F.trim("token")), F.lower("name")
    j = tokens.select("token").distinct().filter(F.trim("token") != "").join(names, F.contains(n, t))
    rank = F.when(F.startswith(n, t), 0).otherwise(1)
    order = W.partitionBy("token").orderBy(rank, F.length("name"), "name", "route_id")
    return j.withColumn("__n", F.row_number().over(order)).filter("__n = 1").select("token", "route_id")


DIRECTIONS = "South North East West Loop".split()


def strip_route_prefix(token: Column) -> list[Column]:
    """candidates in turn: the token, without 'Route ', then the token without a direction at its end."""
    t = F.trim(token)
    bare = F.when(F.startswith(F.lower(t), F.lit("route ")), F.trim(F.substring(t, 7, 1 << 30)))
    ends = F.when(t.rlike(f" ({'|'.join(DIRECTIONS)})$"), F.trim(F.regexp_replace(t, f" ({'|'.join(DIRECTIONS)})$", "")))
    return [t, bare, ends]


def strip_route_marks(token: Column) -> Column:
    """the number, with one letter if it follows at once, after Wk, Rt, Rte or Route; no leading zeros; else null."""
    bare = F.trim(F.regexp_replace(token, r"(?i)^(wk\s+)?(rte?\.?\s+|route\s+)", ""))
    number = true(F.regexp_extract(bare, r"^(\d+[A-Za-z]?)", 1))
    return F.upper(F.regexp_replace(number, r"^0+(?=\d)", ""))


def two_hop(rows: DataFrame, static: DataFrame, sidecar: DataFrame, routes: DataFrame) -> DataFrame:
    """Line number to route by the static map, else by the sidecar's commercial name."""
    a = static.select(F.col("id_ligne").alias("__l"), F.col("route_id").alias("__a"))
    b = sidecar.join(routes, sidecar.nom_commercial == routes.route_short_name).select(F.col("id_ligne").alias("__m"), F.col("route_id").alias("__b"))
    rows = rows.join(a, F.col("route_line_id") == F.col("__l"), "left").join(b, F.col("route_line_id") == F.col("__m"), "left")
    return rows.withColumn("route_id", F.coalesce("__a", "__b")).drop("__l", "__m", "__a", "__b")


def _shape(rows: DataFrame, **given: Column) -> DataFrame:
    null = {"vehicle_id": "string", "ts_utc": "long", "latitude": "double", "longitude": "double", "trip_id": "string", "stop_id": "string", "bearing": "double", "raw_route": "string", "raw_speed": "double", "speed_unit": "string"}
    columns = {k: given.get(k, F.lit(None)).cast(t) for k, t in null.items()}
    return rows.select(*[c.alias(k) for k, c in columns.items()])


WRTA_LINES = {18045: "27", 18046: "2", 18047: "4", 18062: "30", 18063: "33", 18068: "1", 18069: "11", 18070: "7"}


def _vehicle(t: DataFrame, heading: str, ts: Column, raw: Column | None, speed: str, unit: str | None) -> DataFrame:
    """A vendor's rows; a speed of unknown unit stays raw."""
    raw = F.lit(None) if raw is None else F.trim(raw.cast("string"))
    return _shape(t, vehicle_id=F.coalesce(F.col("vehicle_id").cast("string"), F.lit("")), ts_utc=F.coalesce(ts, F.col("feed_timestamp")), latitude=F.col("latitude"), longitude=F.col("longitude"), bearing=F.col(heading), raw_route=true(raw), raw_speed=F.col(speed), speed_unit=F.lit(unit or "unknown"))


# Table -> its columns in the common shape, before resolution. Each takes the table and the time zone as a column.
NORMALIZERS: dict[str, Callable[[DataFrame, Column], DataFrame]] = {
    "lirr_trains": lambda t, tz: _shape(t, vehicle_id=F.coalesce("train_num", F.lit("")), ts_utc=F.coalesce("location_timestamp", "feed_timestamp"), latitude=F.col("latitude"), longitude=F.col("longitude"), trip_id=true(F.trim("train_num")), stop_id=true(F.trim("current_stop_code")), raw_speed=F.col("speed_mph"), speed_unit=F.lit("mph")),
    "mwrta_vehicles": lambda t, tz: _vehicle(t, "heading", naive_local_to_utc("vehicle_datetime", tz, "feed_timestamp"), F.col("route"), "speed", None),
    "ccrta_vehicles": lambda t, tz: _vehicle(t, "heading", naive_local_to_utc("vehicle_datetime", tz, "feed_timestamp"), F.coalesce(true(F.trim("route_name")), F.col("route")), "speed", None),
    "routematch_vehicles": lambda t, tz: _vehicle(t, "heading", iso_offset_to_utc("last_update"), F.col("route_id"), "speed", "mph"),
    "trillium_vehicles": lambda t, tz: _vehicle(t, "heading_degrees", iso_offset_to_utc("last_updated"), F.col("route_short_name"), "speed", None),
    "swiv_vehicles": lambda t, tz: _vehicle(t, "heading", F.lit(None).cast("long"), F.col("route_line_id"), "speed", "kmh"),
    "vta_vehicles": lambda t, tz: _vehicle(t, "bearing", naive_local_to_utc("last_update", tz, "feed_timestamp"), F.col("headsign_text"), "velocity", "mph"),
    "passio_vehicles": lambda t, tz: _vehicle(t.withColumn("__none", F.lit(None).cast("double")), "calculated_course", clock_near("created", "feed_timestamp", tz, ahead=False), F.col("route_name"), "speed" if "speed" in t.columns else "__none", None),
}
NEEDS_TOPO = {"swiv_vehicles"}


def _lookup(rows: DataFrame, column: str, names: DataFrame | None) -> DataFrame:
    """column's token replaced by its id in names (token, canonical); null where there is none."""
    if names is None:
        return rows.withColumn(column, F.lit(None).cast("string"))
    n = names.select(F.col("token").alias("__t"), F.col("canonical").alias("__c"))
    return rows.join(n, F.col(column) == F.col("__t"), "left").withColumn(column, F.col("__c")).drop("__t", "__c")


def normalize(table: str, rows: DataFrame, tz: Column, index: DataFrame, topo: DataFrame | None = None, trips: DataFrame | None = None, stops: DataFrame | None = None, ids: DataFrame | None = None, agency: str = "") -> DataFrame:
    """one vendor table in the common shape.

    index: (token, canonical) of route short names; topo: (id_ligne, nom_commercial); trips and stops: (token, canonical) of
    train numbers and stop codes; ids: (route_id). Vendors' own trip ids match no schedule and are left out.
    """
    ccrta = table == "mwrta_vehicles" and agency.upper() == "CCRTA"
    shaped = NORMALIZERS["ccrta_vehicles" if ccrta else table](rows, tz)
    if table == "lirr_trains":
        shaped = _lookup(_lookup(shaped, "trip_id", trips), "stop_id", stops).withColumns({"route_id": F.lit(None).cast("string"), "resolution_status": F.lit("no_route")})
    elif table == "swiv_vehicles":
        shaped = _swiv(shaped, index, topo, ids, agency)
    elif table == "routematch_vehicles":
        # a short name counts before the id itself
        none = index.select(F.col("canonical").alias("route_id")).limit(0)
        own = (index.select(F.col("canonical").alias("__own")) if ids is None else ids.select(F.col("route_id").alias("__own"))).distinct()
        shaped = resolve(shaped, index, [strip_route_marks(F.col("raw_route"))], none).join(own, F.col("raw_route") == F.col("__own"), "left")
        through = F.col("route_id").isNull() & F.col("__own").isNotNull()
        shaped = shaped.withColumn("resolution_status", F.when(through, "passthrough").otherwise(F.col("resolution_status"))).withColumn("route_id", F.coalesce("route_id", "__own"))
    elif table == "passio_vehicles":
        shaped = resolve(shaped, index, strip_route_prefix(F.col("raw_route")), ids)
    else:
        shaped = resolve(shaped, index, None, ids)
        if ccrta:
            left = shaped.filter("resolution_status = 'route_unresolved'").select(F.col("raw_route").alias("token"))
            fuzzy = resolve_fuzzy(left, index.select(F.col("token").alias("name"), F.col("canonical").alias("route_id"))).select(F.col("token").alias("__t"), F.col("route_id").alias("__f"))
            shaped = shaped.join(fuzzy, F.col("raw_route") == F.col("__t"), "left")
            hit = F.col("route_id").isNull() & F.col("__f").isNotNull()
            shaped = shaped.withColumn("resolution_status", F.when(hit, "resolved").otherwise(F.col("resolution_status"))).withColumn("route_id", F.coalesce("route_id", "__f"))
    speed = to_mps(F.col("raw_speed"), F.col("speed_unit"))
    known = F.col("speed_unit") != "unknown"
    shaped = shaped.withColumns({"speed_mps": speed, "raw_speed": F.when(~known, F.col("raw_speed")), "speed_unit": F.when(known, "mps").otherwise(F.col("speed_unit"))})
    return shaped.select(*OUT)


def _swiv(rows: DataFrame, index: DataFrame, topo: DataFrame | None, ids: DataFrame | None, agency: str) -> DataFrame:
    """The line number's short name by WRTA's fixed list, else its commercial name of the sidecar."""
    fixed = F.create_map(*[F.lit(x) for k, v in WRTA_LINES.items() for x in (str(k), v)])
    raw = F.col("raw_route")
    rows = rows.withColumn("__line", raw).withColumn("__fixed", F.when(F.lit(agency.upper() == "WRTA"), F.element_at(fixed, raw)))
    if topo is None:
        rows = rows.withColumn("__name", F.lit(None).cast("string"))
    else:
        t = topo.select(F.col("id_ligne").cast("string").alias("__l"), true(F.trim("nom_commercial")).alias("__name"))
        rows = rows.join(t, F.col("__line") == F.col("__l"), "left").drop("__l")
    short = index.select(F.col("token").alias("__t"), F.col("canonical").alias("__f"))
    rows = rows.join(short, F.col("__fixed") == F.col("__t"), "left").drop("__t", "__fixed")
    rows = resolve(rows.withColumn("raw_route", F.col("__name")), index, None, ids)
    status = F.when(F.col("__line").isNull(), "no_route").when(F.col("__f").isNotNull(), "resolved").when(F.col("__name").isNull(), "route_unresolved").otherwise(F.col("resolution_status"))
    rows = rows.withColumn("resolution_status", status).withColumn("route_id", F.coalesce("__f", "route_id"))
    return rows.withColumn("raw_route", F.col("__line")).drop("__line", "__name", "__f")
