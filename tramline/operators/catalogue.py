"""Feeds, snapshots and their quality."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.geo import haversine_m
from tramline.functions.stats import true


def coverage(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per column the values that are neither null nor empty, and their share in percent."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c) for c in columns])
    long = counts.unpivot([*keys, "rows"], columns, "field", "set_count")
    return long.withColumn("pct", F.round(F.col("set_count") * 100 / F.col("rows"), 4))


def notes(rows: Column, share: dict[str, Column]) -> Column:
    """what a feed's gaps mean for its analysis. share: percentages of stop, status, route and dir; null counts as 0."""
    lacks = {k: F.coalesce(v, F.lit(0.0)) < 1 for k, v in share.items()}
    place = F.when(lacks["stop"], "no stop_id \u2192 use --source trip-updates").when(lacks["status"], "no current_status \u2192 position-based dwell")
    line = F.when(lacks["route"], "no route_id").when(lacks["dir"], "no direction \u2192 GTFS backfill")
    return F.when(rows == 0, "no rows").otherwise(F.concat_ws("; ", place, line))


def snapshot_for(days: DataFrame, catalogue: DataFrame) -> DataFrame:
    """For each feed and day the snapshot in force, the latest to start; days without one are left out."""
    c = catalogue.select(F.col("feed").alias("__f"), "feed_start_date", "feed_end_date", "feed_version")
    j = days.join(c, (F.col("feed") == F.col("__f")) & F.col("day").between(F.col("feed_start_date"), F.col("feed_end_date"))).drop("__f")
    best = W.partitionBy("feed", "day").orderBy(F.desc("feed_start_date"), F.desc("feed_version"))
    return j.withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n")


def latest_version(pointers: DataFrame) -> DataFrame:
    """Each feed's version of its last day."""
    return pointers.groupBy("feed").agg(F.max_by("version", F.struct("service_date", "version")).alias("version"), F.max("service_date").alias("service_date"))


def version_slug(version: Column) -> Column:
    """without fraction, Z and marks."""
    return F.translate(F.regexp_replace(F.split(version, r"\.")[0], "Z+$", ""), ":- ", "")


def shard(agency: Column, n: int) -> Column:
    """sha256 of the name modulo n, folded over the hexadecimal digits since 256 bits fit no number."""
    digits = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.conv(F.substring(F.sha2(agency, 256), i, F.lit(1)), 16, 10).cast("int"))
    return F.aggregate(digits, F.lit(0), lambda acc, x: (acc * 16 + x) % n)


def diff(early: DataFrame, late: DataFrame, moved_m: float = 50.0) -> DataFrame:
    """Stops added, removed, renamed, moved, both. Tables: (stop_id, name, lat, lon)."""
    a = early.select("stop_id", F.col("name").alias("n1"), F.col("lat").alias("y1"), F.col("lon").alias("x1"), F.lit(1).alias("a"))
    b = late.select("stop_id", F.col("name").alias("n2"), F.col("lat").alias("y2"), F.col("lon").alias("x2"), F.lit(1).alias("b"))
    j = a.join(b, "stop_id", "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    renamed = both & ~F.col("n1").eqNullSafe(F.col("n2"))
    moved = both & F.coalesce(haversine_m(F.col("y1"), F.col("x1"), F.col("y2"), F.col("x2")) > moved_m, F.lit(False))
    return j.agg(
        F.count_if(F.col("a").isNull()).alias("added"), F.count_if(F.col("b").isNull()).alias("removed"), F.count_if(both).alias("common"),
        F.count_if(renamed & ~moved).alias("renamed"), F.count_if(moved & ~renamed).alias("moved"), F.count_if(renamed & moved).alias("renamed_and_moved"),
    )


def flapping(presence: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Ids that come and go, or whose name or place returns to an earlier one.

    presence: (snap, stop_id, name) and maybe (lat, lon); snapshots: (snap). Snapshots are numbered, and a run of presence
    begins where the number isn't one more than that of the row before; no table of all stops and snapshots is made.
    """
    numbered = snapshots.select("snap").distinct().withColumn("__no", F.row_number().over(W.orderBy("snap")))
    rows = presence.join(numbered, "snap")
    order = W.partitionBy("stop_id").orderBy("snap")
    place = F.struct("lat", "lon") if {"lat", "lon"} <= set(presence.columns) else F.lit("")
    rows = rows.withColumn("__place", place)
    rows = rows.withColumns({"__last": F.lag("__no").over(order), "__name": F.lag("name").over(order), "__was": F.lag("__place").over(order)})
    first = F.col("__last").isNull()
    moved, named = first | ~F.col("__place").eqNullSafe(F.col("__was")), first | ~F.col("name").eqNullSafe(F.col("__name"))
    many = lambda flag: F.count_if(flag)
    kinds = lambda c, flag: F.size(F.collect_set(F.when(flag, F.to_json(F.struct(c)))))
    out = rows.groupBy("stop_id").agg(
        F.count_if(first | (F.col("__no") != F.col("__last") + 1)).alias("presence_runs"),
        (kinds("name", named) < many(named)).alias("name_returns"), (kinds("__place", moved) < many(moved)).alias("place_returns"),
    )
    return out.filter("presence_runs >= 2 or name_returns or place_returns")


def missing(here: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the one that the other lacks."""
    return here.select(*keys).distinct().join(there.select(*keys), keys, "left_anti")


def conform(rows: DataFrame, schema: dict[str, str], rename: dict[str, str] | None = None) -> DataFrame:
    """Another era's names in today's schema; absent columns are typed nulls."""
    rows = rows.withColumnsRenamed({k: v for k, v in (rename or {}).items() if k in rows.columns})
    return rows.select(*[(F.col(f"`{c}`") if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()])


def candidates(rows: DataFrame, known_ids: DataFrame) -> DataFrame:
    """New feeds, one for each host and path, https first; agencies of a single origin only.

    rows: (feed_id, agency, url, status, auth). Deprecated and authenticated feeds are left out.
    """
    live = rows.filter(~F.coalesce(F.col("status") == "deprecated", F.lit(False)) & (F.coalesce("auth", F.lit(0)) == 0))
    live = live.join(known_ids.select("feed_id"), "feed_id", "left_anti")
    live = live.withColumns({"host": F.lower(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1)), "path": F.regexp_extract("url", "^[a-z]+://[^/?#]+([^?#]*)", 1)})
    order = W.partitionBy("host", "path").orderBy(F.when(F.startswith("url", F.lit("https")), 0).otherwise(1), "feed_id")
    live = live.withColumn("__n", F.row_number().over(order)).filter("__n = 1")
    origins = live.groupBy("agency").agg(F.countDistinct("host").alias("__h")).filter("__h = 1")
    live = live.join(origins, "agency").drop("__h", "__n")
    same = W.partitionBy(F.lower("agency")).orderBy("feed_id")
    return live.withColumn("name", F.concat_ws("-", F.lower("agency"), F.when(F.row_number().over(same) > 1, F.row_number().over(same))))


def outcomes(polls: DataFrame) -> DataFrame:
    """Polls by what came of them; `parsed` tells whether the body was a complete message."""
    code = F.col("status_code")
    kind = F.when(code.isin(401, 403), "needs_auth").when(code.isNull() | (code >= 400), "dead").when(~F.coalesce("parsed", F.lit(False)), "format_mismatch").otherwise("ok")
    return polls.groupBy(kind.alias("outcome")).agg(F.count(F.lit(1)).alias("polls"))


class Prices(NamedTuple):
    """US dollars: a gibibyte and month in each tier, a thousand watched objects a month, a request."""

    cold: float = 0.00099
    hot: float = 0.023
    landing: float = 0.023
    watched: float = 0.0025
    put: float = 5e-6
    get: float = 4e-7


def costs(objects: DataFrame, keys: list[str], prices: Prices = Prices()) -> DataFrame:
    """Monthly cost by tier and in all. objects: (tier, bytes, objects, puts, gets), tier being cold, hot or landing."""
    of = lambda tier, c: F.coalesce(F.sum(F.when(F.col("tier") == tier, F.col(c))), F.lit(0))
    gib = lambda tier: of(tier, "bytes") / float(1 << 30)
    parts = {
        "cold_usd": gib("cold") * prices.cold, "hot_usd": gib("hot") * prices.hot + of("hot", "objects") / 1000 * prices.watched, "landing_usd": gib("landing") * prices.landing,
        "requests_usd": F.coalesce(F.sum("puts"), F.lit(0)) * prices.put + F.coalesce(F.sum("gets"), F.lit(0)) * prices.get,
    }
    total = sum(parts.values(), F.lit(0.0))
    return objects.groupBy(*keys).agg(F.sum("bytes").alias("bytes"), *[F.round(v, 6).alias(k) for k, v in parts.items()], F.round(total, 6).alias("total_usd"))


def crosswalk(routes: DataFrame) -> DataFrame:
    """A row for each name of a route, trimmed, blanks dropped."""
    long = routes.unpivot(["route_id"], ["route_short_name", "route_long_name"], "alias_type", "alias_token")
    return long.withColumn("alias_token", F.trim("alias_token")).filter("alias_token <> ''").select("alias_token", "alias_type", "route_id")


def edited_shapes(shapes: DataFrame, edits: DataFrame, pointers: DataFrame) -> DataFrame:
    """Shapes of each feed's latest version, with the edited geometry where there is one."""
    last = latest_version(pointers).select("feed", "version")
    e = edits.select("feed", "shape_id", F.col("geom").alias("__e"))
    return shapes.join(last, ["feed", "version"]).join(e, ["feed", "shape_id"], "left").withColumn("geom", F.coalesce("__e", "geom")).drop("__e")


def earliest(rows: DataFrame, key: str, ts: str) -> DataFrame:
    """The first time of each key."""
    return rows.groupBy(key).agg(F.min(ts).alias("first_ts"))


def subset_by_prefix(stops: DataFrame, prefix: str) -> DataFrame:
    """Stops that, or whose parent, start so."""
    return stops.filter(F.startswith(F.coalesce("parent_station", F.lit("")), F.lit(prefix)) | F.startswith("stop_id", F.lit(prefix)))


def timezone_of(rows: DataFrame, city: DataFrame, region: DataFrame, country: DataFrame) -> DataFrame:
    """by city, else by region, else by country."""
    j = rows.join(city.withColumnRenamed("tz", "t1"), "city", "left").join(region.withColumnRenamed("tz", "t2"), "region", "left").join(country.withColumnRenamed("tz", "t3"), "country", "left")
    return j.withColumn("tz", F.coalesce("t1", "t2", "t3")).drop("t1", "t2", "t3")


def agencies(feeds: DataFrame) -> DataFrame:
    """Each agency's feeds."""
    return feeds.groupBy("agency_id").agg(F.array_join(F.array_sort(F.collect_set("feed")), ",").alias("feeds"), F.count(F.lit(1)).alias("n"))


def has(column: str) -> Column:
    return true(column).isNotNull()
