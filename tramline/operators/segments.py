"""Speeds between stops, along shapes where they fit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.geo import MPH, haversine_m
from tramline.functions.stats import pct, pct_int, true

MAX_STOPS = 100_000
MAX_TRANSIT_S, BUS_MPH, RAIL_MPH = 7200, 90.0, 200.0
RATIO = (0.95, 4.0)


def pairs(visits: DataFrame, trip: str = "trip_id") -> DataFrame:
    """Consecutive visits of a trip; buses and others pair apart, as their speed limits differ.

    Visits without a trip or route take no part, so their neighbours are consecutive. trip: a column that tells trips
    apart as trip_id does, by which the rows may lie already.
    """
    rows = visits.filter(true("trip_id").isNotNull() & true("route_id").isNotNull()).withColumn("is_bus", F.coalesce(F.col("mode") == "bus", F.lit(False)))
    order = W.partitionBy(trip, "is_bus").orderBy("arrival_ts", "departure_ts", "stop_id", "vehicle")
    nxt = F.lead(F.struct("stop_id", "arrival_ts")).over(order)
    rows = rows.withColumn("__to", nxt).filter("__to is not null")
    return rows.select(
        "route_id", "direction_id", "trip_id", "vehicle", "is_bus", F.col("stop_id").alias("from_stop_id"), F.col("__to.stop_id").alias("to_stop_id"),
        F.col("departure_ts").alias("departure_unix"), F.col("__to.arrival_ts").alias("arrival_unix"), (F.col("__to.arrival_ts") - F.col("departure_ts")).alias("transit_s"),
    )


def with_coords(segments: DataFrame, stops: DataFrame) -> DataFrame:
    """Both ends' coordinates; a segment without one of them is dropped.

    Up to MAX_STOPS stops are broadcast, which is checked: segments would else be shuffled twice, by a few hot stops.
    """
    if stops.limit(MAX_STOPS + 1).count() <= MAX_STOPS:
        stops = F.broadcast(stops)
    for end in ("from", "to"):
        s = stops.select(F.col("stop_id").alias(f"{end}_stop_id"), F.col("lat").alias(f"{end}_lat"), F.col("lon").alias(f"{end}_lon"))
        segments = segments.join(s, f"{end}_stop_id")
    return segments


def directions(offsets: DataFrame) -> DataFrame:
    """(route_id, from_stop_id, to_stop_id, direction_id): the least direction with a shape that has them in this order.

    offsets: (route_id, direction_id, shape_id, stop_id, along_m).
    """
    a = offsets.select("route_id", "direction_id", "shape_id", F.col("stop_id").alias("from_stop_id"), F.col("along_m").alias("a"))
    b = offsets.select("route_id", "direction_id", "shape_id", F.col("stop_id").alias("to_stop_id"), F.col("along_m").alias("b"))
    return a.join(b, ["route_id", "direction_id", "shape_id"]).filter("a < b").groupBy("route_id", "from_stop_id", "to_stop_id").agg(F.min("direction_id").alias("geo_direction"))


def with_direction(segments: DataFrame, geometry: DataFrame, trips: DataFrame) -> DataFrame:
    """The direction by geometry, else that of the static trip, else the realtime one; speeds drops what isn't 0 or 1 then.

    geometry: what directions gives; trips: (trip_id, direction_id), one row for each trip.
    """
    rows = segments.join(geometry, ["route_id", "from_stop_id", "to_stop_id"], "left")
    rows = rows.join(trips.select("trip_id", F.col("direction_id").alias("__static")), "trip_id", "left")
    return rows.withColumn("direction_id", F.coalesce("geo_direction", "__static", "direction_id")).drop("geo_direction", "__static")


def speeds(segments: DataFrame, along: DataFrame | None = None) -> DataFrame:
    """Transit between 0 and two hours, distance along the shape if it is plausible, speed below the cap.

    along: (trip_id, stop_id, along_m), the place of a stop on the trip's shape.
    """
    rows = segments.filter(true("route_id").isNotNull() & (F.col("transit_s") > 0) & (F.col("transit_s") <= MAX_TRANSIT_S))
    rows = rows.filter(F.col("direction_id").isNull() | F.col("direction_id").isin(0, 1))
    rows = rows.withColumn("air_m", haversine_m(*[F.col(c) for c in ("from_lat", "from_lon", "to_lat", "to_lon")]))
    if along is None:
        rows = rows.withColumn("distance_m", F.col("air_m"))
    else:
        for end in ("from", "to"):
            a = along.select("trip_id", F.col("stop_id").alias(f"{end}_stop_id"), F.col("along_m").alias(f"__{end}"))
            rows = rows.join(a, ["trip_id", f"{end}_stop_id"], "left")
        shape = F.col("__to") - F.col("__from")
        fits = (F.col("air_m") > 0) & (shape / F.nullif("air_m", F.lit(0.0))).between(*RATIO)
        rows = rows.withColumn("distance_m", F.when(fits, shape).otherwise(F.col("air_m"))).drop("__from", "__to")
    rows = rows.filter("distance_m > 0").withColumn("speed_mph", F.col("distance_m") / F.col("transit_s") * MPH)
    return rows.filter(F.col("speed_mph") <= F.when(F.col("is_bus"), BUS_MPH).otherwise(RAIL_MPH))


def segment_day(rows: DataFrame) -> DataFrame:
    """A5: per segment and date; the distance is that of the earliest departure."""
    return rows.groupBy("route_id", "direction_id", "from_stop_id", "to_stop_id", "service_date").agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.round(F.percentile("speed_mph", F.lit(0.5)), 4).alias("speed_p50_mph"),
        F.round(F.percentile("speed_mph", F.lit(0.9)), 4).alias("speed_p90_mph"),
        F.round(F.avg("speed_mph"), 4).alias("speed_mean_mph"),
        pct_int("transit_s", 50).alias("transit_p50_s"),
        F.round(F.min_by("distance_m", F.struct("departure_unix", "trip_id", "arrival_unix")), 4).alias("distance_m"),
    )


def popularity(trips: DataFrame) -> DataFrame:
    """Shapes of a route and direction by number of trips, ties by shape_id."""
    n = trips.filter("shape_id is not null").groupBy("route_id", "direction_id", "shape_id").agg(F.count(F.lit(1)).alias("trips"))
    return n.withColumn("priority", F.row_number().over(W.partitionBy("route_id", "direction_id").orderBy(F.desc("trips"), "shape_id")))


def covering_shape(hops: DataFrame, offsets: DataFrame, priority: DataFrame) -> DataFrame:
    """For each hop the shape of the best priority that has both stops in order."""
    o = offsets.join(priority.select("route_id", "direction_id", "shape_id", "priority"), ["route_id", "direction_id", "shape_id"])
    a = o.select("route_id", "direction_id", "shape_id", "priority", F.col("stop_id").alias("from_stop_id"), F.col("along_m").alias("from_m"))
    b = o.select("shape_id", F.col("stop_id").alias("to_stop_id"), F.col("along_m").alias("to_m"))
    j = hops.join(a, ["route_id", "direction_id", "from_stop_id"]).join(b, ["shape_id", "to_stop_id"]).filter("from_m < to_m")
    best = W.partitionBy("route_id", "direction_id", "from_stop_id", "to_stop_id").orderBy("priority")
    return j.withColumn("__n", F.row_number().over(best)).filter("__n = 1").drop("__n")


def expand_hops(hops: DataFrame, offsets: DataFrame) -> DataFrame:
    """The consecutive stops of the shape between a hop's ends. hops: (hop, shape_id, from_m, to_m)."""
    o = offsets.select("shape_id", "stop_id", "along_m").distinct()
    j = hops.join(o, "shape_id").filter("along_m >= from_m and along_m <= to_m")
    order = W.partitionBy("hop").orderBy("along_m", "stop_id")
    j = j.withColumns({"next_stop": F.lead("stop_id").over(order), "next_m": F.lead("along_m").over(order)})
    return j.filter("next_stop is not null").select("hop", F.col("stop_id").alias("from_stop"), "next_stop", F.col("along_m").alias("start_m"), "next_m")


def bracket(points: DataFrame, hops: DataFrame) -> DataFrame:
    """the points of the shape between two offsets, if there are two or more. points: (shape_id, seq, lat, lon, dist_m)."""
    j = hops.join(points, "shape_id").filter("dist_m >= from_m and dist_m <= to_m")
    line = F.array_sort(F.collect_list(F.struct("seq", "lat", "lon")))
    return j.groupBy("hop").agg(line.alias("line")).filter("size(line) >= 2")
