"""Distances and polylines in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
MPH = 2.23694


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """metres on the sphere; null where a coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    a += F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))


def arc_lengths(points: DataFrame, keys: list[str]) -> DataFrame:
    """Points (keys, seq, lat, lon) with dist_m along their polyline."""
    order = W.partitionBy(*keys).orderBy("seq")
    step = haversine_m(F.lag("lat").over(order), F.lag("lon").over(order), F.col("lat"), F.col("lon"))
    return points.withColumn("__step", F.coalesce(step, F.lit(0.0))).withColumn(
        "dist_m", F.sum("__step").over(order.rowsBetween(W.unboundedPreceding, 0))
    ).drop("__step")


def project(shapes: DataFrame, stops: DataFrame) -> DataFrame:
    """(shape_id, stop_id, along_m) of each pair in stops (shape_id, stop_id, stop_lat, stop_lon).

    Flat projection about the shape's first point; the nearest segment, the first of equally near ones. A shape of
    fewer than two points gives null, as does a stop without a position. Pass distinct pairs: the cost is pairs times points of their shape.
    """
    order = W.partitionBy("shape_id").orderBy("seq")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = arc_lengths(shapes, ["shape_id"])
    s = s.withColumn("__lat0", F.first("lat").over(whole))
    for name in ("lat", "lon", "dist_m"):
        s = s.withColumn(f"__next_{name}", F.lead(name).over(order))
    s = s.filter("__next_lat is not null")
    j = stops.join(s, "shape_id", "left")
    k = F.lit(EARTH_M * 3.141592653589793 / 180)
    shrink = F.cos(F.radians("__lat0"))
    dx, dy = (F.col("__next_lon") - F.col("lon")) * k * shrink, (F.col("__next_lat") - F.col("lat")) * k
    px, py = (F.col("stop_lon") - F.col("lon")) * k * shrink, (F.col("stop_lat") - F.col("lat")) * k
    j = j.withColumns({"__dx": dx, "__dy": dy, "__px": px, "__py": py})
    norm = F.expr("__dx * __dx + __dy * __dy")
    t = F.expr("__px * __dx + __py * __dy") / norm
    t = F.when(norm == 0, 0.0).when(t > 1, 1.0).when(t < 0, 0.0).otherwise(t)  # least() and greatest() would skip a null
    j = j.withColumn("__t", t)
    off = F.pow(F.expr("__px - __t * __dx"), 2) + F.pow(F.expr("__py - __t * __dy"), 2)
    along = F.col("dist_m") + F.col("__t") * (F.col("__next_dist_m") - F.col("dist_m"))
    return j.groupBy("shape_id", "stop_id").agg(F.min_by(along, F.struct(off, F.col("seq"))).alias("along_m"))


def line_wkt(points: Column) -> Column:
    """LINESTRING of an array of (seq, lat, lon)."""
    ends = F.transform(F.array_sort(points), lambda p: F.concat_ws(" ", p["lon"].cast("string"), p["lat"].cast("string")))
    return F.concat(F.lit("LINESTRING("), F.array_join(ends, ", "), F.lit(")"))
