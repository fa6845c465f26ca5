"""Daily marts over visits that need no schedule.

Visits have: feed_day (the partition day in UTC), service_date, route_id, direction_id, stop_id, arrival_ts,
departure_ts, trip_id, vehicle. Headways never cross a partition day, so feed_day is part of every key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.stats import cov, pct, pct_int, true

ROUTE = ["route_id", "direction_id"]


def routed(visits: DataFrame) -> DataFrame:
    """Visits with a route; a null direction is a direction of its own."""
    return visits.filter(true("route_id").isNotNull())


def with_headways(visits: DataFrame) -> DataFrame:
    """Seconds since the arrival before at the same stop, route, direction and day."""
    order = W.partitionBy("feed_day", *ROUTE, "stop_id", "service_date").orderBy("arrival_ts", "departure_ts", "vehicle", "trip_id")
    return visits.withColumn("headway_s", F.col("arrival_ts") - F.lag("arrival_ts").over(order))


def stop_day(visits: DataFrame) -> DataFrame:
    """A1: one row per route, direction, stop and service date."""
    rows = with_headways(routed(visits)).withColumn("dwell_s", F.col("departure_ts") - F.col("arrival_ts"))
    return rows.groupBy("feed_day", *ROUTE, "stop_id", "service_date").agg(
        F.count(F.lit(1)).alias("visit_count"),
        F.count_distinct(true("trip_id")).alias("trip_count"),
        F.count_distinct(true("vehicle")).alias("distinct_vehicle_count"),
        pct_int("headway_s", 50).alias("headway_p50_s"),
        pct_int("headway_s", 90).alias("headway_p90_s"),
        F.round(F.avg("headway_s"), 6).alias("headway_mean_s"),
        F.round(cov("headway_s"), 6).alias("headway_cov"),
        pct_int("dwell_s", 50).alias("dwell_p50_s"),
        pct_int("dwell_s", 90).alias("dwell_p90_s"),
        F.min("arrival_ts").alias("first_service_unix"),
        F.max("departure_ts").alias("last_service_unix"),
        (F.max("departure_ts") - F.min("arrival_ts")).alias("service_span_s"),
    )


def route_day(visits: DataFrame) -> DataFrame:
    """A2: one row per route, direction and date. Its headway is the median of the stops' rounded medians."""
    keys = ["feed_day", *ROUTE, "service_date"]
    rows = routed(visits).withColumn("dwell_s", F.col("departure_ts") - F.col("arrival_ts"))
    pooled = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("visit_count"),
        F.count_distinct(true("trip_id")).alias("trip_count"),
        F.count_distinct(true("vehicle")).alias("distinct_vehicle_count"),
        F.count_distinct("stop_id").alias("distinct_stop_count"),
        pct_int("dwell_s", 50).alias("dwell_p50_s"),
        pct_int("dwell_s", 90).alias("dwell_p90_s"),
        F.min("arrival_ts").alias("first_service_unix"),
        F.max("departure_ts").alias("last_service_unix"),
        (F.max("departure_ts") - F.min("arrival_ts")).alias("service_span_s"),
    )
    stops = with_headways(routed(visits)).groupBy(*keys, "stop_id").agg(pct_int("headway_s", 50).alias("p"))
    medians = stops.groupBy(*keys).agg(pct_int("p", 50).alias("headway_p50_s"))
    same = [pooled[k].eqNullSafe(medians[k]) for k in keys]
    on = same[0]
    for s in same[1:]:
        on &= s
    return pooled.join(medians, on).select(*[pooled[c] for c in pooled.columns], "headway_p50_s")


def events(visits: DataFrame, date_of: Column | None = None) -> DataFrame:
    """An arrival and a departure for each visit, each with its own service date if date_of(event_unix) is given."""
    both = F.explode(F.array(
        F.struct(F.lit("ARR").alias("event_type"), F.col("arrival_ts").alias("event_unix")),
        F.struct(F.lit("DEP").alias("event_type"), F.col("departure_ts").alias("event_unix")),
    ))
    rows = routed(visits).withColumn("__e", both)
    return rows.select("route_id", "direction_id", "stop_id", "trip_id", "vehicle", "__e.event_type", "__e.event_unix")


def stop_activity(visits: DataFrame) -> DataFrame:
    """Each stop's visits, routes, dwell and headway over all routes."""
    order = W.partitionBy("stop_id").orderBy("arrival_ts", "departure_ts", "vehicle")
    rows = visits.withColumn("h", F.col("arrival_ts") - F.lag("arrival_ts").over(order))
    return rows.groupBy("stop_id").agg(
        F.count(F.lit(1)).alias("visits"), F.array_join(F.array_sort(F.collect_set(true("route_id"))), ",").alias("routes"),
        pct("h", 50).alias("headway_p50"), F.sum(F.col("departure_ts") - F.col("arrival_ts")).alias("dwell_total"),
    )


def clipped_headways(visits: DataFrame, low: int = 30, high: int = 3600) -> DataFrame:
    """Per-route headways within the clip."""
    rows = with_headways(routed(visits)).filter(F.col("headway_s").between(low, high))
    return rows.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("n"), pct("headway_s", 50).alias("p50"), pct("headway_s", 90).alias("p90"), F.min("headway_s").alias("low"), F.max("headway_s").alias("high")
    )


def backfill(visits: DataFrame, trips: DataFrame) -> DataFrame:
    """Route and direction of the trip where the visit lacks them; visits that stay incomplete are dropped."""
    t = trips.select(F.col("trip_id").alias("__t"), F.col("route_id").alias("__r"), F.col("direction_id").alias("__d"))
    rows = visits.join(t, F.col("trip_id") == F.col("__t"), "left")
    rows = rows.withColumns({"route_id": F.coalesce(true("route_id"), "__r"), "direction_id": F.coalesce("direction_id", "__d")})
    return rows.filter("route_id is not null and direction_id is not null").drop("__t", "__r", "__d")
