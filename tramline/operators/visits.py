"""From pings, stop-time predictions and countdowns to stop visits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.stats import true

MERGE_GAP, MAX_WAIT, APPROACH_JUMP = 60, 120, 600
PRIOR = (W.unboundedPreceding, 0)


def valid_pings(pings: DataFrame) -> DataFrame:
    """Adds vehicle = vehicle_id, or trip_id for a null or empty one; drops pings without either or without time."""
    rows = pings.withColumn("vehicle", F.coalesce(true("vehicle_id"), F.col("trip_id")))
    return rows.filter("vehicle is not null and ts is not null")


def runs(pings: DataFrame, keys: list[str], mode: str | None = None) -> DataFrame:
    """Pings that dwell, with the run that they belong to.

    pings: keys, ts, ord, stop_id, status. A vehicle with any status dwells where it is STOPPED_AT; one without
    dwells wherever it has a stop. Any other ping ends a run, a null status in status mode too. mode
    ('status' or 'position') overrides the choice.
    """
    known = F.max(true("status").isNotNull()).over(W.partitionBy(*keys)) if mode is None else F.lit(mode == "status")
    rows = pings.withColumn("by_status", known)
    still = F.col("stop_id").isNotNull() & (~F.col("by_status") | F.coalesce(F.col("status") == "STOPPED_AT", F.lit(False)))
    rows = rows.withColumn("__dwell", still)
    order = W.partitionBy(*keys).orderBy("ts", "ord")
    goes_on = F.coalesce(F.lag("__dwell").over(order) & (F.lag("stop_id").over(order) == F.col("stop_id")), F.lit(False))
    rows = rows.withColumn("__new", (F.col("__dwell") & ~goes_on).cast("int"))
    rows = rows.withColumn("run", F.sum("__new").over(order.rowsBetween(*PRIOR)))
    return rows.filter("__dwell").drop("__dwell", "__new")


def fold_runs(dwelling: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """One visit per run, with the `carried` columns of its first ping.

    By status the first ping arrives and the last leaves; by position both times are those of the last ping.
    """
    first = F.min_by(F.struct(*carried), F.struct("ts", "ord")).alias("__first")
    rows = dwelling.groupBy(*keys, "run", "stop_id", "by_status").agg(
        F.min("ts").alias("__lo"), F.max("ts").alias("departure_ts"), F.count(F.lit(1)).alias("ping_count"), first
    )
    arrival = F.when(F.col("by_status"), F.col("__lo")).otherwise(F.col("departure_ts"))
    return rows.withColumn("arrival_ts", arrival).select(*keys, "run", "stop_id", "arrival_ts", "departure_ts", "ping_count", "__first.*")


def merge_close(visits: DataFrame, keys: list[str], carried: list[str], gap: int = MERGE_GAP) -> DataFrame:
    """Successive visits of a vehicle at one stop, at most `gap` seconds apart, are one; 0 turns it off.

    A merged visit ends where its last part ends, so each part looks only at the one before: no fold is needed.
    """
    if gap <= 0:
        return visits
    order = W.partitionBy(*keys).orderBy("arrival_ts", "run")
    wait = F.col("arrival_ts") - F.lag("departure_ts").over(order)
    same = (F.lag("stop_id").over(order) == F.col("stop_id")) & wait.between(0, gap)
    rows = visits.withColumn("__new", (~F.coalesce(same, F.lit(False))).cast("int"))
    rows = rows.withColumn("__merged", F.sum("__new").over(order.rowsBetween(*PRIOR)))
    first = F.min_by(F.struct(*carried), F.struct("arrival_ts", "run")).alias("__first")
    rows = rows.groupBy(*keys, "__merged", "stop_id").agg(
        F.min("run").alias("run"), F.min("arrival_ts").alias("arrival_ts"), F.max_by("departure_ts", F.struct("arrival_ts", "run")).alias("departure_ts"),
        F.sum("ping_count").alias("ping_count"), first,
    )
    return rows.select(*keys, "run", "stop_id", "arrival_ts", "departure_ts", "ping_count", "__first.*")


CARRIED = ["route_id", "trip_id", "direction_id"]


def visits(pings: DataFrame, gap: int = MERGE_GAP, mode: str | None = None, carried: list[str] | None = None) -> DataFrame:
    """Pings to visits: P1, W1, W2, A6, W3, A7. All windows share one partitioning by vehicle, so there is one shuffle."""
    carried = CARRIED if carried is None else carried
    rows = fold_runs(runs(valid_pings(pings), ["vehicle"], mode), ["vehicle"], carried)
    return merge_close(rows, ["vehicle"], carried, gap).drop("run")


def dedup_latest(rows: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """A3: the row of the greatest version of each key. Spark keeps one row a key on the map side (WindowGroupLimit)."""
    order = W.partitionBy(*keys).orderBy(*[F.desc(v) for v in version])
    return rows.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def usable_update(schedule_relationship: str = "schedule_relationship") -> Column:
    """Scheduled (null counts as that), with ids, a version and a time."""
    named = F.col("trip_id").isNotNull() & F.col("stop_id").isNotNull() & F.col("feed_timestamp").isNotNull()
    scheduled = F.coalesce(F.col(schedule_relationship) == "SCHEDULED", F.lit(True))
    return named & scheduled & (F.col("arrival_time").isNotNull() | F.col("departure_time").isNotNull())


def update_visits(updates: DataFrame, version: list[str]) -> DataFrame:
    """The last prediction of each trip and stop, as a visit."""
    last = dedup_latest(updates.filter(usable_update()), ["trip_id", "stop_id"], version)
    return last.select(
        F.coalesce(true("vehicle_id"), F.col("vehicle_label"), F.lit("")).alias("vehicle"), "trip_id", "stop_id",
        F.coalesce("arrival_time", "departure_time").alias("arrival_ts"), F.coalesce("departure_time", "arrival_time").alias("departure_ts"),
    )


def approaches(pings: DataFrame, jump: int = APPROACH_JUMP, max_wait: int = MAX_WAIT) -> DataFrame:
    """Countdowns to arrivals.

    pings: (train, station, destination, ts, next_arr, waiting_seconds, ord). A jump of next_arr by more than
    `jump` starts an approach; it arrives at its first ping of the least wait, unless that exceeds max_wait.
    """
    rows = pings.withColumn("train", F.trim("train")).filter("train <> ''")
    keys = ["train", "station", "destination"]
    order = W.partitionBy(*keys).orderBy("ts", "ord")
    far = F.abs(F.col("next_arr") - F.lag("next_arr").over(order)) > jump
    rows = rows.withColumn("__new", F.coalesce(far, F.lit(False)).cast("int"))
    rows = rows.withColumn("approach", F.sum("__new").over(order.rowsBetween(*PRIOR)))
    best = rows.groupBy(*keys, "approach").agg(
        F.min_by("ts", F.struct("waiting_seconds", "ts", "ord")).alias("arrival_ts"), F.min("waiting_seconds").alias("least_wait"), F.count(F.lit(1)).alias("pings")
    )
    return best.filter(F.col("least_wait") <= max_wait)


def destination_trips(arrivals: DataFrame) -> DataFrame:
    """A trip starts where a train's destination changes; trip_id is train-NNN-DESTINATION, with the stop's ordinal."""
    order = W.partitionBy("train").orderBy("arrival_ts", "station", "destination")
    same = F.coalesce(F.lag("destination").over(order) == F.col("destination"), F.lit(False))
    rows = arrivals.withColumn("__new", (~same).cast("int")).withColumn("__trip", F.sum("__new").over(order.rowsBetween(*PRIOR)))
    slug = F.regexp_replace(F.upper("destination"), "[ /]+", "-")
    rows = rows.withColumn("trip_id", F.format_string("%s-%03d-%s", F.col("train"), F.col("__trip"), slug))
    place = F.row_number().over(W.partitionBy("train", "__trip").orderBy("arrival_ts", "station", "destination"))
    return rows.withColumn("stop_sequence", place).drop("__new", "__trip")


def trip_runs(pings: DataFrame) -> DataFrame:
    """The successive trips of each vehicle, and its pings."""
    order = W.partitionBy("vehicle").orderBy("ts", "ord")
    rows = valid_pings(pings)
    named = rows.filter(true("trip_id").isNotNull())
    changed = named.filter(named.trip_id.isNotNull()).withColumn("__before", F.lag("trip_id").over(order)).filter("__before is null or __before <> trip_id")
    trips = changed.groupBy("vehicle").agg(F.count(F.lit(1)).alias("trip_runs"), F.countDistinct("trip_id").alias("trips"))
    return rows.groupBy("vehicle").agg(F.count(F.lit(1)).alias("pings")).join(trips, "vehicle", "left").fillna(0, ["trip_runs", "trips"])
