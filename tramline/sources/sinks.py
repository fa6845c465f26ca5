"""Writing marts: fixed columns, whole partitions, a manifest of what is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_mart(rows: DataFrame, columns: list[str], path: str, keys: list[str]) -> None:
    """K1, K2: the named columns, by partition; only the partitions that have rows are replaced."""
    rows = rows.select(*columns, *keys).repartition(*keys)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def mark_done(spark: SparkSession, work: DataFrame, path: str) -> None:
    """K3: (mart, feed, day) handled, also those without rows, which leave no partition."""
    work.select("mart", "feed", "day").write.mode("append").parquet(path)


def todo(spark: SparkSession, work: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Work that the manifest doesn't have; all of it if forced."""
    if force:
        return work
    try:
        done = spark.read.parquet(path).select("mart", "feed", "day").distinct()
        done.schema
    except Exception as e:  # no manifest yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return work
    return work.join(done, ["mart", "feed", "day"], "left_anti")


def write_events_csv(events: DataFrame, path: str) -> None:
    """K7, K8: a folder for each feed, mode, stop and day, in order of time (Q14)."""
    keys = ["feed", "mode", "bucket", "Year", "Month", "Day"]
    rows = events.withColumns({"bucket": F.concat_ws("-", "route_id", "direction_id", "stop_id"), "Year": F.substring("service_date", 1, 4), "Month": F.substring("service_date", 6, 2), "Day": F.substring("service_date", 9, 2)})
    rows.repartition(*keys).sortWithinPartitions(*keys, "event_unix", "event_type").write.mode("overwrite").partitionBy(*keys).option("header", True).csv(path)


def write_alerts(alerts: DataFrame, path: str) -> None:
    """K9, S25."""
    alerts.write.mode("overwrite").option("compression", "gzip").json(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows instead of the old ones with the same keys."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)
