"""Questions that the marts answer: filters, ranges, rankings, maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.stats import weighted_mean


def read_kind(mart: DataFrame, start: str | None = None, end: str | None = None, filters: dict[str, list] | None = None, limit: int | None = None, order: list[str] | None = None) -> DataFrame:
    """A date range and exact choices of any column; an unknown column is an error.

    On tables partitioned by year and month the range also names the months, so that whole partitions are left out.
    """
    unknown = [c for c in (filters or {}) if c not in mart.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")
    if start and end:
        mart = mart.filter(F.col("service_date").between(start, end))
        if {"year", "month"} <= set(mart.columns):
            (y1, m1), (y2, m2) = (map(int, d.split("-")[:2]) for d in (start, end))
            mart = mart.filter((F.col("year") * 12 + F.col("month")).between(y1 * 12 + m1, y2 * 12 + m2))
    for column, values in (filters or {}).items():
        mart = mart.filter(F.col(column).isin(*values))
    if limit is not None:
        mart = mart.orderBy(*(order or mart.columns)).limit(limit)
    return mart


def agency_summary(otp: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """On-time share of all matched visits in percent, and the mean of p50 speeds weighted by samples."""
    a = otp.groupBy(*keys).agg(F.round(F.sum("on_time_count") * 100 / F.nullif(F.sum("matched_count"), F.lit(0)), 4).alias("on_time_pct"), F.sum("matched_count").alias("matched"))
    b = segments.groupBy(*keys).agg(F.round(weighted_mean(F.col("speed_p50_mph"), F.col("sample_count")), 9).alias("speed_mph"))
    return a.join(b, keys, "left")


def segment_speed(rows: DataFrame, keep_null_direction: bool = False) -> DataFrame:
    """Speed of each segment and direction, weighted by samples, nulls skipped."""
    if not keep_null_direction:
        rows = rows.filter("direction_id is not null")
    return rows.groupBy("from_stop_id", "to_stop_id", "direction_id").agg(
        F.round(weighted_mean(F.col("speed_p50_mph"), F.col("sample_count")), 9).alias("speed_mph"), F.sum("sample_count").alias("samples")
    )


def quartile(rows: DataFrame, value: str, ties: list[str]) -> DataFrame:
    """I / (n - 1) of the rank in four equal parts; 0.5 for a single row. Not ntile, whose groups differ in size.

    The rank is over all rows, so give it aggregated segments.
    """
    i = F.row_number().over(W.orderBy(value, *ties)) - 1
    n = F.count(F.lit(1)).over(W.partitionBy())
    part = F.when(n == 1, F.lit(0.5)).otherwise(i / (n - 1))
    return rows.withColumn("bucket", F.least(F.lit(3), F.floor(part * 4)).cast("int"))


def top_per_route(rows: DataFrame, route: str, metric: Column, per_route: int, n: int, ties: list[str]) -> DataFrame:
    """The first n of the order, at most per_route of any route."""
    rows = rows.withColumn("__m", metric)
    place = F.row_number().over(W.partitionBy(route).orderBy("__m", *ties))
    return rows.withColumn("__n", place).filter(F.col("__n") <= per_route).orderBy("__m", *ties).limit(n).drop("__m", "__n")


def daily_series(rows: DataFrame, value: Column, how: str, least: int = 10) -> DataFrame:
    """Per day and direction the sum, or the mean weighted by samples where there are `least` of them."""
    if how == "sum":
        out = F.sum(value)
    else:
        out = F.when(F.sum("samples") >= least, F.round(weighted_mean(value, F.col("samples")), 9))
    return rows.groupBy("service_date").pivot("direction_id", [0, 1]).agg(out)


def by_route(rows: DataFrame) -> DataFrame:
    """A route's counts over directions and days; percentages with one digit, half to even."""
    n = F.sum("matched_count")
    return rows.groupBy("route_id").agg(
        n.alias("matched"), F.bround(F.sum("on_time_count") * 100 / F.nullif(n, F.lit(0)), 1).alias("on_time_pct"),
        F.bround(weighted_mean(F.col("arr_delay_p50_s").cast("double"), F.col("matched_count")), 1).alias("delay_p50"),
    )


def route_means(rows: DataFrame, nulls_as_zero: bool) -> DataFrame:
    """A route's mean headway over days, nulls as 0 or skipped."""
    h = F.coalesce("headway_p50_s", F.lit(0)) if nulls_as_zero else F.col("headway_p50_s")
    return rows.groupBy("route_id").agg(F.round(F.avg(h), 4).alias("headway_s"), F.round(F.avg("dwell_p50_s"), 4).alias("dwell_s"))


def period_delta(rows: DataFrame, start: str, end: str) -> DataFrame:
    """The on-time share of a period and of the equally long one before, and whether it moved by 0.05 points."""
    days = F.datediff(F.lit(end), F.lit(start)) + 1
    now = F.col("service_date").between(start, end)
    before = F.col("service_date").between(F.date_sub(F.lit(start), days).cast("string"), F.date_sub(F.lit(start), 1).cast("string"))
    share = lambda cond: F.sum(F.when(cond, F.col("on_time_count"))) * 100 / F.nullif(F.sum(F.when(cond, F.col("matched_count"))), F.lit(0))
    out = rows.agg(F.round(share(now), 6).alias("current_pct"), F.round(share(before), 6).alias("previous_pct"))
    d = F.round(F.col("current_pct") - F.col("previous_pct"), 6)
    return out.withColumns({"delta": d, "trend": F.when(F.abs(d) < 0.05, "flat").when(d > 0, "up").otherwise("down")})


def export_bundle(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of JSON with a list for each small table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*df.columns)))).alias(name))
        out = one if out is None else out.crossJoin(one)
    return out


def geojson(rows: DataFrame, line: str, properties: list[str]) -> DataFrame:
    """F32: a feature for each row; `line` is an array of (seq, lat, lon)."""
    coords = F.transform(line, lambda p: F.array(p["lon"], p["lat"]))
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("LineString").alias("type"), coords.alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    return rows.select(*properties, F.to_json(feature).alias("feature"))
