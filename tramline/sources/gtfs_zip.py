"""Static GTFS in zip files: CSV members to tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as compute
import pyarrow.csv as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.functions.timeutil import hms_seconds
from tramline.operators.schedule import route_mode

COLUMNS = {
    "trips": "trip_id route_id service_id direction_id trip_short_name shape_id",
    "routes": "route_id route_type route_short_name route_long_name route_color",
    "stops": "stop_id stop_code stop_name stop_lat stop_lon parent_station",
    "stop_times": "trip_id stop_sequence stop_id arrival_time departure_time checkpoint_id",
    "calendar": "service_id monday tuesday wednesday thursday friday saturday sunday start_date end_date",
    "calendar_dates": "service_id date exception_type",
    "shapes": "shape_id shape_pt_lat shape_pt_lon shape_pt_sequence shape_dist_traveled",
    "directions": "route_id direction_id direction direction_destination",
    "checkpoints": "checkpoint_id checkpoint_name",
    "stop_observations": "trip_id service_date vehicle_id stop_sequence observed_arrival_time observed_departure_time route_id agency_id direction_id to_stop_id scheduled_arrival_time scheduled_departure_time",
    "route_patterns": "route_pattern_id route_id direction_id route_pattern_name route_pattern_time_desc route_pattern_typicality route_pattern_sort_order representative_trip_id",
}


def read(files: DataFrame, table: str, only: dict[str, list[str]] | None = None) -> DataFrame:
    """All rows of one member of each zip (path, content), every column a string, with path and ord.

    A missing member has no rows, a missing column is null; blanks around values don't count. A member is streamed in
    blocks, so its size isn't bound by memory. only: the values wanted of some columns; other rows don't leave a block,
    and ord still counts them.
    """
    names = COLUMNS[table].split()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    if f"{table}.txt" not in z.namelist():
                        continue
                    at = 0
                    with z.open(f"{table}.txt") as member:
                        head = io.TextIOWrapper(member, "utf-8-sig").readline()
                    known = [c.strip().strip('"') for c in head.rstrip("\r\n").split(",")]
                    if not any(known):
                        continue
                    options = pc.ConvertOptions(column_types={c: pa.string() for c in known}, strings_can_be_null=True, null_values=[""])
                    with z.open(f"{table}.txt") as member:
                        for block in pc.open_csv(member, pc.ReadOptions(column_names=known, skip_rows=1), pc.ParseOptions(newlines_in_values=True), options):
                            n = block.num_rows
                            columns = {c: block.column(known.index(c)) if c in known else pa.nulls(n, pa.string()) for c in names}
                            made = pa.RecordBatch.from_pydict({"path": pa.array([path] * n), "ord": pa.array(range(at, at + n), pa.int64()), **columns})
                            for c, values in (only or {}).items():
                                made = made.filter(compute.is_in(compute.utf8_trim_whitespace(made.column(c)), value_set=pa.array(values, pa.string())))
                            yield made
                            at += n

    rows = files.select("path", "content").mapInArrow(run, "path string, ord long, " + ", ".join(f"`{c}` string" for c in names))
    return rows.select("path", "ord", *[F.nullif(F.trim(c), F.lit("")).alias(c) for c in names])


def typed(rows: DataFrame, table: str) -> DataFrame:
    """Typed columns; rows without what their table requires are dropped. Times past 24:00 stay seconds."""
    if table == "stop_times":
        return rows.withColumns({"arrival_s": hms_seconds("arrival_time"), "departure_s": hms_seconds("departure_time"), "stop_sequence": F.col("stop_sequence").try_cast("int")}).filter("trip_id is not null and stop_id is not null")
    if table == "stops":
        rows = rows.withColumns({"lat": F.col("stop_lat").try_cast("double"), "lon": F.col("stop_lon").try_cast("double")})
        return rows.filter("stop_id is not null and lat is not null and lon is not null and not isnan(lat) and not isnan(lon)")
    if table == "shapes":
        rows = rows.withColumns({"lat": F.col("shape_pt_lat").try_cast("double"), "lon": F.col("shape_pt_lon").try_cast("double"), "seq": F.col("shape_pt_sequence").try_cast("int")})
        return rows.dropna(subset=["shape_id", "lat", "lon", "seq"])
    if table == "routes":
        return rows.filter("route_id is not null").withColumn("mode", route_mode(F.col("route_type").try_cast("int")))
    if table == "trips":
        return rows.filter("trip_id is not null").withColumn("direction_id", F.col("direction_id").try_cast("int"))
    if table == "calendar":
        days = {c: F.col(c).try_cast("int") for c in COLUMNS["calendar"].split()[1:8]}
        ends = {c: F.try_to_timestamp(F.col(c), F.lit("yyyyMMdd")).cast("date") for c in ("start_date", "end_date")}
        return rows.withColumns(days | ends).dropna(subset=["service_id", "start_date", "end_date"])
    if table == "calendar_dates":
        return rows.withColumns({"date": F.try_to_timestamp(F.col("date"), F.lit("yyyyMMdd")).cast("date"), "exception_type": F.col("exception_type").try_cast("int")}).dropna(subset=["service_id", "date", "exception_type"])
    return rows
