"""The static schedule, and how visits keep to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tramline.functions.stats import pct_int, true
from tramline.functions.timeutil import hms_seconds, service_midnight

EARLY_S, LATE_S = 60, 300
AGENCY_FEEDS = {"SF": "sfmta-vehicles", "SC": "vta-vehicles", "CT": "caltrain-vehicles", "CE": "ace-vehicles", "AM": "capcor-vehicles", "SA": "smart-vehicles"}
WEEK = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def active_services(calendar: DataFrame, exceptions: DataFrame, days: DataFrame) -> DataFrame:
    """(day, service_id): the weekday's services in range, with the added and without the removed ones."""
    flags = F.array(*[F.col(d) for d in WEEK])
    on = (F.col("day") >= F.col("start_date")) & (F.col("day") <= F.col("end_date"))
    regular = days.join(calendar, on).filter(F.element_at(flags, F.weekday("day") + 1) == 1).select("day", "service_id")
    x = exceptions.select(F.col("date").alias("day"), "service_id", "exception_type").join(days, "day")
    plus, minus = (x.filter(F.col("exception_type") == k).select("day", "service_id") for k in (1, 2))
    return regular.union(plus).distinct().join(minus, ["day", "service_id"], "left_anti")


def scheduled_stops(stop_times: DataFrame, trips: DataFrame, trip: str = "trip_id", headway: bool = True) -> DataFrame:
    """Stop times of the given trips with scheduled_tt and scheduled_headway.

    An absent time is null and takes no part in either. A null direction has no headway. trip: a column of both that
    tells trips apart as trip_id does, by which the rows may lie already. Without headway there is no such column.
    """
    rows = stop_times.join(trips if trip == "trip_id" else trips.drop("trip_id"), trip)
    start = F.min("arrival_s").over(W.partitionBy(trip))
    timed = rows.filter("arrival_s is not null").withColumn("scheduled_tt", F.col("arrival_s") - start)
    bare = rows.filter("arrival_s is null").withColumn("scheduled_tt", F.lit(None).cast("int"))
    if headway:
        timed, bare = with_headway(timed, trip), bare.withColumn("scheduled_headway", F.lit(None).cast("int"))
    return timed.unionByName(bare)


def with_headway(timed: DataFrame, trip: str) -> DataFrame:
    """The wait since the row before by (arrival_s, trip_id, stop_sequence) of a route, direction and stop.

    Only the first row of each time waits, since the time before; the others have 0. So the order is over the distinct
    times of a stop, which are few, and not over all of its rows, which one task would have to sort.
    """
    by = ["route_id", "direction_id", "stop_id"]
    same = W.partitionBy(trip).orderBy(*by, "arrival_s", "stop_sequence")
    row = F.struct(*by, "arrival_s", "stop_sequence")
    timed = timed.withColumn("__again", F.coalesce(F.lag(row).over(same).eqNullSafe(row), F.lit(False)))
    times = timed.filter("direction_id is not null").groupBy(*by, "arrival_s").agg(F.min(F.struct("trip_id", "stop_sequence")).alias("__first"))
    times = times.withColumn("__gap", F.col("arrival_s") - F.lag("arrival_s").over(W.partitionBy(*by).orderBy("arrival_s")))
    times = times.select("__first", "__gap", *[F.col(c).alias(f"__{c}") for c in (*by, "arrival_s")])
    on = (F.col("arrival_s") == F.col("__arrival_s")) & (F.col("direction_id") == F.col("__direction_id"))
    rows = timed.join(times, on & F.col("route_id").eqNullSafe(F.col("__route_id")) & F.col("stop_id").eqNullSafe(F.col("__stop_id")), "left")
    first = (F.col("trip_id") == F.col("__first.trip_id")) & F.col("stop_sequence").eqNullSafe(F.col("__first.stop_sequence")) & ~F.col("__again")
    gap = F.when(first, F.col("__gap")).when(F.col("__first").isNotNull(), 0)
    return rows.withColumn("scheduled_headway", gap).drop("__again", "__first", "__gap", *[f"__{c}" for c in (*by, "arrival_s")])


def keep_first(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def classify(delay: Column, early: int = EARLY_S, late: int = LATE_S) -> Column:
    """F8: both bounds are on time."""
    return F.when(delay < -early, "early").when(delay > late, "late").when(delay.isNotNull(), "on_time")


def adherence(visits: DataFrame, schedule: DataFrame, tz: Column) -> DataFrame:
    """Each visit with the schedule row of its trip and stop on the nearer of two service days.

    schedule: (service_date date, trip_id, stop_id, arrival_s, departure_s, route_id, direction_id, stop_sequence). A
    trip after midnight belongs to the day before, so the arrival's local date and the date before are candidates;
    the smaller absolute delay wins, today's on a tie. The delay at arrival counts, else that at departure.

    Route, direction and sequence are the schedule's, else the visit's; visits without a trip, and those for which
    neither knows a route, are dropped. An empty vehicle is null.
    """
    keys = ["trip_id", "stop_id"]
    if "stop_sequence" not in visits.columns:
        visits = visits.withColumn("stop_sequence", F.lit(None).cast("int"))
    carried = [c for c in visits.columns if c not in (*keys, "local_date")]
    seen = visits.filter(true("trip_id").isNotNull()).select(*keys, F.col("local_date").alias("__date"), visit(carried, tz).alias("__visit"))
    planned = schedule.select(*keys, F.col("service_date").alias("__date"), due().alias("__due"))
    return meet(seen.unionByName(planned, allowMissingColumns=True), keys)


def visit(carried: list[str], tz: Column) -> Column:
    """A visit's own columns for meet, with the midnights of its two candidate days."""
    midnights = [service_midnight(F.date_sub("local_date", k), tz).alias(f"__m{k}") for k in (0, 1)]
    return F.struct(*carried, *midnights)


def due() -> Column:
    """A schedule row's columns for meet; of several for one trip, stop and day the greatest counts."""
    return F.struct("arrival_s", "departure_s", "route_id", "direction_id", "stop_sequence")


def meet(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Visits and schedule rows in one table, sorted once: a visit looks for its schedule at its own date and the one before.

    rows: keys (which tell trip and stop), __date, and either __visit or __due. It takes no join and so no further
    shuffle where the rows already lie by some of the keys, and no schedule row is repeated for a second date. Both
    frames only grow, so a trip and stop with many rows is not held in memory.
    """
    rows = rows.filter(" and ".join(f"{c} is not null" for c in (*keys, "__date"))).withColumn("__day", F.unix_date("__date"))
    order = W.partitionBy(*keys).orderBy("__day")
    last = F.max(F.when(F.col("__due").isNotNull(), F.struct("__day", "__due")))
    rows = rows.withColumns({f"__s{k}": last.over(order.rangeBetween(W.unboundedPreceding, -k)) for k in (0, 1)})
    rows = rows.withColumns({f"__s{k}": F.when(F.col(f"__s{k}.__day") == F.col("__day") - k, F.col(f"__s{k}.__due")) for k in (0, 1)})
    return judge(rows.filter("__visit is not null").select(*keys, "__date", "__s0", "__s1", "__visit.*"))


def meet_own(rows: DataFrame, keys: list[str], days: int) -> DataFrame:
    """meet for visits that bring their schedule row along, so that nothing is searched for and no row is repeated.

    rows: a visit's columns, keys, __date, and __due, a schedule row that holds on `__from` and the days - 1 dates before.
    Rows of equal keys and __from have equal __due. Nearly all keys have one such row, which is then the visit's own;
    for others the distinct ones are looked through. One sort by keys and __from serves all, and that of the caller too.
    """
    rows = rows.filter(" and ".join(f"{c} is not null" for c in (*keys, "__date", "__from")))
    whole = W.partitionBy(*keys)
    rows = rows.withColumns({"__lo": F.min("__from").over(whole), "__hi": F.max("__from").over(whole)})
    several = F.col("__lo") < F.col("__hi")
    rows = rows.withColumn("__dues", F.collect_set(F.when(several, F.struct("__from", "__due"))).over(whole))
    for k in (0, 1):
        holds = lambda day, k=k: F.datediff(day, F.date_sub("__date", k)).between(0, days - 1)
        found = F.array_max(F.transform(F.filter("__dues", lambda x: holds(x["__from"])), lambda x: x["__due"]))  # noqa: B023
        rows = rows.withColumn(f"__s{k}", F.when(several, found).when(holds(F.col("__from")), F.col("__due")))
    return judge(rows.drop("__from", "__due", "__lo", "__hi", "__dues"))


def judge(rows: DataFrame) -> DataFrame:
    """The nearer of a visit's two schedule rows __s0 and __s1, of the days that begin at __m0 and __m1, and the delays by it."""
    for k in (0, 1):
        m, s = F.col(f"__m{k}"), F.col(f"__s{k}")
        rows = rows.withColumn(f"__b{k}", F.coalesce(F.col("arrival_ts") - m - s["arrival_s"], F.col("departure_ts") - m - s["departure_s"]))
    second = F.col("__b1").isNotNull() & (F.col("__b0").isNull() | (F.abs("__b1") < F.abs("__b0")))
    pick = lambda one, two: F.when(second, F.col(two)).otherwise(F.col(one))
    rows = rows.withColumns({"__s": pick("__s0", "__s1"), "basis": pick("__b0", "__b1"), "__m": pick("__m0", "__m1"), "service_date": F.when(second, F.date_sub("__date", 1)).otherwise(F.col("__date"))})
    rows = rows.filter("basis is not null")
    rows = rows.withColumns({"scheduled_arrival_unix": F.col("__m") + F.col("__s.arrival_s"), "scheduled_departure_unix": F.col("__m") + F.col("__s.departure_s")})
    rows = rows.withColumns({
        "arrival_delay_s": F.col("arrival_ts") - F.col("scheduled_arrival_unix"), "departure_delay_s": F.col("departure_ts") - F.col("scheduled_departure_unix"),
        "stop_sequence": F.coalesce("__s.stop_sequence", "stop_sequence"), "route_id": F.coalesce(true("__s.route_id"), true("route_id")),
        "direction_id": F.coalesce("__s.direction_id", "direction_id"), "vehicle": true("vehicle"), "status": classify(F.col("basis")),
    })
    rows = rows.filter("route_id is not null")
    return rows.withColumn("on_time", F.col("status") == "on_time").drop("__s", "__s0", "__s1", "__b0", "__b1", "__m", "__m0", "__m1", "__date")


def historic_facts(observed: DataFrame, modes: DataFrame, tz: Column | None = None, feeds: dict[str, str] = AGENCY_FEEDS) -> DataFrame:
    """Rows of stop_observations as adherence facts, with their feed and mode.

    observed: strings, as gtfs_zip.read gives them; modes: (route_id, mode), one row for each route. Clocks count from
    the service day's midnight in tz (Los Angeles). The departure is the arrival where none was observed. Rows of other
    agencies, without an arrival, or without a scheduled time to judge by are dropped, as are bad dates, at which
    the reference stops. A direction or sequence that isn't a whole number is null.
    """
    def at(clock: str) -> Column:
        s = hms_seconds(clock)
        return F.when(s >= 0, F.col("__midnight") + s)

    def whole(c: str) -> Column:
        x = F.col(c).try_cast("double")
        return F.when(x == F.floor(x), x.try_cast("int"))

    day = F.try_to_timestamp("service_date", F.lit("yyyyMMdd")).cast("date")
    feed = F.create_map(*[F.lit(x) for pair in feeds.items() for x in pair])
    rows = observed.filter(F.col("agency_id").isin(*feeds)).withColumn("service_date", day)
    rows = rows.withColumn("__midnight", service_midnight("service_date", F.lit("America/Los_Angeles") if tz is None else tz))
    rows = rows.withColumns({
        "arrival_ts": at("observed_arrival_time"), "departure_ts": F.coalesce(at("observed_departure_time"), at("observed_arrival_time")),
        "scheduled_arrival_unix": at("scheduled_arrival_time"), "scheduled_departure_unix": at("scheduled_departure_time"),
    })
    rows = rows.withColumns({"arrival_delay_s": F.col("arrival_ts") - F.col("scheduled_arrival_unix"), "departure_delay_s": F.col("departure_ts") - F.col("scheduled_departure_unix")})
    rows = rows.withColumn("basis", F.coalesce("arrival_delay_s", "departure_delay_s")).filter("arrival_ts is not null and basis is not null")
    rows = rows.withColumns({"status": classify(F.col("basis")), "on_time": classify(F.col("basis")) == "on_time", "direction_id": whole("direction_id"), "stop_sequence": whole("stop_sequence"), "feed": F.element_at(feed, F.col("agency_id"))})
    return rows.join(modes.select("route_id", "mode"), "route_id", "left").select(
        "feed", "trip_id", F.col("to_stop_id").alias("stop_id"), true("vehicle_id").alias("vehicle"), F.col("service_date").cast("string").alias("service_date"), "route_id", "mode", "direction_id", "stop_sequence",
        "arrival_ts", "departure_ts", "scheduled_arrival_unix", "scheduled_departure_unix", "arrival_delay_s", "departure_delay_s", "basis", "status", "on_time",
    )


def otp(facts: DataFrame, keys: list[str], stops: bool) -> DataFrame:
    """A4: counts by status and delays, at either grain."""
    extra = [F.count_distinct("stop_id").alias("distinct_stop_count")] if stops else []
    return facts.groupBy(*keys).agg(
        *extra,
        F.count(F.lit(1)).alias("matched_count"),
        F.count_if("on_time").alias("on_time_count"),
        F.count_if(F.col("status") == "early").alias("early_count"),
        F.count_if(F.col("status") == "late").alias("late_count"),
        F.round(F.count_if("on_time") / F.count(F.lit(1)), 6).alias("on_time_pct"),
        pct_int("arrival_delay_s", 50).alias("arr_delay_p50_s"),
        pct_int("arrival_delay_s", 90).alias("arr_delay_p90_s"),
        F.round(F.avg("arrival_delay_s"), 6).alias("arr_delay_mean_s"),
        pct_int("departure_delay_s", 50).alias("dep_delay_p50_s"),
    )


def tallies(facts: DataFrame) -> DataFrame:
    """A18."""
    return facts.agg(
        F.count_if("on_time").alias("on_time"), F.count_if(F.col("arrival_delay_s") > 0).alias("late"), F.count_if(F.col("arrival_delay_s") < 0).alias("early")
    )


def enrich(events: DataFrame, scheduled: DataFrame) -> DataFrame:
    """The first scheduled row of a trip and stop gives an event its scheduled_tt and scheduled_headway."""
    first = keep_first(scheduled, ["trip_id", "stop_id"], ["arrival_s", "stop_sequence"]).select("trip_id", "stop_id", "scheduled_tt", "scheduled_headway")
    return events.join(first, ["trip_id", "stop_id"], "left")


def route_mode(kind: Column) -> Column:
    """GTFS route type, base and extended, to rapid, cr (commuter rail), bus or other; null is other."""

    def among(*ranges: int | tuple[int, int]) -> Column:
        hit = F.lit(False)
        for r in ranges:
            hit = hit | (kind.between(*r) if isinstance(r, tuple) else kind == r)
        return F.coalesce(hit, F.lit(False))

    return (
        F.when(among(0, 1, 5, 12, (400, 405), (900, 906)), "rapid").when(among(2, (100, 117), (300, 307)), "cr")
        .when(among(3, 11, (200, 209), (700, 716), 800), "bus").otherwise("other")
    )


def with_mode(rows: DataFrame, routes: DataFrame) -> DataFrame:
    """Each row's mode by its route; routes: (route_id, route_type), one row for each. An unknown route is other."""
    modes = routes.select("route_id", route_mode(F.col("route_type")).alias("mode"))
    return rows.join(modes, "route_id", "left").withColumn("mode", F.coalesce("mode", F.lit("other")))
