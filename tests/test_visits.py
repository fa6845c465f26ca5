import random

import pytest

from tramline.operators import marts
from tramline.operators import visits as v

PINGS = "vehicle_id string, trip_id string, route_id string, direction_id int, ts long, ord long, stop_id string, status string"


def pings(spark, *rows):
    """(vehicle, ts, stop, status) each."""
    return spark.createDataFrame([(r[0], "T", "R", 0, r[1], i, r[2], r[3]) for i, r in enumerate(rows)], PINGS)


def found(df):
    return sorted((r["vehicle"], r["stop_id"], r["arrival_ts"], r["departure_ts"], r["ping_count"]) for r in df.collect())


def test_status_runs_and_merge_at_the_gap(spark):
    rows = [("a", 0, "S", "STOPPED_AT"), ("a", 10, "S", "STOPPED_AT"), ("a", 20, "S", "IN_TRANSIT_TO"), ("a", 70, "S", "STOPPED_AT"), ("a", 131, "S", "IN_TRANSIT_TO"), ("a", 132, "S", "STOPPED_AT"), ("a", 140, None, "STOPPED_AT")]
    df = pings(spark, *rows)
    assert found(v.visits(df, 0)) == [("a", "S", 0, 10, 2), ("a", "S", 70, 70, 1), ("a", "S", 132, 132, 1)]
    assert found(v.visits(df, 60)) == [("a", "S", 0, 70, 3), ("a", "S", 132, 132, 1)]
    assert found(v.visits(df, 62)) == [("a", "S", 0, 132, 4)]


def test_null_status_closes_a_run_in_status_mode(spark):
    df = pings(spark, ("a", 0, "S", "STOPPED_AT"), ("a", 5, "S", None), ("a", 9, "S", "STOPPED_AT"))
    assert len(found(v.visits(df, 0))) == 2


def test_position_mode_has_the_last_time(spark):
    df = pings(spark, ("a", 0, "S", None), ("a", 30, "S", ""), ("a", 60, "Q", None))
    assert found(v.visits(df, 0)) == [("a", "Q", 60, 60, 1), ("a", "S", 30, 30, 2)]


def test_ping_keys(spark):
    rows = [(None, "T1", "R", 0, 5, 0, "S", "STOPPED_AT"), ("", "", "R", 0, 6, 1, "S", "STOPPED_AT"), (None, None, "R", 0, 7, 2, "S", "STOPPED_AT"), ("v", "T", "R", 0, None, 3, "S", "STOPPED_AT")]
    assert [r[0] for r in found(v.visits(spark.createDataFrame(rows, PINGS)))] == ["", "T1"]


def model(rows, gap):
    """One vehicle at a time, ping by ping."""
    out = []
    for vehicle in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == vehicle), key=lambda r: r[1])
        status = any(r[3] for r in own)
        run, visits = None, []
        for _, ts, stop, st in own:
            here = stop if stop is not None and (not status or st == "STOPPED_AT") else None
            if run and run[0] == here:
                run[2], run[3] = ts, run[3] + 1
            else:
                if run:
                    visits.append(run)
                run = [here, ts, ts, 1] if here is not None else None
        visits += [run] if run else []
        if not status:
            visits = [[s, d, d, n] for s, _, d, n in visits]
        merged = []
        for s, a, d, n in visits:
            if merged and merged[-1][0] == s and 0 <= a - merged[-1][2] <= gap:
                merged[-1][2], merged[-1][3] = d, merged[-1][3] + n
            else:
                merged.append([s, a, d, n])
        out += [(vehicle, *m) for m in merged]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_random_pings_equal_a_plain_model(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(25):
        ts, by_status = 0, i % 3
        for _ in range(40):
            ts += rng.choice([5, 20, 61])
            rows.append((f"v{i}", ts, rng.choice(["A", "A", "B", None]), rng.choice(["STOPPED_AT", "STOPPED_AT", "IN_TRANSIT_TO", None]) if by_status else None))
    df = pings(spark, *rows)
    assert found(v.visits(df.repartition(5), 60)) == model(rows, 60)


UPDATES = "trip_id string, stop_id string, feed_timestamp long, schedule_relationship string, arrival_time long, departure_time long, vehicle_id string, vehicle_label string"


def test_latest_usable_prediction(spark):
    rows = [("T", "S", 1000, "SCHEDULED", None, 995, "v", None), ("T", "S", 1010, None, 1003, None, "", "L"), ("T", "S", 1020, "SKIPPED", 1, 1, "v", None), ("T", "S", 1030, None, None, None, "v", None), (None, "S", 9, None, 1, 1, "v", None)]
    got = v.update_visits(spark.createDataFrame(rows, UPDATES), ["feed_timestamp"]).collect()
    assert [tuple(r) for r in got] == [("L", "T", "S", 1003, 1003)]


def test_countdowns(spark):
    rows = [(" 7 ", "A", "N", 1000 + 10 * i, 1190, 196 - 10 * i, i) for i in range(19)] + [("", "A", "N", 0, 0, 0, 99), ("8", "A", "N", 0, 900, 130, 100)]
    df = spark.createDataFrame(rows, "train string, station string, destination string, ts long, next_arr long, waiting_seconds long, ord long")
    got = v.approaches(df).collect()
    assert [(r["train"], r["arrival_ts"], r["least_wait"], r["pings"]) for r in got] == [("7", 1180, 16, 19)]
    stops = spark.createDataFrame([("7", "A", "North Ave", 1), ("7", "B", "North Ave", 2), ("7", "B", "South", 3), ("7", "A", "South", 9)], "train string, station string, destination string, arrival_ts long")
    trips = sorted((r["arrival_ts"], r["trip_id"], r["stop_sequence"]) for r in v.destination_trips(stops).collect())
    assert trips == [(1, "7-001-NORTH-AVE", 1), (2, "7-001-NORTH-AVE", 2), (3, "7-002-SOUTH", 1), (9, "7-002-SOUTH", 2)]


def test_marts(spark):
    rows = [("R", 0, "S", "2024-05-20", "2024-05-20", 0, 60, "T1", "a"), ("R", 0, "S", "2024-05-20", "2024-05-20", 300, 420, "T2", "b"), ("R", 0, "S", "2024-05-20", "2024-05-20", 720, 900, "", "a"), ("R", 0, "S", "2024-05-20", "2024-05-20", 1200, 1440, "T3", ""), ("R", None, "S", "2024-05-20", "2024-05-20", 5, 6, "T4", "c"), ("", 0, "S", "2024-05-20", "2024-05-20", 7, 8, "T5", "d")]
    df = spark.createDataFrame(rows, "route_id string, direction_id int, stop_id string, service_date string, feed_day string, arrival_ts long, departure_ts long, trip_id string, vehicle string")
    day = {r["direction_id"]: r for r in marts.stop_day(df).collect()}
    assert set(day) == {0, None}
    r = day[0]
    assert (r["visit_count"], r["trip_count"], r["distinct_vehicle_count"]) == (4, 3, 2)
    assert (r["headway_p50_s"], r["dwell_p50_s"], r["dwell_p90_s"]) == (420, 150, 222)
    assert day[None]["headway_p50_s"] is None and day[None]["headway_cov"] is None
    route = {r["direction_id"]: r for r in marts.route_day(df).collect()}
    assert route[0]["headway_p50_s"] == 420 and route[0]["distinct_stop_count"] == 1 and set(route) == {0, None}
    assert sum(r["visit_count"] for r in route.values()) * 2 == marts.events(df).count()
