from datetime import date

import pytest
from pyspark.sql import functions as F

from tramline.operators import alerts, catalogue, normalize, schedule, segments, serve
from tramline.sources import json_feeds

NOON = 1716206400  # 2024-05-20 12:00 UTC


@pytest.mark.parametrize("delay, want", [(-61, "early"), (-60, "on_time"), (0, "on_time"), (300, "on_time"), (301, "late"), (None, None)])
def test_on_time_window(spark, delay, want):
    assert spark.range(1).select(schedule.classify(F.lit(delay).cast("int"))).first()[0] == want


def facts(spark, visits, rows, tz="UTC"):
    v = spark.createDataFrame(visits, "trip_id string, stop_id string, vehicle string, arrival_ts long, departure_ts long, route_id string, direction_id int, local_date date")
    s = spark.createDataFrame(rows, "service_date date, trip_id string, stop_id string, arrival_s int, departure_s int, route_id string, direction_id int, stop_sequence int")
    return schedule.adherence(v, s, F.lit(tz)).collect()


def test_nearest_service_day(spark):
    today, before = date(2024, 5, 20), date(2024, 5, 19)
    owl = facts(spark, [("T", "S", "v", NOON - 43200 + 600, NOON - 43200 + 660, "R", 0, today)], [(before, "T", "S", 86400 + 540, 86400 + 600, "Q", 1, 4)])
    assert [(r["service_date"], r["arrival_delay_s"], r["status"], r["route_id"], r["direction_id"]) for r in owl] == [(before, 60, "on_time", "Q", 1)]
    both = facts(spark, [("T", "S", "v", NOON, NOON, "R", 0, today)], [(d, "T", "S", 43200, 43200, None, None, 1) for d in (today, before)])
    assert [(r["service_date"], r["arrival_delay_s"], r["route_id"]) for r in both] == [(today, 0, "R")]
    untimed = facts(spark, [("T", "S", "v", NOON, NOON + 400, "R", 0, today)], [(today, "T", "S", None, 43200, "R", 0, 1)])
    assert [(r["arrival_delay_s"], r["departure_delay_s"], r["status"]) for r in untimed] == [(None, 400, "late")]
    assert facts(spark, [("T", "S", "v", NOON, NOON, "R", 0, today)], [(today, "T", "S", None, None, "R", 0, 1)]) == []


def test_facts_without_route_or_trip(spark):
    today = date(2024, 5, 20)
    visits = [("T", "S", "", NOON, NOON, None, 0, today), ("", "S", "v", NOON, NOON, "R", 0, today), ("U", "S", "v", NOON, NOON, "", 0, today), ("V", "S", "", NOON, NOON, "R", None, today)]
    rows = [(today, t, "S", 43200, 43200, r, None, None) for t, r in (("T", None), ("", "R"), ("U", ""), ("V", None))]
    v = spark.createDataFrame(visits, "trip_id string, stop_id string, vehicle string, arrival_ts long, departure_ts long, route_id string, direction_id int, local_date date").withColumn("stop_sequence", F.lit(9))
    s = spark.createDataFrame(rows, "service_date date, trip_id string, stop_id string, arrival_s int, departure_s int, route_id string, direction_id int, stop_sequence int")
    assert [(r["trip_id"], r["route_id"], r["vehicle"], r["stop_sequence"]) for r in schedule.adherence(v, s, F.lit("UTC")).collect()] == [("V", "R", None, 9)]


def test_visits_without_a_route_are_no_stops_of_a_segment(spark):
    rows = [("T", s, r, NOON + 60 * i, NOON + 60 * i, "v", 0, "bus") for i, (s, r) in enumerate([("A", "R"), ("B", None), ("B2", ""), ("C", "R")])]
    got = segments.pairs(spark.createDataFrame(rows, "trip_id string, stop_id string, route_id string, arrival_ts long, departure_ts long, vehicle string, direction_id int, mode string")).collect()
    assert [(r["from_stop_id"], r["to_stop_id"]) for r in got] == [("A", "C")]


def test_modes_and_costs(spark):
    kinds = {0: "rapid", 1: "rapid", 2: "cr", 3: "bus", 4: "other", 5: "rapid", 11: "bus", 12: "rapid", 99: "other", 100: "cr", 117: "cr", 118: "other", 209: "bus", 210: "other", 307: "cr", 405: "rapid", 406: "other", 716: "bus", 717: "other", 800: "bus", 801: "other", 906: "rapid", 1200: "other", None: "other"}
    df = spark.createDataFrame([(k,) for k in kinds], "k int")
    assert [r[0] for r in df.select(schedule.route_mode(F.col("k"))).collect()] == list(kinds.values())
    gib = 1 << 30
    objects = spark.createDataFrame([("a", "cold", 100 * gib, 5, 0, 0), ("a", "hot", 10 * gib, 2000, 0, 0), ("a", "landing", 2 * gib, 1, 10**6, 10**6)], "agency string, tier string, bytes long, objects long, puts long, gets long")
    r = catalogue.costs(objects, ["agency"]).first()
    assert (r["cold_usd"], r["hot_usd"], r["landing_usd"], r["requests_usd"], r["total_usd"]) == (0.099, 0.235, 0.046, 5.4, 5.78)


def test_places_that_return(spark):
    rows = [(1, "A", "n", 1.0, 1.0), (2, "A", "n", 2.0, 1.0), (3, "A", "n", 1.0, 1.0), (1, "B", "n", 1.0, 1.0), (3, "B", "n", 1.0, 1.0), (1, "C", "x", 1.0, 1.0), (2, "C", "y", 1.0, 1.0), (3, "C", "y", None, None)]
    presence = spark.createDataFrame(rows, "snap int, stop_id string, name string, lat double, lon double")
    got = catalogue.flapping(presence, presence.select("snap").distinct()).collect()
    assert sorted((r["stop_id"], r["presence_runs"], r["name_returns"], r["place_returns"]) for r in got) == [("A", 1, False, True), ("B", 2, False, False)]


def test_active_services(spark):
    calendar = spark.createDataFrame([("WD", 1, 1, 1, 1, 1, 0, 0, date(2024, 5, 1), date(2024, 5, 31))], "service_id string, monday int, tuesday int, wednesday int, thursday int, friday int, saturday int, sunday int, start_date date, end_date date")
    x = spark.createDataFrame([("WD", date(2024, 5, 27), 2), ("HOL", date(2024, 5, 27), 1)], "service_id string, date date, exception_type int")
    days = spark.createDataFrame([(date(2024, 5, d),) for d in (25, 27, 28)] + [(date(2024, 6, 3),)], "day date")
    assert sorted((r["day"].day, r["service_id"]) for r in schedule.active_services(calendar, x, days).collect()) == [(27, "HOL"), (28, "WD")]


def test_one_segment(spark):
    visits = spark.createDataFrame([("R1", 0, "T1", "V1", "S1", NOON, NOON + 30, "bus"), ("R1", 0, "T1", "V1", "S2", NOON + 630, NOON + 660, "bus"), ("R1", 0, "T2", "V1", "S1", NOON, NOON, "bus"), ("R1", 0, "T2", "V1", "S2", NOON + 1, NOON + 1, "bus")], "route_id string, direction_id int, trip_id string, vehicle string, stop_id string, arrival_ts long, departure_ts long, mode string")
    stops = spark.createDataFrame([("S1", 40.7580, -73.9855), ("S2", 40.7506, -73.9971)], "stop_id string, lat double, lon double")
    rows = segments.speeds(segments.with_coords(segments.pairs(visits), stops)).collect()  # T2 is too fast
    assert [(r["trip_id"], r["transit_s"]) for r in rows] == [("T1", 600)]
    air = rows[0]["distance_m"]
    along = spark.createDataFrame([("T1", "S1", 100.0), ("T1", "S2", 100.0 + 2 * air)], "trip_id string, stop_id string, along_m double")
    assert abs(segments.speeds(segments.with_coords(segments.pairs(visits), stops), along).filter("trip_id = 'T1'").first()["distance_m"] - 2 * air) < 1e-6
    loop = along.withColumn("along_m", F.when(F.col("stop_id") == "S2", 100.0 + 9 * air).otherwise(F.col("along_m")))
    assert abs(segments.speeds(segments.with_coords(segments.pairs(visits), stops), loop).filter("trip_id = 'T1'").first()["distance_m"] - air) < 1e-6


@pytest.mark.parametrize("text, want", [("Delays of about 10 minutes", 10), ("delays of up to 20 minutes and 5 minutes late", 20), ("running 5 minutes late", 5), ("10 - 15 minutes behind schedule", 15), ("12-7 minutes late", 12), ("30+ minutes", None), ("up to 20 min delay", None), ("no numbers", None), ("Line 7 suspended", None)])
def test_delay_minutes(spark, text, want):
    assert spark.range(1).select(alerts.delay_minutes(F.lit(text))).first()[0] == want


def test_alert_rules(spark):
    cases = [("STRIKE", "signal problem", "strike"), (None, "A Signal Problem and police", "signal_problem"), ("OTHER_CAUSE", "police", "other"), ("HOLIDAY", "fire", "other"), ("BRAND_NEW", "police", "other"), ("UNKNOWN_CAUSE", "police and smoke", "police_activity"), ("", "Disabled vehicle on the tracks", "car_traffic"), (None, "snow", "other"), (None, None, "other"), (None, "a switch issue", "switch_problem")]
    df = spark.createDataFrame(cases, "cause string, text string, want string")
    assert [r[0] for r in df.select(alerts.alert_type(F.col("cause"), F.col("text"))).collect()] == [c[2] for c in cases]
    assert len(alerts.TYPES) == 18
    cases = [("REDUCED_SERVICE", "", True), ("SIGNIFICANT_DELAYS", None, True), ("NO_SERVICE", "delays of 5 minutes", False), ("UNKNOWN_EFFECT", "Delays of about 5 minutes", True), ("OTHER_EFFECT", "delays", False), (None, "running behind schedule", True), (None, "late", False), ("", "7 minutes late", True)]
    df = spark.createDataFrame(cases, "effect string, text string, want boolean")
    assert [r[0] for r in df.select(alerts.is_delay(F.col("effect"), F.col("text"))).collect()] == [c[2] for c in cases]
    t = "array(named_struct('language','fr','text','a'), named_struct('language','en-US','text','b'))"
    assert spark.sql(f"select {t} as t").select(alerts.pick_translation(F.col("t")), alerts.pick_translation(F.col("t"), silver=True)).first() == ("b", "a")
    empty = spark.sql("select array_remove(array(named_struct('language','x','text','y')), named_struct('language','x','text','y')) as t")
    assert empty.select(alerts.pick_translation(F.col("t")), alerts.pick_translation(F.col("t"), silver=True)).first() == ("", None)


def test_normalisers(spark):
    index = spark.createDataFrame([("604", "CC604"), ("Orange", "OR")], "token string, canonical string")
    mwrta = spark.createDataFrame([("7", 1716220800, "604", None, 1.0, 2.0, 10.0, 90.0, "2024-05-20T12:00:00")], "vehicle_id string, feed_timestamp long, route string, route_name string, latitude double, longitude double, speed double, heading double, vehicle_datetime string")
    r = normalize.normalize("mwrta_vehicles", mwrta, F.lit("America/New_York"), index).first()
    assert (r["route_id"], r["ts_utc"], r["speed_mps"], r["raw_speed"], r["speed_unit"], r["resolution_status"]) == ("CC604", 1716220800, None, 10.0, "unknown", "resolved")
    fuzzy = normalize.normalize("mwrta_vehicles", mwrta.withColumn("route_name", F.lit("oran")), F.lit("America/New_York"), index, agency="ccrta").first()
    assert (fuzzy["route_id"], fuzzy["raw_route"], fuzzy["resolution_status"]) == ("OR", "oran", "resolved")
    swiv = spark.createDataFrame([("1", 5, 1.0, 2.0, 3.0, 36.0, 77)], "vehicle_id string, feed_timestamp long, latitude double, longitude double, heading double, speed double, route_line_id long")
    r = normalize.normalize("swiv_vehicles", swiv, F.lit("UTC"), index).first()
    assert (r["route_id"], round(r["speed_mps"], 6), r["resolution_status"]) == (None, 10.0, "route_unresolved")
    topo = spark.createDataFrame([(77, " Orange "), (78, "CC604")], "id_ligne long, nom_commercial string")
    lines = swiv.unionByName(swiv.withColumn("route_line_id", F.lit(78).cast("long"))).unionByName(swiv.withColumn("route_line_id", F.lit(None).cast("long"))).unionByName(swiv.withColumn("route_line_id", F.lit(18045).cast("long")))
    got = normalize.normalize("swiv_vehicles", lines, F.lit("UTC"), index.union(spark.createDataFrame([("27", "W27")], "token string, canonical string")), topo, agency="WRTA").collect()
    assert sorted(((r["raw_route"], r["route_id"], r["resolution_status"]) for r in got), key=repr) == sorted([("77", "OR", "resolved"), ("78", "CC604", "passthrough"), (None, None, "no_route"), ("18045", "W27", "resolved")], key=repr)
    match = spark.createDataFrame([(str(i), 5, 1.0, 2.0, 3.0, 10.0, r, "t", None) for i, r in enumerate(["Wk Rt 0604", "CC604", "x", None])], "vehicle_id string, feed_timestamp long, latitude double, longitude double, heading double, speed double, route_id string, trip_id string, last_update string")
    got = sorted((r["vehicle_id"], r["route_id"], r["trip_id"], r["resolution_status"]) for r in normalize.normalize("routematch_vehicles", match, F.lit("UTC"), index).collect())
    assert got == [("0", "CC604", None, "resolved"), ("1", "CC604", None, "passthrough"), ("2", None, None, "route_unresolved"), ("3", None, None, "no_route")]


DECODED = {
    "mta_lirr_json": ("lirr_trains", '[{"train_num": "604", "location": {"latitude": 1, "longitude": 2, "heading": 3, "speed": 10, "timestamp": 7}, "status": {}, "details": {"stops": [{"code": "JAM", "stop_status": "EN_ROUTE"}]}}]', (None, "T604", "S1", 4.4704, None, "mps", "no_route", 7)),
    "mwrta_json": ("mwrta_vehicles", '[{"ID": 1, "Route": "Orange", "Lat": 1, "Long": 2, "Speed": 10, "Heading": 3, "DateTime": "2024-05-20T12:00:00", "VehiclePlate": "p"}]', ("OR", None, None, None, 10.0, "unknown", "resolved", 1716220800)),
    "routematch_json": ("routematch_vehicles", '{"data": [{"vehicleId": 1, "latitude": 1, "longitude": 2, "lastUpdate": "2024-05-20T12:00:00-04:00", "masterRouteId": "Rte 604", "tripId": "x", "speed": 10}]}', ("CC604", None, None, 4.4704, None, "mps", "resolved", 1716220800)),
    "trillium_json": ("trillium_vehicles", '[{"id": 1, "lat": 1, "lon": 2, "lastUpdated": "2024-05-20T16:00:00Z", "route_short_name": "OR", "speed": 10}]', ("OR", None, None, None, 10.0, "unknown", "passthrough", 1716220800)),
    "swiv_json": ("swiv_vehicles", '[{"id": 1, "localisation": {"lat": 1, "lng": 2, "cap": 3}, "conduite": {"idLigne": 77, "vitesse": 36}}]', ("OR", None, None, 10.0, None, "mps", "resolved", 1716220801)),
    "vta_json": ("vta_vehicles", '[{"vehicleId": 1, "lat": 1, "lng": 2, "headsignText": "604", "velocity": 10, "lastUpdate": "2024-05-20T12:00:00"}]', ("CC604", None, None, 4.4704, None, "mps", "resolved", 1716220800)),
    "passio_json": ("passio_vehicles", '{"buses": {"9": [{"busId": 1, "latitude": 1, "longitude": 2, "route": "Orange Loop", "tripId": "x", "created": null}]}}', ("OR", None, None, None, None, "unknown", "resolved", 1716220801)),
}


@pytest.mark.parametrize("decoder", sorted(DECODED))
def test_decoder_output_goes_through_its_normaliser(spark, decoder):
    table, payload, want = DECODED[decoder]
    names = lambda rows: spark.createDataFrame(rows, "token string, canonical string")
    rows = json_feeds.decode(spark.createDataFrame([(payload.encode(), 1716220801)], "payload binary, fetched_at long"), decoder)
    topo = spark.createDataFrame([(77, "Orange")], "id_ligne long, nom_commercial string")
    got = normalize.normalize(table, rows, F.lit("America/New_York"), names([("604", "CC604"), ("Orange", "OR")]), topo, names([("604", "T604")]), names([("JAM", "S1")])).collect()
    r = got[0]
    assert len(got) == 1 and r["latitude"] == 1.0 and r["longitude"] == 2.0
    assert (r["route_id"], r["trip_id"], r["stop_id"], r["speed_mps"] and round(r["speed_mps"], 6), r["raw_speed"], r["speed_unit"], r["resolution_status"], r["ts_utc"]) == want


def test_route_tokens(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(c) for c in normalize.strip_route_prefix(F.lit(" Route 5 North "))] == ["Route 5 North", "5 North", "Route 5"]
    assert [one(c) for c in normalize.strip_route_prefix(F.lit("Airport Loop"))] == ["Airport Loop", None, "Airport"]
    marks = {"Wk Rt 01": "1", "Rte 34": "34", "Route 5 Loop": "5", "Rt. 05 Orange": "5", "Rte 7 a": "7", "Rte 7a": "7A", "Route 010": "10", "Wk 12": None, "Rt05": None, "00": "0", "": None, None: None}
    assert {t: one(normalize.strip_route_marks(F.lit(t).cast("string"))) for t in marks} == marks
    names = spark.createDataFrame([("Hyannis Loop", "H"), ("Barnstable Hyannis", "B"), ("Hyannis", "Y")], "name string, route_id string")
    tokens = spark.createDataFrame([("hyann",), ("stable",), ("none",), (" ",)], "token string")
    assert {r[0]: r[1] for r in normalize.resolve_fuzzy(tokens, names).collect()} == {"hyann": "Y", "stable": "B"}


def test_read_kind_refuses_unknown_columns(spark):
    df = spark.createDataFrame([("2024-05-20", "R", 2024, 5)], "service_date string, route_id string, year int, month int")
    assert serve.read_kind(df, "2024-05-01", "2024-05-31", {"route_id": ["R"]}, 5).count() == 1
    with pytest.raises(ValueError):
        serve.read_kind(df, filters={"nope": [1]})


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "mart")
    spark.createDataFrame([("2024-05-20", "R", 2024, 5), ("2024-06-20", "R", 2024, 6)], "service_date string, route_id string, year int, month int").write.partitionBy("year", "month").parquet(path)
    df = serve.read_kind(spark.read.parquet(path), "2024-05-01", "2024-05-31", {"route_id": ["R"]})
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(year" in plan and "EqualTo(route_id,R)" in plan
    assert df.count() == 1


def test_quartiles_are_not_ntile(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "k int, v double")
    b = [r["bucket"] for r in serve.quartile(df, "v", ["k"]).orderBy("v").collect()]
    assert [b.count(i) for i in range(4)] == [3, 2, 2, 3]


def test_notes_and_slug(spark):
    cases = [(0, 0.0, 0.0, 0.0, 0.0, "no rows"), (9, 0.5, 0.0, 0.0, 0.0, "no stop_id → use --source trip-updates; no route_id"), (9, 1.0, 0.9, 50.0, None, "no current_status → position-based dwell; no direction → GTFS backfill"), (9, 2.0, 2.0, 2.0, 2.0, "")]
    df = spark.createDataFrame(cases, "n long, stop double, status double, route double, dir double, want string")
    assert [r[0] for r in df.select(catalogue.notes(F.col("n"), {k: F.col(k) for k in ("stop", "status", "route", "dir")})).collect()] == [c[-1] for c in cases]
    assert spark.range(1).select(catalogue.version_slug(F.lit("2024-05-20T10:00:00.123Z"))).first()[0] == "20240520T100000"


def test_two_hops(spark):
    rows = spark.createDataFrame([(1,), (2,), (3,)], "route_line_id long")
    static = spark.createDataFrame([(1, "A")], "id_ligne long, route_id string")
    side = spark.createDataFrame([(1, "x"), (2, "5")], "id_ligne long, nom_commercial string")
    routes = spark.createDataFrame([("5", "R5")], "route_short_name string, route_id string")
    assert {r[0]: r[1] for r in normalize.two_hop(rows, static, side, routes.withColumnRenamed("route_id", "route_id")).collect()} == {1: "A", 2: "R5", 3: None}


def test_direction_chain(spark):
    rows = spark.createDataFrame([("R", "A", "B", "T1", 14), ("R", "B", "C", "T1", 14), ("R", "B", "C", "T2", 1), ("R", "B", "C", "T3", None)], "route_id string, from_stop_id string, to_stop_id string, trip_id string, direction_id int")
    geometry = segments.directions(spark.createDataFrame([("R", 0, "S", "A", 1.0), ("R", 0, "S", "B", 2.0)], "route_id string, direction_id int, shape_id string, stop_id string, along_m double"))
    trips = spark.createDataFrame([("T1", 1), ("T3", None)], "trip_id string, direction_id int")
    got = segments.with_direction(rows, geometry, trips)
    assert got.columns and sorted((r["from_stop_id"], r["trip_id"], r["direction_id"]) for r in got.collect()) == [("A", "T1", 0), ("B", "T1", 1), ("B", "T2", 1), ("B", "T3", None)]


def test_range_of_days_is_whole_or_an_error(spark):
    rows = spark.createDataFrame([(date(2024, 3, 3), 2)], "day date, n int")
    got = alerts.dense_daily(rows, "day", "2024-01-01", "2024-03-03", ["n"]).collect()
    assert len(got) == 63 and {r["day"]: r["n"] for r in got}[date(2024, 3, 3)] == 2
    with pytest.raises(ValueError):
        alerts.dense_daily(rows, "day", "2024-01-01", "2024-03-04", ["n"])
