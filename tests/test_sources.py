import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from tramline.operators import schedule
from tramline.sources import frames, gtfs_zip, gtfsrt, json_feeds, sinks


def payloads(spark, *bodies):
    return spark.createDataFrame([(b if isinstance(b, bytes) else json.dumps(b).encode(), 1000) for b in bodies], "payload binary, fetched_at long")


def test_frames():
    whole = frames.frame([b"a", b"", b"ccc"])
    assert [x[0] for x in frames.unframe(whole)] == [b"a", b"", b"ccc"]
    assert [x[2] for x in frames.unframe(whole[:-1])] == [None, None, "truncated"]
    assert [x[2] for x in frames.unframe(whole[:-1] + b"x")] == [None, None, "corrupt"]
    assert [x[2] for x in frames.unframe(frames.MAGIC + b"\x09")] == ["bad_header"]
    assert [x[0] for x in frames.unframe(b"old")] == [b"old"]


def test_landing(spark, tmp_path):
    day = tmp_path / "mbta/bins/2024-05-20"
    day.mkdir(parents=True)
    (day / "window=1200.bin").write_bytes(frames.frame([b"a", b"b"]))
    meta = tmp_path / "mbta/metadata/2024-05-20"
    meta.mkdir(parents=True)
    digest = next(frames.unframe(b"a"))[1]
    (meta / "data.jsonl").write_text(json.dumps({"timestamp": 1205.9, "digest": digest}) + "\n" + json.dumps({"timestamp": 1201.5, "digest": digest}) + "\nbroken\n")
    files = frames.read_bins(spark, str(tmp_path))
    got = frames.landed(frames.payloads(files), frames.read_metadata(spark, str(tmp_path)))
    assert sorted((bytes(r["payload"]), r["fetched_at"]) for r in got.collect()) == [(b"a", 1201), (b"b", 1200)]
    assert [tuple(r) for r in frames.discover(files).collect()] == [("mbta", "2024-05-20")]
    assert frames.discover(files, before="2024-05-20").count() == 0


def message():
    m = gtfsrt.messages()["Feed"]()
    m.header.timestamp = 999
    v = m.entity.add(id="1").vehicle
    v.trip.trip_id, v.vehicle.id, v.position.latitude, v.position.longitude, v.current_status, v.timestamp = "T", "V", 1.5, 2.5, 1, 77
    u = m.entity.add(id="2").trip_update
    u.trip.trip_id = "T"
    for i, rel in enumerate((None, 1)):
        s = u.stop_time_update.add(stop_id=f"S{i}")
        s.arrival.time = 100 + i
        if rel is not None:
            s.schedule_relationship = rel
    a = m.entity.add(id="3").alert
    a.cause, a.effect = 3, 3
    for lang, text in (("fr", "retard"), ("en", "late")):
        a.header_text.translation.add(text=text, language=lang)
    a.informed_entity.add(route_id="R")
    a.informed_entity.add(stop_id="S")
    m.entity.add(id="4").alert.cause = 1
    return m.SerializeToString()


def test_realtime_messages(spark):
    df = payloads(spark, message(), b"\xff\xff")
    v = gtfsrt.decode(df, "vehicles").collect()
    assert [(r["vehicle_id"], r["latitude"], r["status"], r["ts"], r["feed_timestamp"], r["bearing"]) for r in v] == [("V", 1.5, "STOPPED_AT", 77, 999, None)]
    u = gtfsrt.decode(df, "trip_updates").collect()
    assert [(r["stop_id"], r["arrival_time"], r["departure_time"], r["schedule_relationship"]) for r in u] == [("S0", 100, None, None), ("S1", 101, None, "SKIPPED")]
    a = gtfsrt.decode(df, "alerts").collect()
    assert [(r["alert_id"], r["cause"], r["header_text"], r["route_id"], r["stop_id"]) for r in a] == [("3", "TECHNICAL_PROBLEM", "late", "R", None), ("3", "TECHNICAL_PROBLEM", "late", None, "S")]


MWRTA = {"ID": 7, "Route": 604, "Lat": "42.1", "Long": -71.5, "Speed": 3, "Heading": 90, "DateTime": "2024-01-01T00:00:00", "VehiclePlate": "x"}


def test_json_drift(spark):
    short = {k: v for k, v in MWRTA.items() if k != "Lat"}
    df = payloads(spark, [MWRTA, "note", short, MWRTA | {"New": 1, "Active": True}])
    rows = json_feeds.decode(df, "mwrta_json").collect()
    assert [(r["vehicle_id"], r["route"], r["latitude"], r["active"]) for r in rows] == [("7", "604", 42.1, None), ("7", "604", 42.1, True)]
    drift = json_feeds.drift(df, "mwrta_json").collect()
    assert [(r["drift_missing_required"], r["drift_extras"]) for r in drift] == [(["Lat"], []), ([], ["New"])]


CASES = {
    "mta_lirr_json": ([{"train_num": "T1", "location": {"latitude": 1.0, "speed": 5}, "status": {"canceled": False}, "details": {"stops": [{"code": "A", "stop_status": "DEPARTED"}, {"code": "B", "stop_status": None}, {"code": "C"}]}}], {"train_num": "T1", "current_stop_code": "B", "current_stop_seq": 2, "speed_mph": 5.0, "canceled": False}),
    "routematch_json": ({"data": [{"vehicleId": 9, "latitude": 1, "longitude": 2, "lastUpdate": "z", "masterRouteId": "Wk 1"}]}, {"vehicle_id": "9", "route_id": "Wk 1", "deadhead": None}),
    "trillium_json": ([{"id": 4, "lat": 1, "lon": 2, "lastUpdated": "t", "heading": "SE", "capacity": 30}], {"vehicle_id": "4", "heading": "SE", "capacity": 30}),
    "swiv_json": ({"vehicule": [{"id": 5, "localisation": {"lat": 1.5}, "conduite": {"idLigne": 12, "arretSuiv": {"estimationTemps": 60}}}]}, {"vehicle_id": "5", "latitude": 1.5, "longitude": None, "route_line_id": 12, "next_stop_eta": 60}),
    "vta_json": ([{"vehicleId": "8", "lat": 1, "lng": 2, "velocity": 10}], {"vehicle_id": "8", "velocity": 10.0}),
    "passio_json": ({"buses": {"-1": [{"busId": 0, "latitude": "1", "longitude": "1"}], "3": [{"busId": 3, "latitude": "1.5", "longitude": "", "paxLoad": 4}], "4": None}}, {"vehicle_id": "3", "latitude": 1.5, "longitude": None, "pax_load": 4}),
    "marta_json": ([{"EVENT_TIME": "05/08/2026 11:59:00 PM", "DESTINATION": "D", "DIRECTION": "N", "IS_REALTIME": "true", "LINE": "RED", "NEXT_ARR": "12:01:00 AM", "STATION": "S", "TRAIN_ID": "1", "WAITING_SECONDS": "120", "WAITING_TIME": "2 min", "DELAY": "T197S"}], {"delay": 197, "is_realtime": True, "waiting_seconds": 120}),
}


@pytest.mark.parametrize("decoder", CASES)
def test_json_feeds(spark, decoder):
    body, want = CASES[decoder]
    (row,) = json_feeds.decode(payloads(spark, body), decoder).collect()
    assert {k: row[k] for k in want} == want
    if decoder == "marta_json":
        assert row["next_arr"] - row["event_time"] == 120
    if decoder == "trillium_json":
        assert json_feeds.decode(payloads(spark, {"data": body}), decoder).count() == 1


def test_static_zip(spark):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("trips.txt", "﻿trip_id,route_id,service_id\nT1, R1 ,WD\n,R2,WD\n")
        z.writestr("stop_times.txt", 'trip_id,stop_sequence,stop_id,arrival_time,departure_time\nT1,1,"A, B",25:00:00,\nT1,2,C,bad,08:00:00\n')
    files = spark.createDataFrame([("z.zip", out.getvalue())], "path string, content binary")
    trips = gtfs_zip.typed(gtfs_zip.read(files, "trips"), "trips").collect()
    assert [(r["trip_id"], r["route_id"], r["direction_id"]) for r in trips] == [("T1", "R1", None)]
    times = gtfs_zip.typed(gtfs_zip.read(files, "stop_times"), "stop_times").collect()
    assert [(r["stop_id"], r["arrival_s"], r["departure_s"], r["stop_sequence"]) for r in times] == [("A, B", 90000, None, 1), ("C", None, 28800, 2)]
    assert gtfs_zip.read(files, "shapes").count() == 0


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "mart")
    first = spark.createDataFrame([("a", 1, "2024", 9), ("b", 2, "2024", 9)], "feed string, n int, year string, extra int")
    sinks.write_mart(first, ["n"], path, ["feed", "year"])
    sinks.write_mart(first.filter("feed = 'b'").withColumn("n", F.lit(5)), ["n"], path, ["feed", "year"])
    assert sorted((r["feed"], r["n"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 5)]
    work = spark.createDataFrame([("m", "a", "d1"), ("m", "b", "d1")], "mart string, feed string, day string")
    done = str(tmp_path / "manifest")
    assert sinks.todo(spark, work, done).count() == 2
    sinks.mark_done(spark, work.filter("feed = 'a'"), done)
    assert [r["feed"] for r in sinks.todo(spark, work, done).collect()] == ["b"]
    assert sinks.todo(spark, work, done, force=True).count() == 2
    events = spark.createDataFrame([("f", "bus", "R", 0, "S", "2024-05-20", 9, "DEP"), ("f", "bus", "R", 0, "S", "2024-05-20", 5, "ARR")], "feed string, mode string, route_id string, direction_id int, stop_id string, service_date string, event_unix long, event_type string")
    sinks.write_events_csv(events, str(tmp_path / "csv"))
    (csv,) = (tmp_path / "csv/feed=f/mode=bus/bucket=R-0-S/Year=2024/Month=05/Day=20").glob("*.csv")
    assert [line.split(",")[-1] for line in csv.read_text().split()[1:]] == ["ARR", "DEP"]


def test_frame_layout():
    body = frames.frame([b"xy"])
    assert body[:5] == b"\x89GRT\x01" and struct.unpack(">I", body[5:9]) == (2,)


def test_historic_observations_to_facts(spark):
    head = "agency_id,trip_id,service_date,vehicle_id,stop_sequence,observed_arrival_time,observed_departure_time,route_id,direction_id,to_stop_id,scheduled_arrival_time,scheduled_departure_time,other"
    lines = [
        "SF,T1,20240520,V,3,08:00:30,,R,1,S,08:00:00,08:01:00,x", "XX,T2,20240520,V,3,08:00:30,,R,1,S,08:00:00,,x",
        "SC,T3,20240520,,2.0,25:10:00,25:12:00,Q,east,S,,25:05:00,x", "CT,T4,20240520,V,1,,08:00:00,R,0,S,08:00:00,08:00:00,x",
        "CE,T5,20240520,V,1,08:00:00,,R,0,S,,,x", "AM,T6,20240310,V,1,08:00:00,,R,0,S,08:02:00,,x", "SA,T7,oops,V,1,08:00:00,,R,0,S,08:02:00,,x",
    ]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("stop_observations.txt", "\n".join([head, *lines]))
    files = spark.createDataFrame([("h.zip", out.getvalue())], "path string, content binary")
    scan = gtfs_zip.read(files, "stop_observations", {"agency_id": list(schedule.AGENCY_FEEDS)})
    assert sorted((r["ord"], r["trip_id"]) for r in scan.collect()) == [(k, f"T{k + 1}") for k in (0, 2, 3, 4, 5, 6)]
    modes = spark.createDataFrame([("R", "bus")], "route_id string, mode string")
    got = {r["trip_id"]: r for r in schedule.historic_facts(scan, modes).collect()}
    assert set(got) == {"T1", "T3", "T6"}
    midnight = 1716188400  # 2024-05-20 00:00 in Los Angeles
    one, three, six = got["T1"], got["T3"], got["T6"]
    assert (one["feed"], one["mode"], one["service_date"], one["vehicle"], one["direction_id"], one["stop_sequence"]) == ("sfmta-vehicles", "bus", "2024-05-20", "V", 1, 3)
    assert (one["arrival_ts"], one["departure_ts"], one["arrival_delay_s"], one["departure_delay_s"], one["status"]) == (midnight + 28830, midnight + 28830, 30, -30, "on_time")
    assert (three["arrival_ts"], three["arrival_delay_s"], three["departure_delay_s"], three["status"], three["on_time"]) == (midnight + 90600, None, 420, "late", False)
    assert (three["mode"], three["vehicle"], three["direction_id"], three["stop_sequence"]) == (None, None, None, 2)
    assert (six["arrival_ts"], six["status"]) == (1710082800, "early")  # 08:00 after the clocks went forward
