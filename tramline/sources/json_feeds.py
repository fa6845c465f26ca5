"""Vendors' JSON payloads to tables: one description each, one engine.

A record is parsed as a map of strings, so drift shows in its keys: a record without a required key is left out, unknown
keys are reported. Nested values stay JSON until a path asks for them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.functions.timeutil import clock_near, meridian_to_utc
from tramline.functions.stats import true

NEW_YORK = "America/New_York"


class Feed(NamedTuple):
    table: str
    required: str
    optional: str
    fields: dict[str, str]  # column -> "Key[.path] type"


def _array(payload: Column) -> Column:
    return F.from_json(payload, "array<string>")


def _under(key: str):
    return lambda payload: _array(F.get_json_object(payload, f"$.{key}"))


def _bare_or_under(key: str):
    return lambda payload: F.when(F.startswith(F.ltrim(payload), F.lit("[")), _array(payload)).otherwise(_under(key)(payload))


def _map_of_lists(payload: Column) -> Column:
    buses = F.from_json(F.get_json_object(payload, "$.buses"), "map<string,array<string>>")
    return F.flatten(F.map_values(F.map_filter(buses, lambda k, v: (k != "-1") & v.isNotNull())))


FEEDS: dict[str, tuple[Feed, object]] = {
    "mta_lirr_json": (Feed("lirr_trains", "train_num location status details", "realtime", {
        "train_num": "train_num string", "realtime": "realtime boolean", "canceled": "status.canceled boolean", "latitude": "location.latitude double",
        "longitude": "location.longitude double", "heading": "location.heading double", "speed_mph": "location.speed double", "location_timestamp": "location.timestamp long",
    }), _array),
    "mwrta_json": (Feed("mwrta_vehicles", "ID Route Lat Long Speed Heading DateTime VehiclePlate", "RouteName DirectionName Destination Active ScheduleDelta SequenceId NumberOfSatelites FixStrength Mode AddressStreet AddressCity", {
        "vehicle_id": "ID string", "route": "Route string", "route_name": "RouteName string", "destination": "Destination string", "direction_name": "DirectionName string", "latitude": "Lat double",
        "longitude": "Long double", "speed": "Speed double", "heading": "Heading double", "vehicle_datetime": "DateTime string", "active": "Active boolean",
    }), _array),
    "routematch_json": (Feed("routematch_vehicles", "vehicleId latitude longitude lastUpdate", "internalVehicleId masterRouteId masterRouteShortName tripId tripDirection speed heading headingName deadhead scheduleAdherence currentPassengers", {
        "vehicle_id": "vehicleId string", "internal_vehicle_id": "internalVehicleId string", "route_id": "masterRouteId string", "route_short_name": "masterRouteShortName string", "trip_id": "tripId string",
        "trip_direction": "tripDirection string", "latitude": "latitude double", "longitude": "longitude double", "speed": "speed double", "heading": "heading double", "heading_name": "headingName string",
        "last_update": "lastUpdate string", "deadhead": "deadhead boolean", "schedule_adherence": "scheduleAdherence long", "current_passengers": "currentPassengers long",
    }), _under("data")),
    "trillium_json": (Feed("trillium_vehicles", "id lat lon lastUpdated", "name route_id route_short_name patternId speed heading headingDegrees vehicleType passengerLoad capacity", {
        "vehicle_id": "id string", "vehicle_name": "name string", "route_id": "route_id string", "route_short_name": "route_short_name string", "pattern_id": "patternId long", "latitude": "lat double", "longitude": "lon double",
        "speed": "speed double", "heading": "heading string", "heading_degrees": "headingDegrees double", "last_updated": "lastUpdated string", "vehicle_type": "vehicleType string", "passenger_load": "passengerLoad double", "capacity": "capacity long",
    }), _bare_or_under("data")),
    "swiv_json": (Feed("swiv_vehicles", "id localisation conduite", "numeroEquipement type vehiculeLoad tauxRemplissage", {
        "vehicle_id": "id string", "equipment_number": "numeroEquipement string", "vehicle_type": "type string", "vehicle_load": "vehiculeLoad string", "fill_rate": "tauxRemplissage long", "latitude": "localisation.lat double",
        "longitude": "localisation.lng double", "heading": "localisation.cap double", "route_line_id": "conduite.idLigne long", "speed": "conduite.vitesse double", "destination": "conduite.destination string",
        "delay_status": "conduite.avanceRetard string", "next_stop_name": "conduite.arretSuiv.nomCommercial string", "next_stop_eta": "conduite.arretSuiv.estimationTemps long",
    }), _bare_or_under("vehicule")),
    "vta_json": (Feed("vta_vehicles", "vehicleId lat lng", "name patternId headsignText velocity bearing lastUpdate vehicleStateId", {
        "vehicle_id": "vehicleId string", "vehicle_name": "name string", "pattern_id": "patternId long", "headsign_text": "headsignText string", "latitude": "lat double", "longitude": "lng double", "velocity": "velocity double",
        "bearing": "bearing double", "last_update": "lastUpdate string", "vehicle_state_id": "vehicleStateId long",
    }), _array),
    "passio_json": (Feed("passio_vehicles", "busId latitude longitude", "deviceId busName routeId route tripId routeBlockId calculatedCourse paxLoad totalCap outOfService created", {
        "vehicle_id": "busId string", "device_id": "deviceId long", "bus_name": "busName string", "route_id": "routeId string", "route_name": "route string", "trip_id": "tripId string", "route_block_id": "routeBlockId string",
        "latitude": "latitude double", "longitude": "longitude double", "calculated_course": "calculatedCourse double", "pax_load": "paxLoad long", "total_cap": "totalCap long", "out_of_service": "outOfService long", "created": "created string",
    }), _map_of_lists),
    "marta_json": (Feed("marta_predictions", "EVENT_TIME DESTINATION DIRECTION IS_REALTIME LINE NEXT_ARR STATION TRAIN_ID WAITING_SECONDS WAITING_TIME", "DELAY LATITUDE LONGITUDE", {
        "destination": "DESTINATION string", "direction": "DIRECTION string", "is_realtime": "IS_REALTIME boolean", "line": "LINE string", "station": "STATION string", "train_id": "TRAIN_ID string",
        "waiting_seconds": "WAITING_SECONDS long", "waiting_time": "WAITING_TIME string", "latitude": "LATITUDE double", "longitude": "LONGITUDE double",
    }), _array),
}


def records(payloads: DataFrame, decoder: str) -> DataFrame:
    """Every record of every payload, with its fields as a map, and its drift. payloads: (payload, fetched_at)."""
    feed, split = FEEDS[decoder]
    rows = payloads.select("fetched_at", F.explode(split(F.col("payload").cast("string"))).alias("record"))
    rows = rows.filter(F.startswith(F.ltrim("record"), F.lit("{")))  # elements that aren't objects
    rows = rows.withColumn("m", F.from_json("record", "map<string,string>"))
    need, known = feed.required.split(), [*feed.required.split(), *feed.optional.split()]
    keys = F.map_keys("m")
    return rows.withColumns({
        "drift_missing_required": F.array_sort(F.array_except(F.array(*map(F.lit, need)), keys)),
        "drift_extras": F.array_sort(F.array_except(keys, F.array(*map(F.lit, known)))),
    })


def drift(payloads: DataFrame, decoder: str) -> DataFrame:
    """The records that drift: missing keys make a record unusable, further ones are a warning."""
    return records(payloads, decoder).filter("size(drift_missing_required) > 0 or size(drift_extras) > 0").select("fetched_at", "drift_missing_required", "drift_extras")


def decode(payloads: DataFrame, decoder: str) -> DataFrame:
    """A payload's usable records as the rows of the decoder's table."""
    feed, _ = FEEDS[decoder]
    rows = records(payloads, decoder).filter("size(drift_missing_required) = 0")

    def field(spec: str) -> Column:
        path, kind = spec.split(" ")
        key, _, rest = path.partition(".")
        value = F.get(F.array(F.col("m")[key]), F.lit(0))
        value = F.get_json_object(value, f"$.{rest}") if rest else value
        return F.lower(value).try_cast(kind) if kind == "boolean" else true(value).try_cast(kind) if kind != "string" else value

    columns = {"feed_timestamp": F.col("fetched_at")} | {c: field(s) for c, s in feed.fields.items()}
    if decoder == "mta_lirr_json":
        stops = F.from_json(F.get_json_object(F.col("m")["details"], "$.stops"), "array<struct<code:string,stop_status:string,act_arrive_time:long,act_depart_time:long>>")
        left = F.filter(stops, lambda s: ~F.coalesce(s["stop_status"] == "DEPARTED", F.lit(False)))
        now = F.get(left, F.lit(0))
        place = F.when(now.isNotNull(), F.array_position(stops, now))
        columns |= {"current_stop_code": now["code"], "current_stop_status": now["stop_status"], "current_stop_seq": place, "act_arrive_time": now["act_arrive_time"], "act_depart_time": now["act_depart_time"]}
    if decoder == "marta_json":
        at = meridian_to_utc(F.col("m")["EVENT_TIME"], F.lit(NEW_YORK))
        late = F.regexp_extract(F.col("m")["DELAY"], r"^T?(-?\d+)S?$", 1)
        columns |= {"event_time": at, "next_arr": clock_near(F.col("m")["NEXT_ARR"], at, F.lit(NEW_YORK), ahead=True), "delay": true(late).try_cast("long")}
    return rows.select(*[c.alias(k) for k, c in columns.items()])
