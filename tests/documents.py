"""Small hand-written snapshot documents in the landing layout."""

from __future__ import annotations

import json
from pathlib import Path


def record(id_, attributes, links=None, **more):
    relationships = {name: {"data": None if v is None else {"id": v}} for name, v in (links or {}).items()}
    return {"id": id_, "type": "x", "attributes": attributes, "relationships": {**relationships, **more}}


def land(root, entity, batch_id, data, group=None, **envelope):
    folder = Path(root) / entity / batch_id[:4] / batch_id[4:6] / batch_id[6:8]
    folder.mkdir(parents=True, exist_ok=True)
    stem = f"{entity}_{group}_{batch_id}" if group else f"{entity}_{batch_id}"
    document = {"data": data, "jsonapi": {"version": "1.0"}, **envelope}
    (folder / f"{stem}.json").write_text(json.dumps(document, indent=2))


def route(id_, long_name="Line", names=("Out", "In"), ends=("North", "South"), agency="1"):
    attributes = {
        "description": "Rapid Transit",
        "direction_names": None if names is None else list(names),
        "direction_destinations": None if ends is None else list(ends),
        "fare_class": "Rapid",
        "listed_route": True,
        "long_name": long_name,
        "short_name": "",
        "color": "DA291C",
    }
    return record(id_, attributes, {"agency": agency, "line": f"line-{id_}"})


def pattern(id_, route_id, direction=0, name="A - B"):
    attributes = {"name": name, "direction_id": direction, "canonical": False, "time_desc": None, "typicality": 1}
    return record(id_, attributes, {"route": route_id, "representative_trip": "t0"})


def stop(id_, **attributes):
    base = {"name": id_, "latitude": 42.1234567, "longitude": -71.5, "location_type": 0, "wheelchair_boarding": 1}
    return record(id_, {**base, **attributes}, {"parent_station": None, "zone": None})


def trip(id_, route_id, direction=0, pattern_id="p1", headsign="North"):
    attributes = {
        "bikes_allowed": 1,
        "block_id": "B1",
        "direction_id": direction,
        "headsign": headsign,
        "revenue": "REVENUE",
        "wheelchair_accessible": 1,
    }
    return record(id_, attributes, {"route": route_id, "route_pattern": pattern_id, "service": "s1", "shape": None})


def call(id_, trip_id, route_id, arrival, departure, direction=0, stop_id="70061", sequence=1):
    attributes = {
        "arrival_time": arrival,
        "departure_time": departure,
        "direction_id": direction,
        "drop_off_type": 0,
        "pickup_type": 0,
        "stop_headsign": None,
        "stop_sequence": sequence,
        "timepoint": True,
    }
    return record(id_, attributes, {"route": route_id, "stop": stop_id, "trip": trip_id})
