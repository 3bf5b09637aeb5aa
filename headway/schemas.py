"""Snapshot entities: landing fields, bronze columns, silver types, keys.

One ``Entity`` drives the landing schema, the bronze projection and the silver
casts, so a column is written down once.
"""

from __future__ import annotations

from dataclasses import dataclass

AUDIT_COLUMNS = ("created_ts", "updated_ts", "scd_key")
LINEAGE_COLUMN = "source_file"


@dataclass(frozen=True)
class Entity:
    name: str
    attributes: dict[str, str]
    links: dict[str, str]
    casts: dict[str, str]
    per_route: bool = False
    drop_repeats: bool = False
    split_directions: bool = False

    @property
    def bronze_keys(self) -> list[str]:
        """Per-route entities keep one row per id and file, i.e. their history."""
        return ["id", LINEAGE_COLUMN] if self.per_route else ["id"]

    @property
    def silver_keys(self) -> list[str]:
        return ["id"]

    @property
    def columns(self) -> list[str]:
        return ["id", *self.attributes, *self.links.values()]

    @property
    def record_ddl(self) -> str:
        """Explicit type of one JSON:API object; nothing is inferred."""
        attributes = ",".join(f"{name}:{kind}" for name, kind in self.attributes.items())
        links = ",".join(f"{name}:struct<data:struct<id:string>>" for name in self.links)
        return f"struct<id:string,attributes:struct<{attributes}>,relationships:struct<{links}>>"

    @property
    def document_ddl(self) -> str:
        return f"data array<{self.record_ddl}>"


# Field names, relationship names, output names and types of the
# five snapshot entities.
ROUTES = Entity(
    "routes",
    attributes={
        "description": "string",
        "direction_destinations": "array<string>",
        "direction_names": "array<string>",
        "fare_class": "string",
        "listed_route": "boolean",
        "long_name": "string",
        "short_name": "string",
    },
    links={"agency": "agency_id", "line": "line_id"},
    casts={"agency_id": "int"},
    split_directions=True,
)
ROUTE_PATTERNS = Entity(
    "route_patterns",
    attributes={
        "name": "string",
        "direction_id": "bigint",
        "canonical": "boolean",
        "time_desc": "string",
        "typicality": "bigint",
    },
    links={"route": "route_id", "representative_trip": "rp_trip_id"},
    casts={"direction_id": "int", "canonical": "boolean", "typicality": "int"},
)
STOPS = Entity(
    "stops",
    attributes={
        "description": "string",
        "address": "string",
        "at_street": "string",
        "latitude": "double",
        "longitude": "double",
        "municipality": "string",
        "location_type": "bigint",
        "name": "string",
        "wheelchair_boarding": "bigint",
        "on_street": "string",
        "platform_code": "string",
        "platform_name": "string",
    },
    links={"parent_station": "parent_station_id", "zone": "zone_id"},
    casts={
        "location_type": "int",
        "wheelchair_boarding": "int",
        "latitude": "decimal(9,6)",
        "longitude": "decimal(9,6)",
    },
)
TRIPS = Entity(
    "trips",
    attributes={
        "bikes_allowed": "bigint",
        "block_id": "string",
        "direction_id": "bigint",
        "headsign": "string",
        "revenue": "string",
        "wheelchair_accessible": "bigint",
    },
    links={
        "route": "route_id",
        "route_pattern": "route_pattern_id",
        "service": "service_id",
        "shape": "shape_id",
    },
    casts={
        "id": "bigint",
        "direction_id": "int",
        "bikes_allowed": "int",
        "wheelchair_accessible": "int",
    },
    per_route=True,
    drop_repeats=True,
)
SCHEDULES = Entity(
    "schedules",
    attributes={
        "arrival_time": "string",
        "departure_time": "string",
        "direction_id": "bigint",
        "drop_off_type": "bigint",
        "pickup_type": "bigint",
        "stop_headsign": "string",
        "stop_sequence": "bigint",
        "timepoint": "boolean",
    },
    links={"route": "route_id", "stop": "stop_id", "trip": "trip_id"},
    casts={
        "arrival_time": "timestamp",
        "departure_time": "timestamp",
        "direction_id": "int",
        "drop_off_type": "bigint",
        "pickup_type": "bigint",
        "stop_sequence": "bigint",
        "timepoint": "boolean",
    },
    per_route=True,
    drop_repeats=True,
)
ENTITIES = {e.name: e for e in (ROUTES, ROUTE_PATTERNS, STOPS, TRIPS, SCHEDULES)}

# Live endpoints, the attributes each one publishes and the
# relationships whose ids are kept.
LIVE_FIELDS: dict[str, dict[str, str]] = {
    "vehicles": {
        "latitude": "double",
        "longitude": "double",
        "bearing": "bigint",
        "occupancy_status": "string",
        "revenue_status": "string",
        "current_status": "string",
        "current_stop_sequence": "bigint",
        "direction_id": "bigint",
        "label": "string",
        "speed": "double",
        "updated_at": "string",
        "created_at": "string",
    },
    "predictions": {
        "arrival_time": "string",
        "departure_time": "string",
        "stop_sequence": "bigint",
        "direction_id": "bigint",
        "revenue_status": "string",
        "status": "string",
        "schedule_relationship": "string",
        "updated_at": "string",
        "created_at": "string",
    },
    "alerts": {
        "effect": "string",
        "severity": "bigint",
        "header": "string",
        "description": "string",
        "active_period": "array<struct<start:string,end:string>>",
        "service_effect": "string",
        "cause": "string",
        "lifecycle": "string",
        "updated_at": "string",
        "created_at": "string",
    },
}
LIVE_LINKS: dict[str, list[str]] = {
    "vehicles": ["trip", "stop", "route"],
    "predictions": ["trip", "stop", "route", "vehicle", "schedule"],
    "alerts": [],
}
ALERT_TARGETS = ("route", "stop", "trip")
