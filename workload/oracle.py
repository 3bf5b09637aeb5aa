"""SQL twins of the registered queries, for DuckDB over the same tables.

Each states the expected rows straight from the tables: upserts as a full
outer join, live records from event columns instead of their JSON.
"""

from __future__ import annotations

RUN_1 = "TIMESTAMP '2024-01-31 06:30:00'"
RUN_2 = "TIMESTAMP '2024-02-01 06:30:00'"
BATCH_1 = "20240131063000"
BATCH_2 = "20240201063000"
NEW_KEY = "1000000000"

# -- fixture shapes ------------------------------------------------------------

ROUTES = """routes AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment || ' service' AS description,
    CASE WHEN c_custkey % 5 = 0 THEN [n_name || ' North']
         ELSE [n_name || ' North', n_name || ' South'] END AS direction_destinations,
    CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN ['Outbound']
         ELSE ['Outbound', 'Inbound'] END AS direction_names,
    r_name AS fare_class, (c_custkey % 2 = 0) AS listed_route, c_name AS long_name,
    'C' || CAST(c_custkey AS VARCHAR) AS short_name,
    CASE WHEN c_custkey % 11 = 0 THEN 'n/a' ELSE CAST(r_regionkey AS VARCHAR) END AS agency_id,
    'line-' || r_name AS line_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

PATTERNS = """patterns AS (
  SELECT CAST(c_custkey AS VARCHAR) || '-' || CAST(dir AS VARCHAR) AS id,
    n_name || '/' || CAST(dir AS VARCHAR) AS name, CAST(dir AS BIGINT) AS direction_id,
    ((c_custkey + dir) % 3 = 0) AS canonical, CASE WHEN dir = 0 THEN 'Weekday' END AS time_desc,
    c_custkey % 5 AS typicality, CAST(c_custkey AS VARCHAR) AS route_id,
    'trip-' || CAST(c_custkey AS VARCHAR) AS rp_trip_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey, (VALUES (0), (1)) AS d(dir))"""

STOPS = """stops AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS id, 'stop of ' || s_name AS description,
    CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey AS VARCHAR) || ' Main St' END AS address,
    CAST(NULL AS VARCHAR) AS at_street,
    CAST(42.0 AS DOUBLE) + CAST(s_suppkey % 1000 AS DOUBLE) / 1000 AS latitude,
    CAST(-71.0 AS DOUBLE) - CAST(s_suppkey % 1000 AS DOUBLE) / 1000 AS longitude,
    n_name AS municipality, s_suppkey % 4 AS location_type, s_name AS name,
    s_suppkey % 3 AS wheelchair_boarding,
    CASE WHEN s_suppkey % 2 = 0 THEN 'Street ' || CAST(s_suppkey AS VARCHAR) END AS on_street,
    CAST(s_suppkey % 8 AS VARCHAR) AS platform_code, CAST(NULL AS VARCHAR) AS platform_name,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'place-' || CAST(s_nationkey AS VARCHAR) END AS parent_station_id,
    CAST(NULL AS VARCHAR) AS zone_id
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

_TRIP_ID = """CASE WHEN o_orderkey % 30 = 0 THEN 'ADDED-' || CAST(o_orderkey AS VARCHAR)
         ELSE CAST(o_orderkey AS VARCHAR) END"""
_TRIP_ROUTE = """CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P'
         THEN 'Shuttle-' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END"""
_TRIP_WAY = "CASE WHEN o_orderkey % 41 <> 0 THEN o_orderkey % 2 END"

TRIPS = f"""trips AS (
  SELECT {_TRIP_ID} AS id, o_orderkey % 3 AS bikes_allowed,
    CASE WHEN o_orderkey % 13 <> 0 THEN 'B' || CAST(o_orderkey % 1000 AS VARCHAR) END AS block_id,
    {_TRIP_WAY} AS direction_id, o_orderpriority AS headsign,
    CASE WHEN o_orderstatus = 'P' THEN 'NON_REVENUE' ELSE 'REVENUE' END AS revenue,
    o_orderkey % 3 AS wheelchair_accessible, {_TRIP_ROUTE} AS route_id,
    ({_TRIP_ROUTE}) || '-' || CAST(o_orderkey % 2 AS VARCHAR) AS route_pattern_id,
    'svc-' || o_orderstatus AS service_id, 'shape-' || CAST(o_custkey AS VARCHAR) AS shape_id,
    o_orderkey AS k, 'L' || CAST(o_custkey % 25 AS VARCHAR) AS line
  FROM orders)"""

SCHEDULES = f"""schedules AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
    CASE WHEN l_linenumber <> 1 THEN l_shipdate + to_minutes(7 * l_linenumber - 1) END AS arrival_time,
    CASE WHEN l_linenumber <> 7 THEN l_shipdate + to_minutes(7 * l_linenumber) END AS departure_time,
    {_TRIP_WAY} AS direction_id, CAST(l_linenumber % 2 AS BIGINT) AS drop_off_type,
    CAST(l_linenumber % 3 AS BIGINT) AS pickup_type,
    CASE WHEN l_linenumber = 1 THEN o_orderpriority END AS stop_headsign,
    CAST(l_linenumber AS BIGINT) AS stop_sequence, (l_linenumber % 2 = 0) AS timepoint,
    {_TRIP_ROUTE} AS route_id,
    CASE WHEN l_partkey % 50 <> 0 THEN 'S' || CAST(l_suppkey AS VARCHAR) END AS stop_id,
    {_TRIP_ID} AS trip_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

COLUMNS = {
    "routes": "id description direction_destinations direction_names fare_class listed_route long_name "
    "short_name agency_id line_id",
    "patterns": "id name direction_id canonical time_desc typicality route_id rp_trip_id",
    "stops": "id description address at_street latitude longitude municipality location_type name "
    "wheelchair_boarding on_street platform_code platform_name parent_station_id zone_id",
    "trips": "id bikes_allowed block_id direction_id headsign revenue wheelchair_accessible route_id "
    "route_pattern_id service_id shape_id",
    "schedules": "id arrival_time departure_time direction_id drop_off_type pickup_type stop_headsign "
    "stop_sequence timepoint route_id stop_id trip_id",
}
COLUMNS = {name: columns.split() for name, columns in COLUMNS.items()}


def _digest(columns) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)
    return f"sha256(concat_ws('_', {parts}))"


def _as_text(column: str) -> str:
    return f"'[' || array_to_string({column}, ', ') || ']'"


def _stamp(columns, relation: str, run_ts: str) -> str:
    return (
        f"SELECT {', '.join(columns)}, {run_ts} AS created_ts, {run_ts} AS updated_ts, "
        f"{_digest(columns)} AS scd_key FROM {relation}"
    )


# -- landing, bronze -----------------------------------------------------------


def _landed(shape: str, relation: str, source_file: str) -> str:
    return f"WITH {shape} SELECT {', '.join(COLUMNS[relation])}, {source_file} AS source_file FROM {relation}"


def _bronze(shape: str, relation: str, source_file: str) -> str:
    return f"""WITH {shape},
filed AS (SELECT {', '.join(COLUMNS[relation])}, {source_file} AS source_file FROM {relation})
{_stamp([*COLUMNS[relation], 'source_file'], 'filed', RUN_1)}"""


_OFFSET = "strftime({0}, '%Y-%m-%dT%H:%M:%S') || '-05:00'"


def _bronze_schedules() -> str:
    columns = COLUMNS["schedules"]
    raw = [
        f"{_OFFSET.format(c)} AS {c}" if c in ("arrival_time", "departure_time") else c for c in columns
    ]
    group = "'schedules_D' || coalesce(CAST(direction_id AS VARCHAR), '')"
    return f"""WITH {SCHEDULES},
filed AS (SELECT {', '.join(raw)}, {group} || '_{BATCH_1}.json' AS source_file FROM schedules)
{_stamp([*columns, 'source_file'], 'filed', RUN_1)}"""


_ARRAYS = ("direction_destinations", "direction_names")


def _routes_digest(columns) -> str:
    return _digest([_as_text(c) if c in _ARRAYS else c for c in columns])


def _routes_shown(columns) -> str:
    return ", ".join(f"array_to_string({c}, '|') AS {c}" if c in _ARRAYS else c for c in columns)


def _bronze_routes() -> str:
    columns = [*COLUMNS["routes"], "source_file"]
    return f"""WITH {ROUTES},
filed AS (SELECT *, 'routes_{BATCH_1}.json' AS source_file FROM routes)
SELECT {_routes_shown(columns)}, {RUN_1} AS created_ts, {RUN_1} AS updated_ts,
  {_routes_digest(columns)} AS scd_key FROM filed"""


def _merged(columns, keys) -> str:
    """``t`` and ``s`` (stamped) merged: one full outer join, one choice per column."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    hit, there = "s.scd_key <> t.scd_key", "t.scd_key IS NOT NULL"
    parts = []
    for c in columns:
        if c in keys:
            parts.append(f"CASE WHEN {there} THEN t.{c} ELSE s.{c} END AS {c}")
        else:
            parts.append(f"CASE WHEN {there} AND (s.scd_key IS NULL OR NOT ({hit})) THEN t.{c} ELSE s.{c} END AS {c}")
    for c, changes in (("created_ts", False), ("updated_ts", True), ("scd_key", True)):
        test = f"{there} AND (s.scd_key IS NULL OR NOT ({hit}))" if changes else there
        parts.append(f"CASE WHEN {test} THEN t.{c} ELSE s.{c} END AS {c}")
    return f"SELECT {', '.join(parts)} FROM t FULL OUTER JOIN s ON {on}"


def _bronze_incremental() -> str:
    columns = [*COLUMNS["routes"], "source_file"]
    second = []
    for c in columns:
        if c == "fare_class":
            c = "CASE WHEN CAST(id AS BIGINT) % 7 = 0 THEN 'Free' ELSE fare_class END AS fare_class"
        elif c == "id":
            c = "CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN 'N' || id ELSE id END AS id"
        elif c == "source_file":
            c = f"'routes_{BATCH_2}.json' AS source_file"
        second.append(c)
    return f"""WITH {ROUTES},
one AS (SELECT *, 'routes_{BATCH_1}.json' AS source_file FROM routes),
two AS (SELECT {', '.join(second)} FROM routes),
t AS (SELECT *, {RUN_1} AS created_ts, {RUN_1} AS updated_ts, {_routes_digest(columns)} AS scd_key FROM one),
s AS (SELECT *, {RUN_2} AS created_ts, {RUN_2} AS updated_ts, {_routes_digest(columns)} AS scd_key FROM two),
m AS ({_merged(columns, ['id'])})
SELECT {_routes_shown([*columns, 'created_ts', 'updated_ts', 'scd_key'])} FROM m"""


# -- silver --------------------------------------------------------------------

_CASTS = {
    "schedules": {"direction_id": "INTEGER"},
    "trips": {
        "id": "BIGINT",
        "direction_id": "INTEGER",
        "bikes_allowed": "INTEGER",
        "wheelchair_accessible": "INTEGER",
    },
    "stops": {
        "location_type": "INTEGER",
        "wheelchair_boarding": "INTEGER",
        "latitude": "DECIMAL(9,6)",
        "longitude": "DECIMAL(9,6)",
    },
    "patterns": {"direction_id": "INTEGER", "typicality": "INTEGER"},
}


def _typed(relation: str) -> str:
    casts = _CASTS[relation]
    parts = []
    for c in COLUMNS[relation]:
        if relation == "schedules" and c in ("arrival_time", "departure_time"):
            parts.append(f"{c} + INTERVAL 5 HOUR AS {c}")
        elif c in casts:
            parts.append(f"TRY_CAST({c} AS {casts[c]}) AS {c}")
        else:
            parts.append(c)
    return ", ".join(parts)


def _silver(shape: str, relation: str) -> str:
    return f"""WITH {shape}, typed AS (SELECT {_typed(relation)} FROM {relation})
{_stamp(COLUMNS[relation], 'typed', RUN_1)}"""


SILVER_ROUTES = """silver_routes AS (
  SELECT id, description, fare_class, listed_route, long_name, short_name,
    TRY_CAST(agency_id AS INTEGER) AS agency_id, line_id,
    direction_names[1] AS direction_name_1, direction_names[2] AS direction_name_2,
    direction_destinations[1] AS direction_destination_1,
    direction_destinations[2] AS direction_destination_2
  FROM routes)"""
_SILVER_ROUTE_COLUMNS = (
    "id description fare_class listed_route long_name short_name agency_id line_id direction_name_1 "
    "direction_name_2 direction_destination_1 direction_destination_2"
).split()


def _silver_incremental() -> str:
    columns = COLUMNS["trips"]
    second = []
    for c in columns:
        if c == "headsign":
            c = "CASE WHEN k % 7 = 0 THEN 'Detour' ELSE headsign END AS headsign"
        elif c == "id":
            c = f"CASE WHEN k % 3 = 1 THEN CAST(k + {NEW_KEY} AS VARCHAR) ELSE id END AS id"
        second.append(c)
    return f"""WITH {TRIPS},
two AS (SELECT {', '.join(second)} FROM trips),
typed_1 AS (SELECT {_typed('trips')} FROM trips),
typed_2 AS (SELECT {_typed('trips')} FROM two),
t AS ({_stamp(columns, 'typed_1', RUN_1)}),
s AS ({_stamp(columns, 'typed_2', RUN_2)})
{_merged(columns, ['id'])}"""


# -- columns and upserts -------------------------------------------------------

ORDERS = """rows_in AS (
  SELECT o_orderkey AS id, o_orderstatus AS status,
    CASE WHEN o_orderkey % 9 <> 0 THEN o_orderpriority END AS priority,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderdate AS ordered_at
  FROM orders)"""
_ORDER_COLUMNS = ["id", "status", "priority", "cents"]
_ARRIVING = f"""CASE WHEN id % 3 = 0 THEN id + {NEW_KEY} ELSE id END AS id, status, priority,
    CASE WHEN id % 7 = 0 THEN cents + 1 ELSE cents END AS cents"""


def _scd1_merge(no_key: bool) -> str:
    some = "CASE WHEN id % 50 <> 0 THEN id END AS id" if no_key else "id"
    return f"""WITH {ORDERS},
two AS (SELECT {_ARRIVING} FROM rows_in),
in_1 AS (SELECT {some}, status, priority, cents FROM rows_in),
in_2 AS (SELECT {some}, status, priority, cents FROM two),
t AS ({_stamp(_ORDER_COLUMNS, 'in_1', RUN_1)}),
s AS ({_stamp(_ORDER_COLUMNS, 'in_2', RUN_2)})
{_merged(_ORDER_COLUMNS, ['id'])}"""


def _scd1_merge_composite() -> str:
    columns = [*_ORDER_COLUMNS, "source_file"]
    file = "CASE WHEN cents % 2 = 0 THEN '{0}' ELSE 'orders_A.json' END AS source_file"
    return f"""WITH {ORDERS},
two AS (SELECT {_ARRIVING} FROM rows_in),
in_1 AS (SELECT id, status, priority, cents, {file.format('orders_A.json')} FROM rows_in),
in_2 AS (SELECT id, status, priority, cents, {file.format('orders_B.json')} FROM two),
t AS ({_stamp(columns, 'in_1', RUN_1)}),
s AS ({_stamp(columns, 'in_2', RUN_2)})
{_merged(columns, ['id', 'source_file'])}"""


# -- gold ----------------------------------------------------------------------

ROLLUP = """rollup_rows AS (
  SELECT trip_id, route_id, CAST(direction_id AS INTEGER) AS direction_id,
    min(departure_time) AS departure_time, max(arrival_time) AS arrival_time, count(stop_id) AS num_stops,
    (floor(epoch(max(arrival_time))) - floor(epoch(min(departure_time)))) / 60 AS duration_minutes
  FROM schedules GROUP BY trip_id, route_id, direction_id)"""
TYPED_TRIPS = f"typed_trips AS (SELECT {_typed('trips')} FROM trips)"
_J1 = "LEFT JOIN silver_routes r ON s.route_id = r.id"
_J2 = """LEFT JOIN typed_trips t ON TRY_CAST(s.trip_id AS BIGINT) = t.id AND s.route_id = t.route_id
    AND s.direction_id = t.direction_id"""
_J3 = """LEFT JOIN patterns p ON t.direction_id = p.direction_id AND t.route_id = p.route_id
    AND t.route_pattern_id = p.id"""
FACTS = f"""{ROUTES}, {SILVER_ROUTES}, {PATTERNS}, {TRIPS}, {TYPED_TRIPS}, {SCHEDULES}, {ROLLUP},
facts AS (
  SELECT CAST(s.departure_time AS DATE) AS service_date, s.trip_id, s.route_id, s.direction_id,
    s.departure_time, s.arrival_time, p.name AS route_pattern_name, p.time_desc AS route_pattern_time_desc,
    t.headsign AS trip_headsign, r.long_name AS route_long_name, r.fare_class AS route_fare_class,
    CASE WHEN s.direction_id = 0 THEN r.direction_destination_1
         ELSE r.direction_destination_2 END AS direction_destination,
    s.num_stops, s.duration_minutes
  FROM rollup_rows s {_J1} {_J2} {_J3})"""
_SIDES = "SELECT s.trip_id, s.route_id, s.direction_id"

# -- live records --------------------------------------------------------------

_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"
LIVE = f"""base AS (SELECT *, regexp_extract(props, '([0-9]+)', 1) AS route, {_ISO} || 'Z' AS zulu,
    CAST(user_id AS VARCHAR) AS u FROM events),
live AS (
  SELECT *, CAST(event_id AS VARCHAR) AS record_id, event_type AS record_type,
    CASE WHEN event_type IN ('click', 'view') THEN 'vehicles'
         WHEN event_type IN ('purchase', 'signup') THEN 'predictions' ELSE 'alerts' END AS endpoint,
    CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 17 = 0 THEN 'not-a-time'
         WHEN event_id % 19 = 0 THEN '' WHEN event_id % 23 = 0 THEN {_ISO}
         WHEN event_id % 3 = 1 THEN strftime(ts - INTERVAL 5 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '-05:00'
         ELSE zulu END AS updated_at,
    CASE WHEN event_id % 20 <> 0 THEN zulu END AS created_at,
    CASE WHEN event_id % 20 = 0 THEN FALSE WHEN event_id % 10 = 0 THEN TRUE
         WHEN event_id % 17 = 0 THEN FALSE WHEN event_id % 19 = 0 THEN TRUE
         WHEN event_id % 23 = 0 THEN FALSE ELSE TRUE END AS dated,
    'T' || u AS trip_id, CASE WHEN event_id % 6 IN (4, 5) THEN 'S' || u END AS stop_id,
    CASE WHEN event_id % 6 = 1 THEN 'S1-' || u || '|S2-' || u END AS stop_ids,
    'V' || u AS vehicle_id,
    CASE WHEN event_id % 4 <> 0 THEN 'P' || CAST(event_id AS VARCHAR) END AS schedule_id
  FROM base),
wanted AS (
  SELECT *, CASE WHEN endpoint = 'predictions' THEN route END AS filter_route FROM live
  WHERE endpoint <> 'predictions' OR route IN ('9', '58', '84'))"""
_CUT = "TIMESTAMP '2024-01-15 12:00:00'"
_NEWS = f"(NOT dated OR ts > {_CUT})"
_NONE = "CAST(NULL AS VARCHAR)"
_SEEN = "SELECT endpoint, record_id, filter_route FROM wanted"
_STEPS = "CAST(route AS DOUBLE) / 8"


def _messages(where: str) -> str:
    car, tip, bad = (f"endpoint = '{e}'" for e in ("vehicles", "predictions", "alerts"))
    alert_stop = "'A' || CAST(event_id % 7 AS VARCHAR) || '|S' || u"
    return f"""WITH {LIVE}
SELECT endpoint AS topic, record_id AS key, 'transit-v3' AS source, '/' || endpoint AS endpoint, record_type,
  record_id, filter_route, '2024-02-01T06:30:00+00:00' AS polled_at_utc,
  CASE WHEN {car} THEN 'bus-' || u END AS label, CASE WHEN {car} THEN value END AS speed,
  CASE WHEN {bad} THEN event_id % 10 END AS severity, CASE WHEN {tip} THEN zulu END AS arrival_time,
  updated_at, CASE WHEN NOT ({bad}) THEN trip_id END AS trip_id,
  CASE WHEN NOT ({bad}) THEN stop_id END AS stop_id,
  CASE WHEN NOT ({bad}) THEN stop_ids WHEN event_id % 5 <> 0 THEN {alert_stop} END AS stop_ids,
  CASE WHEN NOT ({bad}) THEN route END AS route_id,
  CASE WHEN {bad} AND event_id % 5 <> 0 THEN route END AS route_ids,
  CASE WHEN {tip} THEN vehicle_id END AS vehicle_id, CASE WHEN {tip} THEN schedule_id END AS schedule_id
FROM wanted WHERE {where}"""


# A feed stamped by the day: poll k holds the events whose id leaves at most k, divided by 3.
_DAILY = f"""WITH events AS (SELECT * REPLACE (CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts) FROM main.events), {LIVE},
polls AS (SELECT unnest([0, 1, 2]) AS poll),
cuts AS (
  SELECT poll, endpoint, max(ts) - INTERVAL 1 SECOND AS cut FROM polls JOIN wanted ON event_id % 3 < poll
  WHERE dated GROUP BY poll, endpoint),
seen AS (
  SELECT p.poll, w.*, (NOT w.dated OR c.cut IS NULL OR (w.ts > c.cut AND w.event_id % 3 = p.poll)) AS news
  FROM polls p JOIN wanted w ON w.event_id % 3 <= p.poll
  LEFT JOIN cuts c ON c.poll = p.poll AND c.endpoint = w.endpoint)"""
_EVENT = "CAST(event_id AS VARCHAR)"


def statements() -> dict[str, str]:
    return {
        "landing_scan": _landed(STOPS, "stops", f"'stops_{BATCH_1}.json'"),
        "landing_glob_scan": _landed(TRIPS, "trips", f"'trips_' || line || '_{BATCH_1}.json'"),
        "page_concat": """SELECT event_id AS page_id, CAST(event_id AS VARCHAR) AS record_id FROM events
WHERE event_id % 4 IN (0, 1)
UNION ALL SELECT event_id, CAST(event_id AS VARCHAR) || '-b' FROM events WHERE event_id % 4 = 0""",
        "batch_id_parts": """SELECT o_orderkey,
  'trips_Red_' || strftime(o_orderdate, '%Y%m%d') || '063000.json' AS source_file,
  strftime(o_orderdate, '%Y%m%d') || '063000' AS batch_id, strftime(o_orderdate, '%Y') AS year,
  strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day,
  o_orderdate + INTERVAL 390 MINUTE AS batch_ts,
  CAST(o_orderdate - INTERVAL 1 DAY AS DATE) AS window_start FROM orders""",
        "batch_filter": """SELECT o_orderkey, 'trips_Red_19970501000000.json' AS source_file FROM orders
WHERE o_orderdate >= DATE '1997-05-01' AND o_orderdate < DATE '1997-06-01'""",
        "bronze_routes": _bronze_routes(),
        "bronze_route_patterns": _bronze(PATTERNS, "patterns", f"'route_patterns_{BATCH_1}.json'"),
        "bronze_stops": _bronze(STOPS, "stops", f"'stops_{BATCH_1}.json'"),
        "bronze_trips": _bronze(TRIPS, "trips", f"'trips_' || line || '_{BATCH_1}.json'"),
        "bronze_schedules": _bronze_schedules(),
        "bronze_incremental": _bronze_incremental(),
        "audit_columns": f"WITH {ORDERS} SELECT *, {RUN_1} AS created_ts, {RUN_1} AS updated_ts FROM rows_in",
        "scd_hash": f"""WITH {ORDERS}
SELECT id, {_digest([*_ORDER_COLUMNS, 'ordered_at'])} AS scd_key FROM rows_in""",
        "distinct_rows": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
        "silver_routes": f"""WITH {ROUTES}, {SILVER_ROUTES}
{_stamp(_SILVER_ROUTE_COLUMNS, 'silver_routes', RUN_1)}""",
        "silver_route_patterns": _silver(PATTERNS, "patterns"),
        "silver_stops": _silver(STOPS, "stops"),
        "silver_trips": _silver(TRIPS, "trips"),
        "silver_schedules": _silver(SCHEDULES, "schedules"),
        "silver_incremental": _silver_incremental(),
        "scd1_merge": _scd1_merge(no_key=True),
        "scd1_merge_composite": _scd1_merge_composite(),
        "scd1_merge_idempotent": _scd1_merge(no_key=False),
        "schedule_rollup": f"WITH {SCHEDULES}, {ROLLUP} SELECT * FROM rollup_rows",
        "join_left_routes": f"""WITH {ROUTES}, {SILVER_ROUTES}, {SCHEDULES}, {ROLLUP}
{_SIDES}, r.long_name AS route_long_name, r.fare_class AS route_fare_class FROM rollup_rows s {_J1}""",
        "join_left_trips": f"""WITH {TRIPS}, {TYPED_TRIPS}, {SCHEDULES}, {ROLLUP}
{_SIDES}, t.route_pattern_id AS trip_pattern_id, t.headsign AS trip_headsign FROM rollup_rows s {_J2}""",
        "join_left_patterns": f"""WITH {PATTERNS}, {TRIPS}, {TYPED_TRIPS}, {SCHEDULES}, {ROLLUP}
{_SIDES}, p.name AS route_pattern_name, p.time_desc AS route_pattern_time_desc
FROM rollup_rows s {_J2} {_J3}""",
        "trips_metrics": f"WITH {FACTS} SELECT * FROM facts",
        "trips_metrics_audited": f"""WITH {FACTS}
SELECT *, {RUN_1} AS created_ts, {RUN_1} AS updated_ts FROM facts""",
        "gold_incremental": f"""WITH {FACTS}
SELECT *, {RUN_2} AS created_ts, {RUN_2} AS updated_ts FROM facts WHERE service_date >= DATE '1998-12-31'""",
        "gold_replace_where": f"""WITH {FACTS}
SELECT * REPLACE (CASE WHEN service_date >= DATE '1998-12-31' THEN num_stops ELSE num_stops + 1 END AS num_stops),
  CASE WHEN service_date >= DATE '1998-12-31' THEN {RUN_2} END AS created_ts,
  CASE WHEN service_date >= DATE '1998-12-31' THEN {RUN_2} END AS updated_ts FROM facts""",
        "gold_overwrite_where": f"""WITH {FACTS}
SELECT * REPLACE (CASE WHEN service_date >= DATE '1998-12-31' THEN num_stops ELSE num_stops + 1 END AS num_stops)
FROM facts""",
        "gold_rollup_batches": f"""WITH {SCHEDULES.replace('schedules AS', 'landed AS', 1)},
schedules AS (SELECT * REPLACE (
    CASE stop_sequence WHEN 1 THEN departure_time + INTERVAL 30 DAY WHEN 3 THEN departure_time - INTERVAL 2 DAY
      ELSE departure_time END AS departure_time,
    CASE WHEN stop_sequence = 4 THEN 1 - direction_id ELSE direction_id END AS direction_id) FROM landed),
{ROLLUP} SELECT * FROM rollup_rows""",
        "batch_marker": f"""WITH {TRIPS} SELECT id, wheelchair_accessible,
  'trips_' || line || '_{BATCH_2}.json' AS source_file FROM trips WHERE wheelchair_accessible = 1""",
        "route_filter": f"WITH {LIVE} {_SEEN}",
        "incremental_filter": f"WITH {LIVE} {_SEEN} WHERE endpoint = 'predictions' OR {_NEWS}",
        "full_backfill": f"WITH {LIVE} {_SEEN}",
        "flatten_vehicles": f"""WITH {LIVE} SELECT record_id, 42 + {_STEPS} AS latitude, -71 - {_STEPS} AS longitude,
  event_id % 360 AS bearing, CASE WHEN event_id % 2 = 0 THEN 'MANY_SEATS_AVAILABLE' END AS occupancy_status,
  'REVENUE' AS revenue_status, event_type AS current_status, event_id % 40 AS current_stop_sequence,
  event_id % 2 AS direction_id, 'bus-' || u AS label, value AS speed, updated_at, created_at,
  trip_id, {_NONE} AS trip_ids, stop_id, stop_ids, route AS route_id, {_NONE} AS route_ids
FROM live WHERE endpoint = 'vehicles'""",
        "flatten_predictions": f"""WITH {LIVE} SELECT record_id, zulu AS arrival_time,
  CASE WHEN event_id % 5 <> 0 THEN zulu END AS departure_time, event_id % 30 AS stop_sequence,
  event_id % 2 AS direction_id, 'REVENUE' AS revenue_status,
  CASE WHEN event_id % 3 = 0 THEN 'On time' END AS status, 'SCHEDULED' AS schedule_relationship,
  updated_at, created_at, trip_id, {_NONE} AS trip_ids, stop_id, stop_ids, route AS route_id,
  {_NONE} AS route_ids, vehicle_id, {_NONE} AS vehicle_ids, schedule_id, {_NONE} AS schedule_ids
FROM live WHERE endpoint = 'predictions'""",
        "flatten_alerts": f"""WITH {LIVE} SELECT record_id, 'DELAY' AS effect, event_id % 10 AS severity,
  'Delay on ' || route AS header, CASE WHEN event_id % 4 = 0 THEN 'Expect delays' END AS description,
  CASE WHEN event_id % 6 = 0 THEN zulu || '/' || zulu ELSE zulu END AS active_period,
  'Delays' AS service_effect, 'TRAFFIC' AS cause, 'ONGOING' AS lifecycle, updated_at, created_at,
  CASE WHEN event_id % 5 <> 0 THEN route END AS route_ids,
  CASE WHEN event_id % 5 <> 0 THEN 'A' || CAST(event_id % 7 AS VARCHAR) || '|S' || u END AS stop_ids,
  CASE WHEN event_id % 5 <> 0 THEN 'T' || u END AS trip_ids
FROM live WHERE endpoint = 'alerts'""",
        "relationship_ids": f"""WITH {LIVE} SELECT endpoint, record_id,
  CASE WHEN endpoint <> 'alerts' THEN stop_id END AS stop_id,
  CASE WHEN endpoint <> 'alerts' THEN stop_ids
       WHEN event_id % 5 <> 0 THEN 'A' || CAST(event_id % 7 AS VARCHAR) || '|S' || u END AS stop_ids,
  CASE WHEN endpoint = 'predictions' THEN schedule_id END AS schedule_id, {_NONE} AS schedule_ids
FROM live""",
        "envelope": _messages(_NEWS),
        "poll_counters": f"""WITH {LIVE} SELECT endpoint, filter_route, count(*) AS fetched,
  count(*) FILTER (WHERE {_NEWS}) AS sent, count(*) FILTER (WHERE NOT {_NEWS}) AS filtered_out
FROM wanted GROUP BY endpoint, filter_route""",
        "stream_envelope": _messages("TRUE"),
        "stream_incremental": f"""WITH {LIVE}
SELECT 0 AS poll, endpoint AS topic, record_id AS key, filter_route FROM wanted
UNION ALL SELECT 1, endpoint, record_id, filter_route FROM wanted WHERE {_NEWS}""",
        "stream_boundary": f"{_DAILY} SELECT poll, endpoint AS topic, record_id AS key FROM seen WHERE news",
        "poll_run_counters": f"""{_DAILY} SELECT poll, endpoint, filter_route, count(*) AS fetched,
  count(*) FILTER (WHERE news) AS sent, count(*) FILTER (WHERE NOT news) AS filtered_out, CAST(0 AS BIGINT) AS rejected
FROM seen GROUP BY poll, endpoint, filter_route""",
        "dead_letters": f"""SELECT 'vehicles' AS endpoint,
  CASE WHEN event_id % 6 = 1 THEN 'no id' ELSE 'no JSON object' END AS reason,
  CASE event_id % 6 WHEN 0 THEN '{{"id":"' || {_EVENT} || '","attrib'
    WHEN 1 THEN '{{"type":"vehicle","attributes":{{"label":"' || {_EVENT} || '"}}}}'
    WHEN 2 THEN '[' || {_EVENT} || ']' WHEN 3 THEN 'line ' || {_EVENT} ELSE {_EVENT} END AS text
FROM events WHERE event_id % 6 <> 5""",
        "undeclared_values": f"""WITH kinds AS (SELECT *, event_type IN ('click', 'view') AS vehicle FROM events)
SELECT CASE WHEN vehicle THEN 'vehicles' ELSE 'alerts' END AS topic, {_EVENT} AS key,
  CASE WHEN vehicle THEN CASE event_id % 4 WHEN 0 THEN '7.25' WHEN 1 THEN 'fast ' || {_EVENT} WHEN 2 THEN 'true' END END AS speed,
  CASE WHEN NOT vehicle THEN CASE event_id % 3 WHEN 0 THEN '3' WHEN 1 THEN '3.5' ELSE 'high' END END AS severity,
  CASE WHEN NOT vehicle THEN CASE WHEN event_id % 2 = 0 THEN '{{"en":["' || {_EVENT} || '",1]}}' ELSE {_EVENT} END END AS header,
  vehicle AND event_id % 4 = 3 AS null_speed FROM kinds""",
        "stream_route_table": f"""WITH {LIVE}, polls AS (SELECT * FROM (VALUES (0, 2), (1, 3)) t(poll, every))
SELECT poll, endpoint AS topic, record_id AS key, CASE WHEN endpoint = 'predictions' THEN route END AS filter_route
FROM live, polls WHERE endpoint <> 'predictions' OR route IN (
  SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % every = 0)""",
    }
