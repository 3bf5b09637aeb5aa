"""The driver's tables reshaped as transit data; nothing is sampled or left out.

customer -> routes and route patterns, supplier -> stops, orders -> trips,
lineitem with orders -> schedules, events -> live records. Every shape reads
its whole tables. Odd values (missing links, short arrays, unreadable ids and
times) come from fixed rules on the keys; ``workload.oracle`` states the same
rules in SQL.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.schemas import Entity

BATCH_1 = "20240131063000"
BATCH_2 = "20240201063000"
RUN_1 = datetime(2024, 1, 31, 6, 30, tzinfo=timezone.utc)
RUN_2 = datetime(2024, 2, 1, 6, 30, tzinfo=timezone.utc)
GOLD_BATCH = "19990101043000"
CUTOFF = datetime(2024, 1, 15, 12, 0, tzinfo=timezone.utc)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(rows: DataFrame, scan: DataFrame | None = None) -> DataFrame:
    """``rows`` dealt over all cores if their ``scan`` has fewer splits: making and parsing JSON is the work here.

    Small test tables are one file of one row group; larger ones are left as they are.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    splits = (rows if scan is None else scan).rdd.getNumPartitions()
    return rows if splits >= cores else rows.repartition(cores)


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


# -- snapshot entities, raw as landed ------------------------------------


def routes(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    base = (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key = F.col("c_custkey")
    north, south = F.concat("n_name", F.lit(" North")), F.concat("n_name", F.lit(" South"))
    return base.select(
        text(key).alias("id"),
        F.concat("c_mktsegment", F.lit(" service")).alias("description"),
        F.when(key % 5 == 0, F.array(north)).otherwise(F.array(north, south)).alias("direction_destinations"),
        F.when(key % 7 == 0, F.lit(None).cast("array<string>"))
        .when(key % 5 == 0, F.array(F.lit("Outbound")))
        .otherwise(F.array(F.lit("Outbound"), F.lit("Inbound")))
        .alias("direction_names"),
        F.col("r_name").alias("fare_class"),
        (key % 2 == 0).alias("listed_route"),
        F.col("c_name").alias("long_name"),
        F.concat(F.lit("C"), text(key)).alias("short_name"),
        F.when(key % 11 == 0, F.lit("n/a")).otherwise(text("r_regionkey")).alias("agency_id"),
        F.concat(F.lit("line-"), "r_name").alias("line_id"),
    )


def route_patterns(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    base = (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "n_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("dir"))
    )
    key, way = F.col("c_custkey"), F.col("dir")
    return base.select(
        F.concat_ws("-", text(key), text(way)).alias("id"),
        F.concat_ws("/", "n_name", text(way)).alias("name"),
        way.cast("bigint").alias("direction_id"),
        ((key + way) % 3 == 0).alias("canonical"),
        F.when(way == 0, F.lit("Weekday")).alias("time_desc"),
        (key % 5).alias("typicality"),
        text(key).alias("route_id"),
        F.concat(F.lit("trip-"), text(key)).alias("rp_trip_id"),
    )


def stops(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    base = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey")
    none = F.lit(None).cast("string")
    return base.select(
        F.concat(F.lit("S"), text(key)).alias("id"),
        F.concat(F.lit("stop of "), "s_name").alias("description"),
        F.when(key % 4 != 0, F.concat(text(key), F.lit(" Main St"))).alias("address"),
        none.alias("at_street"),
        (F.lit(42.0) + (key % 1000) / F.lit(1000.0)).alias("latitude"),
        (F.lit(-71.0) - (key % 1000) / F.lit(1000.0)).alias("longitude"),
        F.col("n_name").alias("municipality"),
        (key % 4).alias("location_type"),
        F.col("s_name").alias("name"),
        (key % 3).alias("wheelchair_boarding"),
        F.when(key % 2 == 0, F.concat(F.lit("Street "), text(key))).alias("on_street"),
        text(key % 8).alias("platform_code"),
        none.alias("platform_name"),
        F.when(key % 3 != 0, F.concat(F.lit("place-"), text("s_nationkey"))).alias("parent_station_id"),
        none.alias("zone_id"),
    )


def _trip_id(key: Column) -> Column:
    return F.when(key % 30 == 0, F.concat(F.lit("ADDED-"), text(key))).otherwise(text(key))


def _trip_route() -> Column:
    shuttle = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    return F.when(shuttle, F.concat(F.lit("Shuttle-"), text("o_custkey"))).otherwise(text("o_custkey"))


def _trip_direction(key: Column) -> Column:
    return F.when(key % 41 != 0, key % 2)


def trips(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return spread(table(spark, folder, "orders")).select(
        _trip_id(key).alias("id"),
        (key % 3).alias("bikes_allowed"),
        F.when(key % 13 != 0, F.concat(F.lit("B"), text(key % 1000))).alias("block_id"),
        _trip_direction(key).alias("direction_id"),
        F.col("o_orderpriority").alias("headsign"),
        F.when(F.col("o_orderstatus") == "P", F.lit("NON_REVENUE")).otherwise(F.lit("REVENUE")).alias("revenue"),
        (key % 3).alias("wheelchair_accessible"),
        _trip_route().alias("route_id"),
        F.concat_ws("-", _trip_route(), text(key % 2)).alias("route_pattern_id"),
        F.concat(F.lit("svc-"), "o_orderstatus").alias("service_id"),
        F.concat(F.lit("shape-"), text("o_custkey")).alias("shape_id"),
    )


def _stop_times(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    minutes = 7 * F.col("l_linenumber")
    day = F.unix_timestamp(F.col("l_shipdate").cast("timestamp"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumns(
        {
            "departs": F.when(F.col("l_linenumber") != 7, day + 60 * minutes),
            "arrives": F.when(F.col("l_linenumber") != 1, day + 60 * (minutes - 1)),
        }
    )


def _schedule_id() -> Column:
    return F.concat_ws("-", *[text(f"l_{c}") for c in ("orderkey", "linenumber", "partkey", "suppkey")])


def keyed_schedules(spark: SparkSession, folder: str) -> DataFrame:
    """Silver-typed schedules with their id and ``line`` number."""
    unique = F.concat_ws("-", _schedule_id(), text("l_shipdate"))
    return silver_schedules(spark, folder, unique.alias("id"), F.col("l_linenumber").alias("line"))


def schedules(spark: SparkSession, folder: str) -> DataFrame:
    """Times as landed: ISO text with a -05:00 offset."""
    key, line = F.col("o_orderkey"), F.col("l_linenumber").cast("bigint")
    rows = spread(_stop_times(spark, folder), table(spark, folder, "lineitem"))

    def local(seconds: str) -> Column:
        shown = F.date_format(F.timestamp_seconds(F.col(seconds)), "yyyy-MM-dd'T'HH:mm:ss")
        return F.concat(shown, F.lit("-05:00"))

    return rows.select(
        _schedule_id().alias("id"),
        local("arrives").alias("arrival_time"),
        local("departs").alias("departure_time"),
        _trip_direction(key).alias("direction_id"),
        (line % 2).alias("drop_off_type"),
        (line % 3).alias("pickup_type"),
        F.when(line == 1, F.col("o_orderpriority")).alias("stop_headsign"),
        line.alias("stop_sequence"),
        (line % 2 == 0).alias("timepoint"),
        _trip_route().alias("route_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit("S"), text("l_suppkey"))).alias("stop_id"),
        _trip_id(key).alias("trip_id"),
    )


def trip_group(shape_id: str = "shape_id") -> Column:
    """Landing fan-out group of a trip: one of 25 lines."""
    customer = F.regexp_extract(shape_id, r"(\d+)$", 1).cast("bigint")
    return F.concat(F.lit("L"), text(customer % 25))


# -- silver-typed forms for the gold queries ------------------------------


def silver_schedules(spark: SparkSession, folder: str, *extra: Column) -> DataFrame:
    return _stop_times(spark, folder).select(
        *extra,
        F.timestamp_seconds("arrives").alias("arrival_time"),
        F.timestamp_seconds("departs").alias("departure_time"),
        _trip_direction(F.col("o_orderkey")).cast("int").alias("direction_id"),
        _trip_route().alias("route_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.concat(F.lit("S"), text("l_suppkey"))).alias("stop_id"),
        _trip_id(F.col("o_orderkey")).alias("trip_id"),
    )


# -- documents -------------------------------------------------------------


def records(flat: DataFrame, entity: Entity, *extra: str) -> DataFrame:
    """Flat rows as JSON:API objects (``record``); a null link has null ``data``."""
    attributes = F.struct(*entity.attributes)
    links = F.struct(
        *[
            F.struct(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("id"))).alias("data")).alias(link)
            for link, c in entity.links.items()
        ]
    )
    record = F.struct("id", attributes.alias("attributes"), links.alias("relationships"))
    return flat.select(record.alias("record"), *extra)


def documents(flat: DataFrame, entity: Entity, *extra: str) -> DataFrame:
    """One document text (``value``) per record."""
    one = records(flat, entity, *extra)
    return one.select(F.to_json(F.struct(F.array("record").alias("data"))).alias("value"), *extra)


# -- live records ------------------------------------------------------------


def _iso(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def live_records(spark: SparkSession, folder: str, events: DataFrame | None = None) -> DataFrame:
    """One JSON:API record text per event: ``endpoint, record``."""
    events = spread(table(spark, folder, "events")) if events is None else events
    key, user = F.col("event_id"), text("user_id")
    ts = F.col("ts").cast("timestamp")
    route = F.get_json_object("props", "$.k")
    zulu = F.concat(_iso(ts), F.lit("Z"))
    shifted = F.concat(_iso(ts - F.expr("interval 5 hours")), F.lit("-05:00"))
    updated = (
        F.when(key % 10 != 0, F.when(key % 17 == 0, "not-a-time")
               .when(key % 19 == 0, "")
               .when(key % 23 == 0, _iso(ts))
               .when(key % 3 == 1, shifted)
               .otherwise(zulu))
    )
    steps = route.cast("double") / F.lit(8.0)
    informed = F.array(
        F.struct(route.alias("route"), F.concat(F.lit("S"), user).alias("stop"), F.lit("").alias("trip")),
        F.struct(route.alias("route"), F.lit(None).cast("string").alias("stop"), F.lit(None).cast("string").alias("trip")),
        F.struct(F.lit("").alias("route"), F.concat(F.lit("A"), text(key % 7)).alias("stop"), F.concat(F.lit("T"), user).alias("trip")),
    )
    attributes = F.struct(
        (F.lit(42.0) + steps).alias("latitude"),
        (F.lit(-71.0) - steps).alias("longitude"),
        (key % 360).alias("bearing"),
        F.when(key % 2 == 0, F.lit("MANY_SEATS_AVAILABLE")).alias("occupancy_status"),
        F.lit("REVENUE").alias("revenue_status"),
        F.col("event_type").alias("current_status"),
        (key % 40).alias("current_stop_sequence"),
        (key % 2).alias("direction_id"),
        F.concat(F.lit("bus-"), user).alias("label"),
        F.col("value").alias("speed"),
        zulu.alias("arrival_time"),
        F.when(key % 5 != 0, zulu).alias("departure_time"),
        (key % 30).alias("stop_sequence"),
        F.when(key % 3 == 0, F.lit("On time")).alias("status"),
        F.lit("SCHEDULED").alias("schedule_relationship"),
        F.lit("DELAY").alias("effect"),
        (key % 10).alias("severity"),
        F.concat(F.lit("Delay on "), route).alias("header"),
        F.when(key % 4 == 0, F.lit("Expect delays")).alias("description"),
        F.array(F.struct(zulu.alias("start"), F.when(key % 6 == 0, zulu).alias("end"))).alias("active_period"),
        F.lit("Delays").alias("service_effect"),
        F.lit("TRAFFIC").alias("cause"),
        F.lit("ONGOING").alias("lifecycle"),
        updated.alias("updated_at"),
        F.when(key % 20 != 0, zulu).alias("created_at"),
        F.when(key % 5 != 0, informed).otherwise(F.filter(informed, lambda _: F.lit(False))).alias("informed_entity"),
    )

    def link(name: str, data: Column) -> Column:
        return F.concat(F.lit(f'"{name}":{{"data":'), data, F.lit("}"))

    def ref(value: Column) -> Column:
        return F.concat(F.lit('{"id":"'), value, F.lit('"}'))

    stop = (
        F.when(key % 6 == 0, link("stop", F.lit("null")))
        .when(
            key % 6 == 1,
            link("stop", F.concat(F.lit('[{"id":"S1-'), user, F.lit('"},{"id":""},{"id":"S2-'), user, F.lit('"}]'))),
        )
        .when(key % 6 == 2, link("stop", F.lit("[]")))
        .when(key % 6 != 3, link("stop", ref(F.concat(F.lit("S"), user))))
    )
    schedule = F.when(key % 4 == 0, F.lit('"schedule":null')).otherwise(
        link("schedule", ref(F.concat(F.lit("P"), text(key))))
    )
    links = F.concat_ws(
        ",",
        link("trip", ref(F.concat(F.lit("T"), user))),
        stop,
        link("route", ref(route)),
        link("vehicle", ref(F.concat(F.lit("V"), user))),
        schedule,
    )
    endpoint = (
        F.when(F.col("event_type").isin("click", "view"), "vehicles")
        .when(F.col("event_type").isin("purchase", "signup"), "predictions")
        .otherwise("alerts")
    )
    record = F.concat(
        F.lit('{"id":"'), text(key), F.lit('","type":"'), F.col("event_type"),
        F.lit('","attributes":'), F.to_json(attributes),
        F.lit(',"relationships":{'), links, F.lit("}}"),
    )
    return events.select(endpoint.alias("endpoint"), record.alias("record"))


def plain(rows: DataFrame) -> DataFrame:
    """Session-zone timestamps as zone-less ones, arrays as ``|``-joined text, for comparison."""
    out = []
    for f in rows.schema.fields:
        kind = f.dataType.typeName()
        if kind == "timestamp":
            out.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        elif kind == "array":
            out.append(F.array_join(f.name, "|").alias(f.name))
        else:
            out.append(F.col(f.name))
    return rows.select(*out)
