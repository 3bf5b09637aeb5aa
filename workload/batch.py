"""Registered queries over snapshots: landing, bronze, silver, upserts, gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.batch_ids import batch_id_in, batch_id_of, day_parts, window_start
from headway.operators.live import landed_records, parse
from headway.operators.replace_window import from_day_by_month, overwrite_where, replace_where
from headway.operators.shape import cast_columns, clean, flatten_documents, in_batch, stamp
from headway.operators.trip_facts import (
    on_or_after,
    rollup_schedules,
    trip_facts,
    trips_with_patterns,
    with_duration,
    with_routes,
    with_trips,
)
from headway.operators.upsert import upsert
from headway.plans.layers import Lake
from headway.plans.rollup import merge_schedules, rebuild
from headway.plans.snapshots import bronze_rows, gold_window, silver_rows
from headway.schemas import ROUTE_PATTERNS, ROUTES, SCHEDULES, STOPS, TRIPS, Entity
from headway.sources.files import Staging, fresh_folder
from headway.sources.landing import parse_documents, read_batch, write_documents, write_grouped
from headway.sources.layer import LayerTable, Partitioning, key_buckets
from headway.sources.state import load_batch_id, save_batch_id
from workload import fixtures as X

NEW_KEY = 1_000_000_000
PAGE_SIZE = 100


# -- landing -----------------------------------------------------------------


def landing_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_folder(spark, "landing")
    flat = X.stops(spark, folder).withColumn("key", F.substring("id", 2, 20).cast("bigint"))
    flat = flat.withColumn("page", F.floor(F.col("key") / PAGE_SIZE))
    # A page holds at most PAGE_SIZE records, as the feed's own pages do.
    pages = X.records(flat, STOPS, "page").groupBy("page").agg(F.collect_list("record").alias("data"))
    write_documents(pages.select("page", F.to_json(F.struct("data")).alias("value")), root, "stops", X.BATCH_1)
    return X.plain(flatten_documents(read_batch(spark, root, STOPS, X.BATCH_1), STOPS))


def landing_glob_scan(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_folder(spark, "landing")
    flat = X.trips(spark, folder).withColumn("group", X.trip_group())
    write_grouped(X.documents(flat, TRIPS, "group"), root, "trips", X.BATCH_1)
    return X.plain(flatten_documents(read_batch(spark, root, TRIPS, X.BATCH_1, lines=True), TRIPS))


def page_concat(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id")
    first = F.concat(F.lit('{"id":"'), X.text(key), F.lit('"}'))
    second = F.concat(F.lit('{"id":"'), X.text(key), F.lit('-b"}'))
    page = (
        F.when(key % 4 == 0, F.concat(F.lit('{"data":['), first, F.lit(","), second, F.lit("]}")))
        .when(key % 4 == 1, F.concat(F.lit('{"data":'), first, F.lit("}")))
        .when(key % 4 == 2, F.lit('{"data":null}'))
        .otherwise(F.lit('{"links":{}}'))
    )
    pages = X.table(spark, folder, "events").select(key.alias("page_id"), page.alias("page"))
    # The poll's own reading of landed lines.
    records = parse(landed_records(pages, "page").withColumn("endpoint", F.lit("vehicles")))
    return records.select("page_id", F.col("id").alias("record_id"))


def batch_marker(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches land, each after its marker; the marker read back says which one to read."""
    root = fresh_folder(spark, "marker")
    for batch_id, half in ((X.BATCH_1, 0), (X.BATCH_2, 1)):
        save_batch_id(spark, root, batch_id)
        flat = X.trips(spark, folder).where(F.col("wheelchair_accessible") % 2 == half).withColumn("group", X.trip_group())
        write_grouped(X.documents(flat, TRIPS, "group"), root, "trips", load_batch_id(spark, root))
    documents = read_batch(spark, root, TRIPS, load_batch_id(spark, root), lines=True)
    return flatten_documents(documents, TRIPS).select("id", "wheelchair_accessible", "source_file")


def batch_id_parts(spark: SparkSession, folder: str) -> DataFrame:
    orders = X.table(spark, folder, "orders").select(
        "o_orderkey", batch_id_of(F.col("o_orderdate") + F.expr("interval 6 hours 30 minutes")).alias("made")
    )
    files = orders.select("o_orderkey", F.concat(F.lit("trips_Red_"), "made", F.lit(".json")).alias("source_file"))
    batches = files.withColumn("batch_id", batch_id_in(F.col("source_file")))
    return X.plain(batches.withColumns(day_parts(F.col("batch_id"))))


def batch_filter(spark: SparkSession, folder: str) -> DataFrame:
    orders = X.table(spark, folder, "orders")
    made = batch_id_of(F.date_trunc("month", "o_orderdate"))
    files = orders.select("o_orderkey", F.concat(F.lit("trips_Red_"), made, F.lit(".json")).alias("source_file"))
    return in_batch(files, "19970501000000")


# -- bronze ------------------------------------------------------------------


def _bronze(flat: DataFrame, entity: Entity, batch_id: str = X.BATCH_1, run_ts=X.RUN_1) -> DataFrame:
    """Bronze rows from document texts, one document per record."""
    if entity.per_route:
        source = F.concat(F.lit(f"{entity.name}_"), "group", F.lit(f"_{batch_id}.json"))
        texts = X.documents(flat, entity, "group")
    else:
        source = F.lit(f"{entity.name}_{batch_id}.json")
        texts = X.documents(flat, entity)
    texts = texts.select("value", source.alias("source_file"))
    return bronze_rows(parse_documents(texts, entity), entity, batch_id, run_ts)


def bronze_routes(spark, folder):
    return X.plain(_bronze(X.routes(spark, folder), ROUTES))


def bronze_route_patterns(spark, folder):
    return X.plain(_bronze(X.route_patterns(spark, folder), ROUTE_PATTERNS))


def bronze_stops(spark, folder):
    return X.plain(_bronze(X.stops(spark, folder), STOPS))


def bronze_trips(spark, folder):
    return X.plain(_bronze(X.trips(spark, folder).withColumn("group", X.trip_group()), TRIPS))


def bronze_schedules(spark, folder):
    flat = X.schedules(spark, folder).withColumn("group", F.concat(F.lit("D"), X.text("direction_id")))
    flat = flat.withColumn("group", F.coalesce("group", F.lit("D")))
    return X.plain(_bronze(flat, SCHEDULES))


def bronze_incremental(spark, folder):
    first = X.routes(spark, folder)
    key = F.col("id").cast("bigint")
    second = first.withColumns(
        {
            "fare_class": F.when(key % 7 == 0, F.lit("Free")).otherwise(F.col("fare_class")),
            "id": F.when(key % 3 == 0, F.concat(F.lit("N"), "id")).otherwise(F.col("id")),
        }
    )
    table = LayerTable(spark, fresh_folder(spark, "bronze"))
    table.overwrite(_bronze(first, ROUTES))
    table.upsert(_bronze(second, ROUTES, X.BATCH_2, X.RUN_2), ROUTES.bronze_keys)
    return X.plain(table.read())


# -- columns -----------------------------------------------------------------


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return X.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("priority"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
    )


def audit_columns(spark, folder):
    return X.plain(stamp(_orders(spark, folder), X.RUN_1))


def scd_hash(spark, folder):
    return stamp(_orders(spark, folder), X.RUN_1, digest=True).select("id", "scd_key")


def distinct_rows(spark, folder):
    return X.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()


# -- silver ------------------------------------------------------------------


def _as_bronze(flat: DataFrame, name: str, batch_id: str = X.BATCH_1, run_ts=X.RUN_1) -> DataFrame:
    return stamp(flat.withColumn("source_file", F.lit(f"{name}_{batch_id}.json")), run_ts, digest=True)


def _delivered_twice(flat: DataFrame, name: str) -> DataFrame:
    """Every record in the documents of two routes, as shared trips are."""
    return _as_bronze(flat, f"{name}_A").unionByName(_as_bronze(flat, f"{name}_B"))


def silver_routes(spark, folder):
    return X.plain(silver_rows(_as_bronze(X.routes(spark, folder), "routes"), ROUTES, X.RUN_1))


def silver_route_patterns(spark, folder):
    bronze = _as_bronze(X.route_patterns(spark, folder), "route_patterns")
    return X.plain(silver_rows(bronze, ROUTE_PATTERNS, X.RUN_1))


def silver_stops(spark, folder):
    return X.plain(silver_rows(_as_bronze(X.stops(spark, folder), "stops"), STOPS, X.RUN_1))


def silver_trips(spark, folder):
    return X.plain(silver_rows(_delivered_twice(X.trips(spark, folder), "trips"), TRIPS, X.RUN_1))


def silver_schedules(spark, folder):
    return X.plain(silver_rows(_delivered_twice(X.schedules(spark, folder), "schedules"), SCHEDULES, X.RUN_1))


def _second_trips(first: DataFrame) -> DataFrame:
    key = F.regexp_extract("id", r"(\d+)$", 1).cast("bigint")
    return first.withColumns(
        {
            "headsign": F.when(key % 7 == 0, F.lit("Detour")).otherwise(F.col("headsign")),
            "id": F.when(key % 3 == 1, X.text(key + NEW_KEY)).otherwise(F.col("id")),
        }
    )


def silver_incremental(spark, folder):
    """Bronze holds two batches; silver has the first and merges the second."""
    first = X.trips(spark, folder)
    bronze = _as_bronze(first, "trips_A").unionByName(
        _as_bronze(_second_trips(first), "trips_A", X.BATCH_2, X.RUN_2)
    )
    table = LayerTable(spark, fresh_folder(spark, "silver"), key_buckets("id", 4))
    table.overwrite(silver_rows(in_batch(bronze, X.BATCH_1), TRIPS, X.RUN_1))
    table.upsert(silver_rows(in_batch(bronze, X.BATCH_2), TRIPS, X.RUN_2), TRIPS.silver_keys)
    return X.plain(table.read())


# -- upserts -----------------------------------------------------------------


def _known(spark: SparkSession, folder: str) -> DataFrame:
    return _orders(spark, folder).select("id", "status", "priority", "cents")


def _arriving(known: DataFrame) -> DataFrame:
    key = F.col("id")
    return known.withColumns(
        {
            "cents": F.when(key % 7 == 0, F.col("cents") + 1).otherwise(F.col("cents")),
            "id": F.when(key % 3 == 0, key + NEW_KEY).otherwise(key),
        }
    )


def _some_without_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("id", F.when(F.col("id") % 50 != 0, F.col("id")))


def scd1_merge(spark, folder):
    known = _known(spark, folder)
    target = stamp(_some_without_key(known), X.RUN_1, digest=True)
    source = stamp(_some_without_key(_arriving(known)), X.RUN_2, digest=True)
    return X.plain(upsert(target, source, ["id"]))


def scd1_merge_composite(spark, folder):
    known = _known(spark, folder)

    def from_file(rows: DataFrame, name: str) -> DataFrame:
        moved = F.when(F.col("cents") % 2 == 0, F.lit(name)).otherwise(F.lit("orders_A.json"))
        return rows.withColumn("source_file", moved)

    target = stamp(from_file(known, "orders_A.json"), X.RUN_1, digest=True)
    source = stamp(from_file(_arriving(known), "orders_B.json"), X.RUN_2, digest=True)
    return X.plain(upsert(target, source, ["id", "source_file"]))


def scd1_merge_idempotent(spark, folder):
    known = _known(spark, folder)
    source = stamp(_arriving(known), X.RUN_2, digest=True)
    once = upsert(stamp(known, X.RUN_1, digest=True), source, ["id"])
    return X.plain(upsert(once, source, ["id"]))


# -- gold --------------------------------------------------------------------


def _routes(spark, folder):
    return clean(X.routes(spark, folder), ROUTES)


def _trips(spark, folder):
    return cast_columns(X.trips(spark, folder), TRIPS.casts)


def _patterns(spark, folder):
    return clean(X.route_patterns(spark, folder), ROUTE_PATTERNS)


def _facts(spark, folder):
    return trip_facts(
        X.silver_schedules(spark, folder), _routes(spark, folder), _trips(spark, folder), _patterns(spark, folder)
    )


def schedule_rollup(spark, folder):
    return X.plain(rollup_schedules(X.silver_schedules(spark, folder)))


def join_left_routes(spark, folder):
    facts = with_routes(rollup_schedules(X.silver_schedules(spark, folder)), _routes(spark, folder))
    return facts.select("trip_id", "route_id", "direction_id", "route_long_name", "route_fare_class")


def join_left_trips(spark, folder):
    facts = with_trips(rollup_schedules(X.silver_schedules(spark, folder)), _trips(spark, folder))
    return facts.select("trip_id", "route_id", "direction_id", "trip_pattern_id", "trip_headsign")


def join_left_patterns(spark, folder):
    carry = ["route_pattern_name", "route_pattern_time_desc"]
    sides = trips_with_patterns(_trips(spark, folder), _patterns(spark, folder))
    facts = with_trips(rollup_schedules(X.silver_schedules(spark, folder)), sides, carry)
    return facts.select("trip_id", "route_id", "direction_id", *carry)


def trips_metrics(spark, folder):
    return X.plain(_facts(spark, folder))


def trips_metrics_audited(spark, folder):
    return X.plain(stamp(_facts(spark, folder), X.RUN_1))


def _window(spark, folder):
    sides = (_routes(spark, folder), _trips(spark, folder), _patterns(spark, folder))
    staging = Staging(spark, "gold-window")
    return gold_window(
        X.silver_schedules(spark, folder), *sides, window_start(X.GOLD_BATCH), staging, X.RUN_2
    )


def gold_incremental(spark, folder):
    return X.plain(_window(spark, folder))


def gold_replace_where(spark, folder):
    """The stored table counts one stop too many; the window is put right."""
    stored = _facts(spark, folder).withColumn("num_stops", F.col("num_stops") + 1)
    return X.plain(replace_where(stored, _window(spark, folder), on_or_after(window_start(X.GOLD_BATCH))))


def gold_overwrite_where(spark, folder):
    """The stored table, by month, counts one stop too many; an overwrite that cuts through a month puts its days right."""
    month = F.trunc("service_date", "month").alias("service_month")
    facts = _facts(spark, folder).select("*", month)
    table = LayerTable(spark, fresh_folder(spark, "facts"), Partitioning("service_month"))
    table.overwrite(facts.withColumn("num_stops", F.col("num_stops") + 1))
    first_day = window_start(X.GOLD_BATCH)
    overwrite_where(table, facts.where(on_or_after(first_day)), from_day_by_month(first_day))
    return X.plain(table.read().drop("service_month"))


def gold_rollup_batches(spark, folder):
    """Totals after three batches that add stops, move first departures both ways and move stops to another trip."""
    lake = Lake(spark, fresh_folder(spark, "rollup"), key_bucket_count=4, keep_superseded=False)
    stops = X.keyed_schedules(spark, folder)
    line = F.col("line")
    second = stops.where(line.isin(3, 4, 5)).withColumns(
        {
            "departure_time": F.when(line == 3, F.col("departure_time") - F.expr("interval 2 days")).otherwise(F.col("departure_time")),
            "direction_id": F.when(line == 4, 1 - F.col("direction_id")).otherwise(F.col("direction_id")),
        }
    )
    third = stops.where(line.isin(1, 5, 6, 7)).withColumn(
        "departure_time",
        F.when(line == 1, F.col("departure_time") + F.expr("interval 30 days")).otherwise(F.col("departure_time")),
    )
    for batch in (stops.where(line <= 4), second, third):
        rows = stamp(batch.drop("line"), X.RUN_1, digest=True)
        if lake.silver(SCHEDULES).version():
            merge_schedules(lake, rows)
        else:
            lake.silver(SCHEDULES).overwrite(rows)
            rebuild(lake)
    return X.plain(with_duration(lake.trip_totals.read()))


QUERIES = {
    f.__name__: f
    for f in (
        landing_scan,
        landing_glob_scan,
        page_concat,
        batch_id_parts,
        batch_filter,
        batch_marker,
        bronze_routes,
        bronze_route_patterns,
        bronze_stops,
        bronze_trips,
        bronze_schedules,
        bronze_incremental,
        audit_columns,
        scd_hash,
        distinct_rows,
        silver_routes,
        silver_route_patterns,
        silver_stops,
        silver_trips,
        silver_schedules,
        silver_incremental,
        scd1_merge,
        scd1_merge_composite,
        scd1_merge_idempotent,
        schedule_rollup,
        join_left_routes,
        join_left_trips,
        join_left_patterns,
        trips_metrics,
        trips_metrics_audited,
        gold_incremental,
        gold_replace_where,
        gold_overwrite_where,
        gold_rollup_batches,
    )
}
