"""Registered queries over live records, as batches and as streams."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import live
from headway.schemas import LIVE_FIELDS
from headway.sources.files import fresh_folder
from headway.sources.state import PollState
from headway.streaming.poll import file_sink, message_stream, poll_batch, read_records, start_poll
from workload import fixtures as X

ROUTES = ("9", "58", "84")
POLLED_AT = "2024-02-01T06:30:00+00:00"
#: A clock after every event.
LATE = datetime(2100, 1, 1, tzinfo=timezone.utc)
CUTOFFS = {"vehicles": X.CUTOFF, "alerts": X.CUTOFF, "predictions": X.CUTOFF}
#: A compressed file is read by one task.
LINES_PER_FILE = 200_000
# Message fields shown by the envelope queries.
SHOWN = (
    "source string, endpoint string, record_type string, record_id string, filter_route string, "
    "polled_at_utc string, label string, speed double, severity bigint, arrival_time string, "
    "updated_at string, trip_id string, stop_id string, stop_ids array<string>, route_id string, "
    "route_ids array<string>, vehicle_id string, schedule_id string"
)


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return live.parse(X.live_records(spark, folder))


def _keys(parsed: DataFrame) -> DataFrame:
    return parsed.select("endpoint", F.col("id").alias("record_id"), "filter_route")


def route_filter(spark, folder):
    return _keys(live.filter_routes(_parsed(spark, folder), ROUTES))


def incremental_filter(spark, folder):
    """Cutoffs for two endpoints; the third has none and is read in full."""
    cutoffs = {"vehicles": X.CUTOFF, "alerts": X.CUTOFF}
    return _keys(live.filter_routes(_parsed(spark, folder), ROUTES).where(live.is_news(cutoffs)))


def full_backfill(spark, folder):
    return _keys(live.filter_routes(_parsed(spark, folder), ROUTES).where(live.is_news({})))


def _flat(spark: SparkSession, folder: str, endpoint: str) -> DataFrame:
    parsed = _parsed(spark, folder).where(F.col("endpoint") == endpoint)
    return live.flatten(parsed).select(*live.endpoint_columns(endpoint))


def flatten_vehicles(spark, folder):
    return X.plain(_flat(spark, folder, "vehicles"))


def flatten_predictions(spark, folder):
    return X.plain(_flat(spark, folder, "predictions"))


def flatten_alerts(spark, folder):
    periods = F.transform("active_period", lambda p: F.concat_ws("/", p["start"], p["end"]))
    return X.plain(_flat(spark, folder, "alerts").withColumn("active_period", periods))


def relationship_ids(spark, folder):
    flat = live.flatten(_parsed(spark, folder))
    return X.plain(flat.select("endpoint", "record_id", "stop_id", "stop_ids", "schedule_id", "schedule_ids"))


def _opened(messages: DataFrame) -> DataFrame:
    value = F.from_json("value", SHOWN)
    return X.plain(messages.select("topic", "key", value.alias("m")).select("topic", "key", "m.*"))


def envelope(spark, folder):
    return _opened(live.poll_messages(_parsed(spark, folder), CUTOFFS, POLLED_AT, ROUTES))


def poll_counters(spark, folder):
    counted = live.count_poll(live.judge(_parsed(spark, folder), CUTOFFS, ROUTES))
    return counted.select("endpoint", "filter_route", "fetched", "sent", "filtered_out")


def stream_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a file stream, worked off in micro-batches into topic folders."""
    out = fresh_folder(spark, "messages")
    events = (
        spark.readStream.schema(X.table(spark, folder, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(folder)
    )
    messages = message_stream(live.parse(X.live_records(spark, folder, events)), POLLED_AT, ROUTES)
    query = (
        messages.writeStream.format("parquet")
        .partitionBy("topic")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _opened(spark.read.schema("key string, value string, topic string").parquet(f"{out}/data"))


def stream_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Two polls of the whole feed, as records and then as pages: the second sends what changed since the first.

    The first meets what changes after it with a stamp of its own time.
    """
    root = fresh_folder(spark, "poll")
    cutoff = F.lit(X.CUTOFF).cast("timestamp_ntz")
    for polled_at in (X.CUTOFF, X.RUN_2):
        events = X.table(spark, folder, "events")
        if polled_at == X.CUTOFF:
            events = events.withColumn("ts", F.when(F.col("ts") > cutoff, cutoff).otherwise(F.col("ts")))
        lines = X.live_records(spark, folder, X.spread(events))
        if polled_at == X.RUN_2:
            lines = lines.withColumn("record", F.concat(F.lit('{"data":['), "record", F.lit("]}")))
        _land(lines, root)
        _poll(spark, root, clock=polled_at)
    sent = _sent(spark, root)
    return sent.select("poll", "topic", "key", F.get_json_object("value", "$.filter_route").alias("filter_route"))


def _land(lines: DataFrame, root: str) -> None:
    """Lines to the folders of their endpoints, each written on its own: no task sorts texts by folder."""
    for endpoint in LIVE_FIELDS:
        own = lines.where(F.col("endpoint") == endpoint).drop("endpoint")
        writer = own.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", LINES_PER_FILE)
        writer.text(f"{root}/in/endpoint={endpoint}")


def _poll(spark: SparkSession, root: str, routes=ROUTES, clock=LATE, **options) -> PollState:
    state = PollState(spark, f"{root}/state")
    body = poll_batch(state, file_sink(f"{root}/out"), routes, clock=lambda: clock, **options)
    start_poll(read_records(spark, f"{root}/in"), f"{root}/checkpoint", body, once=True).awaitTermination()
    return state


def _sent(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("key string, value string, poll int, topic string").parquet(f"{root}/out")


def _three_polls(spark: SparkSession, folder: str) -> tuple[PollState, str]:
    """A feed stamped by the day that repeats its whole state in every poll, each time with a third more of the events."""
    root = fresh_folder(spark, "polls")
    events = X.table(spark, folder, "events").withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    for poll in range(3):
        _land(X.live_records(spark, folder, X.spread(events.where(F.col("event_id") % 3 <= poll))), root)
        state = _poll(spark, root)
    return state, root


def stream_boundary(spark, folder):
    """What three polls send: each change once, those with the stamp of the cutoff that land late included."""
    _, root = _three_polls(spark, folder)
    return _sent(spark, root).select("poll", "topic", "key")


def poll_run_counters(spark, folder):
    """The counters that the job itself keeps of three polls."""
    state, _ = _three_polls(spark, folder)
    return state.counters().withColumnRenamed("epoch", "poll")


def dead_letters(spark, folder):
    """Texts that are no records, from the pass that parses the others."""
    root = fresh_folder(spark, "rejected")
    key = X.text("event_id")
    record = F.concat(F.lit('{"id":"'), key, F.lit('"}'))
    kinds = [
        F.concat(F.lit('{"id":"'), key, F.lit('","attrib')),
        F.concat(F.lit('{"type":"vehicle","attributes":{"label":"'), key, F.lit('"}}')),
        F.concat(F.lit("["), key, F.lit("]")),
        F.concat(F.lit("line "), key),
        F.concat(F.lit('{"data":['), record, F.lit(","), key, F.lit("]}")),
    ]
    line = record
    for number, kind in enumerate(kinds):
        line = F.when(F.col("event_id") % 6 == number, kind).otherwise(line)
    _land(X.table(spark, folder, "events").select(line.alias("value"), F.lit("vehicles").alias("endpoint")), root)
    return _poll(spark, root).dead_letters().select("endpoint", "reason", "text")


def undeclared_values(spark, folder):
    """Attributes of other types than declared, and present nulls, reach the message as they came."""
    key = X.text("event_id")
    speed = (
        F.when(F.col("event_id") % 4 == 0, F.lit("7.25"))
        .when(F.col("event_id") % 4 == 1, F.concat(F.lit('"fast '), key, F.lit('"')))
        .when(F.col("event_id") % 4 == 2, F.lit("true"))
        .otherwise(F.lit("null"))
    )
    severity = F.when(F.col("event_id") % 3 == 0, F.lit("3")).when(F.col("event_id") % 3 == 1, F.lit("3.5")).otherwise(F.lit('"high"'))
    header = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"en":["'), key, F.lit('",1]}'))).otherwise(F.concat(F.lit('"'), key, F.lit('"')))
    vehicle = F.concat(F.lit('{"id":"'), key, F.lit('","attributes":{"speed":'), speed, F.lit("}}"))
    alert = F.concat(F.lit('{"id":"'), key, F.lit('","attributes":{"severity":'), severity, F.lit(',"header":'), header, F.lit("}}"))
    is_vehicle = F.col("event_type").isin("click", "view")
    rows = X.table(spark, folder, "events").select(
        F.when(is_vehicle, "vehicles").otherwise("alerts").alias("endpoint"), F.when(is_vehicle, vehicle).otherwise(alert).alias("record")
    )
    messages = live.poll_messages(live.parse(rows), {}, POLLED_AT)
    shown = [F.get_json_object("value", f"$.{name}").alias(name) for name in ("speed", "severity", "header")]
    return messages.select("topic", "key", *shown, F.col("value").contains('"speed":null').alias("null_speed"))


def stream_route_table(spark, folder):
    """Predictions of the routes in a table that another one replaces between two polls."""
    root = fresh_folder(spark, "routes")
    wanted = X.table(spark, folder, "customer").select("c_custkey")
    for every in (2, 3):
        _land(X.live_records(spark, folder), root)
        _poll(spark, root, lambda: wanted.where(F.col("c_custkey") % every == 0), full_backfill=True)
    return _sent(spark, root).select("poll", "topic", "key", F.get_json_object("value", "$.filter_route").alias("filter_route"))


QUERIES = {
    f.__name__: f
    for f in (
        route_filter,
        incremental_filter,
        full_backfill,
        flatten_vehicles,
        flatten_predictions,
        flatten_alerts,
        relationship_ids,
        envelope,
        poll_counters,
        stream_envelope,
        stream_incremental,
        stream_boundary,
        poll_run_counters,
        dead_letters,
        undeclared_values,
        stream_route_table,
    )
}
