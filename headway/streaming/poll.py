"""The live poll as a streaming query: filter, flatten, wrap, route, remember."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators import live
from headway.schemas import LIVE_FIELDS
from headway.sources.files import Staging
from headway.sources.state import PollState

POLL_INTERVAL = "1 minute"
#: A cutoff stays this far behind the latest change seen, so that changes stamped in the
#: same second and landed later are not lost; what was sent beyond it is remembered.
OVERLAP = timedelta(seconds=1)
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
Sink = Callable[[DataFrame, int], None]
Routes = Sequence[str] | DataFrame | Callable[[], Sequence[str] | DataFrame]


def read_records(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Landed live records: lines of JSON, each a record or a page of them, in ``endpoint=<name>`` folders."""
    reader = spark.readStream.schema("value string, endpoint string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return live.parse(live.landed_records(reader.text(folder)), keep_text=True)


def file_sink(folder: str) -> Sink:
    """Messages as Parquet files per poll and topic; a repeated poll replaces its own files of the topics given."""

    def write(messages: DataFrame, epoch: int) -> None:
        out = messages.withColumn("key", F.coalesce("key", F.lit("")))
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("topic").parquet(f"{folder}/poll={epoch:010d}")

    return write


def kafka_sink(servers: str, topics: dict[str, str] | None = None, **options: str) -> Sink:
    """Messages to one Kafka topic per endpoint; ``topics`` renames them.

    Kafka keeps a repeated poll's messages, so delivery is at least once.
    """

    def write(messages: DataFrame, _epoch: int) -> None:
        topic = F.col("topic")
        for endpoint, name in (topics or {}).items():
            topic = F.when(F.col("topic") == endpoint, F.lit(name)).otherwise(topic)
        out = messages.select(topic.alias("topic"), "key", "value")
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).options(**options).save()

    return write


def moved_cutoffs(
    earlier: dict[str, datetime], latest: dict[str, int | None], polled_at: datetime
) -> dict[str, datetime]:
    """Cutoffs of the endpoints that delivered dated records (``latest``: microseconds), never set back."""
    out = {}
    for endpoint, micros in latest.items():
        if micros is not None:
            reached = min(polled_at, EPOCH + timedelta(microseconds=micros) - OVERLAP)
            out[endpoint] = max(reached, earlier.get(endpoint, reached))
    return out


def poll_batch(
    state: PollState,
    sink: Sink,
    routes: Routes = live.DEFAULT_ROUTES,
    source: str = live.DEFAULT_SOURCE,
    full_backfill: bool = False,
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    report: Callable[[int, dict], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` body of one poll.

    Records are parsed in one pass, whose outcome is staged: messages, rejected
    text with its reason, and what the counters need. Tables of routes and of changes
    sent before are joined to that outcome, never to parsed records. An endpoint's cutoff follows
    the latest change it delivered, less ``OVERLAP``, never the mere time of a poll.
    Changes sent beyond the cutoff are remembered by id and instant, so a feed that
    repeats its state sends each change once and one landed late is still sent.

    The sink takes one endpoint's messages at a time. An endpoint whose sink fails
    keeps its cutoff, and its messages wait in the state for the next poll; the
    others go on. If no endpoint's messages could be sent, the error is raised and
    the micro-batch is repeated with the state it had before. ``routes`` may be a
    function, called in every poll, that returns the wanted routes or their table.
    """

    def run(parsed: DataFrame, epoch: int) -> None:
        polled_at = clock()
        earlier = state.before(epoch)
        known, pending = state.known(epoch), state.pending(epoch)
        waiting = pending.select(F.col("topic").alias("endpoint"), F.col("key").alias("id"), "changed_at")
        wanted = routes() if callable(routes) else routes
        by_table = isinstance(wanted, DataFrame)
        judged = live.judge(parsed, {} if full_backfill else earlier, None if by_table else wanted)
        with Staging(parsed.sparkSession, "poll") as staging:
            rows = staging.keep(_outcome(judged, polled_at, source))
            if by_table:
                # The wanted ones among the routes that occur: few, whatever the table's size.
                found = rows.select("filter_route").distinct().where(F.col("filter_route").isNotNull())
                names = wanted.select(F.col(wanted.columns[0]).cast("string").alias("filter_route"))
                rows = live.of_wanted_routes(rows, staging.keep(found.join(names, "filter_route", "left_semi")))
            if not full_backfill:
                rows = live.not_known(rows, known.unionByName(waiting))
            by_route = staging.keep(
                rows.groupBy("endpoint", "filter_route")
                .agg(*live.poll_counts(), F.max(F.unix_micros("changed_at")).alias("latest"))
            )
            totals = {
                r["endpoint"]: r.asDict()
                for r in by_route.groupBy("endpoint")
                .agg(*[F.sum(n).alias(n) for n in _COUNTED], F.max("latest").alias("latest"))
                .collect()
            }
            state.write("counters", epoch, by_route.drop("latest"))
            if any(t["rejected"] for t in totals.values()):
                rejected = rows.where(F.col("status") == live.REJECTED)
                state.write("dead_letters", epoch, rejected.select("endpoint", "reason", F.col("value").alias("text")))

            held_back = {r["topic"] for r in pending.select("topic").distinct().collect()}
            sent = rows.where(F.col("status") == live.SENT).select(
                F.col("endpoint").alias("topic"), "key", "value", "changed_at"
            )
            messages = pending.unionByName(sent)
            failed: dict[str, Exception] = {}
            due = [e for e in LIVE_FIELDS if e in held_back or totals.get(e, {}).get("sent")]
            for endpoint in due:
                try:
                    sink(messages.where(F.col("topic") == endpoint).select("topic", "key", "value"), epoch)
                except Exception as e:
                    failed[endpoint] = e
            if failed and len(failed) == len(due):
                raise next(iter(failed.values()))

            latest = {e: t["latest"] for e, t in totals.items() if e not in failed}
            cutoffs = earlier | moved_cutoffs(earlier, latest, polled_at)
            unsent = F.col("topic").isin(list(failed)) if failed else F.lit(False)
            delivered = messages.where(~unsent).select(F.col("topic").alias("endpoint"), F.col("key").alias("id"), "changed_at")
            beyond = F.col("changed_at") > live.cutoff_column(cutoffs)
            remembered = known.unionByName(delivered).where(beyond).distinct()
            state.save(epoch, cutoffs, known=remembered, pending=messages.where(unsent))
        if report:
            counts = {f"{e}_{n}": totals.get(e, {}).get(n, 0) for e in LIVE_FIELDS for n in _COUNTED}
            report(epoch, counts | {f"{e}_failed": str(error) for e, error in failed.items()})

    return run


_COUNTED = ("fetched", live.SENT, live.FILTERED_OUT, live.REJECTED)


def _outcome(judged: DataFrame, polled_at: datetime, source: str) -> DataFrame:
    """endpoint, key, value, filter_route, changed_at, status and reason of every record, from one parse.

    ``value`` is the message of a sent record, the text of a rejected one.
    """
    beside = F.struct("endpoint", "filter_route", "changed_at", "status", F.col(live.RECORD_TEXT).alias("text"))
    flat = live.flatten(judged.withColumn("_beside", beside).drop("changed_at", "status"), declared_types=False)
    message = live.envelope(flat, polled_at, source, beside=["_beside"])
    status, text = F.col("_beside.status"), F.col("_beside.text")
    keys = F.json_object_keys(text)
    return message.select(
        "_beside.endpoint",
        "key",
        F.when(status == live.SENT, F.col("value")).when(status == live.REJECTED, text).alias("value"),
        "_beside.filter_route",
        "_beside.changed_at",
        status.alias("status"),
        F.when(status == live.REJECTED, F.when(keys.isNull(), "no JSON object").otherwise("no id")).alias("reason"),
    )


def start_poll(
    parsed: DataFrame,
    checkpoint: str,
    body: Callable[[DataFrame, int], None],
    once: bool = False,
) -> StreamingQuery:
    """Start polling every minute, or work off what has landed and stop (``once``)."""
    writer = parsed.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": POLL_INTERVAL}
    return writer.trigger(**trigger).start()


def message_stream(
    parsed: DataFrame,
    polled_at: datetime | str,
    routes: Sequence[str] = live.DEFAULT_ROUTES,
    source: str = live.DEFAULT_SOURCE,
) -> DataFrame:
    """Full-backfill messages as a stateless stream, for any sink with ``topic, key, value``."""
    return live.poll_messages(parsed, {}, polled_at, routes, source)
