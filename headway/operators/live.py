"""Live records: parsing, route filter, cutoff filter, flattening, envelope, counters.

Parsed records are rows ``endpoint, id, type, attributes, relationships``, from a
JSON scan with ``RECORD_DDL`` or from text through ``parse``. Published attributes
are variants: a value of another type than the feed declares reaches the message
as it came, and a present null stays a null. ``flatten`` can also give them their
declared types. All three endpoints share one projection; a field an endpoint does
not publish, or a record lacks, is null there, and the JSON envelope leaves it out.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.jsonapi import distinct_ids, related_id, related_ids
from headway.functions.values import first_filled, instant_of
from headway.schemas import ALERT_TARGETS, LIVE_FIELDS, LIVE_LINKS

ENVELOPE = ["source", "endpoint", "record_type", "record_id", "filter_route", "polled_at_utc"]
DEFAULT_ROUTES = ("Red",)
DEFAULT_SOURCE = "transit-v3"


def _all_fields() -> dict[str, str]:
    return {name: kind for fields in LIVE_FIELDS.values() for name, kind in fields.items()}


def _all_links() -> list[str]:
    return list(dict.fromkeys(link for links in LIVE_LINKS.values() for link in links))


def _record_ddl() -> str:
    entities = ",".join(f"{t}:string" for t in ALERT_TARGETS)
    attributes = ",".join(f"{n}:variant" for n in _all_fields())
    links = ",".join(f"{link}:struct<data:string>" for link in _all_links())
    return (
        f"id string, type string, "
        f"attributes struct<{attributes},informed_entity:array<struct<{entities}>>>, "
        f"relationships struct<{links}>"
    )


# Columns of a live record; relationship ``data`` stays text as its shape varies.
RECORD_DDL = _record_ddl()
RECORD_TEXT = "_record_text"
SENT, FILTERED_OUT, REJECTED = "sent", "filtered_out", "rejected"


def landed_records(lines: DataFrame, line: str = "value") -> DataFrame:
    """Record texts (``record``) of landed lines, in place of the line.

    A line is one record, or a page of a listing, whose ``data`` is a list of
    records, a lone one or null. Text that is no JSON object stays a record, which
    ``parse`` cannot read.
    """
    keys = F.json_object_keys(line)
    is_page = keys.isNotNull() & ~F.arrays_overlap(keys, F.array(*[F.lit(k) for k in ("id", "type", "attributes")]))
    data = F.get_json_object(line, "$.data")
    items = (
        F.when(~F.coalesce(is_page, F.lit(False)), F.array(line))
        .when(data.startswith("["), F.from_json(data, "array<string>"))
        .when(data.isNotNull(), F.array(data))
    )
    return lines.select(*[c for c in lines.columns if c != line], F.explode(items).alias("record"))


def is_readable() -> Column:
    """Whether a parsed record is one: it names its id."""
    return F.col("id").isNotNull()


def parse(records: DataFrame, keep_text: bool = False) -> DataFrame:
    """``record`` text as the record's columns; other columns pass through.

    The parse sits in a generator: the filters that follow then read its result
    instead of being pushed below it, where each would parse the text again.
    ``keep_text`` keeps the text as ``RECORD_TEXT``, for what turns out unreadable.
    """
    kept = [F.col(c) for c in records.columns if c != "record"]
    if keep_text:
        kept.append(F.col("record").alias(RECORD_TEXT))
    return records.select(*kept, F.inline(F.array(F.from_json("record", RECORD_DDL))))


def typed(value: Column, kind: str) -> Column:
    """A variant as ``kind``; null where it holds something else."""
    found = F.try_variant_get(value, "$", kind)
    if kind == "bigint":
        return F.when(F.try_variant_get(value, "$", "double") == found, found)
    return found


def _published(name: str, value: Column, owners: dict) -> Column:
    """``value`` on the endpoints that publish ``name``, null elsewhere."""
    endpoints = [e for e, names in owners.items() if name in names]
    if len(endpoints) == len(owners):
        return value
    return F.when(F.col("endpoint").isin(endpoints), value)


def filter_routes(
    parsed: DataFrame, routes: Sequence[str] | DataFrame = DEFAULT_ROUTES, also: Column | None = None
) -> DataFrame:
    """Keep predictions of the wanted routes only and stamp them with ``filter_route``.

    Vehicles and alerts are unrestricted and carry no filter route, nor do the
    rows ``also``, which all stay. ``routes`` may be a table, whose first column
    names the routes; it is joined, by broadcast where its size allows. An empty
    list means the default routes, an empty table none.
    """
    route = related_id(F.col("relationships.route.data"))
    predicted = F.col("endpoint") == "predictions"
    free = ~predicted if also is None else ~predicted | also
    stamp = F.when(predicted & ~free, route)
    if not isinstance(routes, DataFrame):
        wanted = list(routes) or list(DEFAULT_ROUTES)
        return parsed.where(free | route.isin(wanted)).withColumn("filter_route", stamp)
    wanted = routes.select(F.col(routes.columns[0]).cast("string").alias("_wanted")).distinct()
    # Rows without a route to look up get keys of their own, or one task would hold them all.
    key = F.coalesce(stamp, F.concat(F.lit("\0"), F.coalesce("id", F.uuid())))
    marked = parsed.withColumn("filter_route", stamp).withColumn("_route", key)
    joined = marked.join(wanted, F.col("_route") == F.col("_wanted"), "left")
    return joined.where(free | F.col("_wanted").isNotNull()).drop("_route", "_wanted")


def stamp_routes(parsed: DataFrame, also: Column) -> DataFrame:
    """``filter_route`` as ``filter_routes`` gives it, with no row dropped yet."""
    route = related_id(F.col("relationships.route.data"))
    return parsed.withColumn("filter_route", F.when((F.col("endpoint") == "predictions") & ~also, route))


def of_wanted_routes(outcome: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of an ``outcome`` (endpoint, filter_route, status) that ``filter_routes`` keeps by a table of routes.

    Made for written rows: what may be shuffled are messages, not parsed records.
    """
    free = F.coalesce(F.col("endpoint") != "predictions", F.lit(False)) | (F.col("status") == REJECTED)
    names = wanted.select(F.col(wanted.columns[0]).cast("string").alias("_wanted"))
    kept = outcome.where(~free).join(names, F.col("filter_route") == F.col("_wanted"), "left_semi")
    return outcome.where(free).unionByName(kept)


def not_known(outcome: DataFrame, known: DataFrame) -> DataFrame:
    """An ``outcome`` (endpoint, key, changed_at, status, value) in which changes ``known`` count as filtered out.

    Only dated news is looked up: everything else is decided already.
    """
    looked_up = (F.col("status") == SENT) & F.col("changed_at").isNotNull()
    sent = known.select(
        F.col("endpoint").alias("_endpoint"), F.col("id").alias("_id"), F.col("changed_at").alias("_changed_at")
    ).distinct()
    pairs = {"endpoint": "_endpoint", "key": "_id", "changed_at": "_changed_at"}
    joined = outcome.where(looked_up).join(sent, [F.col(c) == F.col(k) for c, k in pairs.items()], "left")
    news = F.col("_id").isNull()
    marked = joined.withColumns(
        {"status": F.when(news, SENT).otherwise(FILTERED_OUT), "value": F.when(news, F.col("value"))}
    )
    return outcome.where(~looked_up).unionByName(marked.select(*outcome.columns))


def changed_at() -> Column:
    attributes = F.col("attributes")
    return instant_of(first_filled(*[typed(attributes[n], "string") for n in ("updated_at", "created_at")]))


def cutoff_column(cutoffs: dict[str, datetime]) -> Column:
    """The endpoint's cutoff; null, hence full backfill, where there is none."""
    column: Column = F.lit(None).cast("timestamp")
    for endpoint, instant in cutoffs.items():
        column = F.when(F.col("endpoint") == endpoint, F.lit(instant).cast("timestamp")).otherwise(column)
    return column


def is_news(cutoffs: dict[str, datetime]) -> Column:
    """Changed strictly after the cutoff, or undated, unreadable or without cutoff."""
    return F.coalesce(changed_at() > cutoff_column(cutoffs), F.lit(True))


def judge(
    parsed: DataFrame,
    cutoffs: dict[str, datetime],
    routes: Sequence[str] | DataFrame | None = DEFAULT_ROUTES,
    known: DataFrame | None = None,
) -> DataFrame:
    """The records a poll fetched, with ``filter_route``, ``changed_at`` and ``status``; with ``routes`` None, of all routes.

    ``known`` (endpoint, id, changed_at) are changes sent before; they are
    filtered out though they lie after the cutoff. Unreadable records are
    ``rejected``, whatever their endpoint and route.
    """
    stamped = stamp_routes(parsed, ~is_readable()) if routes is None else filter_routes(parsed, routes, also=~is_readable())
    fetched = stamped.withColumn("changed_at", changed_at())
    news = is_news(cutoffs)
    if known is not None:
        sent = known.select(
            F.col("endpoint").alias("_endpoint"), F.col("id").alias("_id"), F.col("changed_at").alias("_changed_at")
        ).distinct()
        same = [F.col(c) == F.col(f"_{c}") for c in ("endpoint", "id", "changed_at")]
        fetched = fetched.join(sent, same, "left")
        news = news & F.col("_id").isNull()
    status = F.when(~is_readable(), REJECTED).when(news, SENT).otherwise(FILTERED_OUT)
    return fetched.withColumn("status", status).drop("_endpoint", "_id", "_changed_at")


def flatten(parsed: DataFrame, declared_types: bool = True) -> DataFrame:
    """Envelope inputs, published attributes and related ids as flat columns.

    Attributes get their declared types, or stay variants as they came.
    """
    attributes, links = F.col("attributes"), F.col("relationships")

    def attribute(name: str, kind: str) -> Column:
        return typed(attributes[name], kind) if declared_types else attributes[name]

    columns = {name: _published(name, attribute(name, kind), LIVE_FIELDS) for name, kind in _all_fields().items()}
    for link in _all_links():
        data = links[link]["data"]
        columns[f"{link}_id"] = _published(link, related_id(data), LIVE_LINKS)
        columns[f"{link}_ids"] = _published(link, related_ids(data), LIVE_LINKS)
    is_alert = F.col("endpoint") == "alerts"
    for target in ALERT_TARGETS:
        informed = distinct_ids(attributes["informed_entity"], target)
        columns[f"{target}_ids"] = F.when(is_alert, informed).otherwise(columns[f"{target}_ids"])
    passed = [c for c in parsed.columns if c not in ("id", "type", "attributes", "relationships", RECORD_TEXT)]
    return parsed.select(
        *passed,
        F.col("type").alias("record_type"),
        F.col("id").alias("record_id"),
        *[column.alias(name) for name, column in columns.items()],
    )


def endpoint_columns(endpoint: str) -> list[str]:
    """Flat columns one endpoint can fill."""
    links = LIVE_LINKS[endpoint]
    ids = [f"{link}_id{many}" for link in links for many in ("", "s")]
    if endpoint == "alerts":
        ids = [f"{target}_ids" for target in ALERT_TARGETS]
    return ["record_id", *LIVE_FIELDS[endpoint], *ids]


def envelope(
    flat: DataFrame, polled_at: datetime | str, source: str = DEFAULT_SOURCE, beside: Sequence[str] = ()
) -> DataFrame:
    """One message per record: ``topic`` (its endpoint), ``key`` and JSON ``value``; columns ``beside`` stay out of it."""
    polled = polled_at if isinstance(polled_at, str) else polled_at.isoformat()
    fields = [c for c in flat.columns if c not in (*ENVELOPE, *beside)]
    message = F.struct(
        F.lit(source).alias("source"),
        F.concat(F.lit("/"), F.col("endpoint")).alias("endpoint"),
        "record_type",
        "record_id",
        "filter_route",
        F.lit(polled).alias("polled_at_utc"),
        *fields,
    )
    return flat.select(
        F.col("endpoint").alias("topic"),
        F.col("record_id").alias("key"),
        F.to_json(message).alias("value"),
        *beside,
    )


def poll_counts() -> list[Column]:
    """Fetched, sent, filtered-out and rejected records; rejected ones do not count as fetched."""
    status = F.col("status")
    return [
        F.count_if(status != REJECTED).alias("fetched"),
        *[F.count_if(status == name).alias(name) for name in (SENT, FILTERED_OUT, REJECTED)],
    ]


def count_poll(judged: DataFrame) -> DataFrame:
    """The poll's counters per endpoint and filter route; rejected records have no route."""
    return judged.groupBy("endpoint", "filter_route").agg(*poll_counts())


def poll_messages(
    parsed: DataFrame,
    cutoffs: dict[str, datetime],
    polled_at: datetime | str,
    routes: Sequence[str] | DataFrame = DEFAULT_ROUTES,
    source: str = DEFAULT_SOURCE,
) -> DataFrame:
    """One poll as a projection over its readable records: no shuffle, no state of its own."""
    wanted = filter_routes(parsed.where(is_readable()), routes).where(is_news(cutoffs))
    return envelope(flatten(wanted, declared_types=False), polled_at, source)
