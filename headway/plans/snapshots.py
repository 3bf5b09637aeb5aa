"""Snapshot jobs: landing to bronze to silver to gold, in full or for one batch.

Every step is a DataFrame function with one table write; the batch id is one
argument for all layers.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.batch_ids import window_start
from headway.operators.shape import clean, flatten_documents, in_batch, stamp
from headway.operators.replace_window import from_day, overwrite_where
from headway.operators.trip_facts import (
    facts_of,
    narrow_to_groups,
    on_or_after,
    trip_facts,
    trips_of_groups,
    window_groups,
    with_duration,
)
from headway.plans import rollup
from headway.plans.layers import Lake
from headway.schemas import ENTITIES, ROUTE_PATTERNS, ROUTES, SCHEDULES, TRIPS, Entity
from headway.session import prepare
from headway.sources.files import Staging
from headway.sources.landing import read_batch


def bronze_rows(documents: DataFrame, entity: Entity, batch_id: str, run_ts: datetime | None = None) -> DataFrame:
    """Landing documents of a batch as stamped bronze rows.

    The digest includes the file name: a delivered row always counts as
    changed, and its newest file tells silver which rows the batch held.
    """
    return in_batch(stamp(flatten_documents(documents, entity), run_ts, digest=True), batch_id)


def silver_rows(bronze: DataFrame, entity: Entity, run_ts: datetime | None = None) -> DataFrame:
    """Bronze rows as stamped silver rows; the digest covers business columns only."""
    return stamp(clean(bronze, entity), run_ts, digest=True)


def gold_window(
    schedules: DataFrame,
    routes: DataFrame,
    trips: DataFrame,
    patterns: DataFrame,
    first_day: date,
    staging: Staging,
    run_ts: datetime | None = None,
) -> DataFrame:
    """The stamped facts from ``first_day`` on, as an incremental run writes them.

    A fact's date is its earliest departure, so the window cannot filter the
    schedules directly. But only groups with some departure in the window can
    start there: the rest of the history is dropped by a semi-join with those,
    which are written first so that Spark picks the join by their measured size.
    """
    groups = staging.keep(window_groups(schedules, first_day))
    schedules, trips = narrow_to_groups(schedules, trips, groups)
    facts = trip_facts(schedules, routes, trips, patterns)
    return stamp(facts.where(on_or_after(first_day)), run_ts)


def _landed(lake: Lake, entity: Entity, batch_id: str, lines: bool) -> DataFrame:
    return read_batch(lake.spark, lake.landing, entity, batch_id, lines=lines and entity.per_route)


def load_bronze(lake: Lake, entity: Entity, batch_id: str, full: bool, run_ts=None, lines: bool = False) -> dict | None:
    """Rebuild the bronze table from one batch, or merge the batch in and return its row counts."""
    rows = bronze_rows(_landed(lake, entity, batch_id, lines), entity, batch_id, run_ts)
    table = lake.bronze(entity)
    if full:
        return table.overwrite(rows)
    return table.upsert(rows, entity.bronze_keys)


def load_silver(lake: Lake, entity: Entity, batch_id: str, full: bool, run_ts=None) -> dict | None:
    """Rebuild the silver table from all of bronze, or merge in the rows the batch delivered."""
    bronze = lake.bronze(entity)
    table = lake.silver(entity)
    if full:
        table.overwrite(silver_rows(bronze.read(), entity, run_ts))
        return rollup.rebuild(lake) if entity is SCHEDULES else None
    latest = in_batch(bronze.read(only={batch_id}), batch_id)
    rows = silver_rows(latest, entity, run_ts)
    return rollup.merge_schedules(lake, rows) if entity is SCHEDULES else table.upsert(rows, entity.silver_keys)


def load_gold(lake: Lake, batch_id: str, full: bool, run_ts=None, audited: bool = False) -> None:
    """Full build, or replacement of every service date from the day before the batch.

    The table is partitioned by service date, so the replaced dates are dropped
    by folder, dates without new facts included; older and undated rows are
    neither read nor written. An incremental run takes the trips' totals as the
    batch left them and reads no schedules.
    """
    table = lake.trips_metrics
    routes, trips, patterns = (lake.silver(e).read() for e in (ROUTES, TRIPS, ROUTE_PATTERNS))
    if full:
        facts = trip_facts(lake.silver(SCHEDULES).read(), routes, trips, patterns)
        table.overwrite(stamp(facts, run_ts) if audited else facts)
        return
    if not lake.trip_totals.version():
        rollup.rebuild(lake)
    first_day = window_start(batch_id)
    with Staging(lake.spark, "gold") as staging:
        totals = staging.keep(lake.trip_totals.read().where(F.col("departure_time") >= F.lit(first_day).cast("timestamp")))
        facts = facts_of(with_duration(totals), routes, trips_of_groups(trips, totals), patterns)
        overwrite_where(table, stamp(facts, run_ts), from_day(first_day))


def run(
    lake: Lake,
    batch_id: str,
    full: bool,
    run_ts: datetime | None = None,
    lines: bool = False,
    entities: Iterable[Entity] = tuple(ENTITIES.values()),
) -> dict[str, dict | None]:
    """All layers for one batch: ``full`` rebuilds, otherwise the batch is merged in.

    Returns the merge counts by table, e.g. rows without a key.
    """
    prepare(lake.spark)
    entities = list(entities)
    counts = {f"bronze.{e.name}": load_bronze(lake, e, batch_id, full, run_ts, lines) for e in entities}
    counts |= {f"silver.{e.name}": load_silver(lake, e, batch_id, full, run_ts) for e in entities}
    load_gold(lake, batch_id, full, run_ts)
    return counts
