"""Projections: records to rows, audit columns, row digest, typed columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.values import row_digest
from headway.schemas import AUDIT_COLUMNS, LINEAGE_COLUMN, Entity


def flatten_documents(documents: DataFrame, entity: Entity) -> DataFrame:
    """One row per record of the ``data`` arrays, nested fields as plain columns.

    Documents with an empty or null array give no row. Only the entity's
    fields are named, so the JSON scan parses nothing else.
    """
    records = documents.select(F.explode("data").alias("r"), LINEAGE_COLUMN)
    return records.select(
        F.col("r.id").alias("id"),
        *[F.col(f"r.attributes.{name}").alias(name) for name in entity.attributes],
        *[F.col(f"r.relationships.{link}.data.id").alias(name) for link, name in entity.links.items()],
        LINEAGE_COLUMN,
    )


def stamp(rows: DataFrame, run_ts: datetime | None = None, digest: bool = False) -> DataFrame:
    """Append ``created_ts`` and ``updated_ts`` and, on request, the digest ``scd_key``.

    The digest covers the columns present before the call. One run passes one
    ``run_ts``; without it the query's start time is used.
    """
    now: Column = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    stamps = {"created_ts": now, "updated_ts": now}
    if digest:
        stamps["scd_key"] = row_digest(rows.columns)
    return rows.withColumns(stamps)


def business_columns(rows: DataFrame) -> DataFrame:
    """Without audit and lineage columns."""
    return rows.drop(*AUDIT_COLUMNS, LINEAGE_COLUMN)


def in_batch(rows: DataFrame, batch_id: str) -> DataFrame:
    """Rows whose landing file carries the batch id; pushed down to Parquet."""
    return rows.where(F.col(LINEAGE_COLUMN).contains(batch_id))


def split_directions(rows: DataFrame) -> DataFrame:
    """The two direction names and destinations as columns; missing ones are null."""
    columns = {}
    for array, prefix in (
        ("direction_names", "direction_name"),
        ("direction_destinations", "direction_destination"),
    ):
        for position in (0, 1):
            columns[f"{prefix}_{position + 1}"] = F.get(array, F.lit(position))
    return rows.withColumns(columns).drop("direction_names", "direction_destinations")


def cast_columns(rows: DataFrame, casts: dict[str, str]) -> DataFrame:
    """Cast in place; a value that does not fit its type becomes null."""
    return rows.withColumns({name: F.col(name).try_cast(kind) for name, kind in casts.items()})


def clean(rows: DataFrame, entity: Entity) -> DataFrame:
    """Bronze rows to typed silver columns.

    Repeats are removed on the raw values, before the casts, as two raw values
    may become one after casting and still are two records.
    """
    out = business_columns(rows)
    if entity.split_directions:
        out = split_directions(out)
    if entity.drop_repeats:
        out = out.distinct()
    return cast_columns(out, entity.casts)
