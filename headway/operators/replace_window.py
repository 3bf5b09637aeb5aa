"""Predicate-scoped overwrite: the rows matching a predicate are replaced as a set."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.sources.layer import LayerTable


def outside(predicate: Column) -> Column:
    """Complement of ``predicate`` that also holds where it is unknown."""
    return ~F.coalesce(predicate, F.lit(False))


def replace_where(old: DataFrame, new: DataFrame, predicate: Column) -> DataFrame:
    """``old`` outside the predicate plus all of ``new``; columns may be added by either."""
    return old.where(outside(predicate)).unionByName(new, allowMissingColumns=True)


@dataclass(frozen=True)
class Scope:
    """Which rows an overwrite replaces, and what a partition's value tells about its rows.

    ``whole``: every row of the partition is replaced. ``touched``: some may be.
    Both see the partition column alone; where they are unknown, as for the null
    partition, nothing is replaced.
    """

    rows: Column
    whole: Column
    touched: Column


def from_day(day: date, column: str = "service_date") -> Scope:
    """Rows dated ``day`` or later, in a table partitioned by that date."""
    since = F.col(column) >= F.lit(day)
    return Scope(since, since, since)


def from_day_by_month(day: date, column: str = "service_date", month: str = "service_month") -> Scope:
    """Rows dated ``day`` or later, in a table partitioned by the first day of their month."""
    first = F.col(month)
    return Scope(F.col(column) >= F.lit(day), first >= F.lit(day), F.add_months(first, 1) > F.lit(day))


def split_partitions(table: LayerTable, scope: Scope) -> tuple[set[str], set[str]]:
    """The partition values the scope covers wholly, and those it cuts through; the rest stays."""
    name = table.layout.name
    values = [(v,) for v in table.partitions()]
    if not values:
        return set(), set()
    known = table.spark.createDataFrame(values, "value string")
    typed = known.withColumn(name, F.col("value").cast(table.read(only=()).schema[name].dataType))
    told = typed.select("value", F.coalesce(scope.whole, F.lit(False)), F.coalesce(scope.touched, F.lit(False))).collect()
    whole = {value for value, is_whole, _ in told if is_whole}
    return whole, {value for value, _, is_touched in told if is_touched} - whole


def overwrite_where(table: LayerTable, new: DataFrame, scope: Scope) -> None:
    """Replace the table's rows in the scope by ``new``.

    Partitions wholly in it are dropped without being read, those without new rows
    included; a partition that it cuts is rewritten; no other is read or written.
    """
    whole, cut = split_partitions(table, scope)
    rows = replace_where(table.read(only=cut), new, scope.rows)
    table.replace(rows, drop=lambda value: value in whole or value in cut)
