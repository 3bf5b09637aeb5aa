"""JSON:API pieces whose shape varies: ``data`` may be a list, an object or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ID_LIST = "array<struct<id:string>>"


def _is_list(data: Column) -> Column:
    return data.startswith("[")


def related_id(data: Column) -> Column:
    """Id of a to-one relationship, from the JSON text of its ``data``."""
    return F.when(~_is_list(data), F.get_json_object(data, "$.id"))


def related_ids(data: Column) -> Column:
    """Non-empty ids of a to-many relationship; null when it is to-one or empty."""
    items = F.from_json(data, _ID_LIST)
    ids = F.transform(items, lambda item: item["id"])
    return F.when(
        _is_list(data) & (F.size(items) > 0),
        F.filter(ids, lambda value: value.isNotNull() & (value != "")),
    )


def distinct_ids(entities: Column, field: str) -> Column:
    """Sorted distinct non-empty ids of ``field`` over a struct array; null if none."""
    ids = F.array_distinct(
        F.filter(
            F.transform(entities, lambda e: e[field]),
            lambda value: value.isNotNull() & (value != ""),
        )
    )
    return F.when(F.size(ids) > 0, F.array_sort(ids))
