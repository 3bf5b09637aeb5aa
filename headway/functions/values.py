"""Value helpers: row digest, first non-empty text, offset timestamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# An instant needs an explicit zone; text without one cannot be ordered
# against a UTC cutoff and counts as unreadable.
_INSTANT_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}.*(Z|[+-]\d{2}:\d{2})$"


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 over the text forms of ``columns`` joined by ``_``, null as empty.

    The format is fixed: digests must agree with those in tables already stored.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("_", *parts), 256)


def first_filled(*texts: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def instant_of(text: Column) -> Column:
    """ISO-8601 text with zone as an instant; anything else is null."""
    return F.when(text.rlike(_INSTANT_PATTERN), text.try_cast("timestamp"))
