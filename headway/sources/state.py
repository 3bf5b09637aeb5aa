"""Run state: the id of the latest landed batch and what the live poll remembers."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.files import Files

# Place and field of the marker other landing writers leave.
_MARKER = "config/last_execution_metadata.json"
_FIELD = "last_ts"


def save_batch_id(spark: SparkSession, landing: str, batch_id: str) -> None:
    Files(spark, landing).write(_MARKER, json.dumps({_FIELD: batch_id}))


def load_batch_id(spark: SparkSession, landing: str) -> str:
    return json.loads(Files(spark, landing).read(_MARKER))[_FIELD]


class PollState:
    """What the live poll remembers: cutoffs, sent changes beyond them, unsent messages, counters, rejected text.

    One small file per finished micro-batch holds the cutoffs; tables hold the
    rest, a folder per micro-batch. A micro-batch reads the state of the ones
    *before* it and overwrites its own, so running it again after a crash sees
    what it saw the first time and counts once. The state's folder belongs to one
    streaming checkpoint, whose epochs it counts in.
    """

    KNOWN = "endpoint string, id string, changed_at timestamp"
    PENDING = "topic string, key string, value string, changed_at timestamp"
    COUNTERS = "endpoint string, filter_route string, fetched long, sent long, filtered_out long, rejected long"
    DEAD_LETTERS = "endpoint string, reason string, text string"

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._files = Files(spark, folder)

    def _epochs(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self._files.names() if n.endswith(".json")]

    def _latest(self, epoch: int) -> int | None:
        return max((e for e in self._epochs() if e < epoch), default=None)

    def before(self, epoch: int) -> dict[str, datetime]:
        """Cutoffs by endpoint; empty when there is no earlier readable state (full backfill)."""
        latest = self._latest(epoch)
        if latest is None:
            return {}
        try:
            saved = json.loads(self._files.read(f"{latest:010d}.json"))
        except ValueError:
            return {}
        return {k: datetime.fromisoformat(v) for k, v in saved.items()}

    def _path(self, table: str, epoch: int) -> str:
        return f"{table}/epoch={epoch:010d}"

    def _carried(self, table: str, schema: str, epoch: int) -> DataFrame:
        latest = self._latest(epoch)
        if latest is None or not self._files.exists(self._path(table, latest)):
            # Known to be empty before anything runs: a join with it is planned away.
            return self._spark.createDataFrame([], schema).where(F.lit(False))
        return self._spark.read.schema(schema).parquet(f"{self._files.root}/{self._path(table, latest)}")

    def known(self, epoch: int) -> DataFrame:
        """Changes sent by earlier micro-batches that lie after their endpoint's cutoff."""
        return self._carried("known", self.KNOWN, epoch)

    def pending(self, epoch: int) -> DataFrame:
        """Messages of earlier micro-batches whose topic did not take them."""
        return self._carried("pending", self.PENDING, epoch)

    def write(self, table: str, epoch: int, rows: DataFrame) -> None:
        """Rows of one micro-batch, in place of those an earlier try wrote."""
        rows.write.mode("overwrite").parquet(f"{self._files.root}/{self._path(table, epoch)}")

    def _history(self, table: str, schema: str) -> DataFrame:
        if not self._files.names(table):
            return self._spark.createDataFrame([], f"{schema}, epoch int")
        return self._spark.read.schema(f"{schema}, epoch int").parquet(f"{self._files.root}/{table}")

    def counters(self) -> DataFrame:
        """Every micro-batch's counters per endpoint and filter route."""
        return self._history("counters", self.COUNTERS)

    def dead_letters(self) -> DataFrame:
        """Every text that could not be read as a record, and why."""
        return self._history("dead_letters", self.DEAD_LETTERS)

    def save(
        self,
        epoch: int,
        cutoffs: dict[str, datetime],
        known: DataFrame | None = None,
        pending: DataFrame | None = None,
    ) -> None:
        """Finish a micro-batch: its tables first, then the file that makes them count."""
        for table, rows in (("known", known), ("pending", pending)):
            if rows is not None:
                self.write(table, epoch, rows)
        body = {k: v.astimezone(timezone.utc).isoformat() for k, v in cutoffs.items()}
        self._files.write(f"{epoch:010d}.json", json.dumps(body))
        for old in sorted(e for e in self._epochs() if e < epoch)[:-1]:
            for name in (f"{old:010d}.json", self._path("known", old), self._path("pending", old)):
                self._files.remove(name)
