"""Routes and known changes are joined to the staged outcome of a poll, and only where they can decide something."""

from __future__ import annotations

import gzip
from datetime import datetime, timezone

from pyspark.sql import functions as F

from headway.operators import live
from headway.sources.state import PollState
from workload import realtime

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
OUTCOME = "endpoint string, key string, value string, filter_route string, changed_at timestamp, status string"


def _outcome(spark):
    rows = [
        ("vehicles", "a", "m", None, NOON, "sent"),
        ("vehicles", "b", "m", None, None, "sent"),
        ("vehicles", "c", None, None, NOON, "filtered_out"),
        ("predictions", "a", "m", "Red", NOON, "sent"),
        ("predictions", "d", "m", "Blue", NOON, "sent"),
        ("predictions", "e", "m", None, NOON, "sent"),
        ("predictions", None, "text", None, None, "rejected"),
        (None, "f", "m", None, NOON, "sent"),
    ]
    return spark.createDataFrame(rows, OUTCOME)


def test_a_table_of_routes_keeps_what_the_route_filter_keeps(spark):
    wanted = spark.createDataFrame([("Red",), (None,)], "route string")
    kept = live.of_wanted_routes(_outcome(spark), wanted).collect()
    assert sorted((r["endpoint"], r["key"] or "") for r in kept) == [
        ("predictions", ""), ("predictions", "a"), ("vehicles", "a"), ("vehicles", "b"), ("vehicles", "c")
    ]


def test_known_changes_lose_their_message(spark):
    known = spark.createDataFrame([("vehicles", "a", NOON), ("vehicles", "b", NOON)] * 2, PollState.KNOWN)
    got = {(r["endpoint"], r["key"]): (r["status"], r["value"]) for r in live.not_known(_outcome(spark), known).collect()}
    before = {(r["endpoint"], r["key"]): (r["status"], r["value"]) for r in _outcome(spark).collect()}
    assert got == before | {("vehicles", "a"): ("filtered_out", None)}


def test_nothing_is_shuffled_for_a_state_that_is_empty(spark, tmp_path):
    rows = _outcome(spark)
    rows.write.parquet(f"{tmp_path}/rows")
    state = PollState(spark, f"{tmp_path}/state")
    joined = live.not_known(spark.read.schema(rows.schema).parquet(f"{tmp_path}/rows"), state.known(0))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_lines_land_compressed_by_endpoint(spark, tmp_path):
    lines = spark.range(6).select(
        F.element_at(F.array(*map(F.lit, ("vehicles", "alerts", "predictions"))), (F.col("id") % 3 + 1).cast("int")).alias("endpoint"),
        F.col("id").cast("string").alias("record"),
    )
    realtime._land(lines, str(tmp_path))
    landed = sorted((f.parent.name, gzip.decompress(f.read_bytes()).decode().split()) for f in tmp_path.glob("in/*/*.gz"))
    merged = {name: sorted(v for n, part in landed if n == name for v in part) for name, _ in landed}
    assert {k: v for k, v in merged.items() if v} == {"endpoint=alerts": ["1", "4"], "endpoint=predictions": ["2", "5"], "endpoint=vehicles": ["0", "3"]}
