"""The physical plans are the ones intended."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from headway.operators import live
from headway.operators.trip_facts import rollup_schedules
from headway.session import prepare
from workload import batch, realtime

FOLDER = "/root/testdata/sf0.001"
CORE = {**batch.QUERIES, **realtime.QUERIES}
EAGER = {  # write before they read
    "landing_scan", "landing_glob_scan", "batch_marker", "stream_envelope", "stream_incremental", "stream_boundary",
    "poll_run_counters", "dead_letters", "stream_route_table", "gold_overwrite_where", "gold_rollup_batches",
}


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CORE) - EAGER))
def test_no_python_rows_and_no_cross_joins(spark, name):
    plan = _plan(entry.queries()[name](spark, FOLDER))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert word not in plan


def test_rollup_aggregates_before_its_shuffle(spark):
    plan = _plan(entry.queries()["schedule_rollup"](spark, FOLDER))
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(trip_id")


def test_scans_read_only_what_the_facts_need(spark):
    plan = _plan(entry.queries()["trips_metrics"](spark, FOLDER))
    schemas = re.findall(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all("l_tax" not in s and "l_comment" not in s for s in schemas)
    orders = re.findall(r"orders\.parquet.*?ReadSchema: struct<([^>]*)>", plan)
    assert orders and all("o_totalprice" not in s for s in orders)


def test_silver_columns_unused_by_gold_are_pruned(spark, tmp_path):
    path = f"{tmp_path}/schedules"
    spark.createDataFrame(
        [],
        "id string, arrival_time timestamp, departure_time timestamp, direction_id int, pickup_type bigint, "
        "stop_headsign string, route_id string, stop_id string, trip_id string, scd_key string",
    ).write.parquet(path)
    plan = _plan(rollup_schedules(prepare(spark).read.parquet(path)))
    assert "scd_key" not in plan and "stop_headsign" not in plan and "partial_count(stop_id" in plan


def test_batch_filter_reaches_parquet(spark, tmp_path):
    from headway.operators.shape import in_batch

    path = f"{tmp_path}/bronze"
    spark.createDataFrame([("a", "routes_1.json")], "id string, source_file string").write.parquet(path)
    assert "StringContains(source_file,20240101000000)" in _plan(in_batch(spark.read.parquet(path), "20240101000000"))


def test_a_small_source_exchanges_only_matched_target_keys(spark, tmp_path):
    from headway.operators.upsert import matched_keys

    columns = ["CAST(id AS STRING) AS id", "'a' AS value", "current_timestamp() AS created_ts", "'h' AS scd_key"]
    spark.range(100_000).selectExpr(*columns).write.parquet(f"{tmp_path}/target")
    spark.range(50).selectExpr(*columns).write.parquet(f"{tmp_path}/source")
    read = prepare(spark).read
    plan = _plan(matched_keys(read.parquet(f"{tmp_path}/target"), read.parquet(f"{tmp_path}/source"), ["id"]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(s == "id:string,scd_key:string" for s in schemas)


def test_live_text_is_parsed_once(spark):
    rows = spark.createDataFrame([("vehicles", "{}")], "endpoint string, record string")
    plan = _plan(live.poll_messages(live.parse(rows), {"vehicles": None}, "now"))
    assert plan.count("from_json(StructField(id") == 1 and "Exchange" not in plan


def test_an_overwrite_reads_only_the_partition_it_cuts(spark, tmp_path, monkeypatch):
    from datetime import date

    from headway.operators.replace_window import from_day_by_month, overwrite_where, split_partitions
    from headway.sources.layer import LayerTable, Partitioning

    table = LayerTable(spark, f"{tmp_path}/facts", Partitioning("service_month"))
    days = ["2024-01-31", "2024-02-01", "2024-02-10", "2024-02-29", "2024-03-01", None]
    rows = spark.createDataFrame([(n, d) for n, d in enumerate(days)], "id int, d string")
    rows = rows.selectExpr("id", "CAST(d AS DATE) AS service_date", "TRUNC(CAST(d AS DATE), 'month') AS service_month")
    table.overwrite(rows)
    scope = from_day_by_month(date(2024, 2, 10))
    assert split_partitions(table, scope) == ({"2024-03-01"}, {"2024-02-01"})
    before = set(table._state()[0])
    asked, read = [], LayerTable.read
    monkeypatch.setattr(LayerTable, "read", lambda self, only=None: asked.append(only) or read(self, only))
    overwrite_where(table, rows.where("id = 3").withColumn("id", rows["id"] + 100), scope)
    assert [sorted(a) for a in asked if a] == [["2024-02-01"]] and None not in asked
    monkeypatch.undo()
    assert sorted(r["id"] for r in table.read().collect()) == [0, 1, 5, 103]
    kept = {f for f in table._state()[0] if f in before}
    assert {f.rsplit("=")[-1] for f in kept} == {"2024-01-01", "__HIVE_DEFAULT_PARTITION__"}


def test_a_scope_that_ends_at_a_partition_reads_nothing(spark, tmp_path):
    from datetime import date

    from headway.operators.replace_window import from_day, overwrite_where, split_partitions
    from headway.sources.layer import LayerTable, Partitioning

    table = LayerTable(spark, f"{tmp_path}/facts", Partitioning("service_date"))
    rows = spark.sql("SELECT id, DATE_ADD(DATE'2024-01-01', CAST(id AS INT)) AS service_date FROM range(4)")
    table.overwrite(rows)
    assert split_partitions(table, from_day(date(2024, 1, 3))) == ({"2024-01-03", "2024-01-04"}, set())
    overwrite_where(table, rows.where("id = 2"), from_day(date(2024, 1, 3)))
    assert sorted(r["id"] for r in table.read().collect()) == [0, 1, 2]
