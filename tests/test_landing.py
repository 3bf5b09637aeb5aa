from __future__ import annotations

import json

from pyspark.sql import functions as F

from documents import land, record, route, stop, trip
from headway.operators.shape import flatten_documents
from headway.schemas import ENTITIES, ROUTES, STOPS, TRIPS
from headway.sources.landing import read_batch, write_documents, write_grouped

BATCH, OTHER = "20260118180711", "20260118190711"


def _read(spark, root, entity, batch=BATCH, **options):
    return flatten_documents(read_batch(spark, str(root), entity, batch, **options), entity)


def test_multi_line_document_of_one_batch(spark, tmp_path):
    land(tmp_path, "routes", BATCH, [route("Red"), route("Blue", names=("Out",), ends=None)])
    land(tmp_path, "routes", OTHER, [route("Late")])
    got = {r["id"]: r for r in _read(spark, tmp_path, ROUTES).collect()}
    assert set(got) == {"Red", "Blue"}
    assert got["Red"]["direction_names"] == ["Out", "In"] and got["Red"]["agency_id"] == "1"
    assert got["Blue"]["direction_names"] == ["Out"] and got["Blue"]["direction_destinations"] is None
    assert got["Red"]["source_file"] == f"routes_{BATCH}.json"


def test_absent_and_null_relationships(spark, tmp_path):
    bare = {"id": "bare", "attributes": {"name": "bare"}}
    null = record("null", {"name": "null"}, zone=None, parent_station={"data": None})
    land(tmp_path, "stops", BATCH, [stop("full", address="1 Main St"), bare, null])
    got = {r["id"]: r for r in _read(spark, tmp_path, STOPS).collect()}
    assert got["full"]["address"] == "1 Main St" and got["full"]["latitude"] == 42.1234567
    assert all(got[i]["zone_id"] is None and got[i]["parent_station_id"] is None for i in got)
    assert got["bare"]["latitude"] is None


def test_documents_without_records_give_no_rows(spark, tmp_path):
    land(tmp_path, "trips", BATCH, [], group="Empty")
    land(tmp_path, "trips", BATCH, None, group="Null")
    land(tmp_path, "trips", BATCH, [trip("1", "Red")], group="Red")
    assert [r["id"] for r in _read(spark, tmp_path, TRIPS).collect()] == ["1"]


def test_per_route_files_are_one_relation(spark, tmp_path):
    land(tmp_path, "trips", BATCH, [trip("1", "Red"), trip("2", "Red")], group="Red")
    land(tmp_path, "trips", BATCH, [trip("3", "CR-Fitchburg")], group="CR-Fitchburg")
    land(tmp_path, "trips", OTHER, [trip("4", "Red")], group="Red")
    got = sorted((r["id"], r["source_file"]) for r in _read(spark, tmp_path, TRIPS).collect())
    red, fitchburg = f"trips_Red_{BATCH}.json", f"trips_CR-Fitchburg_{BATCH}.json"
    assert got == [("1", red), ("2", red), ("3", fitchburg)]


def test_written_documents_read_back_and_replace_themselves(spark, tmp_path):
    for _ in range(2):
        text = [(n, json.dumps({"data": [stop(f"s{n}{i}") for i in range(3)]}, indent=1)) for n in range(4)]
        write_documents(spark.createDataFrame(text, "page int, value string"), str(tmp_path), "stops", BATCH)
    got = _read(spark, tmp_path, STOPS)
    assert got.count() == 12
    assert {r[0] for r in got.select("source_file").distinct().collect()} == {f"stops_{BATCH}.json"}


def test_fan_out_by_group(spark, tmp_path):
    rows = [("Red", i) for i in range(20)] + [("A/B c", 20), ("Blue", 21)]
    text = [(g, json.dumps({"data": [trip(str(i), g)]})) for g, i in rows]
    documents = spark.createDataFrame(text, "`group` string, value string")
    write_grouped(documents, str(tmp_path), "trips", BATCH)
    got = _read(spark, tmp_path, TRIPS, lines=True)
    assert got.count() == 22
    files = got.groupBy("route_id").agg(F.collect_set("source_file").alias("f")).collect()
    assert {r["route_id"]: r["f"] for r in files} == {g: [f"trips_{g}_{BATCH}.json"] for g in ("Red", "A/B c", "Blue")}


def test_every_entity_has_an_explicit_document_type(spark):
    for entity in ENTITIES.values():
        empty = spark.createDataFrame([], f"{entity.document_ddl}, source_file string")
        assert flatten_documents(empty, entity).columns == [*entity.columns, "source_file"]
