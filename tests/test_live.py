from __future__ import annotations

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from headway.operators import live

CUTOFF = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)
POLLED = datetime(2024, 1, 2, tzinfo=timezone.utc)

VEHICLE = {
    "id": "v1",
    "type": "vehicle",
    "attributes": {
        "latitude": 42.5,
        "bearing": 90,
        "label": "1700",
        "speed": None,
        "severity": 3,
        "updated_at": "2024-01-01T12:00:01Z",
        "carriages": [{"label": "a"}],
    },
    "relationships": {
        "trip": {"data": {"id": "T1", "type": "trip"}},
        "stop": {"data": [{"id": "S1"}, {"id": ""}, {"id": "S2"}]},
        "route": {"data": None},
        "vehicle": {"data": {"id": "never"}},
    },
}
PREDICTION = {
    "id": "p1",
    "type": "prediction",
    "attributes": {"arrival_time": "2024-01-01T07:00:00-05:00", "stop_sequence": 4, "label": "no"},
    "relationships": {
        "route": {"data": {"id": "Red"}},
        "vehicle": {"data": {"id": "V9"}},
        "schedule": {"data": []},
        "stop": {},
    },
}
ALERT = {
    "id": "a1",
    "type": "alert",
    "attributes": {
        "severity": 7,
        "header": "Delay",
        "active_period": [{"start": "2024-01-01T00:00:00-05:00", "end": None}],
        "informed_entity": [{"route": "Red", "stop": "S2"}, {"route": "Red", "stop": "S1"}, {"trip": ""}, {}],
    },
    "relationships": {"trip": {"data": {"id": "never"}}},
}


def _parsed(spark, *records):
    rows = [(endpoint, json.dumps(record)) for endpoint, record in records]
    return live.parse(spark.createDataFrame(rows, "endpoint string, record string"))


def _values(messages):
    return {r["key"]: json.loads(r["value"]) for r in messages.collect()}


def test_messages_hold_published_fields_only(spark):
    parsed = _parsed(spark, ("vehicles", VEHICLE), ("predictions", PREDICTION), ("alerts", ALERT))
    got = _values(live.poll_messages(parsed, {}, POLLED, ["Red"], source="feed"))
    common = {"source": "feed", "polled_at_utc": "2024-01-02T00:00:00+00:00"}
    assert got["v1"] == {
        **common, "endpoint": "/vehicles", "record_type": "vehicle", "record_id": "v1", "latitude": 42.5,
        "bearing": 90, "label": "1700", "speed": None, "updated_at": "2024-01-01T12:00:01Z", "trip_id": "T1", "stop_ids": ["S1", "S2"],
    }
    assert got["p1"] == {
        **common, "endpoint": "/predictions", "record_type": "prediction", "record_id": "p1", "filter_route": "Red",
        "arrival_time": "2024-01-01T07:00:00-05:00", "stop_sequence": 4, "route_id": "Red", "vehicle_id": "V9",
    }
    assert got["a1"] == {
        **common, "endpoint": "/alerts", "record_type": "alert", "record_id": "a1", "severity": 7, "header": "Delay",
        "active_period": [{"start": "2024-01-01T00:00:00-05:00", "end": None}], "route_ids": ["Red"], "stop_ids": ["S1", "S2"],
    }


def test_message_fields_keep_their_order(spark):
    value = live.poll_messages(_parsed(spark, ("vehicles", VEHICLE)), {}, POLLED).first()["value"]
    assert list(json.loads(value))[:5] == ["source", "endpoint", "record_type", "record_id", "polled_at_utc"]


@pytest.mark.parametrize(
    ("updated", "created", "kept"),
    [
        ("2024-01-01T12:00:01Z", None, True),
        ("2024-01-01T12:00:00Z", None, False),
        ("2024-01-01T07:00:00-05:00", None, False),
        ("2024-01-01T07:00:01-05:00", None, True),
        ("2024-01-01T11:00:00Z", "2024-01-01T13:00:00Z", False),
        ("", "2024-01-01T11:00:00Z", False),
        ("", "2024-01-01T13:00:00Z", True),
        (None, "2024-01-01T11:00:00Z", False),
        (None, None, True),
        ("soon", "2024-01-01T11:00:00Z", True),
        ("2024-01-01T11:00:00", None, True),
    ],
)
def test_cutoff(spark, updated, created, kept):
    attributes = {k: v for k, v in (("updated_at", updated), ("created_at", created)) if v is not None}
    parsed = _parsed(spark, ("vehicles", {"id": "v", "attributes": attributes}))
    assert parsed.where(live.is_news({"vehicles": CUTOFF})).count() == int(kept)
    assert parsed.where(live.is_news({"alerts": CUTOFF})).count() == 1
    assert parsed.where(live.is_news({})).count() == 1


def test_route_filter_is_for_predictions(spark):
    def on(route, id_):
        return {"id": id_, "relationships": {"route": {"data": {"id": route}}}}

    parsed = _parsed(
        spark,
        ("predictions", on("Red", "1")),
        ("predictions", on("Blue", "2")),
        ("predictions", {"id": "3"}),
        ("vehicles", on("Blue", "4")),
        ("alerts", {"id": "5"}),
    )

    def kept(routes):
        rows = live.filter_routes(parsed, routes).select("id", "filter_route").collect()
        return sorted((r["id"], r["filter_route"]) for r in rows)

    assert kept([]) == [("1", "Red"), ("4", None), ("5", None)]
    assert kept(["Blue", "Green"]) == [("2", "Blue"), ("4", None), ("5", None)]


def test_unreadable_records_do_not_fail_the_poll(spark):
    rows = [("vehicles", "not json"), ("vehicles", '{"id":"v","attributes":{"latitude":"north"}}')]
    parsed = live.parse(spark.createDataFrame(rows, "endpoint string, record string"))
    got = live.flatten(live.filter_routes(parsed)).select("record_id", "latitude").collect()
    assert [tuple(r) for r in got] == [(None, None), ("v", None)]


def test_counters_add_up(spark):
    late = {"id": "v2", "attributes": {"updated_at": "2024-01-01T00:00:00Z"}}
    parsed = _parsed(spark, ("vehicles", VEHICLE), ("vehicles", late), ("predictions", PREDICTION), ("predictions", {}))
    got = {(r["endpoint"], r["filter_route"]): r[2:] for r in live.count_poll(live.judge(parsed, {"vehicles": CUTOFF})).collect()}
    assert got == {("vehicles", None): (2, 1, 1, 0), ("predictions", "Red"): (1, 1, 0, 0), ("predictions", None): (0, 0, 0, 1)}


def test_known_changes_are_filtered_out_by_id_and_instant(spark):
    def at(id_, updated):
        return {"id": id_, "attributes": {"updated_at": updated}}

    records = [at("a", "2024-01-01T13:00:00Z"), at("a", "2024-01-01T08:00:00-05:00"), at("a", "2024-01-01T13:00:01Z"), at("b", "2024-01-01T13:00:00Z"), at("a", None)]
    known = spark.createDataFrame([("vehicles", "a", CUTOFF.replace(hour=13)), ("alerts", "b", CUTOFF.replace(hour=13))] * 2, "endpoint string, id string, changed_at timestamp")
    judged = live.judge(_parsed(spark, *[("vehicles", r) for r in records]), {"vehicles": CUTOFF}, known=known)
    assert [r["status"] for r in judged.collect()] == ["filtered_out", "filtered_out", "sent", "sent", "sent"]


def test_values_of_other_types_reach_the_message(spark):
    odd = {"speed": "fast", "bearing": 3.5, "label": {"a": [1, None]}, "latitude": None, "direction_id": True, "updated_at": 7}
    parsed = _parsed(spark, ("vehicles", {"id": "v", "attributes": odd}))
    value = _values(live.poll_messages(parsed, {"vehicles": CUTOFF}, POLLED))["v"]
    assert {k: value[k] for k in odd} == odd and "longitude" not in value
    flat = live.flatten(live.filter_routes(parsed)).first()
    assert (flat["speed"], flat["bearing"], flat["latitude"]) == (None, None, None)


def test_routes_from_a_table(spark):
    def on(route, id_):
        return ("predictions", {"id": id_, "relationships": {"route": {"data": {"id": route}}}})

    parsed = _parsed(spark, on("Red", "1"), on("Blue", "2"), on(None, "3"), ("vehicles", {"id": "4"}), ("predictions", {}))
    routes = spark.createDataFrame([("Blue", 1), ("Blue", 2), (None, 3)], "route string, n int")

    def kept(table, **options):
        return sorted(((r["id"] or "", r["filter_route"]) for r in live.filter_routes(parsed, table, **options).collect()))

    assert kept(routes) == [("2", "Blue"), ("4", None)]
    assert kept(routes.limit(0)) == [("4", None)]
    assert kept(routes, also=~live.is_readable()) == [("", None), ("2", "Blue"), ("4", None)]


def test_endpoint_columns_match_the_flat_frame(spark):
    flat = live.flatten(live.filter_routes(_parsed(spark, ("vehicles", VEHICLE))))
    for endpoint in ("vehicles", "predictions", "alerts"):
        assert set(live.endpoint_columns(endpoint)) <= set(flat.columns)
    assert flat.select(F.size("stop_ids")).first()[0] == 2
