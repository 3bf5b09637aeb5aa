"""The snapshot jobs end to end on hand-written documents."""

from __future__ import annotations

import shutil
from datetime import date, datetime, timezone
from decimal import Decimal

import pytest

from documents import call, land, pattern, route, stop, trip
from headway.plans.layers import Lake
from headway.plans.snapshots import load_bronze, load_gold, load_silver, run
from headway.schemas import ROUTE_PATTERNS, ROUTES, SCHEDULES, STOPS, TRIPS

B1, B2 = "20260118060000", "20260119060000"
T1, T2 = (datetime(2026, 1, d, 7, tzinfo=timezone.utc) for d in (18, 19))


def _land_first(root):
    land(root, "routes", B1, [route("Red"), route("Blue", names=("Out",), ends=("East",))])
    land(root, "route_patterns", B1, [pattern("p1", "Red"), pattern("p2", "Blue", direction=1)])
    land(root, "stops", B1, [stop("70061"), stop("70063")])
    shared = trip("200", "Blue", direction=1, pattern_id="p2", headsign="East")
    land(root, "trips", B1, [trip("100", "Red"), trip("ADDED-1", "Red"), shared], group="Red")
    land(root, "trips", B1, [shared], group="Blue")
    red = [
        call("c1", "100", "Red", None, "2026-01-17T23:50:00-05:00", sequence=1),
        call("c2", "100", "Red", "2026-01-18T00:20:30-05:00", "2026-01-18T00:21:00-05:00", sequence=2),
        call("c3", "100", "Red", "2026-01-18T00:40:30-05:00", None, stop_id=None, sequence=3),
        call("c4", "ADDED-1", "Red", None, "2026-01-18T10:00:00-05:00"),
    ]
    blue = [
        call("c5", "200", "Blue", "2026-01-18T09:10:00-05:00", "2026-01-18T09:00:00-05:00", direction=1),
        call("c6", "300", "Green", "2026-01-16T09:10:00-05:00", None, direction=None),
        call("c7", "0100", "Red", "2026-01-16T09:10:00-05:00", "2026-01-16T09:00:00-05:00"),
    ]
    land(root, "schedules", B1, red, group="Red")
    land(root, "schedules", B1, [*blue, red[0]], group="Blue")


def _land_second(root):
    land(root, "routes", B2, [route("Red", long_name="Red Line"), route("Green")])
    land(root, "route_patterns", B2, [pattern("p1", "Red")])
    land(root, "stops", B2, [stop("70061", name="Davis"), stop("70063")])
    land(root, "trips", B2, [trip("100", "Red"), trip("400", "Red", headsign="Late")], group="Red")
    later = [
        call("c8", "400", "Red", "2026-01-19T09:30:00-05:00", "2026-01-19T09:00:00-05:00"),
        call("c4", "ADDED-1", "Red", "2026-01-18T11:00:00-05:00", "2026-01-18T10:00:00-05:00"),
    ]
    land(root, "schedules", B2, later, group="Red")


def _copy(spark, source, target):
    """A lake of its own for a test that changes it; tables do not name their root."""
    shutil.copytree(source, target)
    return Lake(spark, str(target), key_bucket_count=2)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """After the first load."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("first") / "lake"), key_bucket_count=2)
    _land_first(lake.landing)
    assert set(run(lake, B1, full=True, run_ts=T1).values()) == {None}
    return lake


@pytest.fixture(scope="module")
def merged(spark, loaded, tmp_path_factory):
    """After the first load and one incremental batch."""
    lake = _copy(spark, loaded.root, tmp_path_factory.mktemp("second") / "lake")
    _land_second(lake.landing)
    counts = run(lake, B2, full=False, run_ts=T2)
    assert counts["silver.trips"] == {"rows": 2, "rows_without_key": 0}
    return lake


def _by(rows, key):
    return {r[key]: r for r in rows.collect()}


def test_first_load(loaded):
    lake = loaded
    bronze = lake.bronze(TRIPS).read()
    assert sorted(r["id"] for r in bronze.collect()) == ["100", "200", "200", "ADDED-1"]
    assert bronze.columns == [*TRIPS.columns, "source_file", "created_ts", "updated_ts", "scd_key"]
    trips = lake.silver(TRIPS).read()
    assert sorted(((r["id"], r["headsign"]) for r in trips.collect()), key=repr) == [
        (100, "North"), (200, "East"), (None, "North")
    ]
    assert dict(trips.dtypes)["id"] == "bigint" and dict(trips.dtypes)["direction_id"] == "int"
    blue = _by(lake.silver(ROUTES).read(), "id")["Blue"]
    assert (blue["direction_name_1"], blue["direction_name_2"], blue["agency_id"]) == ("Out", None, 1)
    stops = _by(lake.silver(STOPS).read(), "id")
    assert stops["70061"]["latitude"] == Decimal("42.123457")
    assert lake.silver(SCHEDULES).read().count() == 7


def test_first_gold_build(loaded):
    lake = loaded
    gold = lake.trips_metrics.read()
    assert "created_ts" not in gold.columns
    facts = _by(gold, "trip_id")
    red = facts["100"]
    assert red["service_date"] == date(2026, 1, 18)
    assert (red["num_stops"], red["duration_minutes"]) == (2, 50.5)
    assert (red["route_pattern_name"], red["trip_headsign"], red["direction_destination"]) == ("A - B", "North", "North")
    added = facts["ADDED-1"]
    assert added["trip_headsign"] is None and added["route_long_name"] == "Line" and added["arrival_time"] is None
    assert added["duration_minutes"] is None
    blue = facts["200"]
    assert blue["direction_destination"] is None and blue["duration_minutes"] == 10.0
    green = facts["300"]
    assert green["service_date"] is None and green["route_long_name"] is None and green["direction_destination"] is None
    # A zero-padded id is the same trip number.
    assert facts["0100"]["trip_headsign"] == "North"


def test_incremental_batch(merged):
    lake = merged
    routes = _by(lake.bronze(ROUTES).read(), "id")
    assert set(routes) == {"Red", "Blue", "Green"}
    assert routes["Red"]["source_file"] == f"routes_{B2}.json" and routes["Blue"]["source_file"] == f"routes_{B1}.json"
    assert lake.bronze(TRIPS).read().count() == 6

    silver = _by(lake.silver(ROUTES).read(), "id")
    assert silver["Red"]["long_name"] == "Red Line"
    assert silver["Red"]["created_ts"] < silver["Red"]["updated_ts"]
    assert silver["Blue"]["created_ts"] == silver["Blue"]["updated_ts"]
    stops = _by(lake.silver(STOPS).read(), "id")
    # 70063 was delivered again unchanged: bronze moves, silver does not.
    assert stops["70063"]["updated_ts"] == stops["70063"]["created_ts"]
    assert stops["70061"]["name"] == "Davis"

    gold = _by(lake.trips_metrics.read(), "trip_id")
    assert set(gold) == {"100", "ADDED-1", "200", "300", "0100", "400"}
    assert gold["400"]["trip_headsign"] == "Late" and gold["400"]["created_ts"] is not None
    assert gold["ADDED-1"]["duration_minutes"] == 60.0
    assert gold["100"]["route_long_name"] == "Red Line"
    # Outside the window and undated rows stay as they were, audit columns unknown.
    assert gold["0100"]["route_long_name"] == "Line" and gold["0100"]["created_ts"] is None
    assert gold["300"]["created_ts"] is None


def test_repeating_a_batch_changes_no_keyed_row(spark, merged, tmp_path):
    lake = _copy(spark, merged.root, tmp_path / "lake")
    entities = (ROUTES, ROUTE_PATTERNS, STOPS, SCHEDULES)
    once = {e.name: sorted(lake.silver(e).read().collect(), key=repr) for e in entities}
    gold = sorted(lake.trips_metrics.read().collect(), key=repr)
    run(lake, B2, full=False, run_ts=T2)
    assert {e.name: sorted(lake.silver(e).read().collect(), key=repr) for e in entities} == once
    assert sorted(lake.trips_metrics.read().collect(), key=repr) == gold


def test_incremental_equals_rebuild_inside_the_window(spark, merged, tmp_path):
    lake = _copy(spark, merged.root, tmp_path / "lake")
    columns = [c for c in lake.trips_metrics.read().columns if not c.endswith("_ts")]
    incremental = lake.trips_metrics.read().where("service_date >= DATE '2026-01-18'").select(*columns).collect()
    load_gold(lake, B2, full=True)
    rebuilt = lake.trips_metrics.read().where("service_date >= DATE '2026-01-18'").select(*columns).collect()
    assert sorted(incremental, key=repr) == sorted(rebuilt, key=repr)


def test_batch_on_the_first_of_a_month(spark, loaded, tmp_path):
    lake = _copy(spark, loaded.root, tmp_path / "lake")
    first = "20260201060000"
    land(lake.landing, "routes", first, [route("Red", long_name="February")])
    load_bronze(lake, ROUTES, first, full=False, run_ts=T2)
    load_silver(lake, ROUTES, first, full=False, run_ts=T2)
    load_gold(lake, first, full=False, run_ts=T2)
    assert _by(lake.silver(ROUTES).read(), "id")["Red"]["long_name"] == "February"
    assert lake.trips_metrics.read().count() == 5


def test_window_facts_do_not_depend_on_the_broadcast_limit(spark, merged, tmp_path):
    lake = _copy(spark, merged.root, tmp_path / "lake")
    narrowed = sorted(lake.trips_metrics.read().collect(), key=repr)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert load_gold(lake, B2, full=False, run_ts=T2) is None
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(lake.trips_metrics.read().collect(), key=repr) == narrowed


def test_audited_first_build(spark, loaded, tmp_path):
    lake = _copy(spark, loaded.root, tmp_path / "lake")
    load_gold(lake, B1, full=True, run_ts=T1, audited=True)
    assert lake.trips_metrics.read().where("created_ts IS NULL").count() == 0
