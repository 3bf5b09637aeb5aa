from __future__ import annotations

import hashlib
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from headway.functions import batch_ids
from headway.functions.jsonapi import related_id, related_ids
from headway.operators.live import landed_records
from headway.functions.values import first_filled, instant_of, row_digest
from headway.operators.shape import cast_columns, split_directions, stamp
from headway.sources.state import load_batch_id, save_batch_id


def test_batch_id_arithmetic_crosses_month_and_year():
    assert batch_ids.window_start("20260101000000") == date(2025, 12, 31)
    assert batch_ids.window_start("20240301120000") == date(2024, 2, 29)
    assert batch_ids.day_folder("20260118180711") == "2026/01/18"
    assert batch_ids.new_batch_id(datetime(2026, 1, 18, 18, 7, 11)) == "20260118180711"
    with pytest.raises(ValueError):
        batch_ids.day_folder("20261318180711")


def test_batch_id_columns(spark):
    rows = spark.createDataFrame(
        [("trips_Red_20240301000000.json",), ("routes_20261318180711.json",), ("notes.json",)], "source_file string"
    )
    found = rows.withColumn("batch_id", batch_ids.batch_id_in(F.col("source_file")))
    got = found.withColumns(batch_ids.day_parts(F.col("batch_id"))).orderBy("source_file").collect()
    by_file = {r["source_file"]: r for r in got}
    good = by_file["trips_Red_20240301000000.json"]
    assert (good["year"], good["month"], good["day"]) == ("2024", "03", "01")
    assert good["window_start"] == date(2024, 2, 29)
    assert by_file["routes_20261318180711.json"]["batch_ts"] is None
    assert by_file["notes.json"]["batch_id"] is None


def test_batch_marker_round_trip(spark, tmp_path):
    save_batch_id(spark, str(tmp_path), "20260118180711")
    save_batch_id(spark, str(tmp_path), "20260119180711")
    assert load_batch_id(spark, str(tmp_path)) == "20260119180711"


def test_digest_is_sha256_of_joined_text(spark):
    rows = spark.createDataFrame([(1, None, "b", datetime(2024, 1, 2, 3, 4, 5))], "a int, n string, s string, t timestamp")
    digest = rows.select(row_digest(rows.columns).alias("d")).first()["d"]
    assert digest == hashlib.sha256(b"1__b_2024-01-02 03:04:05").hexdigest()


def test_digest_covers_columns_before_the_stamp_only(spark):
    rows = spark.createDataFrame([(1, "x")], "id int, v string")
    one = stamp(rows, datetime(2024, 1, 1, tzinfo=timezone.utc), digest=True).first()
    two = stamp(rows, datetime(2025, 1, 1, tzinfo=timezone.utc), digest=True).first()
    assert one["scd_key"] == two["scd_key"] and one["created_ts"] != two["created_ts"]
    assert stamp(rows).columns == ["id", "v", "created_ts", "updated_ts"]


@pytest.mark.parametrize(
    ("text", "instant"),
    [
        ("2024-01-01T10:00:00Z", datetime(2024, 1, 1, 10)),
        ("2024-01-01T10:00:00-05:00", datetime(2024, 1, 1, 15)),
        ("2024-01-01T10:00:00.250+00:00", datetime(2024, 1, 1, 10, 0, 0, 250000)),
        ("2024-01-01T10:00:00", None),
        ("2024-01-01", None),
        ("10:00", None),
        ("soon", None),
        ("2024-13-01T10:00:00Z", None),
        (None, None),
    ],
)
def test_instants_need_a_zone(spark, text, instant):
    got = spark.createDataFrame([(text,)], "t string").select(instant_of(F.col("t")).cast("timestamp_ntz").alias("i"))
    assert got.first()["i"] == instant


def test_first_filled_skips_empty(spark):
    rows = spark.createDataFrame([("", "b"), (None, "b"), ("a", "b"), (None, "")], "x string, y string")
    got = [r[0] for r in rows.select(first_filled(F.col("x"), F.col("y"))).collect()]
    assert got == ["b", "b", "a", None]


def test_related_ids_by_shape(spark):
    data = ['{"id":"a"}', '[{"id":"a"},{"id":""},{"id":null},{"id":"b"}]', "[]", '[{"id":""}]', None, "{}"]
    rows = spark.createDataFrame([(d,) for d in data], "d string")
    got = rows.select(related_id(F.col("d")).alias("one"), related_ids(F.col("d")).alias("many")).collect()
    assert [r["one"] for r in got] == ["a", None, None, None, None, None]
    assert [r["many"] for r in got] == [None, ["a", "b"], None, [], None, None]


def test_pages_hold_a_list_an_object_or_nothing(spark):
    pages = ['{"data":[{"id":"a"},{"id":"b"}]}', '{"data":{"id":"c"}}', '{"data":null}', "{}", '{"data":[]}', "junk"]
    rows = spark.createDataFrame([(p,) for p in pages], "p string")
    got = [r["record"] for r in landed_records(rows, "p").collect()]
    assert got == ['{"id":"a"}', '{"id":"b"}', '{"id":"c"}', "junk"]


def test_direction_arrays_of_any_length(spark):
    rows = spark.createDataFrame(
        [(2, ["a", "b"], ["x", "y"]), (1, ["a"], ["x"]), (0, [], []), (-1, None, None)],
        "n int, direction_names array<string>, direction_destinations array<string>",
    )
    got = {r["n"]: r for r in split_directions(rows).collect()}
    assert (got[2]["direction_name_2"], got[2]["direction_destination_1"]) == ("b", "x")
    assert (got[1]["direction_name_1"], got[1]["direction_name_2"]) == ("a", None)
    assert got[0]["direction_name_1"] is None and got[-1]["direction_destination_2"] is None


def test_bad_casts_become_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    rows = spark.createDataFrame([("12",), ("ADDED-1",), (None,)], "id string")
    assert [r[0] for r in cast_columns(rows, {"id": "bigint"}).collect()] == [12, None, None]
