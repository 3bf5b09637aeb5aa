from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from headway.operators import live
from headway.sources.state import PollState
from headway.streaming.poll import file_sink, message_stream, poll_batch, read_records, start_poll

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def _land(root, endpoint, name, records):
    folder = Path(root) / "in" / f"endpoint={endpoint}"
    folder.mkdir(parents=True, exist_ok=True)
    draft = Path(root) / f"{name}.draft"
    draft.write_text("\n".join(json.dumps(r) for r in records) + "\n")
    draft.rename(folder / f"{name}.json")


def _vehicle(id_, updated):
    return {"id": id_, "type": "vehicle", "attributes": {"label": id_, "updated_at": updated.isoformat()}}


def _poll(spark, root, at, sink=None, **options):
    body = poll_batch(PollState(spark, f"{root}/state"), sink or file_sink(f"{root}/out"), clock=lambda: at, **options)
    start_poll(read_records(spark, f"{root}/in"), f"{root}/checkpoint", body, once=True).awaitTermination()


def _sent(spark, root):
    rows = spark.read.schema("key string, value string, poll int, topic string").parquet(f"{root}/out").collect()
    return sorted((r["poll"], r["topic"], r["key"]) for r in rows)


def test_second_poll_sends_what_changed_since_the_first(spark, tmp_path):
    root = str(tmp_path)
    _land(root, "vehicles", "a", [_vehicle("v1", NOON - timedelta(hours=1))])
    _land(root, "alerts", "a", [{"id": "a1", "type": "alert", "attributes": {}}])
    reports = []
    _poll(spark, root, NOON, report=lambda epoch, counts: reports.append((epoch, counts)))
    assert _sent(spark, root) == [(0, "alerts", "a1"), (0, "vehicles", "v1")]

    # The feed repeats v1 and adds v2; a new process continues from the checkpoint.
    _land(root, "vehicles", "b", [_vehicle("v1", NOON - timedelta(hours=1)), _vehicle("v2", NOON + timedelta(hours=1))])
    _poll(spark, root, NOON + timedelta(hours=2), report=lambda epoch, counts: reports.append((epoch, counts)))
    assert _sent(spark, root) == [(0, "alerts", "a1"), (0, "vehicles", "v1"), (1, "vehicles", "v2")]
    assert [e for e, _ in reports] == [0, 1]
    assert (reports[1][1]["vehicles_fetched"], reports[1][1]["vehicles_sent"]) == (2, 1)

    # v2 is the latest now; v1 lies before the cutoff and stays out.
    _land(root, "vehicles", "c", [_vehicle("v1", NOON - timedelta(hours=1))])
    _poll(spark, root, NOON + timedelta(hours=3))
    assert [row for row in _sent(spark, root) if row[0] == 2] == []


def test_pages_are_split_and_unreadable_lines_are_counted_not_sent(spark, tmp_path):
    root, reports = str(tmp_path), []
    v = [_vehicle(f"v{n}", NOON) for n in range(5)]
    lines = [{"data": v[:2], "links": {}}, {"data": v[2]}, {"data": None}, {"links": {}}, {"data": []}, v[3], {"data": [v[4], 7]}]
    _land(root, "vehicles", "a", [*lines, [1], "text", {"type": "vehicle"}])
    (tmp_path / "in" / "endpoint=vehicles" / "b.json").write_text('{"id": "v9", "attrib\n')
    _poll(spark, root, NOON, report=lambda epoch, counts: reports.append(counts))
    assert _sent(spark, root) == [(0, "vehicles", f"v{n}") for n in range(5)]
    assert reports[0]["vehicles_rejected"] == 5 and reports[0]["vehicles_fetched"] == 5


def test_silent_endpoint_keeps_its_cutoff(spark, tmp_path):
    root = str(tmp_path)
    _land(root, "vehicles", "a", [_vehicle("v1", NOON - timedelta(minutes=5))])
    _poll(spark, root, NOON)
    old_alert = {"id": "a1", "type": "alert", "attributes": {"updated_at": (NOON - timedelta(minutes=1)).isoformat()}}
    _land(root, "alerts", "b", [old_alert])
    _poll(spark, root, NOON + timedelta(minutes=1))
    assert _sent(spark, root) == [(0, "vehicles", "v1"), (1, "alerts", "a1")]


def test_record_stamped_before_a_poll_and_landed_after_it_is_sent(spark, tmp_path):
    root = str(tmp_path)
    _land(root, "vehicles", "a", [_vehicle("v1", NOON - timedelta(minutes=5))])
    _poll(spark, root, NOON)
    _land(root, "vehicles", "b", [_vehicle("v2", NOON - timedelta(seconds=1)), _vehicle("v3", NOON - timedelta(minutes=5))])
    _poll(spark, root, NOON + timedelta(minutes=1))
    assert _sent(spark, root) == [(0, "vehicles", "v1"), (1, "vehicles", "v2"), (1, "vehicles", "v3")]


def test_failed_sink_moves_no_cutoff_and_the_poll_is_repeated(spark, tmp_path):
    root = str(tmp_path)
    _land(root, "vehicles", "a", [_vehicle("v1", NOON - timedelta(hours=1))])

    def broken(messages, epoch):
        file_sink(f"{root}/out")(messages, epoch)
        raise OSError("broker gone")

    with pytest.raises(Exception, match="broker gone"):
        _poll(spark, root, NOON, sink=broken)
    assert PollState(spark, f"{root}/state").before(10) == {}
    _poll(spark, root, NOON + timedelta(minutes=1))
    assert _sent(spark, root) == [(0, "vehicles", "v1")]


def test_repeated_poll_uses_the_cutoffs_it_had(spark, tmp_path):
    state = PollState(spark, str(tmp_path))
    assert state.before(0) == {}
    for epoch in range(4):
        state.save(epoch, {"vehicles": NOON + timedelta(minutes=epoch)})
    assert state.before(3) == {"vehicles": NOON + timedelta(minutes=2)}
    assert state.before(4) == {"vehicles": NOON + timedelta(minutes=3)}
    assert len(list(Path(tmp_path).glob("*.json"))) == 2


def test_unreadable_state_means_full_backfill(spark, tmp_path):
    (tmp_path / "0000000000.json").write_text("{")
    assert PollState(spark, str(tmp_path)).before(1) == {}


def test_full_backfill_ignores_cutoffs(spark, tmp_path):
    root = str(tmp_path)
    _land(root, "vehicles", "a", [_vehicle("v1", NOON - timedelta(hours=1))])
    _poll(spark, root, NOON)
    _land(root, "vehicles", "b", [_vehicle("v1", NOON - timedelta(hours=1))])
    _poll(spark, root, NOON + timedelta(hours=1), full_backfill=True)
    assert _sent(spark, root) == [(0, "vehicles", "v1"), (1, "vehicles", "v1")]


def test_streamed_messages_equal_the_batch(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        _land(root, "vehicles", f"f{n}", [_vehicle(f"v{n}{i}", NOON) for i in range(4)])
    stream = message_stream(read_records(spark, f"{root}/in", max_files=1), "now")
    query = stream.writeStream.format("memory").queryName("streamed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    static = spark.read.schema(f"{live.RECORD_DDL}, endpoint string").json(f"{root}/in")
    batch = live.poll_messages(static, {}, "now").collect()
    assert sorted(spark.table("streamed").collect()) == sorted(batch)
    assert spark.table("streamed").select(F.countDistinct("key")).first()[0] == 12


def test_quiet_feed_sends_each_change_once(spark, tmp_path):
    """Five polls of a feed that repeats its state; one record of the latest second lands late."""
    root = str(tmp_path)
    feed = [_vehicle("v1", NOON), _vehicle("v2", NOON), {"id": "undated", "attributes": {}}]
    for n in range(5):
        if n == 2:
            feed += [_vehicle("v3", NOON), _vehicle("v1", NOON + timedelta(milliseconds=300))]
        _land(root, "vehicles", f"f{n}", feed)
        _poll(spark, root, NOON + timedelta(minutes=n))
    dated = [row for row in _sent(spark, root) if row[2] != "undated"]
    assert dated == [(0, "vehicles", "v1"), (0, "vehicles", "v2"), (2, "vehicles", "v1"), (2, "vehicles", "v3")]
    assert len(_sent(spark, root)) == 9


def test_what_is_remembered_stays_small(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        _land(root, "vehicles", f"f{n}", [_vehicle(f"v{n}{k}", NOON + timedelta(minutes=n)) for k in range(4)])
        _poll(spark, root, NOON + timedelta(hours=1))
    state = PollState(spark, f"{root}/state")
    assert sorted(r["id"] for r in state.known(99).collect()) == [f"v2{k}" for k in range(4)]
    assert len(list((tmp_path / "state" / "known").glob("epoch=*"))) == 2


def test_changes_stamped_in_the_future_are_sent_once(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        _land(root, "vehicles", f"f{n}", [_vehicle("ahead", NOON + timedelta(days=9)), _vehicle(f"v{n}", NOON + timedelta(minutes=n))])
        _poll(spark, root, NOON + timedelta(minutes=n))
    assert [row for row in _sent(spark, root) if row[2] == "ahead"] == [(0, "vehicles", "ahead")]


def _alert(id_, updated):
    return {"id": id_, "type": "alert", "attributes": {"updated_at": updated.isoformat()}}


def test_a_failing_topic_keeps_its_cutoff_and_the_others_go_on(spark, tmp_path):
    root, reports = str(tmp_path), []
    healthy = file_sink(f"{root}/out")

    def alerts_down(messages, epoch):
        if messages.first()["topic"] == "alerts":
            raise OSError("topic gone")
        healthy(messages, epoch)

    def land(n):
        _land(root, "vehicles", f"v{n}", [_vehicle(f"v{n}", NOON + timedelta(minutes=n))])
        _land(root, "alerts", f"a{n}", [_alert(f"a{k}", NOON + timedelta(minutes=k)) for k in range(n + 1)])

    land(0)
    _poll(spark, root, NOON + timedelta(hours=1))
    for n in (1, 2):
        land(n)
        _poll(spark, root, NOON + timedelta(hours=1), sink=alerts_down, report=lambda _, counts: reports.append(counts))
    assert _sent(spark, root) == [(0, "alerts", "a0"), (0, "vehicles", "v0"), (1, "vehicles", "v1"), (2, "vehicles", "v2")]
    assert [r["alerts_failed"] for r in reports] == ["topic gone"] * 2 and "vehicles_failed" not in reports[0]
    state = PollState(spark, f"{root}/state")
    assert state.before(9)["alerts"] == NOON - timedelta(seconds=1) and state.before(9)["vehicles"] > NOON
    assert sorted(r["key"] for r in state.pending(9).collect()) == ["a1", "a2"]

    # The topic is back: its messages go out, in a poll that brings nothing new.
    _land(root, "vehicles", "again", [_vehicle("v2", NOON + timedelta(minutes=2))])
    _poll(spark, root, NOON + timedelta(hours=1))
    assert [row for row in _sent(spark, root) if row[0] == 3] == [(3, "alerts", "a1"), (3, "alerts", "a2")]
    assert state.pending(9).count() == 0 and state.before(9)["alerts"] == NOON - timedelta(seconds=1)


def test_a_repeated_epoch_counts_once(spark, tmp_path):
    root = str(tmp_path)
    _land(root, "vehicles", "a", [_vehicle("v1", NOON), _vehicle("v2", NOON - timedelta(hours=1))])
    (tmp_path / "in" / "endpoint=vehicles" / "b.json").write_text("nonsense\n")
    with pytest.raises(Exception, match="down"):
        def down(_messages, _epoch):
            raise OSError("down")

        _poll(spark, root, NOON, sink=down)
    _poll(spark, root, NOON)
    state = PollState(spark, f"{root}/state")
    assert [tuple(r) for r in state.counters().collect()] == [("vehicles", None, 2, 2, 0, 1, 0)]
    assert [tuple(r) for r in state.dead_letters().collect()] == [("vehicles", "no JSON object", "nonsense", 0)]


def test_routes_are_read_anew_in_every_poll(spark, tmp_path):
    def prediction(id_, route):
        return {"id": id_, "attributes": {}, "relationships": {"route": {"data": {"id": route}}}}

    root, wanted = str(tmp_path), ["Red"]
    for n in range(2):
        _land(root, "predictions", f"p{n}", [prediction(f"r{n}", "Red"), prediction(f"b{n}", "Blue")])
        _poll(spark, root, NOON, routes=lambda: spark.createDataFrame([(w,) for w in wanted], "route string"))
        wanted[:] = ["Blue"]
    assert _sent(spark, root) == [(0, "predictions", "r0"), (1, "predictions", "b1")]
