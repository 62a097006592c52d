"""Live health against the batch operators, over restarts; control rows and what readers see of them."""

import json
import random

import pytest

from feedloom import schemas
from feedloom.operators import health, quality
from feedloom.sources import lake
from feedloom.streaming import health as live
from feedloom.streaming import sinks

S = 1_000_000_000
BASE = 1_784_259_900 * S
EVENTS = "run_id string, event_id long, component string, symbol string, received_at_unix_ns long"
TURNS = (
    "run_id string, event_id long, component string, connection_key string, event_type string, "
    "received_at_unix_ns long"
)
CONFIGURED = "run_id string, symbol_upper string, connection_key string"
SYMBOLS = ["A", "B", "C"]


def drawn(seed, ended=300):
    """Receipts of two symbols with long silences on both feeds; C never arrives."""
    rng = random.Random(seed)
    rows = []
    for component in health.COMPONENTS:
        for symbol in SYMBOLS[:2]:
            now = rng.randint(0, 30)
            while now <= ended:
                rows.append((now, component, symbol.lower() if rng.random() < 0.3 else symbol))
                now += rng.choice([1, 1, 2, 5, 8, 25, 60])
    rows.sort()
    return [("r", i + 100, c, s, BASE + now * S) for i, (now, c, s) in enumerate(rows)]


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(path)


def streams(spark, tmp_path):
    return (
        spark.readStream.schema(EVENTS).json(str(tmp_path / "events")),
        spark.readStream.schema(TURNS).json(str(tmp_path / "turns")),
    )


@pytest.mark.parametrize("seed", [1, 2])
def test_live_silence_is_that_of_the_batch_over_restarts(spark, tmp_path, seed):
    rows, timeout, ended = drawn(seed), 10, 300
    ready = BASE + 20 * S
    configured = spark.createDataFrame([("r", s, "tbt:1") for s in SYMBOLS], CONFIGURED)
    land(spark, [("r", 1, "process", None, "streams_ready", ready)], TURNS, str(tmp_path / "turns"))
    third = len(rows) // 3
    for part in (rows[:third], rows[third : 2 * third], rows[2 * third :], [("r", 9999, "data", "A", BASE + 900 * S)]):
        land(spark, part, EVENTS, str(tmp_path / "events"))
        events, turns = streams(spark, tmp_path)
        live.live_symbols(
            events, turns, configured, timeout_seconds=timeout, lateness="0 seconds"
        ).writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "progress")
        ).trigger(availableNow=True).start().awaitTermination()
    told = spark.read.parquet(str(tmp_path / "out")).collect()
    got = sorted(
        (r["component"], r["symbol_upper"], r["at_ns"]) for r in told
        if r["event_type"] == "feed_stale" and r["at_ns"] <= BASE + ended * S
    )
    frame = spark.createDataFrame(rows, EVENTS)
    runs = spark.createDataFrame(
        [("r", ready, BASE + ended * S)], "run_id string, ready_at_ns long, ended_at_ns long"
    )
    spans = health.silences(frame, runs, timeout_seconds=timeout, configured=configured).collect()
    assert got == sorted((r["component"], r["symbol_upper"], r["stale_at_ns"]) for r in spans)
    assert ("data", "C", ready) in got and len(got) > 8
    fresh = {(r["component"], r["symbol_upper"], r["at_ns"]) for r in told if r["event_type"] == "feed_fresh"}
    assert {
        (r["component"], r["symbol_upper"], r["silent_until_ns"]) for r in spans if not r["open_ended"]
    } <= fresh


def test_gate_and_outages_become_control_rows_that_fail_the_run(spark, tmp_path):
    root, progress = str(tmp_path / "lake"), str(tmp_path / "progress")
    configured = spark.createDataFrame([("r", s, "tbt:1") for s in SYMBOLS[:2]], CONFIGURED)
    steps = [
        ([("r", 1, "process", None, "sockets_ready", BASE),
          ("r", 2, "data", "data", "socket_open", BASE), ("r", 3, "tbt", "tbt:1", "socket_open", BASE)],
         [("r", 10, "data", "A", BASE + 1 * S), ("r", 11, "data", "b", BASE + 2 * S), ("r", 12, "tbt", "a", BASE + 3 * S)]),
        ([("r", 20, "data", "data", "socket_close", BASE + 40 * S), ("r", 21, "data", "data", "socket_close", BASE + 41 * S),
          ("r", 22, "tbt", "tbt:1", "feed_stale_retry", BASE + 42 * S)],
         [("r", 23, "data", "A", BASE + 45 * S)]),
        ([("r", 30, "data", "data", "socket_open", BASE + 60 * S)],
         [("r", 31, "tbt", "A", BASE + 61 * S)]),
        ([("r", 40, "data", "data", "socket_open", BASE + 200 * S)], [("r", 41, "data", "A", BASE + 200 * S)]),
        ([("r", 50, "data", "data", "socket_open", BASE + 201 * S)], [("r", 51, "data", "A", BASE + 201 * S)]),
    ]
    for turns_, events_ in steps:
        land(spark, turns_, TURNS, str(tmp_path / "turns"))
        land(spark, events_, EVENTS, str(tmp_path / "events"))
        events, turns = streams(spark, tmp_path)
        sinks.drain(
            *live.record_health(
                events, turns, configured, root, progress, timeout_seconds=0,
                first_event_seconds=30, grace_seconds=30, lateness="0 seconds", flush_seconds=None,
            )
        )
    control = lake.scan_control(spark, root)
    found = sorted(
        ((r["received_at_unix_ns"] - BASE) // S, r["component"], r["event_type"], r["severity"])
        for r in control.collect()
    )
    assert found == [
        (30, "process", "first_event_timeout", "ERROR"),
        (40, "data", "disconnect_detected", "WARNING"),
        (42, "tbt", "disconnect_detected", "WARNING"),
        (72, "tbt", "tbt_disconnect_timeout", "ERROR"),
    ]
    [gate] = control.where("event_type = 'first_event_timeout'").collect()
    details = json.loads(gate["details_json"])
    assert details["missing_streams"] == ["tbt"] and details["missing_symbols"] == {"tbt": ["B"]}
    effects = quality.with_effects(control)
    assert {r[0] for r in effects.select("fatal_reason").where("fatal_reason is not null").collect()} == {
        "first_event_timeout", "tbt_disconnect_timeout",
    }
    [verdict] = quality.run_status(effects).collect()
    assert verdict["status"] == "failed" and verdict["stop_reason"] == "first_event_timeout"
    with pytest.raises(ValueError, match="another checkpoint"):
        live.record_health(events, turns, configured, root, str(tmp_path / "other"), flush_seconds=None)


def test_never_seen_symbols_turn_stale_by_the_wall_clock(spark, tmp_path):
    import time

    configured = spark.createDataFrame([("r", s, "tbt:1") for s in SYMBOLS[:2]], CONFIGURED)
    now = time.time_ns()
    land(spark, [("r", 1, "process", None, "streams_ready", now)], TURNS, str(tmp_path / "turns"))
    land(spark, [("r", 2, "data", "A", now + 1)], EVENTS, str(tmp_path / "events"))
    events, turns = streams(spark, tmp_path)
    query = (
        live.live_symbols(events, turns, configured, timeout_seconds=2, components=("data",))
        .writeStream.format("memory").queryName("watched").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "c")).start()
    )
    try:
        deadline = time.time() + 90
        while time.time() < deadline:
            told = {(r["symbol_upper"], r["event_type"], r["at_ns"]) for r in spark.table("watched").collect()}
            if {("B", "feed_stale", now), ("A", "feed_stale", now + 1 + 2 * S)} <= told:
                break
            time.sleep(0.5)
        assert {("B", "feed_stale", now), ("A", "feed_stale", now + 1 + 2 * S)} <= told
    finally:
        query.stop()


def test_state_of_an_ended_run_is_dropped():
    watch = live.SymbolWatch(10, 5)
    watch.lifecycle(live.OPENED, 0)
    assert watch.next_at() == 5
    watch.receipts(7, 9, 1)
    assert watch.told == [("first_event_missing", 5, None, None)] and watch.next_at() is None
    watch.lifecycle(live.READY, 12)
    assert watch.next_at() == 19 and live.SymbolWatch(0, 0, watch.state()).next_at() is None
    watch.due(19)
    watch.receipts(25, 26, 2)
    assert [t[:2] for t in watch.told[1:]] == [("feed_stale", 19), ("feed_fresh", 25)]


def test_a_batch_that_is_not_committed_is_not_seen(spark, tmp_path, monkeypatch):
    root, progress = str(tmp_path / "lake"), str(tmp_path / "progress")
    configured = spark.createDataFrame([("r", "A", "tbt:1")], CONFIGURED)
    land(spark, [("r", 1, "tbt", "tbt:1", "socket_open", BASE), ("r", 2, "tbt", "tbt:1", "socket_close", BASE + S)],
         TURNS, str(tmp_path / "turns"))
    land(spark, [("r", 3, "tbt", "A", BASE)], EVENTS, str(tmp_path / "events"))

    def run():
        events, turns = streams(spark, tmp_path)
        return live.record_health(events, turns, configured, root, progress, lateness="0 seconds", flush_seconds=None)

    write = live.write_batch

    def killed(rows, root_, stream, batch_id):
        write(rows, root_, stream, batch_id)
        if stream == schemas.OUTAGE_CONTROL:
            raise RuntimeError("killed after the write")

    monkeypatch.setattr(live, "write_batch", killed)
    with pytest.raises(Exception, match="killed"):
        sinks.drain(*run())
    assert spark.read.parquet(lake.stream_path(root, schemas.OUTAGE_CONTROL)).count() == 1
    assert lake.scan_control(spark, root).count() == 0
    monkeypatch.undo()
    sinks.drain(*run())
    assert [r["event_type"] for r in lake.scan_control(spark, root).collect()] == ["disconnect_detected"]


def test_a_run_that_ends_on_each_connection_meets_its_symbols_once(spark):
    ends = [("r", 7, "tbt", f"tbt:{n}", "process_stop_requested", BASE + n) for n in range(400)]
    ready = [("r", n, "process", None, "streams_ready", BASE) for n in range(3)]
    other = [("s", 1, "data", "data", "process_stop_requested", BASE + 5), ("r", 1, "data", "data", "socket_open", BASE)]
    turns = spark.createDataFrame(ends + ready + other, TURNS).repartition(7)
    assert sorted(map(tuple, live._run_turns(turns).collect())) == [
        ("r", "process_stop_requested", BASE + 399), ("r", "streams_ready", BASE),
        ("s", "process_stop_requested", BASE + 5),
    ]


def test_symbols_of_one_bucket_keep_their_own_timers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "BUCKETS", 1)
    test_live_silence_is_that_of_the_batch_over_restarts(spark, tmp_path, 3)
