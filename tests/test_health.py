"""Outages, silences, retries and the first-event gate, against a polling simulation."""

import random

import pytest

from feedloom.operators import health

S = 1_000_000_000


def outage_rows(spark, *turns, ended=1000.0, grace=30):
    rows = [
        ("r", i + 1, "data", "data", kind, int(at * S)) for i, (kind, at) in enumerate(turns)
    ]
    control = spark.createDataFrame(
        rows, "run_id string, event_id long, component string, connection_key string, "
        "event_type string, received_at_unix_ns long",
    )
    runs = spark.createDataFrame([("r", int(ended * S))], "run_id string, ended_at_ns long")
    return health.outages(control, runs, grace_seconds=grace, chunk_rows=2).orderBy("event_id").collect()


@pytest.mark.parametrize("seconds, fatal", [(29.999, False), (30.0, True)])
def test_outage_boundary(spark, seconds, fatal):
    rows = outage_rows(
        spark, ("socket_open", 0), ("socket_close", 100), ("socket_close", 105),
        ("socket_open", 100 + seconds),
    )
    assert len(rows) == 1 and rows[0]["timed_out"] is fatal
    assert rows[0]["fatal_reason"] == ("data_disconnect_timeout" if fatal else None)


def test_open_outage_lasts_to_the_end_and_needs_an_open_first(spark):
    rows = outage_rows(spark, ("socket_close", 1), ("socket_open", 5), ("socket_close", 990))
    assert [(r["down_at_ns"], r["up_at_ns"], r["outage_ns"]) for r in rows] == [
        (990 * S, None, 10 * S)
    ]


def test_stale_retry_starts_an_outage(spark):
    rows = outage_rows(
        spark, ("socket_open", 0), ("feed_stale_retry", 1), ("socket_close", 2), ("socket_open", 41)
    )
    assert [(r["down_at_ns"], r["outage_ns"], r["timed_out"]) for r in rows] == [(1 * S, 40 * S, True)]


def simulate(symbols, events, timeout, retries, ended):
    """Continuous polling of one connection from readiness at 0, in whole seconds."""
    last = {s: 0 for s in symbols}
    attempt, started, out = 0, None, []
    for now in range(0, ended + 1):
        # The health check sees the clock before the callbacks of this very second.
        if any(now - at >= timeout for at in last.values()):
            if attempt >= retries:
                out.append((attempt, now, "feed_stale"))
                return out
            attempt, started = attempt + 1, now
            last = {s: now for s in symbols}
            out.append((attempt, now, "feed_stale_retry"))
        for symbol in events.get(now, ()):
            last[symbol] = now
            # Fresh means after the retry; the retry's own second counts as the clock's restart.
            if started is not None and all(at > started for at in last.values()):
                out.append((attempt, now, "feed_recovered"))
                attempt, started = 0, None
    return out


@pytest.mark.parametrize("component", ["data", "tbt"])
@pytest.mark.parametrize("seed", range(4))
def test_attempts_equal_polling(spark, seed, component):
    draw = random.Random(seed + 10 * (component == "data"))
    symbols, timeout, retries, ended = ["A", "B", "C"][: 2 + seed % 2], 5, 2, 160
    times = {s: [0] for s in symbols}
    events: dict[int, list[str]] = {0: list(symbols)}
    for symbol in symbols:
        now = 0
        while True:
            now += draw.choice([1, 2, 3, 4, 4, 2, 1, 7, 9])
            if now > ended:
                break
            times[symbol].append(now)
            events.setdefault(now, []).append(symbol)
    rows, ids = [], 0
    for now in sorted(events):
        for symbol in events[now]:
            ids += 1
            rows.append(("r", ids, component, symbol, now * S))
    frame = spark.createDataFrame(
        rows, "run_id string, event_id long, component string, symbol string, received_at_unix_ns long"
    )
    runs = spark.createDataFrame(
        [("r", 0, ended * S)], "run_id string, ready_at_ns long, ended_at_ns long"
    )
    stale = health.silences(frame, runs, timeout_seconds=timeout, chunk_rows=5)
    configured = spark.createDataFrame(
        [("r", s, "tbt:1") for s in symbols],
        "run_id string, symbol_upper string, connection_key string",
    )
    attempts = health.stale_attempts(
        health.on_connections(stale, configured), timeout_seconds=timeout, retries=retries
    )
    back = health.recoveries(attempts, frame, configured, timeout_seconds=timeout)
    rows = attempts.unionByName(back).collect()
    assert {(r["component"], r["connection_key"]) for r in rows} <= {
        (component, {"tbt": "tbt:1"}.get(component, component))
    }
    got = sorted((r["at_ns"] // S, r["event_type"] != "feed_recovered", r["attempt"], r["event_type"]) for r in rows)
    assert [(a, at, kind) for at, _, a, kind in got] == simulate(symbols, events, timeout, retries, ended)


def test_only_the_outline_of_many_silences_is_swept(spark):
    rows = [("r", "data", "data", (k % 50) * S, (60 + k % 50) * S) for k in range(500)]
    rows += [("r", "data", "data", 5 * S, 1000 * S), ("r", "tbt", "tbt:1", 7 * S, 9 * S)]
    stale = spark.createDataFrame(
        rows, "run_id string, component string, connection_key string, stale_at_ns long, silent_until_ns long"
    )
    kept = health.leading_silences(stale, timeout_seconds=2)
    got = sorted((r["component"], r["begin_ns"] // S, r["end_ns"] // S) for r in kept.collect())
    assert got == [("data", k, 60 + k + 2) for k in range(-2, 3)] + [("data", 3, 1000), ("tbt", 5, 9)]


def test_silence_of_a_never_seen_symbol_and_switch_off(spark):
    frame = spark.createDataFrame(
        [("r", 1, "data", "A", 10 * S)],
        "run_id string, event_id long, component string, symbol string, received_at_unix_ns long",
    )
    runs = spark.createDataFrame(
        [("r", 5 * S, 80 * S)], "run_id string, ready_at_ns long, ended_at_ns long"
    )
    configured = spark.createDataFrame([("r", "A"), ("r", "B")], "run_id string, symbol_upper string")

    def found(timeout):
        rows = health.silences(
            frame, runs, timeout_seconds=timeout, configured=configured, components=("data",)
        ).collect()
        return sorted((r["symbol_upper"], r["stale_at_ns"] // S, r["open_ended"]) for r in rows)

    # A came five seconds after the streams were ready: until then it was missing.
    assert found(60) == [("A", 5, False), ("A", 70, True), ("B", 5, True)]
    assert found(71) == [("A", 5, False), ("B", 5, True)]
    assert found(0) == []


def test_gate(spark):
    events = spark.createDataFrame(
        [("r", "data", "a", 30 * S), ("r", "tbt", "A", 31 * S), ("r", "data", "B", 1 * S)],
        "run_id string, component string, symbol string, received_at_unix_ns long",
    )
    configured = spark.createDataFrame([("r", "A"), ("r", "B")], "run_id string, symbol_upper string")
    runs = spark.createDataFrame([("r", 0)], "run_id string, opened_at_ns long")
    rows = health.first_event_gate(events, configured, runs, timeout_seconds=30).collect()
    assert {(r["component"], r["symbol_upper"]): r["arrival"] for r in rows} == {
        ("data", "A"): "in_time", ("tbt", "A"): "late", ("data", "B"): "in_time",
        ("tbt", "B"): "missing",
    }


def test_connection_is_recovered_from_the_open_row(spark):
    control = spark.createDataFrame(
        [("r", 1, "c1", "tbt", "socket_open", '{"connection":"tbt:2"}'),
         ("r", 2, "c1", "tbt", "socket_close", "{}"), ("r", 3, "d1", "data", "socket_close", "{}")],
        "run_id string, event_id long, connection_id string, component string, "
        "event_type string, details_json string",
    )
    rows = health.with_connection_key(control).orderBy("event_id").collect()
    assert [r["connection_key"] for r in rows] == ["tbt:2", "tbt:2", "data"]
