"""Live feed health: silent and missing symbols, lost connections, and counters of what arrived.

Two stateful operators watch a running stream: one for configured symbols, one per connection. Each
tells what the rows themselves show, and has a timer for what only their absence shows. Lifecycle
rows give each run its clocks: ``sockets_ready`` starts the wait for first events and
``streams_ready`` the watch for silence, on every configured symbol, whether it ever arrives or not.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from feedloom import schemas
from feedloom.operators import normalize
from feedloom.operators.health import (
    COMPONENTS, DISCONNECT_GRACE, FIRST_EVENT_TIMEOUT, STALE_TIMEOUT, members,
)
from feedloom.operators.joins import sized_broadcast
from feedloom.sources.lake import claim, stream_path
from feedloom.streaming.sinks import write_batch

KEYS = ["run_id", "component", "symbol_upper"]
CONNECTION = ["run_id", "component", "connection_key"]
#: Symbols of a run and component are watched in this many groups. Fixed: states are kept by group.
BUCKETS = 64
_NS, _MS = 1_000_000_000, 1_000_000
#: Lifecycle rows by which a run's symbols are watched, and no longer watched.
OPENED, READY, ENDED = "sockets_ready", "streams_ready", "process_stop_requested"
_TOLD = "event_type string, at_ns long, last_received_ns long, event_id long"
_SYMBOL_TOLD = f"run_id string, component string, symbol_upper string, {_TOLD}"


class SymbolWatch:
    """What is known of one symbol of a run; ``told`` collects what is to be said."""

    HELD = (
        "symbol_upper:string, timer_ms:long, opened_ns:long, ready_ns:long, last_ns:long, "
        "last_id:long, gate_told:boolean, stale:boolean"
    )

    def __init__(self, timeout: int, gate: int, state: tuple | None = None) -> None:
        self.timeout, self.gate = timeout, gate
        (self.opened, self.ready, self.last, self.last_id, self.gate_told, self.stale) = (
            state or (None, None, None, None, False, False)
        )
        self.told: list[tuple[str, int, int | None, int | None]] = []

    def state(self) -> tuple:
        return self.opened, self.ready, self.last, self.last_id, self.gate_told, self.stale

    def _tell(self, event_type: str, at: int) -> None:
        self.told.append((event_type, at, self.last, self.last_id))

    def gate_at(self) -> int | None:
        """When the wait for the first event is over; None if it is or was never on."""
        if self.opened is None or self.last is not None or self.gate_told or self.gate <= 0:
            return None
        return self.opened + self.gate

    def stale_at(self) -> int | None:
        """When the symbol turns stale unless it arrives; None if it is already or not watched."""
        if self.ready is None or self.stale or self.timeout <= 0:
            return None
        return self.ready if self.last is None else max(self.last + self.timeout, self.ready)

    def due(self, now: int) -> None:
        """Tell what has come to pass up to ``now``."""
        gate = self.gate_at()
        if gate is not None and now > gate:
            self._tell("first_event_missing", gate)
            self.gate_told = True
        stale = self.stale_at()
        if stale is not None and now >= stale:
            self._tell("feed_stale", stale)
            self.stale = True

    def lifecycle(self, kind: str, at: int) -> None:
        if kind == OPENED and self.opened is None:
            self.opened = at
        elif kind == READY and self.ready is None:
            self.ready = at

    def receipts(self, first: int, last: int, event_id: int) -> None:
        """Receipts from ``first`` to ``last``, none a timeout after the one before it."""
        self.due(first)
        late = self.last is not None and last < self.last
        self.last = last if self.last is None else max(self.last, last)
        self.last_id = event_id if self.last_id is None else max(self.last_id, event_id)
        if self.stale and not late:
            self._tell("feed_fresh", first)
            self.stale = False

    def next_at(self) -> int | None:
        pending = [at for at in (self.gate_at(), self.stale_at()) if at is not None]
        return min(pending, default=None)


class ConnectionWatch:
    """What is known of one connection of a run."""

    FIELDS = "up boolean, down_ns long, last_id long, timed_out boolean"

    def __init__(self, grace: int, state: tuple | None = None) -> None:
        self.grace = grace
        self.up, self.down, self.last_id, self.timed_out = state or (False, None, None, False)
        self.told: list[tuple[str, int, int | None, int | None]] = []

    def state(self) -> tuple:
        return self.up, self.down, self.last_id, self.timed_out

    def due(self, now: int) -> None:
        at = self.next_at()
        if at is not None and now >= at:
            self.told.append(("disconnect_timeout", at, self.down, self.last_id))
            self.timed_out = True

    def turn(self, kind: str, at: int, event_id: int) -> None:
        """A connection that opens, closes, or is closed for a retry."""
        self.due(at)
        self.last_id = event_id
        if kind == "socket_open":
            self.up, self.down, self.timed_out = True, None, False
        elif self.up:
            self.up, self.down, self.timed_out = False, at, False
            self.told.append(("disconnect_detected", at, at, event_id))

    def next_at(self) -> int | None:
        return None if self.down is None or self.timed_out else self.down + self.grace


def _rows(key: tuple[Any, ...], names: list[str], told: list[tuple]) -> pd.DataFrame:
    """What is told, each row after ``key``; ``names`` are those of the columns before the event."""
    columns = [*names, "event_type", "at_ns", "last_received_ns", "event_id"]
    # Python's own numbers and None stay what they are; casting each small frame would cost more.
    return pd.DataFrame([(*key, *row) for row in told], columns=columns, dtype=object)


def _optional(values: tuple) -> tuple:
    return tuple(None if pd.isna(x) else x for x in values)


def _timer(at: int | None, now_ms: int) -> int | None:
    """The millisecond of a timer: it must lie beyond now; one that is due fires with the next batch."""
    return None if at is None else max(-(-at // _MS), now_ms + 1)


def _schedule(state: GroupState, at: int | None, by_event_time: bool) -> None:
    if at is None:
        return
    if by_event_time:
        state.setTimeoutTimestamp(_timer(at, state.getCurrentWatermarkMs()))
    else:
        now = state.getCurrentProcessingTimeMs()
        state.setTimeoutDuration(_timer(at, now) - now)


def _now(state: GroupState, by_event_time: bool) -> int:
    ms = state.getCurrentWatermarkMs() if by_event_time else state.getCurrentProcessingTimeMs()
    return ms * _MS


def _stretches(timeout_ns: int):
    """Receipts of a symbol within an Arrow batch as stretches without a gap of the timeout.

    Stretches of several batches merge, receipts would not if only some of them were kept; a hot
    symbol shuffles a few rows a batch, however many receipts it has.
    """
    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ordered = batch.sort_values([*KEYS, "received_at_unix_ns"], kind="stable")
            gap = ordered.groupby(KEYS, dropna=False)["received_at_unix_ns"].diff()
            ordered["_n"] = (gap.isna() | (gap >= max(timeout_ns, 1))).cumsum()
            out = ordered.groupby([*KEYS, "_n"], dropna=False, as_index=False).agg(
                from_ns=("received_at_unix_ns", "min"), to_ns=("received_at_unix_ns", "max"),
                event_id=("event_id", "max"),
            )
            yield out.assign(kind="receipt")[[*KEYS, "kind", "from_ns", "to_ns", "event_id"]]

    return reduce


def _once(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turns of a partition, each once; of a run's ends only the last."""
    found = pd.DataFrame()
    for batch in batches:
        found = pd.concat([found, batch]) if len(found) else batch
        ends = found["kind"] == ENDED
        last = found[ends].sort_values("received_at_unix_ns", na_position="first")
        found = pd.concat([found[~ends].drop_duplicates(), last.drop_duplicates(["run_id"], keep="last")])
    if len(found):
        yield found


_RUN_TURN = "run_id string, kind string, received_at_unix_ns long"


def _run_turns(lifecycle: DataFrame) -> DataFrame:
    """A micro-batch's turns of whole runs.

    A run is told to stop on each of its connections. Joined as they are, these rows would meet all
    symbols of the run, connections times symbols in all. What is told by the earlier ends of a
    batch, the last one or a receipt before it tells as well. Turns are reduced where they are read
    and again by run, so few of them are shuffled; no state is kept between batches.
    """
    turns = lifecycle.where(F.col("event_type").isin(OPENED, READY, ENDED)).select(
        "run_id", F.col("event_type").alias("kind"), "received_at_unix_ns"
    )
    return turns.mapInPandas(_once, _RUN_TURN).repartition("run_id").mapInPandas(_once, _RUN_TURN)


_WATCHED = "run_id string, component string, symbol_upper string, kind string, from_ns long, to_ns long, event_id long"


def _timeouts(by_event_time: bool) -> str:
    return (
        GroupStateTimeout.EventTimeTimeout if by_event_time else GroupStateTimeout.ProcessingTimeTimeout
    )


def _timed(rows: DataFrame, ns: str, lateness: str | None) -> DataFrame:
    if lateness is None:
        return rows
    return rows.withColumn("_time", F.timestamp_micros(F.call_function("div", F.col(ns), F.lit(1000)))).withWatermark(
        "_time", lateness
    )


def _symbol_watch(timeout: int, gate: int, by_event_time: bool, always: bool = False):
    """The state function of a bucket of symbols; ``always``: no lifecycle row is needed to watch one.

    Each symbol has its own timer, kept with its state; the bucket's is the first of them. One that
    ran off while other symbols of the bucket arrived is told of then.
    """
    def watch(
        key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        held = state.get[0] if state.exists else []
        known = {symbol: (timer, tuple(own)) for symbol, timer, *own in held}
        arrived: dict[Any, list[tuple]] = {}
        if not state.hasTimedOut:
            for frame in frames:
                for symbol, *row in zip(*(frame[c].tolist() for c in ("symbol_upper", "from_ns", "kind", "to_ns", "event_id"))):
                    arrived.setdefault(symbol, []).append(row)
        now = _now(state, by_event_time)
        told: list[tuple] = []

        def keep(symbol: Any, one: SymbolWatch) -> None:
            known[symbol] = (_timer(one.next_at(), now // _MS), one.state())
            told.extend((symbol, *row) for row in one.told)

        for symbol, (timer, own) in list(known.items()):
            if symbol not in arrived and timer is not None and timer < now // _MS:
                one = SymbolWatch(timeout, gate, own)
                one.due(now)
                keep(symbol, one)
        for symbol, rows in arrived.items():
            one = SymbolWatch(timeout, gate, known[symbol][1] if symbol in known else None)
            ended = False
            if always:
                one.lifecycle(READY, 0)
                if one.last is None:
                    one.last = min(int(row[0]) for row in rows)
            # At one moment the run's own turns come before receipts.
            for first, kind, last, event_id in sorted(rows, key=lambda r: (r[0], r[1] == "receipt")):
                if kind == "receipt":
                    one.receipts(int(first), int(last), int(event_id))
                elif kind == ENDED:
                    one.due(int(first))
                    ended = True
                else:
                    one.lifecycle(kind, int(first))
            keep(symbol, one)
            if ended:
                del known[symbol]
        if known:
            state.update(([(symbol, timer, *own) for symbol, (timer, own) in known.items()],))
            first = min((timer for timer, _ in known.values() if timer is not None), default=None)
            _schedule(state, None if first is None else first * _MS, by_event_time)
        elif state.exists:
            state.remove()
        if told:
            yield _rows(key[:2], KEYS, told)

    return watch


def _watched(rows: DataFrame, watch, by_event_time: bool) -> DataFrame:
    """Rows of symbols through the state function, a bucket of a run's symbols at a time.

    A call of the function costs far more than a symbol does; a bucket's state is a list of its
    configured symbols (or, without a universe, those that arrived).
    """
    return (
        rows.withColumn("bucket", F.pmod(F.xxhash64("symbol_upper"), F.lit(BUCKETS)))
        .groupBy(*KEYS[:2], "bucket")
        .applyInPandasWithState(
            watch, _SYMBOL_TOLD, f"known array<struct<{SymbolWatch.HELD}>>", "append",
            _timeouts(by_event_time),
        )
    )


def _receipts(events: DataFrame, timeout: int) -> DataFrame:
    return events.where(F.col("symbol").isNotNull()).select(
        "run_id", "component", F.upper("symbol").alias("symbol_upper"), "event_id",
        "received_at_unix_ns",
    ).mapInPandas(_stretches(timeout), _WATCHED)


def live_staleness(events: DataFrame, *, timeout_seconds: int = STALE_TIMEOUT) -> DataFrame:
    """``feed_stale`` and ``feed_fresh`` of every symbol that ever arrives, from its first receipt on.

    For streams without lifecycle rows or a universe; ``live_symbols`` knows both.
    """
    timeout = timeout_seconds * _NS
    known = events if "event_id" in events.columns else events.withColumn("event_id", F.lit(0).cast("long"))
    watch = _symbol_watch(timeout, 0, False, always=True)
    return _watched(_receipts(known, timeout), watch, False).select(
        *KEYS, "event_type", "last_received_ns"
    )


def live_symbols(
    events: DataFrame,
    lifecycle: DataFrame,
    configured: DataFrame,
    *,
    timeout_seconds: int = STALE_TIMEOUT,
    first_event_seconds: int = FIRST_EVENT_TIMEOUT,
    components: tuple[str, ...] = COMPONENTS,
    lateness: str | None = None,
) -> DataFrame:
    """Stream of what becomes of the configured symbols of each run.

    ``feed_stale`` when one falls silent, or has not come when the streams are ready;
    ``feed_fresh`` when it returns; ``first_event_missing`` when the wait for its first event is
    over. ``at_ns`` is when it came to pass, not when it was noticed; ``event_id`` the last one
    seen of the symbol. ``events`` and ``lifecycle`` are streams, ``configured`` is a table of
    ``run_id, symbol_upper, connection_key``. A timeout of zero switches its check off.

    Timers follow the wall clock, so silence is noticed although no row arrives. With ``lateness``
    they follow the stamps of the rows instead, for replays; rows later than that are not seen.
    The state of a run is dropped when the run is told to stop.
    """
    timeout, gate = timeout_seconds * _NS, first_event_seconds * _NS
    by_event_time = lateness is not None

    receipts = _receipts(events, timeout)
    everyone = sized_broadcast(members(configured, components).drop("connection_key").distinct())
    turns = (
        _run_turns(lifecycle)
        .join(everyone, "run_id")
        .select(
            *KEYS, "kind", F.col("received_at_unix_ns").alias("from_ns"),
            F.col("received_at_unix_ns").alias("to_ns"), F.lit(0).cast("long").alias("event_id"),
        )
    )
    return _watched(
        _timed(receipts.unionByName(turns), "to_ns", lateness),
        _symbol_watch(timeout, gate, by_event_time), by_event_time,
    )


def live_outages(
    lifecycle: DataFrame, *, grace_seconds: int = DISCONNECT_GRACE, lateness: str | None = None
) -> DataFrame:
    """Stream of ``disconnect_detected`` and ``disconnect_timeout`` per connection.

    ``lifecycle`` is the stream of control rows with ``connection_key``. An open connection that
    closes, or is closed for a stale retry, is lost until it opens again; after the grace period
    it has timed out. Turns of one micro-batch are taken in the order of their ids, the run's end
    (``process_stop_requested`` with the connection's key) last; it drops the state.
    """
    grace = grace_seconds * _NS
    by_event_time = lateness is not None

    def watch(
        key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        known = ConnectionWatch(grace, _optional(state.get) if state.exists else None)
        ended = False
        if state.hasTimedOut:
            known.due(_now(state, by_event_time))
        else:
            rows = [row for frame in frames for row in zip(*(frame[c] for c in ("event_id", "event_type", "received_at_unix_ns")))]
            for event_id, kind, at in sorted(rows, key=lambda r: (r[1] == ENDED, r[0])):
                if kind == ENDED:
                    known.due(int(at))
                    ended = True
                else:
                    known.turn(kind, int(at), int(event_id))
        if ended:
            state.remove()
        else:
            state.update(known.state())
            _schedule(state, known.next_at(), by_event_time)
        if known.told:
            yield _rows(key, CONNECTION, known.told)

    turns = lifecycle.where(
        F.col("event_type").isin("socket_open", "socket_close", "feed_stale_retry", ENDED)
        & F.col("connection_key").isNotNull()
    ).select(*CONNECTION, "event_id", "event_type", "received_at_unix_ns")
    return (
        _timed(turns, "received_at_unix_ns", lateness)
        .groupBy(*CONNECTION)
        .applyInPandasWithState(
            watch, f"run_id string, component string, connection_key string, {_TOLD}",
            ConnectionWatch.FIELDS, "append", _timeouts(by_event_time),
        )
    )


def gate_control(told: DataFrame, first_event_seconds: int) -> DataFrame:
    """One ``first_event_timeout`` row per run from the symbols that were missing at its gate.

    All symbols of a run have one deadline, so they are told of in one micro-batch. Symbols are
    gathered by component, at most the configured ones.
    """
    missing = told.where(F.col("event_type") == "first_event_missing")
    by_component = missing.groupBy("run_id", "component").agg(
        F.array_sort(F.collect_set("symbol_upper")).alias("symbols"),
        F.max("at_ns").alias("at_ns"),
    )
    return by_component.groupBy("run_id").agg(
        F.max("at_ns").alias("received_at_unix_ns"),
        F.to_json(
            F.struct(
                F.array_sort(F.collect_list("component")).alias("missing_streams"),
                F.map_from_entries(F.collect_list(F.struct("component", "symbols"))).alias("missing_symbols"),
                F.lit(first_event_seconds).alias("timeout_seconds"),
            )
        ).alias("details_json"),
    ).select(
        "run_id", F.lit(0).cast("long").alias("event_id"), "received_at_unix_ns",
        F.lit("process").alias("component"), F.lit("first_event_timeout").alias("event_type"),
        F.lit("ERROR").alias("severity"), F.lit("Streams gave no first event").alias("message"),
        "details_json",
    )


def stale_control(told: DataFrame, timeout_seconds: int) -> DataFrame:
    """One ``feed_stale_detected`` row per run and component: symbols that a batch found silent."""
    stale = told.where(F.col("event_type") == "feed_stale")
    return stale.groupBy("run_id", "component").agg(
        F.max("event_id").alias("event_id"), F.max("at_ns").alias("received_at_unix_ns"),
        F.to_json(
            F.struct(
                F.lit(timeout_seconds).alias("timeout_seconds"),
                F.array_sort(F.collect_set(F.when(F.col("last_received_ns").isNotNull(), F.col("symbol_upper")))).alias("stale_symbols"),
                F.array_sort(F.collect_set(F.when(F.col("last_received_ns").isNull(), F.col("symbol_upper")))).alias("missing_symbols"),
            )
        ).alias("details_json"),
    ).select(
        "run_id", F.coalesce("event_id", F.lit(0)).cast("long").alias("event_id"), "received_at_unix_ns",
        "component", F.lit("feed_stale_detected").alias("event_type"),
        F.lit("WARNING").alias("severity"), F.lit("Symbols fell silent").alias("message"),
        "details_json",
    )


def outage_control(told: DataFrame, grace_seconds: int) -> DataFrame:
    """``disconnect_detected`` and ``<component>_disconnect_timeout`` as control rows."""
    over = F.col("event_type") == "disconnect_timeout"
    return told.select(
        "run_id", F.coalesce("event_id", F.lit(0)).cast("long").alias("event_id"),
        F.col("at_ns").alias("received_at_unix_ns"),
        "component",
        F.when(over, F.concat("component", F.lit("_disconnect_timeout"))).otherwise(F.col("event_type")).alias("event_type"),
        F.when(over, "ERROR").otherwise("WARNING").alias("severity"),
        F.when(over, "Connection was lost for longer than the grace period")
        .otherwise("Connection was lost").alias("message"),
        F.to_json(
            F.struct(
                F.col("connection_key").alias("connection"),
                F.lit(grace_seconds).alias("grace_seconds"),
                F.col("last_received_ns").alias("down_at_ns"),
            )
        ).alias("details_json"),
    )


def as_control(found: DataFrame, secrets: tuple[str, ...] = ()) -> DataFrame:
    """Health rows in the shape of the control stream; ids are those of the rows that caused them."""
    arrived = found.withColumns(
        {
            "connection_id": F.lit(None).cast("string"),
            "connection_epoch": F.lit(0),
            "received_at_monotonic_ns": F.col("received_at_unix_ns"),
        }
    )
    return normalize.control_events(
        arrived, component=F.col("component"), event_type=F.col("event_type"),
        severity=F.col("severity"), message=F.col("message"), details=F.col("details_json"),
        secrets=secrets,
    )


def _started(rows: DataFrame, record, checkpoint: str, flush_seconds: int | None) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(record).option("checkpointLocation", checkpoint)
    if flush_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{flush_seconds} seconds").start()


def record_health(
    events: DataFrame,
    lifecycle: DataFrame,
    configured: DataFrame,
    root: str,
    checkpoint: str,
    *,
    timeout_seconds: int = STALE_TIMEOUT,
    first_event_seconds: int = FIRST_EVENT_TIMEOUT,
    grace_seconds: int = DISCONNECT_GRACE,
    lateness: str | None = None,
    secrets: tuple[str, ...] = (),
    flush_seconds: int | None = 1,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Watch symbols and connections, and record what happens as control rows of the lake.

    Two queries, each with a folder and a checkpoint of its own (``health_control`` and
    ``outage_control``). A batch that is run again replaces itself.
    """
    symbols = live_symbols(
        events, lifecycle, configured, timeout_seconds=timeout_seconds,
        first_event_seconds=first_event_seconds, lateness=lateness,
    )
    outages = live_outages(lifecycle, grace_seconds=grace_seconds, lateness=lateness)
    started = []
    for told, target, shaped in (
        (symbols, schemas.HEALTH_CONTROL, lambda rows: gate_control(rows, first_event_seconds)
         .unionByName(stale_control(rows, timeout_seconds))),
        (outages, schemas.OUTAGE_CONTROL, lambda rows: outage_control(rows, grace_seconds)),
    ):
        progress = f"{checkpoint}/{target}"
        claim(events.sparkSession, stream_path(root, target), progress, by_batch=True)

        def record(batch: DataFrame, batch_id: int, target=target, shaped=shaped) -> None:
            kept = batch.persist()
            try:
                write_batch(as_control(shaped(kept), secrets), root, target, batch_id)
            finally:
                kept.unpersist()

        started.append(_started(told, record, progress, flush_seconds))
    return started[0], started[1]


def live_counts(events: DataFrame) -> DataFrame:
    """Running count per run and stream (complete or update mode)."""
    return events.groupBy("run_id", "source").agg(F.count(F.lit(1)).alias("received"))


def observed(events: DataFrame, name: str = "received") -> DataFrame:
    """The same rows, with per-batch counters in the query progress; costs no extra pass."""
    def per_stream(source: str):
        return F.count_if(F.col("source") == source).alias(source)

    return events.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        per_stream("symbol_update"),
        per_stream("tbt_depth"),
        per_stream("control"),
    )
