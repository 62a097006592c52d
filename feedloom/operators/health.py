"""Feed health of recorded runs: first-event gate, silence, retries, outages.

Times are receipt nanoseconds; timeouts are seconds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.scan import CHUNK_ROWS, Running, running

# Default limits in seconds, and the number of stale retries.
STALE_TIMEOUT = 60
STALE_RETRIES = 3
DISCONNECT_GRACE = 30
FIRST_EVENT_TIMEOUT = 30

COMPONENTS = ("data", "tbt")
_NS = 1_000_000_000


def first_event_gate(
    events: DataFrame,
    configured: DataFrame,
    runs: DataFrame,
    *,
    components: tuple[str, ...] = COMPONENTS,
    timeout_seconds: int = FIRST_EVENT_TIMEOUT,
) -> DataFrame:
    """Per configured symbol and component: first sight and whether it came in time.

    ``runs`` has ``run_id, opened_at_ns``; ``configured`` has ``run_id, symbol_upper``;
    ``events`` has ``run_id, component, symbol, received_at_unix_ns``. Any late or missing
    symbol fails the run.
    """
    expected = configured.select(
        "run_id",
        F.explode(F.array(*[F.lit(name) for name in components])).alias("component"),
        "symbol_upper",
    )
    seen = events.groupBy("run_id", "component", F.upper("symbol").alias("symbol_upper")).agg(
        F.min("received_at_unix_ns").alias("first_seen_ns")
    )
    deadline = F.col("opened_at_ns") + F.lit(timeout_seconds * _NS)
    verdict = (
        F.when(F.col("first_seen_ns").isNull(), "missing")
        .when(F.col("first_seen_ns") <= deadline, "in_time")
        .otherwise("late")
    )
    return (
        expected.join(seen, ["run_id", "component", "symbol_upper"], "left")
        .join(runs.select("run_id", "opened_at_ns"), "run_id")
        .withColumn("arrival", verdict)
    )


def silences(
    events: DataFrame,
    runs: DataFrame,
    *,
    timeout_seconds: int = STALE_TIMEOUT,
    configured: DataFrame | None = None,
    components: tuple[str, ...] = COMPONENTS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Spans in which a configured symbol was silent for at least the timeout.

    ``runs`` has ``run_id, ready_at_ns, ended_at_ns``. A span runs from one receipt to the next,
    or to the end of the run (``open_ended``). It counts from the moment the streams were ready:
    a run that never became ready has no silences. A configured symbol is silent until its first
    receipt, or throughout (``silent_from_ns`` null), and stale as soon as the streams are ready.
    A timeout of zero switches the check off.
    """
    window = runs.select("run_id", "ready_at_ns", "ended_at_ns").where(
        F.col("ready_at_ns").isNotNull()
    )
    keys = ["run_id", "component", "symbol_upper"]
    arrivals = events.select(
        "run_id", "component", F.upper("symbol").alias("symbol_upper"), "event_id",
        "received_at_unix_ns",
    )
    # A span shorter than the timeout cannot count; dropping those leaves little to join.
    between = (
        running(
            arrivals,
            keys,
            "event_id",
            {"silent_from_ns": Running(F.col("received_at_unix_ns"))},
            chunk_rows=chunk_rows,
        )
        .where(
            F.col("received_at_unix_ns") - F.col("silent_from_ns") >= timeout_seconds * _NS
        )
        .select(*keys, "silent_from_ns", F.col("received_at_unix_ns").alias("silent_until_ns"))
    )
    open_ended = F.lit(None).cast("bigint").alias("silent_until_ns")
    ends = arrivals.groupBy(*keys).agg(
        F.max_by("received_at_unix_ns", "event_id").alias("silent_from_ns"),
        F.min_by("received_at_unix_ns", "event_id").alias("first_ns"),
    )
    spans = between.unionByName(ends.select(*keys, "silent_from_ns", open_ended))
    if configured is not None:
        expected = configured.select(
            "run_id", F.explode(F.array(*[F.lit(c) for c in components])).alias("component"),
            "symbol_upper",
        )
        unseen = F.lit(None).cast("bigint").alias("silent_from_ns")
        first = F.col("first_ns").alias("silent_until_ns")
        spans = spans.unionByName(
            expected.join(ends.select(*keys, "first_ns"), keys, "left").select(*keys, unseen, first)
        )
    until = F.col("silent_until_ns")
    stale_at = stale_moment(F.col("silent_from_ns"), F.col("ready_at_ns"), timeout_seconds)
    return (
        spans.join(window, "run_id")
        .withColumns(
            {
                "silent_until_ns": F.coalesce(until, F.col("ended_at_ns")),
                "open_ended": until.isNull(),
                "stale_at_ns": stale_at,
            }
        )
        .where((F.lit(timeout_seconds) > 0) & (F.col("stale_at_ns") <= until))
        .drop("ready_at_ns", "ended_at_ns")
    )


def stale_moment(silent_from: Column, ready_at: Column, timeout_seconds: int) -> Column:
    """When a silence turns stale: after the timeout, not before ready, at once if never seen."""
    return F.greatest(silent_from + F.lit(timeout_seconds * _NS), ready_at)


CONNECTION = ["run_id", "component", "connection_key"]
_ATTEMPTS = (
    "run_id string, component string, connection_key string, attempt int, at_ns long, "
    "event_type string"
)
#: Silences are thinned in stretches of so many timeouts, which bounds a symbol's share of each.
_STRETCH = 64


def on_connections(
    symbols: DataFrame, configured: DataFrame, components: tuple[str, ...] = COMPONENTS
) -> DataFrame:
    """Rows by ``run_id, component, symbol_upper`` with their ``connection_key``.

    All symbols of a run share one quote connection; ``configured`` names the depth connections.
    """
    return symbols.join(members(configured, components), ["run_id", "component", "symbol_upper"])


def members(configured: DataFrame, components: tuple[str, ...] = COMPONENTS) -> DataFrame:
    """Every component's configured symbols with the connection that carries them."""
    return configured.select(
        "run_id",
        F.explode(F.array(*[F.lit(name) for name in components])).alias("component"),
        "symbol_upper",
        F.col("connection_key").alias("_depth_connection"),
    ).select(
        "run_id",
        "component",
        "symbol_upper",
        F.when(F.col("component") == "tbt", F.col("_depth_connection"))
        .otherwise(F.col("component"))
        .alias("connection_key"),
    )


def leading_silences(stale: DataFrame, *, timeout_seconds: int = STALE_TIMEOUT) -> DataFrame:
    """Silences per connection that reach beyond all that began before them.

    ``stale`` holds silences with ``component, connection_key, stale_at_ns, silent_until_ns``. A
    retry comes one timeout after the latest of a silence's begin and the last retry, as long as
    the silence lasts. A silence within a longer one that began earlier is never the one that
    decides, so a connection with many symbols shrinks to its outline before it is swept.
    """
    timeout = timeout_seconds * _NS
    begins = stale.groupBy(*CONNECTION, (F.col("stale_at_ns") - timeout).alias("begin_ns")).agg(
        F.max("silent_until_ns").alias("end_ns")
    )
    outlined = running(
        begins, CONNECTION, "begin_ns", {"_reach": Running(F.col("end_ns"), "max")},
        chunk_rows=max(1, _STRETCH * timeout),
    )
    return outlined.where(
        F.col("_reach").isNull() | (F.col("end_ns") > F.col("_reach"))
    ).drop("_reach")


class _Sweep:
    """Retries of one connection, fed silences in order of their begin; keeps five numbers."""

    def __init__(self, timeout: int, retries: int) -> None:
        self.timeout, self.retries = timeout, retries
        self.reach: int | None = None
        self.retry_at: int | None = None
        self.attempt, self.failed = 0, False

    def _retry(self, at: int) -> tuple[int, int, str]:
        # Had a symbol stayed silent since the last retry, this one would follow after a timeout.
        if self.retry_at is not None and at > self.retry_at + self.timeout:
            self.attempt = 0
        self.retry_at = at
        if self.attempt >= self.retries:
            self.failed = True
            return self.attempt, at, "feed_stale"
        self.attempt += 1
        return self.attempt, at, "feed_stale_retry"

    def until(self, begin: int | None) -> Iterator[tuple[int, int, str]]:
        """Retries that silences seen so far cause before one that begins at ``begin`` is known."""
        while not self.failed and self.retry_at is not None and self.reach is not None:
            due = self.retry_at + self.timeout
            if self.reach < due or (begin is not None and begin <= self.retry_at):
                return
            yield self._retry(due)

    def add(self, begin: int, end: int) -> Iterator[tuple[int, int, str]]:
        yield from self.until(begin)
        if not self.failed and (self.retry_at is None or begin > self.retry_at):
            # Nothing that began earlier lasts a timeout from the last retry on.
            yield self._retry(begin + self.timeout)
        self.reach = end if self.reach is None else max(self.reach, end)


def stale_attempts(
    stale: DataFrame,
    *,
    timeout_seconds: int = STALE_TIMEOUT,
    retries: int = STALE_RETRIES,
) -> DataFrame:
    """Retries per connection in order, up to the fatal one.

    ``stale`` holds the silences with ``component, connection_key``. A retry restarts the clock of
    all symbols of the connection; if the next one follows after more than the timeout, all were
    fresh in between, and the count begins anew.

    Each connection's outline is sorted and swept once, row by row, with a state of a few numbers:
    nothing of a connection is gathered, however many symbols it carries.
    """
    timeout = timeout_seconds * _NS

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, out = None, _Sweep(timeout, retries), []
        for batch in batches:
            for *names, begin, end in batch.itertuples(index=False):
                if names != key:
                    if key is not None:
                        out += [(*key, *row) for row in state.until(None)]
                    key, state = names, _Sweep(timeout, retries)
                out += [(*key, *row) for row in state.add(int(begin), int(end))]
            yield pd.DataFrame(out, columns=[*CONNECTION, "attempt", "at_ns", "event_type"])
            out = []
        if key is not None:
            out = [(*key, *row) for row in state.until(None)]
            yield pd.DataFrame(out, columns=[*CONNECTION, "attempt", "at_ns", "event_type"])

    outline = leading_silences(stale, timeout_seconds=timeout_seconds).select(
        *CONNECTION, "begin_ns", "end_ns"
    )
    # Few bytes but work per row: a set number of partitions keeps AQE from merging them.
    width = int(stale.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        outline.repartition(width, *CONNECTION)
        .sortWithinPartitions(*CONNECTION, "begin_ns")
        .mapInPandas(sweep, _ATTEMPTS)
    )


def recoveries(
    attempts: DataFrame,
    events: DataFrame,
    configured: DataFrame,
    *,
    timeout_seconds: int = STALE_TIMEOUT,
    components: tuple[str, ...] = COMPONENTS,
) -> DataFrame:
    """``feed_recovered`` rows: when the last symbol of a retried connection was fresh again.

    Shaped like ``stale_attempts``. A retry that is not followed by another after a timeout has
    every symbol's next receipt within it, or the run ended before. Receipts are met by equal
    joins on symbol and stretch of a timeout: each meets the one or two retries it may belong to.
    """
    timeout = timeout_seconds * _NS
    if timeout <= 0:
        return attempts.where(F.lit(False))

    def stretch(ns: Column) -> Column:
        return F.call_function("div", ns, F.lit(timeout))

    at = F.col("at_ns")
    waiting = (
        attempts.where(F.col("event_type") == "feed_stale_retry")
        .join(members(configured, components), CONNECTION)
        .withColumn("_stretch", F.explode(F.array(stretch(at), stretch(at) + 1)))
    )
    receipts = events.select(
        "run_id",
        "component",
        F.upper("symbol").alias("symbol_upper"),
        "received_at_unix_ns",
        stretch(F.col("received_at_unix_ns")).alias("_stretch"),
    )
    fresh = (F.col("received_at_unix_ns") > at) & (F.col("received_at_unix_ns") < at + timeout)
    per_symbol = (
        waiting.join(receipts, ["run_id", "component", "symbol_upper", "_stretch"], "left")
        .groupBy(*CONNECTION, "attempt", "at_ns", "symbol_upper")
        .agg(F.min(F.when(fresh, F.col("received_at_unix_ns"))).alias("fresh_ns"))
    )
    return (
        per_symbol.groupBy(*CONNECTION, "attempt", "at_ns")
        .agg(
            F.max("fresh_ns").alias("recovered_ns"),
            F.count("fresh_ns").alias("_fresh"),
            F.count(F.lit(1)).alias("_all"),
        )
        .where("_fresh = _all")
        .select(
            *CONNECTION, "attempt", F.col("recovered_ns").alias("at_ns"),
            F.lit("feed_recovered").alias("event_type"),
        )
    )


def with_connection_key(control: DataFrame) -> DataFrame:
    """Recover the connection of control rows that carry only a connection id.

    For quotes the component is the connection. Depth rows take it from the ``socket_open`` row
    of the same connection id, whose details name it.
    """
    opens = (
        control.where((F.col("event_type") == "socket_open") & (F.col("component") == "tbt"))
        .groupBy("run_id", "connection_id")
        .agg(F.max(F.get_json_object("details_json", "$.connection")).alias("_opened_as"))
    )
    return control.join(opens, ["run_id", "connection_id"], "left").select(
        *control.columns,
        F.when(F.col("component") == "tbt", F.col("_opened_as"))
        .otherwise(F.col("component"))
        .alias("connection_key"),
    )


def outages(
    control: DataFrame,
    runs: DataFrame,
    *,
    grace_seconds: int = DISCONNECT_GRACE,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Spans from the loss of an open connection to its next opening, or to the run's end.

    ``control`` carries ``connection_key``; ``runs`` has ``run_id, ended_at_ns``. Further close
    rows within an outage do not start another. A stale retry closes the connection itself, so it
    starts an outage as well. An outage of at least the grace period is fatal.
    """
    keys = ("run_id", "connection_key")
    turns = control.where(F.col("event_type").isin("socket_open", "socket_close", "feed_stale_retry")).select(
        *keys, "component", "event_id", "event_type", "received_at_unix_ns"
    )
    opened = F.when(F.col("event_type") == "socket_open", F.col("received_at_unix_ns"))
    with_previous = running(
        turns, keys, "event_id", {"_was_open": Running(F.col("event_type") == "socket_open")},
        chunk_rows=chunk_rows,
    )
    # Only transitions matter from here: the first loss after an open, and opens.
    changes = with_previous.where(
        (F.col("event_type") == "socket_open") | F.col("_was_open")
    )
    spans = running(
        changes, keys, "event_id", {"up_at_ns": Running(opened)}, forward=False,
        chunk_rows=chunk_rows,
    ).where(F.col("event_type") != "socket_open")
    length = F.coalesce("up_at_ns", "ended_at_ns") - F.col("down_at_ns")
    timed_out = F.col("outage_ns") >= F.lit(grace_seconds * _NS)
    return (
        spans.withColumnRenamed("received_at_unix_ns", "down_at_ns")
        .join(runs.select("run_id", "ended_at_ns"), "run_id", "left")
        .withColumn("outage_ns", length)
        .withColumn("timed_out", timed_out)
        .withColumn(
            "fatal_reason",
            F.when(F.col("timed_out"), F.concat("component", F.lit("_disconnect_timeout"))),
        )
        .select(
            *keys, "component", "event_id", "down_at_ns", "up_at_ns", "outage_ns", "timed_out",
            "fatal_reason",
        )
    )
