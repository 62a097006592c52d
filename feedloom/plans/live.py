"""Queries over live health: the event feeds as streams, watched over restarts."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import health
from feedloom.plans import feeds
from feedloom.plans.feeds import CONTROL_SQL, with_sql
from feedloom.plans.runs import OUTAGES_SQL, STALE_SQL
from feedloom.session import shared_dir
from feedloom.streaming import health as live

_EVENTS = "run_id string, event_id long, component string, symbol string, received_at_unix_ns long"
_TURNS = (
    "run_id string, event_id long, component string, connection_key string, event_type string, "
    "received_at_unix_ns long"
)
STARTS = 3


def _turns(spark, sf):
    """Lifecycle rows: opens and closes, and each run's beginning and end on all its connections."""
    spans = feeds.run_spans(spark, sf)
    connections = (
        health.members(feeds.configured_per_run(spark, sf))
        .select("run_id", "component", "connection_key")
        .distinct()
    )
    stops = connections.join(spans, "run_id").select(
        "run_id", F.lit(0).cast("long").alias("event_id"), "component", "connection_key",
        F.lit(live.ENDED).alias("event_type"), F.col("ended_at_ns").alias("received_at_unix_ns"),
    )
    ready = spans.select(
        "run_id", F.lit(0).cast("long").alias("event_id"), F.lit("process").alias("component"),
        F.lit(None).cast("string").alias("connection_key"), F.lit(live.READY).alias("event_type"),
        F.col("ready_at_ns").alias("received_at_unix_ns"),
    )
    opened = feeds.control_core(spark, sf).select(*stops.columns)
    return opened.unionByName(stops).unionByName(ready)


def live_health(spark, sf):
    """Silent symbols and lost connections as two streams tell of them, each started three times.

    Rows arrive in thirds of the time they span; timers follow their stamps.
    """
    events = feeds.stored(
        feeds.seen_events(spark, sf).select(
            "run_id", "event_id", "component", "symbol", "received_at_unix_ns"
        ),
        "seen",
    )
    turns = feeds.stored(_turns(spark, sf), "turns")
    first, last = events.agg(F.min("received_at_unix_ns"), F.max("received_at_unix_ns")).first()
    first, last = first or 0, last or 0  # An empty table has no stamps.
    third = F.floor(
        (F.col("received_at_unix_ns") - first).cast("decimal(38,0)") * STARTS / (last - first + 1)
    )
    part = F.least(F.greatest(third, F.lit(0)), F.lit(STARTS - 1))
    landing, out = shared_dir(spark, "landing"), shared_dir(spark, "told")
    configured = feeds.configured_per_run(spark, sf)
    for number in range(STARTS):
        for rows, name in ((events, "events"), (turns, "turns")):
            rows.where(part == number).write.mode("append").json(f"{landing}/{name}")
        arrived = spark.readStream.schema(_EVENTS).json(f"{landing}/events")
        told_turns = spark.readStream.schema(_TURNS).json(f"{landing}/turns")
        symbols = live.live_symbols(
            arrived, told_turns, configured, timeout_seconds=feeds.STALE_SECONDS,
            first_event_seconds=0, lateness="1 day",
        )
        outages = live.live_outages(
            told_turns, grace_seconds=feeds.GRACE_SECONDS, lateness="1 day"
        )
        for told, key, name in (
            (symbols, "symbol_upper", "symbols"), (outages, "connection_key", "outages"),
        ):
            told.select("run_id", "component", F.col(key).alias("key"), "event_type", "at_ns").writeStream.format(
                "parquet"
            ).option("path", f"{out}/{name}").option(
                "checkpointLocation", f"{out}/progress-{name}"
            ).trigger(availableNow=True).start().awaitTermination()
    found = "run_id string, component string, key string, event_type string, at_ns long"
    return spark.read.schema(found).parquet(f"{out}/symbols").unionByName(
        spark.read.schema(found).parquet(f"{out}/outages")
    )


QUERIES = {
    "live_health": (live_health, STALE_SQL + ",\n" + CONTROL_SQL + ",\n" + OUTAGES_SQL + f"""
SELECT run_id, component, symbol_upper AS key, 'feed_stale' AS event_type, stale_at_ns AS at_ns
FROM silences WHERE stale_at_ns <= silent_until_ns
UNION ALL
SELECT run_id, component, symbol_upper, 'feed_fresh', silent_until_ns
FROM silences WHERE stale_at_ns <= silent_until_ns AND NOT open_ended
UNION ALL
SELECT run_id, component, connection_key, 'disconnect_detected', received_at_unix_ns FROM found
UNION ALL
SELECT run_id, component, connection_key, 'disconnect_timeout',
       received_at_unix_ns + {feeds.GRACE_SECONDS * 1_000_000_000}
FROM found WHERE outage_ns >= {feeds.GRACE_SECONDS * 1_000_000_000}"""),
}
