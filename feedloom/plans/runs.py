"""Queries over runs: readiness, silence, outages, reasons, verdicts, coverage, quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.operators import health, manifest, quality, replay, sequence, universe
from feedloom.plans import feeds
from feedloom.plans.feeds import (
    CONFIGURED_SQL, CONTROL_SQL, DEPTH_SQL, LINES_SQL, QUOTES_SQL, RUN_UNIVERSE_SQL, SEEN_SQL,
    SPANS_SQL, TICKS_SQL, stored, table, with_sql,
)

_NS = 1_000_000_000
RETRIES = 3


def first_event_gate(spark, sf):
    return health.first_event_gate(
        feeds.seen_events(spark, sf),
        feeds.configured_per_run(spark, sf),
        feeds.run_spans(spark, sf),
        timeout_seconds=feeds.GATE_SECONDS,
    ).select("run_id", "component", "symbol_upper", "first_seen_ns", "arrival")


KINDS = ("view", "click", "purchase", "signup", "error")


def missing_symbols(spark, sf):
    """Symbols a run never saw on a feed, with every kind of event as a feed of its own."""
    seen = feeds.ticks(spark, sf).select(
        "run_id", F.col("kind").alias("component"), feeds.spelled_symbol().alias("symbol")
    )
    return universe.missing_symbols(
        feeds.configured_per_run(spark, sf), seen, ["run_id"], KINDS
    )


def stale_feeds(spark, sf):
    return health.silences(
        feeds.seen_events(spark, sf),
        feeds.run_spans(spark, sf),
        timeout_seconds=feeds.STALE_SECONDS,
        configured=feeds.configured_per_run(spark, sf),
    )


def _retries(spark, sf):
    """Retries of both feeds' connections, and their recoveries."""
    seen, configured = feeds.seen_events(spark, sf), feeds.configured_per_run(spark, sf)
    stale = health.silences(
        seen, feeds.run_spans(spark, sf), timeout_seconds=feeds.STALE_SECONDS, configured=configured
    )
    attempts = health.stale_attempts(
        health.on_connections(stale, configured),
        timeout_seconds=feeds.STALE_SECONDS, retries=RETRIES,
    )
    # Few rows after much work, read by both branches.
    attempts = stored(attempts, "retries")
    return attempts.unionByName(
        health.recoveries(attempts, seen, configured, timeout_seconds=feeds.STALE_SECONDS)
    )


def stale_attempts(spark, sf):
    return _retries(spark, sf)


def outages(spark, sf):
    return health.outages(
        feeds.control_core(spark, sf), feeds.run_spans(spark, sf),
        grace_seconds=feeds.GRACE_SECONDS,
    )


def _effects(spark, sf):
    return quality.with_effects(feeds.line_control(spark, sf))


def degraded_reasons(spark, sf):
    return quality.degraded_reasons(_effects(spark, sf)).select(
        "run_id", F.array_join("degraded_reasons", ",").alias("degraded_reasons")
    )


def run_status(spark, sf):
    return quality.run_status(_effects(spark, sf))


def received_counts(spark, sf):
    return quality.received_counts(feeds.line_control(spark, sf))


def run_coverage(spark, sf):
    return quality.coverage(feeds.seen_events(spark, sf))


def replay_quarantine(spark, sf):
    """Rows per run that replay refuses: failed runs and runs without a marker."""
    refused = replay.quarantined(
        feeds.line_control(spark, sf), feeds.order_runs(spark, sf).select("run_id", "status")
    )
    return refused.groupBy("run_id", "source").agg(F.count(F.lit(1)).alias("rows"))


def replay_trusted(spark, sf):
    kept = replay.trusted(
        feeds.line_control(spark, sf), feeds.order_runs(spark, sf).select("run_id", "status")
    )
    return kept.select("run_id", "event_id", "source", "event_type")


def _recorded(spark, sf):
    """Events and control effects of the event feeds, as a manifest sees them."""
    diagnosed = sequence.diagnose(feeds.depth_core(spark, sf))
    steps = sequence.sequence_events(diagnosed).select(
        "run_id", "event_id", F.lit("tbt").alias("component"), "event_type", "severity",
        "connection_epoch", "details_json",
    )
    turns = sequence.with_epochs(feeds.control_core(spark, sf)).select(
        "run_id", "event_id", "component", "event_type", "severity",
        F.col("epoch").alias("connection_epoch"), "details_json",
    )
    return quality.with_effects(turns.unionByName(steps))


def run_reasons(spark, sf):
    """Reasons of the event runs, with the rows behind each."""
    return (
        _recorded(spark, sf)
        .where(F.col("degraded_reason").isNotNull())
        .groupBy("run_id", "degraded_reason")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_event_id"))
    )


SETTINGS = {"zone": "Asia/Kolkata", "token": "not-for-show", "rows_per_file": "5000"}


def run_manifest(spark, sf):
    """Manifests of the event runs; maps and lists are spelled out as text for comparison."""
    built = manifest.manifests(
        feeds.seen_events(spark, sf), _recorded(spark, sf), settings=SETTINGS,
        configured=feeds.configured_per_run(spark, sf),
        secret_names=("token",), require_ready=False,
    )
    return built.select(
        F.col("first_events_seen")["data"].alias("all_data"),
        F.col("first_events_seen")["tbt"].alias("all_tbt"),
        "streams_ready", "fatal_error",
        "schema_version", "run_id", "status", "clean_shutdown", "stop_reason",
        "started_at_unix_ns", "ended_at_unix_ns",
        F.array_join("degraded_reasons", ",").alias("degraded_reasons"),
        F.col("received_events")["tbt_depth"].alias("received_depth"),
        F.col("received_events")["symbol_update"].alias("received_quotes"),
        F.col("symbols_seen")["data"].alias("symbols_data"),
        F.col("symbols_seen")["tbt"].alias("symbols_tbt"),
        F.col("connection_epochs")["data"].alias("epoch_data"),
        F.col("configuration")["token"].alias("token"),
        F.col("configuration")["zone"].alias("zone"),
    )


SEEN_VIEW = with_sql(TICKS_SQL, CONFIGURED_SQL, RUN_UNIVERSE_SQL, SEEN_SQL, SPANS_SQL)
_EXPECTED = """expected AS (
  SELECT u.run_id, c.component, u.symbol_upper, u.connection_key
  FROM run_universe u, (VALUES ('data'), ('tbt')) c(component))"""
_SILENCES = f"""{_EXPECTED},
gaps AS (
  SELECT run_id, component, symbol_upper,
         lag(received_at_unix_ns) OVER (PARTITION BY run_id, component, symbol_upper ORDER BY event_id)
           AS silent_from_ns, received_at_unix_ns AS silent_until_ns, false AS open_ended
  FROM seen),
spans_of AS (
  SELECT * FROM gaps WHERE silent_from_ns IS NOT NULL
  UNION ALL
  SELECT s.run_id, s.component, s.symbol_upper, max_by(s.received_at_unix_ns, s.event_id),
         max(r.ended_at_ns), true
  FROM seen s JOIN spans r USING (run_id) GROUP BY ALL
  UNION ALL
  SELECT e.run_id, e.component, e.symbol_upper, NULL, coalesce(f.first_ns, r.ended_at_ns),
         f.first_ns IS NULL
  FROM expected e JOIN spans r USING (run_id)
  LEFT JOIN (SELECT run_id, component, symbol_upper, min(received_at_unix_ns) AS first_ns
             FROM seen GROUP BY ALL) f USING (run_id, component, symbol_upper)),
silences AS (
  SELECT o.run_id, o.component, o.symbol_upper, o.silent_from_ns, o.silent_until_ns, o.open_ended,
         greatest(coalesce(o.silent_from_ns + {feeds.STALE_SECONDS * _NS}, r.ready_at_ns), r.ready_at_ns)
           AS stale_at_ns
  FROM spans_of o JOIN spans r USING (run_id))"""
_T = feeds.STALE_SECONDS * _NS
OUTAGES_SQL = """turns AS (
  SELECT *, lag(event_type) OVER w AS previous,
         first_value(CASE WHEN event_type = 'socket_open' THEN received_at_unix_ns END IGNORE NULLS)
           OVER (PARTITION BY run_id, connection_key ORDER BY event_id
                 ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS up_at_ns
  FROM control WINDOW w AS (PARTITION BY run_id, connection_key ORDER BY event_id)),
found AS (
  SELECT t.*, coalesce(up_at_ns, r.ended_at_ns) - received_at_unix_ns AS outage_ns
  FROM turns t JOIN spans r USING (run_id)
  WHERE event_type = 'socket_close' AND previous = 'socket_open')"""
STALE_SQL = SEEN_VIEW.rstrip() + ",\n" + _SILENCES
_CONNECTION = "run_id, component, connection_key"
RETRIES_VIEW = (
    SEEN_VIEW.replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + ",\n" + _SILENCES + f""",
carried AS (
  SELECT run_id, component, symbol_upper,
         CASE component WHEN 'tbt' THEN connection_key ELSE component END AS connection_key
  FROM expected),
stale AS (
  SELECT run_id, component, c.connection_key, s.stale_at_ns, s.silent_until_ns
  FROM silences s JOIN carried c USING (run_id, component, symbol_upper)
  WHERE s.stale_at_ns <= s.silent_until_ns),
attempts AS (
  SELECT {_CONNECTION}, 1 AS attempt, min(stale_at_ns) AS at_ns FROM stale GROUP BY ALL
  UNION ALL
  SELECT {_CONNECTION},
         CASE WHEN n.at_ns > n.before_ns + {_T} THEN 1 ELSE n.attempt + 1 END, n.at_ns
  FROM (SELECT {_CONNECTION}, a.attempt, a.at_ns AS before_ns,
               min(greatest(s.stale_at_ns, a.at_ns + {_T})) AS at_ns
        FROM attempts a JOIN stale s USING ({_CONNECTION})
        WHERE a.attempt <= {RETRIES} AND greatest(s.stale_at_ns, a.at_ns + {_T}) <= s.silent_until_ns
        GROUP BY ALL) n),
fresh AS (
  SELECT a.run_id, a.component, a.connection_key, a.attempt, a.at_ns, c.symbol_upper,
         min(s.received_at_unix_ns) AS fresh_ns
  FROM attempts a JOIN carried c USING ({_CONNECTION})
  LEFT JOIN seen s ON s.run_id = a.run_id AND s.component = a.component
    AND s.symbol_upper = c.symbol_upper AND s.received_at_unix_ns > a.at_ns
    AND s.received_at_unix_ns < a.at_ns + {_T}
  WHERE a.attempt <= {RETRIES} GROUP BY ALL),
turns_of AS (
  SELECT {_CONNECTION}, least(attempt, {RETRIES}) AS attempt, at_ns,
         CASE WHEN attempt > {RETRIES} THEN 'feed_stale' ELSE 'feed_stale_retry' END AS event_type
  FROM attempts
  UNION ALL
  SELECT {_CONNECTION}, attempt, max(fresh_ns), 'feed_recovered'
  FROM fresh GROUP BY {_CONNECTION}, attempt, at_ns HAVING count(fresh_ns) = count(*))
""")

QUERIES = {
    "first_event_gate": (first_event_gate, SEEN_VIEW.rstrip() + ",\n" + _EXPECTED + f"""
SELECT e.run_id, e.component, e.symbol_upper, f.first_seen_ns,
       CASE WHEN f.first_seen_ns IS NULL THEN 'missing'
            WHEN f.first_seen_ns <= r.ready_at_ns + {feeds.GATE_SECONDS * _NS} THEN 'in_time'
            ELSE 'late' END AS arrival
FROM expected e JOIN spans r USING (run_id)
LEFT JOIN (SELECT run_id, component, symbol_upper, min(received_at_unix_ns) AS first_seen_ns
           FROM seen GROUP BY ALL) f USING (run_id, component, symbol_upper)"""),
    "missing_symbols": (missing_symbols, with_sql(TICKS_SQL, CONFIGURED_SQL, RUN_UNIVERSE_SQL) + f"""
SELECT u.run_id, c.component, u.symbol_upper FROM run_universe u,
  (SELECT unnest({list(KINDS)}) AS component) c
EXCEPT SELECT run_id, kind, upper({feeds.SYMBOL_SQL}) FROM ticks"""),
    "stale_feeds": (stale_feeds, SEEN_VIEW.rstrip() + ",\n" + _SILENCES + """
SELECT * FROM silences WHERE stale_at_ns <= silent_until_ns"""),
    "stale_attempts": (stale_attempts, RETRIES_VIEW + "SELECT * FROM turns_of"),
    "outages": (outages, with_sql(TICKS_SQL, CONTROL_SQL, SPANS_SQL) + ", " + OUTAGES_SQL + f"""
SELECT run_id, connection_key, component, event_id, received_at_unix_ns AS down_at_ns, up_at_ns,
       outage_ns, outage_ns >= {feeds.GRACE_SECONDS * _NS} AS timed_out,
       CASE WHEN outage_ns >= {feeds.GRACE_SECONDS * _NS} THEN component || '_disconnect_timeout' END
         AS fatal_reason FROM found"""),
    "degraded_reasons": (degraded_reasons, with_sql(LINES_SQL) + """
SELECT run_id, string_agg(DISTINCT degraded_reason, ',' ORDER BY degraded_reason) AS degraded_reasons
FROM effects WHERE degraded_reason IS NOT NULL GROUP BY run_id"""),
    "run_status": (run_status, with_sql(LINES_SQL) + """
, verdicts AS (
  SELECT run_id, min({'e': event_id, 'r': fatal_reason}) FILTER (WHERE fatal_reason IS NOT NULL)
      AS fatal, count(degraded_reason) AS degrading,
    count(*) FILTER (WHERE event_type = 'streams_ready') AS ready
  FROM effects GROUP BY run_id),
stops AS (SELECT *, CASE WHEN fatal IS NOT NULL THEN fatal.r
    WHEN ready = 0 THEN 'streams_not_ready' END AS stop_reason FROM verdicts)
SELECT run_id, stop_reason,
  CASE WHEN stop_reason IS NOT NULL THEN 'failed' WHEN degrading > 0 THEN 'degraded'
    ELSE 'complete' END AS status,
  CASE WHEN stop_reason IS NOT NULL THEN '_FAILED' WHEN degrading > 0 THEN '_DEGRADED'
    ELSE '_SUCCESS' END AS marker FROM stops"""),
    "received_counts": (received_counts, with_sql(LINES_SQL) + """
SELECT run_id, source, count(*) AS received FROM lines GROUP BY ALL"""),
    "run_coverage": (run_coverage, with_sql(TICKS_SQL, SEEN_SQL) + """
SELECT run_id, component, symbol_upper, min(event_id) AS first_event_id, 1 AS last_epoch,
       count(*) AS rows FROM seen GROUP BY ALL"""),
    "replay_quarantine": (replay_quarantine, with_sql(LINES_SQL) + """
SELECT run_id, source, count(*) AS rows FROM lines WHERE run_id NOT IN (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'
    OR (o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT')) GROUP BY ALL"""),
    "replay_trusted": (replay_trusted, with_sql(LINES_SQL) + """
SELECT run_id, event_id, source, event_type FROM lines WHERE run_id IN (
  SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'
    OR (o_orderstatus = 'P' AND o_orderpriority <> '1-URGENT'))"""),
}
from feedloom.plans.depth import DIAGNOSED_SQL  # noqa: E402

_REASONS = with_sql(TICKS_SQL, DIAGNOSED_SQL, CONTROL_SQL, SEEN_SQL) + """
, opened AS (
  SELECT *, count(*) FILTER (WHERE event_type = 'socket_open') OVER (
      PARTITION BY run_id, connection_key ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS epoch
  FROM control),
reasons AS (
  SELECT run_id, event_id, CASE WHEN event_type = 'socket_open' THEN
      CASE WHEN epoch > 1 THEN component || '_reconnected' END
    WHEN severity = 'WARNING' THEN component || '_socket_closed' END AS degraded_reason
  FROM opened
  UNION ALL
  SELECT run_id, event_id, 'tbt_sequence_' || base_status FROM diagnosed
  WHERE base_status IN ('gap', 'regression'))
"""
QUERIES["run_reasons"] = (run_reasons, _REASONS + """
SELECT run_id, degraded_reason, count(*) AS rows, min(event_id) AS first_event_id FROM reasons
WHERE degraded_reason IS NOT NULL GROUP BY ALL""")
QUERIES["run_manifest"] = (run_manifest, _REASONS + """
, per_run AS (
  SELECT run_id, string_agg(DISTINCT degraded_reason, ',' ORDER BY degraded_reason) AS degraded_reasons
  FROM reasons GROUP BY run_id)
SELECT 1 AS schema_version, s.run_id,
       CASE WHEN max(p.degraded_reasons) IS NULL THEN 'complete' ELSE 'degraded' END AS status,
       true AS clean_shutdown, NULL AS stop_reason, min(received_at_unix_ns) AS started_at_unix_ns,
       max(received_at_unix_ns) AS ended_at_unix_ns,
       coalesce(max(p.degraded_reasons), '') AS degraded_reasons,
       count(*) FILTER (WHERE component = 'tbt') AS received_depth,
       count(*) FILTER (WHERE component = 'data') AS received_quotes,
       count(DISTINCT symbol_upper) FILTER (WHERE component = 'data') AS symbols_data,
       count(DISTINCT symbol_upper) FILTER (WHERE component = 'tbt') AS symbols_tbt,
       (SELECT max(epoch) FROM opened o WHERE o.run_id = s.run_id AND o.component = 'data') AS epoch_data,
       '<redacted>' AS token, 'Asia/Kolkata' AS zone,
       count(DISTINCT symbol_upper) FILTER (WHERE component = 'data')
         = (SELECT count(DISTINCT user_id) FROM ticks) AS all_data,
       count(DISTINCT symbol_upper) FILTER (WHERE component = 'tbt')
         = (SELECT count(DISTINCT user_id) FROM ticks) AS all_tbt,
       false AS streams_ready, NULL AS fatal_error
FROM seen s LEFT JOIN per_run p USING (run_id) GROUP BY s.run_id""")
