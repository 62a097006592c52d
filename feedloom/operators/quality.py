"""Counts, degradation reasons and the verdict of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions import payload
from feedloom.operators.sequence import base_status
from feedloom.sources.lake import MARKERS

NOT_READY = "streams_not_ready"


def degraded_reason(component: Column, event_type: Column, severity: Column, epoch: Column,
                    details_json: Column) -> Column:
    """Reason by which a control row degrades its run, or null."""
    base = base_status(F.get_json_object(details_json, "$.sequence_status"))
    bad_step = event_type.isin("sequence_gap", "sequence_regression")
    return (
        F.when((event_type == "socket_open") & (epoch > 1)
               & component.isin("data", "tbt"), F.concat(component, F.lit("_reconnected")))
        .when((event_type == "socket_close") & (severity == "WARNING"),
              F.concat(component, F.lit("_socket_closed")))
        .when(event_type == "socket_error", F.concat(component, F.lit("_socket_error")))
        .when(event_type == "server_error", F.concat(component, F.lit("_server_error")))
        .when(event_type == "disconnect_detected",
              F.concat(component, F.lit("_connection_interrupted")))
        .when(event_type.isin("feed_stale", "feed_stale_retry", "feed_stale_detected"),
              F.concat(component, F.lit("_feed_stale")))
        .when(bad_step, F.concat(F.lit("tbt_"), event_type))
        .when((event_type == "sequence_after_reconnect") & base.isin("gap", "regression"),
              F.concat(F.lit("tbt_sequence_"), base))
    )


def fatal_reason(component: Column, event_type: Column, severity: Column,
                 details_json: Column) -> Column:
    """Reason by which a control row fails its run, or null."""
    # The error message arrives as text inside the details; it is fatal only if it is an object
    # in which the server says so. The parse sits in a branch of its own: as part of a condition
    # it would be computed for every row.
    said = payload.fields(F.get_json_object(details_json, "$.payload"))
    rejected = (event_type == "socket_error") & (component == "data")
    ends = F.concat(component, F.lit("_"), event_type)
    return (
        F.when(rejected, F.when(payload.is_server_error(said), F.lit("data_server_error")))
        .when(event_type == "server_error", F.concat(component, F.lit("_server_error")))
        .when(event_type.isin("feed_stale", "feed_stale_retry_failure", "connect_timeout"), ends)
        .when(event_type.rlike("^(data|tbt)_(disconnect_timeout|reconnect_exhausted)$"),
              event_type)
        .when(event_type.isin("stream_readiness_timeout", "first_event_timeout"), event_type)
        .when(event_type.rlike("^(data|tbt)_callback_failure$"), event_type)
        .when((event_type == "socket_shutdown") & (severity == "ERROR"),
              F.lit("socket_shutdown_failure"))
    )


def with_effects(control: DataFrame) -> DataFrame:
    """Add ``degraded_reason`` and ``fatal_reason`` to control rows."""
    component, event_type, severity, epoch, details = (
        F.col(name)
        for name in ("component", "event_type", "severity", "connection_epoch", "details_json")
    )
    return control.withColumns(
        {
            "degraded_reason": degraded_reason(component, event_type, severity, epoch, details),
            "fatal_reason": fatal_reason(component, event_type, severity, details),
        }
    )


def reason_counts(effects: DataFrame) -> DataFrame:
    """Control rows reduced to one row per run, component and pair of reasons.

    Reasons come from a fixed vocabulary, so this is small; its aggregates are numbers, so it is
    hashed and mostly done before the shuffle. Verdicts and reason lists start from it.
    """
    return effects.groupBy("run_id", "component", "degraded_reason", "fatal_reason").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("event_id").alias("first_event_id"),
        F.max("connection_epoch").alias("last_epoch"),
        F.count_if(F.col("event_type") == "streams_ready").alias("ready"),
    )


def run_summary(effects: DataFrame, *, require_ready: bool = True) -> DataFrame:
    """Verdict, reasons and epochs per run.

    Any fatal reason fails a run, any other reason degrades it. The first fatal reason by
    ``event_id`` is the stop reason. A run without ``streams_ready`` (and without a fatal
    reason) fails as not ready.
    """
    fatal = F.col("fatal_reason")
    first_fatal = F.min(F.when(fatal.isNotNull(), F.struct("first_event_id", fatal)))

    def epoch(component: str) -> Column:
        return F.max(F.when(F.col("component") == component, F.col("last_epoch")))

    totals = reason_counts(effects).groupBy("run_id").agg(
        first_fatal["fatal_reason"].alias("_fatal"),
        # At most the vocabulary of reasons.
        F.array_sort(F.collect_set("degraded_reason")).alias("degraded_reasons"),
        F.sum("ready").alias("_ready"),
        epoch("data").alias("epoch_data"),
        epoch("tbt").alias("epoch_tbt"),
    )
    stop = F.col("_fatal")
    if require_ready:
        stop = F.coalesce(stop, F.when(F.col("_ready") == 0, F.lit(NOT_READY)))
    status = (
        F.when(F.col("stop_reason").isNotNull(), "failed")
        .when(F.size("degraded_reasons") > 0, "degraded")
        .otherwise("complete")
    )
    return (
        totals.withColumn("stop_reason", stop)
        .withColumn("status", status)
        .withColumn("marker", marker(F.col("status")))
        .drop("_fatal", "_ready")
    )


def degraded_reasons(effects: DataFrame) -> DataFrame:
    """Distinct reasons per degraded run, sorted."""
    summary = run_summary(effects).select("run_id", "degraded_reasons")
    return summary.where(F.size("degraded_reasons") > 0)


def run_status(effects: DataFrame, *, require_ready: bool = True) -> DataFrame:
    """Status, completion marker and stop reason per run."""
    return run_summary(effects, require_ready=require_ready).select(
        "run_id", "status", "marker", "stop_reason"
    )


def marker(status: Column) -> Column:
    chosen = F.lit(None).cast("string")
    for name, file_name in MARKERS:
        chosen = F.when(status == name, F.lit(file_name)).otherwise(chosen)
    return chosen


def received_counts(events: DataFrame) -> DataFrame:
    """Rows received per run and stream."""
    return events.groupBy("run_id", "source").agg(F.count(F.lit(1)).alias("received"))


def coverage(events: DataFrame) -> DataFrame:
    """Symbols seen per run and component, with first sight and latest epoch.

    One row per symbol instead of one array per run, so no group is ever collected.
    """
    return events.groupBy("run_id", "component", F.upper("symbol").alias("symbol_upper")).agg(
        F.min("event_id").alias("first_event_id"),
        F.max("connection_epoch").alias("last_epoch"),
        F.count(F.lit(1)).alias("rows"),
    )
