"""From message streams to the recorded streams of the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom import schemas
from feedloom.operators import normalize, route
from feedloom.sources import messages
from feedloom.streaming.sinks import append_stream


def quote_rows(arrived: DataFrame, configured: DataFrame) -> DataFrame:
    """Rows of the quote stream out of quote messages of configured symbols."""
    routed = route.route_quotes(arrived, configured).where(F.col("route") == route.DATA)
    return normalize.normalize_quotes(routed.drop("symbol", "connection_key", "route"))


def quote_control(
    arrived: DataFrame, configured: DataFrame, secrets: tuple[str, ...] = ()
) -> DataFrame:
    """Control rows for the quote messages that are not data."""
    routed = route.route_quotes(arrived, configured).where(F.col("route") != route.DATA)
    detailed = route.route_details(routed)
    return normalize.control_events(
        detailed.withColumnsRenamed(
            {"symbol": "_symbol", "message": "_message", "details_json": "_details"}
        ),
        component=F.lit("data"),
        event_type=F.col("route"),
        severity=route.severity(F.col("route")),
        message=F.col("_message"),
        details=F.col("_details"),
        symbol=F.col("_symbol"),
        secrets=secrets,
    )


def lifecycle_control(arrived: DataFrame, secrets: tuple[str, ...] = ()) -> DataFrame:
    """Control rows for lifecycle messages; the payload becomes message and details."""
    text = F.coalesce("payload", F.lit(""))
    return normalize.control_events(
        arrived.withColumnRenamed("component", "_component"),
        component=F.col("_component"),
        event_type=messages.lifecycle_event(F.col("kind"), 1),
        severity=messages.lifecycle_event(F.col("kind"), 2),
        message=F.when(F.col("kind") != "open", text),
        details=F.to_json(F.struct(text.alias("payload"))),
        secrets=secrets,
    )


def record_quotes(
    arrived: DataFrame,
    configured: DataFrame,
    root: str,
    checkpoint: str,
    *,
    secrets: tuple[str, ...] = (),
    lifecycle: DataFrame | None = None,
    flush_seconds: int | None = 60,
) -> list[StreamingQuery]:
    """Start recording quote messages: one query per target stream, each exactly-once.

    ``lifecycle`` messages of the same run go to the control stream too, in the same query.
    """
    control = quote_control(arrived, configured, secrets)
    if lifecycle is not None:
        control = control.unionByName(lifecycle_control(lifecycle, secrets))
    return [
        append_stream(
            quote_rows(arrived, configured), root, schemas.SYMBOL_UPDATE, checkpoint,
            flush_seconds=flush_seconds,
        ),
        append_stream(
            control, root, schemas.CONTROL,
            f"{checkpoint}/quotes", flush_seconds=flush_seconds,
        ),
    ]
