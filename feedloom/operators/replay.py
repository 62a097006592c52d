"""Replaying recorded streams in receive order, and analysis along that order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import sized_broadcast
from feedloom.operators.scan import CHUNK_ROWS, Running, running


def interleave(*streams: DataFrame) -> DataFrame:
    """All rows of all streams; columns a stream lacks are null. Nothing is deduplicated."""
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream, allowMissingColumns=True)
    return merged


def in_receive_order(events: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Order rows by ``event_id``, never by time; several runs follow each other by start.

    ``runs`` (``run_id, started_at_unix_ns``) orders runs; ids alone only order within a run.
    """
    if runs is None:
        return events.orderBy("event_id")
    started = runs.select("run_id", F.col("started_at_unix_ns").alias("_started"))
    return (
        events.join(sized_broadcast(started), "run_id", "left")
        .orderBy("_started", "run_id", "event_id")
        .drop("_started")
    )


def trusted(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of runs that ended complete or degraded."""
    good = runs.where(F.col("status").isin("complete", "degraded")).select("run_id")
    return events.join(sized_broadcast(good), "run_id", "left_semi")


def quarantined(events: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of failed runs and of runs without a completion marker."""
    good = runs.where(F.col("status").isin("complete", "degraded")).select("run_id")
    return events.join(sized_broadcast(good), "run_id", "left_anti")


def best_level(levels: Column) -> Column:
    """First level of a book side."""
    return F.try_element_at(levels, F.lit(1))


def with_best_levels(depth: DataFrame) -> DataFrame:
    return depth.withColumns(
        {
            "best_bid": best_level(F.col("bid_prices")),
            "best_bid_qty": best_level(F.col("bid_quantities")),
            "best_ask": best_level(F.col("ask_prices")),
            "best_ask_qty": best_level(F.col("ask_quantities")),
        }
    )


def book_levels(depth: DataFrame, keep: list[str]) -> DataFrame:
    """One row per event and book level (1 is the best), both sides next to each other."""
    zipped = F.arrays_zip(
        "bid_prices", "bid_quantities", "bid_order_counts",
        "ask_prices", "ask_quantities", "ask_order_counts",
    )
    return depth.select(*keep, F.posexplode(zipped).alias("_place", "_level")).select(
        *keep,
        (F.col("_place") + 1).alias("level"),
        F.col("_level.bid_prices").alias("bid_price"),
        F.col("_level.bid_quantities").alias("bid_quantity"),
        F.col("_level.bid_order_counts").alias("bid_orders"),
        F.col("_level.ask_prices").alias("ask_price"),
        F.col("_level.ask_quantities").alias("ask_quantity"),
        F.col("_level.ask_order_counts").alias("ask_orders"),
    )


def asof_depth(quotes: DataFrame, depth: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Quote rows with the latest best levels received before each, per run and symbol.

    Both streams are interleaved and scanned once; there is no join between them. Symbols are
    matched by fold, as membership is. Book arrays are reduced to the best level before the
    shuffle.
    """
    keys = ["run_id", "symbol_upper"]
    state = F.struct(
        F.col("event_id").alias("depth_event_id"),
        *[F.col(name) for name in ("best_bid", "best_bid_qty", "best_ask", "best_ask_qty")],
    )
    books = with_best_levels(depth).select(
        "run_id", F.upper("symbol").alias("symbol_upper"), "event_id", state.alias("_book")
    )
    trades = quotes.where(F.col("symbol").isNotNull()).withColumns(
        {"symbol_upper": F.upper("symbol"), "_quote": F.lit(True)}
    )
    merged = trades.unionByName(books, allowMissingColumns=True)
    filled = running(
        merged, keys, "event_id", {"_latest": Running(F.col("_book"))}, chunk_rows=chunk_rows
    )
    return filled.where(F.col("_quote")).select(*quotes.columns, "_latest.*")


def footprint(quotes: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Attribute cumulative-volume growth to the last trade; the rest stays unknown.

    At most ``min(last_traded_qty, positive growth)`` is attributed. Growth is measured from
    the last known volume of the symbol, and is null where there is none yet.
    """
    known = running(
        quotes,
        ("run_id", "symbol"),
        "event_id",
        {"previous_volume": Running(F.col("volume_traded_today"))},
        chunk_rows=chunk_rows,
    )
    growth = F.col("volume_traded_today") - F.col("previous_volume")
    positive = F.when(growth.isNotNull(), F.greatest(growth, F.lit(0).cast("bigint")))
    traded = F.greatest(F.coalesce("last_traded_qty", F.lit(0)), F.lit(0).cast("bigint"))
    attributed = F.when(
        F.col("volume_delta").isNotNull(), F.least(traded, F.col("volume_delta"))
    )
    return (
        known.withColumn("volume_delta", positive)
        .withColumn("attributed_volume", attributed)
        .withColumn("unknown_volume", F.col("volume_delta") - F.col("attributed_volume"))
    )
