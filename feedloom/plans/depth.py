"""Queries over the depth feed: books, sequence diagnostics, reconnects, replay analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import coerce, payload
from feedloom.operators import normalize, numbering, replay, route, sequence
from feedloom.plans import feeds
from feedloom.plans.feeds import (
    BOOKS_SQL, CONFIGURED_SQL, CONTROL_SQL, DEPTH_SQL, QUOTES_SQL, TICKS_SQL, books, control_core,
    depth_core, quote_messages, table, ticks, with_sql,
)
from feedloom.session import shared_dir
from feedloom.sources import messages
from feedloom.streaming import depth as live_depth


def depth_length_check(spark, sf):
    """Books of both feeds that have them: which rows are kept, which quarantined."""
    kept, refused = normalize.split_books(_stored_books(spark, sf))
    return kept.select("event_id", F.lit("kept").alias("verdict")).unionByName(
        refused.select("event_id", F.lit("quarantined").alias("verdict"))
    )


def depth_coerce(spark, sf):
    """Vectors as book sides: text levels, every negative one blanked, back to numbers."""
    side = F.transform(
        "embedding", lambda x: F.when(x >= 0, x.cast("double").cast("string"))
    )
    levels = coerce.double_levels(side)
    return table(spark, sf, "embeddings").select(
        "vec_id", F.posexplode(levels).alias("place", "price")
    )


def normalize_depth(spark, sf):
    return _typed_books(spark, sf).select(
        "run_id", "event_id", "source", "symbol", "channel", "total_buy_qty", "total_sell_qty",
        F.element_at("bid_prices", 1).alias("bid_1"),
        F.element_at("bid_prices", 50).alias("bid_50"),
        F.element_at("ask_prices", 25).alias("ask_25"),
        F.element_at("ask_prices", 50).alias("ask_50"),
        F.element_at("bid_quantities", 50).alias("bid_qty_50"),
        F.element_at("ask_order_counts", 50).alias("ask_orders_50"),
        F.size("bid_prices").alias("levels"),
        "is_snapshot", "feed_time", "send_time",
        F.col("sequence_no").cast("bigint").alias("sequence_no"), "payload_semantics",
    )


def route_depth(spark, sf):
    rows = ticks(spark, sf).select("tick_id", feeds.spelled_symbol().alias("ticker"))
    return route.route_depth(rows, feeds.configured(spark, sf)).select(
        "tick_id", "ticker", "route", "connection_key"
    )


def _stored_books(spark, sf):
    """Depth messages at rest, as they arrive: built once, then read like any recording."""
    return _at_rest(spark, books(spark, sf))


def _at_rest(spark, rows):
    """Messages written once."""
    path = shared_dir(spark, "messages")
    live_depth.write_books(rows, path)
    return spark.read.schema(schemas.DEPTH_MESSAGES).parquet(path)


def _typed_books(spark, sf):
    kept, _ = normalize.split_books(_stored_books(spark, sf))
    return normalize.normalize_depth(kept)


def best_level(spark, sf):
    return replay.with_best_levels(_typed_books(spark, sf)).select(
        "event_id", "symbol", "best_bid", "best_bid_qty", "best_ask", "best_ask_qty",
        F.col("sequence_no").cast("bigint").alias("sequence_no"),
    )


def depth_levels(spark, sf):
    """Book quantities by level over all events."""
    levels = replay.book_levels(_typed_books(spark, sf), ["run_id", "event_id"])
    return levels.groupBy("run_id", "level").agg(
        F.count(F.lit(1)).alias("books"),
        F.sum("bid_quantity").alias("bid_quantity"),
        F.sum("ask_quantity").alias("ask_quantity"),
        F.max("bid_price").alias("highest_bid"),
        F.min("ask_price").alias("lowest_ask"),
    )


def _shown(rows, *names):
    decimals = {"sequence_no", "previous_sequence_no"}
    return rows.select(
        *[F.col(n).cast("bigint").alias(n) if n in decimals else F.col(n) for n in names]
    )


def _diagnosed(spark, sf):
    return sequence.diagnose(depth_core(spark, sf))


def prev_sequence(spark, sf):
    return _shown(_diagnosed(spark, sf), "event_id", "symbol", "sequence_no",
                  "previous_sequence_no")


def sequence_diagnostics(spark, sf):
    return _shown(
        _diagnosed(spark, sf), "run_id", "event_id", "symbol", "connection_epoch", "sequence_no",
        "previous_sequence_no", "sequence_delta", "sequence_status", "is_first_after_reconnect",
    )


def first_after_reconnect(spark, sf):
    rows = _diagnosed(spark, sf).where(F.col("is_first_after_reconnect"))
    return rows.select("run_id", "event_id", "symbol", "connection_key", "connection_epoch")


def sequence_events(spark, sf):
    rows = sequence.sequence_events(_diagnosed(spark, sf))
    said = F.from_json("details_json", "sequence_delta long, sequence_status string")
    return rows.select(
        "run_id", "event_id", "symbol", "event_type", "severity", "degraded_reason",
        said["sequence_delta"].alias("sequence_delta"),
        said["sequence_status"].alias("said_status"),
    )


def record_depth(spark, sf):
    """Depth messages through the live query, which is started again for each third of them.

    Diagnosed rows, refused books and control rows as the lake then holds them. Thirds are cut by
    id, so a symbol's state is carried from one start to the next.
    """
    landing, root, progress = (shared_dir(spark, n) for n in ("landing", "lake", "progress"))
    epochs = depth_core(spark, sf).select("event_id", "connection_epoch")
    rows = _at_rest(
        spark, books(spark, sf, epochs=epochs).select(*schemas.DEPTH_MESSAGES.fieldNames())
    )
    first, last = rows.agg(F.min("event_id"), F.max("event_id")).first()
    first, last = first or 0, last or 0  # An empty table has no ids.
    third = F.floor((F.col("event_id") - first) * 3 / (last - first + 1))
    for part in range(3):
        rows.where(third == part).write.mode("append").json(landing, compression="gzip")
        live_depth.record_depth(
            messages.depth_messages(spark, landing), feeds.configured(spark, sf), root, progress,
            flush_seconds=None,
        ).awaitTermination()
    stored, control, refused = (
        live_depth.read_recorded(spark, root, stream) for stream in live_depth.TARGETS
    )
    decimals = ("previous_sequence_no", "sequence_no")
    return (
        stored.select("run_id", "event_id", F.lit("depth").alias("place"), "symbol",
                      *(F.col(c).cast("bigint").alias(c) for c in decimals), "sequence_delta",
                      F.col("sequence_status").alias("said"))
        .unionByName(control.select("run_id", "event_id", F.lit("control").alias("place"), "symbol",
                                    F.col("event_type").alias("said")), allowMissingColumns=True)
        .unionByName(refused.select("run_id", "event_id", F.lit("refused").alias("place"),
                                    F.col("ticker").alias("symbol")), allowMissingColumns=True)
    )


def lossy_symbols(spark, sf):
    """Which symbols lost data: rows per run, symbol and sequence status."""
    return _diagnosed(spark, sf).groupBy("run_id", "symbol", "sequence_status").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col("sequence_delta") > 1, F.col("sequence_delta") - 1)).alias("missed"),
    )


def connection_epochs(spark, sf):
    return sequence.with_epochs(control_core(spark, sf)).select(
        "run_id", "event_id", "connection_key", "event_type", "epoch"
    )


def _trades(spark, sf):
    """Narrow quote rows: only the fields the analysis needs are taken from the payload."""
    named = quote_messages(spark, sf, known_symbol=True).where(F.col("symbol").isNotNull())
    parsed = named.withColumn("_m", payload.fields(F.col("payload")))
    wanted = normalize.quote_fields(F.col("_m"))
    return parsed.select(
        "run_id", "event_id", "received_at_unix_ns", "symbol",
        *[wanted[n].alias(n) for n in ("ltp", "last_traded_qty", "volume_traded_today")],
    )


def footprint(spark, sf):
    rows = replay.footprint(_trades(spark, sf))
    return rows.select(
        "run_id", "event_id", "symbol", "last_traded_qty", "volume_traded_today",
        "previous_volume", "volume_delta", "attributed_volume", "unknown_volume",
    )


def asof_depth(spark, sf):
    quotes = _trades(spark, sf).select("run_id", "event_id", "symbol", "ltp")
    message = F.col("message")
    # Books of the wrong length are refused; of the others only the best level is coerced.
    whole, _ = normalize.split_books(_stored_books(spark, sf))
    best = whole.select(
        "run_id", "event_id", F.col("ticker").alias("symbol"),
        *[
            cast(F.slice(message[name], 1, 1)).alias(stored)
            for name, stored, cast in (
                ("bidprice", "bid_prices", coerce.double_levels),
                ("askprice", "ask_prices", coerce.double_levels),
                ("bidqty", "bid_quantities", coerce.long_levels),
                ("askqty", "ask_quantities", coerce.long_levels),
            )
        ],
    )
    return replay.asof_depth(quotes, best)


def _interleaved(spark, sf):
    quotes = quote_messages(spark, sf).select(
        "run_id", "event_id", F.lit("symbol_update").alias("source"), "received_at_unix_ns"
    )
    depth = depth_core(spark, sf).select(
        "run_id", "event_id", F.lit("tbt_depth").alias("source"), "received_at_unix_ns", "symbol",
        F.col("sequence_no").cast("bigint").alias("sequence_no"),
    )
    control = control_core(spark, sf).select(
        "run_id", "event_id", F.lit("control").alias("source"), "received_at_unix_ns",
        "event_type",
    )
    return replay.interleave(quotes, depth, control)


def replay_order(spark, sf):
    rows = quote_messages(spark, sf).select("run_id", "event_id", "received_at_unix_ns")
    return replay.in_receive_order(rows)


def replay_interleave(spark, sf):
    return replay.in_receive_order(
        _interleaved(spark, sf), feeds.run_spans(spark, sf).select("run_id", "started_at_unix_ns")
    )


def assign_event_id(spark, sf):
    """New contiguous ids over all three streams by receipt time, source and old id."""
    rows = _interleaved(spark, sf).select(
        "received_at_unix_ns", "source", F.col("event_id").alias("old_id")
    )
    return numbering.assign_ids(rows, ["received_at_unix_ns", "source", "old_id"])


DEPTH_VIEW = with_sql(TICKS_SQL, DEPTH_SQL)


def diagnosed_sql(rows: str) -> str:
    """The sequence diagnostics of the rows of a common table expression, as more of them."""
    return f"""previous AS (
  SELECT *, last_value(sequence_no IGNORE NULLS) OVER (PARTITION BY run_id, symbol ORDER BY event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_sequence_no,
    row_number() OVER (PARTITION BY run_id, connection_key, connection_epoch, symbol
      ORDER BY event_id) AS nth
  FROM {rows}),
flagged AS (
  SELECT *, connection_epoch > 1 AND nth = 1 AND previous_sequence_no IS NOT NULL
      AS is_first_after_reconnect, sequence_no - previous_sequence_no AS sequence_delta
  FROM previous),
diagnosed AS (
  SELECT *, CASE WHEN sequence_delta IS NULL THEN 'first' ELSE
      CASE WHEN is_first_after_reconnect THEN 'first_after_reconnect_' ELSE '' END || base END
      AS sequence_status,
    CASE WHEN sequence_delta IS NULL THEN 'first' ELSE base END AS base_status
  FROM (SELECT *, CASE WHEN sequence_delta = 1 THEN 'ok' WHEN sequence_delta = 0 THEN 'duplicate'
      WHEN sequence_delta > 1 THEN 'gap' WHEN is_snapshot THEN 'reset' ELSE 'regression' END AS base
    FROM flagged))"""


DIAGNOSED_SQL = f"{DEPTH_SQL},\n{diagnosed_sql('depth')}"
DIAGNOSED_VIEW = with_sql(TICKS_SQL, DIAGNOSED_SQL)
RECORDED_VIEW = with_sql(
    TICKS_SQL, CONFIGURED_SQL, DEPTH_SQL, BOOKS_SQL,
    """arrived AS (
  SELECT d.*, b.full_book, c.symbol_upper IS NOT NULL AS expected
  FROM depth d JOIN books b USING (event_id) LEFT JOIN configured c ON upper(d.symbol) = c.symbol_upper)""",
    "recorded AS (SELECT * FROM arrived WHERE expected AND full_book)",
    diagnosed_sql("recorded"),
)
STATUS_SQL = DIAGNOSED_VIEW + """
SELECT run_id, event_id, symbol, connection_epoch, sequence_no, previous_sequence_no, sequence_delta,
       sequence_status, is_first_after_reconnect FROM diagnosed"""
BOOKS_VIEW = with_sql(TICKS_SQL, BOOKS_SQL)

QUERIES = {
    "depth_length_check": (depth_length_check, BOOKS_VIEW + """
SELECT event_id, CASE WHEN full_book THEN 'kept' ELSE 'quarantined' END AS verdict FROM books"""),
    "depth_coerce": (depth_coerce, """
SELECT vec_id, place - 1 AS place, CASE WHEN x >= 0 THEN x::DOUBLE ELSE 0.0 END AS price
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS place
      FROM embeddings)"""),
    "normalize_depth": (normalize_depth, BOOKS_VIEW + f"""
SELECT run_id, event_id, 'tbt_depth' AS source, symbol, '1' AS channel, k AS total_buy_qty,
       k AS total_sell_qty, cents::DOUBLE AS bid_1,
       CASE WHEN kind = 'purchase' THEN 0.0 ELSE (cents + 245)::DOUBLE END AS bid_50,
       (cents + 220)::DOUBLE AS ask_25,
       CASE WHEN kind = 'purchase' THEN 0.0 ELSE (cents + 345)::DOUBLE END AS ask_50,
       k + 50 AS bid_qty_50, 4 AS ask_orders_50, 50 AS levels, kind = 'signup' AS is_snapshot,
       100 AS feed_time, 100 AS send_time, sequence_no,
       'sdk_reconstructed_state' AS payload_semantics FROM books WHERE full_book"""),
    "route_depth": (route_depth, with_sql(TICKS_SQL, CONFIGURED_SQL) + f"""
SELECT t.tick_id, t.ticker, c.connection_key,
       CASE WHEN c.connection_key IS NULL THEN 'unexpected_symbol' ELSE 'data' END AS route
FROM (SELECT tick_id, {feeds.SYMBOL_SQL} AS ticker FROM ticks) t
LEFT JOIN configured c ON upper(t.ticker) = c.symbol_upper"""),
    "best_level": (best_level, BOOKS_VIEW + f"""
SELECT event_id, symbol, cents::DOUBLE AS best_bid, k + 1 AS best_bid_qty,
       (cents + 100)::DOUBLE AS best_ask, k + 2 AS best_ask_qty, sequence_no
FROM books WHERE full_book"""),
    "depth_levels": (depth_levels, BOOKS_VIEW + f"""
SELECT run_id, i + 1 AS level, count(*) AS books, sum(k + i + 1)::BIGINT AS bid_quantity,
       sum(k + i + 2)::BIGINT AS ask_quantity,
       max(CASE WHEN kind = 'purchase' AND i = 49 THEN 0.0 ELSE (cents + 5 * i)::DOUBLE END) AS highest_bid,
       min(CASE WHEN kind = 'purchase' AND i = 49 THEN 0.0 ELSE (cents + 100 + 5 * i)::DOUBLE END)
         AS lowest_ask
FROM books, (SELECT unnest(range(50)) AS i) WHERE full_book GROUP BY run_id, i"""),
    "prev_sequence": (prev_sequence, DIAGNOSED_VIEW + """
SELECT event_id, symbol, sequence_no, previous_sequence_no FROM diagnosed"""),
    "sequence_diagnostics": (sequence_diagnostics, STATUS_SQL),
    "first_after_reconnect": (first_after_reconnect, DIAGNOSED_VIEW + """
SELECT run_id, event_id, symbol, connection_key, connection_epoch FROM diagnosed
WHERE is_first_after_reconnect"""),
    "sequence_events": (sequence_events, DIAGNOSED_VIEW + """
SELECT run_id, event_id, symbol,
       CASE WHEN is_first_after_reconnect THEN 'sequence_after_reconnect'
         ELSE 'sequence_' || base_status END AS event_type,
       CASE WHEN base_status = 'reset' AND NOT is_first_after_reconnect THEN 'INFO'
         ELSE 'WARNING' END AS severity,
       CASE WHEN base_status IN ('gap', 'regression') THEN 'tbt_sequence_' || base_status END
         AS degraded_reason, sequence_delta,
       CASE WHEN is_first_after_reconnect THEN sequence_status END AS said_status
FROM diagnosed
WHERE is_first_after_reconnect OR base_status IN ('gap', 'duplicate', 'regression', 'reset')"""),
    "record_depth": (record_depth, RECORDED_VIEW + """
SELECT run_id, event_id, 'depth' AS place, symbol, previous_sequence_no, sequence_no, sequence_delta,
       sequence_status AS said FROM diagnosed
UNION ALL SELECT run_id, event_id, 'refused', symbol, NULL, NULL, NULL, NULL FROM arrived
WHERE expected AND NOT full_book
UNION ALL SELECT run_id, event_id, 'control', symbol, NULL, NULL, NULL,
       CASE WHEN NOT expected THEN 'unexpected_symbol' ELSE 'tbt_callback_failure' END FROM arrived
WHERE NOT (expected AND full_book)
UNION ALL SELECT run_id, event_id, 'control', symbol, NULL, NULL, NULL,
       CASE WHEN is_first_after_reconnect THEN 'sequence_after_reconnect'
         ELSE 'sequence_' || base_status END FROM diagnosed
WHERE is_first_after_reconnect OR base_status IN ('gap', 'duplicate', 'regression', 'reset')"""),
    "lossy_symbols": (lossy_symbols, DIAGNOSED_VIEW + """
SELECT run_id, symbol, sequence_status, count(*) AS rows,
       sum(sequence_delta - 1) FILTER (WHERE sequence_delta > 1)::BIGINT AS missed
FROM diagnosed GROUP BY ALL"""),
    "connection_epochs": (connection_epochs, with_sql(TICKS_SQL, CONTROL_SQL) + """
SELECT run_id, event_id, connection_key, event_type,
       count(*) FILTER (WHERE event_type = 'socket_open') OVER (
         PARTITION BY run_id, connection_key ORDER BY event_id
         ROWS UNBOUNDED PRECEDING) AS epoch FROM control"""),
    "footprint": (footprint, with_sql(TICKS_SQL, QUOTES_SQL) + """
, grown AS (
  SELECT *, last_value(volume_traded_today IGNORE NULLS) OVER (PARTITION BY run_id, symbol
      ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_volume
  FROM quotes WHERE symbol IS NOT NULL),
delta AS (SELECT *, CASE WHEN volume_traded_today - previous_volume IS NOT NULL
    THEN greatest(volume_traded_today - previous_volume, 0) END AS volume_delta FROM grown),
shared AS (SELECT *, CASE WHEN volume_delta IS NOT NULL
    THEN least(greatest(coalesce(last_traded_qty, 0), 0), volume_delta) END AS attributed_volume
  FROM delta)
SELECT run_id, event_id, symbol, last_traded_qty, volume_traded_today, previous_volume, volume_delta,
       attributed_volume, volume_delta - attributed_volume AS unknown_volume FROM shared"""),
    "asof_depth": (asof_depth, with_sql(TICKS_SQL, QUOTES_SQL, BOOKS_SQL) + f"""
, both_feeds AS (
  SELECT run_id, event_id, upper(symbol) AS folded, symbol, ltp, NULL AS depth_event_id,
         NULL AS cents, NULL AS k FROM quotes WHERE symbol IS NOT NULL
  UNION ALL
  SELECT run_id, event_id, upper(symbol), NULL, NULL, event_id, cents, k FROM books WHERE full_book),
filled AS (
  SELECT *, last_value(depth_event_id IGNORE NULLS) OVER before AS latest_id,
         last_value(cents IGNORE NULLS) OVER before AS latest_cents,
         last_value(k IGNORE NULLS) OVER before AS latest_k
  FROM both_feeds WINDOW before AS (PARTITION BY run_id, folded ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT run_id, event_id, symbol, ltp, latest_id AS depth_event_id,
       latest_cents::DOUBLE AS best_bid, latest_k + 1 AS best_bid_qty,
       (latest_cents + 100)::DOUBLE AS best_ask, latest_k + 2 AS best_ask_qty
FROM filled WHERE depth_event_id IS NULL"""),
    "replay_order": (replay_order, with_sql(TICKS_SQL, QUOTES_SQL) + """
SELECT run_id, event_id, received_at_unix_ns FROM quotes ORDER BY event_id"""),
    "replay_interleave": (replay_interleave, with_sql(TICKS_SQL, QUOTES_SQL, DEPTH_SQL, CONTROL_SQL)
     + """
SELECT run_id, event_id, 'symbol_update' AS source, received_at_unix_ns, NULL AS symbol,
       NULL AS sequence_no, NULL AS event_type FROM quotes
UNION ALL SELECT run_id, event_id, 'tbt_depth', received_at_unix_ns, symbol, sequence_no, NULL FROM depth
UNION ALL SELECT run_id, event_id, 'control', received_at_unix_ns, NULL, NULL, event_type FROM control"""),
    "assign_event_id": (assign_event_id, with_sql(TICKS_SQL, QUOTES_SQL, DEPTH_SQL, CONTROL_SQL) + """
SELECT *, row_number() OVER (ORDER BY received_at_unix_ns, source, old_id) AS event_id
FROM (SELECT received_at_unix_ns, 'symbol_update' AS source, event_id AS old_id FROM quotes
      UNION ALL SELECT received_at_unix_ns, 'tbt_depth', event_id FROM depth
      UNION ALL SELECT received_at_unix_ns, 'control', event_id FROM control)"""),
}
