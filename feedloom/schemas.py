"""Fixed, versioned schemas of the three recorded streams and of the run metadata.

Unsigned 64-bit sequence numbers are ``decimal(20,0)``: that is how Spark reads the Parquet
type, and it is exact up to 2**64 - 1.
"""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = 1
BOOK_LEVELS = 50
SEQUENCE_TYPE = T.DecimalType(20, 0)

# Stream names and the directory each stream is stored in.
SYMBOL_UPDATE = "symbol_update"
TBT_DEPTH = "tbt_depth"
CONTROL = "control"
ENGINE_VERSION = "0.3"
# What the depth query writes beside its rows: its own control rows, and the books it refused.
DEPTH_CONTROL = "depth_control"
REFUSED_DEPTH = "refused_depth"
# Control rows that live health writes: of symbols, and of connections.
HEALTH_CONTROL = "health_control"
OUTAGE_CONTROL = "outage_control"
CONTROL_STREAMS = (CONTROL, DEPTH_CONTROL, HEALTH_CONTROL, OUTAGE_CONTROL)
STREAM_DIRECTORIES = {
    "control": "control",
    "symbol_update": "symbolupdate",
    "tbt_depth": "tbtdepth",
    "depth_control": "controldepth",
    "refused_depth": "refuseddepth",
    "health_control": "controlhealth",
    "outage_control": "controloutage",
}


def _required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, False)


def _optional(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind, True) for name in names.split()]


COMMON = T.StructType(
    [
        _required("schema_version", T.ShortType()),
        _required("run_id", T.StringType()),
        _required("event_id", T.LongType()),
        _required("source", T.StringType()),
        _required("connection_id", T.StringType()),
        _required("connection_epoch", T.IntegerType()),
        *_optional("symbol channel", T.StringType()),
        _required("received_at_unix_ns", T.LongType()),
        _required("received_at_monotonic_ns", T.LongType()),
        _required("received_at_utc", T.TimestampType()),
        _required("received_at_local", T.StringType()),
        _required("trading_date", T.StringType()),
        _required("receipt_hour", T.StringType()),
    ]
)

QUOTES = T.StructType(
    COMMON.fields
    + _optional("update_type", T.StringType())
    + _optional("ltp", T.DoubleType())
    + _optional(
        "last_traded_qty last_traded_time exchange_feed_time volume_traded_today", T.LongType()
    )
    + _optional("bid_price ask_price", T.DoubleType())
    + _optional("bid_size ask_size total_buy_qty total_sell_qty", T.LongType())
    + _optional("average_trade_price", T.DoubleType())
    + _optional("open_interest", T.LongType())
    + _optional(
        "open_price high_price low_price previous_close_price year_high year_low "
        "lower_circuit upper_circuit change change_percent",
        T.DoubleType(),
    )
    + [
        T.StructField("present_fields", T.ArrayType(T.StringType()), True),
        _required("sanitized_fields", T.ArrayType(T.StringType())),
        _required("raw_json", T.StringType()),
    ]
)

DEPTH = T.StructType(
    COMMON.fields
    + _optional("total_buy_qty total_sell_qty", T.LongType())
    + [
        _required("bid_prices", T.ArrayType(T.DoubleType())),
        _required("ask_prices", T.ArrayType(T.DoubleType())),
        _required("bid_quantities", T.ArrayType(T.LongType())),
        _required("ask_quantities", T.ArrayType(T.LongType())),
        _required("bid_order_counts", T.ArrayType(T.LongType())),
        _required("ask_order_counts", T.ArrayType(T.LongType())),
        _required("is_snapshot", T.BooleanType()),
    ]
    + _optional("feed_time send_time", T.LongType())
    + _optional("sequence_no previous_sequence_no", SEQUENCE_TYPE)
    + _optional("sequence_delta", T.LongType())
    + [
        _required("sequence_status", T.StringType()),
        _required("is_first_after_reconnect", T.BooleanType()),
        _required("payload_semantics", T.StringType()),
    ]
    + _optional("raw_json", T.StringType())
)

CONTROL_EVENTS = T.StructType(
    COMMON.fields
    + [
        _required("component", T.StringType()),
        _required("event_type", T.StringType()),
        _required("severity", T.StringType()),
        T.StructField("message", T.StringType(), True),
        _required("details_json", T.StringType()),
    ]
)

STREAMS = {SYMBOL_UPDATE: QUOTES, TBT_DEPTH: DEPTH, CONTROL: CONTROL_EVENTS}

# What a message carries on arrival: who received it, when, in which order, and the payload text.
ARRIVAL = T.StructType(
    [
        _required("run_id", T.StringType()),
        _required("event_id", T.LongType()),
        _required("connection_id", T.StringType()),
        _required("connection_epoch", T.IntegerType()),
        _required("received_at_unix_ns", T.LongType()),
        _required("received_at_monotonic_ns", T.LongType()),
    ]
)
QUOTE_MESSAGES = T.StructType(ARRIVAL.fields + _optional("payload", T.StringType()))

# Array elements stay text so that a malformed element can be coerced instead of losing the row.
_LEVELS = T.ArrayType(T.StringType())
BOOK_MESSAGE = T.StructType(
    _optional("tbq tsq", T.StringType())
    + _optional("bidprice askprice bidqty askqty bidordn askordn", _LEVELS)
    + _optional("snapshot timestamp sendtime seqNo", T.StringType())
)
DEPTH_MESSAGES = T.StructType(
    ARRIVAL.fields
    + _optional("ticker channel", T.StringType())
    + [T.StructField("message", BOOK_MESSAGE, True)]
)
STREAMS |= {DEPTH_CONTROL: CONTROL_EVENTS, REFUSED_DEPTH: DEPTH_MESSAGES}
STREAMS |= {HEALTH_CONTROL: CONTROL_EVENTS, OUTAGE_CONTROL: CONTROL_EVENTS}
# Depth rows as the live query stores them: one that came behind a later id of its symbol is late.
RECORDED_DEPTH = T.StructType(DEPTH.fields + [T.StructField("late", T.BooleanType(), True)])
LIFECYCLE_MESSAGES = T.StructType(
    ARRIVAL.fields + _optional("component kind payload", T.StringType())
)

PARTS = T.StructType(
    [
        _required("path", T.StringType()),
        _required("source", T.StringType()),
        _required("rows", T.LongType()),
        _required("min_event_id", T.LongType()),
        _required("max_event_id", T.LongType()),
        _required("min_received_at_unix_ns", T.LongType()),
        _required("max_received_at_unix_ns", T.LongType()),
        _required("bytes", T.LongType()),
        T.StructField("sha256", T.StringType(), True),
    ]
)

MANIFESTS = T.StructType(
    _optional("schema_version", T.LongType())
    + _optional("engine_version status", T.StringType())
    + _optional("clean_shutdown streams_ready", T.BooleanType())
    + [
        T.StructField("first_events_seen", T.MapType(T.StringType(), T.BooleanType())),
        T.StructField("symbols_seen", T.MapType(T.StringType(), T.LongType())),
        T.StructField("degraded_reasons", T.ArrayType(T.StringType())),
    ]
    + _optional("stop_reason run_id", T.StringType())
    + _optional("started_at_unix_ns ended_at_unix_ns", T.LongType())
    + [
        T.StructField("connection_epochs", T.MapType(T.StringType(), T.LongType())),
        T.StructField("configuration", T.MapType(T.StringType(), T.StringType())),
        T.StructField("received_events", T.MapType(T.StringType(), T.LongType())),
        T.StructField("rows_written", T.MapType(T.StringType(), T.LongType())),
        T.StructField("files_written", T.MapType(T.StringType(), T.LongType())),
    ]
    + _optional("fatal_error", T.StringType())
)

RECEIPTS = T.StructType(
    _optional(
        "trading_date upload_status sha256 source_fingerprint bucket_name endpoint_url "
        "object_key uri verified_at_utc",
        T.StringType(),
    )
    + _optional("size_bytes file_count", T.LongType())
)
