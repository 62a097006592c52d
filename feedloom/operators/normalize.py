"""From raw messages to the typed rows of the three streams; all row-local."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import clock, coerce, payload
from feedloom.functions.redact import redact_details, redact_text

# Typed column, kind, and the vendor keys that may carry it (first present wins).
QUOTE_FIELDS = [
    ("ltp", "float", ("ltp", "last_price", "last_traded_price")),
    ("last_traded_qty", "int", ("last_traded_qty", "ltq", "last_quantity")),
    ("last_traded_time", "int", ("last_traded_time", "ltt", "exchange_time")),
    ("exchange_feed_time", "int", ("exch_feed_time", "exchange_feed_time")),
    ("volume_traded_today", "int", ("vol_traded_today", "vtt", "volume")),
    ("bid_price", "float", ("bid_price", "best_bid_price")),
    ("ask_price", "float", ("ask_price", "best_ask_price")),
    ("bid_size", "int", ("bid_size", "best_bid_size")),
    ("ask_size", "int", ("ask_size", "best_ask_size")),
    ("total_buy_qty", "int", ("tot_buy_qty", "total_buy_qty")),
    ("total_sell_qty", "int", ("tot_sell_qty", "total_sell_qty")),
    ("average_trade_price", "float", ("avg_trade_price", "atp")),
    ("open_interest", "int", ("OI", "oi", "open_interest")),
    ("open_price", "float", ("open_price",)),
    ("high_price", "float", ("high_price",)),
    ("low_price", "float", ("low_price",)),
    ("previous_close_price", "float", ("prev_close_price", "previous_close_price")),
    ("year_high", "float", ("Yhigh", "year_high")),
    ("year_low", "float", ("Ylow", "year_low")),
    ("lower_circuit", "float", ("lower_ckt", "lower_circuit")),
    ("upper_circuit", "float", ("upper_ckt", "upper_circuit")),
    ("change", "float", ("ch", "change")),
    ("change_percent", "float", ("chp", "change_percent")),
]

# Fixed value: the depth feed delivers rebuilt books, not raw packets.
PAYLOAD_SEMANTICS = "sdk_reconstructed_state"

# Book column of a depth message, the stored column it fills, and its kind.
BOOK_ARRAYS = [
    ("bidprice", "bid_prices", "float"),
    ("askprice", "ask_prices", "float"),
    ("bidqty", "bid_quantities", "int"),
    ("askqty", "ask_quantities", "int"),
    ("bidordn", "bid_order_counts", "int"),
    ("askordn", "ask_order_counts", "int"),
]


def with_envelope(
    rows: DataFrame,
    source: str,
    *,
    symbol: Column | None = None,
    channel: Column | None = None,
    zone: str = clock.MARKET_ZONE,
) -> DataFrame:
    """Complete the common columns of arrived rows; other columns are kept behind them."""
    none = F.lit(None).cast("string")
    utc = F.col("received_at_utc")
    common = {
        "schema_version": F.lit(schemas.SCHEMA_VERSION).cast("smallint"),
        "source": F.lit(source),
        "symbol": none if symbol is None else symbol,
        "channel": none if channel is None else channel,
        "received_at_local": clock.iso_local(utc, zone),
        "trading_date": clock.trading_date(utc, zone),
        "receipt_hour": clock.receipt_hour(utc, zone),
    }
    stamped = rows.withColumn(
        "received_at_utc", clock.utc_time(F.col("received_at_unix_ns"))
    ).withColumns(common)
    names = schemas.COMMON.fieldNames()
    return stamped.select(*names, *[c for c in stamped.columns if c not in names])


def quote_fields(message: Column) -> dict[str, Column]:
    """The typed columns of a quote message, before zero sanitising."""
    casts = {"float": coerce.lenient_double, "int": coerce.lenient_long}
    return {
        column: casts[kind](payload.first_present(message, *keys))
        for column, kind, keys in QUOTE_FIELDS
    }


def is_zero_pair(lower: Column, upper: Column) -> Column:
    """Both circuit limits are zero: the feed's filler, not limits."""
    return F.coalesce((lower == 0.0) & (upper == 0.0), F.lit(False))


def sanitized_names(zero_pair: Column) -> Column:
    """Names of the typed columns nulled by sanitising; empty, never null."""
    return F.when(zero_pair, F.array(F.lit("lower_circuit"), F.lit("upper_circuit"))).otherwise(
        F.array().cast("array<string>")
    )


def normalize_quotes(rows: DataFrame, zone: str = clock.MARKET_ZONE) -> DataFrame:
    """Quote messages (arrival columns and ``payload``) as rows of the quote stream."""
    parsed = rows.withColumn("_fields", payload.fields(F.col("payload")))
    message = F.col("_fields")
    typed = with_envelope(
        parsed, schemas.SYMBOL_UPDATE, symbol=F.when(message["symbol"] != "", message["symbol"]),
        zone=zone,
    ).withColumns(
        {
            **quote_fields(message),
            "update_type": payload.type_label(message),
            "present_fields": payload.present_names(message),
            "raw_json": payload.canonical_json(F.col("payload")),
        }
    )
    zero_pair = is_zero_pair(F.col("lower_circuit"), F.col("upper_circuit"))
    return (
        typed.withColumn("sanitized_fields", sanitized_names(zero_pair))
        .withColumns(
            {
                name: F.when(F.size("sanitized_fields") == 0, F.col(name))
                for name in ("lower_circuit", "upper_circuit")
            }
        )
        .select(*schemas.QUOTES.fieldNames())
    )


def has_full_book(message: Column) -> Column:
    """Every side of the book has exactly the fixed number of levels."""
    complete = F.lit(True)
    for name, _, _ in BOOK_ARRAYS:
        complete = complete & (coerce.level_count(message[name]) == schemas.BOOK_LEVELS)
    return complete


def is_full_book(message: Column) -> Column:
    """``has_full_book``, and false where the book is unknown."""
    return F.coalesce(has_full_book(message), F.lit(False))


def split_books(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with full books, and the quarantined rest (which fails the run, see ``quality``)."""
    full = is_full_book(F.col("message"))
    return rows.where(full), rows.where(~full)


def normalize_depth(
    rows: DataFrame,
    *,
    strict: bool = False,
    include_raw_json: bool = False,
    zone: str = clock.MARKET_ZONE,
) -> DataFrame:
    """Depth messages as typed rows, still without sequence diagnostics (see ``sequence``).

    ``strict`` raises on a book of the wrong length; otherwise call ``split_books`` first.
    """
    message = F.col("message")
    if strict:
        wrong = F.concat(F.lit("book of the wrong length in event "), F.col("event_id"))
        rows = rows.where(F.when(has_full_book(message), F.lit(True)).otherwise(
            F.raise_error(wrong).cast("boolean")))
    casts = {"float": coerce.double_levels, "int": coerce.long_levels}
    columns = {
        "total_buy_qty": coerce.lenient_long(message["tbq"]),
        "total_sell_qty": coerce.lenient_long(message["tsq"]),
        **{stored: casts[kind](message[name]) for name, stored, kind in BOOK_ARRAYS},
        "is_snapshot": coerce.truthy(message["snapshot"]),
        "feed_time": coerce.lenient_long(message["timestamp"]),
        "send_time": coerce.lenient_long(message["sendtime"]),
        "sequence_no": coerce.lenient_sequence(message["seqNo"]),
        "payload_semantics": F.lit(PAYLOAD_SEMANTICS),
    }
    typed = with_envelope(
        rows, schemas.TBT_DEPTH, symbol=F.col("ticker"), channel=F.col("channel"), zone=zone
    ).withColumns(columns)
    raw = F.lit(None).cast("string")
    if include_raw_json:
        raw = F.to_json(
            F.struct(
                F.col("ask_order_counts").alias("askordn"),
                F.col("ask_prices").alias("askprice"),
                F.col("ask_quantities").alias("askqty"),
                F.col("bid_order_counts").alias("bidordn"),
                F.col("bid_prices").alias("bidprice"),
                F.col("bid_quantities").alias("bidqty"),
                F.col("sequence_no").alias("seqNo"),
                F.col("send_time").alias("sendtime"),
                F.col("is_snapshot").alias("snapshot"),
                F.col("total_buy_qty").alias("tbq"),
                F.col("feed_time").alias("timestamp"),
                F.col("total_sell_qty").alias("tsq"),
            ),
            {"ignoreNullFields": "false"},
        )
    names = [
        *schemas.COMMON.fieldNames(), *columns,
    ]
    return typed.withColumn("raw_json", raw).select(*names, "raw_json")


def control_events(
    rows: DataFrame,
    *,
    component: Column,
    event_type: Column,
    severity: Column,
    message: Column,
    details: Column,
    symbol: Column | None = None,
    channel: Column | None = None,
    secrets: tuple[str, ...] = (),
    zone: str = clock.MARKET_ZONE,
) -> DataFrame:
    """Rows of the control stream; message and details (JSON text) are redacted here."""
    built = with_envelope(rows, schemas.CONTROL, symbol=symbol, channel=channel, zone=zone)
    return built.withColumns(
        {
            "component": component,
            "event_type": event_type,
            "severity": severity,
            "message": redact_text(message, secrets),
            "details_json": redact_details(details, secrets) if secrets else details,
        }
    ).select(*schemas.CONTROL_EVENTS.fieldNames())
