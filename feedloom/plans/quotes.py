"""Queries over the quote feed: coercion, normalisation, routing, envelope, redaction."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom.functions import clock, coerce, keys, payload, redact
from feedloom.operators import archive, normalize, route, universe
from feedloom.plans import feeds
from feedloom.plans.feeds import (
    BIG, CONFIGURED_SQL, QUOTES_SQL, TICKS_SQL, quote_messages, table, ticks, with_sql,
)

QUOTE_VIEW = with_sql(TICKS_SQL, QUOTES_SQL)


def _fields(spark, sf):
    """Quote messages with their payload parsed once."""
    return quote_messages(spark, sf).withColumn("_m", payload.fields(F.col("payload")))


def coerce_float(spark, sf):
    return _fields(spark, sf).select(
        "event_id",
        *[
            coerce.lenient_double(payload.first_present(F.col("_m"), *names)).alias(column)
            for column, kind, names in normalize.QUOTE_FIELDS
            if column in ("ltp", "lower_circuit", "upper_circuit") and kind == "float"
        ],
    )


def coerce_int(spark, sf):
    return _fields(spark, sf).select(
        "event_id",
        *[
            coerce.lenient_long(payload.first_present(F.col("_m"), *names)).alias(column)
            for column, kind, names in normalize.QUOTE_FIELDS
            if column in ("last_traded_qty", "volume_traded_today", "exchange_feed_time")
        ],
    )


def alias_first(spark, sf):
    message = F.col("_m")
    return _fields(spark, sf).select(
        "event_id",
        payload.first_present(message, "last_traded_qty", "ltq", "last_quantity").alias("qty_text"),
        payload.first_present(message, "OI", "oi", "open_interest").alias("interest_text"),
        F.when(payload.first_present(message, "ltp", "last_price") == "", "empty").alias("price_is"),
    )


def canonical_json(spark, sf):
    return quote_messages(spark, sf).select(
        "event_id", payload.canonical_json(F.col("payload")).alias("raw_json")
    )


def present_fields(spark, sf):
    return _fields(spark, sf).select(
        "event_id", F.array_join(payload.present_names(F.col("_m")), ",").alias("present_fields")
    )


def sanitize_zero_pair(spark, sf):
    return _normalized(spark, sf).select(
        "event_id", "lower_circuit", "upper_circuit",
        F.array_join("sanitized_fields", ",").alias("sanitized_fields"),
    )


def _normalized(spark, sf):
    return normalize.normalize_quotes(quote_messages(spark, sf))


def normalize_quotes(spark, sf):
    return _normalized(spark, sf).select(
        "run_id", "event_id", "source", "symbol", "received_at_unix_ns", "trading_date",
        "update_type", "ltp", "last_traded_qty", "exchange_feed_time", "volume_traded_today",
        "open_interest", "lower_circuit", "upper_circuit",
        F.array_join("sanitized_fields", ",").alias("sanitized_fields"),
        F.size("present_fields").alias("n_fields"),
    )


def route_quotes(spark, sf):
    routed = route.route_quotes(quote_messages(spark, sf), feeds.configured(spark, sf))
    return routed.select(
        "run_id", "event_id", "symbol", "route", route.severity(F.col("route")).alias("severity"),
        "connection_key",
    )


def control_events(spark, sf):
    from feedloom.streaming.ingest import quote_control

    rows = quote_control(quote_messages(spark, sf), feeds.configured(spark, sf))
    return rows.select(
        "run_id", "event_id", "source", "component", "event_type", "severity", "symbol",
        "trading_date", F.length("details_json").alias("details_chars"),
    )


def server_errors(spark, sf):
    return route.server_errors(quote_messages(spark, sf)).select("run_id", "event_id")


def symbol_membership(spark, sf):
    named = ticks(spark, sf).withColumn("symbol", feeds.spelled_symbol())
    return universe.members(named, feeds.configured(spark, sf)).select("tick_id", "symbol")


def symbol_connection(spark, sf):
    named = ticks(spark, sf).withColumn("symbol", feeds.spelled_symbol())
    return universe.with_membership(named, feeds.configured(spark, sf)).select(
        "tick_id", "symbol", "connection_key"
    )


def symbol_universe(spark, sf):
    """Each document's text as the comma list of one run's configuration."""
    return universe.universe(
        feeds.spread(table(spark, sf, "documents"), "doc_id"), "text", ["doc_id"],
        max_symbols=None,
    ).select("doc_id", "position", "symbol")


def connection_groups(spark, sf):
    listed = universe.universe(
        table(spark, sf, "conversations"), "text", ["conv_id", "turn"], max_symbols=None
    )
    return listed.groupBy("conv_id", "turn", "connection_key").agg(
        F.count(F.lit(1)).alias("symbols"), F.min("position").alias("first_position")
    )


def envelope(spark, sf):
    rows = normalize.with_envelope(
        quote_messages(spark, sf).drop("payload"), "symbol_update"
    )
    return rows.select(
        "schema_version", "run_id", "event_id", "source", "received_at_unix_ns",
        F.unix_micros("received_at_utc").alias("utc_micros"), "received_at_local",
        "trading_date", "receipt_hour",
    )


def in_session(spark, sf):
    return ticks(spark, sf).select(
        "tick_id",
        clock.in_session(clock.utc_time(F.col("received_at_unix_ns"))).alias("in_session"),
    )


def _date_texts(spark, sf):
    day = F.col("o_orderdate").cast("timestamp")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.date_format(day, "yyyyMM"),
                                                                F.lit("31")))
        .when(F.col("o_orderpriority") == "5-LOW", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "yyyyMMdd"))
    )
    return table(spark, sf, "orders").select("o_orderkey", text.alias("date_text"))


def valid_dates(spark, sf):
    return _date_texts(spark, sf).select(
        "o_orderkey", "date_text",
        clock.is_compact_date(F.col("date_text")).alias("compact"),
        clock.is_calendar_date(F.col("date_text")).alias("valid"),
    )


# Words common in the documents, one inside another, standing in for secrets.
SECRETS = ("tion", "the", "ation", "que", "er")


def redact_text(spark, sf):
    text = redact.redact_text(F.col("text"), SECRETS)
    return table(spark, sf, "documents").select("doc_id", F.md5(text).alias("redacted_md5"),
                                                F.length(text).alias("chars"))


def redact_details(spark, sf):
    details = F.to_json(
        F.struct(
            F.col("n_chars").alias("ther"),
            F.col("lang"),
            F.array(F.struct(F.col("text").alias("question"))).alias("nested"),
        )
    )
    cleaned = table(spark, sf, "documents").withColumn(
        "_clean", redact.redact_details(details, SECRETS)
    )
    inner = F.from_json("_clean", "ther long, nested array<struct<question:string>>")
    return cleaned.select(
        "doc_id", inner["ther"].alias("ther"),
        F.md5(inner["nested"][0]["question"]).alias("redacted_md5"),
    )


def object_key(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        keys.object_key(
            F.lit("pages"), F.concat(F.lit("//pages/"), F.col("url"), F.lit("/")),
            F.lpad(F.col("page_id").cast("string"), 8, "0"),
        ).alias("object_key"),
    )


def unfinished_policy(spark, sf):
    """Pages as files per site; addresses with a query string stand for unfinished parts."""
    files = table(spark, sf, "pages").select(
        F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("site"),
        F.when(F.contains("url", F.lit("?")), F.concat("url", F.lit(".inprogress")))
        .otherwise(F.col("url")).alias("path"),
    )
    return archive.unfinished_counts(files, "site")


_REPLACED = "text"
for _secret in redact._longest_first(SECRETS):
    _REPLACED = f"replace({_REPLACED}, '{_secret}', '{redact.MARK}')"

_V = "CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE CAST(value AS VARCHAR) END"
_NAMED = "CASE WHEN symbol IS NULL THEN '' ELSE '\"symbol\":\"' || symbol || '\"' END"
_COMMA = "CASE WHEN symbol IS NULL THEN '' ELSE ',' END"
_VOL = "CAST(floor(value * 100) AS BIGINT)"
# Symbols as Python would trim and fold them.
_TRIM = r"regexp_replace({}, '^[\s\v\x1c-\x1f\x{{85}}\x{{a0}}]+|[\s\v\x1c-\x1f\x{{85}}\x{{a0}}]+$', '', 'g')"


def _listed(keys_sql: str, source: str) -> str:
    return f"""WITH items AS (
  SELECT {keys_sql}, unnest(string_split({_TRIM.format('text')}, ',')) AS item,
         generate_subscripts(string_split({_TRIM.format('text')}, ','), 1) AS place
  FROM {source}),
named AS (SELECT {keys_sql}, {_TRIM.format('item')} AS symbol, place FROM items),
firsts AS (SELECT *, row_number() OVER (PARTITION BY {keys_sql}, upper(symbol) ORDER BY place) AS nth
  FROM named WHERE symbol <> ''),
universe AS (SELECT {keys_sql}, symbol,
    row_number() OVER (PARTITION BY {keys_sql} ORDER BY place) - 1 AS position
  FROM firsts WHERE nth = 1)
"""


QUERIES = {
    "coerce_float": (coerce_float, QUOTE_VIEW + """
SELECT event_id, ltp, CASE WHEN k <> 1 AND kind IN ('click', 'signup') THEN 0.0::DOUBLE END
         AS lower_circuit,
       CASE WHEN k <> 1 THEN CASE kind WHEN 'click' THEN value WHEN 'signup' THEN 0.0 END END
         AS upper_circuit FROM quotes"""),
    "coerce_int": (coerce_int, QUOTE_VIEW + """
SELECT event_id, last_traded_qty, volume_traded_today, exchange_feed_time FROM quotes"""),
    "alias_first": (alias_first, QUOTE_VIEW + f"""
SELECT event_id,
       CASE WHEN k <> 1 THEN CASE kind WHEN 'view' THEN k || '' WHEN 'click' THEN k || '.7'
         WHEN 'purchase' THEN '-' || k || '.7' WHEN 'signup' THEN '' ELSE '{BIG}' END END AS qty_text,
       CASE WHEN k <> 1 AND kind = 'purchase' THEN k || '' END AS interest_text,
       CASE WHEN k <> 1 AND kind = 'purchase' THEN 'empty' END AS price_is FROM quotes"""),
    "canonical_json": (canonical_json, QUOTE_VIEW + f"""
SELECT event_id, CASE WHEN k = 1 THEN '["heartbeat",' || {_V} || ']'
  WHEN kind = 'view' THEN '{{"future":{{"a":[1,2],"b":' || k || '}},"last_traded_qty":' || k ||
    ',"ltp":' || {_V} || ',' || {_NAMED} || {_COMMA} || '"type":"sf","vol_traded_today":' || {_VOL} || '}}'
  WHEN kind = 'click' THEN '{{"last_price":"' || CAST(value AS VARCHAR) || '","lower_ckt":0,"ltq":"' || k ||
    '.7",' || {_NAMED} || {_COMMA} || '"type":"","upper_ckt":' || {_V} || ',"vtt":"' || {_VOL} || '"}}'
  WHEN kind = 'purchase' THEN '{{"OI":' || k || ',"last_price":' || {_V} || ',"last_quantity":"-' || k ||
    '.7","ltp":"","oi":1,' || {_NAMED} || {_COMMA} || '"type":null,"volume":' || {_VOL} || '}}'
  WHEN kind = 'signup' THEN '{{"exch_feed_time":"1e3","last_traded_qty":null,"lower_ckt":0,"ltp":"abc","ltq":"",' ||
    {_NAMED} || {_COMMA} || '"upper_ckt":"0.0"}}'
  ELSE '{{"last_traded_qty":{BIG},"ltp":' || {_V} || ',"s":"Error",' || {_NAMED} || {_COMMA} ||
    '"vol_traded_today":' || {_VOL} || '}}' END AS raw_json FROM quotes"""),
    "present_fields": (present_fields, QUOTE_VIEW + f"""
SELECT event_id, CASE WHEN k <> 1 THEN CASE kind
  WHEN 'view' THEN 'future,last_traded_qty,ltp,' || s || 'type,vol_traded_today'
  WHEN 'click' THEN 'last_price,lower_ckt,ltq,' || s || 'type,upper_ckt,vtt'
  WHEN 'purchase' THEN 'OI,last_price,last_quantity,ltp,oi,' || s || 'type,volume'
  WHEN 'signup' THEN 'exch_feed_time,last_traded_qty,lower_ckt,ltp,ltq,' || s || 'upper_ckt'
  ELSE 'last_traded_qty,ltp,s,' || s || 'vol_traded_today' END END AS present_fields
FROM (SELECT *, CASE WHEN symbol IS NULL THEN '' ELSE 'symbol,' END AS s FROM quotes)"""),
    "sanitize_zero_pair": (sanitize_zero_pair, QUOTE_VIEW + """
SELECT event_id, lower_circuit, upper_circuit, sanitized AS sanitized_fields FROM quotes"""),
    "normalize_quotes": (normalize_quotes, QUOTE_VIEW + """
SELECT run_id, event_id, 'symbol_update' AS source, symbol, received_at_unix_ns,
       strftime(make_timestamp(received_at_unix_ns // 1000) + INTERVAL 330 MINUTE, '%Y-%m-%d') AS trading_date,
       update_type, ltp, last_traded_qty, exchange_feed_time, volume_traded_today, open_interest,
       lower_circuit, upper_circuit, sanitized AS sanitized_fields,
       CASE WHEN k <> 1 THEN CASE kind WHEN 'view' THEN 5 WHEN 'click' THEN 6 WHEN 'purchase' THEN 7
         WHEN 'signup' THEN 6 ELSE 4 END + CASE WHEN symbol IS NULL THEN 0 ELSE 1 END END
         AS n_fields FROM quotes"""),
    "route_quotes": (route_quotes, with_sql(TICKS_SQL, QUOTES_SQL, CONFIGURED_SQL) + """
SELECT q.run_id, q.event_id, q.symbol, q.route,
       CASE q.route WHEN 'service_message' THEN 'INFO' WHEN 'data' THEN NULL ELSE 'WARNING' END AS severity,
       c.connection_key
FROM quotes q LEFT JOIN configured c ON upper(q.symbol) = c.symbol_upper"""),
    "control_events": (control_events, QUOTE_VIEW + f"""
SELECT run_id, event_id, 'control' AS source, 'data' AS component, route AS event_type,
       CASE route WHEN 'service_message' THEN 'INFO' ELSE 'WARNING' END AS severity, symbol,
       strftime(make_timestamp(received_at_unix_ns // 1000) + INTERVAL 330 MINUTE, '%Y-%m-%d') AS trading_date,
       length(CASE WHEN k = 1 THEN '{{"payload":"[\\"heartbeat\\",' || CAST(value AS VARCHAR) || ']"}}'
         WHEN kind = 'view' THEN '{{"future":{{"a":[1,2],"b":' || k || '}},"last_traded_qty":' || k ||
           ',"ltp":' || {_V} || ',' || {_NAMED} || {_COMMA} || '"type":"sf","vol_traded_today":' || {_VOL} || '}}'
         WHEN kind = 'click' THEN '{{"last_price":"' || CAST(value AS VARCHAR) || '","lower_ckt":0,"ltq":"' || k ||
           '.7",' || {_NAMED} || {_COMMA} || '"type":"","upper_ckt":' || {_V} || ',"vtt":"' || {_VOL} || '"}}'
         WHEN kind = 'purchase' THEN '{{"OI":' || k || ',"last_price":' || {_V} || ',"last_quantity":"-' || k ||
           '.7","ltp":"","oi":1,' || {_NAMED} || {_COMMA} || '"type":null,"volume":' || {_VOL} || '}}'
         WHEN kind = 'signup' THEN '{{"exch_feed_time":"1e3","last_traded_qty":null,"lower_ckt":0,"ltp":"abc","ltq":"",' ||
           {_NAMED} || {_COMMA} || '"upper_ckt":"0.0"}}'
         ELSE '{{"last_traded_qty":{BIG},"ltp":' || {_V} || ',"s":"Error",' || {_NAMED} || {_COMMA} ||
           '"vol_traded_today":' || {_VOL} || '}}' END) AS details_chars
FROM quotes WHERE route <> 'data'"""),
    "server_errors": (server_errors, QUOTE_VIEW + """
SELECT run_id, event_id FROM quotes WHERE kind = 'error' AND k <> 1"""),
    "symbol_membership": (symbol_membership, with_sql(TICKS_SQL, CONFIGURED_SQL) + f"""
SELECT tick_id, symbol FROM (SELECT tick_id, {feeds.SYMBOL_SQL} AS symbol FROM ticks)
WHERE upper(symbol) IN (SELECT symbol_upper FROM configured)"""),
    "symbol_connection": (symbol_connection, with_sql(TICKS_SQL, CONFIGURED_SQL) + f"""
SELECT t.tick_id, t.symbol, c.connection_key
FROM (SELECT tick_id, {feeds.SYMBOL_SQL} AS symbol FROM ticks) t
LEFT JOIN configured c ON upper(t.symbol) = c.symbol_upper"""),
    "symbol_universe": (symbol_universe, _listed("doc_id", "documents") + """
SELECT doc_id, position, symbol FROM universe"""),
    "connection_groups": (connection_groups, _listed("conv_id, turn", "conversations") + """
SELECT conv_id, turn, 'tbt:' || (position // 5 + 1) AS connection_key, count(*) AS symbols,
       min(position) AS first_position FROM universe GROUP BY ALL"""),
    "envelope": (envelope, with_sql(TICKS_SQL) + """
SELECT 1 AS schema_version, run_id, tick_id * 3 + 2 AS event_id, 'symbol_update' AS source,
       received_at_unix_ns, received_at_unix_ns // 1000 AS utc_micros,
       strftime(local, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30' AS received_at_local,
       strftime(local, '%Y-%m-%d') AS trading_date, strftime(local, '%H') AS receipt_hour
FROM (SELECT *, make_timestamp(received_at_unix_ns // 1000) + INTERVAL 330 MINUTE AS local FROM ticks)"""),
    "in_session": (in_session, with_sql(TICKS_SQL) + """
SELECT tick_id, isodow(local) < 6 AND CAST(local AS TIME) >= TIME '09:15:00'
         AND CAST(local AS TIME) < TIME '15:31:00' AS in_session
FROM (SELECT *, make_timestamp(received_at_unix_ns // 1000) + INTERVAL 330 MINUTE AS local FROM ticks)"""),
    "valid_dates": (valid_dates, """
WITH d AS (SELECT o_orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN strftime(o_orderdate, '%Y%m') || '31'
    WHEN '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%Y%m%d') END AS date_text
  FROM orders)
SELECT o_orderkey, date_text, regexp_full_match(date_text, '[0-9]{8}') AS compact,
       regexp_full_match(date_text, '[0-9]{8}') AND try_strptime(date_text, '%Y%m%d') IS NOT NULL AS valid
FROM d"""),
    "redact_text": (redact_text, f"""
SELECT doc_id, md5({_REPLACED}) AS redacted_md5, length({_REPLACED}) AS chars FROM documents"""),
    "redact_details": (redact_details, f"""
SELECT doc_id, n_chars AS ther, md5({_REPLACED}) AS redacted_md5 FROM documents"""),
    "object_key": (object_key, """
SELECT page_id, rtrim(url, '/') || '/' || lpad(page_id || '', 8, '0') || '/' || lpad(page_id || '', 8, '0') || '_trade_ticks.tar.gz'
  AS object_key FROM pages"""),
    "unfinished_policy": (unfinished_policy, """
SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS site,
       count(*) FILTER (WHERE NOT contains(url, '?')) AS kept,
       count(*) FILTER (WHERE contains(url, '?')) AS skipped FROM pages GROUP BY 1"""),
}
