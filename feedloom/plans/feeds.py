"""The given tables seen as feeds: every registered query starts from one of these.

Each adapter has a SQL twin of the same content in ``SQL``; the twins state the expected values
directly and parse no JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.scan import Running, running
from feedloom.operators.universe import connection_key
from feedloom.session import shared_dir

# Fixed values of the adapters: scaled limits for a feed with hours between rows.
STALE_SECONDS = 86_400
GATE_SECONDS = 86_400
GRACE_SECONDS = 86_400
BIG = 9_007_199_254_740_993
# Rows of costly row-local work that one task takes.
HEAVY_ROWS = 50_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def spread(rows: DataFrame, key: str, rows_per_task: int | None = None) -> DataFrame:
    """Rows over all cores if the scan has fewer splits than cores, else untouched.

    A small file is one split and would keep one core busy. A large table has more splits than
    the cluster has cores and is never shuffled here, unless ``rows_per_task`` bounds what a task
    may take: splits are cut by bytes, and narrow rows may grow a hundredfold behind the scan.
    """
    wanted = rows.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        wanted = max(wanted, -(-rows.count() // rows_per_task))  # Counted from the file footers.
    if rows.rdd.getNumPartitions() >= wanted:
        return rows
    return rows.repartition(wanted, key)


def ticks(spark: SparkSession, sf: str, *, heavy: bool = False) -> DataFrame:
    """``events`` with a run per ten days of a month, receipt nanoseconds and the props number.

    ``heavy`` announces costly row-local work on top (see ``spread``).
    """
    events = table(spark, sf, "events")
    stamp = F.col("ts").cast("timestamp")
    run = F.call_function("div", F.dayofmonth(stamp) - 1, F.lit(10))
    return (spread(events, "event_id", HEAVY_ROWS) if heavy else events).select(
        F.concat(F.lit("run-"), run.cast("string")).alias("run_id"),
        F.col("event_id").alias("tick_id"),
        (F.unix_micros(stamp) * 1000).alias("received_at_unix_ns"),
        "user_id",
        F.col("event_type").alias("kind"),
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


TICKS_SQL = """ticks AS (
  SELECT 'run-' || CAST((day(ts) - 1) // 10 AS VARCHAR) AS run_id, event_id AS tick_id,
         epoch_us(ts) * 1000 AS received_at_unix_ns, user_id, event_type AS kind, value,
         CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
  FROM events)"""


def spelled_symbol() -> Column:
    """Ticker of a tick: a few come from another exchange or in lower case."""
    user = F.col("user_id").cast("string")
    return (
        F.when(F.col("k") == 2, F.concat(F.lit("BSE:U"), user))
        .when(F.col("k") == 3, F.concat(F.lit("nse:u"), user))
        .otherwise(F.concat(F.lit("NSE:U"), user))
    )


SYMBOL_SQL = """CASE WHEN k = 2 THEN 'BSE:U' || user_id WHEN k = 3 THEN 'nse:u' || user_id
  ELSE 'NSE:U' || user_id END"""


def configured(spark: SparkSession, sf: str) -> DataFrame:
    """Universe of the event feeds: one symbol per user, listed by user number."""
    return (
        ticks(spark, sf)
        .select("user_id")
        .distinct()
        .select(
            F.col("user_id").alias("position"),
            F.concat(F.lit("NSE:U"), F.col("user_id").cast("string")).alias("symbol"),
            F.concat(F.lit("NSE:U"), F.col("user_id").cast("string")).alias("symbol_upper"),
            connection_key(F.col("user_id")).alias("connection_key"),
        )
    )


CONFIGURED_SQL = """configured AS (
  SELECT DISTINCT user_id AS position, 'NSE:U' || user_id AS symbol,
         'NSE:U' || user_id AS symbol_upper, 'tbt:' || (user_id // 5 + 1) AS connection_key
  FROM ticks)"""


def configured_per_run(spark: SparkSession, sf: str) -> DataFrame:
    """Every run is configured with the whole universe."""
    # Days 1 to 31 of a month in spans of ten: every run that ``ticks`` can name.
    possible = F.array(*[F.lit(f"run-{span}") for span in range((31 - 1) // 10 + 1)])
    return (
        configured(spark, sf)
        .select(F.explode(possible).alias("run_id"), "symbol_upper", "connection_key")
        .join(ticks(spark, sf).select("run_id").distinct(), "run_id", "left_semi")
    )


RUN_UNIVERSE_SQL = """run_universe AS (
  SELECT r.run_id, c.symbol_upper, c.connection_key
  FROM configured c, (SELECT DISTINCT run_id FROM ticks) r)"""


def _arrival(ids: Column, epoch: Column, connection: Column) -> list[Column]:
    return [
        F.col("run_id"),
        ids.alias("event_id"),
        connection.alias("connection_id"),
        epoch.cast("int").alias("connection_epoch"),
        F.col("received_at_unix_ns"),
        F.col("received_at_unix_ns").alias("received_at_monotonic_ns"),
    ]


def quote_messages(spark: SparkSession, sf: str, *, known_symbol: bool = False) -> DataFrame:
    """One quote message per tick, its payload built from the tick's kind.

    k = 0 has no symbol, k = 1 is not an object. ``known_symbol`` adds the symbol as a column.
    """
    symbol = F.when(F.col("k") != 0, spelled_symbol())
    named = F.when(symbol.isNotNull(), F.concat(F.lit('"symbol":"'), symbol, F.lit('",')))
    named = F.coalesce(named, F.lit(""))
    price = F.col("value").cast("string")
    k = F.col("k").cast("string")
    volume = F.floor(F.col("value") * 100).cast("string")

    def build(*pieces: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    payload = (
        F.when(F.col("k") == 1, build('["heartbeat",', price, "]"))
        .when(
            F.col("kind") == "view",
            build("{", named, '"type":"sf","ltp":', price, ',"last_traded_qty":', k,
                  ',"vol_traded_today":', volume, ',"future":{"b":', k, ',"a":[1,2]}}'),
        )
        .when(
            F.col("kind") == "click",
            build("{", named, '"type":"","last_price":"', price, '","ltq":"', k,
                  '.7","vtt":"', volume, '","lower_ckt":0,"upper_ckt":', price, "}"),
        )
        .when(
            F.col("kind") == "purchase",
            build("{", named, '"type":null,"ltp":"","last_price":', price,
                  ',"last_quantity":"-', k, '.7","volume":', volume, ',"OI":', k, ',"oi":1}'),
        )
        .when(
            F.col("kind") == "signup",
            build("{", named, '"ltp":"abc","last_traded_qty":null,"ltq":"",'
                  '"exch_feed_time":"1e3","lower_ckt":0,"upper_ckt":"0.0"}'),
        )
        .otherwise(
            build('{"s":"Error",', named, '"ltp":', price, f',"last_traded_qty":{BIG}',
                  ',"vol_traded_today":', volume, "}")
        )
    )
    return ticks(spark, sf, heavy=True).select(
        *_arrival(F.col("tick_id") * 3 + 2, F.lit(1), F.lit("data")),
        payload.alias("payload"),
        *([F.when(F.col("k") != 1, symbol).alias("symbol")] if known_symbol else []),
    )


QUOTES_SQL = f"""quotes AS (
  SELECT run_id, tick_id * 3 + 2 AS event_id, received_at_unix_ns, kind, value, k,
         CASE WHEN k NOT IN (0, 1) THEN {SYMBOL_SQL} END AS symbol,
         CASE WHEN k <> 1 THEN CASE kind WHEN 'view' THEN 'sf' WHEN 'purchase' THEN 'None' END END
           AS update_type,
         CASE WHEN k <> 1 AND kind IN ('view', 'click', 'error') THEN value END AS ltp,
         CASE WHEN k <> 1 THEN CASE kind WHEN 'view' THEN k WHEN 'click' THEN k
           WHEN 'purchase' THEN -k WHEN 'error' THEN {BIG} END END AS last_traded_qty,
         CASE WHEN k <> 1 AND kind <> 'signup' THEN CAST(floor(value * 100) AS BIGINT) END
           AS volume_traded_today,
         CASE WHEN k <> 1 AND kind = 'purchase' THEN k END AS open_interest,
         CASE WHEN k <> 1 AND kind = 'signup' THEN 1000 END AS exchange_feed_time,
         CASE WHEN k <> 1 AND kind = 'click' THEN 0.0::DOUBLE END AS lower_circuit,
         CASE WHEN k <> 1 AND kind = 'click' THEN value END AS upper_circuit,
         CASE WHEN k <> 1 AND kind = 'signup' THEN 'lower_circuit,upper_circuit' ELSE '' END
           AS sanitized,
         CASE WHEN k = 1 THEN 'unrecognized_message'
              WHEN k = 0 THEN 'service_message'
              WHEN k = 2 THEN 'unexpected_symbol' ELSE 'data' END AS route
  FROM ticks)"""


def depth_core(spark: SparkSession, sf: str) -> DataFrame:
    """Narrow depth rows: sequence number k (none for views), snapshots, connection and epoch.

    A connection reopens after each large error row of its symbols.
    """
    keyed = ticks(spark, sf).withColumns(
        {
            "connection_key": connection_key(F.col("user_id")),
            "_lost": F.when((F.col("kind") == "error") & (F.col("value") > 100), 1).otherwise(0),
        }
    )
    counted = running(
        keyed, ("run_id", "connection_key"), "tick_id", {"_before": Running(F.col("_lost"), "sum")}
    )
    return counted.select(
        "run_id",
        (F.col("tick_id") * 3 + 1).alias("event_id"),
        "received_at_unix_ns",
        spelled_symbol().alias("symbol"),
        "connection_key",
        (F.coalesce("_before", F.lit(0)) + 1).cast("int").alias("connection_epoch"),
        F.when(F.col("kind") != "view", F.col("k")).cast("decimal(20,0)").alias("sequence_no"),
        (F.col("kind") == "signup").alias("is_snapshot"),
    )


DEPTH_SQL = f"""depth AS (
  SELECT run_id, tick_id * 3 + 1 AS event_id, received_at_unix_ns, kind, value, k,
         {SYMBOL_SQL} AS symbol, connection_key,
         1 + count(*) FILTER (WHERE kind = 'error' AND value > 100) OVER (
           PARTITION BY run_id, connection_key ORDER BY tick_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS connection_epoch,
         CASE WHEN kind <> 'view' THEN k END AS sequence_no, kind = 'signup' AS is_snapshot
  FROM (SELECT *, 'tbt:' || (user_id // 5 + 1) AS connection_key FROM ticks))"""


def _met(spark: SparkSession, sf: str, epochs: DataFrame) -> DataFrame:
    """Ticks with their epochs, at rest, so that they are dealt anew by their number."""
    by_tick = epochs.withColumn("tick_id", F.call_function("div", F.col("event_id") - 1, F.lit(3)))
    met = stored(ticks(spark, sf).join(by_tick.drop("event_id"), "tick_id"), "epochs")
    return spread(met, "tick_id", HEAVY_ROWS)


def books(
    spark: SparkSession, sf: str, levels: int = schemas.BOOK_LEVELS, epochs: DataFrame | None = None
) -> DataFrame:
    """Depth messages with 50 levels as text; purchases carry a bad level, some errors 49.

    Prices are whole hundredths, five apart. ``epochs`` (``event_id, connection_epoch``) is met by
    the narrow ticks, before their books are built; without it every epoch is the first.
    """
    short = (F.col("kind") == "error") & (F.col("k") < 10)
    full = levels == schemas.BOOK_LEVELS

    def side(first: Column, step: int) -> Column:
        texts = F.sequence(first, first + step * (levels - 1), F.lit(step).cast("bigint"))
        return texts.cast("array<string>")

    def cut(texts: Column) -> Column:
        return F.when(short, F.slice(texts, 1, levels - 1)).otherwise(texts) if full else texts

    def prices(first: Column, last: str) -> Column:
        texts = side(first, 5)
        if not full:
            return texts
        head = F.slice(texts, 1, levels - 1)
        spoilt = F.concat(head, F.array(F.lit(last)))
        return F.when(F.col("kind") == "purchase", spoilt).otherwise(cut(texts))

    def sizes(plus: int) -> Column:
        return cut(side(F.col("k") + plus, 1))

    def orders(count: str) -> Column:
        return cut(F.array_repeat(F.lit(count), levels))

    cents = F.floor(F.col("value") * 100)
    sides = {
        "bidprice": prices(cents, "x"),
        "askprice": prices(cents + 100, ""),
        "bidqty": sizes(1),
        "askqty": sizes(2),
        "bidordn": orders("3"),
        "askordn": orders("4"),
    }
    k = F.col("k").cast("string")
    sequence = F.when(F.col("kind") == "click", F.concat(k, F.lit(".7"))).when(
        F.col("kind") != "view", k
    )
    message = F.struct(
        k.alias("tbq"),
        F.concat(k, F.lit(".9")).alias("tsq"),
        *[F.col(name) for name in sides],
        F.when(F.col("kind") == "signup", "true").otherwise("false").alias("snapshot"),
        F.lit("100").alias("timestamp"),
        F.lit("1e2").alias("sendtime"),
        sequence.alias("seqNo"),
    )
    if epochs is None:
        rows, epoch = ticks(spark, sf, heavy=True), F.lit(1)
    else:
        rows, epoch = _met(spark, sf, epochs), F.col("connection_epoch")
    return rows.withColumns(sides).select(
        *_arrival(F.col("tick_id") * 3 + 1, epoch, connection_key(F.col("user_id"))),
        spelled_symbol().alias("ticker"),
        F.lit("1").alias("channel"),
        message.alias("message"),
    )


BOOKS_SQL = f"""books AS (
  SELECT run_id, tick_id * 3 + 1 AS event_id, {SYMBOL_SQL} AS symbol, kind, value, k,
         CAST(floor(value * 100) AS BIGINT) AS cents,
         CASE WHEN kind <> 'view' THEN k END AS sequence_no,
         NOT (kind = 'error' AND k < 10) AS full_book
  FROM ticks)"""


def control_core(spark: SparkSession, sf: str) -> DataFrame:
    """Open and close rows: signups open, errors close; small k is the quote connection."""
    data = F.col("k") < 50
    return (
        ticks(spark, sf)
        .where(F.col("kind").isin("signup", "error"))
        .select(
            "run_id",
            (F.col("tick_id") * 3 + 3).alias("event_id"),
            "received_at_unix_ns",
            F.when(data, "data").otherwise("tbt").alias("component"),
            F.when(data, F.lit("data"))
            .otherwise(connection_key(F.col("user_id")))
            .alias("connection_key"),
            F.when(F.col("kind") == "signup", "socket_open")
            .otherwise("socket_close")
            .alias("event_type"),
            F.when((F.col("kind") == "error") & (F.col("value") > 5), "WARNING")
            .otherwise("INFO")
            .alias("severity"),
            F.lit("{}").alias("details_json"),
        )
    )


CONTROL_SQL = """control AS (
  SELECT run_id, tick_id * 3 + 3 AS event_id, received_at_unix_ns,
         CASE WHEN k < 50 THEN 'data' ELSE 'tbt' END AS component,
         CASE WHEN k < 50 THEN 'data' ELSE 'tbt:' || (user_id // 5 + 1) END AS connection_key,
         CASE kind WHEN 'signup' THEN 'socket_open' ELSE 'socket_close' END AS event_type,
         CASE WHEN kind = 'error' AND value > 5 THEN 'WARNING' ELSE 'INFO' END AS severity
  FROM ticks WHERE kind IN ('signup', 'error'))"""


def run_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Start, readiness and end of each run: its first and last receipt."""
    return ticks(spark, sf).groupBy("run_id").agg(
        F.min("received_at_unix_ns").alias("ready_at_ns"),
        F.min("received_at_unix_ns").alias("opened_at_ns"),
        F.min("received_at_unix_ns").alias("started_at_unix_ns"),
        F.max("received_at_unix_ns").alias("ended_at_ns"),
    )


SPANS_SQL = """spans AS (
  SELECT run_id, min(received_at_unix_ns) AS ready_at_ns, max(received_at_unix_ns) AS ended_at_ns
  FROM ticks GROUP BY run_id)"""


def seen_events(spark: SparkSession, sf: str) -> DataFrame:
    """Receipts of configured symbols on both feeds: quotes for even k, depth for odd k."""
    odd = F.col("k") % 2 == 1
    return ticks(spark, sf).where(F.col("k") != 2).select(
        "run_id",
        (F.col("tick_id") * 3 + F.when(odd, 1).otherwise(2)).alias("event_id"),
        F.when(odd, "tbt").otherwise("data").alias("component"),
        F.when(odd, "tbt_depth").otherwise("symbol_update").alias("source"),
        spelled_symbol().alias("symbol"),
        "received_at_unix_ns",
        F.lit(1).alias("connection_epoch"),
    )


SEEN_SQL = f"""seen AS (
  SELECT run_id, tick_id * 3 + CASE WHEN k % 2 = 1 THEN 1 ELSE 2 END AS event_id,
         CASE WHEN k % 2 = 1 THEN 'tbt' ELSE 'data' END AS component,
         upper({SYMBOL_SQL}) AS symbol_upper, received_at_unix_ns
  FROM ticks WHERE k <> 2)"""


def line_control(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` as control rows of one run per order."""
    flag = F.col("l_returnflag")
    event_type = (
        F.when((flag == "R") & (F.col("l_discount") >= 0.09), "server_error")
        .when(flag == "R", "sequence_gap")
        .when(flag == "A", "socket_close")
        .when(F.col("l_linenumber") == 1, "socket_error")
        .otherwise("streams_ready")
    )
    severity = (
        F.when(event_type.isin("server_error", "socket_error"), "ERROR")
        .when((event_type == "sequence_gap") | ((flag == "A") & (F.col("l_tax") >= 0.06)),
              "WARNING")
        .otherwise("INFO")
    )
    said = F.when(F.col("l_discount") < 0.04, '{"payload":"{\\"s\\":\\"ERROR\\"}"}').otherwise(
        '{"payload":"{\\"s\\":\\"ok\\"}"}'
    )
    return spread(table(spark, sf, "lineitem"), "l_orderkey").select(
        F.col("l_orderkey").alias("run_id"),
        (F.col("l_linenumber") * F.lit(10**12) + F.col("l_partkey")).alias("event_id"),
        F.when(flag == "R", "tbt_depth").when(flag == "A", "symbol_update").otherwise("control")
        .alias("source"),
        F.when(F.col("l_linestatus") == "O", "data").otherwise("tbt").alias("component"),
        event_type.alias("event_type"),
        severity.alias("severity"),
        F.lit(1).alias("connection_epoch"),
        said.alias("details_json"),
    )


LINES_SQL = """lines AS (
  SELECT l_orderkey AS run_id, l_linenumber * 1000000000000 + l_partkey AS event_id,
         CASE l_returnflag WHEN 'R' THEN 'tbt_depth' WHEN 'A' THEN 'symbol_update'
           ELSE 'control' END AS source,
         CASE WHEN l_linestatus = 'O' THEN 'data' ELSE 'tbt' END AS component,
         CASE WHEN l_returnflag = 'R' AND l_discount >= 0.09 THEN 'server_error'
              WHEN l_returnflag = 'R' THEN 'sequence_gap'
              WHEN l_returnflag = 'A' THEN 'socket_close'
              WHEN l_linenumber = 1 THEN 'socket_error' ELSE 'streams_ready' END AS event_type,
         l_discount, l_tax
  FROM lineitem),
effects AS (
  SELECT *, CASE event_type WHEN 'server_error' THEN component || '_server_error'
              WHEN 'sequence_gap' THEN 'tbt_sequence_gap'
              WHEN 'socket_error' THEN component || '_socket_error'
              WHEN 'socket_close' THEN CASE WHEN l_tax >= 0.06 THEN component || '_socket_closed' END
            END AS degraded_reason,
         CASE WHEN event_type = 'server_error' THEN component || '_server_error'
              WHEN event_type = 'socket_error' AND component = 'data' AND l_discount < 0.04
                THEN 'data_server_error' END AS fatal_reason
  FROM lines)"""


def order_runs(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` as finished runs; open orders left no completion marker."""
    status = (
        F.when(F.col("o_orderstatus") == "F", "complete")
        .when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), "failed")
        .when(F.col("o_orderstatus") == "P", "degraded")
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        status.alias("status"),
        (F.unix_micros(F.col("o_orderdate").cast("timestamp")) * 1000).alias("started_at_unix_ns"),
    ).where(F.col("status").isNotNull())


def stored(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written below the shared folder and read back: several readers, one computation."""
    path = shared_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
