"""Queries that go through storage: message sources, sinks, scans, parts, archives, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import clock
from feedloom.operators import archive, manifest, normalize, quality, replay
from feedloom.plans import feeds, runs
from feedloom.plans.depth import STATUS_SQL, depth_core
from feedloom.plans.feeds import (
    BOOKS_SQL, CONTROL_SQL, QUOTES_SQL, TICKS_SQL, books, configured, quote_messages, table, ticks,
    with_sql,
)
from feedloom.session import shared_dir
from feedloom.sources import lake, messages
from feedloom.streaming import ingest, sequence as live_sequence, sinks

_LOCAL_DAY = "make_timestamp(received_at_unix_ns // 1000) + INTERVAL 330 MINUTE"


def src_quotes(spark, sf):
    """Quote messages from a landing folder through the stream into the lake and back."""
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    quote_messages(spark, sf).write.json(landing)
    arrived = messages.quote_messages(spark, landing)
    sinks.drain(
        *ingest.record_quotes(
            arrived, configured(spark, sf), root, shared_dir(spark, "progress"),
            flush_seconds=None,
        )
    )
    names = ["run_id", "event_id", "source", "symbol", "trading_date"]
    rows = lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE).select(
        *names, F.col("ltp"), F.col("last_traded_qty"), F.lit(None).cast("string").alias("event_type")
    )
    control = lake.scan_parts(spark, root, schemas.CONTROL).select(
        *names, F.lit(None).cast("double").alias("ltp"),
        F.lit(None).cast("bigint").alias("last_traded_qty"), "event_type",
    )
    return rows.unionByName(control)


def src_depth(spark, sf):
    """Depth messages from a landing folder: full books become rows, the rest is left out."""
    landing, root = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    books(spark, sf).write.json(landing, compression="gzip")
    kept, _ = normalize.split_books(messages.depth_messages(spark, landing))
    rows = normalize.normalize_depth(kept).withColumns(
        {
            "previous_sequence_no": F.lit(None).cast("decimal(20,0)"),
            "sequence_delta": F.lit(None).cast("bigint"),
            "sequence_status": F.lit("first"),
            "is_first_after_reconnect": F.lit(False),
        }
    )
    sinks.drain(
        sinks.append_stream(
            rows.select(*schemas.DEPTH.fieldNames()), root, schemas.TBT_DEPTH,
            shared_dir(spark, "progress"), flush_seconds=None,
        )
    )
    return lake.scan_parts(spark, root, schemas.TBT_DEPTH).select(
        "run_id", "event_id", "symbol", "channel", "trading_date",
        F.element_at("bid_prices", 1).alias("bid_1"), F.size("ask_quantities").alias("levels"),
        F.col("sequence_no").cast("bigint").alias("sequence_no"),
    )


def src_lifecycle(spark, sf):
    """Open, close and error messages become control rows, secrets removed."""
    landing = shared_dir(spark, "landing")
    kind = (
        F.when(F.col("kind") == "signup", "open")
        .when(F.col("kind") == "purchase", "close")
        .when(F.col("k") < 50, "error")
        .otherwise("server_error")
    )
    said = F.concat(F.lit('token-7 said "'), F.col("kind"), F.lit('"'))
    ticks(spark, sf).where(F.col("kind") != "view").select(
        "run_id",
        (F.col("tick_id") * 3 + 3).alias("event_id"),
        F.lit("c").alias("connection_id"),
        F.lit(1).alias("connection_epoch"),
        "received_at_unix_ns",
        F.col("received_at_unix_ns").alias("received_at_monotonic_ns"),
        F.when(F.col("k") < 50, "data").otherwise("tbt").alias("component"),
        kind.alias("kind"),
        said.alias("payload"),
    ).write.json(landing)
    arrived = messages.lifecycle_messages(spark, landing)
    root = shared_dir(spark, "lake")
    sinks.drain(
        sinks.append_stream(
            ingest.lifecycle_control(arrived, ("token-7",)), root, schemas.CONTROL,
            shared_dir(spark, "progress"), flush_seconds=None,
        )
    )
    return lake.scan_parts(spark, root, schemas.CONTROL).select(
        "run_id", "event_id", "component", "event_type", "severity", "message",
        F.get_json_object("details_json", "$.payload").alias("said"),
    )


def _stored_quotes(spark, sf, **options) -> str:
    """A fresh lake that holds the quote stream."""
    root = shared_dir(spark, "lake")
    rows = normalize.normalize_quotes(quote_messages(spark, sf))
    sinks.append_batch(rows, root, schemas.SYMBOL_UPDATE, **options)
    return root


def sink_roundtrip(spark, sf):
    root = _stored_quotes(spark, sf)
    return lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE).select(
        "run_id", "event_id", "symbol", "trading_date", "receipt_hour", "update_type", "ltp",
        "last_traded_qty", "volume_traded_today", F.size("sanitized_fields").alias("sanitized"),
    )


def sink_rotation(spark, sf):
    """Rows per date, and whether every file kept to the limit."""
    limit = sinks.ROWS_PER_FILE
    root = _stored_quotes(spark, sf, rows_per_file=limit)
    parts = lake.part_stats(lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE))
    date = F.regexp_extract("path", "trading_date=([^/]+)/", 1)
    return parts.groupBy(date.alias("trading_date")).agg(
        F.sum("rows").alias("rows"), F.max(F.col("rows") > limit).alias("over_limit")
    )


def scan_parts(spark, sf):
    """Prices and volumes over all recorded dates."""
    root = _stored_quotes(spark, sf)
    rows = lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE)
    return rows.select(
        "event_id", "symbol", "ltp", "last_traded_qty", "volume_traded_today",
        "received_at_local",
    )


def _dates(name: str):
    return F.regexp_extract(name, "trading_date=([^/]+)/", 1).alias("trading_date")


def part_stats(spark, sf):
    """Statistics and digests of all parts, summed up per date."""
    root = _stored_quotes(spark, sf)
    parts = lake.part_stats(lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE))
    sums = lake.file_digests(spark, lake.stream_path(root, schemas.SYMBOL_UPDATE),
                             glob="*.parquet")
    return parts.join(sums, "path").groupBy(_dates("path"), "source").agg(
        F.sum("rows").alias("rows"),
        F.min("min_event_id").alias("min_event_id"),
        F.max("max_event_id").alias("max_event_id"),
        F.min("min_received_at_unix_ns").alias("min_received_at_unix_ns"),
        F.max("max_received_at_unix_ns").alias("max_received_at_unix_ns"),
        F.min(F.col("bytes") > 0).alias("has_bytes"),
        F.min(F.length("sha256")).alias("digest_chars"),
    )


def file_digest(spark, sf):
    """Digest of each stored part against a second reading of it, per date."""
    path = lake.stream_path(_stored_quotes(spark, sf), schemas.SYMBOL_UPDATE)
    first = lake.file_digests(spark, path, glob="*.parquet")
    again = lake.file_digests(spark, path, glob="*.parquet").withColumnRenamed("sha256", "_again")
    return first.join(again, "path").groupBy(_dates("path")).agg(
        F.min(F.col("sha256") == F.col("_again")).alias("equal"),
        F.min(F.length("sha256")).alias("digest_chars"),
    )


def file_inventory(spark, sf):
    """Files listed per date against the files a scan reads rows from."""
    root = _stored_quotes(spark, sf)
    listed = lake.file_inventory(spark, root, glob="*.parquet")
    read = lake.part_stats(lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE))
    return (
        listed.join(read.select("path", "rows", "bytes"), "path", "left")
        .groupBy(
            F.regexp_extract("relative_path", "^([^/]+)/", 1).alias("directory"),
            _dates("relative_path"),
        )
        .agg(
            F.sum("rows").alias("rows"),
            F.min(F.col("size_bytes").eqNullSafe(F.col("bytes"))).alias("sizes_agree"),
        )
    )


def part_latest(spark, sf):
    """Latest receipt of each buffer (stream, date, hour): the name of its part."""
    rows = normalize.with_envelope(quote_messages(spark, sf), schemas.SYMBOL_UPDATE)
    latest = rows.groupBy("source", "trading_date", "receipt_hour").agg(
        F.max("received_at_unix_ns").alias("_ns")
    )
    # The local time follows from the nanoseconds, so only a number is aggregated.
    local = clock.iso_local(clock.utc_time(F.col("_ns")))
    return latest.withColumn("latest_received_at_local", local).drop("_ns")


def written_counts(spark, sf):
    root = _stored_quotes(spark, sf)
    parts = lake.part_stats(lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE))
    return parts.groupBy("source").agg(
        F.sum("rows").alias("rows_written"),
        (F.count(F.lit(1)) >= F.count_distinct(_dates("path"))).alias("a_file_per_date"),
    )


def scan_manifests(spark, sf):
    root = shared_dir(spark, "lake")
    built = manifest.manifests(
        feeds.seen_events(spark, sf), quality.with_effects(
            feeds.control_core(spark, sf).withColumn("connection_epoch", F.lit(1))
        ),
        settings=runs.SETTINGS, secret_names=("token",), require_ready=False,
    )
    manifest.write_manifests(built, root)
    return lake.scan_manifests(spark, root).select(
        "run_id", "status", "started_at_unix_ns", "ended_at_unix_ns",
        F.array_join("degraded_reasons", ",").alias("degraded_reasons"),
        F.col("received_events")["tbt_depth"].alias("received_depth"),
        F.col("symbols_seen")["data"].alias("symbols_data"),
        F.col("configuration")["token"].alias("token"),
    )


def run_catalogue(spark, sf):
    """Rows of each run that replay takes or refuses, by the markers that lie in the lake.

    The first run left no marker, the last two of them; the others have what their manifests say.
    """
    root, seen = shared_dir(spark, "lake"), feeds.seen_events(spark, sf)
    built = manifest.manifests(
        seen, quality.with_effects(
            feeds.control_core(spark, sf).withColumn("connection_epoch", F.lit(1))
        ),
        settings=runs.SETTINGS, secret_names=("token",), require_ready=False,
    )
    manifest.write_manifests(built, root)
    ended = lake.scan_manifests(spark, root).orderBy("run_id").select("run_id", "status").collect()
    for row in ended[1:]:  # One row per run.
        manifest.write_marker(spark, root, row["run_id"], row["status"])
    for row in ended[-1:]:
        manifest.place_marker(spark, root, row["run_id"], "failed")
    known = lake.scan_runs(spark, root)
    taken = replay.trusted(seen, known).withColumn("taken", F.lit(True))
    refused = replay.quarantined(seen, known).withColumn("taken", F.lit(False))
    return (
        taken.unionByName(refused)
        .groupBy("run_id", "taken")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(known.select("run_id", "status"), "run_id")
    )


BUCKET, PREFIX, ENDPOINT = "lake-copies", "copies/contracts", "https://objects.example"


def _archived(spark, sf):
    root, copy = _stored_quotes(spark, sf), shared_dir(spark, "archive")
    stored = lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE).select("trading_date").distinct()
    # A date that was never recorded is asked for as well, for every one that was.
    unknown = stored.select(F.replace("trading_date", F.lit("2024"), F.lit("1999")))
    return archive.archive_dates(
        spark, root, schemas.SYMBOL_UPDATE, copy, stored.union(unknown)
    )


def archive_date(spark, sf):
    return _archived(spark, sf).select("trading_date", "rows", "rows_copied", "upload_status")


def _receipts(spark, sf):
    """Receipts of all archived dates, stored and read back."""
    root = shared_dir(spark, "lake")
    done = archive.with_archive_keys(_archived(spark, sf), BUCKET, PREFIX).withColumns(
        {"endpoint_url": F.lit(ENDPOINT), "sha256": F.col("source_fingerprint")}
    )
    archive.write_receipts(done, root)
    return lake.scan_receipts(spark, root)


def receipts(spark, sf):
    return _receipts(spark, sf).select(
        "trading_date", "upload_status", "bucket_name", "object_key",
        F.col("verified_at_utc").isNotNull().alias("stamped"),
    )


def scan_receipts(spark, sf):
    return _receipts(spark, sf).select(
        "trading_date", "endpoint_url", F.length("source_fingerprint").alias("digest_chars")
    )


def pending_dates(spark, sf):
    """Documents as dates, labels as their receipts; many receipts are stale or failed."""
    # Eight digits per document stand for its date.
    dates = table(spark, sf, "documents").select(
        F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("trading_date"),
        F.sha2("text", 256).alias("source_fingerprint"),
    )
    proofs = archive.with_archive_keys(
        table(spark, sf, "labels")
        .select(F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("trading_date"),
                "quality", "toxic")
        .join(dates, "trading_date"),
        BUCKET, PREFIX,
    ).select(
        "trading_date", "bucket_name", "object_key", F.lit(ENDPOINT).alias("endpoint_url"),
        F.lit("d").alias("sha256"),
        F.when(F.col("toxic") == 1, "failed").otherwise("verified").alias("upload_status"),
        F.when(F.col("quality") == 1, F.col("source_fingerprint")).otherwise("stale")
        .alias("source_fingerprint"),
    )
    return archive.pending_dates(
        dates, proofs, bucket=BUCKET, prefix=PREFIX, endpoint=ENDPOINT
    ).select("trading_date", "object_key")


def finalized_dates(spark, sf):
    day = F.replace(clock.trading_date(clock.utc_time(F.col("received_at_unix_ns"))), F.lit("-"),
                    F.lit(""))
    paths = ticks(spark, sf).select(
        F.concat(day, F.lit("/control/part-"), F.col("tick_id").cast("string")).alias("path")
    )
    return archive.finalized_dates(paths)


def dates_to_archive(spark, sf):
    shipped = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("trading_date")
    )
    ordered = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("trading_date")
    )
    return archive.dates_to_archive(shipped, ordered)


def tree_fingerprint(spark, sf):
    """Documents as files of a folder per source."""
    files = table(spark, sf, "documents").select(
        "source", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("relative_path"),
        F.col("n_chars").alias("size_bytes"), (F.col("doc_id") * 1000).alias("modified_ms"),
    )
    return archive.tree_fingerprint(files, "source")


def archive_verify(spark, sf):
    """Labelled documents were copied: some truncated (quality 0), some altered (toxic)."""
    docs = table(spark, sf, "documents").select(
        "source", "doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
        .alias("relative_path"), F.col("n_chars").alias("size_bytes"),
        F.sha2("text", 256).alias("sha256"),
    )
    copies = docs.join(table(spark, sf, "labels"), "doc_id").select(
        "source", "relative_path",
        (F.col("size_bytes") - F.when(F.col("quality") == 0, 1).otherwise(0)).alias("size_bytes"),
        F.when(F.col("toxic") == 1, "altered").otherwise(F.col("sha256")).alias("sha256"),
    )
    compared = archive.verify_copy(docs, copies, "source")
    return compared.groupBy("source", "outcome").agg(F.count(F.lit(1)).alias("files"))


def archive_status(spark, sf):
    """The same comparison by file owner: a folder with one unequal file failed."""
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("folder"), F.lit("text").alias("relative_path"),
        F.col("n_chars").alias("size_bytes"), F.sha2("text", 256).alias("sha256"),
    )
    copies = table(spark, sf, "labels").join(docs, F.col("doc_id") == F.col("folder")).select(
        "folder", "relative_path", "size_bytes",
        F.when(F.col("toxic") == 1, "altered").otherwise(F.col("sha256")).alias("sha256"),
    )
    return archive.copy_status(archive.verify_copy(docs, copies, "folder"), "folder")


def stream_sequence(spark, sf):
    """The depth feed diagnosed live, micro-batch by micro-batch."""
    recorded, root = shared_dir(spark, "recorded"), shared_dir(spark, "live")
    depth_core(spark, sf).write.parquet(recorded)
    schema = spark.read.parquet(recorded).schema
    live_sequence.start(
        messages.parquet_messages(spark, recorded, schema), root, flush_seconds=None
    ).awaitTermination()
    return live_sequence.read_rows(spark, root).select(
        "run_id", "event_id", "symbol", "connection_epoch",
        F.col("sequence_no").cast("bigint").alias("sequence_no"),
        F.col("previous_sequence_no").cast("bigint").alias("previous_sequence_no"),
        "sequence_delta", "sequence_status", "is_first_after_reconnect",
    )


QUOTE_VIEW = with_sql(TICKS_SQL, QUOTES_SQL)
_DATED = f"(SELECT *, strftime({_LOCAL_DAY}, '%Y-%m-%d') AS trading_date FROM quotes)"
_LANES = " || ':' || ".join(
    f"CAST(sum(CAST('0x' || substr(h, {1 + 8 * lane}, 8) AS BIGINT)) AS VARCHAR)"
    for lane in range(8)
)

QUERIES = {
    "src_quotes": (src_quotes, QUOTE_VIEW + f"""
SELECT run_id, event_id, CASE route WHEN 'data' THEN 'symbol_update' ELSE 'control' END AS source,
       symbol, trading_date, CASE WHEN route = 'data' THEN ltp END AS ltp,
       CASE WHEN route = 'data' THEN last_traded_qty END AS last_traded_qty,
       CASE WHEN route <> 'data' THEN route END AS event_type FROM {_DATED}"""),
    "src_depth": (src_depth, with_sql(TICKS_SQL, BOOKS_SQL) + f"""
SELECT b.run_id, b.event_id, b.symbol, '1' AS channel,
       strftime({_LOCAL_DAY}, '%Y-%m-%d') AS trading_date,
       b.cents::DOUBLE AS bid_1, 50 AS levels, b.sequence_no
FROM books b JOIN ticks t ON b.event_id = t.tick_id * 3 + 1 WHERE full_book"""),
    "src_lifecycle": (src_lifecycle, with_sql(TICKS_SQL) + """
SELECT run_id, tick_id * 3 + 3 AS event_id, CASE WHEN k < 50 THEN 'data' ELSE 'tbt' END AS component,
       CASE kind WHEN 'signup' THEN 'socket_open' WHEN 'purchase' THEN 'socket_close'
         ELSE CASE WHEN k < 50 THEN 'socket_error' ELSE 'server_error' END END AS event_type,
       CASE kind WHEN 'signup' THEN 'INFO' WHEN 'purchase' THEN 'WARNING' ELSE 'ERROR' END AS severity,
       CASE WHEN kind <> 'signup' THEN '<redacted> said "' || kind || '"' END AS message,
       '<redacted> said "' || kind || '"' AS said
FROM ticks WHERE kind <> 'view'"""),
    "sink_roundtrip": (sink_roundtrip, QUOTE_VIEW + f"""
SELECT run_id, event_id, symbol, trading_date, strftime({_LOCAL_DAY}, '%H') AS receipt_hour,
       update_type, ltp, last_traded_qty, volume_traded_today,
       CASE sanitized WHEN '' THEN 0 ELSE 2 END AS sanitized FROM {_DATED}"""),
    "sink_rotation": (sink_rotation, QUOTE_VIEW + f"""
SELECT trading_date, count(*) AS rows, false AS over_limit FROM {_DATED} GROUP BY 1"""),
    "scan_parts": (scan_parts, QUOTE_VIEW + f"""
SELECT event_id, symbol, ltp, last_traded_qty, volume_traded_today,
       strftime({_LOCAL_DAY}, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30' AS received_at_local
FROM {_DATED}"""),
    "part_stats": (part_stats, QUOTE_VIEW + f"""
SELECT trading_date, 'symbol_update' AS source, count(*) AS rows, min(event_id) AS min_event_id,
       max(event_id) AS max_event_id, min(received_at_unix_ns) AS min_received_at_unix_ns,
       max(received_at_unix_ns) AS max_received_at_unix_ns, true AS has_bytes, 64 AS digest_chars
FROM {_DATED} GROUP BY 1"""),
    "file_digest": (file_digest, QUOTE_VIEW + f"""
SELECT DISTINCT trading_date, true AS equal, 64 AS digest_chars FROM {_DATED}"""),
    "file_inventory": (file_inventory, QUOTE_VIEW + f"""
SELECT 'symbolupdate' AS directory, trading_date, count(*) AS rows, true AS sizes_agree
FROM {_DATED} GROUP BY ALL"""),
    "part_latest": (part_latest, QUOTE_VIEW + f"""
SELECT 'symbol_update' AS source, trading_date, strftime({_LOCAL_DAY}, '%H') AS receipt_hour,
       max_by(strftime({_LOCAL_DAY}, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30', received_at_unix_ns)
         AS latest_received_at_local FROM {_DATED} GROUP BY ALL"""),
    "written_counts": (written_counts, QUOTE_VIEW + f"""
SELECT 'symbol_update' AS source, count(*) AS rows_written,
       true AS a_file_per_date FROM {_DATED}"""),
    "scan_manifests": (scan_manifests, with_sql(TICKS_SQL, CONTROL_SQL, feeds.SEEN_SQL) + """
, per_run AS (
  SELECT run_id, string_agg(DISTINCT component || '_socket_closed', ','
      ORDER BY component || '_socket_closed') AS reasons
  FROM control WHERE event_type = 'socket_close' AND severity = 'WARNING' GROUP BY run_id)
SELECT s.run_id, CASE WHEN max(p.reasons) IS NULL THEN 'complete' ELSE 'degraded' END AS status,
       min(received_at_unix_ns) AS started_at_unix_ns, max(received_at_unix_ns) AS ended_at_unix_ns,
       coalesce(max(p.reasons), '') AS degraded_reasons,
       count(*) FILTER (WHERE component = 'tbt') AS received_depth,
       count(DISTINCT symbol_upper) FILTER (WHERE component = 'data') AS symbols_data,
       '<redacted>' AS token
FROM seen s LEFT JOIN per_run p USING (run_id) GROUP BY s.run_id"""),
    "run_catalogue": (run_catalogue, with_sql(TICKS_SQL, CONTROL_SQL, feeds.SEEN_SQL) + """
, per_run AS (
  SELECT s.run_id, count(*) AS rows, row_number() OVER (ORDER BY s.run_id) AS place,
         count(*) OVER () AS runs,
         EXISTS (SELECT 1 FROM control c WHERE c.run_id = s.run_id
           AND event_type = 'socket_close' AND severity = 'WARNING') AS closed
  FROM seen s GROUP BY s.run_id)
SELECT run_id, rows, place > 1 AND place < runs AS taken,
       CASE WHEN place = 1 THEN 'unfinished' WHEN place = runs THEN 'ambiguous'
            WHEN closed THEN 'degraded' ELSE 'complete' END AS status
FROM per_run"""),
    "archive_date": (archive_date, QUOTE_VIEW + f"""
, days AS (SELECT trading_date, count(*) AS n FROM {_DATED} GROUP BY 1)
SELECT trading_date, n AS rows, n AS rows_copied, 'verified' AS upload_status FROM days
UNION ALL SELECT replace(trading_date, '2024', '1999'), NULL, NULL, 'archive_failed' FROM days"""),
    "receipts": (receipts, QUOTE_VIEW + f"""
SELECT DISTINCT trading_date, 'verified' AS upload_status, '{BUCKET}' AS bucket_name,
       '{PREFIX}/' || trading_date || '/' || trading_date || '_trade_ticks.tar.gz' AS object_key,
       true AS stamped FROM {_DATED}"""),
    "scan_receipts": (scan_receipts, QUOTE_VIEW + f"""
SELECT DISTINCT trading_date, '{ENDPOINT}' AS endpoint_url, 64 AS digest_chars FROM {_DATED}"""),
    "pending_dates": (pending_dates, f"""
SELECT d AS trading_date, '{PREFIX}/' || d || '/' || d || '_trade_ticks.tar.gz' AS object_key
FROM (SELECT doc_id, lpad(doc_id || '', 8, '0') AS d FROM documents)
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)"""),
    "finalized_dates": (finalized_dates, QUOTE_VIEW + f"""
SELECT DISTINCT replace(trading_date, '-', '') AS trading_date FROM {_DATED}"""),
    "dates_to_archive": (dates_to_archive, """
SELECT strftime(l_shipdate, '%Y%m%d') AS trading_date FROM lineitem
UNION SELECT strftime(o_orderdate, '%Y%m%d') FROM orders"""),
    "tree_fingerprint": (tree_fingerprint, f"""
SELECT source, count(*) AS file_count, sum(n_chars)::BIGINT AS size_bytes,
       sha256(count(*) || ':' || {_LANES}) AS source_fingerprint
FROM (SELECT source, n_chars, sha256('file' || chr(9) || 'doc-' || doc_id || chr(9) || n_chars || chr(9)
        || doc_id * 1000) AS h FROM documents) GROUP BY source"""),
    "archive_verify": (archive_verify, """
SELECT d.source, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN quality = 0 THEN 'size_mismatch'
  WHEN toxic = 1 THEN 'digest_mismatch' ELSE 'equal' END AS outcome, count(*) AS files
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL"""),
    "archive_status": (archive_status, """
SELECT doc_id AS folder, 1 AS files, CASE WHEN toxic = 0 THEN 0 ELSE 1 END AS unequal,
       CASE WHEN toxic = 0 THEN 'verified' ELSE 'failed' END AS upload_status
FROM documents LEFT JOIN labels USING (doc_id)"""),
    "stream_sequence": (stream_sequence, STATUS_SQL),
}
