"""Finished dates: which exist, which are pending, fingerprints, copies and receipts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import clock, digest, keys
from feedloom.operators.joins import sized_broadcast
from feedloom.session import shared_root
from feedloom.sources import lake


def finalized_dates(parts: DataFrame, path: str = "path") -> DataFrame:
    """Distinct dates that parts (paths relative to the data folder) were written to.

    A path that does not start with a compact date is an error, and so is no path at all.
    """
    if parts.isEmpty():
        raise ValueError("no finished parts")
    head = F.element_at(F.split(F.col(path), "/"), 1)
    refused = F.raise_error(
        F.concat(F.lit("invalid trading-date partition: "), head)
    ).cast("string")
    valid = F.when(clock.is_compact_date(head), head).otherwise(refused)
    return parts.select(valid.alias("trading_date")).distinct()


def dates_to_archive(current: DataFrame, pending: DataFrame) -> DataFrame:
    """Dates of this run and dates still pending, each once."""
    return current.select("trading_date").union(pending.select("trading_date")).distinct()


def apply_unfinished_policy(inventory: DataFrame, *, strict: bool) -> DataFrame:
    """Inventory without unfinished files; strict raises on the first one instead."""
    unfinished = F.endswith(F.col("path"), F.lit(lake.UNFINISHED))
    if strict:
        refused = F.raise_error(F.concat(F.lit("unfinished file: "), F.col("path")))
        return inventory.where(
            F.when(unfinished, refused.cast("boolean")).otherwise(F.lit(True))
        )
    return inventory.where(~unfinished)


def unfinished_counts(inventory: DataFrame, key: str = "trading_date") -> DataFrame:
    """Files kept and skipped per date under the lenient policy."""
    unfinished = F.endswith(F.col("path"), F.lit(lake.UNFINISHED))
    return inventory.groupBy(key).agg(
        F.count_if(~unfinished).alias("kept"), F.count_if(unfinished).alias("skipped")
    )


def tree_fingerprint(inventory: DataFrame, key: str = "trading_date") -> DataFrame:
    """Digest, file count and size per date over (path, size, modification time).

    Any added, removed, resized or rewritten file changes it. It is built by partial
    aggregation: a date's file list is never gathered in one place.
    """
    line = F.concat_ws(
        "\t",
        F.lit("file"),
        "relative_path",
        F.col("size_bytes").cast("string"),
        F.col("modified_ms").cast("string"),
    )
    return inventory.groupBy(key).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("size_bytes").alias("size_bytes"),
        digest.multiset_digest(line).alias("source_fingerprint"),
    )


def with_archive_keys(dates: DataFrame, bucket: str, prefix: str) -> DataFrame:
    """Add bucket and object key of each date."""
    return dates.withColumns(
        {
            "bucket_name": F.lit(bucket),
            "object_key": keys.object_key(F.lit(bucket), F.lit(prefix), F.col("trading_date")),
        }
    )


def pending_dates(
    dates: DataFrame, receipts: DataFrame, *, bucket: str, prefix: str, endpoint: str
) -> DataFrame:
    """Dates without a receipt that proves a verified copy of their current files.

    ``dates`` has ``trading_date, source_fingerprint`` of what is on disk now.
    """
    wanted = with_archive_keys(
        dates.where(clock.is_compact_date(F.col("trading_date"))), bucket, prefix
    )
    proof = receipts.where(
        (F.col("upload_status") == "verified")
        & (F.col("sha256") != "")
        & (F.col("source_fingerprint") != "")
        & (F.col("endpoint_url") == endpoint)
    ).select("trading_date", "source_fingerprint", "bucket_name", "object_key")
    return wanted.join(
        proof, ["trading_date", "source_fingerprint", "bucket_name", "object_key"], "left_anti"
    )


def verify_copy(source: DataFrame, copy: DataFrame, key: str = "trading_date") -> DataFrame:
    """Compare two inventories with digests, file by file.

    Both have ``key, relative_path, size_bytes, sha256``. Size is judged before content.
    """
    pairs = source.select(
        key, "relative_path", F.col("size_bytes").alias("_size"), F.col("sha256").alias("_sha")
    ).join(
        copy.select(
            key,
            "relative_path",
            F.col("size_bytes").alias("_copy_size"),
            F.col("sha256").alias("_copy_sha"),
        ),
        [key, "relative_path"],
        "full_outer",
    )
    outcome = (
        F.when(F.col("_copy_size").isNull(), "missing")
        .when(F.col("_size").isNull(), "unexpected")
        .when(F.col("_size") != F.col("_copy_size"), "size_mismatch")
        .when(F.col("_sha") != F.col("_copy_sha"), "digest_mismatch")
        .otherwise("equal")
    )
    return pairs.select(key, "relative_path", outcome.alias("outcome"))


def copy_status(compared: DataFrame, key: str = "trading_date") -> DataFrame:
    """Status per date: a date with any unequal file failed, the others are verified."""
    unequal = F.count_if(F.col("outcome") != "equal")
    return compared.groupBy(key).agg(
        F.count(F.lit(1)).alias("files"),
        unequal.alias("unequal"),
        F.when(unequal == 0, "verified").otherwise("failed").alias("upload_status"),
    )


def table_digest(rows: DataFrame, key: str = "trading_date") -> DataFrame:
    """Row count and row-hash totals per date: equal for equal bags of rows in any layout."""
    columns = sorted(rows.columns)
    return rows.groupBy(key).agg(*digest.row_digest(columns))


def _date_files(spark: SparkSession, root: str, stream: str) -> DataFrame:
    """Fingerprint per stored date of a stream, as it is now."""
    files = lake.file_inventory(spark, lake.stream_path(root, stream), glob="*.parquet")
    date = F.regexp_extract("relative_path", "(?:^|/)trading_date=([^/]+)/", 1)
    return tree_fingerprint(files.withColumn("trading_date", date))


def archive_dates(
    spark: SparkSession, root: str, stream: str, destination: str, dates: DataFrame
) -> DataFrame:
    """Rewrite finished dates of a stream into few files sorted by ``event_id``, and verify them.

    All dates go through one job, range-partitioned by date and id, so a heavy date is spread
    over tasks. Returns one record per asked date; a date fails on its own (malformed, empty,
    with unfinished files, changed while being archived, or copied wrongly) and the others still
    proceed. Each date replaces its own earlier copy only; other dates of ``destination`` stay.
    """
    shared_root(spark)
    named = F.col("trading_date")
    asked = dates.select("trading_date").distinct()
    valid = asked.where(clock.is_calendar_date(F.replace(named, F.lit("-"), F.lit(""))))
    open_parts = lake.unfinished_parts(spark, lake.stream_path(root, stream))
    still_open = {m[1] for path in open_parts if (m := re.search("/trading_date=([^/]+)/", path))}
    if still_open:
        valid = valid.where(~named.isin(sorted(still_open)))
    # Fixed before anything is copied: this is what the state afterwards is held against.
    before = _date_files(spark, root, stream).checkpoint()
    rows = lake.scan_parts(spark, root, stream).join(
        sized_broadcast(valid), "trading_date", "left_semi"
    )
    (
        rows.repartitionByRange("trading_date", "run_id", "event_id")
        .sortWithinPartitions("trading_date", "run_id", "event_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("trading_date")
        .parquet(lake.stream_path(destination, stream))
    )
    after = _date_files(spark, root, stream).select(
        "trading_date", F.col("source_fingerprint").alias("_after")
    )
    copied = lake.scan_parts(spark, destination, stream).join(
        sized_broadcast(valid), "trading_date", "left_semi"
    )
    compared = compare_tables(table_digest(rows), table_digest(copied)).withColumnRenamed(
        "upload_status", "_compared"
    )
    changed = ~F.col("source_fingerprint").eqNullSafe(F.col("_after"))
    status = F.when(F.col("source_fingerprint").isNull() | changed, "archive_failed").otherwise(
        F.coalesce("_compared", F.lit("archive_failed"))
    )
    return (
        asked.join(before, "trading_date", "left")
        .join(after, "trading_date", "left")
        .join(compared, "trading_date", "left")
        .withColumn("upload_status", status)
        .drop("_after", "_compared")
    )


def compare_tables(source: DataFrame, copy: DataFrame, key: str = "trading_date") -> DataFrame:
    """Row-level verdict per date from two ``table_digest`` results."""
    copied = copy.select(
        key, *[F.col(name).alias(f"_{name}") for name in ("rows", "hash_sum", "hash_xor")]
    )
    same = digest.all_true(
        [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in ("rows", "hash_sum", "hash_xor")]
    )
    return source.join(copied, key, "full_outer").select(
        key,
        "rows",
        F.col("_rows").alias("rows_copied"),
        F.when(same, "verified").otherwise("failed").alias("upload_status"),
    )


def write_receipts(verified: DataFrame, root: str) -> None:
    """Store one receipt per verified date, replacing only the dates present."""
    known = set(schemas.RECEIPTS.fieldNames())
    receipts = verified.where(F.col("upload_status") == "verified").withColumn(
        "verified_at_utc", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    )
    columns = [name for name in receipts.columns if name in known]
    (
        receipts.select(*columns)
        .withColumn("date", F.col("trading_date"))
        .repartition("date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", 1)
        .partitionBy("date")
        .json(f"{root.rstrip('/')}/_uploads")
    )
