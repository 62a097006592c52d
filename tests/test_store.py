"""Storage: recorded layouts, sinks, receipts, fingerprints and archives."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import archive, normalize
from feedloom.sources import lake
from feedloom.streaming import sinks

BUCKET, PREFIX, ENDPOINT = "bk", "holder/contracts", "https://objects.example"


def quotes(spark, size=40, days=2):
    rows = [
        ("r", i + 1, "c", 1, 1784259900000000000 + (i % days) * 86_400_000_000_000 + i, i,
         json.dumps({"symbol": f"S{i % 3}", "ltp": i}))
        for i in range(size)
    ]
    return normalize.normalize_quotes(spark.createDataFrame(rows, schemas.QUOTE_MESSAGES))


def test_dated_layout_with_unsigned_and_fixed_size_columns(spark, tmp_path):
    folder = tmp_path / "20260717" / "tbtdepth"
    folder.mkdir(parents=True)
    fixed = pa.list_(pa.float64(), 50)
    table = pa.table(
        {
            "event_id": pa.array([2, 1], pa.int64()),
            "symbol": pa.array(["S", "S"]),
            "trading_date": pa.array(["2026-07-17"] * 2),
            "bid_prices": pa.array([[float(i) for i in range(50)]] * 2, fixed),
            "sequence_no": pa.array([2**64 - 1, 9007199254740993], pa.uint64()),
            "raw_json": pa.array(["{}", None], pa.large_string()),
        }
    )
    pq.write_table(table, folder / "part-tbtdepth-20260717-1.parquet")
    (folder / ".part-2.parquet.x.inprogress").write_bytes(b"partial")
    rows = lake.scan_dated_parts(spark, str(tmp_path), schemas.TBT_DEPTH).orderBy("event_id").collect()
    assert [int(r["sequence_no"]) for r in rows] == [9007199254740993, 2**64 - 1]
    assert rows[0]["bid_prices"][49] == 49.0 and rows[0]["raw_json"] is None
    (tmp_path / "a" / "b" / "c" / "d").mkdir(parents=True)
    for place in (tmp_path, tmp_path / "a" / "b" / "c" / "d"):
        (place / ".part-3.parquet.inprogress").write_bytes(b"")
    assert len(lake.unfinished_parts(spark, str(tmp_path))) == 3
    assert lake.unfinished_parts(spark, str(tmp_path / "absent")) == []


@pytest.mark.parametrize("codec", ["zstd", "snappy", "gzip", "lz4", "none"])
def test_batch_round_trip_and_rotation(spark, tmp_path, codec):
    rows = quotes(spark)
    sinks.append_batch(rows, str(tmp_path), schemas.SYMBOL_UPDATE, rows_per_file=7, compression=codec)
    back = lake.scan_parts(spark, str(tmp_path), schemas.SYMBOL_UPDATE)
    assert sorted(r["event_id"] for r in back.collect()) == list(range(1, 41))
    assert back.select(*rows.columns).exceptAll(rows).count() == 0
    parts = lake.part_stats(back).collect()
    assert max(p["rows"] for p in parts) <= 7 and sum(p["rows"] for p in parts) == 40
    assert len(parts) == len(list((tmp_path / "symbolupdate").rglob("*.parquet")))


def test_codec_without_a_writer_is_refused():
    with pytest.raises(ValueError, match="no writer"):
        sinks.codec("brotli")
    with pytest.raises(ValueError, match="unknown"):
        sinks.codec("zip")


def test_append_never_replaces(spark, tmp_path):
    for _ in range(2):
        sinks.append_batch(quotes(spark, 5, 1), str(tmp_path), schemas.SYMBOL_UPDATE)
    back = lake.scan_parts(spark, str(tmp_path), schemas.SYMBOL_UPDATE)
    assert sorted(r["event_id"] for r in back.collect()) == sorted([1, 2, 3, 4, 5] * 2)


def test_dates_prune_folders(spark, tmp_path):
    sinks.append_batch(quotes(spark), str(tmp_path), schemas.SYMBOL_UPDATE)
    day = lake.scan_parts(spark, str(tmp_path), schemas.SYMBOL_UPDATE).where(
        F.col("trading_date") == "2026-07-17"
    )
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trading_date" in plan and day.count() == 20


def test_finalized_dates(spark):
    def paths(*texts):
        return spark.createDataFrame([(t,) for t in texts], "path string")

    rows = archive.finalized_dates(
        paths("20260718/tbtdepth/p2", "20260717/control/p1", "20260718/symbolupdate/p3")
    ).collect()
    assert sorted(r["trading_date"] for r in rows) == ["20260717", "20260718"]
    with pytest.raises(ValueError, match="no finished parts"):
        archive.finalized_dates(paths("x").limit(0))
    with pytest.raises(Exception, match="invalid trading-date"):
        archive.finalized_dates(paths("_runs/run/manifest.json")).collect()


def test_unfinished_policy(spark):
    files = spark.createDataFrame([("20260717", "a.parquet"), ("20260717", ".b.inprogress")],
                                  "trading_date string, path string")
    assert archive.apply_unfinished_policy(files, strict=False).count() == 1
    assert tuple(archive.unfinished_counts(files).first()) == ("20260717", 1, 1)
    with pytest.raises(Exception, match="unfinished file"):
        archive.apply_unfinished_policy(files, strict=True).collect()


def fingerprints(spark, *files):
    frame = spark.createDataFrame(
        list(files), "trading_date string, relative_path string, size_bytes long, modified_ms long"
    )
    return {r["trading_date"]: r["source_fingerprint"] for r in archive.tree_fingerprint(frame).collect()}


def test_fingerprint_sees_every_change(spark):
    base = [("d", "a", 1, 10), ("d", "b", 2, 20)]
    kept = fingerprints(spark, *base)["d"]
    assert fingerprints(spark, *reversed(base))["d"] == kept
    for changed in (
        [("d", "a", 1, 10)], [*base, ("d", "c", 1, 1)], [("d", "a", 2, 10), base[1]],
        [("d", "a", 1, 11), base[1]], [("d", "x", 1, 10), base[1]], [*base, *base],
    ):
        assert fingerprints(spark, *changed)["d"] != kept


def test_receipt_clears_a_date_until_anything_differs(spark, tmp_path):
    root = str(tmp_path)
    dates = spark.createDataFrame([("20260717", "f1")], "trading_date string, source_fingerprint string")
    done = archive.with_archive_keys(dates, BUCKET, PREFIX).withColumns(
        {"sha256": F.lit("s"), "upload_status": F.lit("verified"), "endpoint_url": F.lit(ENDPOINT)}
    )
    archive.write_receipts(done, root)
    receipts = lake.scan_receipts(spark, root)

    def pending(now="f1", prefix=PREFIX, endpoint=ENDPOINT):
        current = dates.withColumn("source_fingerprint", F.lit(now))
        return archive.pending_dates(
            current, receipts, bucket=BUCKET, prefix=prefix, endpoint=endpoint
        ).count()

    assert pending() == 0
    assert pending(now="f2") == 1
    assert pending(prefix="different") == 1
    assert pending(endpoint="https://other.example") == 1
    archive.write_receipts(done, root)
    assert lake.scan_receipts(spark, root).count() == 1
    broken = tmp_path / "_uploads" / "20260718.json"
    broken.write_text("not-json")
    assert [r["trading_date"] for r in lake.scan_receipts(spark, root).collect()] == ["20260717"]


def test_one_failing_copy_leaves_the_other_date_verified(spark):
    def files(*rows):
        return spark.createDataFrame(
            list(rows), "trading_date string, relative_path string, size_bytes long, sha256 string"
        )

    source = files(("d1", "a", 1, "x"), ("d1", "b", 2, "y"), ("d2", "a", 1, "z"))
    copy = files(("d1", "a", 1, "x"), ("d1", "b", 2, "other"), ("d2", "a", 1, "z"))
    got = archive.copy_status(archive.verify_copy(source, copy)).collect()
    assert {r["trading_date"]: r["upload_status"] for r in got} == {"d1": "failed", "d2": "verified"}


def test_archive_keeps_rows_and_repeats(spark, tmp_path):
    root, copy = str(tmp_path / "lake"), str(tmp_path / "copy")
    rows = quotes(spark)
    sinks.append_batch(rows.unionByName(rows), root, schemas.SYMBOL_UPDATE, rows_per_file=5)
    dates = spark.createDataFrame([("2026-07-17",), ("2026-07-30",), ("bad",)], "trading_date string")
    got = {
        r["trading_date"]: (r["upload_status"], r["rows"], r["rows_copied"])
        for r in archive.archive_dates(spark, root, schemas.SYMBOL_UPDATE, copy, dates).collect()
    }
    assert got == {
        "2026-07-17": ("verified", 40, 40),
        "2026-07-30": ("archive_failed", None, None),
        "bad": ("archive_failed", None, None),
    }
    stored = lake.scan_parts(spark, copy, schemas.SYMBOL_UPDATE)
    assert stored.select("trading_date").distinct().count() == 1


def test_dates_are_archived_one_after_another(spark, tmp_path):
    root, copy = str(tmp_path / "lake"), str(tmp_path / "copy")
    sinks.append_batch(quotes(spark), root, schemas.SYMBOL_UPDATE)
    stored = lake.scan_parts(spark, root, schemas.SYMBOL_UPDATE)
    days = sorted(r["trading_date"] for r in stored.select("trading_date").distinct().collect())

    def archived(*asked):
        dates = spark.createDataFrame([(d,) for d in asked], "trading_date string")
        found = archive.archive_dates(spark, root, schemas.SYMBOL_UPDATE, copy, dates).collect()
        return {r["trading_date"]: r["upload_status"] for r in found}

    extra = stored.where(F.col("trading_date") == days[0]).withColumn("trading_date", F.lit("2026-07-20"))
    sinks.append_batch(extra, root, schemas.SYMBOL_UPDATE)
    assert archived(days[0]) == {days[0]: "verified"}
    folder = next((tmp_path / "lake").rglob("trading_date=2026-07-20"))
    unfinished = folder / ".part-9.parquet.inprogress"
    unfinished.write_bytes(b"")
    assert archived(days[0], "2026-07-20") == {days[0]: "verified", "2026-07-20": "archive_failed"}
    unfinished.unlink()
    assert archived("2026-07-20") == {"2026-07-20": "verified"}
    dates = lake.scan_parts(spark, copy, schemas.SYMBOL_UPDATE).groupBy("trading_date").count()
    assert {r["trading_date"] for r in dates.collect()} == {days[0], "2026-07-20"}


def test_row_digest_counts_repeats(spark):
    one = spark.createDataFrame([("d", 1), ("d", 2)], "trading_date string, v int")
    twice = one.unionByName(one).unionByName(one)
    compared = archive.compare_tables(archive.table_digest(one), archive.table_digest(twice))
    assert compared.first()["upload_status"] == "failed"
