"""Costly row-local work is dealt by rows, and messages at rest stay small."""

import json

from pyspark.sql import functions as F

from feedloom.functions import coerce
from feedloom.plans import feeds


def _events(spark, path, rows):
    spark.range(rows).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("error", "view", "purchase"))), (F.col("id") % 3 + 1).cast("int"))
        .alias("event_type"),
        (F.col("id") + 200).cast("double").alias("value"),
        F.format_string('{"k": %d}', F.col("id") % 90).alias("props"),
    ).coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_a_task_takes_a_bounded_number_of_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 1000, numPartitions=cores)
    assert feeds.spread(rows, "id").rdd.getNumPartitions() == cores
    cut = feeds.spread(rows, "id", rows_per_task=10)
    assert cut.rdd.getNumPartitions() == 100
    assert sorted(row[0] for row in cut.collect()) == list(range(1000))


def test_stages_beyond_the_jvms_method_size_are_compiled_by_operator(spark):
    from feedloom.session import SETTINGS

    assert int(SETTINGS["spark.sql.codegen.hugeMethodLimit"]) == 8000


def test_epochs_meet_ticks_before_books_are_built(spark, tmp_path):
    sf = _events(spark, tmp_path, 40)
    epochs = spark.createDataFrame([(3 * t + 1, t + 5) for t in range(0, 40, 2)] + [(1, 99), (None, 7)],
                                   "event_id long, connection_epoch int")
    made = feeds.books(spark, sf, epochs=epochs)
    got = sorted((r["event_id"], r["connection_epoch"]) for r in made.collect())
    assert got == sorted([(3 * t + 1, t + 5) for t in range(0, 40, 2)] + [(1, 99)])
    plain = {r["event_id"]: r["message"] for r in feeds.books(spark, sf).collect()}
    assert all(r["message"] == plain[r["event_id"]] for r in made.collect())


def test_sides_with_failed_and_odd_levels(spark):
    sides = [["1", "x", None], ["1.5", "", " 2 "], ["1d", "2"], ["0x1p3", "2"], ["NaN", "abc", "-Infinity"],
             ["3.f", "1e3"], ["7", "12.7", "1e2"], ["-1", "5"], [], None]
    rows = spark.createDataFrame([(n, json.dumps(s)) for n, s in enumerate(sides)], "n int, s string").select(
        "n", F.from_json("s", "array<string>").alias("s"))
    exact = lambda rule, zero: F.transform("s", lambda x: F.coalesce(rule(x), F.lit(zero)))
    got = rows.select(
        "n", coerce.double_levels(F.col("s")).alias("d"), exact(coerce.lenient_double, 0.0).alias("d2"),
        coerce.long_levels(F.col("s")).alias("l"), exact(coerce.lenient_long, 0).alias("l2"),
    ).collect()
    for row in got:
        assert str(row["d"]) == str(row["d2"]) and row["l"] == row["l2"], row
