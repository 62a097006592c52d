"""Run manifests and completion markers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions.redact import redacted_settings
from feedloom.operators import quality
from feedloom.operators.health import COMPONENTS
from feedloom.sources import lake


def _per_stream(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """One map per run from at most one row per run and fixed key (stream or component)."""
    return rows.groupBy("run_id").agg(
        F.map_from_entries(F.collect_list(F.struct(key, F.col(value).cast("bigint")))).alias(name)
    )


def _first_events(events: DataFrame, configured: DataFrame | None) -> DataFrame:
    """Per run and component, as columns, whether the first events that are waited for came."""
    names = ["run_id", "component", "symbol_upper"]
    came = (
        events.where(F.col("symbol").isNotNull())
        .select("run_id", "component", F.upper("symbol").alias("symbol_upper"))
        .groupBy(*names)
        .agg(F.lit(1).alias("came"))
    )
    if configured is None:
        waited = came
    else:
        expected = configured.select(
            "run_id", F.explode(F.array(*map(F.lit, COMPONENTS))).alias("component"), "symbol_upper"
        )
        waited = expected.join(came, names, "left")
    return waited.groupBy("run_id").agg(
        *(
            F.min(F.when(F.col("component") == name, F.col("came").isNotNull())).alias(f"_seen_{name}")
            for name in COMPONENTS
        )
    )


def manifests(
    events: DataFrame,
    effects: DataFrame,
    *,
    parts: DataFrame | None = None,
    configured: DataFrame | None = None,
    settings: Mapping[str, str] | None = None,
    secret_names: tuple[str, ...] = (),
    require_ready: bool = True,
) -> DataFrame:
    """One row per run, summarising its events, control effects and written parts.

    ``events`` has ``run_id, source, component, symbol, connection_epoch, event_id,
    received_at_unix_ns``; ``effects`` is control with ``quality.with_effects``; ``parts`` has
    ``run_id, source, rows``. First events of a component are seen once every symbol of
    ``configured`` (``run_id, symbol_upper``) arrived on it; without that table, once any did. The
    message of the first fatal control row, which was redacted when it was made, is the error that
    stopped the run. Symbols are counted here; the list itself is ``quality.coverage``,
    which grows with the universe and so stays a table.
    """
    # One row per run and stream first: the map below holds at most the three streams.
    per_stream = events.groupBy("run_id", "source").agg(
        F.count(F.lit(1)).alias("received"),
        F.min("received_at_unix_ns").alias("_first"),
        F.max("received_at_unix_ns").alias("_last"),
    )
    span = per_stream.groupBy("run_id").agg(
        F.min("_first").alias("started_at_unix_ns"),
        F.max("_last").alias("ended_at_unix_ns"),
        F.map_from_entries(F.collect_list(F.struct("source", "received"))).alias(
            "received_events"
        ),
    )
    covered = quality.coverage(events.where(F.col("symbol").isNotNull())).groupBy(
        "run_id", "component"
    ).agg(F.count(F.lit(1)).alias("symbols"))
    seen = _per_stream(covered, "component", "symbols", "symbols_seen")
    turns = effects.groupBy("run_id").agg(
        F.coalesce(F.max(F.col("event_type") == "streams_ready"), F.lit(False)).alias("streams_ready"),
        (
            F.min_by("message", F.when(F.col("fatal_reason").isNotNull(), F.col("event_id")))
            if "message" in effects.columns
            else F.lit(None).cast("string")
        ).alias("fatal_error"),
    )
    readiness = _first_events(events, configured)
    verdict = quality.run_summary(effects, require_ready=require_ready)
    table = (
        span.join(verdict, "run_id", "left")
        .join(seen, "run_id", "left")
        .join(turns, "run_id", "left")
        .join(readiness, "run_id", "left")
    )
    if parts is not None:
        written = parts.groupBy("run_id", "source").agg(
            F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files")
        )
        table = table.join(_per_stream(written, "source", "rows", "rows_written"), "run_id",
                           "left").join(
            _per_stream(written, "source", "files", "files_written"), "run_id", "left")
    shown = redacted_settings(settings or {}, secret_names)
    configuration = F.create_map(
        *[F.lit(item) for pair in sorted(shown.items()) for item in pair]
    ).cast("map<string,string>")
    built = table.withColumns(
        {
            "schema_version": F.lit(schemas.SCHEMA_VERSION).cast("bigint"),
            "engine_version": F.lit(schemas.ENGINE_VERSION),
            "streams_ready": F.coalesce("streams_ready", F.lit(False)),
            "first_events_seen": F.create_map(
                *(
                    x
                    for name in COMPONENTS
                    for x in (F.lit(name), F.coalesce(F.col(f"_seen_{name}"), F.lit(False)))
                )
            ),
            "status": F.coalesce("status", F.lit("failed")),
            "stop_reason": F.when(F.col("status").isNull(), quality.NOT_READY).otherwise(
                F.col("stop_reason")
            ),
            "clean_shutdown": F.coalesce(F.col("status") != "failed", F.lit(False)),
            "degraded_reasons": F.coalesce("degraded_reasons", F.array().cast("array<string>")),
            "configuration": configuration,
            "connection_epochs": F.create_map(
                F.lit("data"), F.col("epoch_data").cast("bigint"),
                F.lit("tbt"), F.col("epoch_tbt").cast("bigint"),
            ),
        }
    )
    return built.select(
        *[name for name in schemas.MANIFESTS.fieldNames() if name in built.columns]
    )


def write_manifests(rows: DataFrame, root: str) -> None:
    """Store manifests as one JSON object per run below ``_runs``.

    A run that has a manifest keeps it: writing the run again adds nothing.
    """
    spark = rows.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_runs")
    if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        rows = rows.join(lake.scan_manifests(spark, root).select("run_id"), "run_id", "left_anti")
    (
        rows.withColumn("run", F.col("run_id"))
        .repartition("run")
        .write.mode("append")
        .option("maxRecordsPerFile", 1)
        .partitionBy("run")
        .json(f"{root.rstrip('/')}/_runs")
    )


def write_marker(spark: SparkSession, root: str, run_id: str, status: str) -> str:
    """Create the completion marker of one run; fails if the run already has one."""
    known = lake.scan_markers(spark, root).where(F.col("run_id") == run_id).first()
    if known is not None:
        raise FileExistsError(f"run {run_id} already carries {known['marker']}")
    return place_marker(spark, root, run_id, status)


def place_marker(spark: SparkSession, root: str, run_id: str, status: str) -> str:
    """Create a marker file beside the run's manifest, whatever other markers there are."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{root.rstrip('/')}/_runs/run={run_id}/{dict(lake.MARKERS)[status]}")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.create(path, False).close()
    return path.toString()
