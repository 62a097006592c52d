"""Reading what a lake holds: recorded parts, manifests, receipts and file inventories."""

from __future__ import annotations

import json
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas

UNFINISHED = ".inprogress"
# Verdicts of a run and the marker each leaves behind.
MARKERS = [("complete", "_SUCCESS"), ("degraded", "_DEGRADED"), ("failed", "_FAILED")]
MARKER_NAMES = [marker for _, marker in MARKERS]
OWNER = "_owner"  # Note in a stream's folder; readers of Parquet pass over it.


def stream_path(root: str, stream: str) -> str:
    return f"{root.rstrip('/')}/{schemas.STREAM_DIRECTORIES[stream]}"


def on_files(spark: SparkSession, name: str):
    """The file system that holds a path, and the path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def owner(spark: SparkSession, folder: str) -> dict | None:
    """Which query writes a folder: its ``checkpoint``, and whether ``by_batch``; None if unknown."""
    files, path = on_files(spark, f"{folder}/{OWNER}")
    if not files.exists(path):
        return None
    note = files.open(path)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(note, "UTF-8"))
    finally:
        note.close()


def claim(spark: SparkSession, folder: str, checkpoint: str, by_batch: bool) -> None:
    """Take a folder for the query with this checkpoint; raise if it is another's.

    The note is created only if it is not there yet, so of two queries started together one fails.
    A folder that was written before there were notes belongs to the query that has a checkpoint.
    """
    files, path = on_files(spark, f"{folder}/{OWNER}")
    known = owner(spark, folder)
    if known is None:
        begun, _ = on_files(spark, checkpoint)
        offsets = on_files(spark, f"{checkpoint}/offsets")[1]
        if files.exists(path.getParent()) and not begun.exists(offsets):
            raise ValueError(f"{folder} is from a query with another checkpoint")
        note = json.dumps({"checkpoint": checkpoint, "by_batch": by_batch})
        try:
            out = files.create(path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" not in str(error.java_exception):
                raise
        else:
            out.write(bytearray(note, "utf-8"))
            out.close()
            return
        known = owner(spark, folder)
    if known["checkpoint"] != checkpoint:
        raise ValueError(f"{folder} is from a query with another checkpoint")


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    """Number of the last batch that a query has finished; -1 before the first."""
    files, path = on_files(spark, f"{checkpoint}/commits")
    if not files.exists(path):
        return -1
    names = [entry.getPath().getName() for entry in files.listStatus(path)]
    return max((int(name) for name in names if name.isdigit()), default=-1)


def committed(rows: DataFrame, folder: str) -> DataFrame:
    """Rows of finished batches only, where a query writes the folder batch by batch.

    Such a query writes several folders; a batch counts in all of them or in none, as its number is
    committed after the last is written. Batches prune directories.
    """
    known = owner(rows.sparkSession, folder)
    if known is None or not known["by_batch"]:
        return rows
    if "batch" not in rows.columns:  # Nothing but the note is there yet.
        return rows
    return rows.where(F.col("batch") <= last_commit(rows.sparkSession, known["checkpoint"]))


def scan_parts(
    spark: SparkSession, root: str, stream: str, schema: T.StructType | None = None
) -> DataFrame:
    """A stream of this lake, partitioned by ``trading_date``; dates prune directories.

    Of a folder written batch by batch only finished batches are seen, with their ``batch``.
    """
    folder = stream_path(root, stream)
    return committed(spark.read.schema(schema or schemas.STREAMS[stream]).parquet(folder), folder)


def scan_control(spark: SparkSession, root: str) -> DataFrame:
    """Control rows of all producers: lifecycle, depth, live health; those that are there."""
    names = schemas.CONTROL_EVENTS.fieldNames()
    found = []
    for stream in schemas.CONTROL_STREAMS:
        files, path = on_files(spark, stream_path(root, stream))
        if files.exists(path):
            found.append(scan_parts(spark, root, stream).select(*names))
    if not found:
        return spark.createDataFrame([], schemas.CONTROL_EVENTS)
    return reduce(DataFrame.unionByName, found)


def scan_dated_parts(spark: SparkSession, root: str, stream: str, dates: str = "*") -> DataFrame:
    """A stream recorded as ``YYYYMMDD/<stream>/part-*.parquet``; ``dates`` is a glob.

    The date column is stored in these files. Unfinished dot-files are not listed by Spark.
    """
    directory = schemas.STREAM_DIRECTORIES[stream]
    return spark.read.schema(schemas.STREAMS[stream]).parquet(
        f"{root.rstrip('/')}/{dates}/{directory}"
    )


def scan_manifests(spark: SparkSession, root: str) -> DataFrame:
    """Run manifests, one JSON object per file below ``_runs/<run>/``.

    The underscore folder is reached because it is named as the root of the read.
    """
    return (
        spark.read.schema(schemas.MANIFESTS)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(f"{root.rstrip('/')}/_runs")
    )


def scan_markers(spark: SparkSession, root: str) -> DataFrame:
    """Completion markers as they lie beside the manifests: ``run_id, marker``.

    Marker names begin like hidden files, which every reader passes over, so the file system is
    asked for them by one pattern. The driver holds a name per run that ended, as many as there
    were starts of the recorder; no file is opened.
    """
    files, path = on_files(spark, f"{root.rstrip('/')}/_runs/run=*/_*")
    found = [entry.getPath() for entry in files.globStatus(path) or []]
    rows = [
        (unquote(place.getParent().getName().split("=", 1)[1]), place.getName())
        for place in found
        if place.getName() in MARKER_NAMES
    ]
    return spark.createDataFrame(rows, "run_id string, marker string")


def scan_runs(spark: SparkSession, root: str) -> DataFrame:
    """Every run that left a manifest or a marker, and the status that its markers prove.

    A run without a marker did not end: ``unfinished``, whatever its manifest says. One with more
    than one marker is ``ambiguous``; one whose marker and manifest disagree is as well.
    """
    status = F.when(F.lit(False), F.lit(""))
    for name, marker in MARKERS:
        status = status.when(F.col("_marker") == marker, F.lit(name))
    proofs = scan_markers(spark, root).groupBy("run_id").agg(
        F.count(F.lit(1)).alias("_markers"), F.min("marker").alias("_marker")
    )
    return (
        scan_manifests(spark, root)
        .withColumnRenamed("status", "_said")
        .join(proofs, "run_id", "full_outer")
        .withColumn("_proved", status)
        .withColumn(
            "status",
            F.when(F.col("_markers").isNull(), "unfinished")
            .when((F.col("_markers") > 1) | (F.col("_said") != F.col("_proved")), "ambiguous")
            .otherwise(F.col("_proved")),
        )
        .drop("_said", "_proved", "_marker", "_markers")
    )


def scan_receipts(spark: SparkSession, root: str) -> DataFrame:
    """Upload receipts; an unreadable receipt is no receipt."""
    schema = T.StructType(
        schemas.RECEIPTS.fields + [T.StructField("_broken", T.StringType(), True)]
    )
    return (
        spark.read.schema(schema)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_broken")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(f"{root.rstrip('/')}/_uploads")
        .where(F.col("_broken").isNull() & F.col("trading_date").isNotNull())
        .drop("_broken")
    )


def plain_path(path: Column) -> Column:
    """File URI with a single slash after a bare scheme, as all readers can agree on."""
    return F.regexp_replace(path, "^(file|hdfs):/+", "$1:/")


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, whatever scheme either is written with."""
    inside = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    return F.element_at(F.split(path, f"/{_quoted(inside)}/", 2), -1)


def _quoted(text: str) -> str:
    return "".join(f"\\{char}" if char in r"\[](){}.*+?^$|-" else char for char in text)


def file_inventory(spark: SparkSession, root: str, *, glob: str = "*") -> DataFrame:
    """Path, size and modification time of all files below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return files.select(
        plain_path(F.col("path")).alias("path"),
        relative_path(F.col("path"), root).alias("relative_path"),
        F.col("length").alias("size_bytes"),
        F.unix_millis("modificationTime").alias("modified_ms"),
    )


def file_digests(spark: SparkSession, root: str, *, glob: str = "*") -> DataFrame:
    """SHA-256 of each file below ``root``.

    A file is read as one value, so this is for parts, whose size rotation bounds; compare
    whole tables with ``archive.table_digest`` instead.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(root)
    )
    return files.select(
        plain_path(F.col("path")).alias("path"), F.sha2("content", 256).alias("sha256")
    )


def part_stats(parts: DataFrame) -> DataFrame:
    """Rows, id range, time range and size of every file a scan reads (digest left out).

    Must be applied to the scan itself: the file name is hidden metadata of its rows.
    """
    per_file = parts.groupBy(
        plain_path(F.col("_metadata.file_path")).alias("path"),
        "source",
        F.col("_metadata.file_size").alias("bytes"),
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("event_id").alias("min_event_id"),
        F.max("event_id").alias("max_event_id"),
        F.min("received_at_unix_ns").alias("min_received_at_unix_ns"),
        F.max("received_at_unix_ns").alias("max_received_at_unix_ns"),
    )


def unfinished_parts(spark: SparkSession, root: str) -> list[str]:
    """Unfinished files at any depth below ``root``; none if it does not exist.

    Spark's readers skip dot-files, so the file system is walked. Only unfinished names are held:
    at most one for every writer that was at work.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    found: list[str] = []
    files = system.listFiles(folder, True)
    while files.hasNext():
        path = files.next().getPath()
        if path.getName().endswith(UNFINISHED):
            found.append(path.toString())
    return sorted(found)
