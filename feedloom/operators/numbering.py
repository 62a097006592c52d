"""Contiguous numbers in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import shared_root

_ROW_BITS = 33  # Width of the per-partition counter in monotonically_increasing_id.


def assign_ids(
    rows: DataFrame, order: Sequence[str | Column], name: str = "event_id", first: int = 1
) -> DataFrame:
    """Number rows ``first, first + 1, ...`` in ``order``, which must be unique.

    Rows are range-partitioned and sorted; because the order is unique, equal leading values do
    not pin a hot group to one partition. The sorted rows are checkpointed, so that counting the
    partitions and numbering them see the very same layout even if executors are lost between
    the two. Only one count per partition is ordered globally.
    """
    shared_root(rows.sparkSession)
    laid_out = (
        rows.orderBy(*order)
        .withColumns(
            {"_partition": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}
        )
        .checkpoint()
    )
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy("_partition")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One offset per partition: small by construction, whatever the data.
    return (
        laid_out.join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + within + F.lit(first))
        .drop("_partition", "_row", "_offset")
    )
