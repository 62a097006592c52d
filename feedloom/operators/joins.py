"""Broadcasting behind a check of the size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000


def sized_broadcast(side: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow side for broadcast if it is counted to be small, else leave it as it is.

    Without the hint, a side that is itself an aggregate has no size estimate, and the large
    side would be shuffled by the join key, hot keys and all, before AQE learns the truth. Left
    alone, a large side gets the sort-merge join, whose hot partitions AQE splits.
    """
    if side.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(side)
    return side
