"""Running values per key that stay parallel when one key holds most of the rows.

A window partitioned by a hot key alone would sort that key in a single task. Here every key is
cut into chunks of the order column (an id that is unique per run, so a chunk's size is bounded
by ``chunk_rows``). Rows are shuffled once by key and chunk; each chunk is reduced, map-side
first, to one summary row; the summaries, one per key and chunk, are scanned in order and their
result is joined back on the very keys the rows are already partitioned by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_ROWS = 1 << 20
_CHUNK = "_chunk"
_KEY = "_key"


@dataclass(frozen=True)
class Running:
    """One running value: the nearest non-null ``value``, its ``max``, ``min`` or its ``sum``."""

    value: Column
    how: str = "nearest"

    def __post_init__(self) -> None:
        if self.how not in ("nearest", "max", "min", "sum"):
            raise ValueError(f"unknown running value: {self.how}")

    def over(self, column: str, window) -> Column:
        value = F.col(column)
        if self.how == "nearest":
            return F.last(value, ignorenulls=True).over(window)
        return {"max": F.max, "min": F.min, "sum": F.sum}[self.how](value).over(window)

    def summary(
        self, column: str, order: str, forward: bool, fields: Sequence[str] = ()
    ) -> Column:
        """Aggregate of a chunk. A struct is picked field by field.

        Aggregates over numbers are hashed; one over a struct would sort all rows first.
        """
        value = F.col(column)
        if self.how == "nearest":
            pick, end = (F.max_by, F.max) if forward else (F.min_by, F.min)
            place = F.when(value.isNotNull(), F.col(order))
            if not fields:
                return pick(value, place)
            picked = F.struct(*[pick(value[name], place).alias(name) for name in fields])
            return F.when(end(place).isNotNull(), picked)
        return {"max": F.max, "min": F.min, "sum": F.sum}[self.how](value)

    def combine(self, carried: Column, local: Column) -> Column:
        if self.how == "nearest":
            return F.coalesce(local, carried)
        if self.how == "max":
            return F.greatest(local, carried)
        if self.how == "min":
            return F.least(local, carried)
        return F.when(local.isNull() & carried.isNull(), None).otherwise(
            F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
        )


def running(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Mapping[str, Running],
    *,
    forward: bool = True,
    seed: DataFrame | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add, per row, each running value over the rows of the same key strictly before it.

    ``forward=False`` looks at the rows strictly after it instead. Rows whose key is null form a
    key of their own. ``order`` must not be null and must be unique within a key. ``seed`` holds one row per key with
    columns named like ``values``: what is known before the first row (streaming state).
    """
    keys = list(keys)
    inputs = {f"_in_{name}": spec for name, spec in values.items()}
    cut = F.call_function("div", F.col(order), F.lit(chunk_rows))
    # A struct is never null itself: it groups and joins rows of a null key like any others.
    key = F.struct(*keys)
    tagged = rows.withColumns(
        {_KEY: key, _CHUNK: cut, **{f"_in_{name}": spec.value for name, spec in values.items()}}
    )

    chunk_order = F.col(_CHUNK) if forward else F.col(_CHUNK).desc()
    earlier_chunks = (
        Window.partitionBy(_KEY).orderBy(chunk_order).rowsBetween(Window.unboundedPreceding, -1)
    )
    fields = {
        name: tagged.schema[name].dataType.fieldNames()
        for name in inputs
        if isinstance(tagged.schema[name].dataType, T.StructType)
    }
    summaries = tagged.groupBy(_KEY, _CHUNK).agg(
        *[
            spec.summary(name, order, forward, fields.get(name, ())).alias(name)
            for name, spec in inputs.items()
        ]
    )
    carried = summaries.select(
        _KEY,
        _CHUNK,
        *[
            spec.over(f"_in_{name}", earlier_chunks).alias(f"_carry_{name}")
            for name, spec in values.items()
        ],
    )
    if seed is not None:
        seeds = seed.select(key.alias(_KEY), *[F.col(name).alias(f"_seed_{name}") for name in values])
        carried = carried.join(seeds, _KEY, "left").select(
            _KEY,
            _CHUNK,
            *[
                spec.combine(F.col(f"_seed_{name}"), F.col(f"_carry_{name}")).alias(
                    f"_carry_{name}"
                )
                for name, spec in values.items()
            ],
        )

    row_order = F.col(order) if forward else F.col(order).desc()
    earlier_rows = (
        Window.partitionBy(_KEY, _CHUNK)
        .orderBy(row_order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = tagged.select(
        *[column for column in tagged.columns if column not in inputs],
        *[
            spec.over(f"_in_{name}", earlier_rows).alias(f"_local_{name}")
            for name, spec in values.items()
        ],
    )
    joined = local.join(carried, [_KEY, _CHUNK], "left")
    return joined.select(
        *rows.columns,
        *[
            spec.combine(F.col(f"_carry_{name}"), F.col(f"_local_{name}")).alias(name)
            for name, spec in values.items()
        ],
    )
