"""Digests that merge: built by partial aggregation, whatever the number of rows or files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_LANES = 8


def multiset_digest(text: Column) -> Column:
    """Order-free digest of a bag of texts, as an aggregate.

    Each text is hashed with SHA-256 and the eight 32-bit words are summed separately; the
    count and the sums are hashed again. Unlike sorting and concatenating all texts it holds
    nine numbers per group, and unlike XOR it sees repeated texts.
    """
    digest = F.sha2(text, 256)
    words = [
        F.conv(F.substring(digest, 1 + 8 * lane, 8), 16, 10).cast("bigint")
        for lane in range(_LANES)
    ]
    totals = [F.sum(word.cast("decimal(20,0)")).cast("string") for word in words]
    return F.sha2(F.concat_ws(":", F.count(text).cast("string"), *totals), 256)


def row_digest(columns: list[str]) -> list[Column]:
    """Aggregates that compare two tables row by row: count, hash sum and hash XOR."""
    row = F.xxhash64(*columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(row).alias("hash_xor"),
    ]


def all_true(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
