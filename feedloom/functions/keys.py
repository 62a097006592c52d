"""Destination keys of archived dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: suffix of an archived date.
ARCHIVE_SUFFIX = "_trade_ticks.tar.gz"


def without_bucket(bucket: Column, key: Column) -> Column:
    """Drop leading slashes, then one accidental copy of the bucket name."""
    plain = F.ltrim(key, F.lit("/"))
    prefix = F.concat(bucket, F.lit("/"))
    return F.when(
        (bucket != "") & F.startswith(plain, prefix), F.substr(plain, F.length(prefix) + 1)
    ).otherwise(plain)


def object_key(bucket: Column, prefix: Column, date: Column) -> Column:
    """``prefix/date/date_suffix`` without empty pieces or doubled slashes at the joints."""
    pieces = F.transform(
        F.array(prefix, date, F.concat(date, F.lit(ARCHIVE_SUFFIX))),
        lambda piece: F.trim(piece, F.lit("/")),
    )
    return without_bucket(bucket, F.array_join(F.filter(pieces, lambda piece: piece != ""), "/"))
