"""Lenient numeric coercion of message text, as column expressions.

All functions take text, so that a value's original spelling decides, not an earlier cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings the JVM parses as a double but that are not numbers here: type suffixes and hex.
_JVM_ONLY = r"[dDpPxX]|[0-9.][fF]\s*$"


def lenient_double(text: Column) -> Column:
    """Number or null; empty and malformed text is null, NaN and infinities are kept."""
    return F.when(text.rlike(_JVM_ONLY), F.lit(None).cast("double")).otherwise(
        text.try_cast("double")
    )


# More digits after the point than the decimal keeps; the cast would round them, not cut them.
_LONG_FRACTION = r"^(\s*[+-]?[0-9]*\.[0-9]{18})[0-9]+(\s*)$"


def _exact(text: Column) -> Column:
    cut = F.when(F.length(text) > 19, F.regexp_replace(text, _LONG_FRACTION, "$1$2")).otherwise(text)
    return cut.try_cast("decimal(38,18)")


def lenient_long(text: Column) -> Column:
    """Whole number, truncated towards zero ("12.7" is 12, "1e3" is 1000), or null.

    Plain integers are cast directly; the rest goes through decimal, because the direct cast
    refuses fractions and a double loses digits past 2**53.
    """
    return F.coalesce(text.try_cast("bigint"), _exact(text).try_cast("bigint"))


def lenient_sequence(text: Column) -> Column:
    """Unsigned 64-bit sequence number as ``decimal(20,0)``, truncated, or null."""
    exact = _exact(text)
    return F.when(exact >= 0, F.floor(exact).cast("decimal(20,0)"))


def truthy(text: Column) -> Column:
    """Truth of a JSON value held as text; absent is false."""
    return F.coalesce(~F.lower(text).isin("", "false", "0", "0.0", "null"), F.lit(False))


# What every spelling that only the JVM parses has in it; a side without it needs no element rule.
_JVM_SIGN = r"[0-9.][dDfF]|0[xX]"


def _whole(fast: Column, absent: Column) -> Column:
    """Every element was read. A failed one is null: then a search for a value cannot answer "no"."""
    return F.coalesce(~F.array_contains(fast, absent), F.lit(False))


# Both read a side by one array cast where that reads elements as their rules do: the cast runs as
# compiled code, a lambda does not, and almost every book is plain.


def double_levels(values: Column) -> Column:
    """Book levels as doubles; a missing or malformed element is 0.0."""
    zero = F.lit(0.0)
    fast = values.try_cast("array<double>")
    plain = ~F.array_join(values, " ", "").rlike(_JVM_SIGN)
    filled = F.transform(fast, lambda item: F.coalesce(item, zero))
    slow = F.transform(values, lambda item: F.coalesce(lenient_double(item), zero))
    return (
        F.when(plain & _whole(fast, F.lit(float("-inf"))), fast).when(plain, filled).otherwise(slow)
    )


def long_levels(values: Column) -> Column:
    """Book levels as longs; a missing or malformed element is 0.

    What the direct cast reads, the element rule reads alike, so no spelling is looked at.
    """
    zero = F.lit(0).cast("bigint")
    fast = values.try_cast("array<bigint>")
    slow = F.transform(values, lambda item: F.coalesce(lenient_long(item), zero))
    return F.when(_whole(fast, F.lit(-1).cast("bigint")), fast).otherwise(slow)


def level_count(values: Column) -> Column:
    """Number of levels; a null array has none."""
    return F.when(values.isNull(), F.lit(0)).otherwise(F.size(values))
