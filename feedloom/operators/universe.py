"""The configured symbols: parsing, connection groups, membership and what never arrived.

Lookups broadcast the universe when it is counted to be small, as it is by design; a larger one
gets a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.operators.joins import sized_broadcast

# Symbols per depth connection and connections per run.
SYMBOLS_PER_CONNECTION = 5
MAX_CONNECTIONS = 3

# The whitespace trimmed from a listed symbol.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(_SPACES))


def parse_symbols(raw: Column) -> Column:
    """Symbols of a comma or JSON list: trimmed, no empties, first spelling of each, in order.

    Row-local: ranking by upper-cased name then position brings repeats next to each other, so
    a list of n symbols costs n log n and no shuffle. Malformed JSON is null.
    """
    text = _trimmed(raw)
    listed = F.when(
        text.startswith("["), F.from_json(text, "array<string>")
    ).otherwise(F.split(text, ","))
    items = F.transform(listed, _trimmed)
    named = F.transform(
        F.filter(items, lambda item: item != ""),
        lambda item, place: F.struct(
            F.upper(item).alias("folded"), place.alias("place"), item.alias("symbol")
        ),
    )
    ranked = F.sort_array(named)
    previous = F.concat(F.array(F.lit(None).cast("string")), ranked["folded"])
    firsts = F.filter(
        F.zip_with(
            ranked,
            previous,
            lambda item, before: F.struct(
                item["place"].alias("place"),
                item["symbol"].alias("symbol"),
                (before.isNull() | (item["folded"] != before)).alias("first"),
            ),
        ),
        lambda item: item["symbol"].isNotNull() & item["first"],
    )
    return F.sort_array(firsts)["symbol"]


def connection_key(position: Column, per_connection: int = SYMBOLS_PER_CONNECTION) -> Column:
    """Depth connection of the symbol at a zero-based position of its list."""
    group = F.call_function("div", position, F.lit(per_connection)) + 1
    return F.concat(F.lit("tbt:"), group.cast("string"))


def universe(
    lists: DataFrame,
    raw: str,
    keys: Iterable[str],
    *,
    per_connection: int = SYMBOLS_PER_CONNECTION,
    max_symbols: int | None = SYMBOLS_PER_CONNECTION * MAX_CONNECTIONS,
) -> DataFrame:
    """One row per configured symbol: keys, position, symbol, its fold and its connection.

    A list that is malformed, empty or longer than ``max_symbols`` is an error; None lifts that.
    """
    parsed = lists.select(*keys, parse_symbols(F.col(raw)).alias("_symbols"))
    if max_symbols is not None:
        size = F.coalesce(F.size("_symbols"), F.lit(-1))
        problem = (
            F.when(size < 0, "the symbol list is not valid JSON")
            .when(size == 0, "the symbol list has no usable symbols")
            .otherwise(f"more than {max_symbols} symbols")
        )
        parsed = parsed.where(
            F.when((size > 0) & (size <= max_symbols), F.lit(True)).otherwise(
                F.raise_error(problem).cast("boolean")
            )
        )
    return parsed.select(*keys, F.posexplode("_symbols").alias("position", "symbol")).select(
        *keys,
        "position",
        "symbol",
        F.upper("symbol").alias("symbol_upper"),
        connection_key(F.col("position"), per_connection).alias("connection_key"),
    )


def with_membership(
    rows: DataFrame, configured: DataFrame, symbol: str = "symbol", keys: Iterable[str] = ()
) -> DataFrame:
    """Add ``connection_key`` (null when the symbol is not configured), ignoring case."""
    keys = list(keys)
    lookup = configured.select(
        *[F.col(key).alias(f"_u_{key}") for key in keys],
        F.col("symbol_upper").alias("_u_symbol"),
        "connection_key",
    )
    match = F.upper(F.col(symbol)) == F.col("_u_symbol")
    for key in keys:
        match = match & (F.col(key) == F.col(f"_u_{key}"))
    dropped = ["_u_symbol", *[f"_u_{key}" for key in keys]]
    return rows.join(sized_broadcast(lookup), match, "left").drop(*dropped)


def members(rows: DataFrame, configured: DataFrame, symbol: str = "symbol") -> DataFrame:
    """Rows of configured symbols only."""
    return rows.join(
        sized_broadcast(configured.select(F.col("symbol_upper").alias("_u_symbol"))),
        F.upper(F.col(symbol)) == F.col("_u_symbol"),
        "left_semi",
    )


def missing_symbols(
    configured: DataFrame, seen: DataFrame, keys: Iterable[str], components: Iterable[str]
) -> DataFrame:
    """Configured symbols without a row, per key (a run) and component.

    ``configured`` carries the keys; ``seen`` carries the keys, ``component`` and ``symbol``.
    The component list is expanded as an array, so nothing is cross-joined.
    """
    keys = list(keys)
    expected = configured.select(
        *keys,
        F.explode(F.array(*[F.lit(name) for name in components])).alias("component"),
        "symbol_upper",
    )
    arrived = seen.select(*keys, "component", F.upper("symbol").alias("symbol_upper")).distinct()
    return expected.join(arrived, [*keys, "component", "symbol_upper"], "left_anti")
