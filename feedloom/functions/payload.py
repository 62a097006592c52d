"""Reading JSON message payloads without losing or guessing fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fields(raw: Column) -> Column:
    """Top-level fields as a text map; null when the payload is not an object.

    A map keeps ``""`` apart from null and compares keys case-sensitively, which struct
    columns do not. Parse once into a column and look fields up there.
    """
    return F.from_json(raw, "map<string,string>")


def first_present(message: Column, *keys: str) -> Column:
    """Text of the first key that is present and not null.

    Text is chosen before any cast: an empty string on an early key wins and becomes null.
    """
    return F.coalesce(*[message[key] for key in keys])


def present_names(message: Column) -> Column:
    """Sorted names of all keys, null-valued ones included."""
    return F.array_sort(F.array_distinct(F.map_keys(message)))


def canonical_json(raw: Column) -> Column:
    """Compact JSON with keys sorted at every level; unparsable text is returned untouched."""
    return F.coalesce(F.to_json(F.try_parse_json(raw)), raw)


def type_label(message: Column, key: str = "type") -> Column:
    """Text of the message type: absent or empty is null, an explicit null is ``None``."""
    value = message[key]
    return F.when(F.map_contains_key(message, key) & value.isNull(), F.lit("None")).otherwise(
        F.when(value != "", value)
    )


def is_server_error(message: Column) -> Column:
    """Object whose ``s`` or ``type`` says ``error`` in any case."""
    return F.coalesce(F.lower(message["s"]) == "error", F.lit(False)) | F.coalesce(
        F.lower(message["type"]) == "error", F.lit(False)
    )
