"""Removing secrets from text and from JSON detail values."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "<redacted>"


def _longest_first(secrets: Iterable[str]) -> list[str]:
    return sorted({item for item in secrets if item}, key=lambda item: (-len(item), item))


def redact_text(text: Column, secrets: Iterable[str]) -> Column:
    """Replace every secret, longest first, so that no secret survives inside a longer one."""
    for secret in _longest_first(secrets):
        text = F.replace(text, F.lit(secret), F.lit(MARK))
    return text


# Stand-ins for the two escapes that would confuse splitting at quotes. Valid JSON text never
# holds these control characters, so the way back is exact.
_BACKSLASH, _QUOTE = "\x01", "\x02"
# A match right behind a backslash (or within the digits of \\uXXXX) starts inside an escape.
_NOT_IN_ESCAPE = r"(?<!\\(?:u.{0,3})?)"


def redact_details(details_json: Column, secrets: Iterable[str]) -> Column:
    """Redact string values at any depth of a JSON text; keys and numbers stay as they are."""

    def masked(text: str) -> str:
        return text.replace("\\\\", _BACKSLASH).replace('\\"', _QUOTE)

    quoted = [
        masked(json.dumps(secret, ensure_ascii=False)[1:-1]) for secret in _longest_first(secrets)
    ]

    def clean(value: Column) -> Column:
        for secret in quoted:
            value = F.regexp_replace(value, _NOT_IN_ESCAPE + _literal(secret), MARK)
        return value

    flat = F.replace(
        F.replace(details_json, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE)
    )
    # Split at quotes: pieces at odd places are strings, and a string before a colon is a key.
    pieces = F.split(flat, '"')
    placed = F.transform(pieces, lambda text, place: F.struct(text.alias("t"), place.alias("p")))
    following = F.concat(F.slice(pieces, F.lit(2), F.size(pieces)), F.array(F.lit("")))
    cleaned = F.zip_with(
        placed,
        following,
        lambda piece, after: F.when(
            (piece["p"] % 2 == 1) & ~F.startswith(F.ltrim(after), F.lit(":")), clean(piece["t"])
        ).otherwise(piece["t"]),
    )
    joined = F.array_join(cleaned, '"')
    return F.replace(
        F.replace(joined, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\")
    )


def _literal(text: str) -> str:
    return re.sub(r"([\\\[\](){}.*+?^$|/-])", r"\\\1", text)


def redacted_settings(settings: Mapping[str, str], secret_names: Iterable[str]) -> dict[str, str]:
    """Configuration as stored in a manifest: secret entries carry the mark only."""
    hidden = set(secret_names)
    return {key: MARK if key in hidden else str(value) for key, value in settings.items()}
