"""Periodic runs of words: long stretches that repeat with a period, found tile by tile.

Periods are cut into octaves. In each octave a document has boundaries at equal steps, no longer
than the fewest matches (positions i with ``w[i] == w[i + period]``) of a run, so every run's
matches hold a boundary. A tile is what lies a step to either side of a boundary, and the longest
period more. Tiles are exploded, dealt out, and solved alone: Z-functions of what follows and of
what precedes the boundary say, for all periods of the octave at once, how far the matches
around it go on, as far as the tile reaches. Fragments are shuffled by document and period and
stitched where they touch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import free_name, kept_table, texts

#: A run has at least this many words, and at least so many times its period.
LEAST_LENGTH, LEAST_TIMES = 24, 3
FIRST_TOP = 8  # Octave 0 holds the periods below; each later one ends at twice its beginning.


def octave(k: int) -> tuple[int, int, int]:
    """Smallest period, the period after the largest, and the step between boundaries."""
    if k == 0:
        return 1, FIRST_TOP, LEAST_LENGTH - FIRST_TOP
    low = FIRST_TOP << (k - 1)
    return low, 2 * low, (LEAST_TIMES - 1) * low


def suspects(words: np.ndarray) -> list[tuple[int, int]]:
    """(octave, boundary) of the tiles that can hold a piece of a run.

    A run's piece in a tile has a step of matches or more, hence half a step of them on one side of
    the boundary: the words there occur again one period on. That is looked up by hashes of as
    many words. Hashes of equal words are equal, so no tile of a run is missed.
    """
    n, out = len(words), []
    if n < LEAST_LENGTH:
        return out
    with np.errstate(over="ignore"):
        grams = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        size = 1
        k = 0
        while LEAST_TIMES * octave(k)[0] <= n:
            low, top, step = octave(k)
            while size < step // 2:
                grams = (grams[:-size] ^ (grams[:-size] >> np.uint64(29))) * np.uint64(
                    0xBF58476D1CE4E5B9 + 2 * size
                ) + grams[size:]
                size *= 2
            if len(grams) <= low:
                break
            keys = np.zeros(n + top, np.uint64)
            keys[: len(grams)] = grams | np.uint64(1)
            later = np.lib.stride_tricks.sliding_window_view(keys, top - low)
            places = np.arange(0, n, step)
            ahead = places[places < len(grams)]
            behind = places[(places >= size) & (places - size < len(grams))]
            found = np.union1d(
                ahead[(later[ahead + low] == keys[ahead][:, None]).any(1)],
                behind[(later[behind - size + low] == keys[behind - size][:, None]).any(1)],
            )
            out += [(k, int(c)) for c in found]
            k += 1
    return out


def z_values(s: list, upto: int) -> list[int]:
    """For each place below ``upto``: how many words from there equal the first words of ``s``."""
    n = len(s)
    z = [0] * min(n, upto)
    left = right = 0
    for i in range(1, len(z)):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def fragments(words: list[int], at: int, k: int, start: int) -> list[tuple[int, int, int]]:
    """(period, first match, match after the last) around place ``at`` of a tile of octave ``k``.

    ``start`` is the tile's place in the document. A period whose stretch is made of shorter equal
    parts is left out: it is no smallest period, in the tile or in the document.
    """
    low, top, step = octave(k)
    right, left = words[at:], words[:at][::-1]
    top = min(top, len(right))
    if top <= low:
        return []
    ahead = np.array(z_values(right, top), np.int64)
    both = [*left, -1, *words[: at + top][::-1]]
    z = z_values(both, len(both))
    # Place top - q of the reversed second part is where the words one period q on begin.
    behind = np.array([0, *z[len(left) + 1 + top - 1 : len(left) + 1 : -1]], np.int64)
    periods = np.flatnonzero((ahead > 0) & (ahead + behind >= step))
    roots: list[tuple[int, int, int]] = []
    out = []
    for q in periods.tolist():
        f, b = int(ahead[q]), int(behind[q])
        near = min(f, step)
        if any(q % p == 0 and b <= back and q + near <= p + fore for p, back, fore in roots):
            continue
        roots.append((q, b, f))
        whole = near + b >= max(LEAST_LENGTH - q, (LEAST_TIMES - 1) * q)
        if q >= low and (whole or near == step or b == step):
            out.append((q, start + at - b, start + at + near))
    return out


def collapsed(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """What is left when of each run only the first period stays."""
    change = np.zeros(len(words) + 1, np.int64)
    for run in runs:
        change[run["start"] + run["period"]] += 1
        change[run["start"] + run["length"]] -= 1
    keep = np.cumsum(change[:-1]) == 0
    return [word for word, kept in zip(words, keep) if kept]


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, ids, tiles, joined = [], [], [], []
        for raw in texts(batch["text"]):
            words = raw.split()
            index: dict[bytes, int] = {}
            own = [index.setdefault(word, len(index)) for word in words]
            found = suspects(np.array(own, np.int64))
            counts.append(len(words))
            joined.append(b" ".join(words))
            ids.append(own if found else None)
            tiles.append([{"octave": k, "place": c} for k, c in found])
        yield pa.RecordBatch.from_arrays(
            [
                batch["row"],
                pa.array(counts, pa.int64()),
                pa.array(joined, pa.binary()),
                pa.array(ids, pa.list_(pa.int32())),
                pa.array(tiles, pa.list_(pa.struct([("octave", pa.int32()), ("place", pa.int64())]))),
            ],
            ["row", "n_words", "text", "ids", "tiles"],
        )


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, out = [], []
        for doc, k, place, words in zip(
            *(batch[c].to_pylist() for c in ("doc", "octave", "place", "words"))
        ):
            step = octave(k)[2]
            found = fragments(words, min(step, place), k, max(0, place - step))
            docs += [doc] * len(found)
            out += found
        columns = np.array(out, np.int64).reshape(-1, 3)
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), *(pa.array(columns[:, c]) for c in range(3))],
            ["doc", "period", "first", "last"],
        )


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [
            b" ".join(collapsed(raw.split(b" "), runs)) if runs else raw
            for raw, runs in zip(texts(batch["text"]), batch["runs"].to_pylist())
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["n_words"], batch["runs"], pa.array(kept, pa.binary())],
            ["row", "n_words", "runs", "text"],
        )


RUNS = "array<struct<start: bigint, period: bigint, length: bigint>>"


def stitched(pieces: DataFrame) -> DataFrame:
    """Runs of each ``doc``: pieces (doc, period, first, last) that touch are one; by start, period."""
    ways = Window.partitionBy("doc", "period").orderBy("first", "last")
    before = F.max("last").over(ways.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col("first") > before)).cast("long")
    islands = pieces.withColumn("opens", opens).withColumn(
        "island", F.sum("opens").over(ways.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        islands.groupBy("doc", "period", "island")
        .agg(F.min("first").alias("start"), F.max("last").alias("last"))
        .select("doc", "period", "start", (F.col("last") - F.col("start") + F.col("period")).alias("length"))
        .where(
            (F.col("length") >= LEAST_LENGTH) & (F.col("length") >= LEAST_TIMES * F.col("period"))
        )
        # One stretch has one smallest period.
        .groupBy("doc", "start", "length")
        .agg(F.min("period").alias("period"))
        .groupBy("doc")
        .agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    )


def periodic_runs(
    docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text"
) -> tuple[DataFrame, str]:
    """The columns ``keep`` and a struct: n_words, runs (start, period, length), text without repeats.

    Returns the frame and the struct's name (``periodic``, with underscores where that is taken).
    Words are what ASCII white space parts, numbered from 0; the text is the words that are left,
    joined by one space. Texts are read whole; a null or empty text has no words, no runs and an
    empty text. Rows are numbered when they are first written, so repeated rows and repeated or
    null ids each have their own result; other columns are left behind; an empty table gives none.

    Only tiles that may hold a piece of a run are exploded and shuffled, by document, octave and
    place: a long document's tiles go to many tasks. Fragments are a few numbers each. What comes
    together in one task is a tile, the fragments of one period of one document, or one document.
    """
    name = free_name(docs.select(*keep), "periodic")
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in keep)
    told = docs.select(
        F.struct(*keep).alias("row"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(
        _places,
        f"row struct<{kinds}>, n_words long, text binary, ids array<int>, "
        "tiles array<struct<octave: int, place: bigint>>",
    )
    found = kept_table(
        told.withColumn("doc", F.monotonically_increasing_id())
        .withColumn("text", F.col("text").cast("string")),
        "periods",
    )
    suspect = F.size("tiles") > 0
    steps = F.array(*(F.lit(octave(k)[2]).cast("long") for k in range(40)))
    tops = F.array(*(F.lit(octave(k)[1]).cast("long") for k in range(40)))
    step, top = F.get(steps, F.col("tile.octave")), F.get(tops, F.col("tile.octave"))
    begin = F.greatest(F.col("tile.place") - step, F.lit(0))
    tiles = (
        found.where(suspect)
        .select("doc", "ids", F.explode("tiles").alias("tile"))
        .select(
            "doc",
            "tile.octave",
            "tile.place",
            F.slice(
                "ids",
                (begin + 1).cast("int"),
                (F.col("tile.place") - begin + step + top).cast("int"),
            ).alias("words"),
        )
        .repartition("doc", "octave", "place")
    )
    pieces = tiles.mapInArrow(_solve, "doc long, period long, first long, last long")
    runs = kept_table(stitched(pieces), "runs")
    none = F.array().cast(RUNS)
    with_runs = (
        found.where(suspect)
        .join(runs, "doc", "left")
        .select("row", "n_words", F.coalesce("runs", none).alias("runs"), "text")
        .mapInArrow(_collapse, f"row struct<{kinds}>, n_words long, runs {RUNS}, text binary")
        .select("row", F.struct("n_words", "runs", F.col("text").cast("string").alias("text")).alias(name))
    )
    without = found.where(~suspect).select(
        "row", F.struct("n_words", none.alias("runs"), "text").alias(name)
    )
    return without.unionByName(with_runs).select("row.*", name), name
