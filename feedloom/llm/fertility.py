"""Quality rules by tokeniser fertility.

Two public vocabularies measure every text: characters per token of each, the share of byte
fallbacks, and the entropy of the tokens. Per language, exact histograms over all texts give the
median and the quartiles of each measure; a text outside the band drawn from them is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import (
    TOKENIZERS,
    WordTable,
    encode_apart,
    free_name,
    kept_table,
    per_worker,
    rank_encoding,
    sentence_pieces,
    slices,
    texts,
    utf8,
)
from feedloom.operators.joins import sized_broadcast

BYTES_A_SLICE = 1 << 20
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"
#: Measures and how finely their histograms are kept.
MEASURES = {"chars_a_piece": 500, "chars_a_rank": 500, "fallback_share": 1000, "entropy": 500}
#: A band reaches this many quartile distances (p75 - p25) from the median, and never less than
#: this share of the median, or this absolute width. Outer points would lie inside the junk itself
#: where more than a few hundredths of a language are junk, so that they would let it pass.
REACH, LEAST_SHARE, LEAST_WIDTH = 4.0, 0.09, 0.05
MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50
COUNTS = (
    "n_words n_chars word_chars n_symbols n_dup_lines n_repeat_words n_pieces n_fallback n_ranks"
).split()
FIELDS = ", ".join([f"{c} long" for c in COUNTS] + ["entropy double"])


def _fallback_ids(sp) -> tuple[int, int]:
    found = [k for k in range(sp.get_piece_size()) if sp.is_byte(k)]
    return (min(found), max(found)) if found else (0, -1)


class Fertility:
    """Words of the worker's texts, each tokenised once by both vocabularies."""

    def __init__(self, folder: str):
        self.sp = sentence_pieces(folder)
        self.ranks = rank_encoding("byte_bpe_multi_50k.tiktoken", folder)
        [self.end] = self.ranks.encode_ordinary("\n")
        self.low, self.high = _fallback_ids(self.sp)
        self.table = WordTable(self._tokenise)
        self.n_ranks = np.zeros(0, np.int64)

    def _tokenise(self, words: list[bytes]):
        decoded = [utf8(word) for word in words]
        spaced = [" " + word for word in decoded]
        sizes = [len(ids) for ids in encode_apart(self.ranks, spaced, self.end)]
        self.n_ranks = np.concatenate(
            [self.n_ranks[: self.table.held], np.array(sizes, np.int64)]
        )
        return self.sp.encode(decoded, num_threads=1)

    def measure(self, raws: list[bytes]) -> dict[str, list]:
        split = [raw.split() for raw in raws]
        words = [word for own in split for word in own]
        ids = self.table.ids(words)
        flat, sizes = self.table.tokens(ids)
        ranks = self.n_ranks[ids]
        bounds = np.concatenate([[0], np.cumsum([len(own) for own in split])])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out: dict[str, list] = {c: [] for c in [*COUNTS, "entropy"]}
        for k, raw in enumerate(raws):
            first, last = bounds[k], bounds[k + 1]
            tokens = flat[ends[first] : ends[last]]
            counts = np.unique(tokens, return_counts=True)[1]
            share = counts / max(1, len(tokens))
            lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
            n_chars = len(utf8(raw))
            blank = len(raw) - len(raw.translate(None, BLANKS))
            for name, value in (
                ("n_words", last - first),
                ("n_chars", n_chars),
                ("word_chars", n_chars - blank),
                ("n_symbols", len(raw) - len(raw.translate(None, SYMBOLS))),
                ("n_dup_lines", len(lines) - len(set(lines))),
                ("n_repeat_words", repeated_words(ids[first:last])),
                ("n_pieces", len(tokens)),
                ("n_fallback", int(((tokens >= self.low) & (tokens <= self.high)).sum())),
                ("n_ranks", int(ranks[first:last].sum())),
                ("entropy", float(-(share * np.log2(share)).sum()) if len(tokens) else 0.0),
            ):
                out[name].append(value)
        return out


def repeated_words(words: np.ndarray) -> int:
    """Words in 3-word windows found twice or more, the first finding included."""
    n = len(words)
    if n < 4:
        return 0
    _, own = np.unique(words, return_inverse=True)
    own = own.astype(np.int64)
    _, pair = np.unique(own[:-1] * n + own[1:], return_inverse=True)
    _, triple, counts = np.unique(
        pair[:-1].astype(np.int64) * n + own[2:], return_inverse=True, return_counts=True
    )
    often = counts[triple] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= often
    return int(covered.sum())


def _measure(folder: str, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fertility = per_worker(("fertility", folder), lambda: Fertility(folder), alone=True)
        kinds = [(c, pa.int64()) for c in COUNTS] + [("entropy", pa.float64())]
        for batch in batches:
            raws = texts(batch["text"])
            for first, last in slices([len(raw) for raw in raws], BYTES_A_SLICE):
                found = fertility.measure(raws[first:last])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].slice(first, last - first),
                        pa.StructArray.from_arrays(
                            [pa.array(found[c], kind) for c, kind in kinds],
                            [c for c, _ in kinds],
                        ),
                    ],
                    ["row", name],
                )

    return run


def measured(
    docs: DataFrame,
    keep: list[str],
    text_col: str,
    tokenizers: str,
    name: str,
) -> DataFrame:
    """The columns ``keep`` and a struct ``name`` with what both vocabularies and the text say."""
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in keep)
    fields = FIELDS.replace(" ", ": ").replace(",:", ",")
    return (
        docs.select(F.struct(*keep).alias("row"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_measure(tokenizers, name), f"row struct<{kinds}>, {name} struct<{fields}>")
        .select("row.*", name)
    )


def _values(q) -> dict:
    """The measures of a text; null where it has no words."""
    some = q["n_words"] > 0
    return {
        "chars_a_piece": F.when(some, q["word_chars"] / q["n_pieces"]),
        "chars_a_rank": F.when(some, q["word_chars"] / q["n_ranks"]),
        "fallback_share": F.when(some, q["n_fallback"] / q["n_pieces"]),
        # Of what as many tokens could have at most, so that length says little.
        "entropy": F.when(some, q["entropy"] / F.log2(q["n_pieces"] + F.lit(1.0))),
    }


def fails_base(q):
    return (q["n_words"] < MIN_WORDS) | (
        100 * q["n_repeat_words"] > MOST_REPEATED_PERCENT * q["n_words"]
    )


def bands(scored: DataFrame, lang_col: str, q) -> DataFrame:
    """Per language the lowest and highest value that each measure may have.

    Histograms are exact counts over all texts that pass the base rules, combined map-side; a
    language has as many rows as filled cells, however many texts it has.
    """
    cells = F.array(
        *(
            F.struct(
                F.lit(m).alias("measure"),
                F.floor(value * MEASURES[m]).cast("long").alias("cell"),
            )
            for m, value in _values(q).items()
        )
    )
    counts = (
        scored.where(~fails_base(q))
        .select(F.col(lang_col).alias("lang"), F.explode(cells).alias("x"))
        .groupBy("lang", "x.measure", "x.cell")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    order = Window.partitionBy("lang", "measure").orderBy("cell")
    whole = Window.partitionBy("lang", "measure")
    placed = counts.select(
        "lang", "measure", "cell", F.sum("n").over(order).alias("upto"),
        F.sum("n").over(whole).alias("all"),
    )
    points = placed.groupBy("lang", "measure").agg(
        *(
            F.min(F.when(F.col("upto") * 100 >= F.col("all") * p, F.col("cell"))).alias(f"p{p}")
            for p in (25, 50, 75)
        )
    )
    scale = reduce(
        lambda e, m: e.when(F.col("measure") == m, F.lit(float(MEASURES[m]))),
        MEASURES,
        F.when(F.lit(False), F.lit(1.0)),
    )
    middle = F.col("p50") / scale
    reach = F.greatest(
        (F.col("p75") - F.col("p25")) / scale * REACH,
        middle * LEAST_SHARE,
        F.lit(LEAST_WIDTH),
    )
    return (
        points.select("lang", "measure", (middle - reach).alias("low"), (middle + reach).alias("high"))
        .groupBy("lang")
        .agg(
            *(
                F.max(F.when(F.col("measure") == m, F.col(end))).alias(f"{m}_{end}")
                for m in MEASURES
                for end in ("low", "high")
            )
        )
    )


def fertility_rules(
    docs: DataFrame,
    keep: list[str] | None = None,
    text_col: str = "text",
    lang_col: str = "lang",
    tokenizers: str = TOKENIZERS,
) -> tuple[DataFrame, str]:
    """The columns ``keep`` (all) of every row and a struct of its measures, base verdict, verdict.

    Returns the frame and the struct's name (``quality``, with underscores where that is taken).
    A null or empty text has no words, fails the base rules and is not kept; a null language is
    a language of its own; repeated rows each have their verdict and each count; an empty table
    gives no rows. Texts are read and measured once, into a written table that the bands and the
    verdicts both read; nothing but histograms and one row per language is shuffled.
    """
    keep = list(keep or docs.columns)
    name = free_name(docs, "quality")
    scored = kept_table(
        measured(docs, list(dict.fromkeys([*keep, lang_col])), text_col, tokenizers, name),
        "fertility",
    )
    q = {c: F.col(f"{name}.{c}") for c in [*COUNTS, "entropy"]}
    limits = sized_broadcast(
        kept_table(bands(scored, lang_col, q), "bands").withColumnRenamed("lang", "_lang")
    )
    packed = scored.select(F.struct("*").alias("row"), F.col(lang_col).alias("lang"))
    found = packed.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    q = {c: F.col(f"row.{name}.{c}") for c in [*COUNTS, "entropy"]}
    values = _values(q)
    inside = reduce(
        lambda a, b: a & b,
        (
            F.coalesce(v.between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(True))
            for m, v in values.items()
        ),
    )
    failed = fails_base(q)
    verdict = F.struct(
        *(v.alias(c) for c, v in q.items()),
        *(v.alias(m) for m, v in values.items() if m != "entropy"),
        failed.alias("base_failed"),
        (~failed & inside).alias("kept"),
    )
    return found.select(*(F.col(f"row.{c}").alias(c) for c in keep), verdict.alias(name)), name
