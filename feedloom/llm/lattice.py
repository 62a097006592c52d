"""LM scoring by subword lattice likelihood.

The pieces of a public vocabulary are unigrams. Their probabilities weight all segmentations of
a text; the score of a text is the log-probability summed over all of them, found by the forward
recursion in log space. The vocabulary file holds merge ranks instead of log-probabilities, so
the piece probabilities are the smoothed frequencies of the pieces in the vocabulary's own
segmentation of the training texts. No piece crosses a word's beginning, so every path of the
document's lattice passes through all word boundaries and the document's marginal is the product
of its words' marginals: each distinct word is summed once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import TOKENIZERS, kept_table, sentence_pieces, texts, utf8
from feedloom.llm.pieces import SPACE, Pieces, load_pieces, prepared, raw_bytes

#: Words sent to every worker with their counts; the rest are joined. A fixed bound.
HOT_WORDS = 65_536
#: Entries a worker counts before it hands them on.
FLUSH = 300_000
END = b"\n"  # The end token; no word holds white space.


def log_marginal(text: str, edges: dict, byte_logs: list[float]) -> float:
    """Natural log of the summed probability of all segmentations of a prepared text."""
    log1p, exp, none = math.log1p, math.exp, -math.inf
    n = len(text)
    alpha = [none] * (n + 1)
    alpha[0] = 0.0
    for i in range(n):
        a = alpha[i]
        j = i + 1
        while j <= n:
            part = text[i:j]
            if part not in edges:
                break
            weight = edges[part]
            if weight is not None:
                x, y = a + weight, alpha[j]
                alpha[j] = (
                    x if y == none
                    else y + log1p(exp(x - y)) if y >= x
                    else x + log1p(exp(y - x))
                )
            j += 1
        if edges.get(text[i]) is None:  # No piece of its own: its bytes.
            x, y = a + sum(byte_logs[b] for b in raw_bytes(text[i])), alpha[i + 1]
            alpha[i + 1] = x if y == none else max(x, y) + log1p(exp(-abs(x - y)))
    return alpha[n]


def piece_logs(pieces: Pieces, counts: dict[int, int]) -> tuple[dict, list[float], float]:
    """Smoothed natural log-probabilities: edges, bytes and the end of a text (id -1)."""
    usable = [*pieces.ids.values(), *pieces.byte_ids, -1]
    total = math.log(sum(counts.get(k, 0) for k in usable) + 0.5 * len(usable))
    logs = {k: math.log(counts.get(k, 0) + 0.5) - total for k in usable}
    edges = pieces.edges({p: logs[k] for p, k in pieces.ids.items()})
    return edges, [logs[k] for k in pieces.byte_ids], logs[-1]


def is_held_out(doc_id):
    """Remainder 1 of the checksum of the id's text; a row without id trains."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    train, rest = Counter(), Counter()

    def handed_on():
        words = list(train.keys() | rest.keys())
        c = [train[w] for w in words]
        yield pa.RecordBatch.from_pydict(
            {
                "word": pa.array(words, pa.binary()),
                "c": pa.array(c, pa.int64()),
                "n": pa.array([x + rest[w] for x, w in zip(c, words)], pa.int64()),
            }
        )
        train.clear()
        rest.clear()

    for batch in batches:
        for raw, held in zip(texts(batch["text"]), batch["held_out"].to_pylist()):
            into = rest if held else train
            into.update(raw.lower().split())
            into[END] += 1
            if len(train) + len(rest) > FLUSH:
                yield from handed_on()
    yield from handed_on()


def _count_pieces(folder: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentence_pieces(folder)
        counts = np.zeros(sp.get_piece_size(), np.int64)
        for batch in batches:
            # A raw U+2581 is not a space; its place is held by a character without a piece.
            words = [utf8(w).replace(SPACE, "￾") for w in batch["word"].to_pylist()]
            encoded = sp.encode(words, num_threads=1)
            flat = np.fromiter((k for ids in encoded for k in ids), np.int64)
            times = np.repeat(batch["c"].to_numpy(), [len(ids) for ids in encoded])
            np.add.at(counts, flat, times)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array(seen, pa.int64()), "n": pa.array(counts[seen], pa.int64())}
        )

    return count


def _sum_words(folder: str, model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, byte_logs, end = piece_logs(load_pieces(folder), model.value)
        for batch in batches:
            logs = [
                (end if w == END else log_marginal(SPACE + prepared(utf8(w)), edges, byte_logs))
                / math.log(10)
                for w in batch["word"].to_pylist()
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "word": batch["word"],
                    "c": batch["c"],
                    "n": batch["n"],
                    "log10_p": pa.array(logs, pa.float64()),
                }
            )

    return score


def _split_words(hot, denominator: float):
    """Per text one row of what the hot words give, and a row for each other distinct word."""
    names = ("doc_id", "text_key", "word", "n", "ends", "tokens", "known", "base", "score")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = hot.value
        for batch in batches:
            out: dict[str, list] = {name: [] for name in names}
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
                words = raw.lower().split()
                counts = Counter(words)
                counts[END] = 1
                key = xxhash.xxh64_intdigest(raw) - (1 << 63)
                known, base, score, rare = 0, 0.0, 0.0, []
                for word, n in counts.items():
                    found = shared.get(word)
                    if found is None:
                        rare.append(word)
                        continue
                    c, log10_p = found
                    known += n * (c > 0)
                    base += n * math.log10((c + 0.5) / denominator)
                    score += n * log10_p
                more = len(rare) + 1
                out["doc_id"] += [doc_id] * more
                out["text_key"] += [key] * more
                # The row of the text itself has a word that no text holds and no other row has.
                out["word"] += [*rare, b"\n%d" % key]
                out["n"] += [*map(counts.__getitem__, rare), 0]
                for name, value in (
                    ("ends", 1), ("tokens", len(words) + 1), ("known", known),
                    ("base", base), ("score", score),
                ):
                    out[name] += [None] * len(rare)
                    out[name].append(value)
            kinds = (
                batch.schema.field("doc_id").type, pa.int64(), pa.binary(), pa.int64(), pa.int64(),
                pa.int64(), pa.int64(), pa.float64(), pa.float64(),
            )
            yield pa.RecordBatch.from_pydict(
                {name: pa.array(out[name], kind) for name, kind in zip(names, kinds)}
            )

    return split


def lattice_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizers: str = TOKENIZERS,
    hot_words: int = HOT_WORDS,
) -> DataFrame:
    """Base and lattice log10 probabilities of every whole text.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score. A null or
    empty text holds the end token alone; a null id trains; repeated rows count each time and
    come back each time; other columns are ignored; an empty table gives no rows. Word counts
    are a map-side combined aggregate over all texts. The ``hot_words`` commonest words, a fixed
    bound, go to all workers; counts of all others meet the texts in a join, whose hot keys are
    thereby gone. Texts themselves are never shuffled.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        is_held_out(F.col(id_col)).alias("held_out"),
    )
    counted = rows.select("text", "held_out").mapInArrow(
        _count_words, "word binary, c long, n long"
    )
    words = kept_table(
        counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "word-counts"
    )
    totals = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n"),
        F.count(F.when(F.col("c") > 0, 1)).alias("v"),
        F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))), F.lit(0)).alias("ends"),
    ).first()
    counts = (
        words.where((F.col("c") > 0) & (F.col("word") != F.lit(END)))
        .mapInArrow(_count_pieces(tokenizers), "piece long, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .collect()  # At most as many rows as the vocabulary has pieces.
    )
    model = spark.sparkContext.broadcast({**{r.piece: r.n for r in counts}, -1: totals.ends})
    scored = kept_table(
        words.mapInArrow(
            _sum_words(tokenizers, model), "word binary, c long, n long, log10_p double"
        ),
        "word-scores",
    )
    common = scored.orderBy(F.desc("n"), "word").limit(hot_words).collect()
    hot = spark.sparkContext.broadcast({bytes(r.word): (r.c, r.log10_p) for r in common})
    denominator = totals.n + 0.5 * (totals.v + 1)
    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = rows.select("doc_id", "text").mapInArrow(
        _split_words(hot, denominator),
        f"doc_id {kind}, text_key long, word binary, n long, ends long, tokens long, known long, "
        "base double, score double",
    )
    base = F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(denominator))
    met = parts.join(scored.select("word", "c", "log10_p"), "word", "left").select(
        "doc_id",
        "text_key",
        "ends",
        "tokens",
        F.coalesce("known", F.when(F.col("c") > 0, F.col("n")), F.lit(0)).alias("known"),
        F.coalesce("base", base).alias("base"),
        F.coalesce("score", F.col("n") * F.col("log10_p")).alias("score"),
    )
    # Rows with the same id and text have the same result: their sums are shared out again.
    sums = met.groupBy("doc_id", "text_key").agg(
        *(F.sum(x).alias(x) for x in ("ends", "tokens", "known", "base", "score"))
    )
    each = sums.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("ends").cast("int"))))
    return each.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        (F.col("tokens") / F.col("ends")).cast("long").alias("n_tokens"),
        (F.col("known") / F.col("ends")).cast("long").alias("n_known"),
        F.lit(totals.n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("ends")).alias("base_score"),
        (F.col("score") / F.col("ends")).alias("score"),
    )
