"""Phrase collocations by counting quotient filters.

Words that occur often enough get numbers, and the numbers of 2 to 4 words in a row are packed to
one key. An invertible permutation spreads keys evenly, so that their leading bits are a quotient
that needs no more room than a count of slots, and the remaining bits are kept in full: a filter
that is as compact as a hash table, but exact, as every key can be won back. Tasks fill filters,
sorted by nature; those of one range of quotients meet in one task, which merges them in order.

Words that occur less often than a phrase must are in no phrase. Counts of all parts of a phrase
are therefore among the counted ones, and the scores are joins over those alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import kept_table, texts, utf8
from feedloom.operators.joins import sized_broadcast
from feedloom.operators.numbering import assign_ids

LONGEST = 4
NO_LANGUAGE = "und"
#: Words whose numbers every worker knows: so many of the commonest, none longer than this. Words
#: beyond are joined to the documents that hold them.
KNOWN_WORDS, KNOWN_BYTES = 500_000, 64
#: Keys of one length that a task holds before it gives out their filter, and keys (repeated ones
#: too) for each range of quotients.
KEYS_A_FILTER, KEYS_A_RANGE = 1 << 21, 1 << 20
BYTES_A_TIME = 1 << 20
ROUNDS = 4

#: Capital letters become small, ends of pieces one byte that no UTF-8 text holds.
END = b"\xff"
_FROM = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_FROM, _FROM[:26].lower() + END * (len(_FROM) - 26))


def words_of(raws: list[bytes]) -> Iterator[list[bytes]]:
    """Words of the texts in order, some at a time, with an ``END`` wherever a piece ends."""
    clean = (raw if END not in raw else utf8(raw).encode() for raw in raws)
    text = END.join(clean).translate(_TABLE).replace(END, b" " + END + b" ")
    first = 0
    while first < len(text):
        last = text.find(b" ", first + BYTES_A_TIME)
        last = len(text) if last < 0 else last
        yield text[first:last].split()
        first = last


def by_language(batch: pa.RecordBatch) -> dict[str, list[int]]:
    rows: dict[str, list[int]] = {}
    for k, lang in enumerate(batch["lang"].to_pylist()):
        rows.setdefault(lang, []).append(k)
    return rows


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def told() -> pa.RecordBatch:
        rows = [(lang, w, n) for lang, own in counts.items() for w, n in own.items() if w != END]
        rows += [(lang, None, sum(own.values()) - own[END]) for lang, own in counts.items()]
        counts.clear()
        langs, words, ns = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(words, pa.binary()), pa.array(ns, pa.int64())],
            ["lang", "word", "n"],
        )

    for batch in batches:
        raws = texts(batch["text"])
        for lang, rows in by_language(batch).items():
            own = counts.setdefault(lang, Counter())
            for words in words_of([raws[k] for k in rows]):
                own.update(words)
        if sum(map(len, counts.values())) > KNOWN_WORDS:
            yield told()
    yield told()


def halves(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Columns of word numbers (rows: phrases) packed to a left and a right half of equal width."""
    k = words.shape[1]
    b = np.uint64(bits)
    if k * bits <= 64:
        width = (k * bits + 1) // 2
        key = words[:, 0]
        for c in range(1, k):
            key = (key << b) | words[:, c]
        return key >> np.uint64(width), key & np.uint64((1 << width) - 1), width
    left, right = (words[:, 0], words[:, 1:]) if k < 4 else (words[:, 0] << b | words[:, 1], words[:, 2:])
    return left, right[:, 0] << b | right[:, 1], 2 * bits


def words_from(left: np.ndarray, right: np.ndarray, bits: int, k: int) -> np.ndarray:
    """The inverse of ``halves``."""
    b, low = np.uint64(bits), np.uint64((1 << bits) - 1)
    if k * bits <= 64:
        key = (left << np.uint64((k * bits + 1) // 2)) | right
        return np.stack([(key >> np.uint64(bits * (k - 1 - c))) & low for c in range(k)], 1)
    tail = [right >> b, right & low]
    return np.stack([left, *tail] if k < 4 else [left >> b, left & low, *tail], 1)


def _mixed(x: np.ndarray, turn: int, low: np.uint64) -> np.ndarray:
    x = (x + np.uint64(0x9E3779B97F4A7C15 * (turn + 1) % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) & low


def spread(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of the pairs of ``width``-bit halves that scatters neighbours."""
    low = np.uint64((1 << width) - 1)
    with np.errstate(over="ignore"):
        for turn in range(ROUNDS):
            left, right = right, left ^ _mixed(right, turn, low)
    return left, right


def gathered(left: np.ndarray, right: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of ``spread``."""
    low = np.uint64((1 << width) - 1)
    with np.errstate(over="ignore"):
        for turn in reversed(range(ROUNDS)):
            left, right = right ^ _mixed(left, turn, low), left
    return left, right


def counted(left: np.ndarray, right: np.ndarray, width: int, n: np.ndarray | None = None):
    """Distinct keys in order, and how often each occurs (or the sums of ``n``)."""
    if 2 * width <= 64:
        key = left << np.uint64(width) | right
        if n is None:
            key = np.sort(key)
        else:
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        left, right = key >> np.uint64(width), key & np.uint64((1 << width) - 1)
    else:
        order = np.lexsort((right, left))
        left, right = left[order], right[order]
        n = None if n is None else n[order]
        same = (left[1:] == left[:-1]) & (right[1:] == right[:-1])
        new = np.flatnonzero(np.concatenate([[True], ~same])) if len(left) else left
    new = new.astype(np.int64)
    if not len(new):
        return left, right, np.zeros(0, np.int64)
    n = np.diff(np.append(new, len(left))) if n is None else np.add.reduceat(n, new)
    return left[new], right[new], n.astype(np.int64)


def _bytes(values: np.ndarray, bits: int) -> bytes:
    """Each value in as many whole bytes as ``bits`` need."""
    wide = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)
    return wide[:, : -(-bits // 8)].tobytes()


def _values(raw: bytes, bits: int, n: int) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    size = -(-bits // 8)
    if size:
        wide[:, :size] = np.frombuffer(raw, np.uint8).reshape(n, size)
    return wide.reshape(-1).view("<u8").astype(np.uint64)


#: A filter of one range: quotients as slots filled for each, remainders in full, counters of one
#: byte and the few that need more.
FILTER = (
    "words int, range long, quotients int, n int, filled binary, left binary, right binary, "
    "counters binary, places binary, larger binary"
)
FILTER_NAMES = [field.split()[0] for field in FILTER.split(", ")]


def packed_filter(left, right, n, width: int, range_bits: int) -> dict:
    """Sorted keys of one range, whose leading ``range_bits`` agree, as a filter."""
    rest = width - range_bits
    quotient_bits = min(rest, max(0, len(left).bit_length() - 1))
    rest -= quotient_bits
    own = left & np.uint64((1 << (width - range_bits)) - 1)
    quotient = (own >> np.uint64(rest)).astype(np.int64)
    large = np.flatnonzero(n > 255)
    return {
        "quotients": quotient_bits,
        "n": len(left),
        "filled": np.bincount(quotient, minlength=1 << quotient_bits).astype("<u4").tobytes(),
        "left": _bytes(own & np.uint64((1 << rest) - 1), rest),
        "right": _bytes(right, width),
        "counters": np.minimum(n, 255).astype(np.uint8).tobytes(),
        "places": large.astype("<i4").tobytes(),
        "larger": n[large].astype("<i8").tobytes(),
    }


def unpacked_filter(f: dict, width: int, range_bits: int):
    """Keys in order and their counts."""
    rest = width - range_bits - f["quotients"]
    quotient = np.repeat(
        np.arange(1 << f["quotients"], dtype=np.uint64), np.frombuffer(f["filled"], "<u4")
    )
    high = (np.uint64(f["range"]) << np.uint64(f["quotients"])) | quotient
    left = (high << np.uint64(rest)) | _values(f["left"], rest, f["n"])
    n = np.frombuffer(f["counters"], np.uint8).astype(np.int64)
    n[np.frombuffer(f["places"], "<i4")] = np.frombuffer(f["larger"], "<i8")
    return left, _values(f["right"], width, f["n"]), n


def width_of(bits: int, k: int) -> int:
    return (k * bits + 1) // 2 if k * bits <= 64 else 2 * bits


class Numbers(dict):
    """Numbers of words; 0, which no phrase crosses, for all others."""

    def __missing__(self, word: bytes) -> int:
        return 0


def _fill(known, bits: int, range_bits: int):
    """Rows of documents to filters; ``tail`` has the words of a row that not all workers know."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, dict] = known.value
        held: dict[int, list[np.ndarray]] = {k: [] for k in range(2, LONGEST + 1)}
        sizes = dict.fromkeys(held, 0)

        def told(k: int) -> Iterator[pa.RecordBatch]:
            width = width_of(bits, k)
            own = min(range_bits, width)
            phrases, held[k], sizes[k] = np.concatenate(held[k]), [], 0
            left, right, n = counted(*spread(*halves(phrases, bits)[:2], width), width)
            ranges = (left >> np.uint64(width - own)).astype(np.int64)
            bounds = np.flatnonzero(np.diff(ranges, prepend=-1, append=-1))
            rows = [
                {"words": k, "range": int(ranges[a])}
                | packed_filter(left[a:b], right[a:b], n[a:b], width, own)
                for a, b in zip(bounds, bounds[1:])
            ]
            for a in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pydict(
                    {c: [row[c] for row in rows[a : a + 256]] for c in FILTER_NAMES}, SCHEMA
                )

        for batch in batches:
            raws = texts(batch["text"])
            tails = batch["tail"].to_pylist() if "tail" in batch.schema.names else None
            parts = []
            for lang, rows in by_language(batch).items():
                get = Numbers(numbers.get(lang, {}))
                groups = [[k] for k in rows] if tails else [rows]
                for group in groups:
                    if tails and tails[group[0]]:
                        get = Numbers(numbers.get(lang, {}))
                        get.update((bytes(t["word"]), t["id"]) for t in tails[group[0]])
                    for words in words_of([raws[k] for k in group]):
                        parts.append(np.fromiter(map(get.__getitem__, words), np.uint64, len(words)))
                    parts.append(np.zeros(1, np.uint64))
            ids = np.concatenate([*parts, np.zeros(LONGEST, np.uint64)])
            windows = np.lib.stride_tricks.sliding_window_view(ids, LONGEST)
            whole = ids[: len(windows)] > 0
            for k in held:
                whole = whole & (windows[:, k - 1] > 0)
                phrases = windows[whole, :k]
                held[k].append(phrases)
                sizes[k] += len(phrases)
                if sizes[k] >= KEYS_A_FILTER:
                    yield from told(k)
        for k in held:
            if sizes[k]:
                yield from told(k)

    return run


SCHEMA = pa.schema(
    [
        (name, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (field.split() for field in FILTER.split(", "))
    ]
)


def _merge(bits: int, range_bits: int, least: int):
    """Filters in order of their range to the phrases that occur ``least`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, int] | None = None
        parts: list = []
        held = 0

        def merged():
            return counted(
                *(np.concatenate([p[c] for p in parts]) for c in (0, 1)),
                width_of(bits, at[0]),
                np.concatenate([p[2] for p in parts]),
            )

        def told() -> pa.RecordBatch:
            left, right, n = merged()
            often = n >= least
            width = width_of(bits, at[0])
            words = words_from(*gathered(left[often], right[often], width), bits, at[0])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(list(words.astype(np.int64)), pa.list_(pa.int64())),
                    pa.array(n[often], pa.int64()),
                ],
                ["ids", "a"],
            )

        for batch in batches:
            for row in batch.to_pylist():
                key = row["words"], row["range"]
                if key != at:
                    if at:
                        yield told()
                    at, parts, held = key, [], 0
                own = min(range_bits, width_of(bits, key[0]))
                parts.append(unpacked_filter(row, width_of(bits, key[0]), own))
                held += row["n"]
                if held > 2 * KEYS_A_RANGE:
                    parts = [merged()]
                    # Merged keys are distinct: what is held grows with them only.
                    held = min(len(parts[0][0]), KEYS_A_RANGE)
        if at:
            yield told()

    return run


def word_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, word, n) of the words that occur ``least`` times or more; word null: all of a lang."""
    return (
        docs.mapInArrow(_count_words, "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .where((F.col("n") >= least) | F.col("word").isNull())
    )


def with_tail(docs: DataFrame, tail: DataFrame, known) -> DataFrame:
    """``docs`` with the numbers of their words that not every worker knows, as a column ``tail``."""
    docs = kept_table(docs.withColumn("doc", F.monotonically_increasing_id()), "phrase-texts")

    def unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws, out = texts(batch["text"]), []
            for doc, lang, raw in zip(batch["doc"].to_pylist(), batch["lang"].to_pylist(), raws):
                words = {word for some in words_of([raw]) for word in some}
                out += [(doc, lang, w) for w in words.difference(known.value.get(lang, {}), [END])]
            doc, lang, word = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(lang, pa.string()), pa.array(word, pa.binary())],
                ["doc", "lang", "word"],
            )

    found = (
        docs.mapInArrow(unknown, "doc long, lang string, word binary")
        .join(tail.select("lang", "word", "id"), ["lang", "word"])
        .groupBy("doc")
        .agg(F.collect_list(F.struct("word", "id")).alias("tail"))
    )
    return docs.join(found, "doc", "left").select("lang", "text", "tail")


def frequent_phrases(
    docs: DataFrame,
    least: int = 30,
    text_col: str = "text",
    lang_col: str = "lang",
    known_words: int = KNOWN_WORDS,
    keys_a_range: int = KEYS_A_RANGE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (lang, word, n, id), totals (lang, n) and phrases (ids, a) found ``least`` times or more."""
    spark = docs.sparkSession
    docs = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    counts = kept_table(word_counts(docs, least), "word-counts")
    totals = counts.where("word IS NULL").select("lang", "n")
    words = kept_table(
        assign_ids(counts.where("word IS NOT NULL"), [F.desc("n"), "lang", "word"], "id"), "words"
    )
    # Rows and bytes of what the driver and the workers hold are bounded by the two constants.
    head = (F.col("id") <= known_words) & (F.length("word") <= KNOWN_BYTES)
    numbers: dict[str, dict] = {}
    for row in words.where(head).collect():
        numbers.setdefault(row["lang"], {})[bytes(row["word"])] = row["id"]
    known = spark.sparkContext.broadcast(numbers)
    size = words.agg(F.count(F.lit(1)), F.sum("n")).first()
    tail = words.where(~head)
    if size[0] > sum(map(len, numbers.values())):
        docs = with_tail(docs, tail, known)
    bits = max(1, size[0].bit_length())
    ranges = (LONGEST - 1) * (size[1] or 0) // keys_a_range
    range_bits = ranges.bit_length()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    phrases = (
        docs.mapInArrow(_fill(known, bits, range_bits), FILTER)
        .repartition(tasks, "words", "range")
        .sortWithinPartitions("words", "range")
        .mapInArrow(_merge(bits, range_bits, least), "ids array<long>, a long")
    )
    return words, totals, kept_table(phrases, "phrases")


def scored_phrases(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """(ids, a, l, r, score): the cut with the lowest score counts, of equal ones the first."""
    single = words.select(F.array("id").alias("part"), F.col("n").alias("f"))
    parts = sized_broadcast(
        kept_table(phrases.select(F.col("ids").alias("part"), F.col("a").alias("f")).unionByName(single), "parts")
    )
    left, right = (
        parts.select(F.col("part").alias(side), F.col("f").alias(f"f_{side}")) for side in ("x", "y")
    )
    score = F.expr("cast(2000000 AS decimal(20,0)) * a DIV (f_x + f_y)")
    return (
        phrases.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
        .select(
            "ids",
            "a",
            "k",
            F.slice("ids", F.lit(1), F.col("k")).alias("x"),
            F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("y"),
        )
        .join(left, "x")
        .join(right, "y")
        .groupBy("ids")
        .agg(F.min(F.struct(score.alias("score"), "k", "a", "f_x", "f_y")).alias("cut"))
        .select(
            "ids",
            "cut.a",
            F.col("cut.f_x").alias("l"),
            F.col("cut.f_y").alias("r"),
            "cut.score",
        )
    )


def within_longer(phrases: DataFrame) -> DataFrame:
    """(ids, most): the largest count of a longer phrase that holds the words in a row."""
    inner = (
        F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))),
        *(
            F.array(*(F.struct(F.lit(at).alias("at"), F.lit(n).alias("n"))
                      for n in range(2, size) for at in range(1, size - n + 2)))
            for size in range(3, LONGEST + 1)
        ),
    )
    return (
        phrases.where(F.size("ids") > 2)
        .select("a", "ids", F.explode(F.get(F.array(*inner), F.size("ids") - 2)).alias("cut"))
        .select("a", F.slice("ids", F.col("cut.at"), F.col("cut.n")).alias("ids"))
        .groupBy("ids")
        .agg(F.max("a").alias("most"))
    )


def collocations(
    docs: DataFrame,
    least: int = 30,
    most: int = 2000,
    within_percent: int = 80,
    text_col: str = "text",
    lang_col: str = "lang",
    known_words: int = KNOWN_WORDS,
    keys_a_range: int = KEYS_A_RANGE,
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are read whole in two passes; a null or empty text has no words; a null language is
    ``und``; repeated rows count as often as they stand there; other columns are left behind; an
    empty table gives no rows. Counts are exact over all texts. The shuffles carry word counts
    combined in each task, filters, and the frequent phrases: nothing is gathered by word or
    language but the best ``most`` phrases of each task.
    """
    words, totals, phrases = frequent_phrases(
        docs, least, text_col, lang_col, known_words, keys_a_range
    )
    longer = sized_broadcast(kept_table(within_longer(phrases), "longer"))
    left = (
        scored_phrases(phrases, words)
        .join(longer, "ids", "left")
        .where(
            F.col("most").isNull()
            | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * within_percent)
        )
    )
    spelt = (
        left.select("ids", "a", "l", "r", "score", F.posexplode("ids").alias("at", "id"))
        .join(sized_broadcast(words.select("id", "lang", F.col("word").cast("string").alias("word"))), "id")
        .groupBy("ids", "a", "l", "r", "score")
        .agg(
            F.first("lang").alias("lang"),
            F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"),
        )
        .select(
            "lang",
            F.array_join(F.transform("words", lambda w: w["word"]), " ").alias("phrase"),
            "a",
            "l",
            "r",
            "score",
        )
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        spelt.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= most)
        .join(sized_broadcast(totals), "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
