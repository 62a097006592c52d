"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles under one global order, rare shingles first. If two sets are
similar enough, their prefixes of l more than the shortest safe length share at least l shingles.
Each document picks the l with the least estimated candidate cost: a longer prefix meets more
posting lists, but a candidate then needs l shared shingles before it is verified.

Copies (equal sets) are one node throughout. A group of near copies is not expanded into its
pairs: members are first verified against a leader of the lists they share. Of the pairs that these
links leave in different components, those under one leader are compared in bounded blocks,
and only the others are enumerated from the lists, counted and verified.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import free_name, kept_table, per_worker, slices, texts
from feedloom.llm.order import mix
from feedloom.operators.joins import sized_broadcast

WORDS, PERCENT = 5, 80
#: Longest extension of a prefix, and what verifying a candidate costs in postings.
MOST_MATCHES, VERIFY_COST = 4, 8.0
HASH_BITS = 48
#: The frequency sketch: a fixed number of cells, each the largest frequency class of its hashes.
CELL_BITS, COUNT_BITS = 26, 32
HELD = 1 << 22  # Hashes a task gathers before it hands them on.
BYTES_A_SLICE = 1 << 18
#: Nodes of a block of a cluster, and shingles counted at a time.
BLOCK, CHUNK = 256, 8192
BASE = 0x9E3779B97F4A7C15


class Shingler:
    """Hashes of word runs as ranges of a polynomial prefix sum over the bytes."""

    def __init__(self):
        self.codes = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        self.powers = self.inverse = np.ones(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * BYTES_A_SLICE)
            step = np.full(n, (BASE | 1) & (2**64 - 1), np.uint64)
            back = np.full(n, pow(BASE | 1, -1, 2**64), np.uint64)
            step[0] = back[0] = 1
            self.powers, self.inverse = np.multiply.accumulate(step), np.multiply.accumulate(back)

    def sets(self, raws: list[bytes], width: int = WORDS) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text, A-Z in lower case."""
        joined = [b" ".join(raw.lower().split()) for raw in raws]
        counts = np.array([part.count(b" ") + 1 if part else 0 for part in joined], np.int64)
        text = np.frombuffer(b" ".join(part for part in joined if part), np.uint8)
        if not len(text):
            return [np.zeros(0, np.uint64)] * len(raws)
        self._grow(len(text) + 1)
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(self.codes[text] * self.powers[: len(text)], out=sums[1:])
        blanks = np.flatnonzero(text == 32)
        starts = np.concatenate([[0], blanks + 1])
        ends = np.concatenate([blanks, [len(text)]])
        # A text of fewer words has its whole sequence as one shingle.
        runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
        bounds = np.concatenate([[0], np.cumsum(runs)])
        words = np.concatenate([[0], np.cumsum(counts)])[:-1]
        first = np.arange(bounds[-1]) + np.repeat(words - bounds[:-1], runs)
        last = first + np.repeat(np.minimum(counts, width) - 1, runs)
        a, b = starts[first], ends[last]
        hashes = mix((sums[b] - sums[a]) * self.inverse[a]) >> np.uint64(64 - HASH_BITS)
        return [np.unique(hashes[x:y]) for x, y in zip(bounds[:-1], bounds[1:])]


def set_key(hashes: np.ndarray) -> int:
    """Identity of a set: equal sets are one node."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def _sets(raws: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    shingler = per_worker(("shingler",), Shingler, alone=True)
    for first, last in slices([len(raw) for raw in raws], BYTES_A_SLICE):
        yield from enumerate(shingler.sets(raws[first:last]), first)


class Seen:
    """Sets a task has met, forgotten now and then; a set met again only costs some rows."""

    def __init__(self, most: int = 200_000):
        self.keys, self.most = set(), most

    def new(self, key: int) -> bool:
        if key in self.keys:
            return False
        if len(self.keys) >= self.most:
            self.keys.clear()
        self.keys.add(key)
        return True


# --- Frequencies ---------------------------------------------------------------------------


def pack(sorted_hashes: np.ndarray, base: int) -> bytes:
    """Differences of sorted 32-bit hashes, two bytes each and in planes, compressed."""
    steps = np.diff(sorted_hashes.astype(np.int64), prepend=base)
    far = np.flatnonzero(steps >> 16)
    low = (steps & 0xFFFF).astype("<u2").view(np.uint8)
    raw = b"".join(
        (
            struct.pack("<qq", len(steps), len(far)),
            low[::2].tobytes(),
            low[1::2].tobytes(),
            far.astype("<i8").tobytes(),
            (steps[far] >> 16).astype("<i8").tobytes(),
        )
    )
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(blob: bytes, base: int) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = struct.unpack_from("<qq", raw)
    steps = np.frombuffer(raw, np.uint8, n, 16).astype(np.int64)
    steps |= np.frombuffer(raw, np.uint8, n, 16 + n).astype(np.int64) << 8
    far = np.frombuffer(raw, "<i8", m, 16 + 2 * n)
    steps[far] += np.frombuffer(raw, "<i8", m, 16 + 2 * n + 8 * m) << 16
    return base + np.cumsum(steps)


def _gather(ranges: int):
    width = (1 << COUNT_BITS) // ranges

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, Seen()

        def handed_on():
            hashes = np.concatenate(held)
            hashes.sort()
            cuts = np.searchsorted(hashes, np.arange(ranges, dtype=np.int64) * width)
            cuts = np.append(cuts, len(hashes))
            some = [r for r in range(ranges) if cuts[r] < cuts[r + 1]]
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(some, pa.int32()),
                    "blob": pa.array(
                        [pack(hashes[cuts[r] : cuts[r + 1]], r * width) for r in some], pa.binary()
                    ),
                }
            )

        for batch in batches:
            for _, hashes in _sets(texts(batch["text"])):
                if len(hashes) and seen.new(set_key(hashes)):
                    held.append((hashes >> np.uint64(HASH_BITS - COUNT_BITS)).astype(np.uint32))
                    size += len(hashes)
                    if size >= HELD:
                        yield handed_on()
                        held, size = [], 0
        if held:
            yield handed_on()

    return gather


def _classes(ranges: int):
    width = (1 << COUNT_BITS) // ranges
    cells = (1 << CELL_BITS) // ranges

    def count(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        base = part * width
        hashes = np.sort(np.concatenate([unpack(b, base) for b in table["blob"].to_pylist()]))
        edges = np.flatnonzero(np.diff(hashes, prepend=-1))
        counts = np.diff(np.append(edges, len(hashes)))
        classes = np.minimum(15, np.log2(counts).astype(np.int64)).astype(np.uint8)
        out = np.zeros(cells, np.uint8)
        some = classes > 0
        places = (hashes[edges[some]] - base) // (width // cells)
        np.maximum.at(out, places, classes[some])
        return pa.table(
            {
                "part": pa.array([part], pa.int32()),
                "cells": pa.array([zstandard.ZstdCompressor(level=3).compress(out.tobytes())], pa.binary()),
            }
        )

    return count


def frequency_sketch(docs: DataFrame) -> dict[int, bytes]:
    """Compressed cells by hash range: 2 ** CELL_BITS frequency classes in all, a fixed bound.

    Every distinct set counts once in a task, so frequencies are those of texts, and each cell
    holds the class (log2) of the commonest of its hashes. A cell of class 0 proves that no two
    different sets share a hash of it. Hashes travel sorted, as packed differences.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(1 << 16, max(64, 1 << (partitions - 1).bit_length()))
    blobs = docs.select("text").mapInArrow(_gather(ranges), "part int, blob binary")
    cells = blobs.groupBy("part").applyInArrow(_classes(ranges), "part int, cells binary")
    return {row.part: bytes(row.cells) for row in cells.collect()} | {-1: ranges}


class Cells:
    """The sketch in a worker: two classes a byte, the even cell in the low half."""

    def __init__(self, sketch: dict):
        ranges = sketch[-1]
        each = (1 << CELL_BITS) // ranges
        self.pairs = np.zeros(1 << CELL_BITS - 1, np.uint8)
        for part, blob in sketch.items():
            if part >= 0:
                cells = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
                half = part * each // 2
                self.pairs[half : half + each // 2] = cells[::2] | cells[1::2] << 4

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """The frequency class of each hash."""
        at = hashes >> np.uint64(HASH_BITS - CELL_BITS)
        odd = (at & np.uint64(1)).astype(np.uint8)
        return self.pairs[at >> np.uint64(1)] >> (odd << 2) & 15


# --- Prefixes ------------------------------------------------------------------------------


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n must share with any similar set."""
    return -(-percent * n // 100)


def adaptive_prefix(
    hashes: np.ndarray, classes: np.ndarray, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashes, levels, matches) of the prefix with the least estimated cost.

    ``matches`` is the number of shared shingles that a candidate needs, and a shingle's level
    the shortest extension whose prefix it is in. The cost of l counts the postings that the
    prefix meets, and of verifications at most one for every l of them.
    """
    n = len(hashes)
    least = least_overlap(n, percent)
    order = np.lexsort((hashes, classes))[: n - least + MOST_MATCHES]
    met = np.cumsum((1 << classes[order].astype(np.int64)) - 1)
    shortest = n - least + 1
    choices = range(1, min(MOST_MATCHES, least) + 1)
    costs = [met[shortest + l - 2] * (1.0 + VERIFY_COST / l) for l in choices]
    matches = 1 + int(np.argmin(costs))
    kept = order[: shortest + matches - 1]
    levels = np.maximum(1, np.arange(len(kept)) - shortest + 2)
    shared = classes[kept] > 0  # Others are in no other set.
    return hashes[kept[shared]], levels[shared], matches


def _post(sketch, percent: int):
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, seen = Cells(sketch.value), Seen()
        for batch in batches:
            ids = batch["doc_id"]
            keys, sizes = [], []
            own_h, own_level, own_key, own_n, own_matches = [], [], [], [], []
            for _, hashes in _sets(texts(batch["text"])):
                n = len(hashes)
                key = set_key(hashes) if n else None
                keys.append(key)
                sizes.append(n)
                if n and seen.new(key):
                    classes = cells.of(hashes)
                    found, levels, matches = adaptive_prefix(hashes, classes, percent)
                    own_h.append(found)
                    own_level.append(levels)
                    own_key.append(np.full(len(found), key, np.int64))
                    own_n.append(np.full(len(found), n, np.int64))
                    own_matches.append(np.full(len(found), matches, np.int64))
            rows = len(keys)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(keys, pa.int64()), pa.array(sizes, pa.int32())]
                + [pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32())],
                POSTED,
            )
            if own_h and sum(map(len, own_h)):
                h = np.concatenate(own_h).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(len(h), ids.type),
                        pa.array(np.concatenate(own_key), pa.int64()),
                        pa.array(np.concatenate(own_n), pa.int32()),
                        pa.array(h, pa.int64()),
                        pa.array(np.concatenate(own_level), pa.int32()),
                        pa.array(np.concatenate(own_matches), pa.int32()),
                    ],
                    POSTED,
                )

    return post


POSTED = ["doc_id", "key", "n", "h", "level", "matches"]


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last in slices([len(raw) for raw in texts(batch["text"])], BYTES_A_SLICE):
            found = [h for _, h in _sets(texts(batch["text"].slice(first, last - first))) if len(h)]
            yield pa.RecordBatch.from_pydict(
                {
                    "key": pa.array([set_key(h) for h in found], pa.int64()),
                    "hashes": pa.array([h.astype(np.int64) for h in found], pa.list_(pa.int64())),
                }
            )


# --- Links and components ------------------------------------------------------------------


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough; keys that differ, any order."""
    left = sets.select(F.col("key").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("hashes").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    near = 100 * F.least(F.size("x"), F.size("y")) >= percent * F.greatest(F.size("x"), F.size("y"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(near)
        .where(100 * both >= percent * (F.size("x") + F.size("y") - both))
        .select("a", "b")
    )


def _compare(percent: int):
    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            sides = []
            for table in (left, right):
                rows = table["hashes"].combine_chunks()
                sizes = np.diff(rows.offsets.to_numpy())
                sides.append((rows.flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes), sizes))
            (x, x_row, x_size), (y, y_row, y_size) = sides
            both = np.intersect1d(x, y)
            shared = np.zeros((len(x_size), len(y_size)), np.int64)
            for first in range(0, len(both), CHUNK):
                part = both[first : first + CHUNK]
                marks = []
                for values, row, sizes in sides:
                    at = np.searchsorted(part, values)
                    hit = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == values)
                    mark = np.zeros((len(sizes), len(part)), np.float32)
                    mark[row[hit], at[hit]] = 1
                    marks.append(mark)
                shared += (marks[0] @ marks[1].T).astype(np.int64)
            total = x_size[:, None] + y_size[None, :]
            other = left["root"].to_numpy()[:, None] != right["root"].to_numpy()[None, :]
            near = other & (100 * shared >= percent * (total - shared))
            i, j = np.nonzero(near)
            a, b = left["key"].to_numpy()[i], right["key"].to_numpy()[j]
        return pa.table(
            {
                "a": pa.array(np.minimum(a, b), pa.int64()),
                "b": pa.array(np.maximum(a, b), pa.int64()),
            }
        )

    return compare


def within_clusters(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between nodes of one cluster (nodes that have the same leader) in different trees.

    Near copies share nearly all their prefixes, whether or not they are near enough to link, so
    no prefix tells their pairs apart. The nodes outside the cluster's largest tree are compared
    with its nodes in blocks of bounded size; a block's pairs stay in its task, only links leave.
    """
    trees = members.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = kept_table(
        trees.groupBy("cluster").agg(
            F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("main"),
            F.count(F.lit(1)).alias("trees"),
        ).where("trees > 1").select(
            "cluster", F.col("main.root").alias("main"),
            F.ceil(F.col("n") / BLOCK).cast("int").alias("right_blocks"),
            F.ceil((F.col("n") - F.col("main.n")) / BLOCK).cast("int").alias("left_blocks"),
        ),
        "mixed-clusters",
    )
    own = members.join(mixed, "cluster")

    def block(n: str):
        return F.pmod(F.xxhash64("key"), F.col(n)).cast("int")

    def each(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = own.where("root <> main").select(
        "cluster", "key", "root", block("left_blocks").alias("i"), each("right_blocks").alias("j")
    )
    right = own.select(
        "cluster", "key", "root", each("left_blocks").alias("i"), block("right_blocks").alias("j")
    )
    keys = ("cluster", "i", "j")
    left, right = (side.join(sets, "key") for side in (left, right))
    left, right = (side.toDF(*side.columns) for side in (left, right))
    return (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(_compare(percent), "a long, b long")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(key, root) of every linked node, by alternating large and small stars until stable.

    Each round replaces links by links to the smallest neighbour, which at least halves long
    paths; the links of a round are a written table, so no lineage grows and nothing is gathered.
    """
    edges = kept_table(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # The node itself goes to its smallest neighbour as well.
        edges = kept_table(
            small.union(below.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
            "links",
        )
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("s")
        ).first()
        if state == before:
            break
        before = state
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("key"), "root")
    return roots.union(edges.select(F.col("v").alias("key"), F.col("v").alias("root")).distinct())


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """Per row doc_id, n_shingles and component_id.

    Sets are those of distinct shingles of ``WORDS`` words; two link if 100 * shared is at least
    ``percent`` * all. The component id is the smallest doc_id that links reach. A null or empty
    text has no shingles and is a component of its own; a null id takes the smallest id of its
    component, null if there is none; repeated rows are equal sets; other columns are ignored;
    an empty table gives no rows. Hashes have 48 bits and set keys 64: a false meeting needs a
    collision of both sizes and hashes.

    Nothing grows on the driver: the frequency sketch has a fixed size. Texts are read twice,
    and those of sets that share a prefix shingle with another a third time.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    sketch = spark.sparkContext.broadcast(frequency_sketch(rows))
    posted = kept_table(
        rows.mapInArrow(
            _post(sketch, percent),
            f"doc_id {kind}, key long, n int, h long, level int, matches int",
        ),
        "postings",
    )
    own = posted.where("h is null").select("doc_id", "key", "n")
    nodes = own.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("rep"))
    postings = posted.where("h is not null").select("h", "key", "n", "level", "matches").distinct()
    lists = postings.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = kept_table(postings.join(lists, "h"), "lists")
    wanted = met.select("key").distinct().join(nodes, "key").select(F.col("rep").alias("_rep"))
    sources = rows.join(
        sized_broadcast(kept_table(wanted, "wanted")), F.col("doc_id").eqNullSafe(F.col("_rep"))
    )
    sets = kept_table(
        sources.select("text").mapInArrow(_whole_sets, "key long, hashes array<long>"), "sets"
    )

    # Near copies are often closer to what they were made from than to each other, and that
    # text is in the most and longest lists: it leads each of its lists, or else the first key.
    weight = met.groupBy("key").agg(F.sum("size").alias("weight"))
    heads = met.select("h", "key").join(weight, "key").groupBy("h").agg(
        F.max(F.struct("weight", "key")).alias("central"), F.min("key").alias("low")
    )
    leaders = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("central.key").alias("leader")), F.struct(F.lit(1).alias("side"), F.col("low").alias("leader"))))
    ends = met.select("h", "key").join(heads.select("h", leaders.alias("x")), "h").select("key", "x.*")
    shared = (
        ends.where("leader <> key")
        .groupBy("side", "leader", "key")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    # One proposal per side and node: the leader that shares most of its lists.
    best = shared.groupBy("key", "side").agg(F.max(F.struct("c", "leader")).alias("x"))
    stars = best.select(
        F.least("x.leader", "key").alias("a"), F.greatest("x.leader", "key").alias("b")
    ).distinct()
    first = kept_table(verified(stars, sets, percent).distinct(), "star-links")

    roots = kept_table(components(first), "star-roots")
    led = best.where("side = 0").select("key", F.col("x.leader").alias("cluster"))
    placed = kept_table(
        met.join(roots, "key", "left").join(led, "key", "left").select(
            "h", "key", "n", "level", "matches",
            F.coalesce("root", "key").alias("root"), F.coalesce("cluster", "key").alias("cluster"),
        ),
        "placed",
    )
    mixed = placed.groupBy("h").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s")
    left = kept_table(
        placed.join(mixed.select("h"), "h").select("h", "key", "n", "level", "matches", "root", "cluster"),
        "mixed-lists",
    )
    sides = ("key", "n", "level", "matches", "root", "cluster")
    x = left.select("h", *(F.col(c).alias(f"{c}_a") for c in sides))
    y = left.select("h", *(F.col(c).alias(f"{c}_b") for c in sides))
    need = F.least("matches_a", "matches_b")
    pairs = (
        x.join(y, "h")
        .where("root_a < root_b and cluster_a <> cluster_b")
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .where((F.col("level_a") <= need) & (F.col("level_b") <= need))
        .groupBy(F.col("key_a").alias("a"), F.col("key_b").alias("b"))
        .agg(F.count(F.lit(1)).alias("c"), F.max(need).alias("need"))
        .where("c >= need")
        .select("a", "b")
    )
    second = kept_table(verified(pairs, sets, percent).distinct(), "other-links")

    third = kept_table(
        within_clusters(placed.select("key", "root", "cluster").distinct(), sets, percent),
        "cluster-links",
    )

    links = first.union(second).union(third)
    found = components(links).join(nodes, "key")
    least = found.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = kept_table(
        nodes.join(found.select("key", "root").join(least, "root"), "key", "left").select(
            "key", F.coalesce("component_id", "rep").alias("component_id")
        ),
        "classes",
    )
    whole = own.where("key is not null").join(classes, "key")
    empty = own.where("key is null").select(
        "key", "doc_id", "n", F.col("doc_id").alias("component_id")
    )
    return whole.unionByName(empty).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: one row of each component stays.

    It is the one with the smallest id (null last), and of equal ids the one written first. Rows
    are written once, with a number, and compared by it: ids may be null, or stand on several
    texts. A null or empty text is like no other and stays. Numbers of rows to go are broadcast
    only if counted to be few, else joined.
    """
    number = free_name(docs, "number")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    docs = kept_table(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = kept_table(near_duplicates(docs, number, text_col), "components")
    several = (
        found.groupBy("component_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    )
    members = kept_table(
        found.select(F.col("doc_id").alias("row"), "component_id")
        .join(sized_broadcast(kept_table(several.select("component_id"), "several")), "component_id")
        .join(docs.select(F.col(number).alias("row"), F.col(id_col).alias("id")), "row"),
        "members",
    )
    best = members.groupBy("component_id").agg(
        F.min(F.struct(F.col("id").isNull().alias("without"), "id", "row")).alias("best")
    )
    gone = kept_table(
        members.join(best, "component_id").where("row <> best.row").select(F.col("row").alias("_gone")),
        "gone",
    )
    kept = docs.join(sized_broadcast(gone), F.col(number) == F.col("_gone"), "left_anti")
    return kept.select(*columns)
