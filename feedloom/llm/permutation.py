"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order in which it sees a fixed set of pivots, nearest first. It
is posted in the inverted files of its nearest pivots; a query visits those of its own, ranks
what it finds by the footrule distance of the two orders, and reranks the front by inner product.

Vectors are cut into slices by a hash of their ids. A task makes the orders and the inverted files
of a slice itself, so a vector is sent once whatever the number of its files, and a query once a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.llm.common import kept_table

#: Pivots at most (a rank is a byte), inverted files of a vector and of a query.
PIVOTS, POSTS, PROBES = 256, 8, 32
#: Vectors a pivot, while there are fewer than would fill all pivots.
A_PIVOT = 16
#: Of a visited block, this share by footrule is reranked, and never fewer than 4 k.
RERANKED = 0.25
#: Entries of a slice in one inverted file, on average: a block.
BLOCK = 1024
#: Queries that meet a slice at a time, and vectors whose ranks stay in the processor's cache.
QUERIES, STRIP = 128, 1024
#: Slices that a task takes one after the other, at most, and tasks a core while there are enough.
SLICES, TASKS = 8, 2


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, no null or non-finite component, not all zero."""
    ok = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & ok & F.exists(vector, lambda x: x != 0)


def orders(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pivots by nearness to each vector, and the rank of each pivot, a vector a row."""
    order = np.empty((len(vectors), len(pivots)), np.uint8)
    ranks = np.empty_like(order)
    for at in range(0, len(vectors), STRIP):
        seen = np.argsort(-(vectors[at : at + STRIP] @ pivots.T), axis=1, kind="stable")
        order[at : at + STRIP] = seen
        places = np.arange(len(pivots), dtype=np.uint8)[None, :]
        np.put_along_axis(ranks[at : at + STRIP], seen, places, axis=1)
    return order, ranks


def footrules(ranks: np.ndarray, seen: np.ndarray, room: np.ndarray | None = None) -> np.ndarray:
    """Footrule distances of orders (a pivot a row) from one; of 256 places it is 2 ** 15 at most.

    Two orders have the same ranks, so what they are apart follows from the smaller rank of each pivot.
    """
    less = np.minimum(ranks, seen[:, None], out=room)
    both = len(seen) * (len(seen) - 1)
    return np.uint16(both) - 2 * np.add.reduce(less, axis=0, dtype=np.uint16)


class _Slice:
    """Vectors of a slice in the order of their ids, with their ranks and inverted files."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, pivots: np.ndarray, posts: int):
        self.ids, self.values = ids, values
        order, ranks = orders(values, pivots)
        # A pivot a row: distances are summed over whole rows.
        self.strips = [
            np.ascontiguousarray(ranks[at : at + STRIP].T.astype(np.uint16))
            for at in range(0, len(ids), STRIP)
        ]
        near = order[:, :posts].ravel()
        entries = np.argsort(near, kind="stable")
        ends = np.searchsorted(near[entries], np.arange(len(pivots) + 1))
        self.files = [entries[a:b] // posts for a, b in zip(ends, ends[1:])]
        self.longest = math.sqrt((values * values).sum(axis=1).max())

    def fronts(self, ranks: np.ndarray, near: np.ndarray, least: int, reranked: float) -> np.ndarray:
        """Which vectors each query (a row) reranks: the front of every file it visits."""
        apart = np.empty((len(ranks), len(self.ids)), np.uint16)
        for strip, at in zip(self.strips, range(0, len(self.ids), STRIP)):
            room = np.empty_like(strip)
            for q, seen in enumerate(ranks):
                apart[q, at : at + STRIP] = footrules(strip, seen, room)
        chosen = np.zeros(apart.shape, bool)
        visits = np.zeros((len(ranks), len(self.files)), bool)
        np.put_along_axis(visits, near.astype(np.int64), True, axis=1)
        for pivot, held in enumerate(self.files):
            askers = np.flatnonzero(visits[:, pivot])
            if not len(askers) or not len(held):
                continue
            # The query's own row is at distance 0; one place more makes up for it.
            front = max(least, math.ceil(len(held) * reranked)) + 1
            if front < len(held):
                # Equal distances go by id: the place in the file is the end of the key.
                key = np.take(apart[askers], held, axis=1).astype(np.uint64) << np.uint64(32)
                key |= np.arange(len(held), dtype=np.uint64)
                places = np.partition(key, front - 1, axis=1)[:, :front] & np.uint64(0xFFFFFFFF)
                chosen[askers[:, None], held[places.astype(np.int64)]] = True
            else:
                chosen[askers[:, None], held] = True
        return chosen

    def best(self, asked: np.ndarray, query: int, chosen: np.ndarray, near: np.ndarray, k: int):
        """Ids and scores of the ``k`` best of ``chosen``; ``near`` has all scores but for rounding."""
        found = np.flatnonzero(chosen)
        found = found[self.ids[found] != query]
        if len(found) > k:
            lost = -near[found]
            doubt = 1e-12 * self.longest * math.sqrt((asked * asked).sum())
            kept = lost <= np.partition(lost, k - 1)[k - 1] + doubt
            found = found[kept] if kept.sum() >= k else found
        scores = (self.values[found] * asked).sum(axis=1)
        first = np.argsort(-scores, kind="stable")[:k]
        return self.ids[found[first]], scores[first]


def _rows(table: pa.Table) -> np.ndarray:
    """Vectors of a table, one a row."""
    flat = table["vec"].combine_chunks().flatten().to_numpy()
    return flat.astype(np.float64).reshape(table.num_rows, -1)


def _search(pivots: np.ndarray, posts: int, probes: int, k: int, reranked: float):
    def search(key, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = queries["vec_id"].to_numpy()
        # The best so far of each query; what is not found yet has the lowest score.
        ids = np.zeros((len(names), k), np.int64)
        scores = np.full((len(names), k), -np.inf)
        held = np.zeros((len(names), k), bool)
        own = vectors["slice"].to_numpy() if len(names) else np.zeros(0, np.int64)
        for number in np.unique(own):
            part = vectors.filter(pa.array(own == number)).sort_by("vec_id")
            one = _Slice(part["vec_id"].to_numpy(), _rows(part), pivots, posts)
            for at in range(0, len(names), QUERIES):
                asked = _rows(queries.slice(at, QUERIES))
                order, ranks = orders(asked, pivots)
                chosen = one.fronts(ranks.astype(np.uint16), order[:, :probes], 4 * k, reranked)
                near = asked @ one.values.T
                for q in range(len(asked)):
                    row = at + q
                    more, found = one.best(asked[q], names[row], chosen[q], near[q], k)
                    more = np.concatenate([ids[row][held[row]], more])
                    found = np.concatenate([scores[row][held[row]], found])
                    first = np.lexsort((more, -found))[:k]
                    ids[row, : len(first)], scores[row, : len(first)] = more[first], found[first]
                    held[row, : len(first)] = True
        return pa.table(
            {
                "query_id": pa.array(np.repeat(names, held.sum(axis=1)), pa.int64()),
                "vec_id": pa.array(ids[held], pa.int64()),
                "score": pa.array(scores[held], pa.float64()),
            }
        )

    return search


def _keys_apart(spark, count: int) -> list[int]:
    """As many numbers, dealt to as many partitions by their hashes: one in each."""
    number = F.col("id").cast("int")
    dealt = spark.range(32 * count).groupBy(F.pmod(F.hash(number), F.lit(count)).alias("at"))
    keys = [row.key for row in dealt.agg(F.min(number).alias("key")).collect()]
    # A partition that no number has hit stays empty.
    return keys + list(range(32 * count, 33 * count - len(keys)))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    pivots: int = PIVOTS,
    posts: int = POSTS,
    probes: int = PROBES,
    reranked: float = RERANKED,
) -> DataFrame:
    """The k nearest found of each query: query_id, rank, vec_id, score (largest inner product).

    Pivots are the vectors with the smallest hashes of their ids: a bounded sample that every
    row is indexed by. Vectors that are null, zero or hold null or non-finite components take no
    part, nor do rows without id or of another length than most; of rows that share an id the
    smallest vector counts; equal scores go by id; other columns are ignored; too few vectors
    give all there are, none give no rows. Inverted files are cut along the slices into blocks,
    each searched by itself; a slice is bounded, and so is what a task holds.
    """
    spark = vectors.sparkSession
    # Singles stay singles: half the bytes.
    single = isinstance(getattr(vectors.schema[vec_col].dataType, "elementType", None), T.FloatType)
    vec = F.col(vec_col).cast(f"array<{'float' if single else 'double'}>")
    clean = vectors.where(F.col(id_col).isNotNull() & usable(vec)).select(
        F.col(id_col).cast("long").alias("vec_id"), vec.alias("vec"), is_query.alias("query")
    )
    sizes = clean.groupBy(F.size("vec").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    top = sizes.orderBy(F.desc("c"), "n").first()
    if top is None:
        return spark.createDataFrame([], RESULT)
    kept = kept_table(
        clean.where(F.size("vec") == top.n)
        .groupBy("vec_id")
        .agg(F.min("vec").alias("vec"), F.max("query").alias("query")),
        "vectors",
    )
    count = max(1, min(pivots, top.c // A_PIVOT))
    sample = kept.select("vec", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * count)
    distinct = list(dict.fromkeys(tuple(row.vec) for row in sample.collect()))[:count]
    count = len(distinct)
    posts, probes = min(posts, count), min(probes, count)
    slices = -(-kept.count() // (BLOCK * count // posts))
    wanted = TASKS * spark.sparkContext.defaultParallelism
    parts = min(slices, max(wanted, -(-slices // SLICES)))
    # Fewer slices than tasks meet the queries in turns: a slice is sent once a turn.
    turns = min(-(-wanted // parts), max(1, kept.where("query").count() // QUERIES))

    def dealt(salt: int, most: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(most))

    def each(most: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(most - 1)))

    keys = F.array(*(F.lit(key) for key in _keys_apart(spark, parts * turns)))
    part = F.get(keys, (F.col("part") * turns + F.col("turn")).cast("int")).alias("part")
    posted = kept.select("vec_id", "vec", dealt(1, slices).alias("slice"), each(turns).alias("turn"))
    posted = posted.withColumn("part", F.col("slice") % parts).select("vec_id", "vec", "slice", part)
    sought = kept.where("query").select(
        "vec_id", "vec", dealt(2, turns).alias("turn"), each(parts).alias("part")
    ).select("vec_id", "vec", part)
    found = (
        posted.repartition(parts * turns, "part")
        .groupBy("part")
        .cogroup(sought.repartition(parts * turns, "part").groupBy("part"))
        .applyInArrow(
            _search(np.array(distinct), posts, probes, k, reranked),
            "query_id long, vec_id long, score double",
        )
    )
    # A vector meets a query once; each query's rows are few, so one task may rank them.
    best = (
        found.repartition("query_id")
        .groupBy("query_id")
        .agg(
            F.slice(
                F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k
            ).alias("x")
        )
    )
    return best.select("query_id", F.posexplode("x").alias("rank", "y")).select(
        "query_id",
        (F.col("rank") + 1).cast("int").alias("rank"),
        F.col("y.vec_id").alias("vec_id"),
        (-F.col("y.s")).alias("score"),
    )


RESULT = "query_id long, rank int, vec_id long, score double"
