"""Mixing sources to target weights by hierarchical budgeting.

A token budget runs down a tree of domains, languages and sources. Siblings share what their
parent has by weight; one that has fewer tokens than its share leaves the rest to its siblings,
and only what all of them cannot take goes to the parent's siblings. Each leaf's budget is read
as a prefix of its documents in seeded order, epoch after epoch. DataFrame functions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.llm.common import free_name, kept_table
from feedloom.operators.joins import sized_broadcast

LEVELS = ("domain", "language", "origin")
#: Bits of the order hash, and bits that each of the two bucket levels takes off its top.
HASH_BITS, BUCKET_BITS = 60, 10
LAST = (1 << 63) - 1
DECIMAL = "decimal(38,0)"


def n_words(text: Column) -> Column:
    """Tokens of a text: its words, as the budget counts them."""
    return F.coalesce(
        F.regexp_count(text, F.lit("[^ \\t\\n\\x0B\\f\\r]+")).cast("long"), F.lit(0).cast("long")
    )


def order_hash(seed: int, epoch: Column, doc_id: Column, digest: Column) -> Column:
    """60 bits that place a document in its leaf's order of an epoch."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), digest.cast("string"), doc_id)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def turn(number: Column) -> Column:
    """As many bits that place a row among rows with equal order hashes."""
    return F.xxhash64(number).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _weight(level: Column, weights: dict[str, int]) -> Column:
    out = F.lit(None).cast("long")
    for value, weight in weights.items():
        if weight <= 0:
            raise ValueError(f"the weight of {value!r} must be positive")
        out = F.when(level.eqNullSafe(F.lit(value)), F.lit(weight).cast("long")).otherwise(out)
    return F.coalesce(out, F.lit(1).cast("long"))


def _same(left: list[str], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def share_out(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Integer shares of each parent's ``budget`` for its children, none above its ``capacity``.

    Siblings are taken by capacity a weight; one is full if the level that all from it upwards
    could reach covers its capacity. The others divide the rest by weight; units left by
    rounding go one each in the order of names.
    """
    family = Window.partitionBy(*(parent or [F.lit(0)]))
    order = family.orderBy(F.col("capacity") / F.col("weight"), F.col(name))
    exact = {c: F.col(c).cast(DECIMAL) for c in ("capacity", "weight", "budget")}
    before = F.coalesce(
        F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).cast(DECIMAL)
    from_here = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast(DECIMAL)
    full = children.withColumns({"_before": before, "_weights": from_here}).withColumn(
        "_full",
        exact["capacity"] * F.col("_weights") <= exact["weight"] * (exact["budget"] - F.col("_before")),
    )
    left = full.withColumns(
        {
            "_rest": F.col("budget")
            - F.coalesce(F.sum(F.when(F.col("_full"), F.col("capacity"))).over(family), F.lit(0)),
            "_open": F.sum(F.when(~F.col("_full"), F.col("weight"))).over(family),
        }
    ).withColumn(
        "_base",
        F.when(F.col("_full"), F.col("capacity")).otherwise(
            F.floor(
                F.col("_rest").cast("decimal(20,0)") * F.col("weight").cast("decimal(10,0)")
                / F.col("_open").cast("decimal(18,0)")
            ).cast("long")
        ),
    )
    counted = left.withColumns(
        {
            "_over": F.col("budget") - F.sum("_base").over(family),
            "_turn": F.row_number().over(family.orderBy("_full", name)),
        }
    )
    share = F.col("_base") + F.when(
        ~F.col("_full") & (F.col("_turn") <= F.col("_over")), F.lit(1)
    ).otherwise(F.lit(0))
    return counted.select(*parent, name, share.cast("long").alias("budget"))


def leaf_budgets(
    leaves: DataFrame, budget: int, weights: dict[str, dict[str, int]], max_epochs: int
) -> DataFrame:
    """The leaves with their budgets; ``leaves`` has the three levels and ``available``."""
    sized = leaves.withColumn("capacity", F.col("available") * F.lit(max_epochs).cast("long"))
    parents = None
    for depth, name in enumerate(LEVELS):
        path = list(LEVELS[:depth])
        nodes = sized.groupBy(*path, name).agg(F.sum("capacity").alias("capacity"))
        nodes = nodes.withColumn("weight", _weight(F.col(name), weights.get(name, {})))
        if parents is None:
            whole = Window.partitionBy(F.lit(0))
            had = nodes.withColumn(
                "budget", F.least(F.lit(budget).cast("long"), F.sum("capacity").over(whole))
            )
        else:
            renamed = parents.select(*(F.col(c).alias(f"_{c}") for c in path), "budget")
            had = nodes.join(renamed, _same(path, [f"_{c}" for c in path])).drop(
                *(f"_{c}" for c in path)
            )
        parents = share_out(had, path, name)
    out = parents.select(*(F.col(c).alias(f"_{c}") for c in LEVELS), "budget")
    return leaves.join(out, _same(list(LEVELS), [f"_{c}" for c in LEVELS])).drop(
        *(f"_{c}" for c in LEVELS)
    )


def _boundary(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """Per leaf the first ``key`` with which its rest is used up, and the rest that is left for it."""
    sums = rows.groupBy(*LEVELS, key.alias(name)).agg(
        F.sum("n_tokens").alias("_sum"), F.min("_left").alias("_had")
    )
    order = Window.partitionBy(*LEVELS).orderBy(name)
    placed = sums.withColumn("_upto", F.sum("_sum").over(order)).where(
        F.col("_upto") > F.col("_had")
    )
    first = placed.groupBy(*LEVELS).agg(
        F.min(F.struct(name, (F.col("_had") - F.col("_upto") + F.col("_sum")).alias("_left"))).alias("x")
    )
    return kept_table(
        first.select(*(F.col(c).alias(f"_{c}") for c in LEVELS), f"x.{name}", "x._left"), "boundaries"
    )


def _inside(rows: DataFrame, key: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """The boundary by ``key``, and the rows whose key it is with what is left for them."""
    ends = _boundary(rows, key, name)
    within = _joined(rows.drop("_left"), ends).where(key == F.col(name)).drop(name)
    return kept_table(within, "boundary-rows"), ends


def _joined(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with what their leaf has; a counted, small side is broadcast, another is shuffled."""
    names = [f"_{c}" for c in LEVELS]
    return rows.join(sized_broadcast(side), _same(list(LEVELS), names), how).drop(*names)


def cutoffs(rows: DataFrame, leaves: DataFrame, seed: int) -> DataFrame:
    """Per leaf its full epochs and the last (hash, turn) that it takes in the epoch after them.

    A leaf, an id, or a text may hold a third of all documents, so a prefix is not summed in one
    task. Sums of 1,024 buckets of the hash find the bucket in which the rest ends, sums of 1,024
    parts of it the part, and sums of that part's hashes, about a millionth, the hash. Rows that
    share it are taken in the order of their turns, whose buckets and parts are found alike.
    """
    full = F.floor(F.col("budget") / F.greatest(F.col("available"), F.lit(1))).cast("long")
    plan = leaves.withColumn("full", full).withColumn(
        "_left", F.col("budget") - F.col("full") * F.col("available")
    )
    sides = plan.select(*(F.col(c).alias(f"_{c}") for c in LEVELS), "full", "_left")
    hashed = (
        _joined(rows, sides)
        .withColumn("_h", order_hash(seed, F.col("full"), F.col("id"), F.col("digest")))
        .withColumn("_t", turn(F.col("number")))
    )
    top, part = HASH_BITS - BUCKET_BITS, HASH_BITS - 2 * BUCKET_BITS
    within, _ = _inside(hashed, F.shiftright("_h", top), "_b1")
    within, _ = _inside(within, F.shiftright("_h", part), "_b2")
    within, hashes = _inside(within, F.col("_h"), "_cut")
    within, _ = _inside(within, F.shiftright("_t", top), "_b3")
    within, parts = _inside(within, F.shiftright("_t", part), "_b4")
    taken = (
        within.withColumn("_upto", F.sum("n_tokens").over(Window.partitionBy(*LEVELS).orderBy("_t")))
        .where(F.col("_upto") <= F.col("_left"))
        .groupBy(*LEVELS)
        .agg(F.max("_t").alias("_last"))
    )
    below = F.shiftleft(F.col("_b4"), part) - 1
    names = [f"_{c}" for c in LEVELS]
    ends = (
        hashes.select(*names, F.col("_cut").alias("cut_hash"))
        .join(parts.select(*(F.col(n).alias(f"_{n}") for n in names), "_b4"),
              _same(names, [f"_{n}" for n in names]))
        .join(taken, _same(names, list(LEVELS)), "left")
        .select(*names, "cut_hash", F.coalesce("_last", below).alias("cut_turn"))
    )
    return (
        plan.join(ends, _same(list(LEVELS), names), "left")
        .select(
            *LEVELS, "available", "budget", "full",
            # A rest of nothing begins no further epoch, not even for texts without tokens.
            F.when(F.col("_left") == 0, -1).otherwise(F.coalesce("cut_hash", F.lit(LAST)))
            .alias("cut_hash"),
            F.coalesce("cut_turn", F.lit(LAST)).alias("cut_turn"),
        )
    )


def mixed(
    docs: DataFrame,
    levels: tuple[Column, Column, Column],
    weights: dict[str, dict[str, int]],
    budget_percent: int,
    max_epochs: int = 1,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every taken row as ``row`` (all its columns), its path, ``n_tokens`` and ``epochs``.

    The budget is ``budget_percent`` of all tokens, at most ``max_epochs`` times what a leaf has.
    ``epochs`` says how often the row is read: the leaf's full epochs, and once more if it lies in
    the prefix of the next. A null level is a node of its own; a null or empty text has no
    tokens; ids of any type, null and repeated ones too, and repeated rows each have their place;
    other columns may have any name; an empty table
    gives no rows. Rows are written once, with a number: what is equal in id and text is parted
    by it, so that a prefix can end among rows without id, or among copies of one row.
    """
    number = free_name(docs, "number")
    columns = docs.columns
    docs = kept_table(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    doc_id, text = F.col(id_col).cast("string"), F.col(text_col).cast("string")
    path = [level.cast("string").alias(name) for level, name in zip(levels, LEVELS)]
    narrow = kept_table(
        docs.select(
            *path,
            doc_id.alias("id"),
            F.xxhash64(text).alias("digest"),
            F.col(number).alias("number"),
            n_words(text).alias("n_tokens"),
        ),
        "tokens",
    )
    leaves = kept_table(
        narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available")), "leaves"
    )
    total = leaves.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("n")).first().n
    budget = total * budget_percent // 100
    shared = kept_table(leaf_budgets(leaves, budget, weights, max_epochs), "leaf-budgets")
    ends = kept_table(cutoffs(narrow, shared, seed), "cutoffs")
    side = ends.select(*(F.col(c).alias(f"_{c}") for c in LEVELS), "full", "cut_hash", "cut_turn")
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
        F.col(number).alias("_number"),
        *path,
    )
    found = _joined(packed, side)
    own, text = F.col("row").getField(id_col), F.col("row").getField(text_col).cast("string")
    place = order_hash(seed, F.col("full"), own.cast("string"), F.xxhash64(text))
    chosen = (F.col("_place") < F.col("cut_hash")) | (
        (F.col("_place") == F.col("cut_hash")) & (turn(F.col("_number")) <= F.col("cut_turn"))
    )
    return (
        found.withColumn("_place", place)
        .withColumn("epochs", F.col("full") + F.when(chosen, 1).otherwise(0))
        .where("epochs > 0")
        .select("row", *LEVELS, n_words(text).alias("n_tokens"), F.col("epochs").cast("int").alias("epochs"))
    )
