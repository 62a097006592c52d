"""No text is lost: near duplicates and the mix against brute force, with null and repeated ids."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from feedloom.llm import budget, jaccard


def passage(letter, n=40):
    return " ".join(f"{letter}{k}" for k in range(n))


def test_every_component_keeps_one_row(spark):
    a, b, c, d = map(passage, "abcd")
    rows = [(1, b), (7, a), (7, b + " x"), (9, a), (5, c), (5, d), (None, c), (None, passage("e")),
            (None, passage("e")), (3, ""), (3, ""), (None, None), (2, passage("f")), (None, passage("f"))]
    docs = spark.createDataFrame(
        [(*r, "x", "y") for r in rows], "doc_id long, text string, number string, component_id string"
    )
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    expected = [(1, b), (7, a), (5, c), (5, d), (None, passage("e")), (3, ""), (3, ""), (None, None),
                (2, passage("f"))]
    assert Counter(tuple(r)[:2] for r in kept.collect()) == Counter(expected)


def shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("seed", [1])
def test_components_by_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(12):
        base = [f"{k}w{i}" for i in range(rng.randint(5, 60))]
        for _ in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 3])):
                own[rng.randrange(len(own))] = "changed"
            rows.append((rng.choice([None, k, k, rng.randint(0, 12)]), " ".join(own)))
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i])
    kept = Counter(map(tuple, jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert kept.total() == len(groups)
    least = Counter(min(((r[0] is None, r[0] or 0) for r in g)) for g in groups.values())
    assert Counter((r[0] is None, r[0] or 0) for r in kept.elements()) == least


def expected_rows(rows, shares, seed, max_epochs):
    """By leaf: epochs of each (id, text), as the seeded order says."""
    out = Counter()
    for leaf, share in shares.items():
        own = [r for r in rows if r[2] == leaf]
        available = sum(len((t or "").split()) for _, t, _ in own)
        full = share // max(available, 1)
        left = share - full * available

        def place(r, full=full):
            digest = xxhash.xxh64_intdigest(r[1].encode(), seed=42) if r[1] is not None else 42
            digest -= (digest >> 63) << 64
            parts = [str(seed), str(full), str(digest)] + ([str(r[0])] if r[0] is not None else [])
            return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:15], 16)

        used, open_ = 0, left > 0
        for r in sorted(own, key=place):
            used += len((r[1] or "").split())
            open_ = open_ and used <= left
            if full + open_:
                out[r[0], r[1], full + open_] += 1
    return out


@pytest.mark.parametrize("percent,epochs", [(50, 1), (150, 2)])
@pytest.mark.parametrize("ids", ["null", "one", "some"])
def test_the_prefix_ends_within_hot_ids_and_copies(spark, ids, percent, epochs):
    rng = random.Random(percent)
    make = {"null": lambda k: None, "one": lambda k: "7", "text": lambda k: f"doc-{k}",
            "unique": str, "some": lambda k: rng.choice([None, "1", str(k)])}[ids]
    rows = [(make(k), " ".join(["w"] * rng.randint(0, 9)), rng.choice("ab")) for k in range(60)]
    rows += [(make(0), "a copy of ten words that stands here many times", "a")] * 40
    rows += [(make(1), None, "b"), (make(1), "", "a")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string").repartition(3)
    levels = (F.lit("d"), F.col("lang"), F.lit(None).cast("string"))
    found = budget.mixed(docs, levels, {"language": {"a": 3}}, percent, max_epochs=epochs)
    got = Counter((r.row.doc_id, r.row.text, r.epochs) for r in found.collect())
    total = {x: sum(len((t or "").split()) for _, t, l in rows if l == x) for x in "ab"}
    whole = min(sum(total.values()) * percent // 100, epochs * sum(total.values()))
    # Two siblings of weights 3 and 1; what one cannot take goes to the other.
    b = whole - whole * 3 // 4 if whole * 3 // 4 <= epochs * total["a"] else whole - epochs * total["a"]
    b = min(b, epochs * total["b"])
    expected = [expected_rows(rows, {"a": whole - b + d, "b": b - d}, 7, epochs) for d in (0, 1)]
    assert got in expected
