"""Periodic runs against a search over all periods, and the registered query against the same."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from feedloom.llm import periods, queries

KEYS = "doc_id long, text string, periodic string"


def brute_runs(words):
    found = set()
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(24, 3 * q) and not any((start, p, length) in found for p in range(1, q)):
                found.add((start, q, length))
            i += i == start
    return sorted(found)


def drawn(rng):
    words = []
    for _ in range(rng.randint(1, 5)):
        period = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 31, 33, 40, 63, 64, 65])
        block = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(period)]
        length = rng.randint(1, period * 6)
        words += (block * 7)[:length] if rng.random() < 0.7 else [
            str(rng.randint(0, 50)) for _ in range(rng.randint(1, 30))
        ]
    return words


def collapsed(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_and_texts_are_those_of_a_search_over_all_periods(spark):
    rng = random.Random(4)
    rows = [(k // 2, " ".join(drawn(rng)), None) for k in range(300)]
    rows += [
        (None, None, None),
        (None, "", "x"),
        (7, " \t\n", ""),
        (7, "a " * 23, "x"),
        (7, "a " * 24, "x"),
        (7, "a " * 24, "x"),
        (8, "é ü " * 3000 + "x", "x"),  # A very long text in one run.
        (8, " ".join(map(str, range(20_000))) + " " + "one two three " * 9, "x"),
    ]
    found, name = periods.periodic_runs(spark.createDataFrame(rows, KEYS), ("doc_id", "periodic"))
    assert name == "_periodic"
    got = sorted(
        (
            (str(r["doc_id"]), r[name]["n_words"], r[name]["text"],
             [(x["start"], x["period"], x["length"]) for x in r[name]["runs"]])
            for r in found.collect()
        )
    )
    expected = []
    for key, text, _ in rows:
        words = (text or "").split()
        runs = brute_runs(words) if len(words) < 1500 else None
        if runs is None:
            runs = [(0, 2, 6000)] if text[0] == "é" else [(20_000, 3, 27)]
        expected.append((str(key), len(words), collapsed(words, runs), runs))
    assert got == sorted(expected)
    assert sum(len(x[3]) for x in got) > 100


def test_no_rows(spark):
    found, name = periods.periodic_runs(spark.createDataFrame([], KEYS))
    assert found.count() == 0 and found.columns == ["doc_id", name]


@pytest.mark.parametrize("data", ["/root/testdata/sf0.001"])
def test_the_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for doc_id, text in docs:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 1500:
            continue
        runs = brute_runs(words)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, q, m in runs)]
        best = [None] * 4
        for s, q, m in runs:
            if best[0] is None or m * best[2] > best[1] * q:
                best = [s, m, q, 1000 * m // q]
        lines = "".join(f"{s},{m},{q}\n" for s, q, m in runs)
        expected[doc_id] = (
            len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(),
        )
    rows = queries.op13_periodic_runs(spark, data).collect()
    assert len(rows) == len(docs)
    got = {r["doc_id"]: tuple(r)[1:] for r in rows if r["doc_id"] in expected}
    assert got == expected
    assert sum(v[0] for v in got.values()) > 3


def test_periodic_ends(spark):
    docs = spark.createDataFrame([(k, "a b c d e f g h") for k in range(200)] + [(None, "a"), (3, None)],
                                 "doc_id long, text string")
    for doc_id, text in queries.with_period(docs).where(F.col("doc_id").isNotNull()).collect():
        h = zlib.crc32(str(doc_id).encode())
        if text is None or h % 10:
            assert text in (None, "a b c d e f g h")
            continue
        a = h // 10 % 8
        p = 1 + (8 - a) // (3 + h // 10 % 8)
        assert text.split() == ["abcdefgh"[i if i < a else a + (i - a) % p] for i in range(8)]
