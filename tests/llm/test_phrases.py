"""Collocations against plain counting; filters and permutations against their inverses."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from feedloom.llm import phrases

COLUMNS = "doc_id long, text string, lang string, ids string, word string"


def brute(rows, least, most):
    totals, counts = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = set()
    for lang, f in counts.items():
        often = {g: c for g, c in f.items() if c >= least and len(g) > 1}
        inside = defaultdict(int)
        for g, c in often.items():
            for n in range(2, len(g)):
                for i in range(len(g) - n + 1):
                    inside[g[i : i + n]] = max(inside[g[i : i + n]], c)
        found = []
        for g, a in often.items():
            if 100 * inside[g] >= 80 * a:
                continue
            score, _, l, r = min(
                (2000000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]])
                for k in range(1, len(g))
            )
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return out


def drawn(seed, n=400):
    rng = random.Random(seed)
    words = ["The", "of", "é", "new", "york", "a.b", "x;y", "\x1fodd", "und", "\ttab", "big", "data", "Z"]
    weights = [9, 8, 4, 4, 4, 1, 1, 2, 3, 2, 3, 3, 1]
    rows = []
    for k in range(n):
        text = " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))
        if k % 3 == 0:
            text += ", New York city hall\nbig data"
        rows.append((k // 2, text, rng.choice(["en", "en", "en", "fr", None, "und"]), "x", "y"))
    rows += [(None, None, "en", None, None), (1, "", None, None, None), (1, "a " * 40_000 + "b", "long", "", "")]
    return rows + rows[:5]


@pytest.mark.parametrize("known_words,keys_a_range,most", [(500_000, 1 << 20, 2000), (4, 50, 7)])
def test_collocations_are_those_of_plain_counting(spark, known_words, keys_a_range, most):
    rows = drawn(known_words)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = phrases.collocations(
        docs, least=12, most=most, known_words=known_words, keys_a_range=keys_a_range
    )
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) > 20
    assert set(found) == brute([(r[1], r[2]) for r in rows], 12, most)


def test_no_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], COLUMNS)).collect() == []
    blank = spark.createDataFrame([(1, " . ", "en", "", "")], COLUMNS)
    assert phrases.collocations(blank).collect() == []


@pytest.mark.parametrize("bits", [1, 2, 11, 16, 17, 21, 22, 31, 32])
@pytest.mark.parametrize("k", [2, 3, 4])
def test_filters_are_lossless(bits, k):
    rng = np.random.default_rng(bits)
    words = rng.integers(0, 1 << bits, (3000, k), dtype=np.uint64)
    words = np.concatenate([words, words[:700], np.repeat(words[:1], 400, 0)])
    left, right, width = phrases.halves(words, bits)
    assert width == phrases.width_of(bits, k)
    assert (phrases.words_from(left, right, bits, k) == words).all()
    mixed = phrases.spread(left, right, width)
    back = phrases.gathered(*mixed, width)
    assert (back[0] == left).all() and (back[1] == right).all()
    l, r, n = phrases.counted(*mixed, width)
    expected = Counter(map(tuple, words.tolist()))
    range_bits = min(3, width)
    parts = []
    for value in range(1 << range_bits):
        own = (l >> np.uint64(width - range_bits)) == value
        if own.any():
            f = phrases.packed_filter(l[own], r[own], n[own], width, range_bits) | {"range": value}
            parts.append(phrases.unpacked_filter(f, width, range_bits))
    l2, r2, n2 = (np.concatenate([p[c] for p in parts]) for c in range(3))
    assert (l2 == l).all() and (r2 == r).all() and (n2 == n).all()
    won = phrases.words_from(*phrases.gathered(l2, r2, width), bits, k)
    assert dict(zip(map(tuple, won.tolist()), n2.tolist())) == expected
    twice = phrases.counted(np.append(l, l), np.append(r, r), width, np.append(n, n))
    assert (twice[2] == 2 * n).all() and (twice[0] == l).all()


def test_very_long_texts_are_cut_between_words():
    text = ("Word" * 10 + " x. ").encode() * 60_000
    some = list(phrases.words_of([text, b"", b"END"]))
    words = [w for part in some for w in part]
    assert len(some) > 2 and words.count(b"x") == 60_000 and words[-1] == b"end"
    assert words.count(phrases.END) == 60_002
