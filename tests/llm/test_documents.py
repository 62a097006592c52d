"""Personal data, licences, near duplicates, budgets, archives, neighbours and the pipeline."""

import base64
import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedloom.llm import budget, jaccard, licences, permutation, pii, queries, warc

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron".split()


# --- Personal data


def plain_spans(text):
    """The contract's patterns as they are written."""
    out = [
        (m.start(), 0, m.end())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_are_the_patterns():
    random.seed(5)
    parts = ["a.b@c.de", "@", "x@", ".", "+1", "(555)", "1234", "1.2.3.4", "300.1.1.1", "-", " ", "é",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-5678", "a@b.c@d.e.f", "7"]
    for _ in range(4000):
        text = "".join(random.choices(parts, k=random.randint(1, 9)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 200_000 + "@" + "a" * 200_000) == []


def brute_labelling(n, spans, scores):
    """Best labelling and log partition by trying every set of disjoint labelled segments."""
    best, every = (0.0, ()), []
    for size in range(n + 1):
        for chosen in itertools.combinations(range(len(spans)), size):
            cells = [c for k in chosen for c in range(*spans[k])]
            if len(cells) == len(set(cells)):
                for kinds in itertools.product(range(scores.shape[1]), repeat=size):
                    total = sum(scores[k, t] for k, t in zip(chosen, kinds))
                    every.append(total)
                    if total > best[0] + 1e-12:
                        best = (total, tuple(zip(chosen, kinds)))
    return best, np.logaddexp.reduce(every)


def test_dynamic_programming_is_exact():
    rng = np.random.default_rng(3)
    spans = [(0, 1), (0, 2), (1, 3), (2, 4), (3, 4), (1, 2)]
    for _ in range(20):
        scores = rng.normal(0, 2, (len(spans), 2))
        (total, _), partition = brute_labelling(4, spans, scores)
        labels = pii.best_labels(4, spans, scores)
        assert sum(scores[k, t] for k, t in labels) == pytest.approx(total)
        found, sure = pii.forward_backward(4, spans, scores)
        assert found == pytest.approx(partition)
        assert sure.min() >= 0 and sure.max() <= 1


def test_field_learns_base_spans_and_adds_to_them():
    random.seed(1)
    sample = []
    for k in range(120):
        sample.append(f"call +1 (5{k % 10}3) 555-{1000 + k} or mail{k}.x@host{k}.example.com now")
        sample.append(f"from 10.{k}.3.{k % 200} version {k}.{k % 7} of {k * 7919} on 20{k % 90 + 10}")
    weights = pii.fit(sample)
    hidden = "ring (523) 555-1055 soon"
    assert {k for _, k, _ in pii.added_spans(hidden, weights, [])} <= {3}
    clean = "chapter 12 of 2019 costs 45.50 and 7 more in 1999"
    assert pii.added_spans(clean, weights, pii.base_spans(clean)) == []
    for text in sample[:40]:
        base = pii.base_spans(text)
        for a, _, b in pii.added_spans(text, weights, base):
            assert all(b <= x or y <= a for x, _, y in base)


def test_find_and_redact(spark):
    rows = [(1, "mail a.b@c.de and +49 (30) 1234-5678.", "en", "s", 1), (2, None, None, None, None),
            (3, "", "en", "s", 0), (4, "plain words", "en", "s", 11), (4, "plain words", "en", "s", 11),
            (None, "10.0.0.1 " * 3000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumn("spans", F.lit("mine"))
    found, name = pii.find_spans(docs)
    assert name == "_spans" and found.count() == 6 and set(found.columns) == {*docs.columns, name}
    digest = {r.doc_id: r for r in queries.pii_digest(found, name).collect()}
    assert (digest[1].n_email, digest[1].n_phone, digest[None].n_ip) == (1, 1, 3000)
    want = "email:5:13,phone:18:36"
    assert digest[1].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert digest[4].base_sha256 == hashlib.sha256(b"").hexdigest() and digest[4].spans == ""
    new = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert new[1] == "mail [EMAIL] and [PHONE]." and new[2] is None and new[4] == "plain words"
    assert new[None] == "[IP] " * 3000
    assert pii.find_spans(docs.limit(0))[0].count() == 0


def card_number(rng):
    digits = "4" + "".join(str(rng.randint(0, 9)) for _ in range(14))
    return next(digits + c for c in "0123456789" if pii.luhn(digits + c))


def test_neighbours_that_the_patterns_join_are_found_and_redacted(spark):
    rng = random.Random(6)
    one, two = card_number(rng), card_number(rng)
    phone, ip = "+1 (826) 555-4081", "190.137.223.204"
    texts = [f"words {one} {two} here", f"words {phone} {ip} here", "chapter 12 of 2019 costs 45.50 and 7 more"]
    broken = two[:-1] + str((int(two[-1]) + 1) % 10)
    texts.append(f"parts {broken} {broken} there")
    far = "plain words of no kind at all " * 20
    for k in range(40):
        texts.append(f"room {k * 101} {far} paid with {card_number(rng)} of late, by a{k}.b@host{k}.example.com")
        texts.append(f"{far} in 20{k + 10} {far} call +1 ({200 + k}) 555-{rng.randint(1000, 9999)}, from {k}.20.{rng.randint(0, 255)}.7, room {k * 7919}")
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], DOCUMENTS)
    assert pii.base_spans(texts[0]) == [] and [k for _, k, _ in pii.base_spans(texts[1])] == [1]
    found, name = pii.find_spans(docs)
    spans = {
        r.doc_id: sorted((s.kind, texts[r.doc_id][s.start : s.end]) for s in r[name])
        for r in found.where("doc_id < 4").collect()
    }
    assert spans == {0: sorted([("card", one), ("card", two)]), 1: [("ip", ip), ("phone", phone)], 2: [], 3: []}
    new = {r.doc_id: r.text for r in pii.redacted(docs).where("doc_id < 4").collect()}
    assert new[0] == "words [CARD] [CARD] here" and new[1] == "words [PHONE] [IP] here"
    assert new[2] == texts[2] and new[3] == texts[3]


# --- Licences


def test_automaton_gives_longest_runs():
    random.seed(2)
    sequences = [[random.randint(0, 3) for _ in range(random.randint(1, 12))] for _ in range(5)]
    automaton = licences.SuffixAutomaton(sequences)
    runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for _ in range(200):
        text = [random.randint(0, 4) for _ in range(15)]
        for place, (state, run) in enumerate(automaton.statistics(text)):
            longest = max(
                (k for k in range(1, place + 2) if tuple(text[place + 1 - k : place + 1]) in runs), default=0
            )
            assert run == longest
            own = tuple(text[place + 1 - run : place + 1])
            holding = {n for n, s in enumerate(sequences) for i in range(len(s)) if run and tuple(s[i : i + run]) == own}
            assert not run or set(automaton.ends[state]) == holding


def test_licences(spark):
    mit = licences.TEMPLATES[0][1]
    cut = mit.replace("without limitation", "of course").replace("publish,", "print,")
    rows = [(1, f"Some text.\n{mit}\nMore."), (2, cut), (3, "the rights to use the software"), (4, None), (5, ""),
            (6, "MIT license, mit LICENSE; CC BY 4.0"), (6, "MIT license, mit LICENSE; CC BY 4.0"),
            (None, "word " * 50_000 + "Licensed under the Apache License, Version 2.0.")]
    found = {r.doc_id: r.licences for r in licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].labels == ["mit"] and found[1].base_labels == [] and found[1].score == 1
    assert found[2].labels == ["mit"] and 0.8 < found[2].score < 1
    assert found[3].labels == [] and found[4].n_words == found[5].n_words == 0
    assert (found[6].n_base, found[6].first_word, found[6].last_word) == (3, 0, 4)
    assert found[6].base_labels == ["cc-by", "mit"]
    assert found[None].first_word == 50_003 and "apache" in found[None].labels
    assert licences.words_of("Äb-C_dé1".encode()) == ["Äb".encode(), b"c", "dé1".encode()]


# --- Near duplicates


def brute_components(rows):
    sets = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        runs = [tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
        sets.append(set(runs))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        shared = len(sets[i] & sets[j])
        if shared and 100 * shared >= 80 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = defaultdict(list)
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(k)].append(doc_id)
    return Counter(
        (doc_id, len(sets[k]), min(least[root(k)], default=None)) for k, (doc_id, _) in enumerate(rows)
    )


def near_rows(seed, n=90):
    random.seed(seed)
    texts = []
    for _ in range(n):
        if texts and random.random() < 0.7:
            words = random.choice(texts).split()
            for _ in range(random.randint(0, max(1, len(words) // 25))):
                if words:
                    words[random.randrange(len(words))] = random.choice(BASE) + str(random.randint(0, 3))
            texts.append(" ".join(words))
        else:
            texts.append(" ".join(random.choice(BASE) + str(random.randint(0, 20)) for _ in range(random.randint(1, 90))))
    passage = " ".join(f"shared{k}" for k in range(60))
    texts += [f"{passage} {' '.join(random.choices(BASE, k=k))}" for k in range(0, 40, 2)]
    return [(k * 3 % 401, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_are_all_found(spark, seed):
    rows = near_rows(seed)
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE two"), (505, "two one"),
             (None, rows[0][1]), (None, "quite alone here with no other text"), rows[1], rows[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("x"))
    found = jaccard.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)


def test_group_around_a_middle_is_linked_and_strays_are_not(spark):
    random.seed(9)
    middle = [random.choice(BASE) + str(random.randint(0, 99)) for _ in range(200)]
    rows = [(0, " ".join(middle))]
    for k in range(1, 60):
        words = list(middle)
        for place in random.sample(range(0, 200, 5), 2 + k % 8):
            words[place] = f"own{k}x{place}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows)


def test_shingle_sets_and_prefixes():
    sets = jaccard.Shingler().sets([b"a b c d e f", b"A  B\tc d e f", b"", b"a b", b"b a", b"a b c d e a b c d e a b c d e"])
    assert [len(s) for s in sets] == [2, 2, 0, 1, 1, 5]
    assert sets[0].tolist() == sets[1].tolist() and sets[3].tolist() != sets[4].tolist()
    rng = np.random.default_rng(1)
    for n in (1, 4, 5, 40, 333):
        hashes = np.unique(rng.integers(0, 1 << 47, n).astype(np.uint64))
        classes = rng.integers(0, 5, len(hashes)).astype(np.uint8)
        kept, levels, matches = jaccard.adaptive_prefix(hashes, classes)
        assert 1 <= matches <= min(jaccard.MOST_MATCHES, jaccard.least_overlap(n))
        assert len(kept) <= n - jaccard.least_overlap(n) + matches and (not len(levels) or levels.max() <= matches)
    blob = np.sort(rng.integers(0, 1 << 32, 5000))
    assert jaccard.unpack(jaccard.pack(blob, 0), 0).tolist() == blob.tolist()


def test_one_of_each_keeps_columns_and_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, text, 1), (3, text, 2), (4, "other words stand here now", 3), (None, "no id", 4), (4, "other words stand here now", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int")
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([3, 4, None])
    assert jaccard.one_of_each(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(900, 901)], "a long, b long")
    found = {r.key: r.root for r in jaccard.components(links).collect()}
    assert found == {**{k: 0 for k in range(201)}, 900: 900, 901: 900}


# --- Budgets


def brute_shares(children, amount):
    """Shares by pouring real-valued water until it is used up, rounded down."""
    left, open_ = float(amount), dict(children)
    out = dict.fromkeys(children, 0.0)
    while left > 1e-9 and open_:
        total = sum(w for _, w in open_.values())
        level = left / total
        full = {k: c for k, (c, w) in open_.items() if c <= level * w + 1e-9}
        if not full:
            for k, (_, w) in open_.items():
                out[k] = level * w
            return out
        for k, c in full.items():
            out[k] = c
            left -= c
            del open_[k]
    return out


def test_shares_follow_weights_and_capacities(spark):
    random.seed(4)
    rows, want = [], {}
    for family in range(12):
        children = {f"c{k}": (random.randint(0, 1000), random.randint(1, 9)) for k in range(random.randint(1, 6))}
        amount = random.randint(0, sum(c for c, _ in children.values()))
        want |= {(family, k): v for k, v in brute_shares(children, amount).items()}
        rows += [(family, k, c, w, amount) for k, (c, w) in children.items()]
    frame = spark.createDataFrame(rows, "p int, name string, capacity long, weight long, budget long")
    got = {(r.p, r.name): r.budget for r in budget.share_out(frame, ["p"], "name").collect()}
    assert all(abs(got[k] - v) < 1 + 1e-6 for k, v in want.items())
    for family in range(12):
        amount = next(r[4] for r in rows if r[0] == family)
        assert sum(v for (p, _), v in got.items() if p == family) == amount
    assert all(got[p, k] <= c for p, k, c, _, _ in rows)


def test_mix_takes_prefixes_up_to_the_budget(spark):
    rows = [(k, " ".join(["w"] * (k % 9)), "en" if k % 3 else None, f"src{k % 5}", 0) for k in range(400)]
    rows += [rows[7], (None, "a b c", "en", "src1", 0), (900, None, "en", "src1", 0)]
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumn("epochs", F.lit(1)).withColumn("domain", F.lit(2))
    found = budget.mixed(docs, queries.levels(), queries.WEIGHTS, 150, max_epochs=2).collect()
    total = sum(len((t or "").split()) for _, t, *_ in rows)
    taken = sum(r.n_tokens * r.epochs for r in found)
    assert 0.9 * 1.5 * total <= taken <= 1.5 * total
    assert {r.epochs for r in found} <= {1, 2}
    assert budget.mixed(docs.limit(0), queries.levels(), {}, 80).count() == 0


# --- Archives


def test_archives_round_trip(spark, tmp_path):
    body = "<html>" + "common words of every page " * 40
    rows = [(k, f"http://x/{k}", f"{body}{k % 30}") for k in range(80)]
    rows += [(100, None, None), (101, "u\r\nv", ""), (102, "u", "<p>é東</p>"), (None, "u", f"{body}3"), (3, "again", f"{body}3")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("sha1", F.lit(1))
    path = warc.write_archives(pages, str(tmp_path / "a"))
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    want = Counter()
    for page_id, _, html in rows:
        raw, least = (html or "").encode(), first[html or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        again = page_id != least
        want[page_id, len(raw), digest, "revisit" if again else "response", least if again else None] += 1
    got = warc.read_archives(spark, path).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.payload is None or bytes(r.payload) == next((h or "") for p, _, h in rows if p == r.page_id).encode() for r in got)
    leading = [
        next(warc.frames(f.read_bytes()))[0] for f in (tmp_path / "a").glob("part-*") if f.stat().st_size
    ]
    assert leading and set(leading) == {warc.DICTIONARY_MAGIC}
    none = warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, none).count() == 0
    few = warc.write_archives(pages.limit(2), str(tmp_path / "c"))
    assert warc.read_archives(spark, few).count() == 2


# --- Neighbours


def test_neighbours_recall_and_order(spark):
    rng = np.random.default_rng(7)
    values = rng.normal(size=(6000, 24)).astype(np.float32)
    values[100:160] = values[100]
    rows = [(k, v.tolist()) for k, v in enumerate(values)]
    rows += [(6000, None), (6020, [0.0] * 24), (6040, [float("nan")] + [1.0] * 23), (6060, [None] + [1.0] * 23),
             (6080, [float("inf")] * 24), (6100, [1.0, 2.0]), (None, [1.0] * 24)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("block", F.lit(1))
    found = defaultdict(list)
    for r in permutation.nearest(frame, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    wide = values.astype(float)
    hits = 0
    assert set(found) == set(range(0, 6000, 20))
    for query, own in found.items():
        scores = wide @ wide[query]
        scores[query] = -np.inf
        best = np.lexsort((np.arange(6000), -scores))[:20]
        hits += len({v for _, v, _ in own} & set(best.tolist()))
        assert [r for r, _, _ in own] == list(range(1, 21))
        assert own == sorted(own, key=lambda x: (-x[2], x[1]))
        assert all(abs(scores[v] - s) < 1e-9 for _, v, s in own)
    assert hits / (20 * len(found)) >= 0.9
    few = permutation.nearest(frame.where("vec_id < 12"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == list(range(1, 12))
    assert permutation.nearest(frame.limit(0), F.lit(True)).count() == 0


def shuffled(spark) -> dict[str, int]:
    """Files of the shuffles that are on disk, and their sizes."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(k) for k in range(files.size())]
    return {str(f.getPath()): f.length() for f in files if f.getName().startswith("shuffle_")}


def test_neighbours_send_a_vector_once_and_a_query_once_a_task(spark, monkeypatch):
    rng = np.random.default_rng(8)
    values = rng.normal(size=(6000, 24)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(values)]
    path = permutation.kept_table(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "given")
    before = shuffled(spark)
    whole = permutation.nearest(path, F.col("vec_id") % 5 == 0).collect()
    sent = sum(size for name, size in shuffled(spark).items() if name not in before)
    assert sent < 12 * values.nbytes
    assert len(whole) == 1200 * 20
    # Some thirty slices, several a part: a task goes on from one to the next.
    monkeypatch.setattr(permutation, "BLOCK", 6)
    monkeypatch.setattr(permutation, "SLICES", 2)
    monkeypatch.setattr(permutation, "TASKS", 1)
    cut = permutation.nearest(path, F.col("vec_id") % 5 == 0, reranked=1.0).collect()
    found = defaultdict(list)
    for r in sorted(cut, key=lambda r: (r.query_id, r.rank)):
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    wide = values.astype(float)
    order = np.argsort(-(wide @ pivots_of(spark, path).T), axis=1, kind="stable")
    for query in range(0, 6000, 500):
        seen = set(order[query, :32].tolist())
        visited = np.array([k for k in range(6000) if k != query and seen & set(order[k, :8].tolist())])
        scores = (wide[visited] * wide[query]).sum(axis=1)
        best = np.argsort(-scores, kind="stable")[:20]
        assert [(r, v) for r, v, _ in found[query]] == list(enumerate(visited[best].tolist(), 1))
        assert [s for _, _, s in found[query]] == scores[best].tolist()


def pivots_of(spark, frame):
    rows = frame.orderBy(F.xxhash64("vec_id"), "vec_id").limit(256).collect()
    return np.array([r.embedding for r in rows])


# --- Pipeline


def test_pipeline_stage_by_stage(spark, tmp_path):
    random.seed(3)
    words = [f"{a}{b}" for a in ("the", "an", "re", "ti", "on") for b in ("st", "er", "ing", "ed", "ou", "le")]
    rows = []
    for k in range(40):
        text = " ".join(random.choice(words) for _ in range(90)) + f" mail x{k}@y.org"
        rows.append((k, text, "en", f"src{k % 4}", len(text)))
    rows += [(50, rows[3][1], "en", "src1", 1), (51, rows[3][1], None, None, None), (52, "short", "en", "src0", 5),
             (53, None, "en", "src0", None), (54, "", "en", "src0", 0)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in docs.collect()}
    ids = [set(rows) for rows in seen.values()]
    assert not ids[0] & {52, 53, 54} and {50, 51} & ids[0]
    assert ids[1] == ids[0] - {50, 51}
    assert ids[2] == ids[1] and all("[EMAIL]" in r.text and "@" not in r.text for r in seen["personal_data"].values())
    assert all(r.n_chars == len(r.text) for r in seen["personal_data"].values())
    assert ids[3] <= ids[2] and len(ids[3]) >= 0.7 * len(ids[2]) and ids[4] == ids[3]
    whole = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {k: r.ids for k, r in seen["encode"].items()}


def test_every_query_is_registered():
    import __spark_entry__

    assert set(queries.QUERIES) <= set(__spark_entry__.queries())
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
