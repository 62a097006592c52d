"""Lattice likelihood, N-best segmentation, fertility and training order against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import fertility, lattice, nbest, order
from feedloom.llm.common import rank_encoding, sentence_pieces
from feedloom.llm.pieces import SPACE, load_pieces, prepared, raw_bytes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, spans int"
AWKWARD = [
    None,
    "",
    " ",
    "\n\n",
    "a",
    "The cat  sat.\nThe cat sat on the ▁mat▁.",
    "Größe 東京 🙂 \t tab\r\nline",
    "x" * 3000,
    "the cat sat on the mat " * 200,
    "\x00nul 'tis don't",
    "the cat sat on the mat " * 200,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if k % 2 else None, "s", 0, "r", 1) for k, t in enumerate(AWKWARD)]
    rows += [(None, "no id here", "en", None, None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


def segmentations(pieces, text):
    """Every path of the lattice as (ids, score), by recursion."""
    if not text:
        yield [], 0.0
        return
    for k in range(1, len(text) + 1):
        if text[:k] in pieces.ids:
            for ids, score in segmentations(pieces, text[k:]):
                yield [pieces.ids[text[:k]], *ids], pieces.scores[text[:k]] + score
    if text[0] not in pieces.ids:
        for ids, score in segmentations(pieces, text[1:]):
            own = [pieces.byte_ids[b] for b in raw_bytes(text[0])]
            yield own + ids, pieces.unknown + score


@pytest.mark.parametrize("text", ["the cat", "a\nbé", "東▁x", "  two", "ooo", ""])
def test_n_best_are_the_best_of_all_paths(text):
    pieces = load_pieces()
    encoder = nbest.Encoder(pieces, 5)
    tokens, _, scores, others = encoder.encode([text])
    want = sorted((s for _, s in segmentations(pieces, prepared(" " + text))), reverse=True) if text else [0.0]
    got = [scores[0], *(o["score"] for o in others[0])]
    assert got == want[: len(got)] and len(got) == min(5, len(want))
    paths = [tokens.tolist(), *(nbest.apply_edits(tokens.tolist(), o["edits"]) for o in others[0])]
    assert len({tuple(p) for p in paths}) == len(paths)
    assert all(nbest.decode_ids(pieces, p) == text for p in paths)


def test_search_of_a_whole_lattice_agrees_with_that_of_units():
    pieces = load_pieces()
    encoder = nbest.Encoder(pieces, 6)
    text = "no other tests the cats"
    _, _, scores, others = encoder.encode([text])
    whole = nbest.Lattice(pieces, encoder.edges, [prepared(" " + text)]).paths(6)
    assert [s for s, _ in whole] == [scores[0], *(o["score"] for o in others[0])]


def test_new_units_are_segmented_together(monkeypatch):
    pieces = load_pieces()
    encoder = nbest.Encoder(pieces, 4)
    draw = random.Random(5)
    some = [p for p in pieces.ids if len(p) < 5] + list("ab \n\x00é東🙂\U0010ffff")
    units = ["".join(draw.choices(some, k=draw.randint(1, 9))) for _ in range(1500)]
    units += [*map(prepared, ["▁", " ", "a", "\n", "z" * 64, "東" * 64]), "x" * 65, "é" * 300]
    want = [nbest.best_two(pieces, encoder.edges, unit) for unit in units]
    alone = []

    def one(pieces, edges, unit, best_two=nbest.best_two):
        alone.append(unit)
        return best_two(pieces, edges, unit)

    monkeypatch.setattr(nbest, "best_two", one)
    monkeypatch.setattr(nbest, "CHARS_TOGETHER", 999)
    encoder.table.ids(units)
    assert set(alone) == {"x" * 65, "é" * 300}
    at = encoder.table.ids(units)
    tokens, sizes = encoder.table.tokens(at)
    parts = [x.tolist() for x in np.split(tokens, np.cumsum(sizes)[:-1])]
    # The table prepares what it is given, so prepared units are prepared twice here.
    again = [nbest.best_two(pieces, encoder.edges, prepared(unit)) for unit in units]
    assert [(p, s, d) for p, s, d in zip(parts, encoder.scores[at], encoder.losses[at])] == again
    assert encoder._best_two(units) == want


def test_encode_decodes_to_the_text(spark, docs):
    found = nbest.encode(docs.withColumn("row_key", F.monotonically_increasing_id()), ("row_key",))
    back = {r.row_key: r.text for r in nbest.decode(found, ("row_key",)).collect()}
    want = {r.row_key: r.text or "" for r in docs.withColumn("row_key", F.monotonically_increasing_id()).collect()}
    assert back == want
    empty = nbest.encode(docs.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "ids", "score", "alternatives"]


def test_marginal_sums_all_segmentations():
    pieces = load_pieces()
    edges, byte_logs, _ = lattice.piece_logs(pieces, {pieces.ids["at"]: 7, pieces.ids["c"]: 2})
    for word in ("cat", "東é", "aaaa", "▁x"):
        text = SPACE + prepared(word)
        logs = {k: v for p, k in pieces.ids.items() if (v := edges[p]) is not None}
        logs |= dict(zip(pieces.byte_ids, byte_logs))
        total = sum(
            math.exp(sum(logs[k] for k in ids)) for ids, _ in segmentations(pieces, text)
        )
        assert lattice.log_marginal(text, edges, byte_logs) == pytest.approx(math.log(total))


def test_piece_probabilities_sum_to_one():
    pieces = load_pieces()
    edges, byte_logs, end = lattice.piece_logs(pieces, {300: 5, -1: 2})
    logs = [v for v in edges.values() if v is not None] + byte_logs + [end]
    assert sum(map(math.exp, logs)) == pytest.approx(1)


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_base_scores_and_counts(docs, hot):
    rows = docs.select("doc_id", "text").collect()
    words = [((r.text or "").encode().lower().split(), r.doc_id) for r in rows]
    train = Counter()
    for own, doc_id in words:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 5 != 1:
            train.update([*own, b"\n"])
    n, v = sum(train.values()), len(train)
    want = Counter()
    for own, doc_id in words:
        tokens = [*own, b"\n"]
        base = sum(math.log10((train[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1
        known = sum(train[t] > 0 for t in tokens)
        want[doc_id, held, len(tokens), known, n, round(base, 6)] += 1
    got = Counter()
    for r in lattice.lattice_scores(docs, hot_words=hot).collect():
        got[r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)] += 1
        assert r.score < 0
    assert got == want
    assert lattice.lattice_scores(docs.limit(0)).count() == 0


def test_fertility_measures(docs):
    found, name = fertility.fertility_rules(docs, ["doc_id", "text", "lang"])
    sp, ranks = sentence_pieces(), rank_encoding("byte_bpe_multi_50k.tiktoken")
    assert found.count() == docs.count()
    for row in found.collect():
        q, text = row[name], row.text or ""
        words = [w.decode() for w in text.encode().split()]
        ids = [k for w in words for k in sp.encode(w)]
        assert (q.n_words, q.n_pieces) == (len(words), len(ids))
        assert q.n_ranks == sum(len(ranks.encode_ordinary(" " + w)) for w in words)
        assert q.n_fallback == sum(sp.is_byte(k) for k in ids)
        share = np.array(list(Counter(ids).values())) / max(1, len(ids))
        assert q.entropy == pytest.approx(-(share * np.log2(share)).sum())
        assert q.base_failed == (len(words) < 50 or 100 * q.n_repeat_words > 50 * len(words))
        assert not (q.base_failed and q.kept)


def test_bands_reject_the_odd_text(spark):
    random.seed(8)
    parts = "the cat sat on this mat and then it went back home again".split()
    rows = [
        (k, " ".join(random.choice(parts) + random.choice(parts) for _ in range(60 + k % 7)), "en")
        for k in range(60)
    ]
    rows.append((99, " ".join("Ж$ЩЮ%&Ъ#" + chr(1040 + j) * 3 + chr(0x4E00 + 97 * j) for j in range(60)), "en"))
    found, name = fertility.fertility_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), ["doc_id"]
    )
    verdicts = {r.doc_id: r[name] for r in found.collect()}
    assert not verdicts[99].kept and not verdicts[99].base_failed
    assert all(v.kept or v.base_failed for k, v in verdicts.items() if k != 99)


@pytest.mark.parametrize("percent", [8, 20])
def test_bands_hold_where_much_of_a_language_is_junk(spark, percent):
    random.seed(4)
    parts = "the water and people other between country through little world after house".split()
    rows = []
    for k in range(300):
        words = random.choices(parts, k=120 + k % 50)
        if k % 100 < percent:
            words = [w + random.choice(["#", "*$", "%&", "|<"]) if j % 2 else w for j, w in enumerate(words)]
        rows.append((k, " ".join(words), "en"))
    found, name = fertility.fertility_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"), ["doc_id"]
    )
    verdicts = {r.doc_id: r[name] for r in found.collect()}
    assert not any(v.base_failed for v in verdicts.values())
    assert {k for k, v in verdicts.items() if not v.kept} == {k for k in range(300) if k % 100 < percent}


def test_permutation_is_one_to_one():
    for size in (1, 2, 3, 5, 64, 1000, 4097):
        slots = order.permuted(np.arange(size), size, 11)
        assert sorted(slots.tolist()) == list(range(size))
    assert order.permuted(np.arange(1000), 1000, 1).tolist() != order.permuted(np.arange(1000), 1000, 2).tolist()


def test_shards_hold_every_sequence(spark, docs, tmp_path):
    source = str(tmp_path / "in")
    docs.write.parquet(source)
    stored = spark.read.parquet(source)
    path, size = order.write_order(stored, length=16, shard_rows=8)
    rows = order.read_order(spark, path, size, length=16, shard_rows=8).collect()
    assert sorted(r.slot for r in rows) == list(range(size))
    encoding = rank_encoding(order.RANKS)
    want = Counter()
    for r in stored.collect():
        ids = [*encoding.encode_ordinary(r.text or ""), order.END_OF_TEXT]
        for k in range(0, len(ids), 16):
            want[r.doc_id, k // 16, tuple(ids[k : k + 16])] += 1
    assert Counter((r.doc_id, r.part, tuple(r.ids)) for r in rows) == want
    assert order.write_order(stored.limit(0))[1] == 0
    assert order.read_order(spark, path, 0).count() == 0


def test_a_record_is_where_its_slot_says(spark, docs, tmp_path):
    source = str(tmp_path / "in")
    docs.write.parquet(source)
    path, size = order.write_order(spark.read.parquet(source), str(tmp_path / "out"), length=16, shard_rows=8)
    rows = {r.slot: r for r in order.read_order(spark, path, size, 16, 8).collect()}
    for slot in range(0, size, 7):
        [shard] = (tmp_path / "out" / f"shard={slot // 8}").glob("part-*")
        with open(shard, "rb") as file:
            file.seek(slot % 8 * order.stride(16))
            doc_id, part, n = order.HEAD.unpack(file.read(order.HEAD.size))
            ids = np.frombuffer(file.read(32), "<u2")[:n]
        assert (doc_id, part, ids.tolist()) == (
            -1 if rows[slot].doc_id is None else rows[slot].doc_id, rows[slot].part, rows[slot].ids
        )
