"""The byte-level BPE machine against the public library, and its decoder against Python's."""

import hashlib
import os
import random

import pytest

from feedloom.llm import bpe, queries
from feedloom.llm.common import TOKENIZERS, rank_encoding

SIGNS = "aAbez1 29\n\t\r.,;é漢語　\x1f\x85\xa0'sß🙂ẞ=-​՘"


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(os.path.join(TOKENIZERS, bpe.RANKS)))


@pytest.fixture(scope="module")
def library():
    return rank_encoding(bpe.RANKS)


def drawn(rng, newer):
    text = "".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 40)))
    if rng.random() < 0.3:
        text = rng.choice([" ", "=", "-", "a", "ab", "\n", "é"]) * rng.randint(1, 300) + text
    if rng.random() < 0.2:
        text += rng.choice(newer) + rng.choice("ab. 1") + rng.choice(newer)
    return text


def test_ids_are_those_of_the_library(encoder, library):
    rng, newer = random.Random(2), sorted(encoder.splitter.newer)
    for _ in range(4000):
        text = drawn(rng, newer)
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text), text


def test_every_letter_class(encoder, library):
    for first in range(0, 0x110000, 0x400):
        text = "".join(
            f"a{c}1{c}.{c} {c}{c}"
            for c in map(chr, range(first, first + 0x400, 5))
            if not 0xD800 <= ord(c) < 0xE000
        )
        assert encoder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_states_are_forgotten_and_little_is_held_back(encoder, library):
    small = bpe.Transducer(encoder.machine.ids, most=50)
    piece = " antidisestablishmentarianism" * 3 + "=" * 500 + "a" * 77
    for match in encoder.splitter.pattern.findall(piece):
        assert small.encode(match.encode()) == library.encode_ordinary(match)
    longest = max(map(len, encoder.machine.ids))
    assert len(small.states) <= 50
    for open_, *guesses in encoder.machine.states:
        assert len(open_) <= longest and max(len(held) for _, _, held in guesses) <= longest


def test_tokens_without_merges_stand_for_whole_matches_only():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"abcd": 257}
    machine = bpe.Transducer(ranks)
    assert machine.encode(b"abcd") == [257]
    assert machine.encode(b"abcda") == [256, 99, 100, 97]


def test_the_sides_of_two_tokens_tell_whether_they_merge():
    rng = random.Random(4)
    for _ in range(150):
        # Ranks in any order: some tokens no merges make, and ranks fall on the way to others.
        some = {bytes(rng.choices(b"abc", k=rng.randint(2, 6))) for _ in range(rng.randint(1, 25))}
        ranks = {token: 256 + k for k, token in enumerate(rng.sample(sorted(some), len(some)))}
        if rng.random() < 0.5:
            ranks = {token: 256 + k for k, token in enumerate(sorted(some, key=len))}
        machine = bpe.Transducer({bytes([b]): b for b in range(256)} | ranks)
        tokens = [*ranks.values(), *b"abcd"]
        for last in (-1, *tokens):
            for token in tokens:
                assert machine.fits(last, token) == machine.merge(last, token), (ranks, last, token)


def test_new_words_neither_merge_anew_nor_end_in_states(encoder, library, monkeypatch):
    machine = bpe.Transducer(encoder.machine.ids)
    assert machine.encode(b" the") == library.encode_ordinary(" the") and len(machine.states) <= 4
    merged = []

    def merge(last, token, merge=machine.merge):
        merged.append(last >= 0)
        return merge(last, token)

    monkeypatch.setattr(machine, "merge", merge)
    rng = random.Random(6)
    some = [token for token in encoder.machine.ids if token.isalpha() and len(token) < 6]
    words = ["".join(map(bytes.decode, rng.choices(some, k=3))) for _ in range(2000)]
    for word in words * 2:
        assert machine.encode(word.encode()) == library.encode_ordinary(word)
    assert not any(merged) and len(machine.pairs) > 500


def test_latin_texts_split_alike(encoder):
    splitter, rng = encoder.splitter, random.Random(7)
    signs = "a b's'S'll've é ß\xa0\x85\x1c\n\r\t  ²½7_-=''\u02af"
    texts = [f"a{c}1{c}{c}.{c} {c}'{c}s" for c in map(chr, range(0x260))]
    texts += ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(3000)]
    for text in texts:
        assert [m for part in splitter.matches(text) for m in part] == splitter.pattern.findall(text)
    assert splitter.latin.findall(bpe.LATIN) == splitter.pattern.findall(bpe.LATIN)


def test_the_stream_decoder_is_pythons(encoder):
    rng, raw = random.Random(3), encoder.machine.raw
    whole = bpe.whole_texts(raw)
    sentence = "Grüße, naïve café 漢字 🙂".encode()
    library_ids = encoder.encode([sentence.decode()])[0].tolist()
    edges = [0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF, 0xE2, 0x82]
    for _ in range(4000):
        content = bytes(rng.choice(edges) for _ in range(rng.randint(0, 12)))
        decoder = bpe.StreamDecoder(raw)
        parts = [decoder.push([encoder.machine.ids[bytes([b])]]) for b in content]
        assert "".join(parts) + decoder.finish() == content.decode("utf-8", "replace")
        ids = [encoder.machine.ids[bytes([b])] for b in content] + library_ids
        fast = bpe.StreamDecoder(raw, whole)
        assert fast.push(ids) + fast.finish() == (content + sentence).decode("utf-8", "replace")
        assert decoder.finish() == ""


def test_tables_with_odd_rows(spark):
    long = "wörd-" * 300_000 + " end"
    rows = [(1, None, 0), (1, "", 0), (None, "one two", 1), (None, "one two", 1), (2, long, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    tokens, ids = bpe.encode(docs, ("doc_id", "ids", "text"))
    assert ids == "_ids"
    decoded, text = bpe.decode(tokens, ("doc_id", "ids", "text"), ids)
    assert text == "_text" and decoded.count() == 5
    assert all(r[text] == (r["text"] or "") for r in decoded.collect())
    empty, _ = bpe.encode(docs.where("doc_id = 9"))
    assert empty.collect() == []
    odd = spark.createDataFrame([(1, None), (2, [32, None, 99_999, -5])], "doc_id long, ids array<int>")
    got = {r[0]: r[1] for r in bpe.decode(odd)[0].collect()}
    assert got == {1: "", 2: "A���"}


def test_the_query(spark, library):
    data = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for doc_id, text in docs:
        ids = library.encode_ordinary(text or "")
        expected[doc_id] = (
            len(ids),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        )
    rows = queries.op11_byte_bpe_transducer(spark, data).collect()
    assert len(rows) == len(docs) and {r[0]: tuple(r)[1:] for r in rows} == expected
