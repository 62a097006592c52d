"""What workers hold: word tables, vocabularies, and distances of whole blocks."""

import gc
import weakref

import numpy as np
import pytest

from feedloom.llm import order, permutation
from feedloom.llm.common import TOKENIZERS, WordTable, per_worker, rank_encoding


class Owner:
    def __init__(self):
        self.table = WordTable(self.encode, 4)
        self.asked = []

    def encode(self, words):
        self.asked.append(list(words))
        return [list(word.encode()) for word in words]


def test_a_large_thing_goes_when_the_next_one_comes():
    gc.disable()
    try:
        held = weakref.ref(per_worker(("test", 1), Owner, alone=True))
        assert held() is not None
        per_worker(("test", 2), Owner, alone=True)
        assert held() is None
    finally:
        gc.enable()


def test_words_are_encoded_once_until_the_table_is_full():
    owner = Owner()
    for words in (["a", "bc", "a"], ["bc", "d"], [], ["e", "", "a"], ["f", "g"], ["a", "b", "c", "d", "e"]):
        flat, sizes = owner.table.tokens(owner.table.ids(words))
        assert flat.tolist() == list("".join(words).encode()) and sizes.tolist() == [len(w) for w in words]
    # Four words fit: the fifth empties the table; a call that has more by itself still gets them.
    assert owner.asked == [["a", "bc"], ["d"], ["e", "", "a"], ["f", "g"], ["a", "b", "c", "d", "e"]]


def test_words_that_fail_are_asked_for_again():
    def encode(words):
        if not known:
            raise ValueError("not yet")
        return [[1]] * len(words)

    known = []
    table = WordTable(encode)
    with pytest.raises(ValueError):
        table.ids(["a"])
    known.append(1)
    assert table.tokens(table.ids(["a", "b"]))[0].tolist() == [1, 1]


TEXTS = [
    "", " ", "\n", "a", " a", "a ", "a\n", "\na", "a b\nc", "a  b", "a \nb", "a\n\nb", "it's 12 o'clock\nwe'll go ",
    "tab\there", "no break　wide", "été 日本 \U0001f600!?", "a\r\nb", "x1y2 -- z\n",
]


def test_texts_without_blanks_side_by_side_need_no_look_ahead():
    tokens, whole = order.Tokens(TOKENIZERS), rank_encoding(order.RANKS)
    assert r"(?!\S)" not in order.AHEAD_FREE
    for text, ids in zip(TEXTS, tokens.encode(TEXTS)):
        assert ids == [*whole.encode_ordinary(text), order.END_OF_TEXT]


def test_footrules_of_a_block_fit_their_type():
    rng = np.random.default_rng(3)
    ranks = np.stack([np.arange(256), np.arange(256)[::-1], *(rng.permutation(256) for _ in range(20))])
    for seen in ranks[:4]:
        found = permutation.footrules(np.ascontiguousarray(ranks.T.astype(np.int16)), seen.astype(np.int16))
        assert found.tolist() == np.abs(ranks - seen).sum(axis=1).tolist()
