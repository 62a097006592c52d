"""Byte-level BPE as a transducer: merges compiled lazily to a deterministic machine, and back.

A sequence of tokens is what merging gives for its bytes exactly if every two neighbours are what
merging gives for their own bytes. So a machine that knows the last whole token and the bytes of the
next one can read bytes from left to right; it does not know where the next token ends. Its subset
construction follows all open guesses at once and emits a token as soon as all of them agree on it.
Guesses reach back by no more than the longest token, so what is held back is bounded. States are
made when texts first reach them and forgotten when there are too many.

Decoding feeds tokens to an incremental UTF-8 machine that gives out whole characters.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import (
    PATTERN,
    TOKENIZERS,
    WordTable,
    free_name,
    per_worker,
    slices,
    strings,
)

RANKS = "byte_bpe_50k.tiktoken"
BYTES_A_SLICE = 1 << 20
PIECES_A_TIME = 1 << 18
NEVER = 1 << 62  # Above all ranks.
NOWHERE = None, None, False
#: So many first bytes lead to their state at once when they were read before.
HEAD = 5
MOST_STATES, MOST_PAIRS, MOST_MATCHES, MOST_DECODED = 120_000, 400_000, 400_000, 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Transducer:
    """Bytes in, token ids out, for one vocabulary of ranks.

    A guess is how far the next token has begun (a node of the tree of all beginnings), after which
    token (-1: none), and the tokens held back for it. A state is the open bytes and guesses.
    """

    def __init__(self, ranks: dict[bytes, int], most: int = MOST_STATES):
        self.ids, self.most = ranks, most
        self.raw = {rank: token for token, rank in ranks.items()}
        self.begun, numbers = [b""], {}
        for token in ranks:
            node = 0
            for k, byte in enumerate(token, 1):
                below = numbers.get(node << 8 | byte)
                if below is None:
                    below = numbers[node << 8 | byte] = len(self.begun)
                    self.begun.append(token[:k])
                node = below
        inner = {key >> 8 for key in numbers}
        #: By node and byte: the node below, the token that is whole there, whether it may go on.
        self.under = {k: (n, ranks.get(self.begun[n]), n in inner) for k, n in numbers.items()}
        self.pairs: dict[int, bool] = {}
        self.sides: dict[int, tuple[list, list] | None] = {}
        self.states: list[tuple] = []
        self.numbers: dict[tuple, int] = {}
        self.steps: dict[int, tuple[int, tuple]] = {}
        self.heads: dict[bytes, tuple[int, tuple]] = {}
        self._forget()

    def _forget(self) -> None:
        self.states.clear()
        self.numbers.clear()
        self.steps.clear()
        self.heads.clear()
        self._state((b"", (0, -1, ())))

    def fits(self, last: int, token: int) -> bool:
        """Whether ``token`` may follow ``last`` (-1: nothing)."""
        pair = (last + 1) << 32 | token
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._apart(last, token)
        return known

    def _apart(self, last: int, token: int) -> bool:
        """``merge``, by the sides of the two tokens where they turn to each other.

        Each token merges as it would alone until a merge joins parts of both. With ranks that only
        rise, a part stays until the rank that takes it comes; a merge over the boundary that is
        lower than the ranks that take its two parts (not above the right one's, as the left goes
        first) comes before them.
        """
        left, right = self._sides(last) if last >= 0 else None, self._sides(token)
        if not left or not right:
            return self.merge(last, token)
        ends, begins, get = left[1], right[0], self.ids.get
        i = j = 0
        while True:
            a, until_a = ends[i]
            b, until_b = begins[j]
            rank = get(a + b)
            if rank is not None and rank < until_a and rank <= until_b:
                return False
            if until_a <= until_b:
                if until_a == NEVER:
                    return True
                i += 1
            else:
                j += 1

    def _sides(self, token: int) -> tuple[list, list] | None:
        """The first and the last parts of a token while it merges, each with the rank that ends it.

        None if ranks fall on the way, or if merging does not give the token.
        """
        if token in self.sides:
            return self.sides[token]
        whole, get = self.raw[token], self.ids.get
        parts = [whole[k : k + 1] for k in range(len(whole))]
        begins, ends, before = [], [], -1
        ranks = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == NEVER or best < before:
                break
            before, at = best, ranks.index(best)
            if at == 0:
                begins.append((parts[0], best))
            if at == len(ranks) - 1:
                ends.append((parts[-1], best))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], NEVER)
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], NEVER)
        found = None
        if len(parts) == 1:
            found = [*begins, (whole, NEVER)], [*ends, (whole, NEVER)]
        self.sides[token] = found
        return found

    def merge(self, last: int, token: int) -> bool:
        """Whether merging the bytes of ``last`` (-1: none) and ``token`` gives just these two.

        Merges go by lowest rank and from the left; one that crosses the boundary decides.
        """
        parts: list[bytes] = []
        for x in (last, token):
            if x >= 0:
                parts += [self.raw[x][k : k + 1] for k in range(len(self.raw[x]))]
        border = len(self.raw[last]) if last >= 0 else 0
        get, none = self.ids.get, len(self.raw) + (1 << 40)
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            if at + 1 == border:
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            border -= at + 1 < border
            del ranks[at]
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], none)
        return len(parts) == (1 if last < 0 else 2)

    def _state(self, state: tuple) -> int:
        number = self.numbers.get(state)
        if number is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
        return number

    def _step(self, number: int, byte: int) -> tuple[int, tuple]:
        """The state after one more byte and the tokens that are now certain."""
        under, pairs = self.under.get, self.pairs.get
        going, ended = [], None
        for node, last, held in self.states[number][1:]:
            below = under(node << 8 | byte)
            if below is None:
                continue
            node, token, more = below
            if more:
                going.append((node, last, held))
            # All bytes read so far are whole tokens in one way only.
            if ended is None and token is not None:
                known = pairs((last + 1) << 32 | token)
                if self.fits(last, token) if known is None else known:
                    ended = 0, token, (*held, token)
        going.append(ended)
        certain = going[0][2]
        if certain:
            for guess in going:
                while guess[2][: len(certain)] != certain:
                    certain = certain[:-1]
            if sure := len(certain):
                going = [(node, last, held[sure:]) for node, last, held in going]
        state = (self.begun[going[0][0]], *going)
        if len(self.states) >= self.most:
            self._forget()
            return self._state(state), certain
        found = self.steps[number << 8 | byte] = (self._state(state), certain)
        return found

    def _read(self, state: int, some: bytes, out: list[int]) -> int:
        """The state after some bytes; tokens that become certain go to ``out``."""
        known = self.steps.get
        for byte in some:
            state, certain = known(state << 8 | byte) or self._step(state, byte)
            if certain:
                out += certain
        return state

    def _end(self, number: int, byte: int) -> tuple | None:
        """The tokens held back if this byte is the last one; no state is made of it."""
        for node, last, held in self.states[number][1:]:
            _, token, _ = self.under.get(node << 8 | byte, NOWHERE)
            if token is not None:
                known = self.pairs.get((last + 1) << 32 | token)
                if self.fits(last, token) if known is None else known:
                    return *held, token
        return None

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the word pattern."""
        out: list[int] = []
        if not piece:
            return out
        if len(piece) > HEAD:
            head, rest = piece[:HEAD], piece[HEAD:-1]
            found = self.heads.get(head)
            if found is None:
                state = self._read(0, head, out)
                # States may have been forgotten on the way, but this one is there.
                if len(self.heads) < self.most:
                    self.heads[head] = state, tuple(out)
            else:
                state, certain = found
                out += certain
        else:
            state, rest = 0, piece[:-1]
        if rest:
            state = self._read(state, rest, out)
        out += self._end(state, piece[-1])
        # A token that no merges make stands only for a whole match.
        if len(out) > 1 and piece in self.ids:
            return [self.ids[piece]]
        return out


LATIN = "".join(map(chr, range(0x250)))  # Long settled: no letters are added here.
UNKNOWN = "\ue000"  # Of private use: neither letter, number nor blank to either table.


def newer_letters() -> dict[str, str]:
    """Letters and numbers that this ``regex`` knows and the tokenizer library's tables do not.

    Only code points that this Python does not know either can be among them. Each is asked for by
    a vocabulary in which a letter, a number and a sign merge with the byte after them.
    """
    import regex
    import tiktoken

    known = regex.compile(r"[\p{L}\p{N}]")
    ranks = {bytes([b]): b for b in range(256)}
    for first in (b"a", b"1"):
        for b in range(256):
            ranks.setdefault(first + bytes([b]), len(ranks))
    asked = tiktoken.Encoding("asked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {}
    for code in range(0x80, 0x110000):
        char = chr(code)
        if unicodedata.category(char) != "Cn" or not known.match(char):
            continue
        size = len(char.encode())
        if all(len(asked.encode_ordinary(first + char)) > size for first in "a1"):
            out[char] = UNKNOWN
    return out


class Splitter:
    """Matches of the word pattern as the tokenizer library finds them."""

    def __init__(self):
        import regex

        self.pattern = regex.compile(PATTERN)

        def own(kind: str) -> str:
            """The Latin characters of a kind as a class for ``re``, which has no kinds."""
            return "".join(f"\\u{ord(x):04x}" for x in regex.findall(kind, LATIN))

        letter, number, blank = own(r"\p{L}"), own(r"\p{N}"), own(r"\s")
        # The same pattern; letters come first, as most matches are words.
        self.latin = re.compile(
            f" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{blank}{letter}{number}]+"
            f"|[{blank}]+(?![^{blank}])|[{blank}]+"
        )
        self.beyond_latin = re.compile(f"[^{LATIN[0]}-{LATIN[-1]}]").search
        self.newer = newer_letters()
        self.table = str.maketrans(self.newer)
        self.none_newer = frozenset(self.newer).isdisjoint

    def matches(self, text: str) -> Iterator[list[str]]:
        """All matches in order, some at a time."""
        latin = text.isascii() or not self.beyond_latin(text)
        if latin or self.none_newer(text):
            pattern = self.latin if latin else self.pattern
            if len(text) < BYTES_A_SLICE:
                yield pattern.findall(text)
                return
            found = (m.group() for m in pattern.finditer(text))
        else:
            found = (text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.table)))
        while part := list(islice(found, PIECES_A_TIME)):
            yield part


class Encoder:
    """Whole texts to ids; a match seen before takes the way it took through the machine then."""

    def __init__(self, ranks: dict[bytes, int]):
        self.machine, self.splitter = Transducer(ranks), Splitter()
        self.table = WordTable(self._read, MOST_MATCHES)

    def _read(self, pieces: list[str]) -> list[list[int]]:
        raw = [piece.encode() for piece in pieces]
        out: list[list[int]] = [[]] * len(raw)
        # In order, so that neighbours share their first states.
        for k in sorted(range(len(raw)), key=raw.__getitem__):
            out[k] = self.machine.encode(raw[k])
        return out

    def encode(self, docs: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in docs]
        waiting: list[tuple[int, int]] = []
        pieces: list[str] = []

        def flush() -> None:
            flat, sizes = self.table.tokens(self.table.ids(pieces))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            at = 0
            for doc, n in waiting:
                out[doc].append(flat[ends[at] : ends[at + n]])
                at += n
            waiting.clear()
            pieces.clear()

        for doc, text in enumerate(docs):
            for part in self.splitter.matches(text):
                waiting.append((doc, len(part)))
                pieces.extend(part)
                if len(pieces) >= PIECES_A_TIME:
                    flush()
        flush()
        return [np.concatenate(parts) if parts else np.zeros(0, np.int32) for parts in out]


#: What may follow a first byte of a character of two, three and four bytes.
FOLLOWS = (
    (0xC2, 0xDF, 0x80, 0xBF, 1),
    (0xE0, 0xE0, 0xA0, 0xBF, 2),
    (0xE1, 0xEC, 0x80, 0xBF, 2),
    (0xED, 0xED, 0x80, 0x9F, 2),
    (0xEE, 0xEF, 0x80, 0xBF, 2),
    (0xF0, 0xF0, 0x90, 0xBF, 3),
    (0xF1, 0xF3, 0x80, 0xBF, 3),
    (0xF4, 0xF4, 0x80, 0x8F, 3),
)
FIRST = {
    byte: (low, high, left)
    for begin, end, low, high, left in FOLLOWS
    for byte in range(begin, end + 1)
}
BROKEN = "\ufffd"


def advance(held: bytes, wants: tuple | None, raw: bytes) -> tuple[str, bytes, tuple | None]:
    """Characters that ``raw`` completes, the bytes then held, and what the next byte must be.

    ``wants`` is (lowest, highest, bytes left), or None between characters. A character that cannot
    go on is U+FFFD, once for the bytes that were right, and the byte is read again as a first one.
    """
    out = []
    for byte in raw:
        if wants and wants[0] <= byte <= wants[1]:
            held += bytes([byte])
            wants = (0x80, 0xBF, wants[2] - 1)
            if not wants[2]:
                out.append(held.decode())
                held, wants = b"", None
            continue
        if wants:
            out.append(BROKEN)
            held, wants = b"", None
        if byte < 0x80:
            out.append(chr(byte))
        elif byte in FIRST:
            held, wants = bytes([byte]), FIRST[byte]
        else:
            out.append(BROKEN)
    return "".join(out), held, wants


def whole_texts(raw: dict[int, bytes]) -> dict[int, str]:
    """The machine's steps from rest to rest: tokens that are whole characters, and their texts."""
    steps = {token: advance(b"", None, content) for token, content in raw.items()}
    return {token: text for token, (text, held, _) in steps.items() if not held}


class StreamDecoder:
    """Token ids in, whole characters out; ids may come one at a time.

    ``whole`` are the steps from rest to rest and ``known`` steps of all other kinds, if there
    are tables of them; a stretch of the former is joined at once.
    """

    STRETCH = 512

    def __init__(
        self, raw: dict[int, bytes], whole: dict[int, str] | None = None, known: dict | None = None
    ):
        self.raw, self.whole, self.known = raw, whole or {}, {} if known is None else known
        self.state: tuple[bytes, tuple | None] = (b"", None)

    def push(self, ids: Sequence[int]) -> str:
        out = []
        for first in range(0, len(ids), self.STRETCH):
            some = ids[first : first + self.STRETCH]
            if not self.state[0]:
                try:
                    out.append("".join(map(self.whole.__getitem__, some)))
                    continue
                except KeyError:
                    pass
            out.append(self._steps(some))
        return "".join(out)

    def _steps(self, ids: Sequence[int]) -> str:
        out, state, known = [], self.state, self.known
        for token in ids:
            step = known.get((state[0], token))
            if step is None:
                text, held, wants = advance(*state, self.raw.get(token, b"\xff"))
                # Held bytes say what may follow, so they are the machine's whole state.
                step = known[state[0], token] = (text, (held, wants))
            out.append(step[0])
            state = step[1]
        self.state = state
        return "".join(out)

    def finish(self) -> str:
        held, self.state = self.state[0], (b"", None)
        return BROKEN if held else ""


def _encoder(folder: str, ranks: str) -> Encoder:
    return per_worker(
        ("bpe", folder, ranks),
        lambda: Encoder(read_ranks(os.path.join(folder, ranks))),
        alone=True,
    )


def _encode(folder: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(folder, ranks)
        # States, pairs and matches are many and hold no cycles; the collector would walk them
        # again and again, a third of the time.
        gc.disable()
        try:
            for batch in batches:
                docs = strings(batch["text"])
                for first, last in slices([len(text) for text in docs], BYTES_A_SLICE):
                    ids = encoder.encode(docs[first:last])
                    bounds = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["row"].slice(first, last - first),
                            pa.ListArray.from_arrays(
                                pa.array(bounds, pa.int32()),
                                pa.array(np.concatenate(ids), pa.int32()),
                            ),
                        ],
                        ["row", "ids"],
                    )
        finally:
            gc.enable()

    return run


def _decode(folder: str, ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def load() -> tuple[dict[int, bytes], dict[int, str]]:
            raw = {k: token for token, k in read_ranks(os.path.join(folder, ranks)).items()}
            return raw, whole_texts(raw)

        raw, whole = per_worker(("bpe bytes", folder, ranks), load)
        known: dict = {}
        for batch in batches:
            out = []
            for ids in batch["ids"]:
                decoder = StreamDecoder(raw, whole, known)
                # A null among the ids is as unknown as a number the vocabulary lacks.
                values = ids.values.fill_null(-1).to_numpy().tolist() if ids.is_valid else []
                out.append(decoder.push(values) + decoder.finish())
                if len(known) > MOST_DECODED:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(out, pa.string())], ["row", "text"]
            )

    return run


def encode(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    tokenizers: str = TOKENIZERS,
    ranks: str = RANKS,
) -> tuple[DataFrame, str]:
    """The columns ``keep`` and the ids of every whole text; returns the frame and the ids' name.

    The ids are those of the public tokenizer library without special tokens. A null or empty text
    has no ids; bytes that are not UTF-8 are read as U+FFFD; repeated rows each have theirs; other
    columns are left behind; an empty table gives no rows. Nothing is shuffled; a worker holds the
    vocabulary, a bounded number of states and of matches, and the ids of about one MB of texts
    or of one longer text. The column is called ``ids``, with underscores where that is taken.
    """
    kept = docs.select(*keep)
    name = free_name(kept, "ids")
    kinds = ", ".join(f"`{c}`: {kept.schema[c].dataType.simpleString()}" for c in keep)
    found = docs.select(
        F.struct(*keep).alias("row"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_encode(tokenizers, ranks), f"row struct<{kinds}>, ids array<int>")
    return found.select("row.*", F.col("ids").alias(name)), name


def decode(
    tokens: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    ids_col: str = "ids",
    tokenizers: str = TOKENIZERS,
    ranks: str = RANKS,
) -> tuple[DataFrame, str]:
    """The columns ``keep`` and the text of every row's ids; returns the frame and the text's name.

    Null or no ids are an empty text; an id that the vocabulary lacks, and bytes that are no
    character, are U+FFFD. The column is called ``text``, with underscores where that is taken.
    """
    kept = tokens.select(*keep)
    name = free_name(kept, "text")
    kinds = ", ".join(f"`{c}`: {kept.schema[c].dataType.simpleString()}" for c in keep)
    found = tokens.select(
        F.struct(*keep).alias("row"), F.col(ids_col).cast("array<int>").alias("ids")
    ).mapInArrow(_decode(tokenizers, ranks), f"row struct<{kinds}>, text string")
    return found.select("row.*", F.col("text").alias(name)), name
