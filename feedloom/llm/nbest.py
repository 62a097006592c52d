"""SentencePiece encoding and decoding with N-best segmentation.

The forward Viterbi scores of a lattice node are the best that any path to it can have, so they
are exact heuristics of the backward A-star search: a partial path from the end is ranked by its
own score plus the Viterbi score of its first node, and complete paths leave the queue best
first. No piece reaches over the beginning of a word, so all paths meet at word boundaries and a
document's best segmentation is that of its words. Of its N best, only the N - 1 words with the
smallest loss to their second segmentation can differ (any other deviation is beaten by those
single ones), so the search runs over the lattice of these words, the others being fixed.

The words that a slice of texts brings are segmented together, each step of the two passes over
their lattices taking one place of all words at once.
"""

from __future__ import annotations

import heapq
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import TOKENIZERS, WordTable, per_worker, slices, strings
from feedloom.llm.pieces import Pieces, load_pieces, prepared, raw_bytes

#: A unit: spaces and the word they lead to, spaces that end a line or text, or a line end.
UNIT = re.compile(" *[^ \n]+| +|\n")
BYTES_A_SLICE = 1 << 20
#: Units of at most so many characters are segmented together, if there are at least so many.
LONGEST_TOGETHER, FEWEST_TOGETHER = 64, 100
CHARS_TOGETHER = 1 << 16
RESULT = (
    "ids array<int>, score double, alternatives array<struct<score:double,"
    "edits:array<struct<start:int,length:int,ids:array<int>>>>>"
)


class Lattice:
    """The lattice of one or more prepared units, which no piece joins, with Viterbi scores."""

    def __init__(self, pieces: Pieces, edges: dict, units: list[str]):
        self.ending: list[list[tuple[int, float, tuple[int, ...]]]] = [[]]
        self.best = [0.0]
        scores, ids, unknown = pieces.scores, pieces.ids, pieces.unknown
        for text in units:
            base, n = len(self.best) - 1, len(text)
            self.best += [-math.inf] * n
            self.ending += [[] for _ in range(n)]
            for i in range(n):
                a = self.best[base + i]
                j, own = i + 1, False
                while j <= n:
                    part = text[i:j]
                    if part not in edges:
                        break
                    score = edges[part]
                    if score is not None:
                        own = own or j == i + 1
                        self._edge(base + i, base + j, a, score, (ids[part],))
                    j += 1
                if not own:
                    codes = tuple(pieces.byte_ids[b] for b in raw_bytes(text[i]))
                    self._edge(base + i, base + i + 1, a, unknown, codes)

    def _edge(self, start: int, end: int, before: float, score: float, ids: tuple) -> None:
        self.ending[end].append((start, score, ids))
        if before + score > self.best[end]:
            self.best[end] = before + score

    def paths(self, n: int) -> list[tuple[float, list[tuple[int, int, tuple[int, ...]]]]]:
        """The n best paths, best first, as (start, end, ids); equal scores in a fixed order."""
        last = len(self.best) - 1
        # Of equal ranks the path that has come farthest goes on, so ties cannot fan out.
        heap = [(-self.best[last], last, 0, 0.0, None)]
        made, found = 0, []
        while heap and len(found) < n:
            _, node, _, score, tail = heapq.heappop(heap)
            if node == 0:
                path = []
                while tail is not None:
                    edge, tail = tail
                    path.append(edge)
                found.append((score, path))
                continue
            for start, value, ids in self.ending[node]:
                made += 1
                total = score + value
                heapq.heappush(
                    heap,
                    (-(total + self.best[start]), start, made, total, ((start, node, ids), tail)),
                )
        return found


def best_two(pieces: Pieces, edges: dict, text: str) -> tuple[list[int], float, float]:
    """Ids and score of the best path of a prepared unit, and what its second path loses."""
    n, none = len(text), -math.inf
    ids, unknown, edge = pieces.ids, pieces.unknown, edges.get
    best = [none] * (n + 1)
    best[0] = 0.0
    back: list = [None] * (n + 1)
    found = []
    for i in range(n):
        a = best[i]
        j, own = i + 1, False
        while j <= n:
            part = text[i:j]
            score = edge(part, best)
            if score is best:  # Begins no piece.
                break
            if score is not None:
                if j == i + 1:
                    own = True
                found.append((i, j, score))
                if a + score > best[j]:
                    best[j] = a + score
                    back[j] = (i, part)
            j += 1
        if not own:
            found.append((i, i + 1, unknown))
            if a + unknown > best[i + 1]:
                best[i + 1] = a + unknown
                back[i + 1] = (i, None)
    total = best[n]
    out: list[int] = []
    on_path = set()
    j = n
    while j:
        i, part = back[j]
        on_path.add((i, j))
        if part is None:
            out.extend(pieces.byte_ids[b] for b in reversed(raw_bytes(text[i])))
        else:
            out.append(ids[part])
        j = i
    out.reverse()
    # The second path has an edge off the best one: the best path through any such edge.
    rest = [none] * (n + 1)
    rest[n] = 0.0
    second = none
    for i, j, score in reversed(found):
        x = score + rest[j]
        if x > rest[i]:
            rest[i] = x
        if (i, j) not in on_path and best[i] + x > second:
            second = best[i] + x
    return out, total, total - second


class Branches:
    """The pieces as a tree of their characters, for steps from many of its nodes at once.

    Node 0 is beside the tree, node 1 its root. A node and a character are one key of a hash table.
    """

    SLOT_BITS = 20

    def __init__(self, pieces: Pieces, edges: dict):
        numbers = {prefix: k for k, prefix in enumerate(edges, 2)}
        numbers[""] = 1
        self.scores = np.full(len(edges) + 2, -math.inf)
        self.ids = np.full(len(edges) + 2, -1, np.int64)
        self.inner = np.zeros(len(edges) + 2, bool)
        keys = np.zeros(len(edges), np.uint64)
        for k, (prefix, score) in enumerate(edges.items()):
            above = numbers[prefix[:-1]]
            keys[k] = above << 21 | ord(prefix[-1])
            self.inner[above] = True
            if score is not None:
                self.scores[k + 2], self.ids[k + 2] = score, pieces.ids[prefix]
        bits = max(self.SLOT_BITS, (4 * len(edges)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)  # No key is 0, as no node above is.
        self.nodes = np.zeros(1 << bits, np.int32)
        left, places = np.arange(len(keys)), self._places(keys)
        while len(left):
            free = np.flatnonzero(self.keys[places] == 0)
            taken, first = np.unique(places[free], return_index=True)
            mine = left[free[first]]
            self.keys[taken], self.nodes[taken] = keys[mine], mine + 2
            rest = np.ones(len(left), bool)
            rest[free[first]] = False
            left, places = left[rest], (places[rest] + 1) & self.mask

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The node that each character leads to, 0 if no piece goes on so."""
        keys = nodes.astype(np.uint64) << np.uint64(21) | codes
        places = self._places(keys)
        there = self.keys[places]
        out = np.where(there == keys, self.nodes[places], 0)
        again = np.flatnonzero((there != keys) & (there != 0))
        while len(again):
            places = (places[again] if len(places) > len(again) else places) + 1 & self.mask
            there = self.keys[places]
            same = there == keys[again]
            out[again[same]] = self.nodes[places[same]]
            go = ~same & (there != 0)
            again, places = again[go], places[go]
        return out


def best_two_of_many(
    pieces: Pieces, branches: Branches, texts: list[str]
) -> list[tuple[list[int], float, float]]:
    """``best_two`` of many prepared units: one place of all units is a step of arrays.

    All lattices lie in a row, a unit of n characters having n + 1 nodes.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(sizes + 1) - sizes - 1
    last = first + sizes
    # The end of a unit is no character, so no piece leads over it.
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.uint64)
    codes[last] = (1 << 21) - 1
    inside = np.arange(len(codes)) - np.repeat(first, sizes + 1)
    chars = np.ones(len(codes), bool)
    chars[last] = False
    start = np.flatnonzero(chars)
    start = start[np.argsort(inside[start].astype(np.uint16), kind="stable")]
    node = np.ones(len(start), np.int32)
    longest, places = int(sizes.max()), np.arange(int(sizes.max()) + 1)
    edges = []  # By length: where they start, by place in the unit; scores; ids or the character.
    while len(start):
        length = len(edges) + 1
        node = branches.step(node, codes[start + (length - 1)])
        score, ids = branches.scores[node], branches.ids[node]
        has = ids >= 0
        if length == 1:
            score[~has] = pieces.unknown
            ids[~has] = -1 - codes[start[~has]].astype(np.int64)
            own = start
        else:
            own, score, ids = start[has], score[has], ids[has]
        edges.append((own, score, ids, np.searchsorted(inside[own], places).tolist()))
        go = branches.inner[node]
        start, node = start[go], node[go]

    best = np.full(len(codes), -math.inf)
    best[first] = 0.0
    back = np.zeros(len(codes), np.int64)  # The length of the best edge to a node, and its id.
    token = np.zeros(len(codes), np.int64)
    for i in range(longest):
        for length, (own, score, ids, cuts) in enumerate(edges, 1):
            a, b = cuts[i], cuts[i + 1]
            if a < b:
                x = best[own[a:b]] + score[a:b]
                to = own[a:b] + length
                more = x > best[to]
                to = to[more]
                best[to], back[to], token[to] = x[more], length, ids[a:b][more]

    on_path = np.zeros(len(codes), bool)
    here, unit = last, np.arange(len(texts))
    steps = []
    while len(here):
        on_path[here] = True
        steps.append((unit, token[here]))
        here = here - back[here]
        more = here > first[unit]
        here, unit = here[more], unit[more]
    units = np.concatenate([x for x, _ in reversed(steps)])
    tokens = np.concatenate([x for _, x in reversed(steps)])
    tokens = tokens[np.argsort(units, kind="stable")]
    counts = np.bincount(units, minlength=len(texts))
    spelled = np.add.reduceat(tokens < 0, np.cumsum(counts) - counts).tolist()
    ends, out, at = np.cumsum(counts).tolist(), [], 0
    tokens = tokens.tolist()
    for end, odd in zip(ends, spelled):
        found = tokens[at:end]
        if odd:
            found = [
                y
                for x in found
                for y in ([x] if x >= 0 else [pieces.byte_ids[b] for b in raw_bytes(chr(-1 - x))])
            ]
        out.append(found)
        at = end

    # The second path has an edge off the best one: the best path through any such edge.
    rest = np.full(len(codes), -math.inf)
    rest[last] = 0.0
    second = np.full(len(codes), -math.inf)
    for i in reversed(range(longest)):
        for length, (own, score, _, cuts) in enumerate(edges, 1):
            a, b = cuts[i], cuts[i + 1]
            if a < b:
                at, to = own[a:b], own[a:b] + length
                x = score[a:b] + rest[to]
                rest[at] = np.maximum(rest[at], x)
                off = ~on_path[to] | (back[to] != length)
                second[at[off]] = np.maximum(second[at[off]], best[at[off]] + x[off])
    totals = best[last]
    losses = totals - np.maximum.reduceat(second, first)
    return list(zip(out, totals.tolist(), losses.tolist()))


class Encoder:
    """Best and N-best segmentations of whole texts; units are segmented once per worker."""

    def __init__(self, pieces: Pieces, n_best: int):
        self.pieces, self.n_best = pieces, n_best
        self.edges = pieces.edges(pieces.scores)
        self.branches = Branches(pieces, self.edges)
        self.table = WordTable(self._segment, 600_000)
        self.scores = np.zeros(0)
        self.losses = np.zeros(0)

    def _segment(self, units: list[str]) -> list[list[int]]:
        found = self._best_two([prepared(unit) for unit in units])
        held = self.table.held  # Zero after the table was emptied.
        self.scores = np.concatenate([self.scores[:held], [x[1] for x in found]])
        self.losses = np.concatenate([self.losses[:held], [x[2] for x in found]])
        return [x[0] for x in found]

    def _best_two(self, units: list[str]) -> list[tuple[list[int], float, float]]:
        short = [0 < len(unit) <= LONGEST_TOGETHER for unit in units]
        if sum(short) < FEWEST_TOGETHER:
            return [best_two(self.pieces, self.edges, unit) for unit in units]
        some = [unit for unit, s in zip(units, short) if s]
        together = chain.from_iterable(
            best_two_of_many(self.pieces, self.branches, some[first:last])
            for first, last in slices([len(unit) for unit in some], CHARS_TOGETHER)
        )
        return [
            next(together) if s else best_two(self.pieces, self.edges, unit)
            for unit, s in zip(units, short)
        ]

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        return UNIT.findall(" " + text) if self.pieces.breaks else [" " + text]

    def encode(self, docs: list[str]):
        """Per text: ids (one array for all, and sizes), score, alternatives as edits."""
        units = [self.units(text) for text in docs]
        flat = [u for own in units for u in own]
        places = self.table.ids(flat)
        tokens, sizes = self.table.tokens(places)
        bounds = np.concatenate([[0], np.cumsum([len(own) for own in units])])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        scores, alternatives = [], []
        for k, own in enumerate(units):
            part = places[bounds[k] : bounds[k + 1]]
            total = float(self.scores[part].sum())
            scores.append(total)
            alternatives.append(
                self._others(own, part, total, starts[bounds[k] : bounds[k + 1] + 1])
                if self.n_best > 1
                else []
            )
        return tokens, starts[bounds], scores, alternatives

    def _others(self, units, part, total, starts):
        """The second to N-th best of a text, each as edits of its best ids."""
        losses = self.losses[part]
        most = self.n_best - 1
        if len(losses) > most:
            edge = np.partition(losses, most - 1)[most - 1]
            below = np.flatnonzero(losses < edge)
            chosen = np.sort(
                np.concatenate([below, np.flatnonzero(losses == edge)[: most - len(below)]])
            )
        else:
            chosen = np.arange(len(losses))
        chosen = chosen[np.isfinite(losses[chosen])]
        if not len(chosen):
            return []
        picked = [prepared(units[k]) for k in chosen]
        ends = list(accumulate(map(len, picked)))
        fixed = total - float(self.scores[part[chosen]].sum())
        best = [
            tuple(self.table.flat[self.table.starts[p] : self.table.starts[p + 1]].tolist())
            for p in part[chosen]
        ]
        out, skipped = [], False
        for score, path in Lattice(self.pieces, self.edges, picked).paths(self.n_best + 1):
            split: list[list[int]] = [[] for _ in picked]
            for _, end, ids in path:
                split[bisect_left(ends, end)].extend(ids)
            edits = [
                {
                    "start": int(starts[k] - starts[0]),
                    "length": int(starts[k + 1] - starts[k]),
                    "ids": ids,
                }
                for k, ids, old in zip(chosen, split, best)
                if tuple(ids) != old
            ]
            if not edits and not skipped:
                skipped = True  # The best itself.
                continue
            out.append({"score": fixed + score, "edits": edits})
        return out[: self.n_best - 1]


def apply_edits(ids: list[int], edits) -> list[int]:
    """Ids of an alternative: the best ids with its edits."""
    out = list(ids)
    for edit in sorted(edits, key=lambda e: -e["start"]):
        out[edit["start"] : edit["start"] + edit["length"]] = edit["ids"]
    return out


def decode_ids(pieces: Pieces, ids) -> str:
    """The text that ids stand for; the space put before the first word goes."""
    raw = b"".join(map(pieces.texts.__getitem__, ids))
    return raw.removeprefix(b" ").decode("utf-8", "replace")


def _encode(folder: str, n_best: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(folder)
        encoder = per_worker(("n-best", folder, n_best), lambda: Encoder(pieces, n_best), alone=True)
        for batch in batches:
            docs = strings(batch["text"])
            for first, last in slices([len(text) for text in docs], BYTES_A_SLICE):
                tokens, bounds, scores, others = encoder.encode(docs[first:last])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"].slice(first, last - first),
                        pa.ListArray.from_arrays(
                            pa.array(bounds, pa.int32()), pa.array(tokens, pa.int32())
                        ),
                        pa.array(scores, pa.float64()),
                        pa.array(others, ALTERNATIVES),
                    ],
                    ["row", "ids", "score", "alternatives"],
                )

    return encode


ALTERNATIVES = pa.list_(
    pa.struct(
        [
            ("score", pa.float64()),
            (
                "edits",
                pa.list_(
                    pa.struct(
                        [
                            ("start", pa.int32()),
                            ("length", pa.int32()),
                            ("ids", pa.list_(pa.int32())),
                        ]
                    )
                ),
            ),
        ]
    )
)


def encode(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
    n_best: int = 4,
    tokenizers: str = TOKENIZERS,
) -> DataFrame:
    """The n best segmentations of every whole text.

    Returns the columns ``keep`` and: ids of the best segmentation, its score, and the second to
    n-th best as edits of it (fewer if the text has fewer). Scores are sums of the vocabulary's
    own. Decoding gives back the very text: characters without a piece, and a raw U+2581, are
    spelled in bytes. A null or empty text has no ids, score 0 and no alternatives; repeated
    rows each have their result; other columns are left behind; an empty table gives no rows.
    Nothing is shuffled. Memory follows the longest text, as each is handled whole.
    """
    row = F.struct(*keep).alias("row")
    kinds = ", ".join(f"`{c}`: {docs.schema[c].dataType.simpleString()}" for c in keep)
    out = docs.select(row, F.col(text_col).cast("string").alias("text")).mapInArrow(
        _encode(tokenizers, n_best), f"row struct<{kinds}>, {RESULT}"
    )
    return out.select("row.*", "ids", "score", "alternatives")


def decode(
    encoded: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    ids_col: str = "ids",
    tokenizers: str = TOKENIZERS,
) -> DataFrame:
    """The columns ``keep`` and the text that the ids stand for; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(tokenizers)
        for batch in batches:
            found = [decode_ids(pieces, ids or ()) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(found, pa.string())], ["row", "text"]
            )

    kinds = ", ".join(f"`{c}`: {encoded.schema[c].dataType.simpleString()}" for c in keep)
    return (
        encoded.select(F.struct(*keep).alias("row"), F.col(ids_col).alias("ids"))
        .mapInArrow(run, f"row struct<{kinds}>, text string")
        .select("row.*", "text")
    )
