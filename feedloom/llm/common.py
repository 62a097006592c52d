"""Helpers the operators share: whole texts as bytes, word tables, written intermediates."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import prepare, shared_dir

#: Where the public tokenizer files are; every operator takes another folder as a parameter.
TOKENIZERS = "/opt/tokenizers"
PIECES = "piece_bpe_32k.model"


def kept_table(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` below the shared folder and read it back: lineage ends, executors may go."""
    path = shared_dir(prepare(frame.sparkSession), name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``frame`` has it (in any case)."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; a null text is an empty one."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The texts as Python strings; bytes that are not UTF-8 become U+FFFD, null is empty."""
    try:
        return [value or "" for value in column.to_pylist()]
    except UnicodeDecodeError:
        return [value.decode("utf-8", "replace") for value in texts(column)]


def slices(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows of about ``most`` bytes together; a longer row stands alone."""
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if row > first and held + size > most:
            yield first, row
            first, held = row, 0
        held += size
    if first < len(sizes):
        yield first, len(sizes)


def utf8(raw: bytes) -> str:
    return raw.decode("utf-8", "replace")


class _Numbers(dict):
    """Words by number; a word that is asked for first gets the next."""

    def __missing__(self, word) -> int:
        number = self[word] = len(self)
        return number


class WordTable:
    """Token sequences of words, each encoded once per worker.

    ``encode`` maps a list of words to their sequences. The table is emptied when it would pass
    ``most`` words, so memory is bounded whatever the corpus; results never depend on it.
    """

    def __init__(self, encode: Callable[[list], Iterable[Sequence[int]]], most: int = 300_000):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.index = _Numbers()
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    @property
    def held(self) -> int:
        """How many words have their sequences."""
        return len(self.starts) - 1

    def ids(self, words: Sequence) -> np.ndarray:
        """Place of each word in the table; new words are encoded first."""
        places = self._places(words)
        if self.held and len(self.index) > self.most:
            self._clear()
            places = self._places(words)
        if len(self.index) > self.held:
            try:
                encoded = list(self.encode(list(islice(reversed(self.index), len(self.index) - self.held))[::-1]))
            except BaseException:
                self._clear()  # No word stays without its sequence.
                raise
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            more = np.fromiter(chain.from_iterable(encoded), np.int32, int(sizes.sum()))
            self.flat = np.concatenate([self.flat, more])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return places

    def _places(self, words: Sequence) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        return self.starts[ids + 1] - self.starts[ids]

    def tokens(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All tokens of the words in a row, and how many each word has."""
        sizes = self.sizes(ids)
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            self.starts[ids] - (ends - sizes), sizes
        )
        return self.flat[places], sizes


_LOADED: dict = {}


_ALONE: list = []


def per_worker(key: tuple, make: Callable, *, alone: bool = False):
    """What ``make`` gives, made once per Python worker and key.

    Workers outlive stages. Of the things that may grow large (``alone``) a worker holds one, so
    the word table of one operator does not stay while another operator fills its own.
    """
    if alone and key not in _ALONE:
        for other in _ALONE:
            _LOADED.pop(other, None)
        _ALONE[:] = [key]
        # A word table and its owner refer to each other; the collector would hardly ever come by.
        gc.collect()
    if key not in _LOADED:
        _LOADED[key] = make()
    return _LOADED[key]


def sentence_pieces(folder: str = TOKENIZERS):
    """The public SentencePiece vocabulary, loaded once per worker."""

    def load():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECES))

    return per_worker(("pieces", folder), load)


def rank_encoding(name: str, folder: str = TOKENIZERS, pattern: str | None = None):
    """A public byte-level BPE vocabulary given as ranks, loaded once per worker and word pattern."""

    def load():
        import base64

        import tiktoken

        with open(os.path.join(folder, name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        return tiktoken.Encoding(
            name, pat_str=pattern or PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    return per_worker((name, folder, pattern), load)


def encode_apart(encoding, units: list[str], line_end: int) -> list[list[int]]:
    """Ids of each unit by itself, in one call: a line end between two units is its own token.

    Units that hold or touch other white space can join with the line end; if so the ends do not
    come out in number, and the units are encoded one by one.
    """
    ids = encoding.encode_ordinary("\n".join(units))
    ends = [k for k, x in enumerate(ids) if x == line_end]
    if len(ends) != len(units) - 1 or any("\n" in unit for unit in units):
        return [encoding.encode_ordinary(unit) for unit in units]
    return [ids[a + 1 : b] for a, b in zip([-1, *ends], [*ends, len(ids)])]


#: Fixed value: the word pattern of the public byte-level BPE vocabularies.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def lower_ascii(column):
    """A-Z in lower case, all other characters as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
