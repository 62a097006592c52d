"""Training order: token sequences written to fixed-stride shards in a keyed random order.

Documents are tokenised and cut into sequences, which a keyed Feistel network with cycle-walking
maps one to one onto global slots. Slots are dealt to tasks by range, sorted, and written as
records of equal length, so record k of the order is at a known place of a known file: training
reads sequentially and resumes at any slot.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import (
    PATTERN,
    TOKENIZERS,
    per_worker,
    rank_encoding,
    slices,
    strings,
)
from feedloom.session import shared_dir

RANKS = "byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256  # Free in the rank file; ends every document and fills its last sequence.
SEQUENCE, SHARD_ROWS, ROUNDS = 512, 16_384, 6
HEAD = struct.Struct("<qii")  # doc_id, part of the document, tokens that are not filling.
BYTES_A_SLICE = 1 << 20
#: Pairs of blanks, other white space, and the mark of first words.
PAIRS = ("  ", " \n", "\n ", "\n\n")
OTHERS = (
    "\x00\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ASCII_OTHERS = "".join(filter(str.isascii, OTHERS))
#: The word pattern for texts without two blanks side by side: there a blank run is one blank.
AHEAD_FREE = PATTERN.replace(r"|\s+(?!\S)", "")


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(places: np.ndarray, size: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """The slots of ``places`` under a keyed permutation of 0 .. size - 1.

    A balanced Feistel network permutes the next power of four; what falls outside is sent
    through again until it falls inside, which keeps the map one to one. The walk is under four
    steps in the mean.
    """
    half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
    shift, low = np.uint64(half), np.uint64((1 << half) - 1)
    keys = [np.uint64(xxhash.xxh64_intdigest(f"{key}:{r}")) for r in range(rounds)]
    out = places.astype(np.uint64)
    walking = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(walking):
            left, right = out[walking] >> shift, out[walking] & low
            for k in keys:
                left, right = right, left ^ (mix(right + k) & low)
            out[walking] = (left << shift) | right
            walking = walking[out[walking] >= np.uint64(size)]
    return out.astype(np.int64)


def joined(text: str) -> bool:
    """Whether blanks may stand side by side: there the word pattern looks over unit boundaries."""
    others = ASCII_OTHERS if text.isascii() else OTHERS
    return any(pair in text for pair in PAIRS) or any(blank in text for blank in others)


class Tokens:
    """Exact byte-level BPE of whole texts.

    The word pattern looks ahead only where blanks stand side by side. Other texts go through the
    same vocabulary with a pattern that never does, which its matcher runs much faster.
    """

    def __init__(self, folder: str):
        self.encoding = rank_encoding(RANKS, folder)
        self.ahead_free = rank_encoding(RANKS, folder, AHEAD_FREE)

    def encode(self, docs: list[str]) -> list[list[int]]:
        """Ids of every text, END_OF_TEXT last."""
        out = [
            (self.encoding if joined(text) else self.ahead_free).encode_ordinary(text) for text in docs
        ]
        for ids in out:
            ids.append(END_OF_TEXT)
        return out


def _tokens(folder: str) -> Tokens:
    return per_worker(("tokens", folder), lambda: Tokens(folder), alone=True)


def _encoded(batches, folder: str) -> Iterator[tuple[list, list[list[int]]]]:
    tokens = _tokens(folder)
    for batch in batches:
        docs, keys = strings(batch["text"]), batch["doc_id"].to_pylist()
        for first, last in slices([len(text) for text in docs], BYTES_A_SLICE):
            yield keys[first:last], tokens.encode(docs[first:last])


def _count(folder: str, length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, xxhash.xxh64()
        for keys, encoded in _encoded(batches, folder):
            for key, ids in zip(keys, encoded):
                total += -(-len(ids) // length)
                seen.update(f"{key}:{len(ids)};")
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()),
                "n": pa.array([total], pa.int64()),
                "seen": pa.array([seen.hexdigest()], pa.string()),
            }
        )

    return count


def _place(folder: str, length: int, key: int, offsets):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = offsets.value
        part = TaskContext.get().partitionId()
        at, expected = known.get(part, (0, None))
        seen = xxhash.xxh64()
        for keys, encoded in _encoded(batches, folder):
            records = []
            for doc_id, ids in zip(keys, encoded):
                seen.update(f"{doc_id}:{len(ids)};")
                n = -(-len(ids) // length)
                filled = np.full(n * length, END_OF_TEXT, "<u2")
                filled[: len(ids)] = ids
                for k in range(n):
                    valid = min(length, len(ids) - k * length)
                    records.append(
                        head_bytes(doc_id, k, valid)
                        + filled[k * length : (k + 1) * length].tobytes()
                    )
            slots = permuted(np.arange(at, at + len(records)), size, key)
            at += len(records)
            yield pa.RecordBatch.from_pydict(
                {"slot": pa.array(slots, pa.int64()), "record": pa.array(records, pa.binary())}
            )
        if seen.hexdigest() != expected and (expected is not None or seen.intdigest() != EMPTY):
            raise RuntimeError(f"partition {part} holds other rows than when it was counted")

    return place


EMPTY = xxhash.xxh64().intdigest()


def head_bytes(doc_id: int | None, part: int, n_tokens: int) -> bytes:
    return HEAD.pack(-1 if doc_id is None else doc_id, part, n_tokens)


def stride(length: int = SEQUENCE) -> int:
    """Bytes of a record: head, two bytes a token, and the line end the writer puts after it."""
    return HEAD.size + 2 * length + 1


def write_order(
    docs: DataFrame,
    path: str | None = None,
    key: int = 20_24,
    length: int = SEQUENCE,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizers: str = TOKENIZERS,
) -> tuple[str, int]:
    """Write the shards ``shard=<k>/`` below ``path``; returns the path and the sequences' number.

    Record r of shard k is slot ``k * shard_rows + r`` and starts at byte ``r * stride(length)``.
    A null or empty text is one sequence that only ends; a null id is written as -1; repeated
    rows are sequences of their own; other columns are ignored; an empty table gives no shards.

    ``docs`` must be read from files (or a checkpoint): sequences are numbered by the partitions
    of that read, which a repeated task reads again in the same order. Each task proves it by a
    digest of its rows and fails if they are not those that were counted. Tokens are made twice
    rather than stored: the records are then the only shuffle.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    counts = (
        rows.mapInArrow(_count(tokenizers, length), "part long, n long, seen string")
        .collect()  # One small row per input partition.
    )
    offsets, size = {}, 0
    for row in sorted(counts):
        offsets[row.part] = (size, row.seen)
        size += row.n
    path = path or shared_dir(spark, "training-order")
    if not size:
        return path, 0
    known = spark.sparkContext.broadcast((offsets, size))
    placed = rows.mapInArrow(_place(tokenizers, length, key, known), "slot long, record binary")
    shards = -(-size // shard_rows)
    tasks = min(shards, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shard = F.floor(F.col("slot") / shard_rows).cast("int")
    (
        placed.withColumn("shard", shard)
        .repartitionById(tasks, F.floor(F.col("shard") * F.lit(tasks) / F.lit(shards)).cast("int"))
        .sortWithinPartitions("shard", "slot")
        .select("shard", F.col("record").cast("string").alias("value"))
        .write.partitionBy("shard")
        .text(path)
    )
    return path, size


def read_order(
    spark: SparkSession,
    path: str,
    size: int,
    length: int = SEQUENCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Every record of the shards: slot, doc_id (null for -1), part, n_tokens, ids."""
    step, head = stride(length), HEAD.size

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch["shard"].to_pylist(), batch["content"].to_pylist()):
                raw = np.frombuffer(content, np.uint8).reshape(-1, step)
                for first in range(0, len(raw), 2048):
                    part = raw[first : first + 2048]
                    heads = np.frombuffer(
                        part[:, :head].tobytes(), [("d", "<i8"), ("p", "<i4"), ("n", "<i4")]
                    )
                    ids = np.frombuffer(part[:, head:-1].tobytes(), "<u2").astype(np.int32)
                    # Arrow drops the filling: ids of each record up to its tokens.
                    kept = np.arange(length) < heads["n"][:, None]
                    slots = shard * shard_rows + first + np.arange(len(part))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "slot": pa.array(slots, pa.int64()),
                            "doc_id": pa.array(heads["d"].astype(np.int64), pa.int64(), mask=heads["d"] == -1),
                            "part": pa.array(heads["p"].astype(np.int32), pa.int32()),
                            "n_tokens": pa.array(heads["n"].astype(np.int32), pa.int32()),
                            "ids": pa.ListArray.from_arrays(
                                pa.array(np.concatenate([[0], np.cumsum(heads["n"])]), pa.int32()),
                                pa.array(ids.reshape(-1, length)[kept], pa.int32()),
                            ),
                        }
                    )

    if not size:
        return spark.createDataFrame([], ORDER)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    ).select(F.col("shard").cast("long").alias("shard"), "content")
    return files.mapInArrow(read, ORDER)


ORDER = "slot long, doc_id long, part int, n_tokens int, ids array<int>"
