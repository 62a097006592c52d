"""Dictionary-compressed web archives.

Every archive is a Zstandard stream of its own: a skippable frame with the dictionary comes
first, then each record as a frame by itself, so a record can be read from its offset alone. The
dictionary is built from records of the very table. Payloads that occur again are written as
revisits of the first.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import texts
from feedloom.session import shared_dir

#: The frame that leads an archive, and an empty frame that readers skip.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"
#: Bounds of the dictionary's sample: records, and bytes of each.
SAMPLE_RECORDS, SAMPLE_BYTES = 400, 1 << 16
DICTIONARY_BYTES, LEVEL = 64 << 10, 3
DATE = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of the samples, or none (empty) where they are too few or too small."""
    if len(samples) < 8 or sum(map(len, samples)) < 4096:
        return b""
    size = min(size, max(1024, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One archive record: headers, a blank line, the payload (none for a revisit), two ends."""
    body = b"" if revisit else payload
    # Ends of lines in a url would break the header; they are percent-encoded.
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def frames(content: bytes) -> Iterator[tuple[int, bytes]]:
    """(magic, content) of each frame of an archive; records are decompressed."""
    decompressor, at, view = zstandard.ZstdDecompressor(), 0, memoryview(content)
    while at < len(content):
        magic = struct.unpack_from("<I", content, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            size = struct.unpack_from("<I", content, at + 4)[0]
            if magic == DICTIONARY_MAGIC:
                held = zstandard.ZstdCompressionDict(content[at + 8 : at + 8 + size])
                decompressor = zstandard.ZstdDecompressor(dict_data=held)
            yield magic, content[at + 8 : at + 8 + size]
            at += 8 + size
            continue
        one, parts = decompressor.decompressobj(), []
        while not one.eof:
            if at >= len(content):
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(view[at : at + 16_384]))
            at += min(16_384, len(content) - at)
        at -= len(one.unused_data)
        yield magic, b"".join(parts)


def _write(dictionary: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if held:
            held.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=True)
        started = False
        for batch in batches:
            out = []
            if not started and dictionary and batch.num_rows:
                out.append(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
            started = started or batch.num_rows > 0
            columns = [batch[c].to_pylist() for c in ("page_id", "url", "digest", "first")]
            for (page_id, url, digest, first), payload in zip(
                zip(*columns), texts(batch["html"])
            ):
                revisit = first is not None and first != page_id
                out.append(
                    compressor.compress(record(page_id, url, payload, digest, first, revisit))
                )
            yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.binary())})

    return write


def write_archives(
    pages: DataFrame,
    path: str | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 0,
) -> str:
    """Archive every page below ``path``; returns the path.

    Of pages with equal payloads of at least ``least_bytes`` bytes, that with the smallest id is
    a response and the others revisit it. A null html is an empty payload; a null id revisits
    the smallest id if there is one, else is a response; rows that share the smallest id are
    responses each; other columns are ignored; an empty table gives empty archives. Only
    payloads found twice are looked up by digest, after a map-side combined count.
    """
    spark = pages.sparkSession
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha1"),
        F.octet_length(html).alias("size"),
    )
    again = (
        rows.where(F.col("size") >= least_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("sha1", "first")
    )
    sample = (
        rows.where((F.col("size") > 0) & (F.col("size") <= SAMPLE_BYTES))
        .select("sha1", "page_id", "url", "html")
        .orderBy("sha1", "page_id")
        .limit(SAMPLE_RECORDS)
        .collect()
    )
    samples = {
        r.sha1: record(r.page_id, r.url, r.html.encode(), payload_digest(r.html.encode()), None, False)
        for r in sample
    }
    dictionary = train(list(samples.values()))
    path = path or shared_dir(spark, "archives")
    joined = rows.join(again, "sha1", "left")
    joined = joined.withColumn("first", F.when(F.col("size") >= least_bytes, F.col("first")))
    (
        joined.select("page_id", "url", "html", base32("sha1").alias("digest"), "first")
        .mapInArrow(_write(dictionary), "value binary")
        .select(F.col("value").cast("string").alias("value"))
        # What stands between two frames is itself an empty frame, which readers skip.
        .write.option("lineSep", EMPTY_FRAME)
        .text(path)
    )
    return path


def base32(column: str):
    """Upper-case base32 of a hex digest of 40 digits, in the JVM."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.concat(
        *(
            F.substring(
                F.lit(alphabet),
                F.shiftright(
                    F.conv(F.substring(column, 5 * k + 1, 5), 16, 10).cast("int"), shift
                ).bitwiseAND(F.lit(31)) + 1,
                F.lit(1),
            )
            for k in range(8)
            for shift in (15, 10, 5, 0)
        )
    )


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch["content"].to_pylist():
            out = []
            for magic, raw in frames(content):
                if magic != ZSTD_MAGIC:
                    continue
                head, _, rest = raw.partition(b"\r\n\r\n")
                fields = dict(
                    line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line
                )
                body = rest[: int(fields["Content-Length"])]
                revisit = fields["WARC-Type"] == "revisit"
                digest, size = fields["WARC-Payload-Digest"][5:], int(fields["X-Payload-Length"])
                if not revisit and (payload_digest(body) != digest or len(body) != size):
                    raise ValueError(f"record {fields['WARC-Record-ID']} is not what was written")
                number = [
                    fields[name][10:-1] if name in fields else ""
                    for name in ("WARC-Record-ID", "WARC-Refers-To")
                ]
                out.append(
                    {
                        "page_id": int(number[0]) if number[0] else None,
                        "url": fields.get("WARC-Target-URI", ""),
                        "payload_bytes": size,
                        "payload_digest": digest,
                        "record_type": fields["WARC-Type"],
                        "refers_to": int(number[1]) if number[1] else None,
                        "payload": None if revisit else body,
                    }
                )
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, RECORD)
                    out = []
            yield pa.RecordBatch.from_pylist(out, RECORD)


RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)
RECORD_DDL = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``; a response's payload is checked by its digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_read, RECORD_DDL)
