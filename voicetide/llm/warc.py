"""WARC archives in Zstandard, one frame per record.

*Writing.*  Each task writes archives of bounded length: first the dictionary as a skippable
frame, then a frame per record.  The text sink of Spark stores the frames, with
an empty skippable frame as the line separator, so archives get Spark's commit
protocol and go to any file system Spark can reach.  Records with equal payloads
become one response and revisits of it.

*Reading.*  Any ``.warc.zst``: the dictionary comes from the leading skippable
frame (plain or itself compressed), frames are found by their block headers,
each is decoded by itself and must hold exactly one record whose version line,
required headers, content length and digests are right.

Defined results.  Null html: an empty payload.  Null or unclean url: the header
is left out, or its line breaks are percent-encoded.  Of equal payloads, all
rows with the smallest page_id are responses; a missing page_id counts as larger
than any other, and if all are missing, all are responses.  An empty table
gives no archive and an empty result.  Memory: one archive (``ARCHIVE_ROWS``
frames at most) at a time.
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

from voicetide.llm.base import HOT_ROWS, dealt_join, hash_sample
from voicetide.session import fresh_path

#: Payloads from this size on are written once and then referred to.
MIN_REVISIT_BYTES = 0
#: Size of the dictionary and of the sample of page beginnings that it is trained on.
DICTIONARY_BYTES = 32_768
SAMPLE_PAGES = 400
SAMPLE_CHARS = 8_192
#: Rows (dictionary frame and records) of an archive; a task starts another one beyond it.
ARCHIVE_ROWS = 4_096
LEVEL = 3

# Fixed values of the formats.
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE = 0x184D2A50
DICTIONARY_FRAME = 0x184D2A5D
SEPARATOR = struct.pack("<II", SKIPPABLE, 0)
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
DATE = "1970-01-01T00:00:00Z"
RECORD_ID = "urn:x-page:"

RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<{RECORD_ID}{'' if page_id is None else page_id}>"


def _page(value: str) -> int | None:
    if not (value.startswith(f"<{RECORD_ID}") and value.endswith(">")):
        raise ValueError(f"unknown record id {value!r}")
    digits = value[1 + len(RECORD_ID) : -1]
    return int(digits) if digits else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; with ``refers_to`` a revisit, which holds the HTTP head only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _id(page_id),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(block)),
    }
    if url:
        head["WARC-Target-URI"] = url.replace("\r", "%0D").replace("\n", "%0A")
    if refers_to is not None:
        head |= {"WARC-Refers-To": _id(refers_to), "WARC-Profile": PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + b"\r\n" + lines.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame at ``at`` ends, from its own headers."""
    if len(data) - at < 8:
        raise ValueError(f"truncated frame at {at}")
    magic, size = struct.unpack_from("<II", data, at)
    if magic & 0xFFFFFFF0 == SKIPPABLE:
        end = at + 8 + size
    elif magic == FRAME_MAGIC:
        end = at + zstandard.frame_header_size(bytes(data[at : at + 18]))
        last = 0
        while not last:
            if end + 3 > len(data):
                raise ValueError(f"truncated frame at {at}")
            block = int.from_bytes(data[end : end + 3], "little")
            last, kind, size = block & 1, block >> 1 & 3, block >> 3
            if kind == 3:
                raise ValueError(f"reserved block type in the frame at {at}")
            end += 3 + (1 if kind == 1 else size)
        end += 4 * (data[at + 4] >> 2 & 1)
    else:
        raise ValueError(f"no frame at {at}: magic {magic:#x}")
    if end > len(data):
        raise ValueError(f"truncated frame at {at}")
    return end


def _inflate(decoder: zstandard.ZstdDecompressor, frame: bytes) -> bytes:
    """The content of one frame, whether or not its header tells the size."""
    stream = decoder.decompressobj()
    content = stream.decompress(frame)
    if not stream.eof or stream.unused_data:
        raise ValueError("a record must fill exactly one frame")
    return content


def read_archive(content: bytes) -> Iterator[bytes]:
    """The records of an archive, one per frame."""
    data = memoryview(content)
    decoder, at = zstandard.ZstdDecompressor(), 0
    while at < len(data):
        end = frame_end(data, at)
        (magic,) = struct.unpack_from("<I", data, at)
        if magic == FRAME_MAGIC:
            yield _inflate(decoder, bytes(data[at:end]))
        elif magic == DICTIONARY_FRAME and at == 0:
            raw = bytes(data[8:end])
            if raw[:4] == struct.pack("<I", FRAME_MAGIC):
                raw = _inflate(zstandard.ZstdDecompressor(), raw)
            decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
        at = end


def parse(raw: bytes) -> dict:
    """A validated record as the columns of ``RECORDS``."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if version != VERSION or not gap:
        raise ValueError(f"not a record: {raw[:40]!r}")
    pairs = [line.partition(":") for line in lines.decode().split("\r\n")]
    if any(not colon for _, colon, _ in pairs):
        raise ValueError("a header line has no colon")
    header = {k.strip().lower(): v.strip() for k, _, v in pairs}
    if missing := [k for k in REQUIRED if k.lower() not in header]:
        raise ValueError(f"headers are missing: {missing}")
    length = header["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"content length {length} does not fit {len(rest)} bytes")
    block = rest[:-4]
    if header.get("warc-block-digest") != f"sha1:{base32_sha1(block)}":
        raise ValueError("wrong block digest")
    http, end, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])
    if not end or not fields.get("Content-Length", "").isdigit():
        raise ValueError("the HTTP head is broken")
    digest = header.get("warc-payload-digest", "").removeprefix("sha1:")
    row = {
        "page_id": _page(header["warc-record-id"]), "url": header.get("warc-target-uri"),
        "record_type": header["warc-type"], "refers_to": None,
        "payload_bytes": int(fields["Content-Length"]), "payload_digest": digest, "payload": None,
    }
    if row["record_type"] == "response":
        if len(payload) != row["payload_bytes"] or base32_sha1(payload) != digest:
            raise ValueError("the payload does not fit its length or digest")
        return row | {"payload": payload}
    if row["record_type"] != "revisit" or payload or "warc-refers-to" not in header:
        raise ValueError(f"unknown or broken record of type {row['record_type']!r}")
    return row | {"refers_to": _page(header["warc-refers-to"])}


def train_dictionary(pages: DataFrame) -> bytes:
    """From the beginnings of a bounded sample of pages; empty if there are too few."""
    some = pages.select("page_id", "url", "html").filter("html <> ''")
    sample = (
        hash_sample(some, ["page_id", "url"], SAMPLE_PAGES)
        .select("page_id", "url", F.substring("html", 1, SAMPLE_CHARS).alias("html"))
        .collect()
    )
    samples = [record(r.page_id, r.url, r.html.encode("utf-8", "replace"), None) for r in sample]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little variety to train on
        return b""


def with_first(
    pages: DataFrame, least: int = MIN_REVISIT_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Adds ``payload`` and, for revisits, ``refers_to``.

    Only digests found more than once are joined back.  Their first pages are aggregated
    before the shuffle; on the way back the pages that share a frequent payload are dealt
    over many tasks by their ids.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"),
    )
    keyed = rows.withColumn("_sha1", F.sha1("payload")).withColumn("_size", F.length("payload"))
    firsts = (
        keyed.filter(F.col("_size") >= least)
        .groupBy("_sha1", "_size")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
    )
    keys = ["_sha1", "_size"]
    found = dealt_join(
        keyed, firsts.drop("_n"), keys, ["page_id", "url"], firsts.drop("_first"), "left", hot_rows
    )
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return found.select(
        "page_id", "url", "payload", F.when(again, F.col("_first")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame,
    path: str,
    least: int = MIN_REVISIT_BYTES,
    archive_rows: int = ARCHIVE_ROWS,
) -> None:
    """Archives below ``path``, each with the dictionary in front.

    Every row is a frame, so the file limit of the sink ends an archive after
    ``archive_rows`` frames, and the dictionary is sent again at each such place.
    """
    dictionary = train_dictionary(pages)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True)
        lead = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary]
        lead = lead if dictionary else []
        sent = 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = zip(*[c.to_pylist() for c in batch.slice(start, 256).columns], strict=True)
                made: list[bytes] = []
                for row in rows:
                    if (sent + len(made)) % archive_rows == 0:
                        made += lead
                    made.append(coder.compress(record(*row)))
                sent += len(made)
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    rows = with_first(pages, least).mapInArrow(frames, "value binary")
    (
        rows.select(F.col("value").cast("string"))
        .write.option("lineSep", SEPARATOR.decode("latin-1"))
        .option("maxRecordsPerFile", archive_rows)
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``, validated; a broken one fails the job."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "content")
    )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows: list[dict] = []
                try:
                    for raw in read_archive(content):
                        rows.append(parse(raw))
                        if len(rows) == 256:
                            yield _batch(rows)
                            rows = []
                except (ValueError, zstandard.ZstdError) as error:
                    raise ValueError(f"{name}: {error}") from error
                if rows:
                    yield _batch(rows)

    return files.mapInArrow(records, RECORDS)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    columns = [pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
