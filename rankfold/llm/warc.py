"""WARC records in seekable Zstandard files.

A file is a run of independent Zstandard frames of about ``frame_bytes`` of
WARC/1.1 records, a skippable frame that maps each record identifier to its
frame, its offset in the decompressed frame and its length, and the seek table
of the Zstandard seekable format as the last skippable frame.  Any Zstandard
reader decompresses the whole file; a reader with the seek table decompresses
one frame for one record.

Records with equal payloads: the one with the smallest page id is written as
a response, the others as revisits that refer to it.

Edge cases: a null html is an empty payload; empty payloads count as equal
when ``min_revisit_bytes`` is 0; line breaks and other control characters in
a URL are percent-encoded, a null URL gives no target; rows with a null
page_id are responses unless a row with an id has the payload; rows that share
page_id and payload are all responses (or all revisits of the same response);
an empty table gives no file and no row; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm.store import read_files, shared_path, write_files

# Fixed values of the Zstandard seekable format.
SKIPPABLE, INDEX_FRAME = 0x184D2A5E, 0x184D2A50
SEEK_MAGIC = struct.pack("<I", 0x8F92EAB1)
URN = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
SCHEMA = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _name(page_id: int | None) -> str:
    return f"<{URN}{'' if page_id is None else page_id}>"


def _clean(url: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, date: str, response: int | None) -> bytes:
    """One WARC record; ``response``: the page that has the payload, if it is
    another one."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (HTTP % len(payload)).encode()
    block = http if response is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if response is None else 'revisit'}",
            f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if response is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(response)}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _skippable(magic: int, body: bytes) -> bytes:
    return struct.pack("<II", magic, len(body)) + body


def _bundle(frames: list[tuple[bytes, int]], index: list[tuple[str, int, int, int]]) -> bytes:
    """A file without its last four bytes, the seekable format's magic number."""
    import zstandard
    names = zstandard.compress("\n".join("\t".join(map(str, e)) for e in index).encode())
    frames = [*frames, (_skippable(INDEX_FRAME, names), 0)]
    seek = b"".join(struct.pack("<II", len(f), n) for f, n in frames) + struct.pack("<IB", len(frames), 0) + SEEK_MAGIC
    return b"".join(f for f, _ in frames) + _skippable(SKIPPABLE, seek)[:-4]


def with_response(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, response): the page whose record holds an equal
    payload, null for that page itself.

    The smallest id per digest is combined before the shuffle, and the join
    back is a plain equi-join, whose hot partitions Spark splits.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("_sha", F.unhex(F.sha1("payload"))).withColumn("_n", F.octet_length("payload"))
    firsts = (rows.where(F.col("_n") >= min_revisit_bytes).groupBy("_sha", "_n")
              .agg(F.min("page_id").alias("_first")))
    other = F.col("_first") != F.coalesce(F.col("page_id"), F.col("_first") + 1)
    return (rows.join(firsts, ["_sha", "_n"], "left")
            .select("page_id", "url", "payload", F.when(other, F.col("_first")).alias("response")))


def write_archive(pages: DataFrame, path: str | None = None, date: str = "2024-01-01T00:00:00Z",
                  min_revisit_bytes: int = 0, frame_bytes: int = 256 << 10, file_bytes: int = 8 << 20,
                  level: int = 3) -> str:
    """Write a page table as archives; returns their folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        pack = zstandard.ZstdCompressor(level=level).compress
        frames, index, records, names, held, size = [], [], [], [], 0, 0

        def close_frame() -> int:
            raw, at = b"".join(records), 0
            for name, n in names:
                index.append((name, len(frames), at, n))
                at += n
            frames.append((pack(raw), len(raw)))
            records.clear()
            names.clear()
            return len(frames[-1][0])

        for b in batches:
            for page_id, url, payload, response in zip(*(b.column(i) for i in range(4))):
                page_id = page_id.as_py()
                rec = record(page_id, url.as_py(), payload.as_py(), date, response.as_py())
                records.append(rec)
                names.append((_name(page_id), len(rec)))
                held += len(rec)
                if held >= frame_bytes:
                    size, held = size + close_frame(), 0
                if size >= file_bytes:
                    yield pa.record_batch([pa.array([_bundle(frames, index)], pa.binary())], names=["file"])
                    frames.clear()
                    index.clear()
                    size = 0
        if records:
            close_frame()
        if frames:
            yield pa.record_batch([pa.array([_bundle(frames, index)], pa.binary())], names=["file"])

    path = path or shared_path(pages.sparkSession, "warc")
    write_files(with_response(pages, min_revisit_bytes).mapInArrow(run, "file binary"), "file", path, SEEK_MAGIC)
    return path


def seek_table(blob: bytes) -> list[tuple[int, int, int]]:
    """(offset, size, decompressed size) of each frame, from the footer alone."""
    if blob[-4:] != SEEK_MAGIC:
        raise ValueError("no seek table")
    count, flags = struct.unpack("<IB", blob[-9:-4])
    width = 12 if flags & 128 else 8
    body = blob[-9 - width * count:-9]
    out, at = [], 0
    for i in range(count):
        packed, size = struct.unpack_from("<II", body, i * width)
        out.append((at, packed, size))
        at += packed
    return out


def _frame(blob: bytes, at: int, packed: int, size: int) -> bytes:
    import zstandard
    return zstandard.ZstdDecompressor().decompress(blob[at:at + packed], max_output_size=size)


def _index(blob: bytes, table: list[tuple[int, int, int]]) -> list[tuple[str, int, int, int]]:
    import zstandard
    at, packed, _ = table[-1]
    text = zstandard.decompress(blob[at + 8:at + packed]).decode()
    return [(name, int(f), int(o), int(n)) for name, f, o, n in (e.split("\t") for e in text.split("\n"))]


def _parse(rec: bytes) -> tuple:
    head, _, block = rec.partition(b"\r\n\r\n")
    field = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda k: int(v) if (v := field[k].strip("<>").removeprefix(URN)) else None
    digest = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if field["WARC-Type"] == "response":
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {field['WARC-Record-ID']} does not match its digest")
        return number("WARC-Record-ID"), "response", len(payload), digest, None, payload
    size = int(http.decode().rpartition("Content-Length: ")[2])
    return number("WARC-Record-ID"), "revisit", size, digest, number("WARC-Refers-To"), None


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives: page_id, record_type, payload_bytes,
    payload_digest, refers_to, payload (null for revisits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                blob = b.column(0)[i].as_py()
                table = seek_table(blob)
                index = _index(blob, table)
                at = 0
                for f, where in enumerate(table[:-1]):
                    raw, rows = _frame(blob, *where), []
                    while at < len(index) and index[at][1] == f:
                        _, _, o, n = index[at]
                        rows.append(_parse(raw[o:o + n]))
                        at += 1
                    yield _records(rows)

    return read_files(spark, path).select("content").mapInArrow(run, SCHEMA)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(record_id, path, frame, offset, length) of every record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                blob = b.column(1)[i].as_py()
                rows = _index(blob, seek_table(blob))
                yield pa.record_batch([
                    pa.array([r[0] for r in rows]), pa.array([b.column(0)[i].as_py()] * len(rows)),
                    *[pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)]],
                    names=["record_id", "path", "frame", "offset", "length"])

    return read_files(spark, path).select("path", "content").mapInArrow(
        run, "record_id string, path string, frame long, offset long, length long")


def fetch(spark: SparkSession, path: str, page_ids: DataFrame) -> DataFrame:
    """The records of ``page_ids`` (column page_id): only the frames that hold
    them are decompressed."""
    wanted = page_ids.select(F.concat(F.lit(f"<{URN}"), F.col("page_id").cast("string"), F.lit(">")).alias("record_id"))
    places = (read_index(spark, path).join(wanted.distinct(), "record_id")
              .groupBy("path").agg(F.collect_list(F.struct("frame", "offset", "length")).alias("places")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                blob, places_ = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                table, frames, rows = seek_table(blob), {}, []
                for p in places_:
                    f = p["frame"]
                    if f not in frames:
                        frames = {f: _frame(blob, *table[f])}
                    rows.append(_parse(frames[f][p["offset"]:p["offset"] + p["length"]]))
                yield _records(rows)

    return (read_files(spark, path).join(places, "path").select("content", F.sort_array("places"))
            .mapInArrow(run, SCHEMA))
