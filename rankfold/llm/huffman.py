"""Token ids in binary files: canonical length-limited Huffman codes.

Code lengths come from the global id counts (package-merge, at most
``max_bits``); codes are canonical, so a file carries the lengths only.  A
document's codes start at a byte boundary and are cut into blocks of
``block_ids`` ids; the file lists every block's bit offset, so blocks decode
independently through one lookup table (all blocks of a file in lockstep).

File layout (integers little-endian unless said): ``HUFC``, then big-endian
u32 part, u32 sequence, u64 ids, then u32 documents, u32 blocks, u32 block
length, u32 size of the deflated code lengths, those lengths, document ids
(i64), null marks (u8), ids per document (u32), block bit offsets (u64), the
code bits, and ``HEND``.  Files ordered by (part, sequence) hold the documents
in ascending id order.

Edge cases: null text is the end id alone; a null doc_id sorts first; rows
that share a doc_id are ordered by their ids' bytes; an empty table gives no
file and no row; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm.store import read_files, shared_path, stored, write_files

MAGIC, TRAILER = b"HUFC", b"HEND"
PLACE, SIZES = ">IIQ", "<IIII"  # (part, sequence, ids), (documents, blocks, block length, size of the lengths)


def code_lengths(counts: dict[int, int], max_bits: int = 16) -> dict[int, int]:
    """Optimal code length per id under a limit (package-merge)."""
    ids = np.array(sorted(counts, key=lambda i: (counts[i], i)), np.int64)
    if len(ids) <= 1:
        return {int(i): 1 for i in ids}
    limit = max(max_bits, int(np.ceil(np.log2(len(ids)))))
    leaves = np.array([counts[int(i)] for i in ids], np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        weights = np.concatenate([leaves, packages])
        order = np.argsort(weights, kind="stable")
        levels.append(order < len(leaves))  # which of the sorted items are leaves
        both = weights[order]
        both = both[: len(both) // 2 * 2]
        packages = both[0::2] + both[1::2]
    lengths = np.zeros(len(ids), np.int64)
    take = 2 * len(ids) - 2
    for is_leaf in reversed(levels):
        leaf_count = int(is_leaf[:take].sum())
        lengths[:leaf_count] += 1
        take = 2 * (take - leaf_count)
    return {int(i): int(n) for i, n in zip(ids, lengths)}


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes of the ids whose length is above 0, in (length, id) order."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        n = int(lengths[i])
        if n:
            code <<= n - last
            codes[i], last = code, n
            code += 1
    return codes


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(id, code length) of every ``max_bits``-bit window."""
    order = [int(i) for i in np.lexsort((np.arange(len(lengths)), lengths)) if lengths[i]]
    bits = int(lengths.max()) if order else 1
    reps = [1 << (bits - int(lengths[i])) for i in order]
    ids = np.repeat(np.array(order, np.uint32), reps)
    pad = (1 << bits) - len(ids)
    return (np.concatenate([ids, np.zeros(pad, np.uint32)]),
            np.concatenate([lengths[ids.astype(np.int64)].astype(np.int64), np.ones(pad, np.int64)]), bits)


def pack_documents(docs: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray,
                   block_ids: int) -> list[tuple[bytes, np.ndarray]]:
    """(bits, block bit offsets) of each document (all non-empty), together."""
    ids = np.concatenate(docs)
    sizes = np.array([len(d) for d in docs], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    n = lengths[ids]
    end = np.cumsum(n)
    begin = end - n
    doc_bits = np.add.reduceat(n, first)
    doc_bytes = (doc_bits + 7) // 8
    doc_at = np.concatenate([[0], np.cumsum(doc_bytes)])
    local = begin - np.repeat(begin[first], sizes)
    pos = local + np.repeat(doc_at[:-1] * 8, sizes)
    width = (int(lengths.max()) + 14) // 8  # bytes that a code can touch
    value = codes[ids] << (8 * width - n - (pos & 7)).astype(np.uint64)
    at, out = pos >> 3, np.zeros(int(doc_at[-1]) + width, np.uint8)
    for k in range(width):  # bits are disjoint: a sum is an or
        part = ((value >> np.uint64(8 * (width - 1 - k))) & np.uint64(255)).astype(np.float64)
        out[: int(at[-1]) + 1 + k] |= np.concatenate(
            [np.zeros(k), np.bincount(at, weights=part, minlength=int(at[-1]) + 1)]).astype(np.uint8)
    raw = out.tobytes()
    return [(raw[doc_at[i]:doc_at[i + 1]], local[first[i]:first[i] + sizes[i]:block_ids])
            for i in range(len(docs))]


def unpack_blocks(payload: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                  table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    """Ids of all blocks, one block after another."""
    symbol, used, bits = table
    width = (bits + 14) // 8
    data = np.concatenate([payload, np.zeros(width, np.uint8)])
    order = np.argsort(-sizes, kind="stable")
    pos, left = starts[order].astype(np.int64), sizes[order]
    out = np.zeros((len(order), int(sizes.max()) if len(sizes) else 0), np.uint32)
    alive = np.searchsorted(-left, -np.arange(1, out.shape[1] + 1), side="right")
    mask = np.int64((1 << bits) - 1)
    for step, live in enumerate(alive):
        p = pos[:live]
        at = p >> 3
        window = data[at].astype(np.int64)
        for k in range(1, width):
            window = (window << 8) | data[at + k]
        key = (window >> (8 * width - bits - (p & 7))) & mask
        out[:live, step] = symbol[key]
        pos[:live] = p + used[key]
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    out = out[back]
    return out[np.arange(out.shape[1])[None, :] < sizes[:, None]]


def id_type(vocab: int) -> str:
    return "<u2" if vocab <= 65536 else "<u4"


def id_counts(staged: DataFrame, vocab: int) -> dict[int, int]:
    """Global id counts: one partial row per id and partition, summed by Spark;
    the driver gets at most one row per vocabulary entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocab, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                ids = np.frombuffer(b"".join(b.column(0).slice(at, 256).to_pylist()), id_type(vocab))
                total += np.bincount(ids, minlength=vocab)
        hit = np.flatnonzero(total)
        yield pa.record_batch([pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["id", "n"])

    rows = staged.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in rows.collect()}


def write_ids(tokens: DataFrame, path: str, vocab: int, block_ids: int = 1024, max_bits: int = 16,
              file_bytes: int = 8 << 20) -> None:
    """Encode ``tokens`` (doc_id, ids as ``id_type(vocab)``) into files at ``path``."""
    spark = tokens.sparkSession
    narrow = id_type(vocab)
    staged = stored(tokens.select("doc_id", "ids"), "token-ids")
    counts = id_counts(staged, vocab)
    by_id = code_lengths(counts, max_bits)
    lengths = np.zeros(vocab, np.int64)
    lengths[list(by_id)] = list(by_id.values())
    codes = canonical_codes(lengths)
    packed_lengths = zlib.compress(lengths.astype(np.uint8).tobytes())
    total_bytes = sum(n * by_id[i] for i, n in counts.items()) // 8
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-total_bytes // (4 * file_bytes)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(1).to_pylist()
            at = 0
            while at < len(raw):  # a group of about half a million ids
                to, size = at, 0
                while to < len(raw) and size < 500_000:
                    size += len(raw[to]) // np.dtype(narrow).itemsize
                    to += 1
                docs = [np.frombuffer(x, narrow).astype(np.int64) for x in raw[at:to]]
                full = [d for d in docs if len(d)]
                done = iter(pack_documents(full, lengths, codes, block_ids) if full else [])
                bits, marks = [], []
                for d in docs:
                    x, y = next(done) if len(d) else (b"", np.empty(0, np.int64))
                    bits.append(x)
                    marks.append(y.astype("<u8").tobytes())
                yield pa.record_batch([b.column(0).slice(at, to - at), pa.array([len(d) for d in docs], pa.int64()),
                                       pa.array(marks, pa.binary()), pa.array(bits, pa.binary())],
                                      names=["doc_id", "n", "marks", "bits"])
                at = to

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, rows, size = None, 0, [], 0

        def flush() -> pa.RecordBatch:
            ids = [r[0] for r in rows]
            base = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])[:-1]]).astype(np.uint64) * 8
            marks = b"".join((np.frombuffer(r[2], "<u8") + at).astype("<u8").tobytes() for r, at in zip(rows, base))
            blob = b"".join([
                MAGIC, struct.pack(PLACE, part, seq, sum(r[1] for r in rows)),
                struct.pack(SIZES, len(rows), len(marks) // 8, block_ids, len(packed_lengths)), packed_lengths,
                np.array([i or 0 for i in ids], "<i8").tobytes(), bytes(i is None for i in ids),
                np.array([r[1] for r in rows], "<u4").tobytes(), marks, *[r[3] for r in rows]])
            return pa.record_batch([pa.array([blob], pa.binary())], names=["file"])

        for b in batches:
            for p, *row in zip(*(c.to_pylist() for c in b.columns)):
                if rows and (p != part or size >= file_bytes):
                    yield flush()
                    seq, rows, size = (seq + 1 if p == part else 0), [], 0
                part = p
                rows.append(row)
                size += len(row[3]) + len(row[2]) + 13
        if rows:
            yield flush()

    step = 1.0 / parts
    cuts = staged.approxQuantile("doc_id", [step * i for i in range(1, parts)], step / 8) if counts and parts > 1 else []
    cuts = sorted({int(c) for c in cuts})
    part = F.lit(0)
    if cuts:  # how many cuts are at or below the id: a binary search over a literal array
        part = F.coalesce(_rank(F.col("doc_id"), cuts), F.lit(0))
    encoded = (staged.mapInArrow(encode, "doc_id long, n long, marks binary, bits binary")
               .select(part.cast("int").alias("part"), "doc_id", "n", "marks", "bits"))
    ordered = encoded.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "n", "bits")
    write_files(ordered.mapInArrow(files, "file binary"), "file", path, TRAILER)


def _rank(col, cuts: list[int]):
    """Number of sorted ``cuts`` at or below ``col``, as nested comparisons of
    logarithmic depth."""
    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col >= F.lit(cuts[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))
    return tree(0, len(cuts))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document: ``start`` counts the
    ids of all documents before it, ``ids`` are little-endian u32."""
    found = read_files(spark, path)

    def number(at: int, size: int):
        return F.conv(F.hex(F.substring("content", at + 1, size)), 16, 10).cast("long")

    heads = found.select(number(4, 4).alias("part"), number(8, 4).alias("seq"), number(12, 8).alias("total"))
    base, before = [], 0
    for r in sorted(heads.collect()):  # one row per file
        base.append((r["part"], r["seq"], before))
        before += r["total"]
    offsets = spark.createDataFrame(base, "part long, seq long, before long")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                yield from _decode_file(b.column(0)[i].as_py())

    rows = found.select("content").mapInArrow(
        decode, "part long, seq long, doc_id long, at long, n_tokens long, ids binary")
    return (rows.join(F.broadcast(offsets), ["part", "seq"])  # one row per file
            .select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids"))


def _decode_file(blob: bytes) -> Iterator[pa.RecordBatch]:
    if blob[:4] != MAGIC or blob[-4:] != TRAILER:
        raise ValueError("not a Huffman id file, or cut short")
    part, seq, _ = struct.unpack_from(PLACE, blob, 4)
    n_docs, n_blocks, block_ids, n_len = struct.unpack_from(SIZES, blob, 20)
    at = 36
    lengths = np.frombuffer(zlib.decompress(blob[at:at + n_len]), np.uint8).astype(np.int64)
    at += n_len
    doc_ids = np.frombuffer(blob, "<i8", n_docs, at)
    nulls = np.frombuffer(blob, np.uint8, n_docs, at + 8 * n_docs).astype(bool)
    sizes = np.frombuffer(blob, "<u4", n_docs, at + 9 * n_docs).astype(np.int64)
    marks = np.frombuffer(blob, "<u8", n_blocks, at + 13 * n_docs).astype(np.int64)
    payload = np.frombuffer(blob, np.uint8, offset=at + 13 * n_docs + 8 * n_blocks)
    blocks = -(-sizes // block_ids)  # per document
    last = np.cumsum(blocks) - 1
    block_sizes = np.full(n_blocks, block_ids, np.int64)
    some = sizes > 0
    block_sizes[last[some]] = sizes[some] - (blocks[some] - 1) * block_ids
    table = decode_table(lengths)
    ends = np.cumsum(sizes)
    block_end = np.cumsum(blocks)
    lo = 0
    while lo < n_docs:  # a few million ids at a time
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + 4_000_000, side="right")))
        b0, b1 = (block_end[lo - 1] if lo else 0), block_end[hi - 1]
        ids = unpack_blocks(payload, marks[b0:b1], block_sizes[b0:b1], table).astype("<u4").tobytes()
        begin = (ends - sizes)[lo:hi]
        cut = (begin - begin[0]) * 4
        yield pa.record_batch([
            pa.array(np.full(hi - lo, part), pa.int64()), pa.array(np.full(hi - lo, seq), pa.int64()),
            pa.array(doc_ids[lo:hi], pa.int64(), mask=nulls[lo:hi]), pa.array(begin, pa.int64()),
            pa.array(sizes[lo:hi], pa.int64()),
            pa.array([ids[c:c + 4 * n] for c, n in zip(cut.tolist(), sizes[lo:hi].tolist())], pa.binary())],
            names=["part", "seq", "doc_id", "at", "n_tokens", "ids"])
        lo = hi


def encode_corpus(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> str:
    """Tokenize and write a document table; returns the files' folder."""
    from rankfold.llm.tokens import token_ids, vocabulary_size
    path = path or shared_path(docs.sparkSession, "huffman")
    vocab = max(vocabulary_size(tokenizer), end_id + 1)
    write_ids(token_ids(docs, tokenizer, end_id, dtype=id_type(vocab)), path, vocab)
    return path
