"""Line de-duplication by a segment-partition edit join.

Two lines are linked when their edit distance is at most
``min(max_edits, shorter length // chars_per_edit)``; classes of linked (and
equal) lines keep their first occurrence (smallest doc_id, then line), every
other occurrence is removed.

A line is split into ``max_edits + 1`` segments: within the budget of edits,
one segment of one line occurs unchanged in the other, at a position that the
lengths bound.  Every line is indexed by its segments and probes with the
substrings that can equal a segment of a line of its own length or up to
``max_edits`` less (multi-match-aware positions).  Lines that share a key meet
in blocks of ``BLOCK`` lines: a key shared by many lines is split into pairs
of blocks, and each block pair emits the spanning forest of its links only.
Pairs are verified by a character-count bound, then by banded bit-parallel
edit distance on what is left between common prefix and suffix.

Edge cases: a null text stays null; lines are compared without the white space
around them; lines of fewer than ``min_chars`` characters are never removed;
rows repeated whole (same doc_id and text) count as one document; documents
that share a doc_id but not the text are separate; empty tables give no row;
the input's other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.components import components
from rankfold.llm.store import stored

MAX_EDITS, CHARS_PER_EDIT, MIN_CHARS = 2, 20, 12
BLOCK = 256
BITS = 1 << 25  # of the filter that spares reading lines without a partner


def segments(length: int, parts: int) -> list[tuple[int, int]]:
    """(start, size) of ``parts`` segments whose sizes differ by one at most."""
    small = length // parts
    long_ = length - small * parts
    out, at = [], 0
    for i in range(parts):
        size = small + (i >= parts - long_)
        out.append((at, size))
        at += size
    return out


def _slots(length: int, edits: int) -> tuple[list, list]:
    """(seed, start, end) of a line's index keys and of its probe keys."""
    parts = edits + 1
    index = [(length * 8 + i, p, p + n) for i, (p, n) in enumerate(segments(length, parts))]
    probe = []
    for less in range(edits + 1):
        other = length - less
        if other < parts:
            continue
        for i, (p, n) in enumerate(segments(other, parts)):
            lo = max(-i, less - (parts - 1 - i))
            hi = min(i, less + (parts - 1 - i))
            for shift in range(lo, hi + 1):
                a = p + shift
                if 0 <= a and a + n <= length and (less or shift):
                    probe.append((other * 8 + i, a, a + n))
    return index, probe


def edit_within(a: str, b: str, limit: int) -> bool:
    """Whether the edit distance is at most ``limit``: common ends are cut,
    then a band of 2 * limit + 1 diagonals is held in the bits of one integer."""
    if abs(len(a) - len(b)) > limit:
        return False
    n, lo, hi = min(len(a), len(b)), 0, min(len(a), len(b))
    while lo < hi:  # longest common prefix
        mid = (lo + hi + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    pre, n = lo, n - lo
    lo, hi = 0, n
    while lo < hi:  # longest common suffix of the rest
        mid = (lo + hi + 1) // 2
        if a[len(a) - mid:len(a) - lo] == b[len(b) - mid:len(b) - lo]:
            lo = mid
        else:
            hi = mid - 1
    a, b = a[pre:len(a) - lo], b[pre:len(b) - lo]
    if max(len(a), len(b)) <= limit:
        return True
    if limit == 0:
        return False
    if len(a) < len(b):
        a, b = b, a
    # Bit width - 1 of column j stands for row j + limit of the longer string:
    # the band's lower edge, whose distance ``score`` is.
    width = 2 * limit + 2
    full = (1 << width) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    pv, mv, score, edge = full & -(1 << (width - limit - 1)), 0, limit, width - 2
    worst = 2 * limit + len(b) - len(a)
    for j, c in enumerate(b):
        shift = j + limit + 1 - width
        eq = where.get(c, 0)
        eq = (eq >> shift if shift >= 0 else eq << -shift) & full
        d0 = (((eq & pv) + pv) ^ pv | eq | mv) & full
        hp, hn = mv | ~(d0 | pv) & full, d0 & pv
        if j < len(a) - limit:
            score += not d0 >> (width - 1) & 1
        else:  # along the last row
            score += (hp >> edge & 1) - (hn >> edge & 1)
            edge -= 1
        if score > worst:
            return False
        pv, mv = hn | ~(d0 >> 1 | hp) & full, d0 >> 1 & hp
    return score <= limit


def _digest(line: str) -> bytes:
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(line.encode("utf-8", "replace"))


def _id(digest: bytes) -> int:
    """A line's 63-bit number; the lowest bit is left for the key's side."""
    return int.from_bytes(digest[:8], "little", signed=True) & ~1


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        for at in range(0, b.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in b.slice(at, 256).columns))


def line_table(docs: DataFrame, min_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, line_no, line): 16-byte digests of the lines of at
    least ``min_chars`` characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = [[], [], [], []]
        for doc, h, text in _texts(batches):
            for no, line in enumerate((text or "").split("\n")):
                line = line.strip()
                if len(line) >= min_chars:
                    for c, x in zip(rows, (doc, h, no, _digest(line))):
                        c.append(x)
            if len(rows[0]) >= 20_000:
                yield out(rows)
                rows = [[], [], [], []]
        yield out(rows)

    def out(rows: list[list]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()),
                                pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.binary())],
                               names=["doc_id", "text_hash", "line_no", "line"])

    return _documents(docs, id_col, text_col).mapInArrow(run, "doc_id long, text_hash long, line_no int, line binary")


def _keys(docs: DataFrame, edits: int, shortest: int, id_col: str, text_col: str) -> DataFrame:
    """(key, id): index keys (id even) and probe keys (id odd) of each line,
    once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest
        slots: dict[int, tuple[list, list]] = {}
        seen: set[int] = set()
        keys: list[int] = []
        ids: list[int] = []
        for _, _, text in _texts(batches):
            for line in (text or "").split("\n"):
                line = line.strip()
                n = len(line)
                if n < shortest:
                    continue
                name = _id(_digest(line))
                if name in seen:
                    continue
                seen.add(name)
                if len(seen) > 300_000:
                    seen = set()
                if n not in slots:
                    slots[n] = _slots(n, edits)
                index, probe = slots[n]
                raw = line.encode("utf-8", "replace")
                if len(raw) == n:
                    keys += [xxh64_intdigest(raw[a:b], s) for s, a, b in index]
                    keys += [xxh64_intdigest(raw[a:b], s) for s, a, b in probe]
                else:
                    keys += [xxh64_intdigest(line[a:b].encode("utf-8", "replace"), s) for s, a, b in index]
                    keys += [xxh64_intdigest(line[a:b].encode("utf-8", "replace"), s) for s, a, b in probe]
                ids += [name] * len(index) + [name | 1] * len(probe)
            if len(keys) >= 100_000:
                yield out(keys, ids)
                keys, ids = [], []
        yield out(keys, ids)

    def out(keys: list[int], ids: list[int]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(ids, pa.int64())], names=["key", "id"])

    return _documents(docs, id_col, text_col).mapInArrow(run, "key long, id long")


def _shared(keys: DataFrame) -> DataFrame:
    """(key, id) of the keys that several lines share, one of them indexed."""
    w = Window.partitionBy("key")
    even = F.col("id").bitwiseAND(F.lit(1)) == 0
    line = F.col("id").bitwiseAND(F.lit(-2))
    ranged = (keys.withColumn("lo", F.min(line).over(w)).withColumn("hi", F.max(line).over(w))
              .withColumn("indexed", F.max(even).over(w)))
    return ranged.where((F.col("lo") != F.col("hi")) & F.col("indexed")).select("key", "id")


def _filter_bits(ids: DataFrame) -> np.ndarray:
    """Bit array of fixed size that marks the ids (at most BITS / 32 rows)."""
    at = f"(shiftright(id, 1) & {BITS - 1})"
    words = ids.selectExpr(f"shiftright({at}, 5) AS word", f"shiftleft(1L, int({at} & 31)) AS bit")
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(BITS // 32, np.uint32)
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def _lines_of(docs: DataFrame, ids: DataFrame, shortest: int, id_col: str, text_col: str) -> DataFrame:
    """(id, line, body) of the lines whose id is in ``ids``."""
    marks = docs.sparkSession.sparkContext.broadcast(_filter_bits(ids))  # fixed size: BITS / 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = marks.value, set()
        rows: list[list] = [[], [], []]
        for _, _, text in _texts(batches):
            for line in (text or "").split("\n"):
                line = line.strip()
                if len(line) < shortest:
                    continue
                digest = _digest(line)
                name = _id(digest)
                at = (name >> 1) & (BITS - 1)
                if not int(bits[at >> 5]) >> (at & 31) & 1 or digest in seen:
                    continue
                seen.add(digest)
                if len(seen) > 300_000:
                    seen = set()
                for c, x in zip(rows, (name, digest, line)):
                    c.append(x)
            if len(rows[0]) >= 5_000:
                yield out(rows)
                rows = [[], [], []]
        yield out(rows)

    def out(rows: list[list]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.string())],
                               names=["id", "line", "body"])

    found = _documents(docs, id_col, text_col).mapInArrow(run, "id long, line binary, body string")
    return found.join(ids, "id", "left_semi").dropDuplicates(["line"])


def _verify(edits: int, per_edit: int):
    """Stream rows sorted by (key, b0, b1): links among the lines of a group,
    as a spanning forest per group."""
    def counts(body: str) -> np.ndarray:
        raw = np.frombuffer(body.encode("utf-8", "replace"), np.uint8)
        return np.bincount(raw & 63, minlength=64)

    def links(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        one = sorted((r for r in rows if r[0] == 0), key=lambda r: r[2])
        two = sorted((r for r in rows if r[0] == 1), key=lambda r: r[2])
        left = one if one else two
        right = two if one and two else left
        same = left is right
        root: dict[bytes, bytes] = {}

        def top(x: bytes) -> bytes:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        if len(left) * len(right) > 16:
            a = np.stack([counts(r[3]) for r in left]).astype(np.int32)
            b = a if same else np.stack([counts(r[3]) for r in right]).astype(np.int32)
        else:
            a = b = None
        for i, (_, side, x, body) in enumerate(left):
            near = range(len(right)) if a is None else np.flatnonzero(np.abs(b - a[i]).sum(axis=1) <= 8 * edits).tolist()
            for j in near:
                if same and j <= i:
                    continue
                _, other_side, y, other = right[j]
                if x == y or (side and other_side) or top(x) == top(y):
                    continue
                if edit_within(body, other, min(edits, min(len(body), len(other)) // per_edit)):
                    root[max(top(x), top(y))] = min(top(x), top(y))
                    yield min(x, y), max(x, y)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, pairs = None, [], []
        for b in batches:
            for key, b0, b1, part, side, line, body in zip(*(c.to_pylist() for c in b.columns)):
                if (key, b0, b1) != group:
                    pairs += links(rows) if len(rows) > 1 else []
                    group, rows = (key, b0, b1), []
                rows.append((part, side, line, body))
            yield out(pairs)
            pairs = []
        pairs += links(rows) if len(rows) > 1 else []
        yield out(pairs)

    def out(pairs: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                               names=["a", "b"])

    return run


def line_links(docs: DataFrame, edits: int = MAX_EDITS, per_edit: int = CHARS_PER_EDIT, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(a, b): digests of linked, different lines (spanning forests)."""
    shared = stored(_shared(_keys(docs, edits, per_edit, id_col, text_col)), "segments")
    line = F.col("id").bitwiseAND(F.lit(-2))
    ids = shared.select(line.alias("id")).distinct()
    bodies = stored(_lines_of(docs, ids, per_edit, id_col, text_col), "bodies")
    w = Window.partitionBy("key").orderBy("line", "side")
    members = (shared.select("key", line.alias("id"), F.col("id").bitwiseAND(F.lit(1)).cast("int").alias("side"))
               .join(bodies.select("id", "line"), "id")
               .withColumn("n", F.count("*").over(Window.partitionBy("key")))
               .withColumn("block", F.floor((F.row_number().over(w) - 1) / F.lit(BLOCK)).cast("int")))
    last = F.floor((F.col("n") - 1) / F.lit(BLOCK)).cast("int")
    met = (members.withColumn("with", F.explode(F.sequence(F.lit(0), last)))
           .select("key", F.least("block", "with").alias("b0"), F.greatest("block", "with").alias("b1"),
                   (F.col("block") > F.col("with")).cast("int").alias("part"), "side", "line")
           .join(bodies.select("line", "body"), "line"))
    grouped = met.select("key", "b0", "b1", "part", "side", "line", "body").repartition("key", "b0", "b1")
    return grouped.sortWithinPartitions("key", "b0", "b1").mapInArrow(_verify(edits, per_edit), "a binary, b binary")


def repeated_lines(docs: DataFrame, min_count: int = 2, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                   per_edit: int = CHARS_PER_EDIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, drop): line numbers to remove from each document
    that has some.  A class of lines counts when it occurs ``min_count`` times."""
    lines = stored(line_table(docs, min_chars, id_col, text_col), "lines")
    nodes = components(line_links(docs, edits, per_edit, id_col, text_col)).withColumnRenamed("node", "line")
    place = F.struct("doc_id", "text_hash", "line_no")
    distinct = lines.groupBy("line").agg(F.count("*").alias("n"), F.min(place).alias("first"))
    classed = stored(distinct.join(nodes, "line", "left").where("n > 1 or root is not null")
                     .select("line", "n", "first", F.coalesce("root", "line").alias("root")), "line-classes")
    first = classed.groupBy("root").agg(F.sum("n").alias("n"), F.min("first").alias("first")).where(F.col("n") >= min_count)
    named = classed.select("line", "root").join(first.select("root", "first"), "root").select("line", "first")
    return (lines.join(named, "line").where(~place.eqNullSafe(F.col("first")))
            .groupBy("doc_id", "text_hash").agg(F.collect_list("line_no").alias("drop")))  # one document's lines


def drop_repeated_lines(docs: DataFrame, min_count: int = 2, edits: int = MAX_EDITS, min_chars: int = MIN_CHARS,
                        per_edit: int = CHARS_PER_EDIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated lines removed from the text, and a last column
    ``dropped_lines`` (how many; its name gets underscores until it is free)."""
    drops = stored(repeated_lines(docs, min_count, edits, min_chars, per_edit, id_col, text_col), "drops")
    name = "dropped_lines"
    while name in docs.columns:
        name += "_"
    same = (docs[id_col].cast("long").eqNullSafe(drops["doc_id"])
            & (F.xxhash64(docs[text_col].cast("string")) == drops["text_hash"]))
    joined = docs.join(drops, same, "left").select(*[docs[c] for c in docs.columns], drops["drop"].alias(name))
    at, last = docs.columns.index(text_col), len(docs.columns)
    schema = joined.schema
    schema[name].dataType = docs.sparkSession.range(0).selectExpr("int(id) as x").schema["x"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, counts = [], []
            for text, drop in zip(b.column(at).to_pylist(), b.column(last).to_pylist()):
                if drop:
                    gone = set(drop)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
                texts.append(text)
                counts.append(len(drop or ()))
            cols = list(b.columns)
            cols[at], cols[last] = pa.array(texts, pa.string()), pa.array(counts, pa.int32())
            yield pa.record_batch(cols, names=b.schema.names)

    return joined.mapInArrow(run, schema)
