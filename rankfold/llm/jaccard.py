"""Exact Jaccard near-duplicates by a parity-sketch join.

A text's shingles are hashed to 64 bits, and its parity sketch has one bit per
hash: every shingle flips its bit, so the bits in which two sketches differ
number at most the shingles that only one text has.  For a link that is at
most (|A| + |B|) / 9 shingles at a similarity of 0.8.  The sketch is used at
two widths: in full, held as the sorted hashes, and folded by parity to a few
bits a shingle for a bound that is quick to test.

1. Size bands double; a band cuts the sketch into chunks, one or two shingles
   each.  A shingle changes one chunk, so linked texts agree in all but so many
   chunks, and (pigeonhole, in one order of all chunk values) they share one of
   their first ``budget + 1`` chunks.  Only these are shuffled, as the xor of the
   chunk's hashes; a text also probes the band below if it can reach it.
2. Chunk values that many texts share (common passages) go to the end of the
   order for the texts that met there, so these meet in other chunks: a value
   is noted in a bitmap of fixed size, which demotes a few others as well and
   stays right.  What then still meets in large groups are near copies.
3. Every member of a group meets the group's smallest member first; candidates
   pass the folded bound and are verified on their whole sets.  Members that
   these links connect within two steps need no other comparison; the rest of a
   group is compared in blocks by the folded bound, and verified.
4. Classes of equal sets are one node; components run over the links.

Edge cases: a null text has no words; texts without words have no shingle and
are linked with nothing; fewer words than a shingle are one shingle; a
component's id is its smallest doc_id (null if all its ids are null); rows that
share a doc_id are separate rows; empty tables give no row; other columns are
ignored.  Sets are compared by 64-bit hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.bitmaps import bitmap, holds, mix
from rankfold.llm.components import components
from rankfold.llm.store import stored

SHINGLE_WORDS, PERCENT, SEED = 5, 80, 42
GROUP_LIMIT = 256  # texts that share a chunk value before it is demoted
ROUNDS = 2  # orders after the first
BLOCK = 512  # members compared by one task at once
LOWEST_BAND_CHUNKS = 1 << 16
KNOWN_SETS = 1_000_000

RUN_BYTES = 16 << 20  # of text at once

_ALL = (1 << 64) - 1
_FACTOR = np.uint64(0x9E3779B97F4A7C17)
# Stands for "a set has too few chunks"; two classes, so that it is seen.
TOO_FEW = -(1 << 63)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, offsets of the texts in them); only A-Z are
    lower-cased, and words end at ASCII white space."""
    from xxhash import xxh64_digest
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    ends = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(int(ends[0]), int(ends[-1] - ends[0])).dictionary_encode()
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    table = np.frombuffer(b"".join([xxh64_digest(w, SEED) for w in words]), ">u8").astype(np.uint64)
    at = coded.indices.to_numpy()
    ends = ends - ends[0]
    if b"" in words:  # white space at a text's start or end
        real = at != words.index(b"")
        ends = np.concatenate([[0], np.cumsum(real)])[ends]
        at = at[real]
    return table[at], ends


def _chain(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    x = np.full(len(h) - size + 1, size, np.uint64)
    for i in range(size):
        x = x * _FACTOR + h[i:len(h) - size + 1 + i]
    return mix(x)


def shingle_sets(texts: pa.Array, words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word shingles of every text."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy()
    at = 0
    while at < len(texts):
        total = np.cumsum(sizes[at:at + 1024])
        end = at + max(1, int(np.searchsorted(total, RUN_BYTES, "right")))  # a longer text alone
        h, ends = word_hashes(texts.slice(at, end - at))
        at = end
        x = _chain(h, words) if len(h) >= words else h
        for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if hi - lo < words:
                yield _chain(h[lo:hi], hi - lo) if hi > lo else h[:0]
                continue
            t = np.sort(x[lo:hi - words + 1])
            yield t[np.concatenate([[True], t[1:] != t[:-1]])]


def name_of(tokens: np.ndarray) -> tuple[int, int]:
    """Two 64-bit names of a set; the second only checks the first."""
    a, b, n = int(np.bitwise_xor.reduce(tokens)), int(np.add.reduce(tokens)), len(tokens)
    named = mix(np.array([(a + 3 * b + n) & _ALL, (a ^ (b >> 1) ^ (b << 63)) & _ALL], np.uint64)).view(np.int64)
    return int(named[0]), int(named[1])


def folded(tokens: np.ndarray) -> bytes:
    """Parity of the hashes in 4 to 8 bits a shingle (a power of two, 64 at least)."""
    bits = max(64, 1 << (4 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def refold(sketch: bytes, size: int) -> bytes:
    """A sketch folded to ``size`` bytes."""
    s = np.frombuffer(sketch, np.uint8)
    return s.tobytes() if len(s) == size else np.bitwise_xor.reduce(s.reshape(-1, size), axis=0).tobytes()


def budget(n: int, m: int, percent: int = PERCENT) -> int:
    """Most shingles in which linked sets of n and m shingles can differ."""
    return (n + m) * (100 - percent) // (100 + percent)


def _band(n: int) -> int:
    return n.bit_length() - 1


def chunk_values(tokens: np.ndarray, band: int, seed: int) -> np.ndarray:
    """Values of the non-empty chunks of a sketch, cut as in ``band``."""
    bits = max(band, LOWEST_BAND_CHUNKS.bit_length() - 1) if band < 6 else band
    x = np.sort(mix(tokens + np.uint64(seed))) if seed else tokens
    chunk = x >> np.uint64(64 - bits)
    first = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]]))
    value = np.bitwise_xor.reduceat(x, first)
    return mix(value + mix(chunk[first] + np.uint64(band << 56)))


def schemes(n: int, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(band, budget) of the bands in which a set of n shingles can meet others."""
    most = n * 100 // percent  # largest partner
    band = _band(n)
    out = [(band, budget(n, max(most, n), percent))]
    low = 1 << band
    if band and -(-n * percent // 100) < low:
        out.append((band - 1, budget(n, low - 1, percent)))
    return out


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in shingle_sets(b.column(2), words):
                if not len(t):
                    out.append((0, None, None, None))
                    continue
                out.append((len(t), *name_of(t), folded(t)))
            n, name, check, sketch = zip(*out) if out else ([],) * 4
            yield pa.record_batch([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(name, pa.int64()),
                                   pa.array(check, pa.int64()), pa.array(sketch, pa.binary())],
                                  names=["doc_id", "row", "n", "class", "checksum", "sketch"])

    return run


def _keys(words: int, percent: int, seed: int, rows=None, demoted=None):
    """(key, class) of each text's first chunks; of the ``rows`` marked, if given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            wanted = np.arange(b.num_rows) if rows is None else np.flatnonzero(
                holds(rows.value, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            keys, classes = [], []
            for t in shingle_sets(b.column(2).take(pa.array(wanted)), words):
                if not len(t):
                    continue
                name = name_of(t)[0]
                if name in seen:
                    continue
                if len(seen) >= KNOWN_SETS:
                    seen.clear()
                seen.add(name)
                for band, most in schemes(len(t), percent):
                    value = chunk_values(t, band, seed)
                    if len(value) <= most:
                        keys.append(np.array([TOO_FEW, TOO_FEW], np.int64).view(np.uint64))
                        classes.append(np.array([0, 1]))
                    if demoted is not None:
                        hot = holds(demoted.value, value)
                        value = value[np.lexsort((value, hot))[:most + 1]]
                    elif len(value) > most + 1:
                        value = np.partition(value, most)[:most + 1]
                    keys.append(value)
                    classes.append(np.full(len(value), name, np.int64))
            if keys:
                yield pa.record_batch([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(classes))],
                                      names=["key", "class"])

    return run


def _shared(limit: int):
    """Rows sorted by key and class -> (key, class, pivot, large) of the keys of
    two or more classes; nothing larger than ``limit`` rows is held."""
    def give(key, cls, pivot, large):
        return pa.record_batch([pa.array(key), pa.array(cls), pa.array(pivot), pa.array(large)],
                               names=["key", "class", "pivot", "large"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cls = np.empty(0, np.int64), np.empty(0, np.int64)
        open_key = open_pivot = open_last = None  # a run whose rows go out as they come
        stop = object()
        source = iter(batches)
        while True:
            b = next(source, stop)
            if b is not stop:
                key = np.concatenate([key, b.column(0).to_numpy()])
                cls = np.concatenate([cls, b.column(1).to_numpy()])
            if len(key):
                new = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])])
                key, cls = key[new], cls[new]
            if open_key is not None and len(key):
                more = int(np.searchsorted(key != open_key, True)) if key[0] == open_key else 0
                got = cls[:more][cls[:more] != open_last] if more else cls[:0]
                if len(got):
                    open_last = got[-1]
                    yield give(np.full(len(got), open_key), got, np.full(len(got), open_pivot), np.full(len(got), True))
                key, cls = key[more:], cls[more:]
                if len(key):
                    open_key = None
            if len(key):
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                end = len(key) if b is stop else first[-1]
                first = first[first < end]
                size = np.diff(np.append(first, end))
                rep = np.repeat(np.arange(len(first)), size)
                keep = size[rep] > 1
                if keep.any():
                    yield give(key[:end][keep], cls[:end][keep], cls[first][rep][keep], (size > limit)[rep][keep])
                key, cls = key[end:], cls[end:]
                if len(key) > limit:
                    open_key, open_pivot, open_last = key[0], cls[0], cls[-1]
                    yield give(key, cls, np.full(len(cls), cls[0]), np.full(len(cls), True))
                    key, cls = key[:0], cls[:0]
            if b is stop:
                return

    return run


def _differ(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    x = np.frombuffer(refold(a, size), np.uint64) ^ np.frombuffer(refold(b, size), np.uint64)
    return int(np.bitwise_count(x).sum())


def _plausible(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, an, bn, asketch, bsketch = (c.to_pylist() for c in batch.columns)
            ok = [100 * min(x, y) >= percent * max(x, y) and _differ(s, t) <= budget(x, y, percent)
                  for x, y, s, t in zip(an, bn, asketch, bsketch)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _sets(words: int, rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted = np.flatnonzero(holds(rows.value, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            for at in range(0, len(wanted), 256):
                part = pa.array(wanted[at:at + 256])
                tokens = [t.tobytes() for t in shingle_sets(b.column(2).take(part), words)]
                yield pa.record_batch([b.column(1).take(part), pa.array(tokens, pa.binary())], names=["row", "tokens"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(y, x)
                both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _compare(percent: int):
    """Rows sorted by group (key, i, j) -> pairs of a group's members, in
    different components, that the folded bound lets through; none with the
    pivot, which has met them all.  A group has two blocks at most."""
    def pairs(n, cls, comp, pivot, block, cross, sketches):
        order = np.argsort(n, kind="stable")
        n, cls, comp, pivot, block = n[order], cls[order], comp[order], pivot[order], block[order]
        reach = np.searchsorted(n, n * 100 // percent, "right")  # largest partner of each member
        count = np.maximum(reach - np.arange(len(n)) - 1, 0)
        x = np.repeat(np.arange(len(n)), count)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
        ok = (comp[x] != comp[y]) & (cls[x] != pivot[x]) & (cls[y] != pivot[y])
        if cross:
            ok &= block[x] != block[y]
        x, y = x[ok], y[ok]
        if not len(x):
            return x, y
        size = min(map(len, sketches))
        bits = np.frombuffer(b"".join(refold(sketches[k], size) for k in order.tolist()), np.uint64).reshape(len(n), -1)
        near = []
        for at in range(0, len(x), 16_384):
            to = slice(at, at + 16_384)
            ham = np.bitwise_count(bits[x[to]] ^ bits[y[to]]).sum(axis=1, dtype=np.int64)
            near.append(ham <= (n[x[to]] + n[y[to]]) * (100 - percent) // (100 + percent))
        near = np.concatenate(near)
        a, b = cls[x[near]], cls[y[near]]
        return np.minimum(a, b), np.maximum(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, stop = None, object()
        source = iter(batches)
        while True:
            b = next(source, stop)
            if b is not stop:
                held = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            if held is None:
                return
            key, i, j, block, cls, pivot, comp, n = (held.column(c).to_numpy() for c in range(8))
            first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
            if b is not stop and len(first) < 2:
                continue
            ends = np.append(first[1:], len(key))
            whole = len(first) if b is stop else len(first) - 1
            sketches = held.column(8).to_pylist()
            out = [(np.empty(0, np.int64),) * 2]
            for lo, hi in zip(first[:whole].tolist(), ends[:whole].tolist()):
                to = slice(lo, hi)
                out.append(pairs(n[to], cls[to], comp[to], pivot[to], block[to], i[lo] != j[lo], sketches[to]))
            found = np.unique(np.stack([np.concatenate([o[c] for o in out]) for c in (0, 1)], axis=1), axis=0)
            yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])
            if b is stop:
                return
            held = held.slice(int(first[-1]))

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; texts link when
    100 * common shingles >= ``percent`` * all their shingles."""
    sc = docs.sparkSession.sparkContext
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), text).alias("row"),
                        text.alias("text"))
    rows = stored(texts.mapInArrow(_describe(words), "doc_id long, row long, n long, class long, checksum long, sketch binary"), "sets")
    classes = stored(rows.where("n > 0").groupBy("class").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.min("checksum").alias("low"), F.max("checksum").alias("high")), "classes")
    if classes.where("low <> high").head(1):
        raise ValueError("two sets share a 64-bit name")

    def groups(seed, marked, demoted) -> DataFrame:
        keys = texts.mapInArrow(_keys(words, percent, seed, marked, demoted), "key long, class long")
        return stored(keys.repartition("key").sortWithinPartitions("key", "class").mapInArrow(
            _shared(GROUP_LIMIT), "key long, class long, pivot long, large boolean"), "groups")

    seed, first = 0, groups(0, None, None)
    while first.where(F.col("key") == TOO_FEW).head(1):  # too few chunks of some set to tell: cut all sets anew
        seed += 1
        first = groups(seed, None, None)
    held, hot = [first], None
    for _ in range(ROUNDS):
        large = held[-1].where("large")
        if not large.head(1):
            break
        hot = large.select("key").distinct() if hot is None else hot.union(large.select("key").distinct())
        marked = sc.broadcast(bitmap(classes.join(large.select("class").distinct(), "class", "left_semi"), "row"))
        demoted = sc.broadcast(bitmap(hot, "key"))
        held[-1] = held[-1].where("not large")
        held.append(groups(seed, marked, demoted))
        for shared in (marked, demoted):
            shared.destroy()
    met = held[0]
    for more in held[1:]:
        met = met.union(more)

    facts = classes.select("class", "n", "sketch")

    def side(table: DataFrame, s: str) -> DataFrame:
        return table.select(F.col("class").alias(s), *[F.col(c).alias(s + c) for c in table.columns if c != "class"])

    def linked(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that the folded bound lets through and whose whole sets
        link; only the sets of their texts are made."""
        likely = stored(pairs.join(side(facts, "a"), "a").join(side(facts, "b"), "b").select("a", "b", "an", "bn", "asketch", "bsketch")
                        .mapInArrow(_plausible(percent), "a long, b long"), f"likely-{name}")
        wanted = classes.join(likely.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "class", "left_semi")
        marked = sc.broadcast(bitmap(wanted, "row"))
        sets = texts.mapInArrow(_sets(words, marked), "row long, tokens binary")
        sets = stored(sets.join(wanted.select("row", "class"), "row").dropDuplicates(["class"]).select("class", "tokens"), f"tokens-{name}")
        marked.destroy()
        return stored(likely.join(side(sets, "a"), "a").join(side(sets, "b"), "b").select("a", "b", "atokens", "btokens")
                      .mapInArrow(_verify(percent), "a long, b long"), f"links-{name}")

    links = linked(met.where("class <> pivot").select(F.col("pivot").alias("a"), F.col("class").alias("b")).distinct(), "first")
    # Groups that are not known to be connected; groups of the same members once.
    # A text's label is its smallest neighbour's smallest neighbour: two cheap
    # steps connect most of a family, and what they miss is only compared in vain.
    both = links.union(links.select("b", "a"))
    low = both.groupBy(F.col("a").alias("class")).agg(F.least(F.min("a"), F.min("b")).alias("one"))
    twice = low.join(low.select(F.col("class").alias("one"), F.col("one").alias("two")), "one").select(
        "class", F.least("one", "two").alias("root"))
    label = met.join(twice, "class", "left").select("key", "class", "pivot", F.coalesce("root", "class").alias("comp"))
    label = stored(label, "labels")
    hashed = F.xxhash64("class").cast("decimal(20,0)")
    open_groups = (label.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                            F.sum(hashed).alias("members"))
                   .where("size > 2 and lo <> hi").groupBy("size", "members").agg(F.min("key").alias("key")))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = (label.join(open_groups.select("key", blocks.alias("blocks")), "key").join(facts, "class")
               .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class", "pivot",
                       "comp", "n", "sketch"))
    pairs = (members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
             .mapInArrow(_compare(percent), "a long, b long").distinct())
    nodes = components(links.union(linked(pairs, "rest"))).select(F.col("node").alias("class"), "root")
    rooted = classes.select("class", "doc_id").join(nodes, "class", "left").withColumn("root", F.coalesce("root", "class"))
    first = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(first, "root").select("class", "component_id")
    return rows.join(named, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
