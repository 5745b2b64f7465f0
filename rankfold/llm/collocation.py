"""Phrase collocations: exact counts of word n-grams by counting quotient
filters, phrases scored by their weakest cut.

1. Texts are cut into pieces and words once and kept in blocks: about
   ``BLOCK_BYTES`` of one language, as a list of the block's words and a stream
   of places in it.  A long text is cut between pieces.  Spark sums the words
   of all blocks; words of fewer than ``min_count`` occurrences cannot be part
   of a phrase.  The others get ids, which go back to the blocks by a join on
   block and word: no task or broadcast holds the vocabulary.
2. Every block makes a quotient filter (``quotient``) of its two-word phrases,
   cut into shards by the permuted key's top bits; a shard's sorted filters
   are merged by one task, and counts of ``min_count`` and more stay.
3. The same for three and four words.  A longer phrase cannot be frequent
   unless its two-word parts are: a bitmap of fixed size tells frequent pairs
   (a pair that it passes wrongly is only counted in vain).
4. Joins of the counted phrases give the cuts, the scores and the phrases that
   longer ones cover.

Edge cases: a null text is empty, a null lang is ``und``; texts without words
count nothing; rows repeated whole count as often as they occur, whatever
their ids; equal scores rank by count, then by phrase in byte order; empty
tables give no row; other columns are ignored.  Only a single piece (text
without any separator) is never cut: it is held whole by its row anyway.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.bitmaps import bitmap, holds, mix
from rankfold.llm.lexical import runs
from rankfold.llm.quotient import Grams
from rankfold.llm.store import stored

BLOCK_BYTES = 4 << 20
HELD_BYTES = 32 << 20  # of all unfinished blocks of a task
SHARD_WORDS = 1 << 21
MAX_WORDS = 4

# A-Z lower-cased, tab as blank, every separator as a full stop.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))


class _Block:
    def __init__(self) -> None:
        self.index: defaultdict = defaultdict()
        self.index.default_factory = self.index.__len__
        self.index[b"."]  # place 0 ends a piece
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, run: bytes) -> None:
        words = run.replace(b".", b" . ").split()
        words.append(b".")
        self.parts.append(np.fromiter(map(self.index.__getitem__, words), np.uint32, len(words)))
        self.size += len(run)

    def batch(self, lang: str) -> pa.RecordBatch:
        stream = np.concatenate(self.parts)
        words = list(self.index)[1:]
        counts = np.bincount(stream, minlength=len(words) + 1)[1:]
        offsets = pa.array([0, len(words)], pa.int32())
        return pa.record_batch([
            pa.array([lang]), pa.ListArray.from_arrays(offsets, pa.array(words, pa.binary()).cast(pa.string())),
            pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
            pa.array([stream.astype("<u4").tobytes()], pa.binary())], names=["lang", "words", "counts", "stream"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, _Block] = {}
    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for run in runs(text or b"", _TABLE, end=b"."):
                block = held.setdefault(lang, _Block())
                block.add(run)
                if block.size >= BLOCK_BYTES:
                    yield held.pop(lang).batch(lang)
                elif sum(x.size for x in held.values()) >= HELD_BYTES:
                    most = max(held, key=lambda x: held[x].size)
                    yield held.pop(most).batch(most)
    for lang, block in held.items():
        if len(block.index) > 1:
            yield block.batch(lang)


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams of places to streams of ids; 0 where no phrase can go on."""
    for b in batches:
        for lang, stream, at, ids in zip(*(b.column(i) for i in range(4))):
            stream = np.frombuffer(stream.as_py(), "<u4")
            table = np.zeros(int(stream.max(initial=0)) + 1, np.uint32)
            table[np.array(at.values)] = np.array(ids.values)
            got = table[stream]
            on = got > 0
            pair = on[:-1] & on[1:]
            on = np.concatenate([pair, [False]]) | np.concatenate([[False], pair])
            got = np.where(on, got, 0)
            got = got[on | np.concatenate([[True], on[:-1]])]
            yield pa.record_batch([pa.array([lang.as_py()]), pa.array([got.astype("<u4").tobytes()], pa.binary())], names=["lang", "ids"])


def _pair_hash(lang: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix((a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)) + np.uint64(zlib.crc32(lang.encode()) << 20))


def _filters(sizes: list[int], width: int, shards: int, pairs=None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.frombuffer(data, "<u4")
                ok = (ids[:-1] > 0) & (ids[1:] > 0)
                if pairs is not None:
                    at = np.flatnonzero(ok)
                    ok[at] = holds(pairs.value, _pair_hash(lang, ids[at], ids[at + 1]))
                for n in sizes:
                    grams = Grams(n, width)
                    bits = grams.shard_bits(shards)
                    long = ok[:len(ok) - (n - 2)] if n > 2 else ok
                    for i in range(1, n - 1):
                        long = long & ok[i:len(ok) - (n - 2) + i]
                    at = np.flatnonzero(long)
                    if not len(at):
                        continue
                    x, y, counts = grams.count(*grams.permute([ids[at + i] for i in range(n)]))
                    shard = grams.shard_of(x, bits)
                    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
                    ends = np.append(first[1:], len(shard))
                    yield pa.record_batch([
                        pa.array(np.full(len(first), n, np.int32)), pa.array([lang] * len(first)), pa.array(shard[first].astype(np.int32)),
                        pa.array([grams.filter(x[i:j], y[i:j], counts[i:j], bits) for i, j in zip(first, ends)], pa.binary())],
                        names=["n", "lang", "shard", "filter"])

    return run


def _merge(width: int, shards: int, min_count: int):
    """One shard: its sorted filters merged, counts of ``min_count`` and more."""
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        n, lang, shard = int(key[0]), key[1], int(key[2])
        grams = Grams(n, width)
        bits = grams.shard_bits(shards)
        parts = [grams.entries(f, shard, bits) for f in pdf["filter"]]
        a, b, f = grams.count(*(np.concatenate([p[i] for p in parts]) for i in range(3)))
        often = f >= min_count
        ids = grams.restore(a[often], b[often])
        rows = pd.Series(list(np.stack(ids, axis=1).astype(np.int32)), dtype=object)
        return pd.DataFrame({"lang": pd.Series([lang] * len(rows), dtype=object), "ids": rows, "f": f[often],
                             "hash": _pair_hash(lang, ids[0], ids[1]).view(np.int64)})

    return run


def _count(streams: DataFrame, sizes: list[int], width: int, shards: int, min_count: int, pairs=None) -> DataFrame:
    rows = streams.mapInArrow(_filters(sizes, width, shards, pairs), "n int, lang string, shard int, filter binary")
    return rows.groupBy("n", "lang", "shard").applyInPandas(
        _merge(width, shards, min_count), "lang string, ids array<int>, f long, hash long")


def phrase_counts(docs: DataFrame, min_count: int = 30, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n) of all words, (lang, word, id, f) of frequent words and
    (lang, ids, f) of frequent phrases of 2 to 4 words."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))
    blocks = stored(rows.mapInArrow(_blocks, "lang string, words array<string>, counts array<long>, stream binary")
                    .withColumn("block", F.monotonically_increasing_id()), "blocks")
    sums = blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    words = blocks.select("block", "lang", F.posexplode("words").alias("at", "word"), "counts").select(
        "block", "lang", (F.col("at") + 1).alias("at"), "word", F.get("counts", "at").alias("c"))
    # Ids are dense within 256 buckets of a language, frequent words first.
    bucket = F.pmod(F.xxhash64("word"), F.lit(256)).cast("int")
    order = Window.partitionBy("lang", "bucket").orderBy(F.desc("f"), "word")
    frequent = stored(words.groupBy("lang", "word").agg(F.sum("c").alias("f")).where(F.col("f") >= min_count)
                      .withColumn("bucket", bucket).withColumn("id", (F.row_number().over(order) - 1) * 256 + F.col("bucket") + 1)
                      .select("lang", "word", "id", "f"), "words")
    names = (words.join(frequent.select("lang", "word", "id"), ["lang", "word"]).groupBy("block")
             .agg(F.collect_list(F.struct("at", "id")).alias("names")))  # bounded by the block's words
    streams = stored(blocks.select("block", "lang", "stream").join(names, "block")
                     .select("lang", "stream", "names.at", "names.id").mapInArrow(_encode, "lang string, ids binary"), "streams")
    top, most = frequent.agg(F.max("id")).first()[0] or 1, sums.agg(F.max("n")).first()[0] or 1
    width, shards = int(top).bit_length(), max(0, math.ceil(math.log2(most / SHARD_WORDS)))
    two = stored(_count(streams, [2], width, shards, min_count), "pairs")
    pairs = sc.broadcast(bitmap(two, "hash"))
    more = stored(_count(streams, [3, 4], width, shards, min_count, pairs), "phrases")
    pairs.destroy()
    return sums, frequent, two.union(more).select("lang", "ids", "f")


def _parts(ids: Column) -> Column:
    """All proper parts of two or more words."""
    return F.flatten(F.transform(F.sequence(F.lit(2), F.size(ids) - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size(ids) - m + 1), lambda s: F.slice(ids, s, m))))


def collocations(docs: DataFrame, top: int = 2000, min_count: int = 30, cover: int = 80, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of
    every language that no longer phrase covers by ``cover`` percent."""
    sums, frequent, phrases = phrase_counts(docs, min_count, text_col, lang_col)
    wide = lambda c: F.col(c).cast("decimal(20,0)")  # noqa: E731  products may pass 64 bits
    known = frequent.select("lang", F.array("id").alias("ids"), "f").union(phrases)
    cuts = phrases.withColumnRenamed("f", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)))
    cuts = (cuts.withColumn("left", F.slice("ids", 1, F.col("k"))).withColumn("right", F.expr("slice(ids, k + 1, size(ids) - k)"))
            .join(known.select("lang", F.col("ids").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(known.select("lang", F.col("ids").alias("right"), F.col("f").alias("r")), ["lang", "right"]))
    score = F.expr("cast(2000000 as decimal(8,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    weakest = cuts.groupBy("lang", "ids").agg(F.min(F.struct(score.alias("score"), "k", "l", "r", "a")).alias("cut"))
    longer = (phrases.where(F.size("ids") > 2).select("lang", F.explode(_parts(F.col("ids"))).alias("ids"), "f")
              .groupBy("lang", "ids").agg(F.max("f").alias("longer")))
    kept = (weakest.select("lang", "ids", "cut.*").join(longer, ["lang", "ids"], "left")
            .where(F.col("longer").isNull() | (100 * wide("longer") < cover * wide("a"))))
    # Two levels, so that a language's phrases are not ranked by one task.
    for split in (["lang", F.pmod(F.xxhash64("ids"), F.lit(64))], ["lang"]):
        first = Window.partitionBy(*split).orderBy(F.desc("score"), F.desc("a"))
        kept = kept.withColumn("place", F.rank().over(first)).where(F.col("place") <= top).drop("place", "longer", "k")
    kept = stored(kept, "kept")
    spelt = (kept.select("lang", "ids", F.posexplode("ids").alias("at", "id")).join(frequent.select("lang", "id", "word"), ["lang", "id"])
             .groupBy("lang", "ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
             .select("lang", "ids", F.array_join("words.word", " ").alias("phrase")))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.join(spelt, ["lang", "ids"]).withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sums, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
