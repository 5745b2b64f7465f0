"""URL filters by Bloom filter cascades: exact membership without joins.

A cascade over a universe of keys alternates levels: level 0 is a Bloom filter
of the listed keys; level 1 one of the other universe keys that level 0 lets
through; level 2 one of the listed keys that level 1 lets through; and so on
until nothing is let through wrongly.  The first level that does not hold a
key decides, so the answer is exact for every key of the universe, at about
the bits of a Bloom filter of the list.

The universe is complete: every host, and every (host suffix, path prefix)
key that a rule could have, of every page of the corpus.  Levels are built by
Spark (positions are or-ed per 64-bit word before the shuffle).  Keys are
dealt to shards of ``SHARD_KEYS`` listed keys by hash; a lookup holds one
shard's cascade at a time, which bounds what is broadcast: with several shards
the pages are judged shard by shard over written tables.

Edge cases: a null url or one without ``://`` has an empty host and path, fits
no rule and is on no list; a key listed as allow and block is a block; empty
lists and empty tables work; rows that share a page_id are judged each; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.llm.store import stored

SHARD_KEYS = 2_000_000
WORD = 64
HASH_SCHEMA = "key string, h1 long, h2 long"


@dataclass
class Level:
    hashes: int
    bits: np.ndarray  # uint64 words


Cascade = list[Level]


def _positions(h1: np.ndarray, h2: np.ndarray, level: int, hashes: int, size: int) -> np.ndarray:
    """Bit positions (keys x hashes) from 128 hash bits."""
    a, b = h1.view(np.uint64), h2.view(np.uint64)
    own = np.uint64((level + 1) * 0xBF58476D1CE4E5B9 % (1 << 64))
    x = a ^ (b * np.uint64(0x9E3779B97F4A7C15) + own)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    step = (b ^ (x >> np.uint64(17))) | np.uint64(1)
    return (x[:, None] + np.arange(hashes, dtype=np.uint64)[None, :] * step[:, None]) % np.uint64(size)


def _holds(level: Level, number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    at = _positions(h1, h2, number, level.hashes, len(level.bits) * WORD)
    return ((level.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=1)


def contains(cascade: Cascade, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether each universe key is listed."""
    out = np.zeros(len(h1), bool)
    alive = np.arange(len(h1))
    for i, level in enumerate(cascade):
        held = _holds(level, i, h1[alive], h2[alive])
        out[alive[~held]] = i % 2 == 1
        alive = alive[held]
    out[alive] = len(cascade) % 2 == 1
    return out


def hashed(keys: DataFrame, column: str = "key") -> DataFrame:
    """(key, h1, h2): 128 hash bits of each distinct key."""
    key = F.col(column).cast("string")
    return keys.select(key.alias("key")).where(F.col("key").isNotNull()).distinct().select(
        "key", F.xxhash64("key").alias("h1"), F.xxhash64(F.concat("key", F.lit("#"))).alias("h2"))


def _hash(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    from xxhash import xxh64_intdigest  # Spark's xxhash64 of one string: seed 42
    raw = [k.encode() for k in keys]
    return (np.array([xxh64_intdigest(k, 42) for k in raw], np.uint64).view(np.int64),
            np.array([xxh64_intdigest(k + b"#", 42) for k in raw], np.uint64).view(np.int64))


def _level(keys: DataFrame, count: int, number: int, rate: float) -> Level:
    hashes = max(1, math.ceil(-math.log2(rate)))
    words = max(1, math.ceil(count * hashes / math.log(2) / WORD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(words, np.uint64)
        for b in batches:
            at = _positions(b.column(0).to_numpy(), b.column(1).to_numpy(), number, hashes, words * WORD).ravel()
            np.bitwise_or.at(bits, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        some = np.flatnonzero(bits)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(bits[some].view(np.int64))], names=["word", "bits"])

    got = (keys.select("h1", "h2").mapInArrow(run, "word long, bits long")
           .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas())  # at most `words` rows
    bits = np.zeros(words, np.uint64)
    bits[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return Level(hashes, bits)


def _through(keys: DataFrame, level: Level, number: int) -> DataFrame:
    held = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(_holds(held.value, number, b.column(1).to_numpy(), b.column(2).to_numpy())))

    return keys.mapInArrow(run, HASH_SCHEMA)


def build(universe: DataFrame, listed: DataFrame, shard_keys: int = SHARD_KEYS) -> list[Cascade]:
    """One cascade per shard; ``universe`` and ``listed`` are ``hashed`` keys.
    Listed keys outside the universe are ignored."""
    inside = stored(universe.join(listed.select("key"), "key", "left_semi"), "listed")
    outside = stored(universe.join(listed.select("key"), "key", "left_anti"), "others")
    shards = max(1, -(-inside.count() // shard_keys))
    out = []
    for s in range(shards):
        mine = F.pmod(F.col("h1"), F.lit(shards)) == s
        yes, no = inside.where(mine), outside.where(mine)
        n_yes, n_no = yes.count(), no.count()
        levels: Cascade = []
        while n_yes:
            rate = 0.5 if levels else min(0.5, 0.7 * n_yes / max(1, n_no))
            levels.append(_level(yes, n_yes, len(levels), rate))
            passed = stored(_through(no, levels[-1], len(levels) - 1), "passed") if n_no else no
            yes, no, n_yes, n_no = passed, yes, passed.count() if n_no else 0, n_yes
        out.append(levels)
    return out


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    """Keys of all rules that could fit, longest host first: host suffixes at
    label borders with path prefixes of the rules' path lengths."""
    if not host:
        return []
    ends = [host]
    at = host.find(".")
    while at >= 0:
        ends.append(host[at + 1:])
        at = host.find(".", at + 1)
    return [h + path[:n] for h in ends if h for n in lengths if n <= len(path)]


def _candidate_keys(pages: DataFrame, lengths: list[int]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = {k for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for k in candidates(h, p, lengths)}
            yield pa.record_batch([pa.array(sorted(keys), pa.string())], names=["key"])

    return pages.select("host", "path").mapInArrow(run, "key string")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], blocked_hosts: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(page_id, host, path, rule, verdict) of rows (page_id, url).

    ``rules``: (verdict, host, path); a rule fits its host and subdomains when
    the url's path starts with the rule's, the longest wins.  Without a rule a
    page of a host in ``blocked_hosts`` (column key) is blocked.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url")).select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    lengths = sorted({len(p) for _, _, p in rules})
    universe = stored(hashed(_candidate_keys(rows, lengths)), "url-keys")
    hosts = stored(hashed(rows.where("host <> ''").select(F.col("host").alias("key"))), "hosts")
    blocks = {h + p for v, h, p in rules if v == "block"}
    allows = {h + p for v, h, p in rules if v == "allow"} - blocks

    def listed(keys: set[str]) -> DataFrame:
        return hashed(spark.createDataFrame([(k,) for k in sorted(keys)], "key string"))

    cascades = {"block": build(universe, listed(blocks), shard_keys), "allow": build(universe, listed(allows), shard_keys),
                "host": build(hosts, hashed(blocked_hosts), shard_keys)}
    out = rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit("").alias("verdict"))
    passes = [(name, s, len(shards)) for name, shards in cascades.items() for s in range(len(shards))]
    groups = [passes] if all(n == 1 for _, _, n in passes) else [[p] for p in passes]
    for number, group in enumerate(groups):
        out = _look_up(out, [(name, s, n, cascades[name][s]) for name, s, n in group], lengths)
        if number + 1 < len(groups):
            out = stored(out, "judged")
    return out.withColumn("verdict", F.when(F.col("verdict") == "", "allow").otherwise(F.col("verdict")))


def _look_up(rows: DataFrame, group: list[tuple[str, int, int, Cascade]], lengths: list[int]) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            _, host, path, rule, verdict = cols
            keys = [candidates(h, p, lengths) for h, p in zip(host, path)]
            flat = [k for ks in keys for k in ks]
            owner = [i for i, ks in enumerate(keys) for _ in ks]
            h1, h2 = _hash(flat)
            g1, g2 = _hash(host)
            for name, s, n, cascade in held.value:
                if name != "host":
                    here = np.flatnonzero(h1 % n == s)
                    for j in here[contains(cascade, h1[here], h2[here])].tolist():
                        i = owner[j]
                        if rule[i] is None or len(flat[j]) > len(rule[i]):
                            rule[i], verdict[i] = flat[j], name
                else:
                    here = np.flatnonzero((g1 % n == s) & np.array([h != "" for h in host]))
                    for i in here[contains(cascade, g1[here], g2[here])].tolist():
                        if rule[i] is None:
                            verdict[i] = "block"
            yield pa.record_batch([*b.columns[:3], pa.array(rule, pa.string()), pa.array(verdict, pa.string())], names=b.schema.names)

    return rows.mapInArrow(run, rows.schema)
