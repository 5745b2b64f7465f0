"""SimHash near-duplicates: fingerprints of whole texts, a binary-trie
self-join of the distinct fingerprints, components.

The trie join walks pairs of trie nodes together: a pair starts at
(root, root) with no differing bits, its children are the pairs of the two
nodes' children, a differing bit costs one, and pairs that cost more than the
budget are dropped.  Spark walks the upper levels: a fingerprint goes to the
groups of every node pair that it can belong to within the budget.  Groups of
at most ``group_rows`` fingerprints are finished by one task each (numpy, in
the same way, on ranges of sorted fingerprints); larger ones are walked four
levels deeper, again and again, so a dense region is split and never held
whole.

Edge cases: a null text has no words; texts without words have fingerprint 0
and link like others; texts of fewer words than a shingle are one shingle;
equal fingerprints are one trie leaf, so copies cost nothing; a component's id
is its smallest doc_id (null if all its ids are null); empty tables give no
row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.llm.components import components, forest
from rankfold.llm.store import stored

SHINGLE_WORDS, MAX_BITS, SEED = 3, 2, 42
GROUP_ROWS = 65_536
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of the text's word shingles, repeats included."""
    from xxhash import xxh64_intdigest
    parts = text.translate(LOWER).split()  # bytes: 0x20 and 0x09 to 0x0D only
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxh64_intdigest(joined, SEED)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    end = np.cumsum(size) + np.arange(len(parts))
    begin = (end - size).tolist()
    end = end[words - 1:].tolist()
    ones, total = np.zeros(64, np.int64), len(end)
    for at in range(0, total, 65_536):
        h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begin[at:at + 65_536], end[at:at + 65_536])], np.uint64)
        for k in range(8):  # bit counts of each byte from its histogram
            ones[8 * k:8 * k + 8] += np.bincount((h >> np.uint64(8 * k)).astype(np.uint8), minlength=256) @ _BITS
    bits = np.flatnonzero(2 * ones > total)
    return sum(1 << int(b) for b in bits)


_BITS = (np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp): fp as a signed 64-bit integer; text_hash tells
    rows that share a doc_id apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint((t or "").encode(), words) for t in b.column(2).to_pylist()], np.uint64)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(fp.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def trie_join(a: np.ndarray, b: np.ndarray, budget: int, bit: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of sorted fingerprints ``a`` x ``b`` that differ in at most
    ``budget`` of the bits below ``bit`` (their upper bits are common within
    each side).  ``same``: a is b, and each pair is given once."""
    start = np.array([[0, len(a), 0, len(b), 0]], np.int64)
    stack = [(bit, start)] if len(a) and len(b) else []
    while stack:
        bit, pairs = stack.pop()
        a0, a1, b0, b1, diff = pairs.T
        small = ((a1 - a0) * (b1 - b0) <= 32) | (bit == 0)
        if small.any():
            p0, p1, q0, q1, d = pairs[small].T
            n = (p1 - p0) * (q1 - q0)
            owner = np.repeat(np.arange(len(n)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            x, y = p0[owner] + k // (q1 - q0)[owner], q0[owner] + k % (q1 - q0)[owner]
            low = np.uint64((1 << bit) - 1) if bit < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
            ok = d[owner] + np.bitwise_count((a[x] ^ b[y]) & low) <= budget
            if same:
                ok &= x < y
            if ok.any():
                yield a[x[ok]], b[y[ok]]
        pairs = pairs[~small]
        if not len(pairs):
            continue
        a0, a1, b0, b1, diff = pairs.T
        bit -= 1
        one = np.uint64(1 << bit)
        am = _middle(a, a0, a1, one)
        bm = am if same and (a0 == b0).all() and (a1 == b1).all() else _middle(b, b0, b1, one)
        kids = np.concatenate([np.stack(x, axis=1) for x in (
            (a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1), (am, a1, b0, bm, diff + 1))])
        ok = (kids[:, 0] < kids[:, 1]) & (kids[:, 2] < kids[:, 3]) & (kids[:, 4] <= budget)
        if same:
            ok &= kids[:, 0] <= kids[:, 2]
        kids = kids[ok]
        stack.extend((bit, kids[at:at + 262_144]) for at in range(0, len(kids), 262_144))


def _middle(v: np.ndarray, lo: np.ndarray, hi: np.ndarray, one: np.uint64) -> np.ndarray:
    """Where the bit ``one`` turns on in each range of equal upper bits."""
    return np.clip(np.searchsorted(v, (v[lo] & ~(one - np.uint64(1))) | one), lo, hi)


def _finish(budget: int):
    """One group: fingerprints of two trie nodes at depth ``depth``."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        same = first["lo"] == first["hi"]
        fp = pdf["fp"].to_numpy(np.int64).view(np.uint64)
        side = pdf["side"].to_numpy()
        a = np.unique(fp[side == 0])
        b = a if same else np.unique(fp[side == 1])
        got = list(trie_join(a, b, budget - int(first["diff"]), 64 - int(first["depth"]), same))
        x = np.concatenate([g[0] for g in got]) if got else np.empty(0, np.uint64)
        y = np.concatenate([g[1] for g in got]) if got else np.empty(0, np.uint64)
        node, root = forest(x.view(np.int64), y.view(np.int64))
        return pd.DataFrame({"a": node, "b": root})

    return run


def _masks(width: int, budget: int) -> list[int]:
    out, layer = [0], [0]
    for _ in range(budget):
        layer = sorted({m | 1 << i for m in layer for i in range(width) if not m >> i & 1})
        out += layer
    return sorted(set(out))


def _deeper(rows: DataFrame, levels: int, budget: int) -> DataFrame:
    """Walk node pairs ``levels`` levels down: every fingerprint goes to the
    child pairs that it can be part of within the budget."""
    child = F.expr(f"int(shiftrightunsigned(fp, 64 - depth - {levels}) & {(1 << levels) - 1})")
    masks = F.array(*[F.lit(m) for m in _masks(levels, budget)])
    spread = (rows.withColumn("c", child).withColumn("m", F.explode(masks))
              .withColumn("d", F.col("diff") + F.bit_count("m")).where(F.col("d") <= budget))
    mine, other = F.col("c"), F.col("c").bitwiseXOR(F.col("m"))
    self_pair = F.col("lo") == F.col("hi")
    # Below a node paired with itself the pair (x, y) is the pair (y, x).
    left = F.when(self_pair, F.least(mine, other)).when(F.col("side") == 0, mine).otherwise(other)
    right = F.when(self_pair, F.greatest(mine, other)).when(F.col("side") == 0, other).otherwise(mine)
    side = F.when(self_pair, (mine > other).cast("int")).otherwise(F.col("side"))
    up = F.lit(1 << levels)
    return spread.select((F.col("lo") * up + left).alias("lo"), (F.col("hi") * up + right).alias("hi"),
                         (F.col("depth") + levels).alias("depth"), F.col("d").alias("diff"), side.alias("side"), "fp")


def links(distinct: DataFrame, max_bits: int = MAX_BITS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, b): links that connect the same fingerprints as all pairs of
    distinct ``fp`` at ``max_bits`` or fewer differing bits."""
    n = distinct.count()
    levels = max(4, math.ceil(math.log2(max(1, n / group_rows))))
    key = ["lo", "hi", "depth", "diff"]
    schema = "a long, b long"
    rows = distinct.select(F.lit(0).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"), F.lit(0).alias("depth"),
                           F.lit(0).alias("diff"), F.lit(0).alias("side"), "fp")
    rows, found = stored(_deeper(rows, levels, max_bits), "trie"), []
    while True:
        sizes = rows.groupBy(*key).agg(F.count("*").alias("n"), F.countDistinct("side").alias("sides"))
        sizes = sizes.where((F.col("sides") == 2) | (F.col("lo") == F.col("hi")))
        sizes = stored(sizes.select(*key, ((F.col("n") > 4 * group_rows) & (F.col("depth") <= 56)).alias("large")), "nodes")
        held = rows.join(sizes, key)
        found.append(held.where(~F.col("large")).select(*key, "side", "fp").groupBy(*key).applyInPandas(_finish(max_bits), schema))
        if not sizes.where("large").head(1):
            break
        rows = stored(_deeper(held.where("large").select(*key, "side", "fp"), 4, max_bits), "trie")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, keeper_hash) of every row.

    component_id is the smallest doc_id that links of ``max_bits`` or fewer
    differing bits reach; (component_id, keeper_hash) names one row's text.
    """
    rows = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash")))
    classes = stored(rows.groupBy("fp").agg(first.alias("first"), F.min("text_hash").alias("hash")), "classes")
    nodes = components(links(classes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "root")
    grouped = classes.join(nodes, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = grouped.groupBy("root").agg(F.min("first").alias("best"), F.min("hash").alias("any"))
    named = grouped.select("fp", "root").join(best, "root").select(
        "fp", F.col("best.doc_id").alias("component_id"), F.coalesce("best.text_hash", "any").alias("keeper_hash"))
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id", "keeper_hash")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
               max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the
    smallest doc_id.  Rows repeated whole count as one row."""
    found = near_duplicates(docs, id_col, text_col, words, max_bits)
    mine = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("keeper_hash"))
    keep = stored(found.where(mine).groupBy("doc_id", "text_hash").agg(F.count("*").alias("_copies"))
                  .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_copies"), "keepers")

    def those(kept: DataFrame) -> DataFrame:
        same = docs[id_col].cast("long").eqNullSafe(kept["_id"]) & (F.xxhash64(docs[text_col].cast("string")) == kept["_hash"])
        return docs.join(kept, same, "left_semi")

    once = those(keep.where("_copies = 1"))
    if not keep.where("_copies > 1").head(1):
        return once
    return once.union(those(keep.where("_copies > 1")).dropDuplicates([id_col, text_col]))
