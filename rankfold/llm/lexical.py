"""Ranked lexical search by dense blocked matrix products.

Items (the query set) are dealt into blocks of up to ``ITEM_BLOCK`` items; a
block's vocabulary is compact, the terms of its items only, and is cut into
tiles.  A task turns a run of documents into a dense tile of term impacts
(vocabulary x documents) and multiplies it by the block's tile of term weights
(items x vocabulary) in float64.  A vocabulary tile is only as wide as keeps
every partial sum below 2^53, so each product is exact; tiles are added in
64-bit integers.  Each task keeps the ``k`` best documents of every item, ties
at the k-th score included until they are cut by document id, and Spark ranks
the survivors.

The corpus is tokenised once per pass over the items: a pass holds the items
whose terms fit ``PASS_TERMS``, which bounds the vocabulary that is broadcast;
more items take more passes.  Documents are stored as the terms of the pass
that they hold, so their counts (documents, terms, documents per term) cover
the whole corpus before anything is scored.

Edge cases: a null or empty text has no terms, is not counted and never
returned; texts are read whole, in runs cut between terms; an item without
terms, or none of whose terms occur, has no row; rows that share an item_id
are ranked one by one, rows that share a doc_id are separate documents (the
rank decides); a null doc_id ranks after others of its score, a null item_id
is returned as null; empty tables give no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.store import stored

ITEM_BLOCK = 32
TILE_TERMS = 2048
TILE_DOCS = 2048
PASS_TERMS = 1_000_000
RUN_BYTES = 1 << 20

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(32 if c in _SEPARATORS else c + 32 if 65 <= c <= 90 else c for c in range(256))


def runs(data: bytes, table: bytes, size: int = RUN_BYTES, end: bytes = b" ") -> Iterator[bytes]:
    """``data`` through ``table``, in runs of about ``size`` bytes that end at ``end``."""
    if len(data) <= size:
        yield data.translate(table)
        return
    rest, at = b"", 0
    while at < len(data):
        rest += data[at:at + size].translate(table)
        at += size
        cut = rest.rfind(end) + 1 if at < len(data) else len(rest)
        if cut:
            yield rest[:cut]
            rest = rest[cut:]


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, run by run."""
    for run in runs(text, _TABLE):
        yield run.split()


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        found = [sorted({t for run in terms(x or b"") for t in run}) for x in b.column(1).to_pylist()]
        yield pa.record_batch([b.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"])


def _sparse(vocabulary):
    """(doc_id, n, ids, counts) of each document: all its terms counted, the
    vocabulary's kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = vocabulary.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                b = whole.slice(at, 1024)
                total, ids, counts = [], [], []
                for text in b.column(1).to_pylist():
                    n, held = 0, []
                    for words in terms(text or b""):
                        n += len(words)
                        found = [i for i in map(index.get, words) if i is not None]
                        held.append(np.unique(np.array(found, np.int32), return_counts=True))
                    total.append(n)
                    if len(held) == 1:
                        i, c = held[0]
                    elif held:
                        i, at_ = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
                        c = np.zeros(len(i), np.int64)
                        np.add.at(c, at_, np.concatenate([h[1] for h in held]))
                    else:
                        i, c = np.empty(0, np.int32), np.empty(0, np.int64)
                    ids.append(i.astype("<i4").tobytes())
                    counts.append(c.astype("<i8").tobytes())
                yield pa.record_batch([b.column(0), pa.array(total, pa.int64()), pa.array(ids, pa.binary()),
                                       pa.array(counts, pa.binary())], names=["doc_id", "n", "ids", "counts"])

    return run


def _holders(size: int):
    """Documents of the partition that hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4"), minlength=size)
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["term", "df"])

    return run


def length_norm(n: np.ndarray, total_docs: int, total_terms: int) -> np.ndarray:
    """100 - 50 + (50 * n * N) div L, exact at any size."""
    if n.size and int(n.max()) * 50 * total_docs >= 1 << 63:
        return np.array([50 + (50 * int(x) * total_docs) // total_terms for x in n], np.int64)
    return 50 + (50 * n * total_docs) // total_terms


def term_weight(df: np.ndarray, total_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def tile_width(weights: np.ndarray) -> int:
    """Terms whose products with impacts of at most 10^6 stay below 2^53 in sum."""
    top = int(weights.max(initial=0)) * 1_000_000
    return max(1, min(TILE_TERMS, ((1 << 53) - 1) // max(1, top)))


def _best(score: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by score descending, doc ascending."""
    if len(score) > k:
        low = np.partition(score, len(score) - k)[len(score) - k]
        keep = np.flatnonzero(score >= low)  # every tie at the k-th score
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((doc[keep], -score[keep]))[:k]]


def _search(plan, total_docs: int, total_terms: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, weights, keys = plan.value
        # Per block: its terms, and their place in the block's vocabulary.
        place = np.full(len(weights), -1, np.int64)
        best = [[(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in b[0]] for b in blocks]
        floor = [np.zeros(len(b[0]), np.int64) for b in blocks]
        last = np.iinfo(np.int64).max  # null ids rank last
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_DOCS):
                b = whole.slice(at, TILE_DOCS)
                doc = b.column(0).fill_null(last).to_numpy(zero_copy_only=False).astype(np.int64)
                n = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                held = [np.frombuffer(x, "<i4") for x in b.column(2).to_pylist()]
                owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
                if not len(owner):
                    continue
                term = np.concatenate(held)
                tf = np.frombuffer(b"".join(b.column(3).to_pylist()), "<i8")
                m = length_norm(n, total_docs, total_terms)
                impact = ((1_000_000_000 * tf) // (1000 * tf + 20 * m[owner])).astype(np.float64)
                for at_block, (items, vocabulary, matrix) in enumerate(blocks):
                    place[vocabulary] = np.arange(len(vocabulary))
                    row = place[term]
                    place[vocabulary] = -1
                    mine = row >= 0
                    if not mine.any():
                        continue
                    r, c, v = row[mine], owner[mine], impact[mine]
                    score = np.zeros((len(items), len(doc)), np.int64)
                    width = tile_width(weights[vocabulary])
                    for lo in range(0, len(vocabulary), width):
                        hi = min(lo + width, len(vocabulary))
                        inside = (r >= lo) & (r < hi)
                        tile = np.zeros((hi - lo, len(doc)))
                        tile[r[inside] - lo, c[inside]] = v[inside]
                        score += (matrix[:, lo:hi] @ tile).astype(np.int64)
                    for i, j in enumerate(floor[at_block]):
                        good = np.flatnonzero(score[i] >= max(int(j), 1))
                        if not len(good):
                            continue
                        s, d = best[at_block][i]
                        s, d = np.concatenate([s, score[i][good]]), np.concatenate([d, doc[good]])
                        top = _best(s, d, k)
                        best[at_block][i] = s[top], d[top]
                        if len(top) == k:
                            floor[at_block][i] = s[top[-1]]
        for found, (items, _, _) in zip(best, blocks):
            for (s, d), item in zip(found, items):
                if len(s):
                    yield pa.record_batch([pa.array(np.full(len(s), keys[item]), pa.int64()),
                                           pa.array(d, pa.int64(), mask=d == last), pa.array(s, pa.int64())],
                                          names=["item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item
    with a score above 0, equal scores by ascending doc_id."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    asked = stored(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").cast("binary").alias("text"))
                   .withColumn("item", F.monotonically_increasing_id()), "items")
    held = stored(asked.select("item", "text").mapInArrow(_item_terms, "item long, terms array<binary>"), "item-terms")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    size = held.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes = max(1, math.ceil(size / PASS_TERMS))
    found = []
    for number in range(passes):
        # The items of a pass: their terms number about PASS_TERMS at most (or are one item's).
        part = held.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == number).orderBy("item").collect() if passes > 1 else (
            held.orderBy("item").collect())
        index: dict[bytes, int] = {}
        lists = [np.array([index.setdefault(bytes(t), len(index)) for t in r["terms"]], np.int64) for r in part]
        vocabulary = sc.broadcast(index)
        sparse = stored(texts.mapInArrow(_sparse(vocabulary), "doc_id long, n long, ids binary, counts binary"), "impacts")
        total_docs, total_terms = sparse.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not total_docs or not index:
            vocabulary.destroy()
            continue
        df = np.zeros(len(index), np.int64)  # one row per term of the pass
        for r in sparse.select("ids").mapInArrow(_holders(len(index)), "term int, df long").groupBy("term").agg(
                F.sum("df").alias("df")).toLocalIterator():
            df[r["term"]] = r["df"]
        weights = term_weight(df, total_docs)
        weights[df == 0] = 0
        blocks = []
        for at in range(0, len(lists), ITEM_BLOCK):
            block = lists[at:at + ITEM_BLOCK]
            words = np.unique(np.concatenate(block))
            matrix = np.zeros((len(block), len(words)))
            for i, t in enumerate(block):
                matrix[i, np.searchsorted(words, t)] = weights[t]
            blocks.append((list(range(at, at + len(block))), words, matrix))
        plan = sc.broadcast((blocks, weights, np.array([r["item"] for r in part], np.int64)))
        rows = sparse.where(F.length("ids") > 0).mapInArrow(
            _search(plan, total_docs, total_terms, k), "item long, doc_id long, score long")
        found.append(stored(rows, "hits"))
        for shared in (vocabulary, plan):
            shared.destroy()
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long").select(
            F.col("item_id").cast(asked.schema["item_id"].dataType).alias("item_id"), "rank", "doc_id", "score")
    hits = found[0]
    for more in found[1:]:
        hits = hits.union(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # Two levels: k rows per item and salt, then k per item.
    some = (hits.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(64)))
            .withColumn("place", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("place") <= k))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
