"""Exact top-k search by distributed histogram selection.

Vectors are quantised to integers and held in blocks of rows; every query
block meets every vector block in some task, which scores the pair by one
matrix product.  No task keeps a candidate heap: each pass counts scores into
``bins`` equal bins of every query's current interval, Spark sums the counts,
and the interval shrinks to the bin that holds the k-th largest score, until
it is one integer wide.  A last pass keeps the scores above the k-th value and,
of those equal to it, the smallest ids.

A block needs to report a query's bins only from the top until they hold as
many scores as are still wanted: the k-th value cannot lie below them.  So a
pass reports at most k rows per query and block.

Edge cases: rows whose vector is null or holds a null, NaN or infinite
component, or whose id is null, take no part; vectors of another length than
the query's are not its candidates; a query skips every row of its own id;
rows that share an id are separate rows (of queries as of candidates); fewer
than k candidates: all of them; empty tables give no row; other columns are
ignored; a score that does not fit a 64-bit integer raises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.store import stored

BLOCK_ROWS = 4096
QUERY_ROWS = 1024


def quantise(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """(id, q): floor(scale * x) of every component, x as double; only whole,
    finite vectors."""
    v = F.col("v")
    ok = F.col("id").isNotNull() & v.isNotNull() & ~F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(ok).select("id", F.transform("v", lambda x: F.floor(x * scale)).alias("q")))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """(dim, n, ids, data): runs of up to ``size`` rows of one partition, ids
    as i64 and vectors as i32 (i64 where they need it) bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, data = held.pop(dim)
            q = np.array(data, np.int64).reshape(len(ids), dim)
            return pa.record_batch([pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()),
                                    pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                                    pa.array([q.astype("<i8" if q.size and np.abs(q).max() >= 1 << 31 else "<i4").tobytes()],
                                             pa.binary())], names=["dim", "n", "ids", "data"])

        for b in batches:
            for i, q in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids, data = held.setdefault(len(q), ([], []))
                ids.append(i)
                data.append(q)
                if len(ids) == size:
                    yield out(len(q))
        for dim in list(held):
            yield out(dim)

    return rows.select("id", "q").mapInArrow(run, "dim int, n int, ids binary, data binary")


def _matrix(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, "<i8" if n * dim and len(data) == 8 * n * dim else "<i4").astype(np.int64).reshape(n, dim)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1]
    if top < 2.0 ** 53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    if top < 2.0 ** 63:
        return q @ v.T
    raise OverflowError("inner products exceed 64 bits")


def _peaks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        tops = [int(np.abs(_matrix(d, n, dim)).max(initial=0)) for d, n, dim in zip(*(c.to_pylist() for c in b.columns))]
        yield pa.record_batch([pa.array(tops, pa.int64())], names=["top"])


def _first_state(peak: int, k: int):
    """Each query's first interval: |score| <= peak * sum |q|."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, dim, n, data in zip(*(c.to_pylist() for c in b.columns)):
                reach = [int(x) * peak for x in np.abs(_matrix(data, n, dim)).sum(axis=1)]
                if max(reach, default=0) >= 1 << 61:
                    raise OverflowError("inner products may exceed 64 bits")
                yield pa.record_batch([
                    pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([-r for r in reach], pa.int64()),
                    pa.array([2 * r + 1 for r in reach], pa.int64()), pa.array([k] * n, pa.int64())],
                    names=["qblock", "row", "low", "width", "need"])

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(qblock, first row, query ids, vector ids, scores, low, width, need), a
    few query rows at a time."""
    for b in batches:
        for i in range(b.num_rows):
            dim, n, ids, data, qblock, qn, qids, qdata, state = (c[i].as_py() for c in b.columns)
            v, vid = _matrix(data, n, dim), np.frombuffer(ids, "<i8")
            q, qid = _matrix(qdata, qn, dim), np.frombuffer(qids, "<i8")
            low, width, need = (np.array([s[c] for s in state], np.int64) for c in ("low", "width", "need"))
            for at in range(0, qn, 256):
                to = slice(at, at + 256)
                yield qblock, at, qid[to], vid, _scores(q[to], v), low[to], width[to], need[to]


def _count(bins: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for qblock, at, qid, vid, s, low, width, need in _pairs(batches):
            step = -(-width // bins)
            ok = (s >= low[:, None]) & (s < (low + width)[:, None]) & (vid[None, :] != qid[:, None])
            slot = (s - low[:, None]) // step[:, None] + np.arange(len(qid))[:, None] * bins
            n = np.bincount(slot[ok], minlength=len(qid) * bins).reshape(len(qid), bins)
            higher = np.cumsum(n[:, ::-1], axis=1)[:, ::-1] - n  # in the bins above
            row, bin_ = np.nonzero((n > 0) & (higher < need[:, None]))
            yield pa.record_batch([pa.array(np.full(len(row), qblock), pa.int64()), pa.array(row + at, pa.int32()),
                                   pa.array(bin_, pa.int64()), pa.array(n[row, bin_], pa.int64())],
                                  names=["qblock", "row", "bin", "n"])

    return run


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for qblock, at, qid, vid, s, low, _, need in _pairs(batches):
        other = vid[None, :] != qid[:, None]
        row, col = np.nonzero((s > low[:, None]) & other)
        tie_row, tie_col = np.nonzero((s == low[:, None]) & other)
        order = np.lexsort((vid[tie_col], tie_row))  # the smallest ids of each query's ties
        tie_row, tie_col = tie_row[order], tie_col[order]
        first = np.searchsorted(tie_row, tie_row)
        keep = np.arange(len(tie_row)) - first < need[tie_row]
        row, col = np.concatenate([row, tie_row[keep]]), np.concatenate([col, tie_col[keep]])
        yield pa.record_batch([pa.array(qid[row], pa.int64()), pa.array(np.full(len(row), qblock), pa.int64()),
                               pa.array(row + at, pa.int32()), pa.array(vid[col], pa.int64()),
                               pa.array(s[row, col], pa.int64())], names=["query_id", "qblock", "row", "id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int, bins: int = 1024) -> DataFrame:
    """(query_id, rank, id, score) of the ``k`` best rows of ``vectors`` (id, q)
    for every row of ``queries`` (id, q); ties to the smaller id."""
    spark = vectors.sparkSession
    held = stored(blocks(vectors, BLOCK_ROWS).withColumn("block", F.monotonically_increasing_id()), "vectors")
    asked = stored(blocks(queries, QUERY_ROWS).withColumn("qblock", F.monotonically_increasing_id()), "queries")
    size, peak = held.count(), held.select("data", "n", "dim").mapInArrow(_peaks, "top long").agg(F.max("top")).first()[0]
    # Every query block meets every vector block: a vector block goes to one
    # group of blocks, a query block to each group.
    groups = max(1, min(size, 4 * spark.sparkContext.defaultParallelism))
    left = held.select(F.pmod(F.xxhash64("block"), F.lit(groups)).alias("group"), "dim", "n", "ids", "data")
    right = asked.select("qblock", "dim", F.col("n").alias("qn"), F.col("ids").alias("qids"), F.col("data").alias("qdata"))

    def pairs(state: DataFrame) -> DataFrame:
        packed = state.groupBy("qblock").agg(  # at most QUERY_ROWS rows a block
            F.sort_array(F.collect_list(F.struct("row", "low", "width", "need"))).alias("state"))
        spread = right.join(packed, "qblock").withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
        return left.join(spread, ["group", "dim"]).select("dim", "n", "ids", "data", "qblock", "qn", "qids", "qdata", "state")

    state = stored(asked.select("qblock", "dim", "n", "data").mapInArrow(
        _first_state(peak or 0, k), "qblock long, row int, low long, width long, need long"), "interval")
    down = Window.partitionBy("qblock", "row").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    while (state.agg(F.max("width")).first()[0] or 1) > 1:
        counts = pairs(state).mapInArrow(_count(bins), "qblock long, row int, bin long, n long")
        run = (counts.groupBy("qblock", "row", "bin").agg(F.sum("n").alias("n"))
               .withColumn("run", F.sum("n").over(down)))  # at most `bins` rows a query
        step = F.ceil(F.col("width") / F.lit(bins)).cast("long")
        kth = (F.col("run") >= F.col("need")) & (F.col("run") - F.col("n") < F.col("need"))
        found = (run.join(state.select("qblock", "row", "need"), ["qblock", "row"]).where(kth)
                 .select("qblock", "row", "bin", (F.col("run") - F.col("n")).alias("above")))
        hit = F.col("bin").isNotNull()  # else the query has fewer candidates than k: all are kept
        state = stored(state.join(found, ["qblock", "row"], "left").select(
            "qblock", "row", F.when(hit, F.col("low") + F.col("bin") * step).otherwise(F.col("low") - 1).alias("low"),
            F.when(hit, step).otherwise(F.lit(1)).cast("long").alias("width"),
            (F.col("need") - F.coalesce("above", F.lit(0))).alias("need")), "interval")
    hits = pairs(state).mapInArrow(_collect, "query_id long, qblock long, row int, id long, score long")
    order = Window.partitionBy("qblock", "row").orderBy(F.desc("score"), "id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))
