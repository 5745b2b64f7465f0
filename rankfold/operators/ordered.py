"""Order-dependent features: lag/lead gaps and rolling means.

Three physical forms behind each operator:

* ``exchange`` (default) — rows sorted once across partitions, neighbours of a
  partition's first and last rows exchanged (``boundary``): one shuffle, and one
  hot key spans many partitions.
* ``window`` — ``Window.partitionBy(keys).orderBy(order)``: one hash shuffle,
  but every row of one key is sorted in one task; for keys of bounded size.
* ``chunked`` — distributed prefix + chunk/halo: a dense index over
  ``(keys, order)`` (range partitioned, so one hot key spans many
  partitions), ``chunk = idx div C``, and the last/first ``m`` rows of each
  chunk copied into the neighbouring chunk.  Windows then run inside
  ``(chunk, keys)`` groups of at most ``C + 2m`` rows, and are exact because
  the neighbours of any row are at most ``m`` index positions away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.functions.scalar import duration_seconds
from rankfold.operators import boundary
from rankfold.operators.index import global_index

DEFAULT_CHUNK_ROWS = 1_000_000


def chunk_with_halo(df: DataFrame, keys: list[str], order: list[str], before: int, after: int,
                    chunk_rows: int = DEFAULT_CHUNK_ROWS, num_partitions: int | None = None) -> DataFrame:
    """Rows tagged ``_idx``, ``_chunk`` and ``_halo`` (copies from neighbours)."""
    if chunk_rows <= max(before, after):
        raise ValueError("chunk_rows must exceed the halo width")
    idx = global_index(df, [*keys, *order], "_idx", 0, num_partitions)
    c = F.floor(F.col("_idx") / F.lit(chunk_rows)).cast("long")
    m = F.pmod(F.col("_idx"), F.lit(chunk_rows))
    home = F.array(F.struct(c.alias("_chunk"), F.lit(False).alias("_halo")))
    nxt = F.when(m >= chunk_rows - before, F.array(F.struct((c + 1).alias("_chunk"), F.lit(True).alias("_halo"))))
    prv = F.when((m < after) & (c > 0), F.array(F.struct((c - 1).alias("_chunk"), F.lit(True).alias("_halo"))))
    empty = F.array().cast("array<struct<_chunk:bigint,_halo:boolean>>")
    targets = F.concat(home, F.coalesce(nxt, empty), F.coalesce(prv, empty))
    return idx.select("*", F.inline(targets))


def _over(form: str, keys: list[str], order: list[str]):
    if form == "window":
        return Window.partitionBy(*keys).orderBy(*order)
    return Window.partitionBy("_chunk", *keys).orderBy("_idx")


def lag_lead_gaps(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str],
                  offsets: dict[int, tuple[str, str]], strategy: str = "exchange",
                  chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """For each offset k -> (before_name, after_name):
    ``before = seconds(ts - ts of the k-th previous row of the key)``,
    ``after = seconds(ts - ts of the k-th next row)`` (negative, as in the
    reference).  Rows are ordered by ``(ts, *tiebreak)``; null keys form a
    group of their own, as window partitions do.
    """
    if strategy == "exchange":
        return boundary.gaps(df, keys, ts, tiebreak, offsets)
    order, form = [ts, *tiebreak], strategy
    k_max = max(offsets)
    base = df if form == "window" else chunk_with_halo(df, keys, order, k_max, k_max, chunk_rows)
    w = _over(form, keys, order)
    cols = {}
    for k, (before, after) in offsets.items():
        cols[before] = duration_seconds(F.col(ts), F.lag(ts, k).over(w))
        cols[after] = duration_seconds(F.col(ts), F.lead(ts, k).over(w))
    out = base.withColumns(cols)
    if form != "window":
        out = out.filter(~F.col("_halo")).drop("_idx", "_chunk", "_halo")
    return out


def rolling_means(df: DataFrame, cols: list[str], sizes: list[int], keys: list[str],
                  order: list[str], strategy: str = "exchange",
                  chunk_rows: int = DEFAULT_CHUNK_ROWS, suffix: str = "_mean{w}") -> DataFrame:
    """Mean of the last ``w`` rows (current included) per column and size;
    NULL unless all ``w`` values are present (full-window rule).  With no
    keys the order is the whole frame's (the reference's form)."""
    if strategy == "exchange":
        return boundary.rolling(df, cols, sizes, order, keys, suffix)
    form = strategy
    w_max = max(sizes)
    base = df if form == "window" else chunk_with_halo(df, keys, order, w_max - 1, 0, chunk_rows)
    if form == "window" and not keys:
        raise ValueError("a whole-frame window needs the chunked form")
    spec = _over(form, keys, order)
    out_cols: dict[str, Column] = {}
    for w in sizes:
        frame = spec.rowsBetween(-(w - 1), 0)
        for c in cols:
            out_cols[c + suffix.format(w=w)] = F.when(F.count(c).over(frame) == w, F.avg(c).over(frame))
    out = base.withColumns(out_cols)
    if form != "window":
        out = out.filter(~F.col("_halo")).drop("_idx", "_chunk", "_halo")
    return out
