"""Exact order statistics by weighted selection.

Values are first counted: a *run* is one row (key, value, weight), so a value
that a third of all rows hold is one run.  Runs are range-partitioned and
sorted by (key, value); a key may span any number of partitions.  Each
partition reports the weight of its first and of its last key only, which
gives every partition the weight before it and the total of the keys that it
shares with others.  A second pass over the sorted runs turns weights into
positions and returns the values at the positions asked for: nothing is joined
or shuffled again, and only two rows per partition reach the driver.

A partition's runs are held by their task; ``num_partitions`` sets their size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from rankfold.session import ensure_checkpoint_dir

Positions = Callable[[np.ndarray], np.ndarray]


def median_positions(total: np.ndarray) -> np.ndarray:
    """The one or two middle positions of ``total`` values."""
    return np.stack([(total - 1) // 2, total // 2], axis=1)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of every key of a sorted table; null keys are a key."""
    change = np.zeros(table.num_rows, bool)
    if table.num_rows:
        change[0] = True
    for k in keys:
        c = table.column(k).combine_chunks()
        a, b = c.slice(1), c.slice(0, len(c) - 1)
        differ = pc.coalesce(pc.not_equal(a, b), pc.xor(a.is_null(), b.is_null()))
        change[1:] |= differ.to_numpy(zero_copy_only=False)
    return np.flatnonzero(change)


def _ends(keys: list[str], weight: str):
    """The weight of a partition's first and last key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        table = pa.Table.from_batches(held) if held else None
        if table is None or not table.num_rows:
            return
        at = _starts(table, keys)
        w = np.add.reduceat(table.column(weight).to_numpy().astype(np.int64), at)
        pick = [0, len(at) - 1]
        out = table.select(["_pid", *keys]).take(pa.array(at[pick])).to_batches()[0]
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(w[pick]), pa.array([0, 1], pa.int32()),
                                          pa.array([len(at) == 1] * 2)], names=["_pid", *keys, "_w", "_last", "_whole"])

    return run


def _pick(keys: list[str], value: str, weight: str, edges, positions: Positions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        table = pa.Table.from_batches(held) if held else None
        if table is None or not table.num_rows:
            return
        first_before, first_total, last_total = edges.value[table.column("_pid")[0].as_py()]
        at = _starts(table, keys)
        w = table.column(weight).to_numpy().astype(np.int64)
        cum = np.cumsum(w)
        local = np.add.reduceat(w, at)
        base = cum[at] - w[at]  # weight of the partition before each key
        before, total = np.zeros(len(at), np.int64), local.copy()
        total[-1] = last_total
        before[0], total[0] = first_before, first_total
        want = positions(total) - before[:, None]  # within this partition's part of the key
        seg, place = np.nonzero((want >= 0) & (want < local[:, None]))
        if not len(seg):
            return
        row = np.searchsorted(cum, base[seg] + want[seg, place], "right")
        out = table.select([*keys, value]).take(pa.array(row)).combine_chunks()
        cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in out.columns]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(place.astype(np.int32)), pa.array(total[seg])],
                                         names=[*keys, value, "place", "total"])

    return run


def runs_of(df: DataFrame, keys: list[str | Column], value: str | Column, weight: str = "weight") -> DataFrame:
    """(keys, value, weight): equal values of a key as one row."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(weight))


def weighted_select(runs: DataFrame, keys: list[str], value: str, weight: str, positions: Positions,
                    num_partitions: int | None = None) -> DataFrame:
    """(keys, value, place, total): for every key the value at each of the
    0-based ``positions(total weight)``, in ascending order of value (nulls
    first); ``place`` is the position's index.  Positions outside the key's
    range give no row."""
    spark = runs.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    order = [*keys, value]
    sorted_ = (runs.select(*order, F.col(weight).cast("long").alias(weight)).repartitionByRange(n, *order)
               .sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id())).checkpoint(eager=True)
    fields = {f.name: f for f in sorted_.schema}
    key_fields = [fields[k] for k in keys]
    ends = sorted_.mapInArrow(_ends(keys, weight), StructType([
        fields["_pid"], *key_fields, StructField("_w", LongType()), StructField("_last", IntegerType()),
        *spark.range(0).select(F.lit(True).alias("_whole")).schema.fields]))
    parts: dict[int, list] = {}
    for r in ends.collect():  # two rows per partition
        parts.setdefault(r["_pid"], [None, None])[r["_last"]] = (tuple(r[k] for k in keys), r["_w"], r["_whole"])
    edges, order_of = {}, sorted(parts)
    total: dict[tuple, int] = {}
    for pid in order_of:
        (first, w0, whole), (last, w1, _) = parts[pid]
        total[first] = total.get(first, 0) + w0
        if not whole:
            total[last] = total.get(last, 0) + w1
    so_far: dict[tuple, int] = {}
    for pid in order_of:
        (first, w0, whole), (last, w1, _) = parts[pid]
        edges[pid] = (so_far.get(first, 0), total[first], total[last])
        so_far[first] = so_far.get(first, 0) + w0
        if not whole:
            so_far[last] = so_far.get(last, 0) + w1
    shared = spark.sparkContext.broadcast(edges)  # three numbers per partition
    return sorted_.mapInArrow(_pick(keys, value, weight, shared, positions), StructType([
        *key_fields, fields[value], StructField("place", IntegerType()), StructField("total", LongType())]))


def group_medians(runs: DataFrame, keys: list[str], value: str, weight: str, out: str,
                  num_partitions: int | None = None) -> DataFrame:
    """(keys, out): exact median of every key's non-null values."""
    picked = weighted_select(runs.where(F.col(value).isNotNull()), keys, value, weight, median_positions, num_partitions)
    return picked.groupBy(*keys).agg(F.avg(F.col(value).cast("double")).alias(out))


def values_at(df: DataFrame, value: str, positions: Positions, num_partitions: int | None = None) -> tuple[int, dict[int, object]]:
    """(number of values, place -> value) of a whole column, nulls first."""
    found = weighted_select(runs_of(df, [], value), [], value, "weight", positions, num_partitions).collect()
    return (found[0]["total"] if found else 0), {r["place"]: r[value] for r in found}
