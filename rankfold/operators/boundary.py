"""Order features by boundary exchange.

Rows are range-partitioned and sorted once; a key, or the whole frame, may
span any number of partitions.  A row's neighbours are in its own partition but
for the first and last few rows, so every partition reports its first and last
``k`` rows, and gets the ``k`` rows before and after it, taken from as many
neighbours as it needs.  A second, narrow pass over the sorted rows computes
gaps and rolling means.  One shuffle, whatever the number of columns; what the
driver and the broadcast hold is at most 4 k rows per partition.

A partition's rows are held by their task; ``num_partitions`` sets their size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from rankfold.functions.scalar import epoch_micros
from rankfold.operators.selection import _starts
from rankfold.session import ensure_checkpoint_dir

# (extended rows, first own row, end of own rows) -> new columns of the own rows
Compute = Callable[[pa.Table, int, int], list[pa.Array]]


def _edge_rows(cols: Sequence[str], before: int, after: int):
    """The last ``before`` and first ``after`` rows of a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).select(["_pid", *cols])
        n = table.num_rows
        for side, part in ((0, table.slice(0, min(after, n))), (1, table.slice(max(0, n - before)))):
            for b in part.to_batches():
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, side, np.int32))],
                                                 names=["_pid", *cols, "_side"])

    return run


def _halos(edges: pa.Table, cols: Sequence[str], before: int, after: int) -> dict[int, tuple[pa.Table, pa.Table]]:
    """For every partition the ``before`` rows before it and the ``after`` rows after it."""
    pids = np.array(edges.column("_pid").to_numpy())
    side = np.array(edges.column("_side").to_numpy())
    order = sorted(set(pids.tolist()))
    plain = edges.select(list(cols))
    first = {p: plain.filter(pa.array((pids == p) & (side == 0))) for p in order}
    last = {p: plain.filter(pa.array((pids == p) & (side == 1))) for p in order}
    out, empty = {}, plain.slice(0, 0)
    ahead: dict[int, pa.Table] = {}
    rest = empty
    for p in reversed(order):
        ahead[p] = rest
        rest = pa.concat_tables([first[p], rest]).slice(0, after)
    rest = empty
    for p in order:
        out[p] = (rest, ahead[p])
        rest = pa.concat_tables([rest, last[p]])
        rest = rest.slice(max(0, rest.num_rows - before))
    return out


def _apply(cols: Sequence[str], halos, compute: Compute, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        before, after = halos.value[table.column("_pid")[0].as_py()]
        narrow = table.select(list(cols))
        whole = pa.concat_tables([before.cast(narrow.schema), narrow, after.cast(narrow.schema)]).combine_chunks()
        lo = before.num_rows
        new = compute(whole, lo, lo + table.num_rows)
        kept = table.drop_columns(["_pid"])
        yield from pa.Table.from_arrays([*kept.columns, *new], names=[*kept.column_names, *names]).to_batches(max_chunksize=65_536)

    return run


def exchange(df: DataFrame, order: list[str | Column], cols: Sequence[str], before: int, after: int, compute: Compute,
             fields: list[StructField], num_partitions: int | None = None) -> DataFrame:
    """``df`` with the columns ``fields`` that ``compute`` derives from ``cols``
    of a row's neighbours in ``order`` (a total order), at most ``before`` rows
    back and ``after`` rows ahead."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    sorted_ = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
               .withColumn("_pid", F.spark_partition_id())).checkpoint(eager=True)
    kinds = {f.name: f for f in sorted_.schema}
    edge_schema = StructType([kinds["_pid"], *[kinds[c] for c in cols], StructField("_side", IntegerType())])
    edges = sorted_.mapInArrow(_edge_rows(cols, before, after), edge_schema).toArrow()
    halos = spark.sparkContext.broadcast(_halos(edges, cols, before, after))
    names = [f.name for f in fields]
    return sorted_.mapInArrow(_apply(cols, halos, compute, names), StructType(
        [f for f in sorted_.schema if f.name != "_pid"] + fields))


def _edge_sums(keys: list[str], values: list[str]):
    """The sums of a partition's first and last key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        at = _starts(table, keys)
        pick = [0, len(at) - 1]
        sums = np.stack([np.add.reduceat(_numbers(table, v), at)[pick] for v in values], axis=1)
        out = table.select(["_pid", *keys]).take(pa.array(at[pick])).combine_chunks().to_batches()[0]
        yield pa.RecordBatch.from_arrays([*out.columns, pa.array(list(sums), pa.list_(pa.float64())), pa.array([0, 1], pa.int32()),
                                          pa.array([len(at) == 1] * 2)], names=["_pid", *keys, "_sums", "_last", "_whole"])

    return run


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).combine_chunks().fill_null(0.0).to_numpy()


def _accumulate(keys: list[str], values: list[str], edges, names: list[str], totals: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        before, first_total, last_total = edges.value[table.column("_pid")[0].as_py()]
        at = _starts(table, keys)
        run_of = np.repeat(np.arange(len(at)), np.diff(np.append(at, table.num_rows)))
        new = []
        for i, v in enumerate(values):
            x = _numbers(table, v)
            total = np.cumsum(x)
            start = total[at] - x[at]
            start[0] -= before[i]
            new.append(pa.array(total - start[run_of]))
        if totals:
            for i, v in enumerate(values):
                whole = np.add.reduceat(_numbers(table, v), at)
                whole[-1] = last_total[i]
                whole[0] = first_total[i]
                new.append(pa.array(whole[run_of]))
        kept = table.drop_columns(["_pid", *values])
        yield from pa.Table.from_arrays([*kept.columns, *new], names=[*kept.column_names, *names, *totals]).to_batches(max_chunksize=65_536)

    return run


def running_sums(df: DataFrame, keys: Sequence[str], order: list[str | Column], values: dict[str, str | Column],
                 totals: dict[str, str] | None = None, num_partitions: int | None = None) -> DataFrame:
    """``df`` with inclusive running sums inside each key, in ``order``:
    ``values`` names each sum (double) and its column or expression; nulls
    count as 0.  ``totals`` (name of a sum -> name) adds the key's whole sum.
    Null keys are a key of their own.  One shuffle; two rows per partition
    reach the driver."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    keys, held = list(keys), [f"_x{i}" for i in range(len(values))]
    source = df.withColumns({h: (F.col(v) if isinstance(v, str) else v).cast("double") for h, v in zip(held, values.values())})
    sorted_ = (source.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
               .withColumn("_pid", F.spark_partition_id())).checkpoint(eager=True)
    kinds = {f.name: f for f in sorted_.schema}
    edge = StructType([kinds["_pid"], *[kinds[k] for k in keys], StructField("_sums", ArrayType(DoubleType())),
                       StructField("_last", IntegerType()), StructField("_whole", BooleanType())])
    parts: dict[int, list] = {}
    for r in sorted_.select("_pid", *keys, *held).mapInArrow(_edge_sums(keys, held), edge).collect():
        parts.setdefault(r["_pid"], [None, None])[r["_last"]] = (tuple(r[k] for k in keys), np.array(r["_sums"]), r["_whole"])
    whole: dict[tuple, np.ndarray] = {}
    so_far: dict[tuple, np.ndarray] = {}
    zero = np.zeros(len(held))

    def add(to: dict, pid: int) -> None:
        (first, a, one), (last, b, _) = parts[pid]
        to[first] = to.get(first, zero) + a
        if not one:
            to[last] = to.get(last, zero) + b
    for pid in sorted(parts):
        add(whole, pid)
    edges = {}
    for pid in sorted(parts):
        first, last = parts[pid][0][0], parts[pid][1][0]
        edges[pid] = (so_far.get(first, zero), whole[first], whole[last])
        add(so_far, pid)
    shared = spark.sparkContext.broadcast(edges)
    names = list(values)
    ends = [totals[v] for v in names] if totals else []
    return sorted_.mapInArrow(_accumulate(keys, held, shared, names, ends), StructType(
        [f for f in sorted_.schema if f.name not in ("_pid", *held)] + [StructField(x, DoubleType()) for x in [*names, *ends]]))


def gaps(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], offsets: dict[int, tuple[str, str]],
         num_partitions: int | None = None) -> DataFrame:
    """For each offset k -> (before, after): whole seconds from the key's k-th
    previous row, and (negative) to its k-th next row, in order of (ts,
    tiebreak).  Null keys are a key of their own; a null ts gives null gaps."""
    most = max(offsets)

    def compute(rows: pa.Table, lo: int, hi: int) -> list[pa.Array]:
        n = rows.num_rows
        run = np.zeros(n, np.int64)
        run[_starts(rows, keys)] = 1
        run = np.cumsum(run)
        t = rows.column("_us").combine_chunks()
        known = np.asarray(t.is_valid())
        t = t.fill_null(0).to_numpy()
        here = np.arange(lo, hi)
        out = []
        for k in offsets:
            for step in (-k, k):
                there = here + step
                inside = (there >= 0) & (there < n)
                there = np.clip(there, 0, n - 1)
                ok = inside & (run[there] == run[here]) & known[there] & known[here]
                d = t[here] - t[there]
                out.append(pa.array(np.sign(d) * (np.abs(d) // 1_000_000), mask=~ok))
        return out

    timed = df.withColumn("_us", epoch_micros(ts))
    fields = [StructField(name, LongType()) for pair in offsets.values() for name in pair]
    return exchange(timed, [*keys, ts, *tiebreak], [*keys, "_us"], most, most, compute, fields, num_partitions).drop("_us")


def rolling(df: DataFrame, cols: Sequence[str], sizes: Sequence[int], order: list[str], keys: Sequence[str] = (),
            suffix: str = "_mean{w}", num_partitions: int | None = None) -> DataFrame:
    """Mean of the last ``w`` rows of every column and size, null unless all
    ``w`` values are there.  Without keys, over the whole frame in ``order``."""
    keys, cols = list(keys), list(cols)
    values = [f"_v{i}" for i in range(len(cols))]

    def compute(rows: pa.Table, lo: int, hi: int) -> list[pa.Array]:
        run = np.zeros(rows.num_rows, np.int64)
        if keys:
            run[_starts(rows, keys)] = 1
            run = np.cumsum(run)
        out = []
        for w in sizes:
            # Rows without w - 1 rows of the key before them have no mean.
            far = np.arange(lo, hi) - (w - 1)
            full = (far >= 0) & (run[np.maximum(far, 0)] == run[lo:hi])
            for v in values:
                c = rows.column(v).combine_chunks()
                known, x = np.asarray(c.is_valid()), c.fill_null(0.0).to_numpy()
                total, ok = np.zeros(hi - lo), full.copy()
                for step in range(w - 1, -1, -1):
                    at = np.maximum(np.arange(lo, hi) - step, 0)
                    total = total + x[at]
                    ok &= known[at]
                out.append(pa.array(total / w, mask=~ok))
        return out

    fields = [StructField(c + suffix.format(w=w), DoubleType()) for w in sizes for c in cols]
    named = df.withColumns({v: F.col(c).cast("double") for v, c in zip(values, cols)})
    return exchange(named, [*keys, *order], [*keys, *values], max(sizes) - 1, 0, compute, fields, num_partitions).drop(*values)
