"""Pivot statistics over a hierarchy of clocks by mergeable states.

A *state* is what one group keeps of a column: count, mean, second and third
central moment, minimum, maximum, first and last by order.  States are built
once, for every (pivot, finest clock), and merged upwards: a parent's moments
are the children's plus the spread of their means around the parent's mean, so
nothing cancels whatever the column's offset.  A parent has a bounded number of
children (a minute's seconds, an hour's minutes, a pivot's hours of the week),
so a pivot value that holds a third of all rows is never one task's group.

Distinct values and medians need the values: they are counted once as runs
(pivot, clocks, column, value, weight), which are merged upwards the same way;
medians are picked from the runs of all levels by weighted selection.

Two ways lead from there to the rows.  A pivot value of up to ``max_rows`` rows
fits one task: the narrow rows are shuffled once by pivot, and numpy computes
every level's statistics slice by slice beside the rows, so that the wide rows
are never shuffled, spilled or written.  The rows of larger values meet the
merged states in one join, on (pivot, finest clock), as do rollups that only
count: the coarser levels are attached to that table first.  Null pivots and
null clocks are groups of their own, joined by a flag and a stand-in instead of
null-safe equality.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from rankfold.operators.selection import group_medians
from rankfold.session import PARTITION_ROWS, ensure_checkpoint_dir

# (clock, the finer clock that it is merged from); None is the pivot itself.
CLOCKS: list[tuple[str | None, str | None]] = [
    ("total_seconds", None), ("day_minute", "total_seconds"), ("day_hour", "day_minute"),
    (None, "day_hour"), ("dayofyear", "total_seconds")]

# Names of the reference's statistics; {p} is the pivot, and a
# clock is appended with an underscore.
NAMES = {"nunique": "{c}_nunique_gby_{p}", "min": "{c}_min_gby_{p}", "max": "{c}_max_gby_{p}",
         "mean": "{c}_mean_gby_{p}", "median": "{c}_median_gby_{p}", "std": "{c}_std_gby_{p}",
         "skew": "{c}_skew_{p}", "first": "{c}_first_{p}", "last": "{c}_last_{p}", "maxmin": "{c}_maxmin_{p}"}


@dataclass
class Rollup:
    """What to compute for one pivot."""
    pivot: str
    dense: Sequence[str]
    distinct: Sequence[str]
    order: Sequence[str]
    clocks: Sequence[tuple[str | None, str | None]] = field(default_factory=lambda: list(CLOCKS))
    count_names: dict[str | None, str] = field(default_factory=dict)  # level -> name of its row count

    @property
    def base(self) -> str:
        return self.clocks[0][0]

    @property
    def named_clocks(self) -> list[str]:
        return [c for c, _ in self.clocks if c]

    def name(self, kind: str, column: str, clock: str | None) -> str:
        return NAMES[kind].format(c=column, p=self.pivot) + (f"_{clock}" if clock else "")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rollup/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key(df: DataFrame, source: str, name: str) -> list[Column]:
    """A nullable key as two columns without nulls."""
    kind = df.schema[source].dataType
    return [F.coalesce(F.col(source), F.lit("" if kind.typeName() == "string" else 0).cast(kind)).alias(name),
            F.col(source).isNull().alias(f"{name}_null")]


def _keys(clock: str | None) -> list[str]:
    return ["_p", "_p_null"] + ([f"_{clock}", f"_{clock}_null"] if clock else [])


def _first_state(c: str) -> Column:
    """State of the rows of one group."""
    n = F.count(c)
    second = F.coalesce(F.var_pop(c) * n, F.lit(0.0))
    third = F.coalesce(F.skewness(c) * F.pow(second, 1.5) / F.sqrt(n), F.lit(0.0))
    return F.struct(n.alias("n"), F.avg(c).alias("mean"), second.alias("m2"), third.alias("m3"), F.min(c).alias("min"),
                    F.max(c).alias("max"), F.min_by(c, "_order").alias("first"), F.max_by(c, "_order").alias("last")).alias(c)


def _merged(df: DataFrame, keys: list[str], keep: list[str], dense: Sequence[str]) -> DataFrame:
    """States of the groups of ``keys`` from finer states; ``keep``: coarser
    clocks, which ``keys`` determine."""
    over = Window.partitionBy(*keys)
    middle = {f"_mu_{c}": F.sum(F.col(f"{c}.n") * F.col(f"{c}.mean")).over(over) / F.nullif(
        F.sum(f"{c}.n").over(over), F.lit(0)) for c in dense}
    aggs = [F.max(k).alias(k) for k in keep]
    aggs += [F.sum("_rows").alias("_rows"), F.min("_from").alias("_from"), F.max("_to").alias("_to")]
    for c in dense:
        n, d = F.col(f"{c}.n"), F.coalesce(F.col(f"{c}.mean") - F.col(f"_mu_{c}"), F.lit(0.0))
        m2, m3 = F.col(f"{c}.m2"), F.col(f"{c}.m3")
        aggs.append(F.struct(
            F.sum(n).alias("n"), F.max(f"_mu_{c}").alias("mean"), F.sum(m2 + n * d * d).alias("m2"),
            F.sum(m3 + 3 * d * m2 + n * d * d * d).alias("m3"), F.min(f"{c}.min").alias("min"), F.max(f"{c}.max").alias("max"),
            F.min_by(f"{c}.first", "_from").alias("first"), F.max_by(f"{c}.last", "_to").alias("last")).alias(c))
    return (df.withColumns(middle) if middle else df).groupBy(*keys).agg(*aggs)


def _statistics(r: Rollup, clock: str | None) -> list[Column]:
    """A level's state as named statistics."""
    out = []
    for c in r.dense:
        s = lambda f, c=c: F.col(f"{c}.{f}")
        flat = s("min") == s("max")
        values = {
            "min": s("min"), "max": s("max"), "mean": s("mean"),
            "std": F.when(s("n") > 1, F.when(flat, F.lit(0.0)).otherwise(F.sqrt(s("m2") / (s("n") - 1)))),
            "skew": F.when(~flat, F.sqrt(s("n")) * s("m3") / F.pow(s("m2"), 1.5)),
            "first": s("first"), "last": s("last"), "maxmin": s("max") - s("min")}
        out += [v.alias(r.name(k, c, clock)) for k, v in values.items()]
    if clock in r.count_names:
        out.append(F.col("_rows").alias(r.count_names[clock]))
    return out


def _up(clock: str | None, clocks: Sequence[tuple[str | None, str | None]]) -> list[str]:
    """The clocks that are merged, at any remove, from ``clock``."""
    out = []
    for c, finer in clocks:
        if c and finer is not None and (finer == clock or finer in out):
            out.append(c)
    return out


def rollup_tables(df: DataFrame, r: Rollup) -> DataFrame:
    """One row per (pivot, finest clock) with the statistics of every level, a
    struct ``_level_<i>`` each.  Key columns are ``_p``, ``_p_null``, ``_<base>``
    and ``_<base>_null``."""
    base_keys = _keys(r.base)
    coarser = [c for c in r.named_clocks if c != r.base]
    coarse_cols = [x for c in coarser for x in (f"_{c}", f"_{c}_null")]
    source = df.select(
        *_key(df, r.pivot, "_p"), *[k for c in r.named_clocks for k in _key(df, c, f"_{c}")], F.struct(*r.order).alias("_order"),
        *[F.col(c).cast("double").alias(c) for c in r.dense],
        F.array(*[F.col(c).cast("string") for c in r.distinct]).cast("array<string>").alias("_distinct"))

    # States, merged from level to level.
    states = {r.base: _stored(source.groupBy(*base_keys, *coarse_cols).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_order").alias("_from"), F.max("_order").alias("_to"),
        *[_first_state(c) for c in r.dense]), "states")}
    for clock, finer in r.clocks[1:]:
        keep = [x for c in _up(clock, r.clocks) for x in (f"_{c}", f"_{c}_null")]
        states[clock] = _stored(_merged(states[finer], _keys(clock), keep, r.dense), f"states-{clock}")

    # Runs of values and distinct values, merged from level to level.
    level = {c: i for i, (c, _) in enumerate(r.clocks)}
    runs: dict[str | None, DataFrame] = {}
    seen: dict[str | None, DataFrame] = {}
    if r.dense:
        long = source.select(*base_keys, *coarse_cols, F.inline(F.array(*[
            F.struct(F.lit(i).alias("_c"), F.col(c).alias("_v")) for i, c in enumerate(r.dense)])))
        runs[r.base] = _stored(long.where("_v IS NOT NULL").groupBy(*base_keys, *coarse_cols, "_c", "_v")
                               .agg(F.count(F.lit(1)).alias("_w")), "runs")
    if r.distinct:
        seen[r.base] = _stored(source.select(*base_keys, *coarse_cols, F.posexplode("_distinct").alias("_c", "_v")).distinct(), "distinct")
    for clock, finer in r.clocks[1:]:
        keep = [x for c in _up(clock, r.clocks) for x in (f"_{c}", f"_{c}_null")]
        if r.dense:
            runs[clock] = _stored(runs[finer].groupBy(*_keys(clock), *keep, "_c", "_v").agg(F.sum("_w").alias("_w")), f"runs-{clock}")
        if r.distinct:
            seen[clock] = _stored(seen[finer].select(*_keys(clock), *keep, "_c", "_v").distinct(), f"distinct-{clock}")

    # Medians of all levels in one selection: (level, pivot, clock, column) is the key.
    medians = None
    if r.dense:
        flat = [runs[c].select(F.lit(i).alias("_level"), "_p", "_p_null", *(
            [F.col(f"_{c}").cast("long").alias("_t"), F.col(f"_{c}_null").alias("_t_null")] if c else
            [F.lit(0).cast("long").alias("_t"), F.lit(False).alias("_t_null")]), "_c", "_v", "_w") for c, i in level.items()]
        medians = _stored(group_medians(reduce(DataFrame.union, flat), ["_level", "_p", "_p_null", "_t", "_t_null", "_c"],
                                        "_v", "_w", "_m"), "medians")

    # A level's statistics, distinct counts and medians side by side.
    tables = {}
    for clock, i in level.items():
        keys = _keys(clock)
        side = states[clock].select(*keys, *(coarse_cols if clock == r.base else []), *_statistics(r, clock))
        if medians is not None:
            mids = medians.where(F.col("_level") == i).select("_p", "_p_null", *(
                [F.col("_t").cast(df.schema[clock].dataType).alias(f"_{clock}"), F.col("_t_null").alias(f"_{clock}_null")] if clock else []),
                "_c", "_m").groupBy(*keys).agg(*[
                    F.max(F.when(F.col("_c") == j, F.col("_m"))).alias(r.name("median", c, clock)) for j, c in enumerate(r.dense)])
            side = side.join(mids, keys, "left")
        if r.distinct:
            side = side.join(seen[clock].groupBy(*keys).agg(*[
                F.count(F.when(F.col("_c") == j, 1)).alias(r.name("nunique", c, clock)) for j, c in enumerate(r.distinct)]), keys, "left")
        extra = coarse_cols if clock == r.base else []
        tables[clock] = side.select(*keys, *extra, F.struct(*([c for c in side.columns if c not in (*keys, *extra)] or [F.lit(None).alias("_none")])).alias(f"_level_{i}"))
    wide = tables[r.base]
    for clock, _ in r.clocks[1:]:
        wide = wide.join(tables[clock], _keys(clock), "left")
    return wide.drop(*coarse_cols)


def rollup_names(r: Rollup) -> list[tuple[str, str | None, str]]:
    """(kind, column, output name) of all statistics, level by level."""
    out = []
    for clock, _ in r.clocks:
        out += [("nunique", c, r.name("nunique", c, clock)) for c in r.distinct]
        out += [(k, c, r.name(k, c, clock)) for k in NAMES if k != "nunique" for c in r.dense]
        if clock in r.count_names:
            out.append(("count", None, r.count_names[clock]))
    return out


# ------------------------------------------------- pivots that fit a task --

SLICE_ROWS, BATCH_ROWS = 16_384, 8_192  # rows whose statistics are held, and given out, at a time
MOMENTS = ("min", "max", "mean", "std", "skew", "first", "last", "maxmin")  # as in _statistics


def _level_outputs(r: Rollup, clock: str | None) -> list[tuple[str, int | None, str]]:
    """(kind, place of the column, output name) of a level, in the order of the joined form."""
    out = [(k, i, r.name(k, c, clock)) for i, c in enumerate(r.dense) for k in MOMENTS]
    if clock in r.count_names:
        out.append(("count", None, r.count_names[clock]))
    out += [("median", i, r.name("median", c, clock)) for i, c in enumerate(r.dense)]
    return out + [("nunique", i, r.name("nunique", c, clock)) for i, c in enumerate(r.distinct)]


def _codes(table: pa.Table, column: str) -> np.ndarray:
    """A number for every value of a column; nulls are -1."""
    coded = table.column(column).combine_chunks().dictionary_encode()
    return coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for every pair of codes."""
    return (a + 1) * (b.max(initial=-1) + 2) + b + 1


def _pieces(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of about ``size`` rows that end at some of ``ends``."""
    at = 0
    while at < ends[-1]:
        to = int(ends[max(np.searchsorted(ends, at + size, "right") - 1, np.searchsorted(ends, at, "right"))])
        yield at, to
        at = to


def _ends(sorted_: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1, len(sorted_))


def _level_statistics(key: np.ndarray, dense: list[tuple], distinct: list[np.ndarray]) -> tuple[np.ndarray, dict]:
    """The group of every row, by ``key``, and the groups' statistics:
    (kind, place of the column) -> (values, which are known).  Rows come in
    order inside each group; ``dense`` holds (values, known, order by value)."""
    _, group, size = np.unique(key, return_inverse=True, return_counts=True)
    groups = len(size)
    start = np.cumsum(size) - size
    ordered = np.argsort(group, kind="stable")
    first, last = ordered[start], ordered[start + size - 1]
    out: dict[tuple, tuple] = {("count", None): (size.astype(np.int64), None)}
    with np.errstate(all="ignore"):
        for i, (x, known, by_value) in enumerate(dense):
            ranked = x[by_value[np.argsort(group[by_value], kind="stable")]]  # a group's values ascending, nulls last
            n = np.bincount(group[known], minlength=groups)
            some, most = n > 0, np.maximum(n, 1)
            low, high = ranked[start], ranked[start + most - 1]
            mean = np.bincount(group, np.where(known, x, 0.0), groups) / most
            off = np.where(known, x - mean[group], 0.0)
            rest = np.bincount(group, off, groups) / most  # what rounding left in the mean
            rest = np.where(np.isfinite(rest), rest, 0.0)
            off = np.where(known, off - rest[group], 0.0)
            square = off * off
            m2, m3 = np.bincount(group, square, groups), np.bincount(group, square * off, groups)
            flat = (low == high) | (np.isnan(low) & np.isnan(high))
            out["min", i], out["max", i], out["mean", i] = (low, some), (high, some), (mean + rest, some)
            out["std", i] = np.where(flat, 0.0, np.sqrt(m2 / np.maximum(n - 1, 1))), n > 1
            out["skew", i] = np.sqrt(n) * m3 / m2 ** 1.5, some & ~flat & (m2 != 0)
            out["first", i], out["last", i] = (x[first], known[first]), (x[last], known[last])
            out["maxmin", i] = high - low, some
            out["median", i] = (ranked[start + (most - 1) // 2] + ranked[start + most // 2]) / 2, some
    for i, code in enumerate(distinct):  # null is a value of its own
        width = code.max(initial=-1) + 2
        out["nunique", i] = np.bincount(np.unique(group * width + code + 1) // width, minlength=groups), None
    return group, out


def _beside_rows(r: Rollup, keep: list[str]):
    """Rows of whole pivots -> the same rows with the statistics of all levels."""
    cut = dict(r.clocks).get(None)  # pivots longer than a slice are cut at its groups
    inner = [c for c in r.named_clocks if cut and (c == cut or cut in _up(c, r.clocks))]
    outputs = {c: _level_outputs(r, c) for c, _ in r.clocks}
    names = [*keep, *[n for c, _ in r.clocks for _, _, n in outputs[c]]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        del held
        pivot = _codes(table, r.pivot)
        clocks = {c: _pairs(pivot, _codes(table, c)) if c else pivot for c, _ in r.clocks}
        distinct = [_codes(table, f"_s{i}") for i in range(len(r.distinct))]
        dense = []
        for i in range(len(r.dense)):
            column = table.column(f"_d{i}").combine_chunks()
            dense.append((column.fill_null(0.0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)))
        kept = table.select(keep)
        order = pc.sort_indices(table.select(list(r.order)), sort_keys=[(c, "ascending") for c in r.order],
                                null_placement="at_start").to_numpy()

        def levels(rows: np.ndarray, which: list) -> dict:
            columns = [(x[rows], known[rows]) for x, known in dense]
            columns = [(x, known, np.lexsort((x, ~known))) for x, known in columns]
            codes = [code[rows] for code in distinct]
            return {c: _level_statistics(clocks[c][rows], columns, codes) for c in which}

        rows = order[np.argsort(pivot[order], kind="stable")]
        for lo, hi in _pieces(_ends(pivot[rows]), SLICE_ROWS):
            whole = rows[lo:hi]
            outer = levels(whole, [c for c, _ in r.clocks if c not in inner])
            by_cut = np.argsort(clocks[cut][whole], kind="stable") if cut else np.arange(len(whole))
            ends = _ends(clocks[cut][whole][by_cut]) if cut else np.array([len(whole)])
            for a, b in _pieces(ends, SLICE_ROWS):
                piece = by_cut[a:b]
                found = {c: (group[piece], stats) for c, (group, stats) in outer.items()} | levels(whole[piece], inner)
                for at in range(0, len(piece), BATCH_ROWS):
                    some = slice(at, at + BATCH_ROWS)
                    columns = [x.combine_chunks() for x in kept.take(pa.array(whole[piece[some]])).columns]
                    for c, _ in r.clocks:
                        group = found[c][0][some]
                        for kind, i, _ in outputs[c]:
                            values, known = found[c][1][kind, i]
                            columns.append(pa.array(values[group], mask=None if known is None else ~known[group]))
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _attach_beside(rows: DataFrame, r: Rollup) -> DataFrame:
    """``rows`` with the statistics of ``r``, a pivot's rows in one task."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    helpers = [F.col(c).cast("double").alias(f"_d{i}") for i, c in enumerate(r.dense)]
    helpers += [F.col(c).cast("string").alias(f"_s{i}") for i, c in enumerate(r.distinct)]
    fields = [StructField(name, LongType() if kind in ("count", "nunique") else DoubleType())
              for c, _ in r.clocks for kind, _, name in _level_outputs(r, c)]
    return (rows.repartition(n, r.pivot).select("*", *helpers)
            .mapInArrow(_beside_rows(r, rows.columns), StructType([*rows.schema.fields, *fields])))


def _attach_joined(rows: DataFrame, source: DataFrame, r: Rollup) -> DataFrame:
    """``rows`` joined with the statistics of ``r`` over ``source``."""
    keyed = rows.select("*", *_key(rows, r.pivot, "_p"), *_key(rows, r.base, f"_{r.base}"))
    levels = [f"_level_{i}.*" for i in range(len(r.clocks))]
    return keyed.join(rollup_tables(source, r), _keys(r.base), "left").select(*rows.columns, *levels).drop("_none")


def attach_rollups(df: DataFrame, rollups: Sequence[Rollup], max_rows: int = PARTITION_ROWS) -> DataFrame:
    """``df`` with the statistics of every rollup: the needed columns are
    written once.  A rollup costs one shuffle of ``df`` by its pivot; the rows of
    pivot values with more than ``max_rows`` rows, and rollups that only count,
    are joined with merged states."""
    needed = list(dict.fromkeys(c for r in rollups for c in (r.pivot, *r.named_clocks, *r.order, *r.dense, *r.distinct)))
    source = _stored(df.select(*needed), "source") if set(needed) != set(df.columns) else None
    rows = df if source is not None else (source := _stored(df, "source"))
    for r in rollups:
        if not (r.dense or r.distinct):
            rows = _attach_joined(rows, source, r)
            continue
        large = _stored(source.groupBy(F.col(r.pivot).alias("_large")).agg(F.count(F.lit(1)).alias("_n"))
                        .where(F.col("_n") > max_rows).select("_large"), "large")
        if large.isEmpty():
            rows = _attach_beside(rows, r)
            continue
        large = F.broadcast(large)  # one value per max_rows rows at most

        def of(side: DataFrame, how: str, r=r, large=large) -> DataFrame:
            return side.join(large, F.col(r.pivot).eqNullSafe(F.col("_large")), how)

        beside = _attach_beside(of(rows, "left_anti"), r)
        rows = beside.union(_attach_joined(of(rows, "left_semi"), of(source, "left_semi"), r).select(*beside.columns))
    return rows
