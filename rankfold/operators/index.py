"""Row identity without a single-partition sort.

``global_index`` is the distributed prefix: range-partition by the full sort
key (hot keys are split across partitions because the sort key includes the
tie-breakers), sort inside partitions, number rows locally, write a reliable
checkpoint so partition ids and local positions are fixed, then add each
partition's offset.  Only one count per partition reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankfold.functions.scalar import epoch_micros, stable_hash
from rankfold.operators.selection import weighted_select
from rankfold.session import ensure_checkpoint_dir

_LOCAL_BITS = 33  # monotonically_increasing_id = partition id << 33 | position


def _num_partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_index(df: DataFrame, order: list[str | Column], out: str = "idx", start: int = 0,
                 num_partitions: int | None = None) -> DataFrame:
    """Dense 0/1-based row index in ``order`` (which should be a total order)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _num_partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = ranged.checkpoint(eager=True)
    ranged = ranged.select("*", F.shiftright("_mid", _LOCAL_BITS).alias("_pid"),
                           F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_loc"))
    counts = sorted((r["_pid"], r["n"]) for r in
                    ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, acc = [], 0
    for pid, cnt in counts:
        offsets.append((pid, acc))
        acc += cnt
    off = spark.createDataFrame(offsets or [(0, 0)], "_pid long, _off long")
    # at most one row per partition: a broadcast of proven size
    j = ranged.join(F.broadcast(off), "_pid")
    return j.withColumn(out, F.col("_off") + F.col("_loc") + F.lit(start)).drop("_mid", "_pid", "_loc", "_off")


def dense_ids(df: DataFrame, key: str, out: str, start: int = 1,
              num_partitions: int | None = None) -> DataFrame:
    """(key, id) table: sorted distinct non-null keys numbered start...
    Sorting by the id value makes the mapping reproducible across runs."""
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    return global_index(keys, [key], out, start, num_partitions)


def dedupe_by_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Keep, per key, the row that is first in ``order``.

    ``dropDuplicates`` keeps an arbitrary row; ``min_by`` over a struct is
    deterministic and is a partial/final aggregate, so a hot key is combined
    map-side before the shuffle.
    """
    others = [c for c in df.columns if c not in key]
    ordered = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*others), ordered).alias("_row"))
    return picked.select(*key, *[F.col("_row")[c].alias(c) for c in others])


def _bound(order: Column, bound, types: list) -> Column:
    """``order`` (a struct) is at or after the row ``bound``; nulls are first."""
    cells = [F.lit(v).cast(t) for v, t in zip(bound, types)]
    return order >= F.struct(*[c.alias(f"_{i}") for i, c in enumerate(cells)])


def split_sequential(df: DataFrame, order: list[str], valid_size: float | int = 0,
                     test_size: float | int = 0, num_partitions: int | None = None) -> DataFrame:
    """Tail of the ordering (a total order) goes to valid then test (D1); adds
    ``split``.  Fractions (< 1) are of the row count; integers are row counts.

    The two rows at which valid and test begin are selected from the order
    columns alone; every row is then compared with them where it is."""
    kinds = df.select(*order).schema
    plain = []  # order columns whose values a literal can name: instants as microseconds
    for i, f in enumerate(kinds):
        kind = f.dataType.simpleString()
        c = F.unix_micros(f.name) if kind == "timestamp" else epoch_micros(f.name) if kind == "timestamp_ntz" else F.col(f.name)
        plain.append(c.alias(f"_{i}"))
    key = F.struct(*plain)

    def starts(total: np.ndarray) -> np.ndarray:
        test = (test_size * total).astype(np.int64) if 0 < test_size < 1 else np.full(len(total), int(test_size))
        valid = (valid_size * total).astype(np.int64) if 0 < valid_size < 1 else np.full(len(total), int(valid_size))
        return np.stack([np.where(valid > 0, np.maximum(total - valid - test, 0), -1), np.where(test > 0, np.maximum(total - test, 0), -1)], axis=1)

    found = weighted_select(df.select(key.alias("_o"), F.lit(1).alias("_w")), [], "_o", "_w", starts, num_partitions)
    at = {r["place"]: r["_o"] for r in found.collect()}  # two rows
    types = [f.dataType for f in df.select(key.alias("_o")).schema["_o"].dataType]
    split = F.lit("train")
    if 0 in at:
        split = F.when(_bound(key, at[0], types), "valid").otherwise(split)
    if 1 in at:
        split = F.when(_bound(key, at[1], types), "test").otherwise(split)
    return df.withColumn("split", split)


def split_random(df: DataFrame, key: list[str], valid_size: float = 0.1, test_size: float = 0.1,
                 seed: int = 2023, num_partitions: int | None = None) -> DataFrame:
    """Random split with exact sizes: order by a seeded hash of the key."""
    tmp = df.withColumn("_h", stable_hash(key, seed))
    return split_sequential(tmp, ["_h", *key], valid_size, test_size, num_partitions).drop("_h")


def shuffle_rows(df: DataFrame, key: list[str], seed: int = 2023) -> DataFrame:
    """Reproducible random row order (O9): sort by a seeded hash of the key."""
    return df.orderBy(stable_hash(key, seed), *key)


def shuffled_places(df: DataFrame, key: list[str], out: str, seed: int = 2023) -> DataFrame:
    """``df`` with each row's 0-based place in the order of ``shuffle_rows``."""
    return global_index(df.withColumn("_h", stable_hash(key, seed)), ["_h", *key], out).drop("_h")


def segmented_prefix_sum(df: DataFrame, keys: list[str], order: list[str | Column],
                         values: list[str], suffix: str = "_cum",
                         num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``values`` inside each key, in ``order``.

    Skew-safe: rows are range-partitioned on ``(keys, order)`` so one key may
    span many partitions; sums run per (partition, key) and each partition's
    first key receives the total of its earlier segments.  The boundary table
    holds one row per partition — the only data that reaches the driver.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = _num_partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *keys, *order)
              .withColumn("_pid", F.spark_partition_id().cast("long")))
    ranged = ranged.checkpoint(eager=True)
    w = (Window.partitionBy("_pid", *keys).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumns({v + suffix: F.sum(v).over(w) for v in values})
    seg = ranged.groupBy("_pid", *keys).agg(*[F.sum(v).alias(v) for v in values])
    if keys:
        kstruct = F.struct(*[F.col(k) for k in keys])
        bounds = seg.groupBy("_pid").agg(F.min(kstruct).alias("first"), F.max(kstruct).alias("last"),
                                         F.count(F.lit(1)).alias("nseg"))
        # totals of each partition's last key: one row per partition
        last_tot = (seg.join(F.broadcast(bounds.select("_pid", "last")), "_pid")
                    .where(F.struct(*[F.col(k) for k in keys]).eqNullSafe(F.col("last")))
                    .select("_pid", *values))
        b = {r["_pid"]: r for r in bounds.collect()}
        lt = {r["_pid"]: r for r in last_tot.collect()}
        rows, carry_key, carry = [], None, None
        for pid in sorted(b):
            first, last = tuple(b[pid]["first"]), tuple(b[pid]["last"])
            off = carry if (carry is not None and carry_key == first) else None
            if off is not None:
                rows.append((pid, *first, *[float(x) for x in off]))
            tot = [lt[pid][v] or 0 for v in values] if pid in lt else [0] * len(values)
            if first == last and off is not None:
                carry = [a + t for a, t in zip(off, tot)]
            else:
                carry = tot
            carry_key = last
        schema = ", ".join(["_pid long"] + [f"{k} {dict(df.dtypes)[k]}" for k in keys]
                           + [f"_off_{v} double" for v in values])
        offs = spark.createDataFrame(rows, schema) if rows else None
        if offs is None:
            return local.drop("_pid")
        cond = [local["_pid"] == offs["_pid"]] + [local[k].eqNullSafe(offs[k]) for k in keys]
        j = local.join(F.broadcast(offs), cond, "left").select(
            local["*"], *[offs[f"_off_{v}"] for v in values])
    else:
        tot = {r["_pid"]: r for r in seg.collect()}
        rows, acc = [], [0.0] * len(values)
        for pid in sorted(tot):
            rows.append((pid, *[float(x) for x in acc]))
            acc = [a + (tot[pid][v] or 0) for a, v in zip(acc, values)]
        offs = spark.createDataFrame(rows or [(0, *([0.0] * len(values)))],
                                     ", ".join(["_pid long"] + [f"_off_{v} double" for v in values]))
        j = local.join(F.broadcast(offs), "_pid", "left")
    out = j.withColumns({v + suffix: F.col(v + suffix) + F.coalesce(F.col(f"_off_{v}"), F.lit(0.0))
                         for v in values})
    return out.drop("_pid", *[f"_off_{v}" for v in values])
