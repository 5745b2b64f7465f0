"""Weighted selection, boundary exchange, as-of merge, rollups and ordered
blocks against plain forms and brute force, on skewed data."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from pyspark.sql import functions as F

from rankfold.operators import asof
from rankfold.operators import boundary as B
from rankfold.operators import encode as E
from rankfold.operators import features as FT
from rankfold.operators import index as I
from rankfold.operators import ordered as O
from rankfold.operators.rollup import Rollup, attach_rollups, rollup_names
from rankfold.operators.selection import group_medians, median_positions, runs_of, weighted_select
from rankfold.operators.sequence import positions
from rankfold.sources import blocks

T0 = datetime(2024, 1, 1)


def skewed(spark, n=900, seed=1):
    """Rows (k, v, t, id): key 'hot' and value 7.0 hold about a third each."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.35 else rnd.choice([None, "a", "b", "c", "d"])
        v = 7.0 if rnd.random() < 0.35 else rnd.choice([None, rnd.randint(0, 40) / 4])
        rows.append((k, v, T0 + timedelta(seconds=rnd.randint(0, 400), microseconds=rnd.choice([0, 250_000])), i))
    return rows, spark.createDataFrame(rows, "k string, v double, t timestamp_ntz, id long").repartition(5)


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_medians_by_weighted_selection(spark, parts):
    rows, df = skewed(spark)
    runs = runs_of(df, ["k"], "v")
    assert runs.where("v = 7.0 and k = 'hot'").count() == 1  # equal values are one run
    got = {r["k"]: r["m"] for r in group_medians(runs, ["k"], "v", "weight", "m", parts).collect()}
    want = {k: float(np.median([v for q, v, _, _ in rows if q == k and v is not None])) for k in {r[0] for r in rows}}
    assert got == want


def test_selection_takes_any_positions(spark):
    rows, df = skewed(spark, 200)
    values = sorted(r[1] for r in rows if r[1] is not None)
    picks = weighted_select(runs_of(df.where("v is not null"), [], "v"), [], "v", "weight",
                            lambda total: np.stack([total * 0, total - 1, total // 3, total], axis=1), 7).collect()
    assert {r["place"]: r["v"] for r in picks} == {0: values[0], 1: values[-1], 2: values[len(values) // 3]}
    assert {r["total"] for r in picks} == {len(values)}
    assert weighted_select(runs_of(df.where("false"), ["k"], "v"), ["k"], "v", "weight", median_positions).collect() == []


def test_quantiles_equal_numpy(spark):
    rows, df = skewed(spark)
    levels = [0.0, 0.05, 0.25, 0.5, 0.9, 0.99, 1.0]
    want = np.quantile([r[1] for r in rows if r[1] is not None], levels)
    assert np.allclose(E.exact_quantiles(df, "v", levels), want, atol=0, rtol=1e-15)
    assert np.isnan(E.exact_quantiles(df.where("false"), "v", [0.5])).all()


@pytest.mark.parametrize("valid,test", [(0.1, 0.2), (13, 7), (0, 0.25), (0, 0), (899, 0), (2000, 5)])
def test_split_sizes_and_order(spark, valid, test):
    rows, df = skewed(spark)
    out = I.split_sequential(df, ["t", "id"], valid, test, 5).collect()
    n = len(rows)
    n_test = int(test * n) if 0 < test < 1 else test
    n_valid = min(int(valid * n) if 0 < valid < 1 else valid, n - n_test)
    want = ["train"] * (n - n_valid - n_test) + ["valid"] * n_valid + ["test"] * n_test
    got = [r["split"] for r in sorted(out, key=lambda r: (r["t"], r["id"]))]
    assert got == want


def test_split_keeps_null_order_keys_first(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3), (4, 4)], "a int, id int")
    assert {r["id"]: r["split"] for r in I.split_sequential(df, ["a", "id"], 1, 1).collect()} == {
        1: "train", 2: "train", 3: "valid", 4: "test"}


@pytest.mark.parametrize("parts", [1, 4, 300])
def test_exchanged_gaps_equal_the_window(spark, parts):
    _, df = skewed(spark, 250)
    offsets = {1: ("b1", "a1"), 2: ("b2", "a2")}
    got = B.gaps(df, ["k"], "t", ["id"], offsets, parts)
    want = O.lag_lead_gaps(df, ["k"], "t", ["id"], offsets, strategy="window")
    cols = ["id", "b1", "a1", "b2", "a2"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


@pytest.mark.parametrize("parts,keys", [(1, []), (4, []), (300, []), (6, ["k"])])
def test_exchanged_rolling_means(spark, parts, keys):
    rows, df = skewed(spark, 250)
    got = {r["id"]: tuple(r[f"v_mean{w}"] for w in (2, 3, 7)) for r in
           B.rolling(df, ["v"], (2, 3, 7), ["t", "id"], keys, num_partitions=parts).collect()}
    want, before = {}, {}
    for k, v, t, i in sorted(rows, key=lambda r: (r[2], r[3])):
        seen = before.setdefault(k if keys else 0, [])
        seen.append(v)
        want[i] = tuple(sum(seen[-w:]) / w if len(seen) >= w and None not in seen[-w:] else None for w in (2, 3, 7))
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i], abs=1e-12) if None not in want[i] else [a is None for a in got[i]] == [
            b is None for b in want[i]]


def test_order_features_shuffle_once_and_join_nothing(spark):
    _, df = skewed(spark, 50)
    plan = B.rolling(df, ["v"], (3,), ["t", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Window" not in plan  # the sorted rows are read as they lie


@pytest.mark.parametrize("parts", [1, 5, 200])
def test_running_sums_and_positions(spark, parts):
    rows, df = skewed(spark, 300)
    got = B.running_sums(df, ["k"], [F.desc("t"), "id"], {"s": "v", "c": F.lit(1)}, {"s": "all_s", "c": "all_c"}, parts).collect()
    by_key = {}
    for k, v, t, i in sorted(rows, key=lambda r: (-r[2].timestamp(), r[3])):
        by_key.setdefault(k, []).append((i, v or 0.0))
    want = {}
    for k, vs in by_key.items():
        for n, (i, _) in enumerate(vs):
            want[i] = (sum(v for _, v in vs[:n + 1]), n + 1, sum(v for _, v in vs), len(vs))
    assert {r["id"]: (r["s"], r["c"], r["all_s"], r["all_c"]) for r in got} == want
    a = positions(df, ["k"], ["t", "id"], "p").select("id", "p", "seq_n").collect()
    b = positions(df, ["k"], ["t", "id"], "p", strategy="window").select("id", "p", "seq_n").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def clocked(df):
    sec = F.unix_timestamp(F.col("t").cast("timestamp"))
    return df.select("*", sec.alias("total_seconds"), (sec / 60).cast("int").alias("day_minute"),
                     (sec / 3600).cast("int").alias("day_hour"), F.dayofyear("t").alias("dayofyear"))


def test_rollup_equals_the_plain_aggregates(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(500):
        t = None if i % 97 == 0 else T0 + timedelta(seconds=rnd.choice([0, 1, 2, 61, 62, 3700, 90_000, 90_001]) + 86_400 * rnd.choice([0, 0, 1]))
        rows.append((rnd.choice([None, "hot", "hot", "a", "b"]), t, i, 1e9 + rnd.randint(0, 3), rnd.choice([None, 0.25, 1.0]), 5.0,
                     rnd.choice([None, "x", "y"])))
    df = clocked(spark.createDataFrame(rows, "u string, t timestamp_ntz, id long, far double, v double, same double, c string").repartition(4))
    dense, distinct = ["far", "v", "same"], ["c", "u"]
    r = Rollup("u", dense, distinct, ["t", "id"], count_names={None: "n_u", "day_hour": "n_hour"})
    got = attach_rollups(df, [r]).toPandas().set_index("id").sort_index()
    sets = []
    for clock in [None, "dayofyear", "day_hour", "day_minute", "total_seconds"]:
        keys, spec = FT.pivot_spec("u", distinct, dense, clock=clock)
        sets.append((keys, spec))
    sets += [(["u"], [("count", None, "n_u")]), (["day_hour", "u"], [("count", None, "n_hour")])]
    want = FT.attach_stats(df, sets, order=["t", "id"]).toPandas().set_index("id").sort_index()
    names = [n for _, _, n in rollup_names(r)]
    assert len(names) == 5 * (2 + 9 * 3) + 2 and len(got) == 500
    for name in names:
        a, b = got[name].astype(float), want[name].astype(float)
        assert (a.isna() == b.isna()).all(), name
        assert np.allclose(a.fillna(0), b.fillna(0), rtol=1e-9, atol=1e-6), name


@pytest.mark.parametrize("size", [1, 40, 16_384])
def test_large_pivots_are_joined_and_the_others_stay_beside_their_rows(spark, monkeypatch, size):
    """Same statistics, whatever share of the rows takes which way and however a pivot is cut."""
    from rankfold.operators import rollup
    monkeypatch.setattr(rollup, "SLICE_ROWS", size)
    monkeypatch.setattr(rollup, "BATCH_ROWS", max(7, size // 2))
    rnd = random.Random(9)
    rows = [(rnd.choice([None, "hot", "hot", "a", "b"]), None if i % 31 == 0 else T0 + timedelta(seconds=rnd.choice([0, 1, 61, 3700, 90_000])),
             i, rnd.choice([None, 0.25, 1.0, 3.5]), rnd.choice([None, "x", "y"])) for i in range(160)]
    df = clocked(spark.createDataFrame(rows + rows[:30], "u string, t timestamp_ntz, id long, v double, c string"))
    r = Rollup("u", ["v"], ["c"], ["t", "id"], count_names={None: "n_u", "day_hour": "n_hour"})
    made = [attach_rollups(df, [r], max_rows=m) for m in (10_000, 60, 1)]  # none, some and all by join
    assert made[0].columns == made[1].columns == made[2].columns
    assert "Join" not in made[0]._jdf.queryExecution().optimizedPlan().toString()
    beside, mixed, joined = (x.toPandas().sort_values("id").reset_index(drop=True) for x in made)
    assert len(beside) == len(mixed) == len(joined) == 190
    for name in [n for _, _, n in rollup_names(r)]:
        for other in (mixed, joined):
            assert (beside[name].isna() == other[name].isna()).all(), name
            assert np.allclose(beside[name].fillna(0).astype(float), other[name].fillna(0).astype(float), rtol=1e-9, atol=1e-7), name


def test_rollup_joins_the_rows_once(spark):
    _, df = skewed(spark, 60)
    r = Rollup("k", ["v"], ["k"], ["t", "id"])
    plan = attach_rollups(clocked(df), [r])._jdf.queryExecution().optimizedPlan().toString()
    rows = [line for line in plan.splitlines() if "Relation" in line and "total_seconds" in line and "id#" in line]
    assert len(rows) == 1  # the frame is read once, beside tables of states


@pytest.mark.parametrize("parts", [1, 4, 150])
def test_asof_merge_equals_brute_force(spark, parts):
    rnd = random.Random(6)
    user = lambda: rnd.choice(["hot", "hot", "a", "b", None])
    ev = [(user(), T0 + timedelta(seconds=rnd.randint(0, 40)), i, rnd.randint(1, 9)) for i in range(160)]
    sm = [(user() if i % 7 else "new", T0 + timedelta(seconds=rnd.randint(0, 40)), i) for i in range(90)]
    events = spark.createDataFrame(ev, "u string, t timestamp_ntz, id long, item long").repartition(3)
    samples = spark.createDataFrame(sm, "u string, t timestamp_ntz, sid long").repartition(3)
    placed, found = asof.asof_merge(events, samples, "u", "t", "item", ["id"], 4, parts)
    ordered = sorted(ev, key=lambda r: (r[1], r[2]))
    want = {}
    for u, t, s in sm:
        before = [r[3] for r in ordered if r[0] == u and r[1] < t]
        want[s] = (len(before), before[-4:])
    assert {r["sid"]: (r["seq_len"], r["last_items"]) for r in found.collect()} == want
    place = {}
    for u in {r[0] for r in ev}:
        place.update({r[2]: i for i, r in enumerate(x for x in ordered if x[0] == u)})
    assert {r["id"]: r["seq_pos"] for r in placed.collect()} == place
    assert set(found.columns) == {"u", "t", "sid", "seq_len", "last_items"}


def test_asof_maps_items_and_drops_unknown_ones(spark):
    events = spark.createDataFrame([("a", 1, 10), ("b", 2, None), ("c", 3, 30)], "item string, n int, x int")
    ids = spark.createDataFrame([("a", 5), ("b", 6)], "item string, id int")
    assert sorted(map(tuple, asof.map_ids(events, "item", ids).collect()), key=str) == [(5, 1, 10), (6, 2, None)]


def test_ordered_blocks(spark, tmp_path):
    _, df = skewed(spark, 103)
    path = str(tmp_path / "blocks")
    blocks.write_ordered_blocks(df, path, ["t", "id"], 25)
    got = sorted(map(tuple, blocks.block_manifest(spark, path).collect()))
    assert got == [(b, 25 * b, min(25 * b + 25, 103), min(25, 103 - 25 * b), 1) for b in range(5)]
    part = blocks.read_block_range(spark, path, 1, 3)
    assert part.count() == 50 and len({r["f"] for r in part.select(F.col("_metadata.file_path").alias("f")).distinct().collect()}) == 2
    ids = [r["id"] for r in spark.read.parquet(path).orderBy("row_index").collect()]
    assert ids == [r["id"] for r in df.orderBy("t", "id").collect()]
    with pytest.raises(ValueError):
        blocks.write_ordered_blocks(df, path, ["id"], 0)


def test_window_and_exchange_of_the_catalog_agree_on_empty_input(spark):
    _, df = skewed(spark, 10)
    none = df.where("false")
    assert B.gaps(none, ["k"], "t", ["id"], {1: ("b", "a")}).collect() == []
    assert B.rolling(none, ["v"], (3,), ["t", "id"]).collect() == []
    assert positions(none, ["k"], ["t", "id"]).collect() == []
    assert attach_rollups(clocked(none), [Rollup("k", ["v"], ["k"], ["t", "id"])]).collect() == []
    assert asof.asof_merge(none.withColumn("item", F.lit(1)), none, "k", "t", "item", ["id"], 2)[1].collect() == []
