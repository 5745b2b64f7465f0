"""Hand-made edge cases and invariants (nulls, ties, one-row and one-class
groups, empty lists, unseen tokens, skew-safe forms equal the plain forms)."""

from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankfold.functions import lists as L
from rankfold.functions import scalar as S
from rankfold.operators import encode as E
from rankfold.operators import explode as X
from rankfold.operators import features as FT
from rankfold.operators import index as I
from rankfold.operators import metrics as M
from rankfold.operators import ordered as O
from rankfold.operators import ranking as R
from rankfold.operators import vectors as V


def test_explode_keeps_empty_and_null_lists(spark):
    df = spark.createDataFrame([(1, [10, 20], [20]), (2, [], []), (3, None, None)],
                               "impression_id long, article_ids_inview array<long>, article_ids_clicked array<long>")
    out = X.label_candidates(X.explode_candidates(df)).orderBy("impression_id", "pos").collect()
    assert [(r.impression_id, r.pos, r.article_id, r.label) for r in out] == [
        (1, 0, 10, 0), (1, 1, 20, 1), (2, None, None, 0), (3, None, None, 0)]


def test_parallel_explode_rejects_unequal_lists(spark):
    df = spark.createDataFrame([(1, [1, 2], [0.5])], "u long, a array<long>, b array<double>")
    with pytest.raises(Exception):
        X.explode_parallel(df, ["a", "b"]).collect()
    ok = spark.createDataFrame([(1, [1, 2], [0.5, 0.7])], "u long, a array<long>, b array<double>")
    assert X.explode_parallel(ok, ["a", "b"]).count() == 2


def test_membership_with_null_element(spark):
    df = spark.createDataFrame([(2, [1, None])], "i long, l array<long>")
    assert df.select(X.is_in_list("i", "l").alias("x")).first().x is False


def test_time_features_and_durations(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 7, 17, 59, 30), datetime(2024, 1, 8, 18, 0, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(*[v.alias(k) for k, v in S.time_feature_columns("a").items()],
                  S.duration_seconds("a", "b").alias("neg"), S.duration_days("b", "a").alias("d")).first()
    assert r.dayofweek == 7 and r.day_hour == 7 * 24 + 17 and r.is_day == 1 and r["6hour"] == 2
    assert r.neg == -(24 * 3600 + 30) and r.d == 1


def test_age_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in [None, 0.0, 1.0, 10.0, 10.5, 95.0, 96.0]], "a double")
    assert [r.b for r in df.select(S.age_bucket("a").alias("b")).collect()] == ["", "", "1", "1", "2", "7", ""]


def test_ratio_zero_denominator_is_null(spark):
    r = spark.createDataFrame([(5.0, 0)], "n double, d int").select(S.safe_ratio("n", "d").alias("x")).first()
    assert r.x is None


def test_pad_sequence_variants(spark):
    df = spark.createDataFrame([([1, 2, 3],), (None,)], "a array<long>")
    rows = df.select(L.pad_sequence("a", 5, 0, "post").alias("post"), L.pad_sequence("a", 5, 0, "pre").alias("pre"),
                     L.pad_sequence("a", 2, 0, "pre", "pre").alias("cut")).collect()
    assert rows[0].post == [1, 2, 3, 0, 0] and rows[0].pre == [0, 0, 1, 2, 3] and rows[0].cut == [2, 3]
    assert rows[1].post == [0, 0, 0, 0, 0]


def test_list_stats(spark):
    df = spark.createDataFrame([([3.0, None, 1.0, 2.0, 10.0],), ([],)], "a array<double>")
    r = df.select(L.list_mean("a").alias("m"), L.list_median("a").alias("md"),
                  L.list_diff("a").alias("d")).collect()
    assert r[0].m == 4.0 and r[0].md == 2.5 and r[1].m is None and r[1].md is None and r[1].d == []


def test_kmax_keeps_original_order(spark):
    df = spark.createDataFrame([([1.0, 5.0, 3.0, 5.0, 2.0],)], "a array<double>")
    assert df.select(L.kmax_in_order("a", 3).alias("k")).first().k == [5.0, 3.0, 5.0]


def test_rank_ties_keep_candidate_order(spark):
    df = spark.createDataFrame([(1, 1, 0, 0.5), (1, 1, 1, 0.9), (1, 1, 2, 0.5)],
                               "impression_id long, user_id long, pos long, score double")
    assert R.rank_lists(df).first()["rank"] == "[2,1,3]"


def test_blend_single_table_is_identity_and_norm_constant_group(spark):
    key = ["impression_id", "user_id", "article_id", "pos"]
    t = spark.createDataFrame([(1, 1, 7, 0, 2.0), (1, 1, 8, 1, 2.0), (2, 1, 7, 0, 5.0), (2, 1, 9, 1, 9.0)],
                              "impression_id long, user_id long, article_id long, pos long, score double")
    same = R.blend_scores([t], [1.0], key=key).orderBy("impression_id", "pos").collect()
    assert [r.score for r in same] == [2.0, 2.0, 5.0, 9.0]
    normed = R.blend_scores([t], [1.0], key=key, norm=True).orderBy("impression_id", "pos").collect()
    assert [r.score for r in normed] == [None, None, 0.0, 1.0]


def test_nunique_counts_null_and_stats_of_single_rows(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, 5, 1.0), (1, 5, 1.0), (2, 3, 4.0)], "k long, c long, x double")
    st = FT.group_stats(df, ["k"], [("nunique", "c", "nu"), ("std", "x", "sd"), ("skew", "x", "sk")])
    got = {r.k: (r.nu, r.sd, r.sk) for r in st.collect()}
    assert got[1] == (2, 0.0, None) and got[2] == (1, None, None)


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "k long, x double")
    out = FT.attach_stats(df, [(["k"], [("mean", "x", "m")])]).collect()
    assert sorted((r.k, r.m) for r in out if r.k is None) == [(None, 2.0), (None, 2.0)]
    win = FT.attach_stats(df, [(["k"], [("mean", "x", "m")])], form="window").collect()
    assert sorted(r.m for r in win) == sorted(r.m for r in out)


def test_window_form_equals_aggregate_form(spark):
    from rankfold.plans.catalog_features import ev_base
    from conftest import SF_SMALL
    df = ev_base(spark, SF_SMALL)
    sets = [FT.pivot_spec("user_id", ["article_id"], ["read_time"], ("min", "median", "first", "skew"),
                          clock="dayofyear")]
    cols = [n for _, sp in sets for _, _, n in sp]
    # moments accumulate in a different order in the two forms: compare at 1e-9
    rounded = [F.round(c, 9).alias(c) for c in cols]
    a = FT.attach_stats(df, sets, order=["impression_time", "event_id"]).select("event_id", *rounded)
    w = FT.attach_stats(df, sets, order=["impression_time", "event_id"], form="window").select("event_id", *rounded)
    assert a.exceptAll(w).count() == 0 and w.exceptAll(a).count() == 0


def test_chunked_lag_and_rolling_equal_plain_windows(spark):
    rows = [(i, i % 3 if i % 7 else 0, datetime(2024, 1, 1 + i % 20, i % 24), float(i % 11) if i % 13 else None)
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz, x double")
    a = O.lag_lead_gaps(df, ["k"], "t", ["id"], {1: ("b1", "a1"), 2: ("b2", "a2")}, strategy="chunked",
                        chunk_rows=17)
    b = O.lag_lead_gaps(df, ["k"], "t", ["id"], {1: ("b1", "a1"), 2: ("b2", "a2")}, strategy="window")
    assert a.exceptAll(b).count() == 0 and a.count() == 400
    r1 = O.rolling_means(df, ["x"], [3, 5], [], ["t", "id"], chunk_rows=13)
    w = Window.orderBy("t", "id")
    naive = df.withColumns({f"x_mean{n}": F.when(F.count("x").over(w.rowsBetween(-(n - 1), 0)) == n,
                                                  F.avg("x").over(w.rowsBetween(-(n - 1), 0))) for n in (3, 5)})
    assert r1.exceptAll(naive).count() == 0


def test_global_index_dense_and_ordered(spark):
    df = spark.range(0, 1000).select(((F.col("id") * 7919) % 1000).alias("v"))
    idx = I.global_index(df, ["v"], "i", 1, num_partitions=7).orderBy("i").collect()
    assert [r.i for r in idx] == list(range(1, 1001))
    assert [r.v for r in idx] == sorted(r.v for r in idx)


def test_segmented_prefix_sum_with_a_hot_key(spark):
    rows = [(0 if i < 700 else i % 5 + 1, i, 1.0) for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, o long, v double")
    got = I.segmented_prefix_sum(df, ["k"], ["o"], ["v"], num_partitions=9)
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("v_cum", F.sum("v").over(w))
    assert got.select("k", "o", "v", "v_cum").exceptAll(exp).count() == 0


def test_auc_conventions_and_symmetry(spark):
    rows = [(1, 1, 0.9), (1, 0, 0.9), (1, 0, 0.1), (2, 1, 0.4), (2, 1, 0.6), (3, 0, 0.2), (3, 1, 0.3)]
    df = spark.createDataFrame(rows, "g long, label long, score double")
    g = {r.g: r.auc for r in M.group_auc(df, ["g"]).collect()}
    assert g[1] == 0.75 and g[2] is None and g[3] == 1.0
    assert M.avg_auc(df, ["g"]).first()[0] == pytest.approx(0.875)
    assert M.impression_auc(df, ["g"]).first()[0] == pytest.approx((0.75 + 1.0 + 1.0) / 3)
    a = M.auc(df).first()[0]
    neg = M.auc(df.withColumn("score", -F.col("score"))).first()[0]
    assert a + neg == pytest.approx(1.0)
    skew_safe = M.group_auc(df, ["g"], strategy="chunked").collect()
    assert {r.g: r.auc for r in skew_safe} == g


def test_vocab_rules(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 5), ("", 9), ("c", 1)], "token string, count long")
    v = E.frequency_vocab(counts, min_count=2, max_features=3, na_value="").orderBy("id").collect()
    assert [(r.token, r.id) for r in v] == [("a", 1), ("b", 2)]
    shared = spark.createDataFrame([("x", 1), ("y", 2)], "token string, id long")
    one_new = spark.createDataFrame([("y", 1), ("z", 2)], "token string, id long")
    merged, oov = E.merge_vocab(shared, 3, one_new)
    assert oov == 3 and {r.token: r.id for r in merged.collect()}["z"] == 3   # shares OOV id (reference rule)
    two_new = spark.createDataFrame([("z", 1), ("w", 2)], "token string, id long")
    merged2, oov2 = E.merge_vocab(shared, 3, two_new)
    assert oov2 == 5 and sorted(r.id for r in merged2.collect()) == [1, 2, 3, 4]


def test_encode_unseen_and_null(spark):
    v = spark.createDataFrame([("a", 1), ("b", 2)], "token string, id long")
    df = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    out = [r.c for r in E.encode_column(df, "c", v, default=3).collect()]
    assert sorted(out) == [1, 3, 3]


def test_quantile_boundaries_match_numpy(spark):
    import numpy as np
    vals = [float(x) for x in np.random.default_rng(1).normal(size=301)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = E.quantile_boundaries(df, "x", 4)
    assert got == pytest.approx(list(np.percentile(vals, [25, 50, 75])))


def test_topk_per_group_salted_equals_plain(spark):
    rows = [(0 if i < 500 else i % 4, i, float((i * 37) % 101)) for i in range(800)]
    df = spark.createDataFrame(rows, "g long, item long, s double")
    order = [F.col("s").desc(), F.col("item").asc()]
    salted = V.topk_per_group(df, ["g"], order, 5)
    w = Window.partitionBy("g").orderBy(*order)
    plain = df.withColumn("rank", F.row_number().over(w)).where("rank <= 5")
    assert salted.exceptAll(plain).count() == 0 and salted.count() == plain.count()


def test_positions_chunked_equals_window(spark):
    from rankfold.operators.sequence import positions
    rows = [(i % 3 if i < 300 else 9, i) for i in range(500)]
    df = spark.createDataFrame(rows, "u long, t long")
    a = positions(df, ["u"], ["t"], strategy="chunked")
    b = positions(df, ["u"], ["t"], strategy="window")
    assert a.select("u", "t", "seq_pos", "seq_n").exceptAll(b.select("u", "t", "seq_pos", "seq_n")).count() == 0


def test_distributed_median_equals_aggregate(spark):
    rows = [(0 if i < 300 else i % 4 + 1, float((i * 31) % 17) if i % 9 else None) for i in range(420)]
    df = spark.createDataFrame(rows, "k long, x double")
    spec = [("median", "x", "med"), ("mean", "x", "m")]
    a = FT.group_stats(df, ["k"], spec, median_strategy="chunked")
    b = FT.group_stats(df, ["k"], spec, median_strategy="window")
    assert sorted(a.collect()) == sorted(b.collect())


def test_feature_specs_layout_and_vocab_by_size(spark):
    from rankfold.operators import featuremap as FM
    specs = FM.expand_specs([{"name": ["a", "b"], "type": "categorical", "source": "user"},
                             {"name": "seq", "type": "sequence", "source": "item", "max_len": 5},
                             {"name": "off", "type": "numeric", "active": False}])
    assert [s["name"] for s in specs] == ["a", "b", "seq"]
    lay = FM.layout(specs)
    assert lay["offsets"] == {"a": 0, "b": 1, "seq": 2} and lay["total_features"] == 7
    v = E.vocab_from_size(spark, 4).orderBy("id").collect()
    assert [(r.token, r.id) for r in v] == [("0", 0), ("1", 1), ("2", 2)]
    fmap = FM.feature_map(spark, [{"name": "a", "type": "categorical", "vocab": spark.createDataFrame(
        [("x", 1), ("y", 2)], "token string, id long")}, {"name": "b", "type": "numeric"}])
    only_a = FM.restrict_and_override(fmap, spark.createDataFrame([("a",)], "feature string"),
                                      spark.createDataFrame([("a", 9)], "feature string, max_len long"))
    r = only_a.first()
    assert only_a.count() == 1 and r.vocab_size == 4 and r.oov_idx == 3 and r.max_len == 9


def test_callable_normalizer_and_max_list_len(spark):
    df = spark.createDataFrame([(1.0, "a b c"), (3.0, "d")], "x double, t string")
    m = E.fit_scaler(df, ["x"], lambda c: c * 10)
    assert [r.x for r in m.transform(df).collect()] == [10.0, 30.0]
    assert E.max_list_len(df, "t", " ") == 3


def test_length_features_both_modes(spark):
    df = spark.createDataFrame([("abc", [1, 2]), ("", [])], "t string, l array<long>")
    per_row = S.length_features(df, ["t", "l"]).collect()
    assert [(r.t_len, r.l_len) for r in per_row] == [(3.0, 2.0), (0.0, 0.0)]
    rc = S.length_features(df, ["t"], mode="rowcount").collect()
    assert [r.t_len for r in rc] == [2.0, 2.0]


def test_rank_in_group_chunked_equals_window(spark):
    rows = [(0 if i < 150 else i % 7, 1, i, float((i * 13) % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "impression_id long, user_id long, pos long, score double")
    a = R.rank_in_group(df, strategy="chunked").select("impression_id", "pos", "rank")
    b = R.rank_in_group(df, strategy="window").select("impression_id", "pos", "rank")
    assert a.exceptAll(b).count() == 0 and a.count() == 300


def test_hamming_topk_masks_last_and_attention_all_masked(spark):
    df = spark.createDataFrame([(5, [5, 4, 5, 0], [1, 1, 0, 1])], "t long, codes array<long>, mask array<int>")
    # sims: slot0 0, slot1 -1 (5 xor 4 = 1 bit), slot2 masked -8, slot3 -2 (5 xor 0 = 2 bits)
    assert df.select(V.hamming_topk("t", "codes", "mask", 4, 8).alias("k")).first().k == [0, 1, 3, 2]
    vec = spark.createDataFrame([([1.0, 0.0], [[1.0, 0.0], [0.0, 1.0]], [0, 0])],
                                "q array<double>, h array<array<double>>, m array<int>")
    out = V.softmax_attend(vec, "q", "h", "h", "m", 2).first().attended
    assert out == pytest.approx([0.5, 0.5])   # all masked: uniform weights, as in the reference
