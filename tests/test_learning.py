"""Learning jobs on planted signals; the field encoder and PCA against brute force."""

import random

import numpy as np
import pytest

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from rankfold.functions.lists import pad_sequence
from rankfold.operators import learn as LN
from rankfold.operators import metrics as M
from rankfold.operators import vectors as V
from rankfold.operators.field_encoder import FieldEncoder, FieldEncoderModel, field_vectors
from rankfold.operators.listwise import ListwiseModel, fit_listwise

FEATURES = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def planted(spark):
    """The label follows x1 > 0 (noisily); x2 is noise, x3 sometimes null."""
    rnd = random.Random(8)
    rows = []
    for i in range(1200):
        x1, x2 = rnd.gauss(0, 1), rnd.gauss(0, 1)
        rows.append((i, i // 8, x1, x2, None if i % 9 == 0 else rnd.random(), float(x1 + 0.4 * rnd.gauss(0, 1) > 0)))
    df = LN.prepare(spark.createDataFrame(rows, "id long, g long, x1 double, x2 double, x3 double, label double"), FEATURES)
    return df.where("g % 3 <> 0").cache(), df.where("g % 3 = 0").cache()


def auc(scores, df):
    return M.auc(scores.join(df.select("id", "label"), "id")).first()["auc"]


@pytest.mark.parametrize("make", [
    lambda: LN.gbt(FEATURES, max_depth=3, max_iter=5), lambda: LN.mlp(FEATURES, hidden=(4,)),
    lambda: LN.logistic(FEATURES), lambda: LN.factorization_machine(FEATURES, factor_size=2)])
def test_classifiers_find_the_signal(planted, make):
    train, test = planted
    scores = LN.score(make().fit(train), test, ["id"])
    assert scores.count() == test.count() and auc(scores, test) > 0.85


@pytest.mark.parametrize("steps", [1, 40])
def test_machine_on_blocks_equals_spark_ml(planted, monkeypatch, steps):
    """Same weights and scores as FMClassifier, however the rows are cut into blocks."""
    from pyspark.ml.classification import FMClassifier
    from pyspark.ml.feature import VectorAssembler
    monkeypatch.setattr(LN, "BLOCK_ROWS", 100)
    train, test = planted
    ours = LN.FactorizationMachine(FEATURES, factor_size=3, max_iter=steps).fit(train)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features")
    spark_ml = FMClassifier(factorSize=3, maxIter=steps, seed=LN.SEED).fit(vectors.transform(train))
    assert np.allclose(ours.factors, spark_ml.factors.toArray(), rtol=1e-6, atol=1e-8)
    assert np.allclose(ours.linear, spark_ml.linear.toArray(), rtol=1e-6, atol=1e-8) and ours.intercept == pytest.approx(spark_ml.intercept)
    a, b = ({r["id"]: r["score"] for r in LN.score(m, t, ["id"]).collect()}
            for m, t in ((ours, test), (spark_ml, vectors.transform(test))))
    assert a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-7) for i in a)


def test_machine_on_no_rows_keeps_its_first_weights(planted):
    model = LN.FactorizationMachine(FEATURES, factor_size=2).fit(planted[0].where("false"))
    assert model.intercept == 0 and not model.linear.any() and model.factors.shape == (3, 2)


def test_importances_name_the_signal_first(planted):
    train, _ = planted
    rows = LN.importances(LN.gbt(FEATURES, max_depth=3, max_iter=5).fit(train), FEATURES).collect()
    assert rows[0]["feature"] == "x1" and [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


def test_stacking_and_selection(planted):
    train, test = planted
    half = train.where("g % 3 = 1"), train.where("g % 3 = 2")
    make = lambda f, label: LN.gbt(f, label, max_depth=2, max_iter=3)
    assert auc(LN.stack_two_stage(*half, test, FEATURES, ["id"], make=make), test) > 0.85
    chosen = LN.select_model(train, FEATURES, depths=(1, 2), iters=(2,))
    assert len(chosen.validationMetrics) == 2 and max(chosen.validationMetrics) > 0.85
    assert BinaryClassificationEvaluator(labelCol="label").evaluate(chosen.transform(test)) > 0.85


def test_listwise_boosting_beats_the_mean_negative(spark):
    """The best row of a group has x1 and x2 of one sign: nothing linear finds it."""
    rnd = random.Random(3)
    rows = []
    for g in range(220):
        for p in range(rnd.randint(4, 9)):
            a, b = rnd.uniform(-1, 1), rnd.uniform(-1, 1)
            rows.append((g, p, a, b, 2 if a * b > 0.3 else 1 if a * b > 0.05 else 0))
    df = spark.createDataFrame(rows, "g long, pos long, x1 double, x2 double, label int")
    train, test = df.where("g < 150"), df.where("g >= 150")
    model = fit_listwise(train, ["g"], ["x1", "x2"], rounds=12, max_depth=4)
    key = ["g", "pos"]
    binary = train.withColumn("label", (F.col("label") > 0).cast("int"))
    plain = LN.pairwise_scores(LN.fit_pairwise(binary, ["g"], ["x1", "x2"]), test, key, ["x1", "x2"])

    def ndcg(scores):
        return M.ndcg(test.select(*key, "label").join(scores, key), ["g"], 5).first()["ndcg_5"]

    ours = model.score(test, key)
    assert ndcg(ours) > 0.85 and ndcg(ours) > ndcg(plain) + 0.1
    assert dict(ours.dtypes)["pos"] == "bigint"


def test_listwise_model_survives_saving(spark, tmp_path):
    rows = [(g, p, float(p == g % 3), p == g % 3) for g in range(30) for p in range(3)]
    df = spark.createDataFrame(rows, "g long, p long, x double, label boolean").withColumn("label", F.col("label").cast("int"))
    df = df.union(spark.createDataFrame([(99, 0, 1.0, 0), (99, 1, None, None)], df.schema))  # a group without gain
    model = fit_listwise(df, ["g"], ["x"], rounds=2, max_depth=1)
    model.save(str(tmp_path / "m"))
    again = ListwiseModel.load(str(tmp_path / "m"))
    a, b = (sorted(map(tuple, m.score(df, ["g", "p"]).collect())) for m in (model, again))
    assert a == b and len(a) == 92


def executed_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_scores_of_a_key_that_repeats_are_joined_as_before(planted):
    """Every row meets every score of its key, in one pass over the rows; a row without a key goes."""
    train, test = planted
    model = LN.logistic(FEATURES).fit(train)
    rows = test.where("id % 4 < 3").withColumn("k", F.when(F.col("id") % 7 > 0, F.col("id") % 50)).drop("g")
    old = rows.join(LN.score(model, rows, ["k"], "train_score"), "k")
    new = LN.with_score(model, rows, ["k"], "train_score")
    cells = lambda df: sorted((r["k"], r["id"], round(r["train_score"], 9)) for r in df.collect())
    assert cells(new) == cells(old) and new.count() > rows.count()
    assert "Join" not in executed_plan(new)


def test_pairs_come_from_one_join(planted):
    train, _ = planted
    pairs = LN.pairwise_frame(train, ["g"], FEATURES)
    assert executed_plan(pairs).count("Join ") == 1 and "Union" not in executed_plan(pairs)
    rows = [tuple(r) for r in pairs.collect()]
    both = train.groupBy("g").agg(F.sum("label").alias("p"), F.count("*").alias("n")).where("p > 0 and p < n").agg(F.sum("p")).first()[0]
    assert len(rows) == 2 * both
    assert sorted(tuple(-x for x in r[:-1]) for r in rows if r[-1] == 1) == sorted(r[:-1] for r in rows if r[-1] == 0)


def test_rows_written_once_leave_no_shuffle_files(spark):
    """The setting holds for the writing job alone, and nulls, kinds and rows stay."""
    from rankfold.session import CLEANUP, written
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (1, "a", 0.5)], "k long, s string, x double")
    df = df.repartition(3, "k").withColumn("n", F.lit(1))
    before = spark.conf.get(CLEANUP)
    done = written(df, "test")
    assert spark.conf.get(CLEANUP) == before and done.dtypes == df.dtypes
    assert sorted(map(str, done.collect())) == sorted(map(str, df.collect()))
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


def test_a_line_is_shuffled_by_impression_and_by_article_only(spark):
    """The length of an impression takes no join and no shuffle of its own."""
    from rankfold.plans import catalog_learn
    from __spark_entry__ import SMOKE_DIR
    plan = executed_plan(catalog_learn.feature_table(spark, SMOKE_DIR))
    assert plan.count("Join ") == 2  # orders, articles
    train, valid, test = catalog_learn._written_splits(spark, SMOKE_DIR)
    assert all("Join" not in executed_plan(part) and "Window" not in executed_plan(part) for part in (train, valid, test))


# --- fields -----------------------------------------------------------------------

ROWS = "id long, color string, size int, words string, price double, note string"
DATA = [(1, "red", 4, "a b c", 10.0, "p"), (2, "red", 4, "b", 20.0, "q"), (3, "blue", 5, "", 15.0, None),
        (4, None, 4, "a  b d a", None, "r"), (5, "blue", None, None, 30.0, "s"), (6, "red", 9, "zz b", 12.0, "t")]


def encoder():
    return FieldEncoder(keyCols=["id"], categorical=["color", "size"], numeric=["price"],
                        sequences={"words": {"splitter": " ", "max_len": 3}}, minCount=2)


def test_field_encoder_and_saved_model(spark, tmp_path):
    train = spark.createDataFrame(DATA, ROWS)
    model = encoder().fit(train)
    assert model.sizes == {"color": 2, "size": 1, "words": 2}
    model.write().save(str(tmp_path / "enc"))
    model = FieldEncoderModel.load(str(tmp_path / "enc"))  # nothing but the files
    got = {r["id"]: r for r in model.transform(train).collect()}
    assert [got[i]["color"] for i in range(1, 7)] == [1, 1, 2, 3, 2, 1]  # null is OOV
    assert [got[i]["size"] for i in range(1, 7)] == [1, 1, 2, 1, 2, 2]  # 5 and 9 occur once
    # words: b 4 times, a 3 times; null and empty are padding, unseen is 3
    assert got[1]["words"] == [2, 1, 3] and got[2]["words"] == [0, 0, 1] and got[5]["words"] == [0, 0, 0]
    assert got[3]["words"] == [0, 0, 0] and got[4]["words"] == [1, 3, 2] and got[6]["words"] == [0, 3, 1]
    assert got[2]["price"] == 0.5 and got[4]["price"] is None and got[1]["note"] == "p" and got[3]["note"] is None
    new = spark.createDataFrame([(9, "green", 4, "b b b b", 50.0, "n")], ROWS)
    r = model.transform(new).first()
    assert (r["color"], r["size"], r["words"], r["price"]) == (3, 1, [1, 1, 1], 2.0)
    assert model.transform(train).columns == train.columns
    assert model.transform(train.where("false")).collect() == []


def test_fields_are_joined_once(spark):
    train = spark.createDataFrame(DATA, ROWS)
    plan = encoder().fit(train).transform(train)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1



@pytest.mark.parametrize("lookup, most", [(4096, 500_000), (1, 500_000), (1, 0)])
def test_rows_encode_alike_by_every_way(spark, monkeypatch, lookup, most):
    """Tokens looked up in the task, broadcast or joined; keys that repeat, across batches too, or are null."""
    from rankfold.operators import field_encoder as FE
    rnd = random.Random(5)
    rows = [(None if i % 11 == 0 else i // 3, i % 2 * 0.5 if i % 7 else None, rnd.choice(["a", "b", "zz", None]), rnd.randrange(30),
             None if i % 13 == 0 else " ".join(rnd.choice(["x", "y", "", "w"]) for _ in range(rnd.randrange(5))), float(i), "same")
            for i in range(400)]
    rows += [(7, 0.5, "a", 3, "x", 1.0, "same")] * 90  # more rows of a key than a batch has
    df = spark.createDataFrame(rows, "k long, k2 double, c string, n int, words string, price double, note string")
    model = FieldEncoder(keyCols=["k", "k2"], categorical=["c", "n"], numeric=["price"],
                         sequences={"words": {"splitter": " ", "max_len": 3}}, minCount=2).fit(df)
    old = model._by_cells(df)
    monkeypatch.setattr(FE, "LOOKUP", lookup)
    monkeypatch.setattr(FE, "BROADCAST", most)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        new = model._folded(df)
        cells = lambda d: sorted(map(str, d.select("k", "k2", "c", "n", "words", "note").collect()))
        assert cells(new) == cells(old) and new.count() < len(rows)
        if lookup > 1:
            plan = executed_plan(model.transform(df))
            assert "Generate" not in plan  # a row stays one row
            assert cells(model.transform(df)) == cells(old.withColumn("words", pad_sequence("words", 3, 0, padding="pre")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_customer_that_is_there_twice_repeats_its_lines(spark, tmp_path):
    """Positions count an order's lines once, whatever its customers."""
    from datetime import datetime
    from rankfold.plans import catalog_build
    day = datetime(1995, 5, 5)
    spark.createDataFrame([(1, 10, "O", 1.0, day, "x"), (2, 11, "O", 1.0, day, "x"), (3, None, "O", 1.0, day, "x")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
                          ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(o, 5, 1, n, 1.0, 2.0, 0.0, 0.0, "R", "O", day) for o in (1, 2, 3) for n in (1, 2)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
                          ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(10, 1, "A"), (10, 2, "B"), (None, 3, "C")], "c_custkey long, c_nationkey int, c_mktsegment string"
                          ).write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame([(5, "n", "b", "t", 1)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"
                          ).write.parquet(str(tmp_path / "part.parquet"))
    rows = catalog_build.field_rows(spark, str(tmp_path))
    got = sorted((r["impression_id"], r["pos"], r["segment"] or "", r["nation"] or 0) for r in rows.collect())
    assert got == [(1, 0, "A", 1), (1, 0, "B", 2), (1, 1, "A", 1), (1, 1, "B", 2), (2, 0, "", 0), (2, 1, "", 0), (3, 0, "", 0), (3, 1, "", 0)]


def test_one_hot_models_on_fields_find_the_signal(spark):
    rnd = random.Random(12)
    rows = []
    for i in range(1500):
        u, a, b = rnd.randrange(40), rnd.choice("abcd"), rnd.randrange(6)
        rows.append((i, f"u{u}", a, b, rnd.random(), float((u % 2 == 0) != (a in "ab")) if rnd.random() < 0.95 else float(rnd.random() < 0.5)))
    df = spark.createDataFrame(rows, "id long, u string, a string, b int, price double, label double")
    enc = FieldEncoder(keyCols=["id"], categorical=["u", "a", "b"], numeric=["price"]).fit(df.where("id < 1100"))
    train, test = (field_vectors(enc.transform(df.where(w)), enc, ["price"]) for w in ("id < 1100", "id >= 1100"))
    width = train.select(F.size(vector_to_array("features"))).first()[0]
    assert width == (40 + 2) + (4 + 2) + (6 + 2) + 1
    assert train.first()["features"].numNonzeros() <= 4  # sparse: one slot a field, and the number
    fm = LN.score(LN.on_vectors("fm", factor_size=4, max_iter=120).fit(train), test, ["id"])
    assert auc(fm, df) > 0.85  # the label is a product of two fields
    linear = df.withColumn("label", (F.col("u").isin([f"u{i}" for i in range(0, 40, 2)])).cast("double"))
    enc2 = FieldEncoder(keyCols=["id"], categorical=["u", "a"]).fit(linear.where("id < 1100"))
    train, test = (field_vectors(enc2.transform(linear.where(w)), enc2) for w in ("id < 1100", "id >= 1100"))
    lr = LN.score(LN.on_vectors("logistic", reg=0.01).fit(train), test, ["id"])
    assert auc(lr, linear) > 0.95


def test_pca_equals_numpy(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(200, 12)) * np.arange(12, 0, -1) + 5
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>")
    got = np.array([r["pca"] for r in V.pca(df, "v", 4).orderBy("id").collect()])
    c = x - x.mean(axis=0)
    _, _, vt = np.linalg.svd(c, full_matrices=False)
    pc = vt[:4].T
    pc = pc * np.sign(pc[np.abs(pc).argmax(axis=0), np.arange(4)])
    assert got.shape == (200, 4) and np.allclose(got, c @ pc, atol=1e-8)
