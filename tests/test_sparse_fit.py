"""Logistic regression and factorization machine with weights in ranges, against Spark ML."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from rankfold.operators import learn as LN


@pytest.fixture
def sparse_rows(spark, monkeypatch):
    """Sparse and dense vectors, an empty one, a slot that all rows share, in parts and ranges of a few."""
    from pyspark.ml.linalg import Vectors
    from rankfold.operators import sparse_fit as SF
    for name, value in (("RANGE_SLOTS", 13), ("PART_ROWS", 60), ("DRAWS", 16), ("KEEP_STEPS", 2)):
        monkeypatch.setattr(SF, name, value)
    rnd = random.Random(1)
    rows = [(0, Vectors.sparse(50, []), 1.0)]
    for i in range(1, 240):
        cells = {0 if i % 3 else rnd.randrange(40): 1.0, 40 + rnd.randrange(5): 1.0, 48: 2.0, 49: rnd.random()}
        rows.append((i, Vectors.sparse(50, sorted(cells.items())) if i % 17 else Vectors.dense([0.1 * (j % 3) for j in range(50)]),
                     float(rnd.random() < 0.4)))
    return spark.createDataFrame(rows, ["id", "features", "label"])


def range_weights(model):
    return np.concatenate([np.frombuffer(r["w"]) for r in sorted(model.weights.collect(), key=lambda r: r["r"])])


def same_scores(ours, theirs, df):
    a, b = ({r["id"]: r["score"] for r in LN.score(m, df, ["id"]).collect()} for m in (ours, theirs))
    return len(a) == df.count() and a.keys() == b.keys() and all(a[i] == pytest.approx(b[i], abs=1e-8) for i in a)


def test_machine_in_ranges_equals_spark_ml(sparse_rows):
    from pyspark.ml.classification import FMClassifier
    spark_ml = FMClassifier(factorSize=4, stepSize=0.05, regParam=0.001, maxIter=5, seed=LN.SEED).fit(sparse_rows)
    ours = LN.on_vectors("fm", factor_size=4, max_iter=5).fit(sparse_rows)
    w = range_weights(ours).reshape(-1, 5)
    assert ours.weights.count() == 4  # no process had them all
    assert np.allclose(w[:, :4], spark_ml.factors.toArray(), atol=1e-10) and np.allclose(w[:, 4], spark_ml.linear.toArray(), atol=1e-10)
    assert ours.intercept == pytest.approx(spark_ml.intercept) and same_scores(ours, spark_ml, sparse_rows)


@pytest.mark.parametrize("reg", [0.01, 0.3])
def test_logistic_in_ranges_equals_spark_ml(sparse_rows, reg):
    from pyspark.ml.classification import LogisticRegression
    spark_ml = LogisticRegression(regParam=reg).fit(sparse_rows)
    estimator = LN.on_vectors("logistic", reg=reg)
    ours = estimator.fit(sparse_rows)
    assert estimator.iterations == spark_ml.summary.totalIterations and ours.weights.count() == 4
    assert np.allclose(range_weights(ours), spark_ml.coefficients.toArray(), atol=1e-9)
    assert ours.intercept == pytest.approx(spark_ml.intercept) and same_scores(ours, spark_ml, sparse_rows)


def test_logistic_on_one_class_and_bad_labels(sparse_rows):
    """As Spark ML: certain of the only class; other labels and no rows raise."""
    for label in (0.0, 1.0):
        model = LN.on_vectors("logistic").fit(sparse_rows.withColumn("label", F.lit(label)))
        assert {r["score"] for r in LN.score(model, sparse_rows, ["id"]).collect()} == {label}
    for bad in (None, 2.0):
        with pytest.raises(Exception, match="label is not 0 or 1"):
            LN.on_vectors("logistic").fit(sparse_rows.withColumn("label", F.lit(bad).cast("double")))


def test_first_weights_are_those_of_one_stream():
    """However it is cut, the stream of java.util.Random is the same."""
    from rankfold.operators import sparse_fit as SF
    whole = SF._gaussians(2023, 0, 512)
    assert np.array_equal(whole, np.concatenate([SF._gaussians(2023, c, 64) for c in range(8)])) and len(whole) > 700


def test_line_search_takes_breezes_steps():
    """Too short a first step grows, too long a one is cut by the cubic."""
    from rankfold.operators import sparse_fit as SF
    asked = []

    def phi(t):
        asked.append(t)
        return (t - 3) ** 2, 2 * (t - 3)

    assert SF._wolfe(phi, 9.0, -6.0, 0.1) == asked[-1] and asked[:2] == [0.1, pytest.approx(0.15)]
    asked.clear()
    assert SF._wolfe(phi, 9.0, -6.0, 40.0) == asked[-1] == pytest.approx(4.0) and len(asked) == 2
    with pytest.raises(SF._LineSearchFailed):
        SF._wolfe(phi, 9.0, 6.0, 1.0)
