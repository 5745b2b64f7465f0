"""Listwise gradient boosting for ranking inside groups (L2).

Every round computes, for each row, the gradient of the group's listwise loss
at the current scores and fits a regression tree to the Newton step.  The loss
is the cross entropy between the share of a row's gain (2^label - 1) in its
group and the softmax of the group's scores: its gradient needs two sums per
group only, so no pair of rows is ever formed and a group of any size is
combined map-side.  A group whose labels give no gain teaches nothing.

A round's state (key, group, gain, features, score) is written to the shared
folder, so the plan of a round does not grow with the rounds.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfold.operators.learn import SEED, prepare
from rankfold.session import ensure_checkpoint_dir

# Leaf values are held in this range, so that rounds * rate * LEAF_LIMIT stays
# far below the largest exponent.
LEAF_LIMIT = 5.0


@dataclass
class ListwiseModel:
    features: list[str]
    trees: list[DecisionTreeRegressionModel]
    rate: float

    def score(self, df: DataFrame, key: Sequence[str], out: str = "score") -> DataFrame:
        """(key, score): the sum of the trees; it ranks rows inside a group."""
        rows = _vectors(df.withColumn("_key", F.struct(*key)), self.features).select("_key.*", "features")
        total = F.lit(0.0)
        for i, tree in enumerate(self.trees):
            rows = tree.copy().setPredictionCol(f"_t{i}").transform(rows)
            total = total + F.lit(self.rate) * F.col(f"_t{i}")
        return rows.select(*key, total.alias(out))

    def save(self, path: str) -> None:
        """The trees by Spark ML's own writers, the rest as one JSON row."""
        spark = _session()
        spark.createDataFrame([(self.features, self.rate, len(self.trees))], "features array<string>, rate double, n int").write.json(
            f"{path}/meta")
        for i, tree in enumerate(self.trees):
            tree.save(f"{path}/tree-{i:05d}")

    @staticmethod
    def load(path: str) -> ListwiseModel:
        meta = _session().read.schema("features array<string>, rate double, n int").json(f"{path}/meta").first()
        return ListwiseModel(meta["features"], [DecisionTreeRegressionModel.load(f"{path}/tree-{i:05d}") for i in range(meta["n"])],
                             meta["rate"])


def _session():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep").transform(prepare(df, features))


def listwise_gradients(state: DataFrame, group: Sequence[str]) -> DataFrame:
    """``state`` (group, _gain, _s, ...) with ``_target`` (the Newton step of
    each row) and ``_weight`` (its curvature)."""
    sums = state.groupBy(*group).agg(F.sum("_gain").alias("_all"), F.sum(F.exp("_s")).alias("_z")).where(F.col("_all") > 0)
    rows = state.join(sums, list(group))
    share, p = F.col("_gain") / F.col("_all"), F.exp("_s") / F.col("_z")
    weight = F.greatest(p * (1 - p), F.lit(1e-6))
    step = F.least(F.greatest((share - p) / weight, F.lit(-LEAF_LIMIT)), F.lit(LEAF_LIMIT))
    return rows.withColumns({"_target": step, "_weight": weight}).drop("_all", "_z")


def fit_listwise(df: DataFrame, group: Sequence[str], features: list[str], label: str = "label", rounds: int = 20,
                 rate: float = 0.3, max_depth: int = 4) -> ListwiseModel:
    """Boosted regression trees on the listwise gradients of every round."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/listwise/{uuid.uuid4().hex}"
    gain = F.pow(F.lit(2.0), F.coalesce(F.col(label).cast("double"), F.lit(0.0))) - 1
    state = _vectors(df, features).select(*group, gain.alias("_gain"), "features", F.lit(0.0).alias("_s"))

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    trees: list[DecisionTreeRegressionModel] = []
    state = written(state, "round-0")
    for i in range(rounds):
        rows = written(listwise_gradients(state, group), f"targets-{i}")
        tree = DecisionTreeRegressor(featuresCol="features", labelCol="_target", weightCol="_weight", predictionCol="_t",
                                     maxDepth=max_depth, minInstancesPerNode=5, seed=SEED + i).fit(rows)
        trees.append(tree)
        if i + 1 < rounds:
            state = written(tree.transform(rows).withColumn("_s", F.col("_s") + rate * F.col("_t"))
                            .select(*group, "_gain", "features", "_s"), f"round-{i + 1}")
    return ListwiseModel(list(features), trees, rate)


