"""Model training and scoring on Spark ML.

Estimators consume a vector column assembled from named feature columns;
nulls are imputed with 0 at the estimator boundary only (Spark trees do not
accept NULL).  Every result is keyed by the candidate key, never by row
order.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (FMClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.operators.sparse_fit import SparseLogistic, SparseMachine, SparseModel
from rankfold.session import ensure_checkpoint_dir

SEED = 2023
BLOCK_ROWS = 16_384  # rows of a dense block


def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")


def prepare(df: DataFrame, features: list[str]) -> DataFrame:
    """Cast features to double and fill NULL with 0 (estimator boundary)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})


def gbt(features: list[str], label: str = "label", max_depth: int = 5, max_iter: int = 20) -> Pipeline:
    """Binary boosted trees (L1) with the reference's sampling settings."""
    clf = GBTClassifier(labelCol=label, featuresCol="features", maxDepth=max_depth, maxIter=max_iter,
                        stepSize=0.1, subsamplingRate=0.7, featureSubsetStrategy="0.8", seed=SEED)
    return Pipeline(stages=[_assembler(features), clf])


def logistic(features: list[str], label: str = "label", reg: float = 0.0) -> Pipeline:
    """Logistic regression on numeric columns; one-hot fields come as a ready
    vector (``on_vectors``, L4)."""
    return Pipeline(stages=[_assembler(features), LogisticRegression(labelCol=label, featuresCol="features", regParam=reg)])


def factorization_machine(features: list[str], label: str = "label", factor_size: int = 8) -> FactorizationMachine:
    """Factorization machine classifier on numeric columns."""
    return FactorizationMachine(list(features), label, factor_size)


@dataclass
class FactorizationMachineModel:
    """Factors (features x size), linear weights and intercept."""
    features: list[str]
    factors: np.ndarray
    linear: np.ndarray
    intercept: float

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the ``probability`` vector of both classes."""
        x = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in self.features]

        def total(weights, values):
            return sum((v * F.lit(float(w)) for w, v in zip(weights, values)), F.lit(0.0))

        own = total((self.factors ** 2).sum(axis=1), [v * v for v in x])
        sums = [total(column, x) for column in self.factors.T]
        raw = F.lit(self.intercept) + total(self.linear, x) + (sum((t * t for t in sums), F.lit(0.0)) - own) * 0.5
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-raw))
        return df.withColumn("_p", p).withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p"), F.col("_p")))).drop("_p")


@dataclass
class FactorizationMachine:
    """Factorization machine on dense numeric columns: Spark ML's ``FMClassifier``
    (its first weights, Adam steps over the whole table, its stop) on blocks.

    The training columns are written once as dense blocks; a step is one job
    that sums a model-sized gradient per task with matrix products, instead of
    one vector object a row."""
    features: list[str]
    label: str = "label"
    factor_size: int = 8
    max_iter: int = 100
    step: float = 1.0
    tol: float = 1e-6

    def _first_factors(self, spark) -> np.ndarray:
        """What Spark ML starts from with this seed: a row of zeros moves no factor."""
        row = spark.createDataFrame([([0.0] * len(self.features), 0.0)], "x array<double>, label double")
        fm = FMClassifier(factorSize=self.factor_size, maxIter=1, seed=SEED)
        return fm.fit(row.select("label", array_to_vector("x").alias("features"))).factors.toArray()

    def _blocks(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = np.column_stack([c.fill_null(float("nan")).to_numpy(zero_copy_only=False) for c in b.columns])
                cut = [rows[at:at + BLOCK_ROWS].tobytes() for at in range(0, len(rows), BLOCK_ROWS)]
                yield pa.record_batch([pa.array(cut, pa.binary())], names=["block"])

        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fm-blocks/{uuid.uuid4().hex}"
        df.select(*[F.col(c).cast("double") for c in (*self.features, self.label)]).mapInArrow(pack, "block binary").write.parquet(path)
        return spark.read.schema("block binary").parquet(path).coalesce(spark.sparkContext.defaultParallelism)

    def fit(self, df: DataFrame) -> FactorizationMachineModel:
        d, k = len(self.features), self.factor_size
        factors = self._first_factors(df.sparkSession)
        blocks = self._blocks(df)
        weights = np.concatenate([factors.ravel(), np.zeros(d + 1)])

        def gradient(weights: np.ndarray) -> tuple[np.ndarray, int]:
            def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                v, w, b0 = weights[:d * k].reshape(d, k), weights[d * k:-1], weights[-1]
                total, n = np.zeros(len(weights)), 0
                for batch in batches:
                    for raw in batch.column(0).to_pylist():
                        rows = np.frombuffer(raw).reshape(-1, d + 1)
                        x = np.ascontiguousarray(rows[:, :d])
                        sums, square = x @ v, x * x
                        score = b0 + x @ w + 0.5 * ((sums * sums).sum(axis=1) - square @ (v * v).sum(axis=1))
                        with np.errstate(over="ignore"):
                            off = 1.0 / (1.0 + np.exp(-score)) - rows[:, d]
                        total[:d * k] += (x.T @ (off[:, None] * sums) - v * (square.T @ off)[:, None]).ravel()
                        total[d * k:-1] += x.T @ off
                        total[-1] += off.sum()
                        n += len(rows)
                yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["total", "n"])

            found = blocks.mapInArrow(part, "total binary, n long").collect()  # one gradient a task
            return sum((np.frombuffer(r["total"]) for r in found), np.zeros(len(weights))), sum(r["n"] for r in found)

        mean, spread = np.zeros(len(weights)), np.zeros(len(weights))
        for i in range(1, self.max_iter + 1):
            total, n = gradient(weights)
            if not n:
                break
            g = total / n
            mean, spread = 0.9 * mean + 0.1 * g, 0.999 * spread + 0.001 * g * g
            last, weights = weights, weights - self.step * (mean / (1 - 0.9 ** i)) / (np.sqrt(spread / (1 - 0.999 ** i)) + 1e-8)
            if i > 1 and np.linalg.norm(weights - last) < self.tol * max(np.linalg.norm(weights), 1.0):
                break
        return FactorizationMachineModel(self.features, weights[:d * k].reshape(d, k), weights[d * k:-1], float(weights[-1]))


def on_vectors(kind: str, label: str = "label", **options) -> SparseLogistic | SparseMachine:
    """``logistic`` (L4) or ``fm`` (L5) on a ready ``features`` vector, such as
    the sparse one of ``field_encoder.field_vectors``: Spark ML's models, with
    weights that no process holds whole (``sparse_fit``)."""
    if kind == "logistic":
        return SparseLogistic(label, "features", options.get("reg", 0.0))
    if kind == "fm":
        return SparseMachine(label, "features", options.get("factor_size", 8), 0.05, options.get("reg", 0.001),
                             options.get("max_iter", 100), seed=SEED)
    raise ValueError(kind)


def mlp(features: list[str], label: str = "label", hidden: tuple[int, ...] = (16,)) -> Pipeline:
    """Feed-forward classifier."""
    layers = [len(features), *hidden, 2]
    return Pipeline(stages=[_assembler(features), MultilayerPerceptronClassifier(
        labelCol=label, featuresCol="features", layers=layers, seed=SEED, maxIter=50)])


def score(model: PipelineModel | FactorizationMachineModel | SparseModel, df: DataFrame, key: list[str], out: str = "score") -> DataFrame:
    """Positive-class probability keyed by ``key``."""
    pred = model.transform(df)
    return pred.select(*key, vector_to_array("probability")[1].alias(out))


def importances(model: PipelineModel, features: list[str]) -> DataFrame:
    """Feature importances of the tree stage with slot names, descending (L3).
    One value per feature column: bounded by the schema, not the data."""
    from pyspark.sql import SparkSession
    vals = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(features, vals), key=lambda r: (-r[1], r[0]))
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double")


def pairwise_frame(df: DataFrame, group: list[str], features: list[str], label: str = "label") -> DataFrame:
    """Pairwise training rows without emitting P x N pairs (L2).

    Each positive is paired with its group's mean negative (and mirrored),
    so a group contributes 2P rows whatever its size; the difference vector
    feeds an intercept-free logistic regression whose weights rank items
    inside a group.  An analogue of pairwise boosting, not LambdaMART.  Both
    rows of a pair come from one row of the join, which runs once.
    """
    y = F.col(label)
    neg = df.where(y == 0).groupBy(*group).agg(*[F.avg(c).alias(f"_n_{c}") for c in features])
    pos = df.where(y == 1).join(neg, group, "inner")
    diff = {c: F.col(c) - F.col(f"_n_{c}") for c in features}
    up = F.struct(*[v.alias(c) for c, v in diff.items()], F.lit(1.0).alias("pair_label"))
    down = F.struct(*[(-v).alias(c) for c, v in diff.items()], F.lit(0.0).alias("pair_label"))
    return pos.select(F.inline(F.array(up, down)))


def fit_pairwise(df: DataFrame, group: list[str], features: list[str], label: str = "label") -> PipelineModel:
    pairs = pairwise_frame(prepare(df, features), group, features, label)
    lr = LogisticRegression(labelCol="pair_label", featuresCol="features", fitIntercept=False)
    return Pipeline(stages=[_assembler(features), lr]).fit(pairs)


def pairwise_scores(model: PipelineModel, df: DataFrame, key: list[str], features: list[str],
                    out: str = "score") -> DataFrame:
    """Score = w·x (a ranking score inside the group)."""
    pred = model.transform(prepare(df, features))
    return pred.select(*key, F.col("rawPrediction").alias("_r")).select(
        *key, vector_to_array("_r")[1].alias(out))


def with_score(model: PipelineModel, df: DataFrame, key: list[str], out: str) -> DataFrame:
    """``df`` joined with its own scores by key, as one shuffle of ``df``: a row
    occurs once for every score of its key, a row without a key not at all."""
    for k in key:
        df = df.where(F.col(k).isNotNull())
    pred = model.transform(df)
    rows = pred.select(*df.columns, vector_to_array("probability")[1].alias(out))
    rows = rows.withColumn(out, F.collect_list(out).over(Window.partitionBy(*key)))
    return rows.withColumn(out, F.explode(out))


def stack_two_stage(train: DataFrame, valid: DataFrame, test: DataFrame, features: list[str],
                    key: list[str], make=gbt, label: str = "label") -> DataFrame:
    """Two-stage stacking (R5): fit on train, score valid as ``train_score``,
    refit on valid with that feature, score test (train model's score also
    joined to test by key)."""
    m1 = make(features, label).fit(prepare(train, features))
    valid2 = with_score(m1, prepare(valid, features), key, "train_score")
    test2 = with_score(m1, prepare(test, features), key, "train_score")
    m2 = make([*features, "train_score"], label).fit(valid2)
    return score(m2, test2, key)


def select_model(df: DataFrame, features: list[str], label: str = "label",
                 depths=(3, 5), iters=(10, 20), parallelism: int = 2):
    """Grid search by validation AUC (L7): ParamGridBuilder + TrainValidationSplit."""
    pipe = gbt(features, label)
    clf = pipe.getStages()[-1]
    grid = ParamGridBuilder().addGrid(clf.maxDepth, list(depths)).addGrid(clf.maxIter, list(iters)).build()
    ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    tvs = TrainValidationSplit(estimator=pipe, estimatorParamMaps=grid, evaluator=ev, trainRatio=0.8,
                               parallelism=parallelism, seed=SEED)
    return tvs.fit(prepare(df, features))
