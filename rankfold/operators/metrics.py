"""Ranking and classification metrics as Spark jobs.

AUC is exact and tie-aware (ties count one half), computed from a score
histogram: ``(group, score) -> (positives, negatives)`` is a partial/final
aggregate, and the negatives ranked below each score are a running sum
inside the group, sorted across partitions with a carry, so that one group (a
global AUC, or a user holding a third of the rows) spans many of them.

MRR / NDCG need a rank inside the group (score descending, ties by
candidate position — the reference leaves ties to an unstable sort).
Every function returns a DataFrame; nothing is collected except the
one-row-per-partition boundary tables of the prefix sums.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.operators.boundary import running_sums
from rankfold.session import ensure_checkpoint_dir

EPS_LOGLOSS = 1e-7
EPS_RANK = 1e-12


def _histogram(df: DataFrame, group: list[str], label: str, score: str) -> DataFrame:
    y = F.col(label).cast("double")
    return df.groupBy(*group, score).agg(F.sum(y).alias("_pos"), F.sum(F.lit(1.0) - y).alias("_neg"))


def group_auc(df: DataFrame, group: list[str], label: str = "label", score: str = "score",
              strategy: str = "auto") -> DataFrame:
    """Per group: ``auc`` (NULL for a one-class group), ``n``, ``n_pos``."""
    return _auc_of(_histogram(df, group, label, score), group, score, strategy)


def _auc_of(h: DataFrame, group: list[str], score: str, strategy: str) -> DataFrame:
    if strategy == "window" and group:
        w = (Window.partitionBy(*group).orderBy(score)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        cum = h.withColumn("_neg_cum", F.sum("_neg").over(w))
    else:
        cum = running_sums(h, group, [score], {"_neg_cum": "_neg"})
    below = F.col("_neg_cum") - F.col("_neg")
    contrib = F.col("_pos") * (below + F.lit(0.5) * F.col("_neg"))
    g = cum.groupBy(*group).agg(F.sum(contrib).alias("_c"), F.sum("_pos").alias("n_pos"),
                                F.sum("_neg").alias("n_neg"))
    auc = F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                 F.col("_c") / (F.col("n_pos") * F.col("n_neg")))
    return g.select(*group, auc.alias("auc"), (F.col("n_pos") + F.col("n_neg")).alias("n"), "n_pos")


def auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Global AUC, exact with ties (M1); one row."""
    return group_auc(df, [], label, score).select("auc")


def logloss(df: DataFrame, label: str = "label", score: str = "score", eps: float = EPS_LOGLOSS) -> DataFrame:
    """Mean binary cross-entropy with probabilities clipped to [eps, 1-eps] (M2)."""
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    ll = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    return df.agg(F.avg(ll).alias("logloss"))


def avg_auc(df: DataFrame, group: list[str], label="label", score="score", **kw) -> DataFrame:
    """Mean AUC over two-class groups (M3)."""
    g = group_auc(df, group, label, score, **kw)
    return g.agg(F.avg("auc").alias("avg_auc"))


def weighted_gauc(df: DataFrame, group: list[str], label="label", score="score", **kw) -> DataFrame:
    """AUC weighted by group size over two-class groups (M4)."""
    g = group_auc(df, group, label, score, **kw)
    two = F.col("auc").isNotNull()
    return g.agg((F.sum(F.when(two, F.col("auc") * F.col("n"))) / F.sum(F.when(two, F.col("n")))).alias("gauc"))


def impression_auc(df: DataFrame, group: list[str], label="label", score="score", **kw) -> DataFrame:
    """Mean over all groups, a one-class group scoring 1.0 (M5)."""
    g = group_auc(df, group, label, score, **kw)
    return g.agg(F.avg(F.coalesce(F.col("auc"), F.lit(1.0))).alias("impression_auc"))


def _ranked(df: DataFrame, group: list[str], score: str, pos: str, by: str | None = None,
            out: str = "_rank", strategy: str = "auto") -> DataFrame:
    """1-based rank by descending ``by`` (default the score), ties by
    position; ``window`` for groups of bounded size."""
    from rankfold.operators.sequence import positions
    key = F.col(by or score)
    r = positions(df, group, [key.desc_nulls_last(), F.col(pos).asc()], "_p0", strategy)
    return r.withColumn(out, F.col("_p0") + 1).drop("_p0", "seq_n")


def mrr(df: DataFrame, group: list[str], label="label", score="score", pos="pos") -> DataFrame:
    """Mean over groups of Σ(y / rank) / (Σy + 1e-12) (M6)."""
    return ranking_metrics(df, group, (), label, score, pos).select("mrr")


def _gain(label: str):
    return F.pow(F.lit(2.0), F.col(label).cast("double")) - F.lit(1.0)


def _ideal_dcg(df: DataFrame, group: list[str], ks: list[int], label: str) -> DataFrame:
    """Per group the best DCG at each k, from a histogram of the labels: equal
    labels take a run of ranks, whose discounts add up from a table."""
    w = Window.partitionBy(*group).orderBy(F.col(label).desc_nulls_last())
    h = df.groupBy(*group, label).agg(F.count(F.lit(1)).alias("_n"))
    h = h.withColumn("_end", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sums = {k: [0.0, *accumulate(1.0 / math.log2(i + 1) for i in range(1, k + 1))] for k in ks}

    def upto(k: int, end):
        return F.get(F.array(*map(F.lit, sums[k])), F.least(end, F.lit(k)).cast("int"))

    return h.groupBy(*group).agg(*[
        F.sum(_gain(label) * (upto(k, F.col("_end")) - upto(k, F.col("_end") - F.col("_n")))).alias(f"_idcg{k}")
        for k in ks])


def ranking_metrics(df: DataFrame, group: list[str], ks: list[int] = (), label="label", score="score",
                    pos="pos", strategy: str = "auto") -> DataFrame:
    """One row: ``mrr`` and ``ndcg_k`` for each k, all from one ranking of the
    rows, which the ideal order's label counts read as well."""
    ks = sorted(set(ks))
    df = r = _ranked(df.select(*group, label, score, pos), group, score, pos, strategy=strategy)
    y = F.col(label).cast("double")
    hit = [F.sum(F.when(F.col("_rank") <= k, _gain(label) / F.log2(F.col("_rank") + F.lit(1.0))).otherwise(0.0))
           .alias(f"_dcg{k}") for k in ks]
    g = r.groupBy(*group).agg((F.sum(y / F.col("_rank")) / (F.sum(y) + F.lit(EPS_RANK))).alias("_mrr"), *hit)
    if ks:
        ideal = _ideal_dcg(df, group, ks, label).withColumnsRenamed({c: f"_i_{c}" for c in group})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_i_{c}")) for c in group])
        g = g.join(ideal, same, "left")
    return g.agg(F.avg("_mrr").alias("mrr"),
                 *[F.avg(F.col(f"_dcg{k}") / (F.col(f"_idcg{k}") + F.lit(EPS_RANK))).alias(f"ndcg_{k}") for k in ks])


def ndcg(df: DataFrame, group: list[str], k: int, label="label", score="score", pos="pos") -> DataFrame:
    """Mean over groups of DCG@k / (ideal DCG@k + 1e-12), gain 2^y - 1 (M7)."""
    return ranking_metrics(df, group, [k], label, score, pos).select(f"ndcg_{k}")


def _once(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder, so that what follows reads it there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _histogram_logloss(h: DataFrame, score: str, eps: float = EPS_LOGLOSS) -> DataFrame:
    p = F.least(F.greatest(F.col(score).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    n = F.when(F.col(score).isNotNull(), F.col("_pos") + F.col("_neg"))
    return h.agg((-F.sum(F.col("_pos") * F.log(p) + F.col("_neg") * F.log(F.lit(1.0) - p)) / F.sum(n)).alias("_v"))


# name of a metric -> the family that computes it
_FAMILY = {"logloss": "score", "binary_crossentropy": "score", "AUC": "score",
           "avgAUC": "group", "gAUC": "group", "MRR": "rank", "NDCG": "rank"}


def evaluate(df: DataFrame, metrics: list[str], group: list[str] | None = None, label="label",
             score="score", pos="pos") -> DataFrame:
    """Metric dispatcher (M8): one row, one column per metric name
    (``logloss``, ``AUC``, ``avgAUC``, ``gAUC``, ``MRR``, ``NDCG@k``).

    The input runs once: its needed columns (or, without rank metrics, its
    score histogram) are written, and every metric is derived from them, the
    group AUCs from one histogram and the rank metrics from one ranking."""
    family = {m: _FAMILY.get(m.split("@")[0]) for m in metrics}
    unknown = [m for m, f in family.items() if f is None]
    if unknown:
        raise ValueError(f"unknown metrics: {unknown}")
    kinds, group = set(family.values()), list(group or [])
    if kinds - {"score"} and not group:
        raise ValueError("group metrics need a group")
    if "rank" in kinds:
        df = _once(df.select(*group, label, score, pos))
    hist = _histogram(df, group if "group" in kinds else [], label, score)
    hist = hist if "rank" in kinds else _once(hist)
    parts = []
    if "score" in kinds:
        h = hist if hist.columns[0] == score else hist.groupBy(score).agg(F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
        for m in (m for m in metrics if family[m] == "score"):
            parts.append(_auc_of(h, [], score, "chunked").select(F.col("auc").alias(m)) if m == "AUC"
                         else _histogram_logloss(h, score).withColumnRenamed("_v", m))
    if "group" in kinds:
        g = _auc_of(hist, group, score, "auto")
        weight = F.when(F.col("auc").isNotNull(), F.col("n"))
        value = {"avgAUC": F.avg("auc"), "gAUC": F.sum(F.col("auc") * F.col("n")) / F.sum(weight)}
        parts.append(g.agg(*[value[m].alias(m) for m in metrics if family[m] == "group"]))
    if "rank" in kinds:
        cut = {m: int(m.split("@")[1]) if "@" in m else 1 for m in metrics if m.startswith("NDCG")}
        r = ranking_metrics(df, group, list(cut.values()), label, score, pos)
        parts.append(r.select(*[F.col(f"ndcg_{cut[m]}" if m in cut else "mrr").alias(m) for m in metrics if family[m] == "rank"]))
    long = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return long.agg(*[F.max(F.col(m)).alias(m) for m in metrics])


def monitor_value(metric_row: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Weighted sum of metric columns (M9)."""
    expr = reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(m) for m, w in weights.items()])
    return metric_row.select(expr.alias("monitor"))


def multi_task(df: DataFrame, labels: list[str], score_cols: dict[str, str],
               metrics: tuple[str, ...] = ("AUC", "logloss")) -> DataFrame:
    """Per-task metrics and their mean (M10): one row per task plus 'mean'."""
    df = _once(df.select(*dict.fromkeys([*labels, *score_cols.values()])))  # the input runs once for all tasks
    per = []
    for t in labels:
        sub = df.select(F.col(t).alias("label"), F.col(score_cols[t]).alias("score"))
        per.append(evaluate(sub, list(metrics)).withColumn("task", F.lit(t)))
    allt = reduce(lambda a, b: a.unionByName(b), per)
    mean = allt.agg(*[F.avg(m).alias(m) for m in metrics]).withColumn("task", F.lit("mean"))
    return allt.unionByName(mean)
