"""In-impression ranking, submission lines, score blending.

An impression's candidate list is bounded by the page, so the per-impression
window / collect here is a bounded group; all work is one shuffle on the
impression key (window and aggregate share the partitioning).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = ["impression_id", "user_id"]


def rank_in_group(df: DataFrame, group: list[str] = GROUP, score: str = "score",
                  pos: str = "pos", out: str = "rank", strategy: str = "auto") -> DataFrame:
    """1-based rank by descending score inside the group; ties keep the
    earlier candidate position first (a stable sort, as in the reference).
    ``window`` for groups of bounded size (see ``sequence.positions``)."""
    from rankfold.operators.sequence import positions
    ranked = positions(df, group, [F.col(score).desc_nulls_last(), F.col(pos).asc()], "_p", strategy)
    return ranked.withColumn(out, (F.col("_p") + 1).cast("int")).drop("_p", "seq_n")


def rank_lists(df: DataFrame, group: list[str] = GROUP, score: str = "score",
               pos: str = "pos", out: str = "rank") -> DataFrame:
    """One row per group: ``[r1,r2,...]`` — the rank of each candidate, listed
    in candidate order (R1)."""
    ranked = rank_in_group(df, group, score, pos, "_rank")
    agg = ranked.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col("_rank").alias("r")))).alias("_l"))
    return agg.select(*group, F.concat(F.lit("["), F.array_join(
        F.transform("_l", lambda x: x["r"].cast("string")), ","), F.lit("]")).alias(out))


def submission_lines(ranked: DataFrame, impression: str = "impression_id",
                     rank: str = "rank", out: str = "line") -> DataFrame:
    """``"<impression_id> [r1,...]"``."""
    return ranked.select(F.concat_ws(" ", F.col(impression).cast("string"), F.col(rank)).alias(out))


def write_submission(lines: DataFrame, path: str, compression: str = "gzip") -> None:
    lines.write.mode("overwrite").option("compression", compression).text(path)


def score_range(df: DataFrame, score: str = "score") -> tuple[float, float]:
    """File-wide min and max of a score: one bounded row to the driver."""
    row = df.agg(F.min(score).alias("lo"), F.max(score).alias("hi")).first()
    return row["lo"], row["hi"]


def minmax_in_group(df: DataFrame, group: list[str] = GROUP, score: str = "score") -> DataFrame:
    """Per-group min-max normalisation (W17); a constant group gives NULL.
    Group min/max come from ``attach_stats`` (windows for bounded groups,
    map-side aggregates + join back for a hot group)."""
    from rankfold.operators.features import attach_stats
    st = attach_stats(df, [(group, [("min", score, "_lo"), ("max", score, "_hi")])])
    norm = F.try_divide(F.col(score) - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return st.withColumn(score, norm).drop("_lo", "_hi")


def blend_scores(tables: list[DataFrame], weights: list[float] | None = None,
                 key: list[str] = ("impression_id", "user_id", "article_id", "pos"),
                 score: str = "score", norm: bool = False, group: list[str] = GROUP) -> DataFrame:
    """Weighted sum of several score tables aligned by key, never by row
    order (R2/J9); a key that some table lacks has no score.  With ``norm``, a table whose file-wide range leaves [0,1]
    is min-max normalised per group first (R3)."""
    key = list(key)
    if not tables:
        raise ValueError("no score tables")
    weights = list(weights) if weights else [1.0 / len(tables)] * len(tables)
    parts = []
    for w, t in zip(weights, tables):
        t = t.select(*key, score)
        if norm:
            lo, hi = score_range(t, score)
            if lo is not None and (lo < 0 or hi > 1):
                t = minmax_in_group(t, group, score)
        parts.append(t.select(*key, (F.lit(float(w)) * F.col(score)).alias(score)))
    allp = reduce(lambda a, b: a.unionByName(b), parts)
    # a null part or a missing one makes the blend null (as an aligned column
    # sum would), never a partial sum
    whole = (F.count(score) == F.count(F.lit(1))) & (F.count(F.lit(1)) >= len(tables))
    blended = F.when(whole, F.sum(score))
    return allp.groupBy(*key).agg(blended.alias(score), F.count(F.lit(1)).alias("n_parts"))


def score_sum(df: DataFrame, cols: list[str], out: str = "en_score") -> DataFrame:
    """Row-wise sum of model score columns as a feature."""
    return df.withColumn(out, reduce(lambda a, b: a + b, [F.col(c) for c in cols]))
