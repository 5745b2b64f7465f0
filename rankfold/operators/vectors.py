"""Vector operators as table jobs.

* Pooling over an unbounded group (all clicks of a user) is done in
  dimension-exploded form: ``(group, dim) -> sum`` is an algebraic aggregate
  with map-side combine, so a user holding a third of the rows is reduced
  before the shuffle; the vector is reassembled from ``d`` values.
* Operators that read a *bounded* per-row sequence (the last ``max_len``
  items a model sees: LSH top-k, collision pooling, attention) are per-row
  higher-order array expressions — no join, no pairs across rows.
* Random projections for LSH come from a seeded generator (a parameter),
  rounded so every engine sees the same literals.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------- array algebra ---

def dot(a: ColumnOrName, b: ColumnOrName) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def vec_sum(vectors: ColumnOrName, dim: int) -> Column:
    """Element-wise sum of an array of vectors (per row)."""
    zero = F.array_repeat(F.lit(0.0), dim)
    return F.aggregate(_c(vectors), zero, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y))


def vec_scale(v: ColumnOrName, s: Column) -> Column:
    return F.transform(_c(v), lambda x: x * s)


# ------------------------------------------------ pooling over groups ---

def _vec_sum_agg(c: Column) -> Column:
    """Per-group element-wise sum of a double array column: Spark ML's vector
    summarizer, a JVM aggregate with partial (map-side) aggregation."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    return vector_to_array(Summarizer.sum(array_to_vector(c)))


def pool_vectors(df: DataFrame, group: list[str], vec: str, mode: str = "mean",
                 out: str = "pooled") -> DataFrame:
    """Masked sum / average pooling of the vectors of each group (V2/V3).

    Average = sum / (number of non-zero vectors + 1e-12): zero vectors are
    padding, as in the reference's mask-by-zeros rule.  Sums are a partial
    aggregate, so a group holding a third of the rows is combined map-side.
    """
    v = F.col(vec).cast("array<double>")
    nz = (F.aggregate(v, F.lit(0.0), lambda a, x: a + x) != 0).cast("double")
    g = df.groupBy(*group).agg(_vec_sum_agg(v).alias("_s"), F.sum(nz).alias("_n"))
    if mode == "mean":
        return g.select(*group, F.transform("_s", lambda x: x / (F.col("_n") + F.lit(1e-12))).alias(out))
    return g.select(*group, F.col("_s").alias(out))


def fm_group_interaction(df: DataFrame, group: list[str], vec: str) -> DataFrame:
    """FM second-order term over all field vectors of a group:
    ``0.5 * ((Σv)² − Σv²)`` per dimension (``bi_interaction``) and its sum
    (``product_sum``) (V4), from two partial vector sums."""
    v = F.col(vec).cast("array<double>")
    g = df.groupBy(*group).agg(_vec_sum_agg(v).alias("_s"),
                               _vec_sum_agg(F.transform(v, lambda x: x * x)).alias("_q"))
    bi = F.zip_with("_s", "_q", lambda a, b: F.lit(0.5) * (a * a - b))
    g = g.select(*group, bi.alias("bi_interaction"))
    return g.withColumn("product_sum", F.aggregate("bi_interaction", F.lit(0.0), lambda acc, x: acc + x))


# --------------------------------------------------- per-row field ops ---

def split_fields(vec: ColumnOrName, n_fields: int, width: int) -> Column:
    """Cut one vector into ``n_fields`` field vectors of ``width``."""
    return F.array(*[F.slice(_c(vec), i * width + 1, width) for i in range(n_fields)])


def fm_interaction(fields: ColumnOrName, dim: int) -> tuple[Column, Column]:
    """Per row: ``(bi_interaction, product_sum)`` of an array of field vectors."""
    s = vec_sum(fields, dim)
    sq = vec_sum(F.transform(_c(fields), lambda v: F.transform(v, lambda x: x * x)), dim)
    bi = F.zip_with(s, sq, lambda a, b: F.lit(0.5) * (a * a - b))
    return bi, F.aggregate(bi, F.lit(0.0), lambda acc, x: acc + x)


def pairwise_inner(fields: ColumnOrName, n_fields: int) -> Column:
    """Inner products of field pairs i < j, row-major (V5).  The pairs are
    fixed by the schema's field count, not by data."""
    f = _c(fields)
    pairs = [(i, j) for i in range(n_fields) for j in range(i + 1, n_fields)]
    return F.array(*[dot(f[i], f[j]) for i, j in pairs])


def pairwise_elementwise(fields: ColumnOrName, n_fields: int) -> Column:
    f = _c(fields)
    pairs = [(i, j) for i in range(n_fields) for j in range(i + 1, n_fields)]
    return F.array(*[F.zip_with(f[i], f[j], lambda x, y: x * y) for i, j in pairs])


# ------------------------------------------------------------- top-k ----

def topk_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per group in ``order``.  Spark limits each group to ``k``
    rows per task before the shuffle, so a hot group reaches the ranking task
    as at most ``k`` rows from each input task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


# -------------------------------------------------------------- LSH -----

def random_rotations(dim: int, n_hashes: int, bits: int, seed: int = 2024, decimals: int = 4) -> np.ndarray:
    """Seeded Gaussian projections, shape (n_hashes, bits, dim)."""
    rng = np.random.default_rng(seed)
    return np.round(rng.standard_normal((n_hashes, bits, dim)), decimals)


def _lit_vec(v) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def lsh_buckets(vec: ColumnOrName, rotations: np.ndarray) -> Column:
    """Bucket id per hash: Σ_b [v·r_b > 0]·2^b (V7).  Array of n_hashes ints."""
    v = _c(vec)
    out = []
    for h in range(rotations.shape[0]):
        terms = [F.when(dot(v, _lit_vec(rotations[h, b])) > 0, F.lit(1 << b)).otherwise(F.lit(0))
                 for b in range(rotations.shape[1])]
        out.append(reduce(lambda a, b: a + b, terms))
    return F.array(*out)


def hamming_topk(target_code: ColumnOrName, codes: ColumnOrName, mask: ColumnOrName, k: int,
                 bits: int) -> Column:
    """Positions (0-based) of the k history items closest to the target in
    Hamming distance of their codes (V8).  Masked slots score the worst
    similarity (−bits) as in the reference; ties go to real items, then to
    the earlier position."""
    t = _c(target_code)
    scored = F.transform(F.arrays_zip(_c(codes).alias("c"), _c(mask).alias("m")), lambda x, i: F.struct(
        F.when(x["m"] > 0, -F.bit_count(x["c"].bitwiseXOR(t))).otherwise(F.lit(-bits)).alias("sim"),
        x["m"].alias("m"), i.alias("i")))
    srt = F.array_sort(scored, lambda l, r: F.when(l["sim"] != r["sim"], r["sim"] - l["sim"])
                       .when(l["m"] != r["m"], r["m"] - l["m"]).otherwise(l["i"] - r["i"]))
    return F.transform(F.slice(srt, 1, k), lambda s: s["i"])


def _bucket_hit(tb: Column, h: int):
    return lambda x: (x["m"] > 0) & (x["b"][h] == tb[h])


def collision_pool(target_buckets: ColumnOrName, hist_buckets: ColumnOrName, hist_vecs: ColumnOrName,
                   mask: ColumnOrName, n_hashes: int, dim: int) -> Column:
    """Mean over hashes of the sum of history vectors whose bucket equals the
    target's bucket for that hash (V9)."""
    tb, hb, hv, m = _c(target_buckets), _c(hist_buckets), _c(hist_vecs), _c(mask)
    items = F.arrays_zip(hb.alias("b"), hv.alias("v"), m.alias("m"))
    per_hash = [vec_sum(F.transform(F.filter(items, _bucket_hit(tb, h)), lambda x: x["v"]), dim)
                for h in range(n_hashes)]
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), per_hash)
    return F.transform(total, lambda x: x / F.lit(float(n_hashes)))


def softmax_attend(df: DataFrame, q: str, keys: str, values: str, mask: str, dim: int,
                   scale: float | None = None, out: str = "attended") -> DataFrame:
    """softmax(q·k / scale) over the row's keys (masked -> -1e9), times V.

    Each intermediate array is its own projection: Spark does not collapse
    projections that would re-evaluate a higher-order function, so scores,
    their max and the normaliser are computed once per row."""
    s = F.transform(F.arrays_zip(F.col(keys).alias("k"), F.col(mask).alias("m")), lambda x: F.when(
        x["m"] > 0, dot(F.col(q), x["k"]) / F.lit(scale or 1.0)).otherwise(F.lit(-1e9)))
    step = df.withColumn("_s", s)
    step = step.withColumn("_e", F.transform("_s", lambda x: F.exp(x - F.array_max(F.col("_s")))))
    step = step.withColumn("_z", F.aggregate("_e", F.lit(0.0), lambda acc, x: acc + x))
    step = step.withColumn("_w", F.transform("_e", lambda x: x / F.col("_z")))
    weighted = F.zip_with("_w", values, lambda w, v: F.transform(v, lambda x: x * w))
    return step.withColumn(out, vec_sum(weighted, dim)).drop("_s", "_e", "_z", "_w")


# -------------------------------------------------------------- PCA -----

def pca(df: DataFrame, vec: str, k: int, out: str = "pca") -> DataFrame:
    """Centred PCA to k dimensions (V1): Spark ML's PCA does not centre, so a
    mean-only StandardScaler runs first.  A component's sign is fixed: its
    loading of largest size (the first of equals) is positive.  The d x d
    covariance and the d x k components are all that the driver holds (d = vector
    width)."""
    import numpy as np
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = df.withColumn("_vec", array_to_vector(F.col(vec).cast("array<double>")))
    centred = StandardScaler(withMean=True, withStd=False, inputCol="_vec", outputCol="_c").fit(v).transform(v)
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    loadings = model.pc.toArray()
    top = loadings[np.abs(loadings).argmax(axis=0), np.arange(k)]
    signs = F.array(*[F.lit(-1.0 if x < 0 else 1.0) for x in top])
    fixed = F.zip_with(vector_to_array("_p"), signs, lambda x, s: x * s)
    return model.transform(centred).withColumn(out, fixed).drop("_vec", "_c", "_p")
