"""Vocabularies, encoders and scalers.

A vocabulary is a DataFrame ``(token, id, count)`` — never a driver dict.
PAD is id 0; real tokens are 1..n; OOV is n+1 unless stated.  Encoding is a
left join of the data with the vocabulary (broadcast when the vocabulary is
small, which Catalyst/AQE decide from its measured size) plus ``coalesce``.
Dense ids come from ``global_index`` so no single-partition window is used
even for a user vocabulary with hundreds of millions of ids.

Scalers fit with one aggregate and bring back one row of statistics.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankfold.functions.lists import pad_sequence, split_tokens
from rankfold.operators.index import dense_ids, global_index
from rankfold.operators.selection import values_at

PAD_ID = 0


def token_counts(df: DataFrame, col: str, explode: bool = False, splitter: str | None = None) -> DataFrame:
    """``(token, count)`` of non-null values, optionally of list elements or
    of split text (A9/A10: partial counts are merged by Spark's two-phase
    aggregation)."""
    c = F.col(col)
    if splitter is not None:
        c = split_tokens(c, splitter)
        explode = True
    tok = df.select(F.explode(c).alias("token")) if explode else df.select(c.alias("token"))
    return tok.where(F.col("token").isNotNull()).groupBy("token").agg(F.count(F.lit(1)).alias("count"))


def max_list_len(df: DataFrame, col: str, splitter: str | None = None) -> int:
    """Longest list (or split text) in a column: one aggregate."""
    c = split_tokens(col, splitter) if splitter is not None else F.col(col)
    return int(df.agg(F.max(F.size(c)).alias("m")).first()["m"] or 0)


def frequency_vocab(counts: DataFrame, min_count: int = 1, max_features: int | None = None,
                    na_value=None, start: int = 1, lower: bool = False) -> DataFrame:
    """Ids by descending count then token, from ``start``.

    As in the reference tokenizer, ``max_features`` keeps the most frequent
    entries *before* the minimum-count cut and the removal of ``na_value``.
    ``lower`` lower-cases the tokens after counting and ranking: spellings of
    one word keep their own places, and the last of them gives the id.
    """
    ranked = counts
    if max_features:
        # a top-k report: the limit is the feature; it sorts only k rows per task
        ranked = ranked.orderBy(F.desc("count"), F.asc("token")).limit(max_features)
    ranked = ranked.where(F.col("count") >= min_count)
    if na_value is not None:
        ranked = ranked.where(F.col("token") != F.lit(na_value))
    indexed = global_index(ranked, [F.desc("count"), F.asc("token")], "id", start)
    if not lower:
        return indexed
    rest = [F.max_by(c, "id").alias(c) for c in indexed.columns if c not in ("token", "id")]
    return (indexed.groupBy(F.lower("token").alias("token")).agg(*rest, F.max("id").alias("id"))
            .select(*indexed.columns))


def label_vocab(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-null values -> 1..n."""
    return dense_ids(df, col, "id", 1).withColumnRenamed(col, "token")


def vocab_size(vocab: DataFrame) -> int:
    """max id + 1 (PAD included): one number to the driver."""
    m = vocab.agg(F.max("id").alias("m")).first()["m"]
    return int(m if m is not None else PAD_ID) + 1


def encode_column(df: DataFrame, col: str, vocab: DataFrame, out: str | None = None,
                  default: int | Column | None = None, null_id: int | None = None) -> DataFrame:
    """Map ``col`` through the vocabulary; unseen -> ``default``; a NULL
    value -> ``null_id`` (or ``default`` when not given) (E1/E2/E7)."""
    out = out or col
    v = vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_id"))
    j = df.join(v, df[col] == v["_tok"], "left")
    unseen = F.lit(default) if not isinstance(default, Column) else default
    nid = F.lit(null_id) if null_id is not None else unseen
    val = F.when(F.col(col).isNull(), nid).otherwise(F.coalesce(F.col("_id"), unseen))
    return j.withColumn(out, val.cast("long")).drop("_tok", "_id")


def encode_list(df: DataFrame, row_key: list[str], col: str, vocab: DataFrame, max_len: int,
                oov: int | None = None, drop_oov: bool = False, na_value=None,
                padding: str = "post", truncating: str | None = None, out: str | None = None) -> DataFrame:
    """Encode every element of a list column and pad it.

    ``drop_oov`` removes unseen tokens (multi-hot rule of the news pipeline);
    otherwise they map to ``oov``.  ``na_value`` tokens become PAD.  Work is
    a posexplode, a join with the vocabulary and a per-row regroup by
    position, so one long list is never looked up against a driver map.
    """
    out = out or col
    v = vocab.select(F.col("token").alias("_tok"), F.col("id").alias("_id"))
    items = F.col(col)
    if not drop_oov:  # encoding keeps every element, so what padding cuts off is cut first
        cut = truncating or padding
        items = F.slice(items, F.greatest(F.lit(1), F.size(items) - max_len + 1), max_len) if cut == "pre" \
            else F.slice(items, 1, max_len)
    ex = df.select(*row_key, F.posexplode(items).alias("_p", "_t"))
    j = ex.join(v, ex["_t"] == v["_tok"], "left")
    if na_value is not None:
        idv = F.when(F.col("_t") == F.lit(na_value), F.lit(PAD_ID)).otherwise(F.coalesce("_id", F.lit(oov)))
    else:
        idv = F.coalesce(F.col("_id"), F.lit(oov))
    j = j.withColumn("_e", idv.cast("long"))
    if drop_oov:
        j = j.where(F.col("_id").isNotNull())
    lists = (j.groupBy(*row_key)
             .agg(F.array_sort(F.collect_list(F.struct("_p", "_e"))).alias("_l"))
             .select(*row_key, F.transform("_l", lambda x: x["_e"]).alias("_enc")))
    base = df.drop(col) if out == col else df
    res = base.join(lists, row_key, "left")
    return res.withColumn(out, pad_sequence("_enc", max_len, PAD_ID, padding, truncating)).drop("_enc")


def append_tokens(vocab: DataFrame, tokens: DataFrame, order: list[str], first_id: int,
                  descending: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Give tokens missing from ``vocab`` consecutive ids from ``first_id``,
    in ``order``; returns the merged ``(token, id)`` table and the number of
    new tokens (one count to the driver)."""
    src = tokens.select("token", *[F.col(c).alias(f"_o_{c}") for c in order])
    new = src.join(vocab.select("token"), "token", "left_anti")
    keys = [F.desc(f"_o_{c}") if c in descending else F.asc(f"_o_{c}") for c in order] + [F.asc("token")]
    new_ids = global_index(new, keys, "id", first_id).select("token", "id")
    n_new = new_ids.count()
    return vocab.select("token", "id").unionByName(new_ids), n_new


def update_vocab(vocab: DataFrame, oov_id: int, counts: DataFrame) -> tuple[DataFrame, int]:
    """Meta-feature vocabulary growing with a later split (E9): new tokens by
    descending count take ids from the old OOV id; OOV then moves past them."""
    merged, n = append_tokens(vocab, counts, ["count"], oov_id, descending=("count",))
    return merged, (oov_id + n if n > 0 else oov_id)


def merge_vocab(shared: DataFrame, shared_oov: int, other: DataFrame) -> tuple[DataFrame, int]:
    """Shared vocabulary merge (E10): tokens of ``other`` unknown to ``shared``
    take ids from the shared OOV id onward, in ``other``'s id order.  OOV is
    re-set to max id + 1 only when the largest id passed it — so with exactly
    one new token that token and OOV share an id, as in the reference."""
    merged, n = append_tokens(shared, other, ["id"], shared_oov)
    return merged, (shared_oov + n if n > 1 else shared_oov)


def expand_with_pretrained(vocab: DataFrame, oov_id: int, keys: DataFrame) -> DataFrame:
    """Append pretrained keys after the OOV id; OOV itself stays."""
    merged, _ = append_tokens(vocab, keys.select("token"), [], oov_id + 1)
    return merged


def vocab_from_size(spark, size: int) -> DataFrame:
    """Vocabulary known only by size: tokens 0..size-2 keep their number as id;
    id size-1 is left for unknown tokens (E12)."""
    return spark.range(0, max(0, size - 1)).select(F.col("id").alias("id"), F.col("id").cast("string").alias("token"))


# ---------------------------------------------------------- scalers -----

@dataclass
class ScalerModel:
    kind: str
    stats: dict[str, tuple[float, float]]
    fn: object = None

    def transform(self, df: DataFrame, clip: bool = False) -> DataFrame:
        cols = {}
        for c, (a, b) in self.stats.items():
            if self.kind == "callable":
                cols[c] = self.fn(F.col(c))
                continue
            if self.kind == "minmax":
                rng = (b - a) if (a is not None and b is not None and b != a) else 1.0
                v = (F.col(c) - F.lit(a)) / F.lit(rng)
                if clip:
                    v = F.when(v < 0, F.lit(0.0)).when(v > 1, F.lit(1.0)).otherwise(v)
            else:
                sd = b if (b is not None and b != 0) else 1.0
                v = (F.col(c) - F.lit(a)) / F.lit(sd)
            cols[c] = v
        return df.withColumns(cols)


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "minmax") -> ScalerModel:
    """One aggregate for all columns (E13/E15); a constant column maps to 0.
    The standard scaler uses the population standard deviation.  ``kind``
    may also be a ``Column -> Column`` function, applied as is (U5)."""
    if callable(kind):
        return ScalerModel("callable", {c: (None, None) for c in cols}, kind)
    if kind == "minmax":
        exprs = [e for c in cols for e in (F.min(c).alias(f"a_{c}"), F.max(c).alias(f"b_{c}"))]
    elif kind == "standard":
        exprs = [e for c in cols for e in (F.avg(c).alias(f"a_{c}"), F.stddev_pop(c).alias(f"b_{c}"))]
    else:
        raise ValueError(kind)
    row = df.agg(*exprs).first()
    return ScalerModel(kind, {c: (row[f"a_{c}"], row[f"b_{c}"]) for c in cols})


def exact_quantiles(df: DataFrame, col: str, levels: list[float]) -> list[float]:
    """Linear-interpolated quantiles (numpy's default) by weighted selection:
    equal values are one run, and only the two values that bracket each
    quantile leave the sorted runs."""
    def bracket(total: np.ndarray) -> np.ndarray:
        low = np.floor(np.outer(total - 1, levels)).astype(np.int64)
        return np.concatenate([low, np.minimum(low + 1, (total - 1)[:, None])], axis=1)

    vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    n, got = values_at(vals, "v", bracket)
    if n == 0:
        return [float("nan")] * len(levels)
    out = []
    for i, q in enumerate(levels):
        h, lo, hi = (n - 1) * q, got[i], got[len(levels) + i]
        out.append(lo + (h - math.floor(h)) * (hi - lo))
    return out


def quantile_boundaries(df: DataFrame, col: str, num_buckets: int) -> list[float]:
    """Interior quantile boundaries for ``num_buckets`` buckets."""
    levels = [i / num_buckets for i in range(1, num_buckets)]
    return exact_quantiles(df, col, levels)


def bucketize(col: str | Column, boundaries: list[float]) -> Column:
    """Bucket = number of boundaries <= value (0..len)."""
    c = F.col(col) if isinstance(col, str) else col
    b = F.array(*[F.lit(float(x)) for x in boundaries])
    return F.when(c.isNotNull(), F.size(F.filter(b, lambda x: x <= c.cast("double"))))
