"""Feature specs, layout, type narrowing, feature selection and the
fit/transform encoder (S12, P17-P19, E6, E18, E19).

Feature metadata (names, types, vocabulary sizes, offsets) is bounded by
the schema, not by the data, so it lives on the driver as small tables; the
vocabulary sizes inside it come from one aggregate per vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankfold.operators import encode as E

# --------------------------------------------------------- specs (P17) --


def expand_specs(specs: list[dict]) -> list[dict]:
    """A spec whose ``name`` is a list stands for one spec per name (P17);
    inactive specs (``active: false``) are dropped."""
    out = []
    for s in specs:
        names = s["name"] if isinstance(s["name"], list) else [s["name"]]
        for n in names:
            if s.get("active", True):
                out.append({**s, "name": n})
    return out


# ------------------------------------------------------ feature map (S12) --

FEATURE_MAP_SCHEMA = ("feature string, type string, source string, vocab_size long, max_len long, "
                      "padding_idx long, oov_idx long")


def feature_map(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """One row per feature.  ``entries`` items: ``name``, ``type``
    (``categorical``/``sequence``/``numeric``/``meta``), ``source``,
    optional ``vocab`` (a vocabulary DataFrame), ``max_len``.  Vocabulary
    size and OOV id come from the vocabulary by one aggregate each."""
    rows = []
    for e in entries:
        vs = oov = pad = None
        if e.get("vocab") is not None:
            oov = E.vocab_size(e["vocab"])
            vs, pad = oov + 1, 0
        rows.append((e["name"], e["type"], e.get("source", ""), vs, e.get("max_len"), pad, oov))
    return spark.createDataFrame(rows, FEATURE_MAP_SCHEMA)


def restrict_and_override(fmap: DataFrame, use_features: DataFrame | None = None,
                          overrides: DataFrame | None = None) -> DataFrame:
    """Keep only ``use_features`` (a one-column ``feature`` table) and replace
    spec fields given in ``overrides`` (feature + any subset of fields)."""
    out = fmap if use_features is None else fmap.join(use_features.select("feature"), "feature", "left_semi")
    if overrides is not None:
        o = overrides.select("feature", *[F.col(c).alias(f"_o_{c}") for c in overrides.columns if c != "feature"])
        out = out.join(o, "feature", "left")
        for c in [c for c in overrides.columns if c != "feature"]:
            out = out.withColumn(c, F.coalesce(F.col(f"_o_{c}"), F.col(c))).drop(f"_o_{c}")
    return out


# ------------------------------------------------------- layout (E18) --

def layout(entries: list[dict]) -> dict:
    """Column offsets (a sequence takes ``max_len`` slots), field counts per
    source and the total width, in feature order."""
    offsets, pos = {}, 0
    per_source: dict[str, int] = {}
    for e in entries:
        offsets[e["name"]] = pos
        pos += int(e.get("max_len") or 1) if e["type"] == "sequence" else 1
        if e["type"] != "meta":
            per_source[e.get("source", "")] = per_source.get(e.get("source", ""), 0) + 1
    return {"offsets": offsets, "total_features": pos,
            "num_fields": sum(per_source.values()), "num_fields_by_source": per_source}


def remap_false_ids(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """``remap=False`` tokenizer: the id is the token read as an integer."""
    return df.withColumn(out or col, F.col(col).cast("long"))


# ------------------------------------------------ type narrowing (P18) --

_INT_LADDER = [("tinyint", -128, 127), ("smallint", -32768, 32767),
               ("int", -2147483648, 2147483647)]
_FLOAT32_MAX = 3.4028234663852886e38


def narrowed_types(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``(column, type)``: the smallest type whose range strictly contains
    the column's min and max (one aggregate for all columns)."""
    num = [c for c, t in df.dtypes if (cols is None or c in cols)
           and t in ("tinyint", "smallint", "int", "bigint", "float", "double")]
    row = df.agg(*[e for c in num for e in (F.min(c).alias(f"a_{c}"), F.max(c).alias(f"b_{c}"))]).first()
    kinds = dict(df.dtypes)
    out = []
    for c in num:
        lo, hi = row[f"a_{c}"], row[f"b_{c}"]
        if lo is None:
            out.append((c, kinds[c]))
            continue
        if kinds[c] in ("float", "double"):
            out.append((c, "float" if (lo > -_FLOAT32_MAX and hi < _FLOAT32_MAX) else "double"))
            continue
        t = next((name for name, mn, mx in _INT_LADDER if lo > mn and hi < mx), "bigint")
        out.append((c, t))
    return df.sparkSession.createDataFrame(out, "column string, type string")


def narrow(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    types = {r["column"]: r["type"] for r in narrowed_types(df, cols).collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})


# ------------------------------- feature lists (P2, P20) and order (O3) --

# Identity, time and raw clock columns that no model is trained on.
TRAINING_DROP = ["impression_id", "user_id", "article_id", "impression_time", "published_time", "last_modified_time",
                 "day", "hour", "minute", "dayofweek", "dayofyear", "total_seconds"]


def select_features(df: DataFrame, features: list[str], keys: list[str] = ()) -> DataFrame:
    """The columns of ``features`` and ``keys`` that ``df`` has, in the order
    of its columns (P2); names that it lacks are no error."""
    wanted = {*features, *keys}
    return df.select(*[c for c in df.columns if c in wanted])


def drop_columns(df: DataFrame, names: list[str] = TRAINING_DROP) -> DataFrame:
    """``df`` without the columns of a drop-list (P20)."""
    return df.drop(*names)


def sort_importances(importance: DataFrame) -> DataFrame:
    """(feature, importance, place): most important first, ties by name (O3).
    One row per feature column: bounded by the schema, not by the data."""
    order = Window.orderBy(F.desc("importance"), F.asc("feature"))
    return importance.select("feature", "importance", F.row_number().over(order).alias("place"))


# --------------------------------------------- feature selection (P19) --

def top_features(importance: DataFrame, k: int, existing: list[str] = (),
                 exclude_suffix: str = "_score") -> DataFrame:
    """Of the ``k`` most important features, those that are neither already
    present nor model scores (P19): the cut comes first, so fewer than ``k``
    may be left.  A top-k report: the limit is the feature."""
    top = importance.orderBy(F.desc("importance"), F.asc("feature")).limit(k)
    return top.where(~F.col("feature").isin(list(existing)) & ~F.col("feature").endswith(exclude_suffix))


# ------------------------------------------------ fit / transform (E19) --

@dataclass
class EncoderModel:
    vocabs: dict[str, tuple[DataFrame, int]] = field(default_factory=dict)
    scaler: E.ScalerModel | None = None
    sequences: dict[str, tuple[DataFrame, int, int, str]] = field(default_factory=dict)

    def transform(self, df: DataFrame, row_key: list[str]) -> DataFrame:
        out = df
        for c, (v, oov) in self.vocabs.items():
            out = E.encode_column(out, c, v, default=oov)
        if self.scaler is not None:
            out = self.scaler.transform(out)
        for c, (v, oov, max_len, splitter) in self.sequences.items():
            from rankfold.functions.lists import split_tokens
            out = out.withColumn(c, split_tokens(c, splitter))
            out = E.encode_list(out, row_key, c, v, max_len, oov=oov, na_value="", padding="pre")
        return out


def fit_encoder(train: DataFrame, categorical: list[str] = (), numeric: list[str] = (),
                sequences: dict[str, dict] | None = None, min_count: int = 1,
                normalizer: str = "minmax") -> EncoderModel:
    """Fit vocabularies (categorical and sequence) and a scaler on the train
    split; the model transforms train/valid/test alike (E19/E3)."""
    m = EncoderModel()
    for c in categorical:
        v = E.frequency_vocab(E.token_counts(train, c), min_count=min_count)
        m.vocabs[c] = (v, E.vocab_size(v))
    if numeric:
        m.scaler = E.fit_scaler(train, list(numeric), normalizer)
    for c, opt in (sequences or {}).items():
        v = E.frequency_vocab(E.token_counts(train, c, splitter=opt.get("splitter", " ")),
                              min_count=opt.get("min_count", min_count), na_value="")
        max_len = opt.get("max_len") or E.max_list_len(train, c, opt.get("splitter", " "))
        m.sequences[c] = (v, E.vocab_size(v), max_len, opt.get("splitter", " "))
    return m


def unpivot(df: DataFrame, cols: list[str], ids: list[str] = (), name: str = "feature",
            value: str = "value") -> DataFrame:
    """Long ``(feature, value)`` form of several numeric columns: one scan
    (an Expand), not one scan per column."""
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return cast.unpivot(list(ids), list(cols), name, value)
