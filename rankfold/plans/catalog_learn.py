"""Model training / scoring queries (phase 8).  Rows-only checks: a trained
model has no SQL twin."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankfold.functions.scalar import duration_days, ntz_lit
from rankfold.operators import learn as LN
from rankfold.operators import ranking as R
from rankfold.operators.field_encoder import FieldEncoder, field_vectors
from rankfold.operators.listwise import fit_listwise
from rankfold.plans import catalog_build
from rankfold.plans.registry import query
from rankfold.session import written
from rankfold.sources import staging as st
from rankfold.streaming.stream_ops import stream_folder

KEY = ["impression_id", "pos"]
FEATURES = ["score_a", "score_c", "quantity", "total_inviews", "total_read_time", "view_days", "pos",
            "session_len"]
CUT_VALID = datetime(1996, 1, 1)
CUT_TEST = datetime(1997, 6, 1)


def feature_table(spark, sf):
    """Candidates with numeric features, the click label and a time split.

    The impression's length is counted where its lines lie for their positions:
    a line is shuffled by its impression and by its article, no third time."""
    c = st.candidate_lines(spark, sf).withColumn("session_len", F.count(F.lit(1)).over(Window.partitionBy("impression_id")))
    art = st.articles(spark, sf).select("article_id", "total_inviews", "total_read_time", "published_time",
                                        "article_type")
    j = c.join(art, "article_id", "left")
    j = j.withColumns({"view_days": duration_days("impression_time", "published_time").cast("double"),
                       "label": F.col("line_label").cast("double"),
                       "split": F.when(F.col("impression_time") < ntz_lit(CUT_VALID), "train")
                       .when(F.col("impression_time") < ntz_lit(CUT_TEST), "valid").otherwise("test")})
    return LN.prepare(j, FEATURES)


def _parts(f):
    return (f.where(F.col("split") == "train"), f.where(F.col("split") == "valid"),
            f.where(F.col("split") == "test"))


def _splits(spark, sf):
    return _parts(feature_table(spark, sf))


def _written_splits(spark, sf):
    """The same with the models' columns, written once: a fit and a score pass
    over them several times.  Boosted trees then sample the rows in the order in
    which the files are read."""
    f = feature_table(spark, sf).select(*dict.fromkeys([*KEY, *FEATURES, "label", "split"]))
    return _parts(written(f, "features"))


def _round(df):
    return df.select(*KEY, F.round("score", 6).alias("score"))


@query("gbt_scores")
def q_gbt_scores(spark, sf):
    train, _, test = _splits(spark, sf)
    m = LN.gbt(FEATURES, max_depth=4, max_iter=10).fit(train)
    return _round(LN.score(m, test, KEY))


@query("importances")
def q_importances(spark, sf):
    train, _, _ = _splits(spark, sf)
    m = LN.gbt(FEATURES, max_depth=4, max_iter=10).fit(train)
    return LN.importances(m, FEATURES)


@query("pairwise_rank_scores")
def q_pairwise(spark, sf):
    train, _, test = _written_splits(spark, sf)
    m = LN.fit_pairwise(train, ["impression_id"], FEATURES)
    return _round(LN.pairwise_scores(m, test, KEY, FEATURES))


@query("stacked_scores")
def q_stacked(spark, sf):
    train, valid, test = _written_splits(spark, sf)
    make = lambda feats, label: LN.gbt(feats, label, max_depth=3, max_iter=5)
    return _round(LN.stack_two_stage(train, valid, test, FEATURES, KEY, make=make))


@query("lr_scores")
def q_lr(spark, sf):
    """Numbers and the one-hot article type."""
    train, _, test = _splits(spark, sf)
    enc = FieldEncoder(keyCols=KEY, categorical=["article_type"]).fit(train)
    train, test = (field_vectors(enc.transform(part), enc, FEATURES) for part in (train, test))
    return _round(LN.score(LN.on_vectors("logistic").fit(train), test, KEY))


@query("fm_scores")
def q_fm(spark, sf):
    train, _, test = _splits(spark, sf)
    m = LN.factorization_machine(FEATURES).fit(train)
    return _round(LN.score(m, test, KEY))


@query("mlp_scores")
def q_mlp(spark, sf):
    train, _, test = _splits(spark, sf)
    m = LN.mlp(FEATURES).fit(train)
    return _round(LN.score(m, test, KEY))


@query("model_select")
def q_model_select(spark, sf):
    train, _, _ = _splits(spark, sf)
    tvs = LN.select_model(train, FEATURES, depths=(2, 3), iters=(3, 5))
    rows = [(str({p.name: v for p, v in pm.items()}), float(m))
            for pm, m in zip(tvs.getEstimatorParamMaps(), tvs.validationMetrics)]
    return spark.createDataFrame(rows, "params string, auc double")


@query("listwise_rank_scores")
def q_listwise(spark, sf):
    """Boosted trees on listwise gradients per impression (L2)."""
    train, _, test = _splits(spark, sf)
    model = fit_listwise(train, ["impression_id"], FEATURES, rounds=8, max_depth=4)
    return _round(model.score(test, KEY))


# Fields of the one-hot models; user and article ids are the large vocabularies.
MODEL_FIELDS = ["user_id", "article_id", "brand", "part_type", "priority", "segment", "nation"]


def encoded_splits(spark, sf):
    """(encoder, train, test) with one sparse vector of all fields; the rows are
    written once for the encoder and both splits."""
    rows = written(catalog_build.field_rows(spark, sf).select(*KEY, "split", "label", "price", *MODEL_FIELDS), "model-rows")
    train = rows.where(F.col("split") == "train")
    encoder = FieldEncoder(keyCols=KEY, categorical=MODEL_FIELDS, numeric=["price"], minCount=2).fit(train)
    vectors = [field_vectors(encoder.transform(part), encoder, ["price"]) for part in (train, rows.where(F.col("split") == "test"))]
    return encoder, vectors[0].select("label", "features"), vectors[1].select(*KEY, "features")


@query("lr_field_scores")
def q_lr_fields(spark, sf):
    """Logistic regression on seven one-hot fields and a number (L4)."""
    _, train, test = encoded_splits(spark, sf)
    return _round(LN.score(LN.on_vectors("logistic", reg=0.01).fit(train), test, KEY))


@query("fm_field_scores")
def q_fm_fields(spark, sf):
    """Factorization machine on the same fields."""
    _, train, test = encoded_splits(spark, sf)
    return _round(LN.score(LN.on_vectors("fm", factor_size=4, max_iter=30).fit(train), test, KEY))


@query("model_submission")
def q_model_submission(spark, sf):
    """From a model's scores to the written submission, read back."""
    train, _, test = _splits(spark, sf)
    scores = LN.score(LN.gbt(FEATURES, max_depth=3, max_iter=5).fit(train), test, [*KEY, "user_id"])
    path = stream_folder(spark, "model-submission")
    R.write_submission(R.submission_lines(R.rank_lists(scores)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")
