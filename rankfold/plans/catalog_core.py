"""Sources, projections, scalar functions, explode/label, join, ranking and
submission queries (phase 0 and the minimum slice)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankfold.functions import scalar as S
from rankfold.operators import explode as X
from rankfold.operators import ranking as R
from rankfold.operators.joins import lookup_join
from rankfold.plans.oracle import ART, CAND, CAND_LABELED, EV, dur_s, epoch_s, with_
from rankfold.plans.registry import query, r6
from rankfold.sources import staging as st


def labeled_candidates(spark, sf):
    """Candidates with the membership label computed row-wise: an article is
    clicked in an impression when any of its lines there is clicked (a
    max over (impression, article), no per-impression list).  An impression's
    lines lie together already, so the maximum is a window over them: a
    map-side sum would hold a key for nearly every line of a scanned split."""
    from rankfold.operators.features import attach_stats
    c = st.candidate_lines(spark, sf)
    out = attach_stats(c, [(["impression_id", "article_id"], [("max", "line_label", "label")])], form="window")
    return out.withColumn("label", F.col("label").cast("int"))


def candidates(spark, sf):
    """Behaviors exploded to candidates with the membership label."""
    b = st.behaviors(spark, sf)
    c = X.explode_candidates(b.withColumn("session_len", F.size("article_ids_inview")))
    return X.label_candidates(c).drop("article_ids_clicked")


@query("explode_label", with_(CAND_LABELED) + """
SELECT c.impression_id, c.user_id, c.pos, c.article_id, CAST(c.label AS INTEGER) AS label,
       CAST(count(*) OVER (PARTITION BY c.impression_id) AS INTEGER) AS session_len
FROM cand_l c""")
def q_explode_label(spark, sf):
    c = candidates(spark, sf)
    return c.select("impression_id", "user_id", "pos", "article_id", "label", "session_len")


@query("session_len", """
SELECT o_orderkey AS impression_id, CAST(count(*) AS INTEGER) AS session_len,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS n_clicked
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def q_session_len(spark, sf):
    b = st.behaviors(spark, sf)
    return b.select("impression_id", F.size("article_ids_inview").alias("session_len"),
                    F.size("article_ids_clicked").alias("n_clicked"))


@query("join_articles", with_(CAND_LABELED, ART) + f"""
SELECT c.impression_id, c.pos, c.article_id, c.label, a.category, a.article_type,
       {dur_s('c.impression_time', 'a.published_time')} AS view_gap,
       CAST(a.total_inviews AS BIGINT) AS total_inviews
FROM cand_l c LEFT JOIN art a ON c.article_id = a.article_id""")
def q_join_articles(spark, sf):
    c = labeled_candidates(spark, sf)
    a = st.articles(spark, sf).select("article_id", "category", "article_type", "published_time",
                                      "total_inviews")
    j = lookup_join(c, a, "article_id")
    return j.select("impression_id", "pos", "article_id", "label", "category", "article_type",
                    S.duration_seconds("impression_time", "published_time").alias("view_gap"),
                    F.col("total_inviews").cast("long").alias("total_inviews"))


@query("article_ratios", with_(ART) + """
SELECT article_id,
       ROUND(CASE WHEN total_pageviews = 0 THEN NULL ELSE total_read_time / total_pageviews END, 6) AS read_pageviews,
       ROUND(CASE WHEN total_inviews = 0 THEN NULL ELSE total_read_time / total_inviews END, 6) AS read_inviews,
       CASE WHEN sentiment_label IS NULL THEN NULL WHEN sentiment_label = 'Positive' THEN 1 ELSE 0 END AS sentiment_label,
       CAST(premium AS INTEGER) AS premium, CAST(length(title) AS BIGINT) AS title_len,
       ROUND(CASE WHEN length(title) = 0 THEN NULL ELSE total_read_time / length(title) END, 6) AS read_time_word
FROM art""")
def q_article_ratios(spark, sf):
    a = S.length_features(st.articles(spark, sf), ["title"])
    a = S.ratio_features(a, words="title_len")
    return a.select("article_id", r6("read_pageviews").alias("read_pageviews"),
                    r6("read_inviews").alias("read_inviews"),
                    S.sentiment_to_int("sentiment_label").alias("sentiment_label"),
                    F.col("premium").cast("int").alias("premium"),
                    F.col("title_len").cast("long").alias("title_len"),
                    r6("read_time_word").alias("read_time_word"))


@query("time_features", with_(EV) + f"""
SELECT event_id, CAST(day(impression_time) AS INTEGER) AS day, CAST(hour(impression_time) AS INTEGER) AS hour,
       CAST(minute(impression_time) AS INTEGER) AS minute, CAST(isodow(impression_time) AS INTEGER) AS dayofweek,
       CAST(dayofyear(impression_time) AS INTEGER) AS dayofyear, {epoch_s('impression_time')} AS total_seconds,
       ROUND(CAST(CAST(hour(impression_time) + minute(impression_time) / 60.0 AS FLOAT) AS DOUBLE), 6) AS hour_minute,
       CAST(floor(hour(impression_time) / 6) AS INTEGER) AS "6hour",
       CAST(floor(hour(impression_time) / 12) AS INTEGER) AS "12hour",
       CAST(floor(((hour(impression_time) + 6) % 24) / 12) AS INTEGER) AS is_day,
       CAST(isodow(impression_time) * 24 + hour(impression_time) AS INTEGER) AS day_hour,
       CAST(isodow(impression_time) * 1440 + hour(impression_time) * 60 + minute(impression_time) AS INTEGER) AS day_minute
FROM ev""")
def q_time_features(spark, sf):
    ev = st.events_view(spark, sf)
    tf = S.time_feature_columns("impression_time")
    tf["hour_minute"] = r6(tf["hour_minute"])
    return ev.select("event_id", *[v.alias(k) for k, v in tf.items()])


@query("age_bucket", """
SELECT c_custkey, CAST(c_nationkey * 4 AS INTEGER) AS age,
       CASE WHEN c_nationkey * 4 < 1 OR c_nationkey * 4 > 95 THEN '' WHEN c_nationkey * 4 <= 10 THEN '1'
            WHEN c_nationkey * 4 <= 20 THEN '2' WHEN c_nationkey * 4 <= 30 THEN '3' WHEN c_nationkey * 4 <= 40 THEN '4'
            WHEN c_nationkey * 4 <= 50 THEN '5' WHEN c_nationkey * 4 <= 60 THEN '6' ELSE '7' END AS age_bucket
FROM customer""")
def q_age_bucket(spark, sf):
    c = st.table(spark, sf, "customer")
    age = (F.col("c_nationkey") * 4).cast("int")
    return c.select("c_custkey", age.alias("age"), S.age_bucket(age).alias("age_bucket"))


@query("log_bucket", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CAST(CASE WHEN l_quantity / 5.0 > 2 THEN floor(pow(ln(l_quantity / 5.0), 2)) ELSE trunc(l_quantity / 5.0) END AS BIGINT) AS qty_bucket,
       CAST(CASE WHEN l_extendedprice > 2 THEN floor(pow(ln(l_extendedprice), 2)) ELSE trunc(l_extendedprice) END AS BIGINT) AS price_bucket
FROM lineitem""")
def q_log_bucket(spark, sf):
    li = st.table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                     S.log_square_bucket(F.col("l_quantity") / 5.0).alias("qty_bucket"),
                     S.log_square_bucket("l_extendedprice").alias("price_bucket"))


@query("clip_log", """
SELECT p_partkey, ROUND(log10(1 + p_retailprice), 6) AS log_price,
       CAST(CASE WHEN p_size > 30 THEN 30 ELSE p_size END AS INTEGER) AS size_clip30,
       CAST(CASE WHEN p_size < 5 THEN 5 WHEN p_size > 40 THEN 40 ELSE p_size END AS INTEGER) AS size_clip_5_40
FROM part""")
def q_clip_log(spark, sf):
    p = st.table(spark, sf, "part")
    return p.select("p_partkey", r6(S.log1p10("p_retailprice")).alias("log_price"),
                    S.clip_max("p_size", 30).cast("int").alias("size_clip30"),
                    S.clip_range("p_size", 5, 40).cast("int").alias("size_clip_5_40"))


@query("yymmddhh_parts", """
WITH h AS (SELECT o_orderkey, strftime(o_orderdate, '%y%m%d%H') AS hour_str FROM orders),
d AS (SELECT *, strptime('20' || substring(hour_str, 1, 6), '%Y%m%d') AS dt FROM h)
SELECT o_orderkey, hour_str, CAST(dayofweek(dt) AS INTEGER) AS weekday,
       CASE WHEN dayofweek(dt) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
       CAST(substring(hour_str, 7, 2) AS INTEGER) AS hour
FROM d""")
def q_yymmddhh_parts(spark, sf):
    o = st.table(spark, sf, "orders")
    h = F.date_format("o_orderdate", "yyMMddHH")
    return o.select("o_orderkey", h.alias("hour_str"), S.yymmddhh_weekday(h).alias("weekday"),
                    S.yymmddhh_weekend(h).alias("weekend"), S.yymmddhh_hour(h).alias("hour"))


@query("country_code", """
SELECT doc_id, coalesce(substring(CASE WHEN doc_id % 7 = 0 THEN NULL ELSE source END, 1, 2), '') AS cc
FROM documents""")
def q_country_code(spark, sf):
    d = st.table(spark, sf, "documents")
    src = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise(F.col("source"))
    return d.select("doc_id", S.country_code(src).alias("cc"))


@query("rank_list", with_(CAND) + """
, r AS (SELECT impression_id, user_id, pos,
           row_number() OVER (PARTITION BY impression_id, user_id ORDER BY score_a DESC, pos) AS rnk FROM cand)
SELECT impression_id, user_id, '[' || string_agg(CAST(rnk AS VARCHAR), ',' ORDER BY pos) || ']' AS rank
FROM r GROUP BY impression_id, user_id""")
def q_rank_list(spark, sf):
    c = st.candidate_lines(spark, sf).withColumnRenamed("score_a", "score")
    return R.rank_lists(c)


@query("submission", with_(CAND) + """
, r AS (SELECT impression_id, user_id, pos,
           row_number() OVER (PARTITION BY impression_id, user_id ORDER BY score_b DESC, pos) AS rnk FROM cand)
SELECT CAST(impression_id AS VARCHAR) || ' [' || string_agg(CAST(rnk AS VARCHAR), ',' ORDER BY pos) || ']' AS line
FROM r GROUP BY impression_id, user_id""")
def q_submission(spark, sf):
    c = st.candidate_lines(spark, sf).withColumnRenamed("score_b", "score")
    return R.submission_lines(R.rank_lists(c))


@query("exclude_done", with_(CAND) + """
SELECT c.impression_id, c.pos, c.article_id FROM cand c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = c.impression_id AND o.o_orderstatus = 'F')""")
def q_exclude_done(spark, sf):
    from rankfold.sources.io import exclude_done
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "article_id")
    done = (st.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
            .select(F.col("o_orderkey").alias("impression_id")))
    return exclude_done(c, done, ["impression_id"])


@query("union_splits", with_(EV) + """
SELECT event_id, user_id, CASE WHEN day(impression_time) <= 10 THEN 'train'
       WHEN day(impression_time) <= 20 THEN 'valid' ELSE 'test' END AS split
FROM ev""")
def q_union_splits(spark, sf):
    from rankfold.sources.io import union_splits
    ev = st.events_view(spark, sf)
    d = F.dayofmonth("impression_time")
    parts = {"train": ev.filter(d <= 10), "valid": ev.filter((d > 10) & (d <= 20)), "test": ev.filter(d > 20)}
    return union_splits(parts).select("event_id", "user_id", "split")


@query("dedupe_deterministic", with_(EV) + f"""
SELECT article_id, arg_min(event_id, (impression_time, event_id)) AS event_id,
       arg_min(user_id, (impression_time, event_id)) AS user_id,
       {epoch_s('min(impression_time)')} AS first_seen
FROM ev GROUP BY article_id""")
def q_dedupe(spark, sf):
    from rankfold.operators.index import dedupe_by_key
    ev = st.events_view(spark, sf)
    d = dedupe_by_key(ev, ["article_id"], ["impression_time", "event_id"])
    return d.select("article_id", "event_id", "user_id",
                    S.epoch_seconds("impression_time").alias("first_seen"))


@query("score_sum", with_(CAND) + """
SELECT impression_id, pos, ROUND(score_a + score_c + quantity, 6) AS en_score FROM cand""")
def q_score_sum(spark, sf):
    c = st.candidate_lines(spark, sf)
    s = R.score_sum(c, ["score_a", "score_c", "quantity"])
    return s.select("impression_id", "pos", r6("en_score").alias("en_score"))


@query("blend_scores", with_(CAND) + """
SELECT impression_id, user_id, article_id, pos, ROUND(0.7 * score_a + 0.3 * score_c, 6) AS score
FROM cand""")
def q_blend_scores(spark, sf):
    c = st.candidate_lines(spark, sf)
    key = ["impression_id", "user_id", "article_id", "pos"]
    t1 = c.select(*key, F.col("score_a").alias("score"))
    t2 = c.select(*key, F.col("score_c").alias("score"))
    b = R.blend_scores([t1, t2], [0.7, 0.3], key=key)
    return b.select(*key, r6("score").alias("score"))


@query("blend_norm", with_(CAND) + """
, n AS (SELECT *, (score_b - min(score_b) OVER (PARTITION BY impression_id, user_id))
        / NULLIF(max(score_b) OVER (PARTITION BY impression_id, user_id)
                 - min(score_b) OVER (PARTITION BY impression_id, user_id), 0) AS nb FROM cand)
SELECT impression_id, user_id, article_id, pos, ROUND(0.5 * score_a + 0.5 * nb, 6) AS score
FROM n""")
def q_blend_norm(spark, sf):
    c = st.candidate_lines(spark, sf)
    key = ["impression_id", "user_id", "article_id", "pos"]
    t1 = c.select(*key, F.col("score_a").alias("score"))   # inside [0,1]: left as is
    t2 = c.select(*key, F.col("score_b").alias("score"))   # prices: normalised per impression
    b = R.blend_scores([t1, t2], None, key=key, norm=True)
    return b.select(*key, r6("score").alias("score"))


@query("score_files_blend", with_(CAND) + """
SELECT impression_id, user_id, pos, ROUND(0.25 * score_a + 0.75 * score_c, 6) AS en_score FROM cand""")
def q_score_files_blend(spark, sf):
    """Two model-score tables written as CSV files (S9) into the shared
    folder, read back side by side by key (S4) and summed with weights (R4)."""
    from rankfold.sources.io import read_score_files, write_csv
    from rankfold.streaming.stream_ops import stream_folder
    c = st.candidate_lines(spark, sf)
    key = ["impression_id", "user_id", "pos"]
    base = stream_folder(spark, "score_files")
    write_csv(c.select(*key, F.col("score_a").alias("score")), f"{base}/dnn_a")
    write_csv(c.select(*key, F.col("score_c").alias("score")), f"{base}/dnn_b")
    s = read_score_files(spark, {"a": f"{base}/dnn_a", "b": f"{base}/dnn_b"}, key,
                         schema="impression_id long, user_id long, pos long, score double")
    s = s.withColumns({"a": F.col("a") * 0.25, "b": F.col("b") * 0.75})
    return R.score_sum(s, ["a", "b"]).select(*key, r6("en_score").alias("en_score"))
