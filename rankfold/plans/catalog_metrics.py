"""Ranking metrics queries (phase 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankfold.operators import metrics as M
from rankfold.plans.catalog_core import labeled_candidates
from rankfold.plans.oracle import CAND_LABELED, with_
from rankfold.plans.registry import query, r6
from rankfold.sources import staging as st


def scored(spark, sf):
    """Labeled candidates with model-score stand-ins: ``score`` = l_discount
    (11 distinct values: heavy ties) and ``prob`` = 10 * l_discount."""
    c = labeled_candidates(spark, sf)
    return c.select("impression_id", "user_id", "pos", "label", F.col("score_a").alias("score"),
                    (F.col("score_a") * 10).alias("prob"))


_T = with_(CAND_LABELED) + """
, t AS (SELECT impression_id, user_id, pos, label AS y, score_a AS s, score_a * 10 AS p FROM cand_l)"""


def _group_auc_sql(group: str) -> str:
    return _T + f"""
, r AS (SELECT {group} AS g, y, rank() OVER (PARTITION BY {group} ORDER BY s) AS rk,
               count(*) OVER (PARTITION BY {group}, s) AS tc FROM t),
m AS (SELECT g, sum(y) AS np, sum(1 - y) AS nn, count(*) AS n,
             sum(CASE WHEN y = 1 THEN rk + (tc - 1) / 2.0 ELSE 0 END) AS sr FROM r GROUP BY g),
a AS (SELECT g, n, CASE WHEN np > 0 AND nn > 0 THEN (sr - np * (np + 1) / 2.0) / (np * nn) END AS auc FROM m)"""


@query("auc", _T + """
, r AS (SELECT y, rank() OVER (ORDER BY s) AS rk, count(*) OVER (PARTITION BY s) AS tc FROM t),
m AS (SELECT sum(y) AS np, sum(1 - y) AS nn, sum(CASE WHEN y = 1 THEN rk + (tc - 1) / 2.0 ELSE 0 END) AS sr FROM r)
SELECT ROUND((sr - np * (np + 1) / 2.0) / (np * nn), 6) AS auc FROM m""")
def q_auc(spark, sf):
    return M.auc(scored(spark, sf)).select(r6("auc").alias("auc"))


@query("logloss", _T + """
SELECT ROUND(avg(-(y * ln(least(greatest(p, 1e-7), 1 - 1e-7))
                  + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7)))), 6) AS logloss FROM t""")
def q_logloss(spark, sf):
    return M.logloss(scored(spark, sf), score="prob").select(r6("logloss").alias("logloss"))


@query("avg_auc", _group_auc_sql("impression_id") + "\nSELECT ROUND(avg(auc), 6) AS avg_auc FROM a")
def q_avg_auc(spark, sf):
    return M.avg_auc(scored(spark, sf), ["impression_id"]).select(r6("avg_auc").alias("avg_auc"))


@query("gauc", _group_auc_sql("user_id")
       + "\nSELECT ROUND(sum(auc * n) FILTER (WHERE auc IS NOT NULL) / sum(n) FILTER (WHERE auc IS NOT NULL), 6)"
         " AS gauc FROM a")
def q_gauc(spark, sf):
    return M.weighted_gauc(scored(spark, sf), ["user_id"]).select(r6("gauc").alias("gauc"))


@query("gauc_skewsafe", _group_auc_sql("user_id")
       + "\nSELECT ROUND(sum(auc * n) FILTER (WHERE auc IS NOT NULL) / sum(n) FILTER (WHERE auc IS NOT NULL), 6)"
         " AS gauc FROM a")
def q_gauc_skewsafe(spark, sf):
    """The same metric with the segmented prefix sum forced on."""
    g = M.weighted_gauc(scored(spark, sf), ["user_id"], strategy="chunked")
    return g.select(r6("gauc").alias("gauc"))


@query("impression_auc", _group_auc_sql("impression_id")
       + "\nSELECT ROUND(avg(coalesce(auc, 1.0)), 6) AS impression_auc FROM a")
def q_impression_auc(spark, sf):
    return M.impression_auc(scored(spark, sf), ["impression_id"]).select(r6("impression_auc").alias("impression_auc"))


_RANKED = _T + """
, r AS (SELECT *, row_number() OVER (PARTITION BY impression_id ORDER BY s DESC, pos) AS rk,
               row_number() OVER (PARTITION BY impression_id ORDER BY y DESC, pos) AS irk FROM t)"""


@query("mrr", _RANKED + """
, g AS (SELECT impression_id, sum(y / rk) / (sum(y) + 1e-12) AS m FROM r GROUP BY impression_id)
SELECT ROUND(avg(m), 6) AS mrr FROM g""")
def q_mrr(spark, sf):
    return M.mrr(scored(spark, sf), ["impression_id"]).select(r6("mrr").alias("mrr"))


@query("ndcg_5", _RANKED + """
, g AS (SELECT impression_id,
          sum(CASE WHEN rk <= 5 THEN (pow(2, y) - 1) / log2(rk + 1) ELSE 0 END) AS dcg,
          sum(CASE WHEN irk <= 5 THEN (pow(2, y) - 1) / log2(irk + 1) ELSE 0 END) AS idcg
        FROM r GROUP BY impression_id)
SELECT ROUND(avg(dcg / (idcg + 1e-12)), 6) AS ndcg_5 FROM g""")
def q_ndcg(spark, sf):
    return M.ndcg(scored(spark, sf), ["impression_id"], 5).select(r6("ndcg_5").alias("ndcg_5"))


@query("metric_dispatch", _RANKED + """
, tc AS (SELECT *, rank() OVER (ORDER BY s) AS grk, count(*) OVER (PARTITION BY s) AS gtc,
                rank() OVER (PARTITION BY impression_id ORDER BY s) AS irank,
                count(*) OVER (PARTITION BY impression_id, s) AS itc FROM r),
a AS (SELECT impression_id, count(*) AS n, sum(y) AS np, sum(1 - y) AS nn,
        sum(CASE WHEN y = 1 THEN irank + (itc - 1) / 2.0 ELSE 0 END) AS sr, sum(y / rk) / (sum(y) + 1e-12) AS m,
        sum(CASE WHEN rk <= 5 THEN (pow(2, y) - 1) / log2(rk + 1) ELSE 0 END) AS dcg5,
        sum(CASE WHEN irk <= 5 THEN (pow(2, y) - 1) / log2(irk + 1) ELSE 0 END) AS idcg5,
        sum(CASE WHEN rk <= 1 THEN pow(2, y) - 1 ELSE 0 END) / (max(pow(2, y) - 1) + 1e-12) AS n1
      FROM tc GROUP BY impression_id),
g AS (SELECT *, CASE WHEN np > 0 AND nn > 0 THEN (sr - np * (np + 1) / 2.0) / (np * nn) END AS auc FROM a),
t1 AS (SELECT avg(-(y * ln(least(greatest(s, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(s, 1e-7), 1 - 1e-7)))) AS ll,
         (sum(CASE WHEN y = 1 THEN grk + (gtc - 1) / 2.0 ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS auc
       FROM tc)
SELECT (SELECT ROUND(ll, 6) FROM t1) AS logloss, (SELECT ROUND(auc, 6) FROM t1) AS auc, ROUND(avg(auc), 6) AS avg_auc,
       ROUND(sum(auc * n) FILTER (WHERE auc IS NOT NULL) / sum(n) FILTER (WHERE auc IS NOT NULL), 6) AS gauc,
       ROUND(avg(m), 6) AS mrr, ROUND(avg(dcg5 / (idcg5 + 1e-12)), 6) AS ndcg_5, ROUND(avg(n1), 6) AS ndcg_1 FROM g""")
def q_metric_dispatch(spark, sf):
    """Every metric of the dispatcher from one pass over its input."""
    row = M.evaluate(scored(spark, sf), ["logloss", "AUC", "avgAUC", "gAUC", "MRR", "NDCG@5", "NDCG"], ["impression_id"])
    return row.select("logloss", F.col("AUC").alias("auc"), F.col("avgAUC").alias("avg_auc"), F.col("gAUC").alias("gauc"),
                      F.col("MRR").alias("mrr"), F.col("NDCG@5").alias("ndcg_5"), F.col("NDCG").alias("ndcg_1")).select(
        *[r6(c).alias(c) for c in ("logloss", "auc", "avg_auc", "gauc", "mrr", "ndcg_5", "ndcg_1")])


@query("multi_task_metrics", """
WITH t AS (SELECT l.quality, l.toxic, (d.n_chars % 1000) / 1000.0 AS s1, (d.n_chars % 997) / 997.0 AS s2
           FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
u AS (SELECT 'quality' AS task, quality AS y, s1 AS s FROM t UNION ALL SELECT 'toxic', toxic, s2 FROM t),
r AS (SELECT task, y, s, rank() OVER (PARTITION BY task ORDER BY s) AS rk,
             count(*) OVER (PARTITION BY task, s) AS tc FROM u),
m AS (SELECT task, sum(y) AS np, sum(1 - y) AS nn,
             sum(CASE WHEN y = 1 THEN rk + (tc - 1) / 2.0 ELSE 0 END) AS sr,
             avg(-(y * ln(least(greatest(s, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(s, 1e-7), 1 - 1e-7)))) AS ll
      FROM r GROUP BY task),
a AS (SELECT task, (sr - np * (np + 1) / 2.0) / (np * nn) AS auc, ll FROM m)
SELECT task, ROUND(auc, 6) AS auc, ROUND(ll, 6) AS logloss FROM a
UNION ALL SELECT 'mean', ROUND(avg(auc), 6), ROUND(avg(ll), 6) FROM a""")
def q_multi_task(spark, sf):
    lab = st.table(spark, sf, "labels")
    d = st.table(spark, sf, "documents").select("doc_id", "n_chars")
    t = lab.join(d, "doc_id").select(
        "quality", "toxic", ((F.col("n_chars") % 1000) / 1000.0).alias("s1"),
        ((F.col("n_chars") % 997) / 997.0).alias("s2"))
    out = M.multi_task(t, ["quality", "toxic"], {"quality": "s1", "toxic": "s2"})
    return out.select("task", r6("AUC").alias("auc"), r6("logloss").alias("logloss"))


@query("metric_monitor", _T + """
, r AS (SELECT y, rank() OVER (ORDER BY s) AS rk, count(*) OVER (PARTITION BY s) AS tc FROM t),
m AS (SELECT sum(y) AS np, sum(1 - y) AS nn, sum(CASE WHEN y = 1 THEN rk + (tc - 1) / 2.0 ELSE 0 END) AS sr FROM r),
l AS (SELECT avg(-(y * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - y) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7)))) AS ll FROM t)
SELECT ROUND(1.0 * (sr - np * (np + 1) / 2.0) / (np * nn) - 0.5 * ll, 6) AS monitor FROM m, l""")
def q_metric_monitor(spark, sf):
    s = scored(spark, sf)
    row = M.evaluate(s.withColumn("score", F.col("prob")), ["AUC", "logloss"])
    return M.monitor_value(row, {"AUC": 1.0, "logloss": -0.5}).select(r6("monitor").alias("monitor"))
