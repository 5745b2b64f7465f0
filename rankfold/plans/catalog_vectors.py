"""Vector queries (phase 7): pooling, FM interaction, field products, k-max,
two-tower top-k, LSH buckets / top-k / collision pooling, attention, PCA."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankfold.functions.lists import kmax_in_order
from rankfold.operators import sequence as Q
from rankfold.operators import vectors as V
from rankfold.plans.oracle import EV, with_
from rankfold.plans.registry import query
from rankfold.sources import staging as st

DIM = 64
HIST = 10
N_FIELDS, FIELD_W = 4, 16
TOPK_BITS = 8
POOL_HASHES, POOL_BITS = 4, 3


def rv(c):
    """Round every element of a double array to 6 decimals."""
    return F.transform(F.col(c) if isinstance(c, str) else c, lambda x: F.round(x, 6) + 0.0)


def _rsql(expr):
    return f"list_transform({expr}, lambda x: round(x, 6) + 0.0)"


VEC = """vec AS (SELECT vec_id AS article_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"""
VEC_DIMS = VEC + """,
vd AS (SELECT article_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM vec)"""


def _user_vectors(spark, sf):
    ev = st.events_view(spark, sf).select("user_id", "article_id")
    return ev.join(st.vectors(spark, sf).select("article_id", "embedding"), "article_id")


# ------------------------------------------------------------- pooling --

@query("avg_pool", with_(EV, VEC_DIMS) + """
, nz AS (SELECT article_id, CASE WHEN list_sum(v) <> 0 THEN 1.0 ELSE 0.0 END AS nzf FROM vec),
u AS (SELECT ev.user_id, vd.d, sum(vd.x) AS s, sum(nz.nzf) AS n
      FROM ev JOIN vd ON ev.article_id = vd.article_id JOIN nz ON ev.article_id = nz.article_id GROUP BY 1, 2)
SELECT user_id, list(round(s / (n + 1e-12), 6) + 0.0 ORDER BY d) AS pooled FROM u GROUP BY user_id""")
def q_avg_pool(spark, sf):
    p = V.pool_vectors(_user_vectors(spark, sf), ["user_id"], "embedding", "mean")
    return p.select("user_id", rv("pooled").alias("pooled"))


@query("sum_pool", with_(EV, VEC_DIMS) + """
, u AS (SELECT ev.user_id, vd.d, sum(vd.x) AS s FROM ev JOIN vd ON ev.article_id = vd.article_id GROUP BY 1, 2)
SELECT user_id, list(round(s, 6) + 0.0 ORDER BY d) AS pooled FROM u GROUP BY user_id""")
def q_sum_pool(spark, sf):
    p = V.pool_vectors(_user_vectors(spark, sf), ["user_id"], "embedding", "sum")
    return p.select("user_id", rv("pooled").alias("pooled"))


@query("fm_interaction", with_(EV, VEC_DIMS) + """
, u AS (SELECT ev.user_id, vd.d, 0.5 * (sum(vd.x) * sum(vd.x) - sum(vd.x * vd.x)) AS bi
        FROM ev JOIN vd ON ev.article_id = vd.article_id GROUP BY 1, 2)
SELECT user_id, list(round(bi, 6) + 0.0 ORDER BY d) AS bi_interaction, round(sum(bi), 6) + 0.0 AS product_sum
FROM u GROUP BY user_id""")
def q_fm_interaction(spark, sf):
    g = V.fm_group_interaction(_user_vectors(spark, sf), ["user_id"], "embedding")
    return g.select("user_id", rv("bi_interaction").alias("bi_interaction"),
                    (F.round("product_sum", 6) + 0.0).alias("product_sum"))


def _pair_sql():
    sl = lambda i: f"v[{i * FIELD_W + 1}:{(i + 1) * FIELD_W}]"
    dots = [f"round(list_dot_product({sl(i)}, {sl(j)}), 6) + 0.0"
            for i in range(N_FIELDS) for j in range(i + 1, N_FIELDS)]
    bis = (f"list_transform(range(1, {FIELD_W + 1}), lambda k: round(0.5 * ("
           + " + ".join(f"{sl(i)}[k]" for i in range(N_FIELDS)) + ") * ("
           + " + ".join(f"{sl(i)}[k]" for i in range(N_FIELDS)) + ") - 0.5 * ("
           + " + ".join(f"{sl(i)}[k] * {sl(i)}[k]" for i in range(N_FIELDS)) + "), 6) + 0.0)")
    return with_(VEC) + f"SELECT article_id, [{', '.join(dots)}] AS inner_products, {bis} AS bi_fields FROM vec"


@query("pairwise_inner", _pair_sql())
def q_pairwise_inner(spark, sf):
    v = st.vectors(spark, sf)
    fields = V.split_fields("embedding", N_FIELDS, FIELD_W)
    bi, _ = V.fm_interaction(fields, FIELD_W)
    return v.select("article_id", rv(V.pairwise_inner(fields, N_FIELDS)).alias("inner_products"),
                    rv(bi).alias("bi_fields"))


@query("kmax_list", with_(VEC_DIMS) + """
, r AS (SELECT article_id, d, x, row_number() OVER (PARTITION BY article_id ORDER BY x DESC, d) AS rk FROM vd)
SELECT article_id, list(round(x, 6) + 0.0 ORDER BY d) AS top5 FROM r WHERE rk <= 5 GROUP BY article_id""")
def q_kmax_list(spark, sf):
    v = st.vectors(spark, sf)
    return v.select("article_id", rv(kmax_in_order("embedding", 5)).alias("top5"))


# ------------------------------------------------------ two-tower top-k --

@query("dot_topk", with_(EV, VEC_DIMS) + """
, nz AS (SELECT article_id, CASE WHEN list_sum(v) <> 0 THEN 1.0 ELSE 0.0 END AS nzf FROM vec),
u AS (SELECT ev.user_id, vd.d, sum(vd.x) AS s, sum(nz.nzf) AS n
      FROM ev JOIN vd ON ev.article_id = vd.article_id JOIN nz ON ev.article_id = nz.article_id GROUP BY 1, 2),
uv AS (SELECT user_id, list(s / (n + 1e-12) ORDER BY d) AS uvec FROM u GROUP BY user_id),
pairs AS (SELECT DISTINCT user_id, article_id FROM ev),
sc AS (SELECT p.user_id, p.article_id, list_dot_product(uv.uvec, vec.v) AS score
       FROM pairs p JOIN uv ON p.user_id = uv.user_id JOIN vec ON p.article_id = vec.article_id),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, article_id) AS rank FROM sc)
SELECT user_id, CAST(rank AS INTEGER) AS rank, article_id, round(score, 6) + 0.0 AS score FROM r WHERE rank <= 3""")
def q_dot_topk(spark, sf):
    uv = _user_vectors(spark, sf)
    users = V.pool_vectors(uv, ["user_id"], "embedding", "mean", out="uvec")
    pairs = st.events_view(spark, sf).select("user_id", "article_id").distinct()
    vecs = st.vectors(spark, sf).select("article_id", "embedding")
    sc = (pairs.join(users, "user_id").join(vecs, "article_id")
          .withColumn("score", V.dot("uvec", "embedding")))
    top = V.topk_per_group(sc.select("user_id", "article_id", "score"), ["user_id"],
                           [F.col("score").desc(), F.col("article_id").asc()], 3)
    return top.select("user_id", "rank", "article_id", (F.round("score", 6) + 0.0).alias("score"))


# ----------------------------------------------------------------- LSH --

def _rot_topk():
    return V.random_rotations(DIM, 1, TOPK_BITS, seed=11)


def _rot_pool():
    return V.random_rotations(DIM, POOL_HASHES, POOL_BITS, seed=23)


def _code_sql(vec_expr, rot, h):
    terms = []
    for b in range(rot.shape[1]):
        lit = "[" + ", ".join(repr(float(x)) for x in rot[h, b]) + "]::DOUBLE[]"
        terms.append(f"(CASE WHEN list_dot_product({vec_expr}, {lit}) > 0 THEN {1 << b} ELSE 0 END)")
    return "(" + " + ".join(terms) + ")"


@query("lsh_bucket", with_(VEC) + "SELECT article_id, ["
       + ", ".join(_code_sql("v", _rot_pool(), h) for h in range(POOL_HASHES)) + "] AS buckets FROM vec")
def q_lsh_bucket(spark, sf):
    v = st.vectors(spark, sf)
    return v.select("article_id", V.lsh_buckets("embedding", _rot_pool()).alias("buckets"))


def user_frames(spark, sf):
    """Per user: the last event's article vector (target) and the previous
    HIST article vectors, pre-padded with zero vectors (mask 0)."""
    ev = st.events_view(spark, sf).select("user_id", "article_id", "impression_time", "event_id")
    pos = Q.positions(ev, ["user_id"], ["impression_time", "event_id"])
    last = pos.where(F.col("seq_pos") >= F.col("seq_n") - (HIST + 1))
    last = last.withColumn("slot", F.col("seq_pos") - F.col("seq_n") + (HIST + 1))
    j = last.join(st.vectors(spark, sf).select("article_id", "embedding"), "article_id")
    g = j.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", "embedding"))).alias("m"))
    slots = F.sequence(F.lit(0), F.lit(HIST - 1))
    zero = F.array_repeat(F.lit(0.0), DIM)
    return g.select(
        "user_id",
        F.element_at("m", F.lit(HIST).cast("long")).alias("target"),
        F.transform(slots, lambda i: F.coalesce(F.element_at(F.col("m"), i.cast("long")), zero)).alias("hist"),
        F.transform(slots, lambda i: F.when(F.map_contains_key(F.col("m"), i.cast("long")), 1).otherwise(0))
        .alias("mask"))


FRAME_SQL = with_(EV, VEC) + f""",
rb AS (SELECT user_id, article_id, row_number() OVER (PARTITION BY user_id ORDER BY impression_time DESC, event_id DESC) AS r
       FROM ev),
tg AS (SELECT rb.user_id, vec.v AS target FROM rb JOIN vec ON rb.article_id = vec.article_id WHERE r = 1),
us AS (SELECT DISTINCT user_id FROM ev),
slots AS (SELECT us.user_id, s.slot FROM us, range(0, {HIST}) s(slot)),
hi AS (SELECT rb.user_id, {HIST + 1} - rb.r AS slot, vec.v FROM rb JOIN vec ON rb.article_id = vec.article_id
       WHERE rb.r BETWEEN 2 AND {HIST + 1}),
fr AS (SELECT slots.user_id, slots.slot, coalesce(hi.v, list_resize([]::DOUBLE[], {DIM}, 0.0)) AS v,
              CASE WHEN hi.v IS NULL THEN 0 ELSE 1 END AS m
       FROM slots LEFT JOIN hi ON slots.user_id = hi.user_id AND slots.slot = hi.slot)"""


@query("lsh_topk", FRAME_SQL + f"""
, c AS (SELECT fr.user_id, fr.slot, fr.m, {_code_sql('fr.v', _rot_topk(), 0)} AS code,
               {_code_sql('tg.target', _rot_topk(), 0)} AS tcode FROM fr JOIN tg ON fr.user_id = tg.user_id),
s AS (SELECT user_id, slot, m, CASE WHEN m > 0 THEN -bit_count(xor(code, tcode)) ELSE -{TOPK_BITS} END AS sim FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sim DESC, m DESC, slot) AS rk FROM s)
SELECT user_id, list(CAST(slot AS INTEGER) ORDER BY rk) AS top5 FROM r WHERE rk <= 5 GROUP BY user_id""")
def q_lsh_topk(spark, sf):
    rot = _rot_topk()
    fr = (user_frames(spark, sf).withColumn("tcode", V.lsh_buckets("target", rot)[0])
          .withColumn("codes", F.transform("hist", lambda v: V.lsh_buckets(v, rot)[0])))
    return fr.select("user_id", V.hamming_topk("tcode", "codes", "mask", 5, TOPK_BITS).alias("top5"))


def _pool_sql():
    rot = _rot_pool()
    bk = lambda e: "[" + ", ".join(_code_sql(e, rot, h) for h in range(POOL_HASHES)) + "]"
    return FRAME_SQL + f"""
, b AS (SELECT fr.user_id, fr.slot, fr.m, fr.v, {bk('fr.v')} AS hb, {bk('tg.target')} AS tb
        FROM fr JOIN tg ON fr.user_id = tg.user_id),
hh AS (SELECT b.*, h.h FROM b, range(1, {POOL_HASHES + 1}) h(h)),
hit AS (SELECT user_id, v FROM hh WHERE m > 0 AND hb[h] = tb[h]),
dims AS (SELECT user_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM hit),
agg AS (SELECT user_id, d, sum(x) / {float(POOL_HASHES)} AS s FROM dims GROUP BY 1, 2),
full_ AS (SELECT us.user_id, dd.d, coalesce(agg.s, 0.0) AS s
          FROM (SELECT DISTINCT user_id FROM tg) us, range(1, {DIM + 1}) dd(d)
          LEFT JOIN agg ON agg.user_id = us.user_id AND agg.d = dd.d)
SELECT user_id, list(round(s, 6) + 0.0 ORDER BY d) AS pooled FROM full_ GROUP BY user_id"""


@query("lsh_collision_pool", _pool_sql())
def q_lsh_collision_pool(spark, sf):
    rot = _rot_pool()
    # bucket arrays are materialised once per row, then shared by every hash
    fr = (user_frames(spark, sf).withColumn("tb", V.lsh_buckets("target", rot))
          .withColumn("hb", F.transform("hist", lambda v: V.lsh_buckets(v, rot))))
    pooled = V.collision_pool("tb", "hb", "hist", "mask", POOL_HASHES, DIM)
    return fr.select("user_id", rv(pooled).alias("pooled"))


@query("softmax_attend", FRAME_SQL + f"""
, sc AS (SELECT fr.user_id, fr.slot, fr.v,
                CASE WHEN fr.m > 0 THEN list_dot_product(tg.target, fr.v) / 8.0 ELSE -1e9 END AS s
         FROM fr JOIN tg ON fr.user_id = tg.user_id),
e AS (SELECT *, exp(s - max(s) OVER (PARTITION BY user_id)) AS e FROM sc),
w AS (SELECT *, e / sum(e) OVER (PARTITION BY user_id) AS a FROM e),
dims AS (SELECT user_id, a, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM w),
agg AS (SELECT user_id, d, sum(a * x) AS o FROM dims GROUP BY 1, 2)
SELECT user_id, list(round(o, 6) + 0.0 ORDER BY d) AS attended FROM agg GROUP BY user_id""")
def q_softmax_attend(spark, sf):
    fr = user_frames(spark, sf)
    out = V.softmax_attend(fr, "target", "hist", "hist", "mask", DIM, scale=8.0)
    return out.select("user_id", rv("attended").alias("attended"))


@query("pca64")
def q_pca(spark, sf):
    """Rows-only: a component's sign is arbitrary."""
    v = st.vectors(spark, sf)
    return V.pca(v, "embedding", 64).select("article_id", "pca")


@query("pca16")
def q_pca16(spark, sf):
    """64 dimensions reduced to 16, signs fixed; tested against numpy (V1)."""
    return V.pca(st.vectors(spark, sf), "embedding", 16).select("article_id", "pca")
