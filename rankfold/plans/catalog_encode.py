"""Encoders, vocabularies, scalers, ids, splits, lists and sequences
(phases 3-5)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rankfold.functions import lists as L
from rankfold.functions.scalar import epoch_seconds, hash_bucket, log1p10, ntz_lit
from rankfold.operators import encode as E
from rankfold.operators import index as I
from rankfold.operators import sequence as Q
from rankfold.operators.explode import explode_parallel, strip_suffix
from rankfold.plans.oracle import ART, CAND, EV, epoch_s, with_
from rankfold.plans.registry import query, r6
from rankfold.sources import staging as st

CUT_TRAIN = datetime(2024, 1, 10)
CUT_VALID = datetime(2024, 1, 20)


# --------------------------------------------------------- label / freq --

@query("label_encode", with_(EV) + """
, v AS (SELECT user_id AS token, row_number() OVER (ORDER BY user_id) AS id
        FROM (SELECT DISTINCT user_id FROM ev WHERE day(impression_time) <= 5 AND user_id IS NOT NULL))
SELECT ev.event_id, CAST(coalesce(v.id, 0) AS BIGINT) AS user_code FROM ev LEFT JOIN v ON ev.user_id = v.token""")
def q_label_encode(spark, sf):
    ev = st.events_view(spark, sf)
    vocab = E.label_vocab(ev.where(F.dayofmonth("impression_time") <= 5), "user_id")
    enc = E.encode_column(ev, "user_id", vocab, out="user_code", default=0, null_id=0)
    return enc.select("event_id", "user_code")


@query("freq_vocab", with_(EV) + """
, c AS (SELECT article_id AS token, count(*) AS count FROM ev WHERE article_id IS NOT NULL GROUP BY 1)
SELECT token, count, row_number() OVER (ORDER BY count DESC, token) AS id FROM c WHERE count >= 100""")
def q_freq_vocab(spark, sf):
    ev = st.events_view(spark, sf)
    v = E.frequency_vocab(E.token_counts(ev, "article_id"), min_count=100)
    return v.select("token", "count", "id")


@query("freq_encode", with_(CAND, ART) + """
, c AS (SELECT cand.*, art.article_type FROM cand LEFT JOIN art ON cand.article_id = art.article_id),
cnt AS (SELECT article_type AS token, count(*) AS n FROM c
        WHERE impression_time < TIMESTAMP '1996-01-01' AND article_type IS NOT NULL GROUP BY 1),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM cnt WHERE n >= 10),
o AS (SELECT count(*) + 1 AS oov FROM v)
SELECT c.impression_id, c.pos, CAST(coalesce(v.id, o.oov) AS BIGINT) AS type_id
FROM c CROSS JOIN o LEFT JOIN v ON c.article_type = v.token""")
def q_freq_encode(spark, sf):
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "article_id", "impression_time")
    art = st.articles(spark, sf).select("article_id", "article_type")
    c = c.join(art, "article_id", "left")
    train = c.where(F.col("impression_time") < ntz_lit(datetime(1996, 1, 1)))
    vocab = E.frequency_vocab(E.token_counts(train, "article_type"), min_count=10)
    oov = E.vocab_size(vocab)
    enc = E.encode_column(c, "article_type", vocab, out="type_id", default=oov)
    return enc.select("impression_id", "pos", "type_id")


@query("multihot_pad", """
WITH b AS (SELECT l_orderkey AS impression_id, l_partkey AS tok,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                      l_extendedprice, l_shipdate, l_returnflag, l_discount, l_tax, l_quantity) AS pos
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
cnt AS (SELECT tok, count(*) AS n FROM b GROUP BY tok),
v AS (SELECT tok, row_number() OVER (ORDER BY n DESC, tok) AS id FROM cnt WHERE n >= 20),
e AS (SELECT b.impression_id, list(v.id ORDER BY b.pos) FILTER (WHERE v.id IS NOT NULL) AS l
      FROM b LEFT JOIN v ON b.tok = v.tok GROUP BY b.impression_id),
t AS (SELECT impression_id, coalesce(l, [])[1:5] AS l FROM e)
SELECT impression_id, CAST(list_concat(l, list_resize([]::BIGINT[], 5 - len(l), 0)) AS BIGINT[]) AS inview_ids FROM t""")
def q_multihot_pad(spark, sf):
    b = st.behaviors(spark, sf).select("impression_id", "article_ids_inview")
    vocab = E.frequency_vocab(E.token_counts(b, "article_ids_inview", explode=True), min_count=20)
    enc = E.encode_list(b, ["impression_id"], "article_ids_inview", vocab, 5, drop_oov=True,
                        padding="post", out="inview_ids")
    return enc.select("impression_id", "inview_ids")


_TOKEN_SQL = """
WITH toks AS (SELECT doc_id, unnest(string_split(text, ' ')) AS token,
                     generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents),
cnt AS (SELECT token, count(*) AS count FROM toks GROUP BY token),
top AS (SELECT * FROM cnt ORDER BY count DESC, token LIMIT 5000),
v AS (SELECT token, count, row_number() OVER (ORDER BY count DESC, token) AS id
      FROM top WHERE count >= 2 AND token <> '')"""


def _doc_vocab(spark, sf):
    d = st.table(spark, sf, "documents").select("doc_id", "text")
    counts = E.token_counts(d, "text", splitter=" ")
    return d, E.frequency_vocab(counts, min_count=2, max_features=5000, na_value="")


@query("token_vocab", _TOKEN_SQL + "\nSELECT token, count, id FROM v")
def q_token_vocab(spark, sf):
    _, v = _doc_vocab(spark, sf)
    return v.select("token", "count", "id")


@query("encode_sequence", _TOKEN_SQL + """,
o AS (SELECT count(*) + 1 AS oov FROM v),
e AS (SELECT t.doc_id, list(CASE WHEN t.token = '' THEN 0 ELSE coalesce(v.id, o.oov) END ORDER BY t.pos) AS l
      FROM toks t CROSS JOIN o LEFT JOIN v ON t.token = v.token GROUP BY t.doc_id),
c AS (SELECT doc_id, CASE WHEN len(l) > 16 THEN l[len(l) - 15:] ELSE l END AS l FROM e)
SELECT doc_id, CAST(list_concat(list_resize([]::BIGINT[], 16 - len(l), 0), l) AS BIGINT[]) AS seq FROM c""")
def q_encode_sequence(spark, sf):
    d, v = _doc_vocab(spark, sf)
    oov = E.vocab_size(v)
    toks = d.select("doc_id", L.split_tokens("text", " ").alias("toks"))
    enc = E.encode_list(toks, ["doc_id"], "toks", v, 16, oov=oov, na_value="", padding="pre", out="seq")
    return enc.select("doc_id", "seq")


# ------------------------------------------------ vocabulary evolution --

_MERGE_SQL = with_(CAND, EV) + """
, ca AS (SELECT article_id AS token, count(*) AS n FROM cand GROUP BY 1),
sh AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM ca WHERE n >= 40),
eo AS (SELECT article_id AS token, count(*) AS n FROM ev WHERE article_id IS NOT NULL GROUP BY 1),
ot AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM eo),
so AS (SELECT count(*) + 1 AS oov FROM sh),
nw AS (SELECT ot.token, so.oov + row_number() OVER (ORDER BY ot.id, ot.token) - 1 AS id
       FROM ot CROSS JOIN so WHERE ot.token NOT IN (SELECT token FROM sh)),
nn AS (SELECT count(*) AS k FROM nw)
SELECT CAST(token AS VARCHAR) AS token, CAST(id AS BIGINT) AS id FROM sh
UNION ALL SELECT CAST(token AS VARCHAR), CAST(id AS BIGINT) FROM nw
UNION ALL SELECT '__OOV__', CAST(CASE WHEN nn.k > 1 THEN so.oov + nn.k ELSE so.oov END AS BIGINT) FROM so, nn"""


@query("vocab_merge", _MERGE_SQL)
def q_vocab_merge(spark, sf):
    c = st.candidate_lines(spark, sf)
    ev = st.events_view(spark, sf)
    shared = E.frequency_vocab(E.token_counts(c, "article_id"), min_count=40)
    other = E.frequency_vocab(E.token_counts(ev, "article_id"))
    merged, oov = E.merge_vocab(shared, E.vocab_size(shared), other)
    out = merged.select(F.col("token").cast("string").alias("token"), "id")
    return out.unionByName(spark.createDataFrame([("__OOV__", oov)], "token string, id long"))


@query("vocab_extend", with_(EV) + """
, c AS (SELECT article_id AS token, count(*) AS n FROM ev WHERE article_id IS NOT NULL GROUP BY 1),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM c WHERE n >= 100),
o AS (SELECT count(*) + 1 AS oov FROM v),
k AS (SELECT DISTINCT vec_id AS token FROM embeddings WHERE vec_id NOT IN (SELECT token FROM v)),
nw AS (SELECT k.token, o.oov + row_number() OVER (ORDER BY k.token) AS id FROM k CROSS JOIN o)
SELECT token, CAST(id AS BIGINT) AS id FROM v UNION ALL SELECT token, CAST(id AS BIGINT) FROM nw""")
def q_vocab_extend(spark, sf):
    ev = st.events_view(spark, sf)
    v = E.frequency_vocab(E.token_counts(ev, "article_id"), min_count=100)
    keys = st.table(spark, sf, "embeddings").select(F.col("vec_id").alias("token")).distinct()
    return E.expand_with_pretrained(v, E.vocab_size(v), keys).select("token", "id")


@query("meta_encode", with_(EV) + """
, tr AS (SELECT user_id AS token, count(*) AS n FROM ev WHERE day(impression_time) <= 10 GROUP BY 1),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM tr),
o AS (SELECT count(*) + 1 AS oov FROM v),
te AS (SELECT user_id AS token, count(*) AS n FROM ev WHERE day(impression_time) > 20 GROUP BY 1),
nw AS (SELECT te.token, o.oov + row_number() OVER (ORDER BY te.n DESC, te.token) - 1 AS id
       FROM te CROSS JOIN o WHERE te.token NOT IN (SELECT token FROM v)),
allv AS (SELECT token, id FROM v UNION ALL SELECT token, id FROM nw),
o2 AS (SELECT o.oov + (SELECT count(*) FROM nw) AS oov FROM o)
SELECT ev.event_id, CAST(coalesce(allv.id, o2.oov) AS BIGINT) AS user_meta_id
FROM ev CROSS JOIN o2 LEFT JOIN allv ON ev.user_id = allv.token WHERE day(ev.impression_time) > 20""")
def q_meta_encode(spark, sf):
    ev = st.events_view(spark, sf)
    d = F.dayofmonth("impression_time")
    v = E.frequency_vocab(E.token_counts(ev.where(d <= 10), "user_id"))
    test = ev.where(d > 20)
    v2, oov2 = E.update_vocab(v, E.vocab_size(v), E.token_counts(test, "user_id"))
    enc = E.encode_column(test, "user_id", v2, out="user_meta_id", default=oov2)
    return enc.select("event_id", "user_meta_id")


# ---------------------------------------------------------- scalers -----

@query("minmax_scale", """
WITH p AS (SELECT p_partkey, log10(1 + p_retailprice) AS lp, CAST(p_size AS DOUBLE) AS sz FROM part),
s AS (SELECT min(lp) a1, max(lp) b1, min(sz) a2, max(sz) b2 FROM p)
SELECT p_partkey, ROUND((lp - a1) / CASE WHEN b1 = a1 THEN 1 ELSE b1 - a1 END, 6) AS price_scaled,
       ROUND((sz - a2) / CASE WHEN b2 = a2 THEN 1 ELSE b2 - a2 END, 6) AS size_scaled FROM p, s""")
def q_minmax_scale(spark, sf):
    p = st.table(spark, sf, "part").select("p_partkey", log1p10("p_retailprice").alias("price_scaled"),
                                           F.col("p_size").cast("double").alias("size_scaled"))
    m = E.fit_scaler(p, ["price_scaled", "size_scaled"], "minmax")
    out = m.transform(p)
    return out.select("p_partkey", r6("price_scaled").alias("price_scaled"), r6("size_scaled").alias("size_scaled"))


@query("minmax_clip", """
WITH s AS (SELECT min(o_totalprice) a, max(o_totalprice) b FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'),
x AS (SELECT o_orderkey, (o_totalprice - a) / CASE WHEN b = a THEN 1 ELSE b - a END AS v FROM orders, s)
SELECT o_orderkey, ROUND(CASE WHEN v < 0 THEN 0 WHEN v > 1 THEN 1 ELSE v END, 6) AS price_scaled FROM x""")
def q_minmax_clip(spark, sf):
    o = st.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.col("o_totalprice").alias("price_scaled"))
    m = E.fit_scaler(o.where(F.col("o_orderdate") < ntz_lit(datetime(1996, 1, 1))), ["price_scaled"], "minmax")
    out = m.transform(o, clip=True)
    return out.select("o_orderkey", r6("price_scaled").alias("price_scaled"))


@query("standard_scale", """
WITH s AS (SELECT avg(c_acctbal) m, stddev_pop(c_acctbal) sd FROM customer)
SELECT c_custkey, ROUND((c_acctbal - m) / CASE WHEN sd = 0 THEN 1 ELSE sd END, 6) AS acctbal_std FROM customer, s""")
def q_standard_scale(spark, sf):
    c = st.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("acctbal_std"))
    m = E.fit_scaler(c, ["acctbal_std"], "standard")
    return m.transform(c).select("c_custkey", r6("acctbal_std").alias("acctbal_std"))


@query("quantile_bucket", """
WITH q AS (SELECT quantile_cont(l_extendedprice, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS b FROM lineitem)
SELECT l_extendedprice, CAST(len(list_filter(b, lambda x: x <= l_extendedprice)) AS INTEGER) AS price_bucket
FROM lineitem, q""")
def q_quantile_bucket(spark, sf):
    li = st.table(spark, sf, "lineitem").select("l_extendedprice")
    bounds = E.quantile_boundaries(li, "l_extendedprice", 10)
    return li.select("l_extendedprice", E.bucketize("l_extendedprice", bounds).alias("price_bucket"))


@query("hash_bucket", """
SELECT c_custkey, CAST('0x' || substr(md5(coalesce(c_mktsegment, '') || '|42'), 1, 15) AS BIGINT) % 16 AS segment_bucket
FROM customer""")
def q_hash_bucket(spark, sf):
    c = st.table(spark, sf, "customer")
    return c.select("c_custkey", hash_bucket("c_mktsegment", 16).alias("segment_bucket"))


# ------------------------------------------------------- ids and splits --

@query("dense_ids", """
SELECT l_partkey AS article_id, dense_rank() OVER (ORDER BY l_partkey) AS item_index
FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey IS NOT NULL)""")
def q_dense_ids(spark, sf):
    li = st.table(spark, sf, "lineitem")
    return I.dense_ids(li, "l_partkey", "item_index").select(F.col("l_partkey").alias("article_id"), "item_index")


@query("split_sequential", with_(EV) + """
, r AS (SELECT event_id, row_number() OVER (ORDER BY impression_time, event_id) - 1 AS i, count(*) OVER () AS n FROM ev)
SELECT event_id, CASE WHEN i >= n - CAST(floor(0.1 * n) AS BIGINT) THEN 'test'
                      WHEN i >= n - 2 * CAST(floor(0.1 * n) AS BIGINT) THEN 'valid' ELSE 'train' END AS split FROM r""")
def q_split_sequential(spark, sf):
    ev = st.events_view(spark, sf).select("event_id", "impression_time")
    return I.split_sequential(ev, ["impression_time", "event_id"], 0.1, 0.1).select("event_id", "split")


_HASHED = with_(EV) + """
, r AS (SELECT event_id, user_id, count(*) OVER () AS n, row_number() OVER (ORDER BY
          CAST('0x' || substr(md5(CAST(event_id AS VARCHAR) || '|2023'), 1, 15) AS BIGINT), event_id) - 1 AS i FROM ev)"""


@query("split_random", _HASHED + """
SELECT event_id, CASE WHEN i >= n - CAST(floor(0.1 * n) AS BIGINT) THEN 'test'
                      WHEN i >= n - 2 * CAST(floor(0.1 * n) AS BIGINT) THEN 'valid' ELSE 'train' END AS split FROM r""")
def q_split_random(spark, sf):
    """Exact sizes, order by a seeded hash."""
    ev = st.events_view(spark, sf).select("event_id")
    return I.split_random(ev, ["event_id"], 0.1, 0.1)


@query("shuffle_rows", _HASHED + "SELECT event_id, user_id, i AS place FROM r")
def q_shuffle_rows(spark, sf):
    """Reproducible random order by a seeded hash (O9), with each row's place."""
    rows = I.shuffled_places(st.events_view(spark, sf).select("event_id", "user_id"), ["event_id"], "place")
    return rows.select("event_id", "user_id", "place")


# --------------------------------------------------------------- lists --

@query("hist_explode", with_(EV) + f"""
SELECT user_id, article_id, {epoch_s('impression_time')} AS t, ROUND(read_time, 6) AS read_time FROM ev""")
def q_hist_explode(spark, sf):
    h = st.history(spark, sf)
    cols = ["article_id_fixed", "impression_time_fixed", "read_time_fixed", "scroll_percentage_fixed"]
    long = strip_suffix(explode_parallel(h, cols))
    return long.select("user_id", "article_id", epoch_seconds("impression_time").alias("t"),
                       r6("read_time").alias("read_time"))


@query("list_stats", with_(EV) + """
SELECT user_id, ROUND(avg(read_time), 6) AS user_read_time_mean,
       ROUND(avg(scroll_percentage), 6) AS user_scroll_percentage_mean,
       ROUND(median(read_time), 6) AS user_read_time_median,
       ROUND(median(scroll_percentage), 6) AS user_scroll_percentage_median,
       CAST(count(*) AS INTEGER) AS n_hist FROM ev GROUP BY user_id""")
def q_list_stats(spark, sf):
    h = st.history(spark, sf)
    return h.select("user_id",
                    r6(L.list_mean("read_time_fixed")).alias("user_read_time_mean"),
                    r6(L.list_mean("scroll_percentage_fixed")).alias("user_scroll_percentage_mean"),
                    r6(L.list_median("read_time_fixed")).alias("user_read_time_median"),
                    r6(L.list_median("scroll_percentage_fixed")).alias("user_scroll_percentage_median"),
                    L.list_len("read_time_fixed").alias("n_hist"))


@query("list_diff_median", with_(EV) + """
, d AS (SELECT user_id, epoch_us(impression_time) - epoch_us(lag(impression_time) OVER
            (PARTITION BY user_id ORDER BY impression_time, event_id)) AS g FROM ev)
SELECT user_id, CAST(trunc(median(g) / 1000000.0) AS BIGINT) AS user_impression_diff FROM d GROUP BY user_id""")
def q_list_diff_median(spark, sf):
    h = st.history(spark, sf)
    return h.select("user_id", L.time_list_diff_median_seconds("impression_time_fixed").alias("user_impression_diff"))


# ----------------------------------------------------------- sequences --

def _seq_long(spark, sf):
    ev = st.events_view(spark, sf).select("user_id", "article_id", "impression_time", "event_id")
    return Q.sequence_long(ev, "user_id", "article_id", "impression_time", ["event_id"])


_SEQ_SQL = with_(EV) + """
, f AS (SELECT user_id, article_id, min(impression_time) AS t,
               arg_min(event_id, (impression_time, event_id)) AS event_id
        FROM ev WHERE article_id IS NOT NULL GROUP BY user_id, article_id),
s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id, article_id) - 1 AS seq_pos,
             count(*) OVER (PARTITION BY user_id) AS seq_n FROM f)"""


@query("user_sequences", _SEQ_SQL + f"""
SELECT user_id, CAST(seq_pos AS BIGINT) AS seq_pos, article_id, CAST(seq_n AS BIGINT) AS seq_n,
       {epoch_s('t')} AS t FROM s""")
def q_user_sequences(spark, sf):
    s = _seq_long(spark, sf)
    return s.select("user_id", "seq_pos", "article_id", F.col("seq_n").cast("long").alias("seq_n"),
                    epoch_seconds("impression_time").alias("t"))


@query("seq_prefix_cutoff", _SEQ_SQL + """
SELECT user_id, CAST(count(*) FILTER (WHERE t < TIMESTAMP '2024-01-10') AS BIGINT) AS seq_len_train,
       CAST(count(*) FILTER (WHERE t < TIMESTAMP '2024-01-20') AS BIGINT) AS seq_len_valid,
       CAST(count(*) AS BIGINT) AS seq_len_full FROM s GROUP BY user_id""")
def q_seq_prefix_cutoff(spark, sf):
    s = _seq_long(spark, sf)
    return Q.cutoff_lengths(s, "user_id", "impression_time",
                            {"seq_len_train": CUT_TRAIN, "seq_len_valid": CUT_VALID})


@query("seq_last_n_pad", _SEQ_SQL + """
, p AS (SELECT user_id, list(article_id ORDER BY seq_pos) AS l FROM s WHERE t < TIMESTAMP '2024-01-20' GROUP BY user_id),
c AS (SELECT user_id, CASE WHEN len(l) > 5 THEN l[len(l) - 4:] ELSE l END AS l FROM p)
SELECT user_id, CAST(list_concat(list_resize([]::BIGINT[], 5 - len(l), 0), l) AS BIGINT[]) AS last5 FROM c""")
def q_seq_last_n_pad(spark, sf):
    s = _seq_long(spark, sf)
    # the point-in-time prefix is the rows before the cutoff (the sequence is
    # time-ordered); only its last 5 positions are ever collected
    before = s.where(F.col("impression_time") < ntz_lit(CUT_VALID))
    n_cut = before.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    tail = before.join(n_cut, "user_id").withColumn("seq_n", F.col("_n"))
    arr = Q.assemble(tail, ["user_id"], "article_id", max_len=5, out="_last")
    return arr.select("user_id", L.pad_sequence("_last", 5, 0, "pre", "pre").alias("last5"))


@query("sample_table", with_(CAND, EV, ART) + """
, it AS (SELECT article_id, dense_rank() OVER (ORDER BY article_id) AS item_index FROM art),
us AS (SELECT user_id, dense_rank() OVER (ORDER BY user_id) AS user_index FROM (SELECT DISTINCT user_id FROM ev)),
j AS (SELECT c.*, it.item_index, us.user_index, a.published_time,
             CAST(max(line_label) OVER (PARTITION BY c.impression_id, c.article_id) AS INTEGER) AS click
      FROM cand c JOIN it ON c.article_id = it.article_id JOIN us ON c.user_id = us.user_id
      LEFT JOIN art a ON c.article_id = a.article_id),
d AS (SELECT *, CAST(trunc((epoch_us(impression_time) - epoch_us(published_time)) / 86400000000.0) AS INTEGER) AS dd,
             CAST(trunc((epoch_us(impression_time) - epoch_us(published_time)) / 3600000000.0) AS INTEGER) AS hh FROM j)
SELECT impression_id, pos, CAST(item_index AS BIGINT) AS item_index, CAST(user_index AS BIGINT) AS user_index, click,
       CASE WHEN dd > 3 THEN 3 ELSE dd END AS pulish_3day, CASE WHEN dd > 7 THEN 7 ELSE dd END AS pulish_7day,
       CASE WHEN dd > 30 THEN 30 ELSE dd END AS publish_days, CASE WHEN hh > 24 THEN 24 ELSE hh END AS publish_hours,
       CAST(hour(impression_time) AS INTEGER) AS impression_hour, CAST(isodow(impression_time) AS INTEGER) AS impression_weekday
FROM d""")
def q_sample_table(spark, sf):
    from rankfold.plans.catalog_core import labeled_candidates
    c = labeled_candidates(spark, sf).withColumnRenamed("label", "click")
    art = st.articles(spark, sf).select("article_id", "published_time")
    items = I.dense_ids(art, "article_id", "item_index")
    users = I.dense_ids(st.events_view(spark, sf), "user_id", "user_index")
    # inner joins drop candidates whose item or user has no index
    j = c.join(items, "article_id").join(users, "user_id").join(art, "article_id", "left")
    j = Q.sample_clock_features(j, "impression_time", "published_time")
    return j.select("impression_id", "pos", "item_index", "user_index", "click", "pulish_3day", "pulish_7day",
                    "publish_days", "publish_hours", "impression_hour", "impression_weekday")


@query("pub_age_clip", with_(CAND, ART) + """
, d AS (SELECT c.impression_id, c.pos,
          CAST(trunc((epoch_us(c.impression_time) - epoch_us(a.published_time)) / 86400000000.0) AS INTEGER) AS dd,
          CAST(trunc((epoch_us(c.impression_time) - epoch_us(a.published_time)) / 3600000000.0) AS INTEGER) AS hh
        FROM cand c LEFT JOIN art a ON c.article_id = a.article_id)
SELECT impression_id, pos, CASE WHEN dd > 3 THEN 3 ELSE dd END AS pulish_3day,
       CASE WHEN dd > 7 THEN 7 ELSE dd END AS pulish_7day, CASE WHEN dd > 30 THEN 30 ELSE dd END AS publish_days,
       CASE WHEN hh > 24 THEN 24 ELSE hh END AS publish_hours FROM d""")
def q_pub_age_clip(spark, sf):
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "article_id", "impression_time")
    art = st.articles(spark, sf).select("article_id", "published_time")
    j = Q.sample_clock_features(c.join(art, "article_id", "left"), "impression_time", "published_time")
    return j.select("impression_id", "pos", "pulish_3day", "pulish_7day", "publish_days", "publish_hours")


# ------------------------------------------------ feature specs & layout --

@query("narrow_types", """
WITH s AS (SELECT min(l_orderkey) a1, max(l_orderkey) b1, min(l_linenumber) a2, max(l_linenumber) b2,
                  min(l_partkey) a3, max(l_partkey) b3, min(l_quantity) a4, max(l_quantity) b4 FROM lineitem),
t AS (SELECT 'l_orderkey' AS "column", a1 AS lo, b1 AS hi, 'i' AS k FROM s
      UNION ALL SELECT 'l_linenumber', a2, b2, 'i' FROM s UNION ALL SELECT 'l_partkey', a3, b3, 'i' FROM s
      UNION ALL SELECT 'l_quantity', a4, b4, 'f' FROM s)
SELECT "column", CASE WHEN k = 'f' THEN (CASE WHEN lo > -3.4028234663852886e38 AND hi < 3.4028234663852886e38
                                          THEN 'float' ELSE 'double' END)
                      WHEN lo > -128 AND hi < 127 THEN 'tinyint' WHEN lo > -32768 AND hi < 32767 THEN 'smallint'
                      WHEN lo > -2147483648 AND hi < 2147483647 THEN 'int' ELSE 'bigint' END AS type FROM t""")
def q_narrow_types(spark, sf):
    from rankfold.operators.featuremap import narrowed_types
    li = st.table(spark, sf, "lineitem")
    return narrowed_types(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"])


@query("topk_features", """
WITH imp AS (SELECT 'l_quantity' AS feature, count(DISTINCT l_quantity) AS importance FROM lineitem
  UNION ALL SELECT 'l_extendedprice', count(DISTINCT l_extendedprice) FROM lineitem
  UNION ALL SELECT 'l_discount', count(DISTINCT l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', count(DISTINCT l_tax) FROM lineitem
  UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
  UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem
  UNION ALL SELECT 'dnn_score', count(DISTINCT l_orderkey) FROM lineitem)
SELECT feature, importance FROM (SELECT * FROM imp ORDER BY importance DESC, feature LIMIT 4)
WHERE feature NOT IN ('l_partkey') AND NOT suffix(feature, '_score')""")
def q_topk_features(spark, sf):
    """Importance = distinct values per column (a data-driven stand-in for the
    importance file); of the top 4, those not already used and not a score."""
    from rankfold.operators.featuremap import top_features, unpivot
    li = st.table(spark, sf, "lineitem").withColumn("dnn_score", F.col("l_orderkey"))
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey", "l_partkey", "dnn_score"]
    imp = unpivot(li, cols).groupBy("feature").agg(F.count_distinct("value").alias("importance"))
    return top_features(imp, 4, existing=["l_partkey"])


@query("feature_map", with_(CAND, EV) + """
, a AS (SELECT count(*) AS n FROM (SELECT article_id FROM cand GROUP BY 1 HAVING count(*) >= 40)),
u AS (SELECT count(DISTINCT user_id) AS n FROM ev)
SELECT 'article_id' AS feature, 'categorical' AS type, 'item' AS source, a.n + 2 AS vocab_size,
       CAST(NULL AS BIGINT) AS max_len, 0 AS padding_idx, a.n + 1 AS oov_idx FROM a
UNION ALL SELECT 'user_id', 'categorical', 'user', u.n + 2, NULL, 0, u.n + 1 FROM u
UNION ALL SELECT 'read_time', 'numeric', 'context', NULL, NULL, NULL, NULL""")
def q_feature_map(spark, sf):
    from rankfold.operators.featuremap import feature_map
    c = st.candidate_lines(spark, sf)
    ev = st.events_view(spark, sf)
    return feature_map(spark, [
        {"name": "article_id", "type": "categorical", "source": "item",
         "vocab": E.frequency_vocab(E.token_counts(c, "article_id"), min_count=40)},
        {"name": "user_id", "type": "categorical", "source": "user",
         "vocab": E.frequency_vocab(E.token_counts(ev, "user_id"))},
        {"name": "read_time", "type": "numeric", "source": "context"}])


@query("user_history_join", with_(CAND, EV) + """
, h AS (SELECT user_id, avg(read_time) AS m1, avg(scroll_percentage) AS m2 FROM ev GROUP BY user_id)
SELECT c.impression_id, c.pos, ROUND(h.m1, 6) AS user_read_time_mean, ROUND(h.m2, 6) AS user_scroll_percentage_mean
FROM cand c LEFT JOIN h ON c.user_id = h.user_id""")
def q_user_history_join(spark, sf):
    """Candidates with the per-user history summary (J2): the means of the
    user's history lists, computed as partial aggregates over the history
    rows (equal to the per-row list means, without building the lists)."""
    from rankfold.operators.features import group_stats
    h = group_stats(st.events_view(spark, sf), ["user_id"],
                    [("mean", "read_time", "m1"), ("mean", "scroll_percentage", "m2")])
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "user_id")
    j = c.join(h, "user_id", "left")
    return j.select("impression_id", "pos", r6("m1").alias("user_read_time_mean"),
                    r6("m2").alias("user_scroll_percentage_mean"))


@query("seq_item_lookup", _SEQ_SQL + """
, p AS (SELECT user_id, list(article_id ORDER BY seq_pos) AS l FROM s WHERE t < TIMESTAMP '2024-01-20' GROUP BY user_id),
c AS (SELECT user_id, CASE WHEN len(l) > 5 THEN l[len(l) - 4:] ELSE l END AS l FROM p),
pad AS (SELECT user_id, list_concat(list_resize([]::BIGINT[], 5 - len(l), -1), l) AS l FROM c),
ex AS (SELECT user_id, unnest(l) AS id, generate_subscripts(l, 1) AS k FROM pad)
SELECT ex.user_id, list(part.p_type ORDER BY ex.k) AS last5_category
FROM ex LEFT JOIN part ON ex.id = part.p_partkey GROUP BY ex.user_id""")
def q_seq_item_lookup(spark, sf):
    """Item attributes for every slot of the padded last-5 sequence (J7);
    padding uses id -1 so it never matches an item."""
    from rankfold.operators.sequence import lookup_items
    s = _seq_long(spark, sf).where(F.col("impression_time") < ntz_lit(CUT_VALID))
    n_cut = s.groupBy("user_id").agg(F.count(F.lit(1)).alias("seq_n"))
    tail = s.drop("seq_n").join(n_cut, "user_id")
    arr = Q.assemble(tail, ["user_id"], "article_id", max_len=5, out="_last")
    seqs = arr.select("user_id", L.pad_sequence("_last", 5, -1, "pre", "pre").alias("last5"))
    items = st.articles(spark, sf).select("article_id", "category")
    out = lookup_items(seqs, ["user_id"], "last5", items, "article_id", ["category"])
    return out.select("user_id", "last5_category")


@query("seq_len_join", _SEQ_SQL + """
, sl AS (SELECT user_id, count(*) FILTER (WHERE t < TIMESTAMP '2024-01-10') AS seq_len FROM s GROUP BY user_id)
SELECT c.impression_id, c.pos, CAST(sl.seq_len AS BIGINT) AS seq_len
FROM (SELECT l_orderkey AS impression_id, o_custkey AS user_id,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                                l_shipdate, l_returnflag, l_discount, l_tax, l_quantity) - 1 AS pos
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) c LEFT JOIN sl ON c.user_id = sl.user_id""")
def q_seq_len_join(spark, sf):
    """Samples joined with the user's point-in-time sequence length."""
    lens = Q.cutoff_lengths(_seq_long(spark, sf), "user_id", "impression_time", {"seq_len": CUT_TRAIN})
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "user_id")
    return c.join(lens.select("user_id", "seq_len"), "user_id", "left").select(
        "impression_id", "pos", F.col("seq_len").cast("long").alias("seq_len"))


@query("encoder_fit_transform", with_(CAND, ART) + """
, c AS (SELECT cand.*, art.category FROM cand LEFT JOIN art ON cand.article_id = art.article_id),
tr AS (SELECT * FROM c WHERE impression_time < TIMESTAMP '1996-01-01'),
v AS (SELECT category AS token, row_number() OVER (ORDER BY count(*) DESC, category) AS id
      FROM tr WHERE category IS NOT NULL GROUP BY category),
o AS (SELECT count(*) + 1 AS oov FROM v),
s AS (SELECT min(quantity) a, max(quantity) b FROM tr)
SELECT c.impression_id, c.pos, CAST(coalesce(v.id, o.oov) AS BIGINT) AS category,
       ROUND((c.quantity - s.a) / CASE WHEN s.b = s.a THEN 1 ELSE s.b - s.a END, 6) AS quantity
FROM c CROSS JOIN o CROSS JOIN s LEFT JOIN v ON c.category = v.token
WHERE c.impression_time >= TIMESTAMP '1996-01-01'""")
def q_encoder_fit_transform(spark, sf):
    """Fit on the train split, transform a later split."""
    from rankfold.operators.featuremap import fit_encoder
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "article_id", "impression_time", "quantity")
    c = c.join(st.articles(spark, sf).select("article_id", "category"), "article_id", "left")
    cut = F.col("impression_time") < ntz_lit(datetime(1996, 1, 1))
    model = fit_encoder(c.where(cut), categorical=["category"], numeric=["quantity"])
    out = model.transform(c.where(~cut), ["impression_id", "pos"])
    return out.select("impression_id", "pos", "category", r6("quantity").alias("quantity"))


@query("pretrained_lookup", with_(CAND) + """
, c AS (SELECT article_id AS token, count(*) AS n FROM cand GROUP BY 1),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM c WHERE n >= 40)
SELECT v.id, v.token, list_transform(coalesce(CAST(e.embedding AS DOUBLE[]), list_resize([]::DOUBLE[], 64, 0.0)),
                                     lambda x: round(x, 6)) AS value
FROM v LEFT JOIN embeddings e ON v.token = e.vec_id""")
def q_pretrained_lookup(spark, sf):
    """Pretrained vector per vocabulary id; keys missing from the embedding
    table get a zero vector (S5/J10)."""
    from rankfold.operators.joins import attach_pretrained
    from rankfold.sources.io import read_embeddings
    c = st.candidate_lines(spark, sf)
    v = E.frequency_vocab(E.token_counts(c, "article_id"), min_count=40)
    emb = read_embeddings(spark, f"{sf.rstrip('/')}/embeddings.parquet", "vec_id", "embedding")
    out = attach_pretrained(v.select("token", "id"), emb, 64)
    return out.select("id", "token", F.transform("value", lambda x: F.round(x, 6)).alias("value"))
