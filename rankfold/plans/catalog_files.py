"""Sources, sinks and column helpers whose result is written and read back, or
computed next to an oracle: CSV and blocked parquet, manifest, vocabulary JSON,
result log, submission file, score export, keyed concat, text and list helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankfold.functions import lists as L
from rankfold.functions import scalar as S
from rankfold.operators import encode as E
from rankfold.operators import featuremap as FM
from rankfold.operators import metrics as M
from rankfold.operators import ranking as R
from rankfold.operators import vectors as V
from rankfold.operators.joins import concat_by_key, lookup_with_default
from rankfold.plans.catalog_metrics import scored
from rankfold.plans.oracle import ART, CAND, CAND_LABELED, EV, with_
from rankfold.plans.registry import query, r6
from rankfold.sources import io
from rankfold.sources import staging as st
from rankfold.streaming.stream_ops import stream_folder

_CUSTOMER = "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer"


@query("csv_round_trip", _CUSTOMER)
def q_csv_round_trip(spark, sf):
    """CSV sink (S9) and typed CSV scan (S3) with a separator."""
    path = stream_folder(spark, "csv")
    io.write_csv(st.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), path)
    return io.read_csv(spark, path, "c_custkey long, c_mktsegment string, c_acctbal double")


@query("blocked_parquet", """
SELECT o_orderkey, o_orderstatus, count(*) OVER () AS num_samples, (count(*) OVER () + 127) // 128 AS num_batches,
       true AS blocks_bounded FROM orders""")
def q_blocked_parquet(spark, sf):
    """Blocked parquet sink (S6, S7) and the counts of its blocks."""
    path = stream_folder(spark, "blocks")
    io.write_parquet(st.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path, block_rows=400)
    stats = io.block_stats(spark, path, 128)
    return io.read_parquet(spark, path).withColumns({
        "num_samples": F.lit(stats["num_samples"]).cast("long"), "num_batches": F.lit(stats["num_batches"]).cast("long"),
        "blocks_bounded": F.lit(stats["num_blocks"] * 400 >= stats["num_samples"])})


@query("manifest", with_(EV) + """
SELECT 'samples' AS part, CASE WHEN label = 1 THEN 'clicked' ELSE 'other' END AS name, count(*) AS value FROM ev GROUP BY 2
UNION ALL SELECT 'vocab_size', 'user_id', count(DISTINCT user_id) FROM ev
UNION ALL SELECT 'vocab_size', 'category', count(DISTINCT category) FROM ev
UNION ALL SELECT 'max_len', 'history', 50""")
def q_manifest(spark, sf):
    """Dataset manifest (S11) written, read back and listed."""
    ev = st.events_view(spark, sf).select("user_id", "category", "label")
    counts = ev.agg(*[F.count_distinct(c).alias(c) for c in ("user_id", "category")])
    sizes = counts.unpivot([], ["user_id", "category"], "feature", "vocab_size")
    made = io.dataset_manifest({"clicked": ev.where("label = 1"), "other": ev.where("label <> 1")}, sizes, ["read_time"],
                               "label", {"history": 50})
    path = stream_folder(spark, "manifest")
    io.write_manifest(spark, made, path)
    back = io.read_manifest(spark, path)
    rows = [(part, k, v) for part in ("samples", "vocab_size", "max_len") for k, v in back[part].items()]
    return spark.createDataFrame(rows, "part string, name string, value long")


@query("vocab_json", with_(EV) + """
, c AS (SELECT article_id AS token, count(*) AS n FROM ev WHERE article_id IS NOT NULL GROUP BY 1)
SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM c WHERE n >= 3""")
def q_vocab_json(spark, sf):
    """Vocabulary JSON (S13) written and read back."""
    vocab = E.frequency_vocab(E.token_counts(st.events_view(spark, sf), "article_id"), min_count=3)
    path = stream_folder(spark, "vocab")
    io.write_vocab_json(vocab, path)
    return spark.read.schema("token long, id long").json(path)


@query("result_log", with_(CAND_LABELED) + """
, t AS (SELECT user_id % 2 AS half, label AS y, least(greatest(score_a * 10, 1e-7), 1 - 1e-7) AS p FROM cand_l)
SELECT 'exp' || half AS exp_id, 'valid' AS split, 'logloss' AS metric,
       ROUND(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS value FROM t GROUP BY half""")
def q_result_log(spark, sf):
    """Metrics of two experiments appended to the result log."""
    rows = scored(spark, sf).select("user_id", "label", "prob")
    path = stream_folder(spark, "log")
    for half in (0, 1):
        got = M.logloss(rows.where(F.col("user_id") % 2 == half), score="prob").first()["logloss"]
        io.append_results(spark, path, f"exp{half}", "candidates", "valid", {"logloss": got})
    return spark.read.parquet(path).select("exp_id", "split", "metric", r6("value").alias("value"))


@query("submission_file", with_(CAND) + """
, r AS (SELECT impression_id, user_id, pos,
           row_number() OVER (PARTITION BY impression_id, user_id ORDER BY score_a * 0.5 + score_c * 0.5 DESC, pos) AS rnk
        FROM cand)
SELECT CAST(impression_id AS VARCHAR) || ' [' || string_agg(CAST(rnk AS VARCHAR), ',' ORDER BY pos) || ']' AS line
FROM r GROUP BY impression_id, user_id""")
def q_submission_file(spark, sf):
    """Blended score to rank list to a written submission."""
    c = st.candidate_lines(spark, sf).withColumn("score", F.col("score_a") * 0.5 + F.col("score_c") * 0.5)
    path = stream_folder(spark, "submission")
    R.write_submission(R.submission_lines(R.rank_lists(c)), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("score_export", with_(CAND) + """
SELECT CASE WHEN impression_id % 10 < 8 THEN 'train' WHEN impression_id % 10 = 8 THEN 'valid' ELSE 'test' END AS split,
       impression_id, user_id, pos, ROUND(score_a * 10, 6) AS score FROM cand""")
def q_score_export(spark, sf):
    """Scores written per split (R7) and read back with their split."""
    c = st.candidate_lines(spark, sf)
    m = F.col("impression_id") % 10
    split = F.when(m < 8, "train").when(m == 8, "valid").otherwise("test")
    path = stream_folder(spark, "scores")
    io.write_parquet(c.select(split.alias("split"), "impression_id", "user_id", "pos", r6(F.col("score_a") * 10).alias("score")),
                     path, partition_by=["split"])
    return io.read_parquet(spark, path).select("split", "impression_id", "user_id", "pos", "score")


@query("keyed_concat", """
SELECT coalesce(l.doc_id, d.doc_id) AS doc_id, l.quality, d.n_chars
FROM labels l FULL JOIN documents d ON l.doc_id = d.doc_id""")
def q_keyed_concat(spark, sf):
    """Feature frames side by side by key (J8); a missing key gives nulls."""
    d = st.table(spark, sf, "documents").select("doc_id", "n_chars")
    return concat_by_key([st.table(spark, sf, "labels").select("doc_id", "quality"), d], ["doc_id"])


@query("lookup_default", with_(EV, ART) + """
SELECT ev.event_id, coalesce(a.article_type, 'none') AS article_type FROM ev LEFT JOIN art a ON ev.article_id = a.article_id""")
def q_lookup_default(spark, sf):
    """Map a key through a table, with a default."""
    ev = st.events_view(spark, sf).select("event_id", "article_id")
    return lookup_with_default(ev, st.articles(spark, sf), "article_id", "article_type", "article_type",
                               "none").select("event_id", "article_type")


@query("pairwise_products", "WITH vec AS (SELECT vec_id AS article_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)\n"
       "SELECT article_id, [" + ", ".join(
           f"list_transform(range(1, 17), lambda k: round(v[{16 * i} + k] * v[{16 * j} + k], 6) + 0.0)"
           for i in range(4) for j in range(i + 1, 4)) + "] AS products FROM vec")
def q_pairwise_products(spark, sf):
    """Element-wise products of field pairs (V5)."""
    p = V.pairwise_elementwise(V.split_fields("embedding", 4, 16), 4)
    return st.vectors(spark, sf).select(
        "article_id", F.transform(p, lambda a: F.transform(a, lambda x: F.round(x, 6) + F.lit(0.0))).alias("products"))


@query("parse_timestamps", """
SELECT o_orderkey, epoch_us(date_trunc('second', CAST(o_orderdate AS TIMESTAMP))) // 1000000 AS dashed,
       epoch_us(date_trunc('minute', CAST(o_orderdate AS TIMESTAMP))) // 1000000 AS slashed FROM orders""")
def q_parse_timestamps(spark, sf):
    """Timestamps read from two text formats."""
    o = st.table(spark, sf, "orders")
    at = F.col("o_orderdate").cast("timestamp_ntz")
    o = o.select("o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("a"), F.date_format(at, "yyyy/M/d H:mm").alias("b"))
    return o.select("o_orderkey", S.epoch_seconds(S.parse_timestamp("a")).alias("dashed"),
                    F.unix_timestamp(S.parse_timestamp_any("b")).alias("slashed"))


@query("split_whitespace", r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(trim(coalesce(title, ''), ' '), '\s+'), lambda t: t <> '') AS words
           FROM (SELECT p_partkey AS doc_id, upper(p_name) || '  ' || p_type AS title FROM part))
SELECT doc_id, list_transform(words, lambda t: lower(t)) AS words,
       list_transform(list_transform(words, lambda t: length(t) - 4), lambda n: CASE WHEN n > 0 THEN 1 ELSE 0 END) AS mask FROM w""")
def q_split_whitespace(spark, sf):
    """Tokens by runs of white space, lower-cased (F17, F18), and the mask of
    positive elements (F21)."""
    p = st.table(spark, sf, "part")
    title = F.concat(F.upper("p_name"), F.lit("  "), F.col("p_type"))
    w = L.split_tokens(title, lower=True)
    return p.select(F.col("p_partkey").alias("doc_id"), w.alias("words"),
                    L.non_pad_mask(F.transform(w, lambda t: F.length(t) - 4)).alias("mask"))


@query("preprocess_hook", """
SELECT o_orderkey, CAST(o_custkey * 2 AS BIGINT) AS doubled, o_custkey AS copied, CAST(o_custkey AS BIGINT) AS raw_id FROM orders""")
def q_preprocess_hook(spark, sf):
    """A user's own preprocessor, declared by name (U4, P15-P17), and ids of a
    tokenizer that does not remap (E6)."""
    S.register_preprocess("twice", lambda c: F.col(c) * 2)
    o = st.table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_custkey").cast("string").alias("raw_id"))
    o = S.apply_preprocess(o, [{"name": "doubled", "preprocess": "twice(o_custkey)", "dtype": "long"},
                               {"name": "copied", "preprocess": "copy_from(o_custkey)"}])
    return FM.remap_false_ids(o, "raw_id").select("o_orderkey", "doubled", "copied", "raw_id")


_NARROW = """CASE WHEN min({0}) > -128 AND max({0}) < 127 THEN 'tinyint' WHEN min({0}) > -32768 AND max({0}) < 32767 THEN 'smallint'
  WHEN min({0}) > -2147483648 AND max({0}) < 2147483647 THEN 'int' ELSE 'bigint' END"""


@query("narrowed_rows", f"""
WITH t AS (SELECT {_NARROW.format('l_orderkey')} AS key_type, {_NARROW.format('l_linenumber')} AS line_type FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity, key_type, line_type FROM lineitem, t""")
def q_narrowed_rows(spark, sf):
    """Columns cast to the smallest type that holds them (P18), values kept;
    the types are those of the narrowed columns."""
    li = st.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    types = dict(li.dtypes)
    n = FM.narrow(li)
    return n.select(*[F.col(c).cast(types[c]).alias(c) for c in li.columns], F.typeof("l_orderkey").alias("key_type"),
                    F.typeof("l_linenumber").alias("line_type"))
