"""Dataset builds: field encoding, sequences by as-of merge, ordered blocks,
feature lists and specs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from rankfold.functions.scalar import ntz_lit, param_hash
from rankfold.operators import asof
from rankfold.operators import encode as E
from rankfold.operators import featuremap as FM
from rankfold.operators import index as I
from rankfold.operators.field_encoder import FieldEncoder, FieldEncoderModel
from rankfold.operators.sequence import positions
from rankfold.plans.oracle import ART, CAND, EV, with_
from rankfold.plans.registry import query, r6
from rankfold.session import ensure_checkpoint_dir, written
from rankfold.sources import blocks, io
from rankfold.sources import staging as st
from rankfold.streaming.stream_ops import stream_folder

# ------------------------------------------------- fields, one join --

FIELDS = ["user_id", "article_id", "supplier", "line_no", "returnflag", "linestatus", "order_status", "priority", "segment",
          "nation", "brand", "part_type", "part_size", "order_year", "order_month"]
FIELD_MIN_COUNT = 10
NAME_LEN = 3
SPLITS = ("train", "valid", "test")
CUT_VALID, CUT_TEST = datetime(1996, 1, 1), datetime(1997, 6, 1)


def field_rows(spark, sf):
    """Order lines with 15 categorical fields, a text field and a number, keyed
    by (impression_id, pos) and split by order date.

    Customers come to the orders, not to every line, and positions count lines
    before a customer that is there twice repeats them: the first stands in the
    order's columns, all are kept only where there are several."""
    li = st.table(spark, sf, "lineitem")
    who = F.struct("c_mktsegment", "c_nationkey")
    customers = (st.table(spark, sf, "customer").where("c_custkey IS NOT NULL").groupBy(F.col("c_custkey").alias("o_custkey"))
                 .agg(F.collect_list(who).alias("_all")))
    customers = customers.select("o_custkey", F.col("_all")[0].alias("_one"), F.when(F.size("_all") > 1, F.col("_all")).alias("_several"))
    orders = (st.table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey").join(customers, "o_custkey", "left")
              .select("*", "_one.c_mktsegment", "_one.c_nationkey").drop("_one"))
    lines = positions(li.join(orders, "l_orderkey"), ["l_orderkey"],
                      [*st.LINE_ORDER, "l_returnflag", "l_discount", "l_tax", "l_quantity"], "pos", strategy="window")
    lines = lines.withColumn("_who", F.explode(F.coalesce("_several", F.array(who))))
    lines = (lines.select(*[c for c in lines.columns if c not in ("c_mktsegment", "c_nationkey", "_several", "_who")], "_who.*")
             .join(st.table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size", "p_name"),
                   "l_partkey", "left"))
    split = (F.when(F.col("o_orderdate") < ntz_lit(CUT_VALID), "train").when(F.col("o_orderdate") < ntz_lit(CUT_TEST), "valid")
             .otherwise("test"))
    return lines.select(
        F.col("l_orderkey").alias("impression_id"), "pos", split.alias("split"), F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("article_id"), F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line_no"),
        F.col("l_returnflag").alias("returnflag"), F.col("l_linestatus").alias("linestatus"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("priority"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("part_type"), F.col("p_size").alias("part_size"),
        F.year("o_orderdate").alias("order_year"), F.month("o_orderdate").alias("order_month"),
        F.col("p_name").alias("name_tokens"), F.col("l_extendedprice").alias("price"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"))


def field_encoder() -> FieldEncoder:
    return FieldEncoder(keyCols=["impression_id", "pos"], categorical=FIELDS, numeric=["price"],
                        sequences={"name_tokens": {"splitter": " ", "max_len": NAME_LEN}}, minCount=FIELD_MIN_COUNT)


def _field_sql():
    ctes = ["""b AS (
  SELECT l_orderkey AS impression_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
           l_extendedprice, l_shipdate, l_returnflag, l_discount, l_tax, l_quantity) - 1 AS BIGINT) AS pos,
         CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '1997-06-01' THEN 'valid'
              ELSE 'test' END AS split,
         o_custkey AS user_id, l_partkey AS article_id, l_suppkey AS supplier, l_linenumber AS line_no, l_returnflag AS returnflag,
         l_linestatus AS linestatus, o_orderstatus AS order_status, o_orderpriority AS priority, c_mktsegment AS segment,
         c_nationkey AS nation, p_brand AS brand, p_type AS part_type, p_size AS part_size, year(o_orderdate) AS order_year,
         month(o_orderdate) AS order_month, p_name AS name_tokens, l_extendedprice AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey
       LEFT JOIN part ON p_partkey = l_partkey)""",
            "r AS (SELECT min(price) AS lo, max(price) AS hi FROM b WHERE split = 'train')"]
    joins, outs = [], []
    for i, f in enumerate(FIELDS):
        ctes.append(f"""v{i} AS (SELECT t, row_number() OVER (ORDER BY n DESC, t) AS id, count(*) OVER () AS size FROM (
  SELECT CAST({f} AS VARCHAR) AS t, count(*) AS n FROM b WHERE split = 'train' AND {f} IS NOT NULL GROUP BY 1)
  WHERE n >= {FIELD_MIN_COUNT})""")
        joins.append(f"LEFT JOIN v{i} ON v{i}.t = CAST(b.{f} AS VARCHAR)")
        outs.append(f"CAST(coalesce(v{i}.id, (SELECT count(*) + 1 FROM v{i})) AS BIGINT) AS {f}")
    ctes.append(f"""tok AS (SELECT impression_id, pos, split, unnest(string_split(name_tokens, ' ')) AS t,
  generate_subscripts(string_split(name_tokens, ' '), 1) AS p, len(string_split(name_tokens, ' ')) AS m FROM b)""")
    ctes.append(f"""vt AS (SELECT t, row_number() OVER (ORDER BY n DESC, t) AS id FROM (
  SELECT t, count(*) AS n FROM tok WHERE split = 'train' AND t <> '' GROUP BY 1) WHERE n >= {FIELD_MIN_COUNT})""")
    ctes.append(f"""seq AS (SELECT impression_id, pos, list(CASE WHEN tok.t = '' THEN 0 ELSE coalesce(vt.id, (SELECT count(*) + 1 FROM vt)) END
  ORDER BY p) AS ids FROM tok LEFT JOIN vt ON vt.t = tok.t WHERE p > m - {NAME_LEN} GROUP BY 1, 2)""")
    pad = f"list_concat(list_resize([]::BIGINT[], {NAME_LEN} - coalesce(len(seq.ids), 0), 0), coalesce(seq.ids, []))"
    return ("WITH " + ",\n".join(ctes) + f"\nSELECT b.impression_id, b.pos, b.split, {', '.join(outs)}, "
            f"array_to_string({pad}, ',') AS name_tokens, "
            "ROUND((price - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END, 6) + 0.0 AS price\n"
            "FROM b CROSS JOIN r\n" + "\n".join(joins) + "\nLEFT JOIN seq ON seq.impression_id = b.impression_id AND seq.pos = b.pos")


@query("encode_fields", _field_sql())
def q_encode_fields(spark, sf):
    """15 fields, a token sequence and a number, fitted on train, saved, read
    back and applied to the three splits (E3, E19)."""
    ensure_checkpoint_dir(spark)
    rows = written(field_rows(spark, sf).drop("label"), "field-rows")  # the joins run once for the fit and the splits
    path = stream_folder(spark, "field-encoder")
    field_encoder().fit(rows.where(F.col("split") == "train")).write().save(path)
    model = FieldEncoderModel.load(path)
    parts = {s: model.transform(rows.where(F.col("split") == s)).drop("split") for s in SPLITS}
    return io.union_splits(parts).select(
        "impression_id", "pos", "split", *FIELDS, F.array_join("name_tokens", ",").alias("name_tokens"), r6("price").alias("price"))


# ------------------------------------------ sequences by as-of merge --

LAST_N = 5

_CLICKS = f"""ids AS (SELECT p_partkey AS article_id, row_number() OVER (ORDER BY p_partkey) AS id FROM part),
c AS (SELECT user_id, ids.id, min(impression_time) AS t, arg_min(event_id, (impression_time, event_id)) AS event_id
      FROM ev JOIN ids USING (article_id) WHERE label = 1 GROUP BY user_id, ids.id)"""


def click_events(spark, sf):
    """First clicks of every (user, article), articles as dense ids."""
    ev = st.events_view(spark, sf).where("label = 1").select("user_id", "article_id", "impression_time", "event_id")
    ids = I.dense_ids(st.articles(spark, sf), "article_id", "id")
    first = asof.map_ids(ev, "article_id", ids, "item").groupBy("user_id", "item").agg(
        F.min(F.struct("impression_time", "event_id")).alias("f"))
    return first.select("user_id", "item", "f.impression_time", "f.event_id")


@query("asof_sequences", with_(EV, _CLICKS) + f"""
SELECT ev.event_id, count(c.id) AS seq_len, coalesce(array_to_string(
         (list(c.id ORDER BY c.t, c.event_id) FILTER (WHERE c.id IS NOT NULL))[-{LAST_N}:], ','), '') AS last_items
FROM ev LEFT JOIN c ON c.user_id = ev.user_id AND c.t < ev.impression_time GROUP BY ev.event_id""")
def q_asof_sequences(spark, sf):
    """Every event's number of earlier clicks and its last five."""
    samples = st.events_view(spark, sf).select("event_id", "user_id", "impression_time")
    _, out = asof.asof_merge(click_events(spark, sf), samples, "user_id", "impression_time", "item", ["event_id"], LAST_N)
    return out.select("event_id", "seq_len", F.array_join("last_items", ",").alias("last_items"))


@query("asof_positions", with_(EV, _CLICKS) + """
SELECT user_id, id AS item, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id, id) - 1 AS seq_pos FROM c""")
def q_asof_positions(spark, sf):
    """User sequences in long form with item ids mapped in the build."""
    placed, _ = asof.asof_merge(click_events(spark, sf), None, "user_id", "impression_time", "item", ["event_id"])
    return placed.select("user_id", "item", "seq_pos")


CUTOFFS = {"valid": datetime(2024, 1, 15), "test": datetime(2024, 1, 23, 12)}


@query("asof_cutoffs", with_(EV, _CLICKS) + """
, k(split, cut) AS (VALUES ('valid', TIMESTAMP '2024-01-15'), ('test', TIMESTAMP '2024-01-23 12:00:00')),
u AS (SELECT DISTINCT user_id FROM ev)
SELECT u.user_id, k.split, count(c.id) AS seq_len,
       coalesce(max(c.id) FILTER (WHERE c.t = m.t AND c.event_id = m.event_id), -1) AS last_item
FROM u CROSS JOIN k LEFT JOIN c ON c.user_id = u.user_id AND c.t < k.cut
LEFT JOIN (SELECT user_id, split, max(t) AS t, arg_max(event_id, (t, event_id)) AS event_id
           FROM c, k WHERE c.t < k.cut GROUP BY user_id, split) m ON m.user_id = u.user_id AND m.split = k.split
GROUP BY u.user_id, k.split""")
def q_asof_cutoffs(spark, sf):
    """Sequence lengths and last items at two cutoffs (D3), one sorted pass."""
    users = st.events_view(spark, sf).select("user_id").distinct()
    at = F.array(*[F.struct(F.lit(s).alias("split"), ntz_lit(t).alias("impression_time")) for s, t in CUTOFFS.items()])
    cutoffs = users.select("user_id", F.inline(at))
    _, out = asof.asof_merge(click_events(spark, sf), cutoffs, "user_id", "impression_time", "item", ["event_id"], 1)
    return out.select("user_id", "split", "seq_len", F.coalesce(F.try_element_at("last_items", F.lit(-1)), F.lit(-1)).alias("last_item"))


# ---------------------------------------------------- ordered blocks --

BLOCK_ROWS = 700


@query("ordered_blocks", f"""
SELECT i // {BLOCK_ROWS} AS block, min(i) AS first_row, max(i) + 1 AS end_row, count(*) AS rows, CAST(1 AS BIGINT) AS files,
       min(event_id) AS first_event, max(event_id) AS last_event
FROM (SELECT event_id, row_number() OVER (ORDER BY ts DESC, event_id) - 1 AS i FROM events) GROUP BY 1""")
def q_ordered_blocks(spark, sf):
    """Blocks of 700 rows in order (S7): each block's file, row range and rows."""
    ev = st.table(spark, sf, "events").withColumn("back", -F.unix_micros(F.col("ts").cast("timestamp")))
    path = stream_folder(spark, "ordered-blocks")
    blocks.write_ordered_blocks(ev, path, ["back", "event_id"], BLOCK_ROWS)
    ends = spark.read.parquet(path).groupBy(F.col("block").cast("long").alias("block")).agg(
        F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))
    return blocks.block_manifest(spark, path).join(ends, "block")


# ------------------------------------------- feature lists and specs --

@query("select_features", with_(CAND, ART) + """
SELECT c.impression_id, c.user_id, c.article_id, c.score_a, c.quantity, a.total_inviews
FROM cand c LEFT JOIN art a ON c.article_id = a.article_id""")
def q_select_features(spark, sf):
    """A feature list with the keys, in the frame's column order."""
    rows = st.candidate_lines(spark, sf).join(st.articles(spark, sf), "article_id", "left")
    return FM.select_features(rows, ["total_inviews", "quantity", "score_a", "not_there"], ["impression_id", "user_id", "article_id"])


@query("training_columns", with_(CAND) + "SELECT score_a, score_b, score_c, quantity, line_label FROM cand")
def q_training_columns(spark, sf):
    """Ids, times and raw clocks dropped before training (P20)."""
    return FM.drop_columns(st.candidate_lines(spark, sf), [*FM.TRAINING_DROP, "pos"])


@query("test_literals", with_(CAND) + """
SELECT impression_id, pos, CAST(NULL AS BIGINT) AS trigger_id, CAST(0 AS INTEGER) AS click,
       CAST(CASE WHEN impression_id % 10 = 9 THEN -1 ELSE line_label END AS INTEGER) AS label FROM cand""")
def q_test_literals(spark, sf):
    """Literal columns of the splits: label -1 on test, no trigger."""
    c = st.candidate_lines(spark, sf)
    test = c.where("impression_id % 10 = 9").withColumn("label", F.lit(-1))
    rest = c.where("impression_id % 10 <> 9").withColumn("label", F.col("line_label"))
    return test.unionByName(rest).select("impression_id", "pos", F.lit(None).cast("long").alias("trigger_id"),
                                         F.lit(0).alias("click"), F.col("label").cast("int").alias("label"))


@query("merge_fill_zero", with_(EV) + """
, h AS (SELECT user_id, article_id, count(*) AS n, ROUND(avg(read_time), 6) + 0.0 AS read FROM ev WHERE label = 1 GROUP BY ALL)
SELECT ev.event_id, coalesce(h.n, 0) AS clicks, coalesce(h.read, 0.0) AS click_read
FROM ev LEFT JOIN h ON h.user_id = ev.user_id AND h.article_id = ev.article_id""")
def q_merge_fill_zero(spark, sf):
    """Base features joined to samples, missing ones 0."""
    ev = st.events_view(spark, sf).select("event_id", "user_id", "article_id", "label", "read_time")
    feats = ev.where("label = 1").groupBy("user_id", "article_id").agg(
        F.count(F.lit(1)).alias("clicks"), r6(F.avg("read_time")).alias("click_read"))
    return ev.join(feats, ["user_id", "article_id"], "left").fillna(0, ["clicks", "click_read"]).select(
        "event_id", "clicks", "click_read")


SPECS = [{"name": ["p_brand", "p_type"], "type": "categorical", "source": "item"},
         {"name": "p_size", "type": "numeric", "source": "item"},
         {"name": "p_name", "type": "sequence", "source": "item"},
         {"name": "p_retailprice", "type": "numeric", "source": "context", "active": False},
         {"name": ["p_partkey"], "type": "meta", "source": ""}]


@query("spec_layout", """
WITH m AS (SELECT max(len(string_split(p_name, ' '))) AS n FROM part),
v AS (SELECT count(DISTINCT p_brand) AS brands, count(DISTINCT p_type) AS types FROM part),
w AS (SELECT count(DISTINCT t) AS words FROM (SELECT unnest(string_split(p_name, ' ')) AS t FROM part))
SELECT feature, type, source, CAST(start AS BIGINT) AS start, CAST(slots AS BIGINT) AS slots, CAST(vocab AS BIGINT) AS vocab_size FROM (
  SELECT 'p_brand' AS feature, 'categorical' AS type, 'item' AS source, 0 AS start, 1 AS slots, brands + 2 AS vocab FROM v
  UNION ALL SELECT 'p_type', 'categorical', 'item', 1, 1, types + 2 FROM v
  UNION ALL SELECT 'p_size', 'numeric', 'item', 2, 1, NULL
  UNION ALL SELECT 'p_name', 'sequence', 'item', 3, n, words + 2 FROM m, w
  UNION ALL SELECT 'p_partkey', 'meta', '', 3 + n, 1, NULL FROM m)""")
def q_spec_layout(spark, sf):
    """Specs whose name is a list, inactive ones gone (P17), the longest list as
    sequence length (A11), and the column layout (E18) with vocabulary sizes."""
    p = st.table(spark, sf, "part")
    entries = FM.expand_specs(SPECS)
    for e in entries:
        if e["type"] == "sequence":
            e["max_len"] = E.max_list_len(p, e["name"], " ")
            e["vocab"] = E.frequency_vocab(E.token_counts(p, e["name"], splitter=" "))
        elif e["type"] == "categorical":
            e["vocab"] = E.frequency_vocab(E.token_counts(p, e["name"]))
    placed = FM.layout(entries)["offsets"]
    sizes = FM.feature_map(spark, entries)
    rows = [(e["name"], placed[e["name"]], e.get("max_len") or 1) for e in entries]
    return spark.createDataFrame(rows, "feature string, start long, slots long").join(
        sizes.select("feature", "type", "source", "vocab_size"), "feature")


@query("vocab_by_size", """
SELECT o_orderkey, CASE WHEN o_custkey < 49 THEN o_custkey ELSE 49 END AS user_slot FROM orders""")
def q_vocab_by_size(spark, sf):
    """Ids of a vocabulary known by its size only (E12); unknown tokens last."""
    o = st.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("user_slot"))
    return E.encode_column(o, "user_slot", E.vocab_from_size(spark, 50), default=49).select("o_orderkey", "user_slot")


@query("callable_normalizer", "SELECT o_orderkey, ROUND(ln(1 + o_totalprice), 6) + 0.0 AS o_totalprice FROM orders")
def q_callable_normalizer(spark, sf):
    """A user's own normalizer."""
    o = st.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    model = E.fit_scaler(o, ["o_totalprice"], lambda c: F.log1p(c))
    return model.transform(o).select("o_orderkey", r6("o_totalprice").alias("o_totalprice"))


@query("csv_head", "SELECT c_custkey, c_name, c_nationkey FROM customer ORDER BY c_custkey LIMIT 25")
def q_csv_head(spark, sf):
    """The first rows of a CSV file (O5): the limit is the feature."""
    path = stream_folder(spark, "csv-head")
    c = st.table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    io.write_csv(c.orderBy("c_custkey").limit(25).coalesce(1), path)
    return io.read_csv(spark, path, "c_custkey long, c_name string, c_nationkey int", n_rows=25)


PARAMS = [{"model": "gbt", "depth": d, "rate": r} for d in (3, 5) for r in (0.1, 0.3)]


def _hash_sql():
    rows = ", ".join(f"('{param_hash(p)}', {p['depth']}, {p['rate']})" for p in PARAMS)
    return f"""SELECT exp_id, depth, rate, count(*) AS lines, ROUND(sum(l_discount), 6) + 0.0 AS total
FROM lineitem JOIN (VALUES {rows}) p(exp_id, depth, rate) ON l_linenumber <= depth GROUP BY exp_id, depth, rate"""


@query("experiment_ids", _hash_sql())
def q_experiment_ids(spark, sf):
    """Experiments named by the hash of their parameters (F22), with the lines
    that each would train on."""
    li = st.table(spark, sf, "lineitem").select("l_linenumber", "l_discount")
    named = [F.struct(F.lit(param_hash(p)).alias("exp_id"), F.lit(p["depth"]).alias("depth"), F.lit(p["rate"]).alias("rate")) for p in PARAMS]
    return (li.select("l_linenumber", "l_discount", F.inline(F.array(*named))).where(F.col("l_linenumber") <= F.col("depth"))
            .groupBy("exp_id", "depth", "rate").agg(F.count(F.lit(1)).alias("lines"), r6(F.sum("l_discount")).alias("total")))


@query("sorted_importances", with_(CAND) + """
, s AS (SELECT unnest(['score_a', 'score_b', 'score_c', 'quantity']) AS feature,
               unnest([abs(corr(score_a, line_label)), abs(corr(score_b, line_label)), abs(corr(score_c, line_label)),
                       abs(corr(quantity, line_label))]) AS v FROM cand)
SELECT feature, ROUND(v, 6) + 0.0 AS importance, CAST(row_number() OVER (ORDER BY ROUND(v, 6) DESC, feature) AS INTEGER) AS place FROM s""")
def q_sorted_importances(spark, sf):
    """Features by descending importance (O3), here their correlation with the label."""
    c = st.candidate_lines(spark, sf)
    cols = ["score_a", "score_b", "score_c", "quantity"]
    one = c.agg(*[r6(F.abs(F.corr(x, "line_label"))).alias(x) for x in cols])
    return FM.sort_importances(FM.unpivot(one, cols, name="feature", value="importance"))
