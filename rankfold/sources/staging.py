"""Stand-in tables for the news-recommendation data model, derived by Spark
from the driver's parquet tables.

The reference reads three tables (behaviors, history, articles).  The test
data is a TPC-H-like star schema plus an event log, so each reference table
is re-expressed as a view over it; the same views are written as SQL CTEs in
``rankfold.plans.oracle`` so the DuckDB oracle sees identical inputs.

* candidates (exploded impressions): one row per lineitem of an order,
  positioned row-wise (no per-order collect).
  impression = order, user = customer, article = part, time = order date,
  clicked = return flag 'R', candidate position = order of
  (l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) inside the
  order, starting at 0.
* behaviors: one row per order with the in-view and clicked id arrays (the
  reference's input format, bounded by what one page shows); used by the
  explode/label and list-encoding queries whose subject is that format.
* events view: user, article = props.k, time = ts, category = event type,
  read time = value, label = event type 'click'.
* history: one row per user with four parallel arrays sorted by time.
* articles: part with category = p_type, article_type = p_brand, counts and
  read time from size and price.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.functions.scalar import ntz_lit
from rankfold.session import fit_partitions

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Tables that grow fastest: the shuffles of a query that reads one are sized by it.
FACTS = {"lineitem", "events"}

# The order of a candidate inside its impression.
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in FACTS:
        fit_partitions(spark, path)
    return spark.read.parquet(path)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: customer, date and the order's lines as a sorted
    array of structs.  An impression's in-view list is bounded by the page,
    so the per-order collect is bounded; the aggregation is partial+final."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *LINE_ORDER, "l_returnflag", "l_discount", "l_tax", "l_quantity")
    lines = (li.groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(F.struct(
                 *LINE_ORDER, "l_returnflag", "l_discount", "l_tax", "l_quantity"))).alias("lines")))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate",
        "o_orderpriority", "o_totalprice")
    return lines.join(orders, "l_orderkey", "inner")


def behaviors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """impression_id, user_id, impression_time, device_type, read_time,
    article_ids_inview, article_ids_clicked."""
    ol = order_lines(spark, sf_dir)
    return ol.select(
        F.col("l_orderkey").alias("impression_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("impression_time"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("device_type"),
        F.col("o_totalprice").alias("read_time"),
        F.transform("lines", lambda x: x["l_partkey"]).alias("article_ids_inview"),
        F.transform(F.filter("lines", lambda x: x["l_returnflag"] == "R"),
                    lambda x: x["l_partkey"]).alias("article_ids_clicked"),
    )


def candidate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (impression, position) with the line's numeric fields,
    used as model scores: score_a = l_discount (many ties, inside [0,1]),
    score_b = l_extendedprice (outside [0,1]), score_c = l_tax.

    The position is a window over the order: a page bounds its lines."""
    from rankfold.operators.sequence import positions
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", *LINE_ORDER, "l_returnflag", "l_discount", "l_tax", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    j = li.join(orders, "l_orderkey", "inner")
    p = positions(j, ["l_orderkey"], [*LINE_ORDER, "l_returnflag", "l_discount", "l_tax", "l_quantity"], "pos", strategy="window")
    return p.select(
        F.col("l_orderkey").alias("impression_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("impression_time"), F.col("pos").cast("long").alias("pos"),
        F.col("l_partkey").alias("article_id"),
        (F.col("l_returnflag") == "R").cast("int").alias("line_label"),
        F.col("l_discount").alias("score_a"), F.col("l_extendedprice").alias("score_b"),
        F.col("l_tax").alias("score_c"), F.col("l_quantity").alias("quantity"))


def events_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("article_id"),
        F.col("ts").alias("impression_time"),
        F.col("event_type").alias("category"),
        F.col("value").alias("read_time"),
        F.least(F.col("value") * 2, F.lit(100.0)).alias("scroll_percentage"),
        (F.col("event_type") == "click").cast("int").alias("label"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user parallel arrays sorted by (time, event_id): the reference's
    history *input* layout, rebuilt here only for the queries whose subject
    is that array format (parallel explode, per-row list statistics).  Every
    feature job reads history in long form (``events_view``) instead, so
    this collect is never on a feature path."""
    ev = events_view(spark, sf_dir)
    s = F.array_sort(F.collect_list(F.struct(
        "impression_time", "event_id", "article_id", "read_time", "scroll_percentage")))
    h = ev.groupBy("user_id").agg(s.alias("_h"))
    return h.select(
        "user_id",
        F.transform("_h", lambda x: x["article_id"]).alias("article_id_fixed"),
        F.transform("_h", lambda x: x["impression_time"]).alias("impression_time_fixed"),
        F.transform("_h", lambda x: x["read_time"]).alias("read_time_fixed"),
        F.transform("_h", lambda x: x["scroll_percentage"]).alias("scroll_percentage_fixed"))


# Sentiment label stand-ins by part type.
SENTIMENT_BY_TYPE = {"PROMO": "Positive", "STANDARD": "Neutral", "SMALL": "Positive",
                     "LARGE": "Negative", "MEDIUM": "Neutral", "ECONOMY": "Negative"}
PUBLISH_BASE = datetime(1992, 1, 1)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    label = F.lit(None).cast("string")
    expr = None
    for k, v in SENTIMENT_BY_TYPE.items():
        expr = (F.when(F.col("p_type") == k, F.lit(v)) if expr is None
                else expr.when(F.col("p_type") == k, F.lit(v)))
    label = expr.otherwise(F.lit(None))
    return p.select(
        F.col("p_partkey").alias("article_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("article_type"),
        F.col("p_size").alias("total_inviews"),
        (F.col("p_size") % 5).alias("total_pageviews"),
        F.col("p_retailprice").alias("total_read_time"),
        (F.col("p_size") / F.lit(50.0)).alias("sentiment_score"),
        label.alias("sentiment_label"),
        (F.col("p_size") > 25).alias("premium"),
        F.timestamp_add("DAY", (F.col("p_partkey") % 2000).cast("int"),
                        ntz_lit(PUBLISH_BASE)).alias("published_time"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("article_id"),
                    F.col("embedding").cast("array<double>").alias("embedding"), "label")
