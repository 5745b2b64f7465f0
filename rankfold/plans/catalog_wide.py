"""The wide feature job: all pivot statistics over all clocks (W6-W16) and
rolling means over the lag/lead gaps (W1-W5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankfold.functions.scalar import duration_seconds, with_time_features
from rankfold.operators import boundary as B
from rankfold.operators.features import COUNT_KEY_SETS, count_features
from rankfold.operators.rollup import Rollup, attach_rollups, rollup_names
from rankfold.plans.catalog_features import INT_KINDS, stats_sql
from rankfold.plans.oracle import ART, EV, dur_s, epoch_s, with_
from rankfold.plans.registry import query, r6
from rankfold.sources import staging as st

# The reference's dense and distinct columns, its clocks and the
# names of its row counts.
DENSE = ["view_gap", "total_inviews", "total_pageviews", "total_read_time", "read_time", "premium", "sentiment_score",
         "user_read_time_mean", "user_scroll_percentage_mean", "session_len"]
DISTINCT = ["article_id", "article_type", "category", "user_id", "device_type", "postcode", "age"]
COUNTS = {"user_id": {None: "full_user_count", "dayofyear": "day_user_count", "day_hour": "hour_user_count",
                      "day_minute": "minute_user_count", "total_seconds": "second_user_count"},
          "article_id": {None: "full_article_count", "dayofyear": "day_article_count", "day_hour": "hour_article_count",
                         "day_minute": "minute_article_count", "total_seconds": "second_article_count"}}
ORDER = ["impression_time", "event_id"]


def wide_base(spark, sf):
    """Events with article, reader and history columns.  Stand-ins from the
    customer table: device type from the segment, postcode from the nation, age
    from the balance; session length is the user's events of the same hour."""
    ev = st.events_view(spark, sf)
    art = st.articles(spark, sf).select(
        "article_id", "article_type", "sentiment_score", "total_inviews", "total_pageviews", "total_read_time",
        F.col("premium").cast("int").alias("premium"), "published_time")
    reader = st.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.substring("c_mktsegment", 1, 1).alias("device_type"),
        F.col("c_nationkey").alias("postcode"), F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"))
    history = ev.groupBy("user_id").agg(F.avg("read_time").alias("user_read_time_mean"),
                                        F.avg("scroll_percentage").alias("user_scroll_percentage_mean"))
    hour = F.date_trunc("HOUR", "impression_time")
    session = ev.groupBy("user_id", hour.alias("_hour")).agg(F.count(F.lit(1)).alias("session_len"))
    rows = (ev.withColumn("_hour", hour).join(session, ["user_id", "_hour"]).drop("_hour").join(history, "user_id")
            .join(reader, "user_id", "left").join(art, "article_id", "left"))
    rows = rows.withColumn("view_gap", duration_seconds("impression_time", "published_time"))
    return with_time_features(rows, "impression_time")


WIDE = EV + ",\n" + ART + f""",
hist AS (SELECT user_id, avg(read_time) AS user_read_time_mean, avg(scroll_percentage) AS user_scroll_percentage_mean
         FROM ev GROUP BY user_id),
wide AS (
  SELECT ev.event_id, ev.user_id, ev.article_id, ev.impression_time, ev.category, ev.read_time, art.article_type,
         art.sentiment_score, art.total_inviews, art.total_pageviews, art.total_read_time,
         CAST(art.premium AS INTEGER) AS premium, substr(c_mktsegment, 1, 1) AS device_type, c_nationkey AS postcode,
         CAST(floor(c_acctbal / 100) AS INTEGER) AS age, user_read_time_mean, user_scroll_percentage_mean,
         count(*) OVER (PARTITION BY ev.user_id, date_trunc('hour', ev.impression_time)) AS session_len,
         {dur_s('ev.impression_time', 'art.published_time')} AS view_gap,
         CAST(dayofyear(ev.impression_time) AS INTEGER) AS dayofyear,
         CAST(isodow(ev.impression_time) * 24 + hour(ev.impression_time) AS INTEGER) AS day_hour,
         CAST(isodow(ev.impression_time) * 1440 + hour(ev.impression_time) * 60
              + minute(ev.impression_time) AS INTEGER) AS day_minute,
         {epoch_s('ev.impression_time')} AS total_seconds
  FROM ev JOIN hist USING (user_id) LEFT JOIN customer ON c_custkey = ev.user_id
       LEFT JOIN art ON ev.article_id = art.article_id)"""

_CLOCKS = [None, "dayofyear", "day_hour", "day_minute", "total_seconds"]


def _rollup(pivot: str) -> Rollup:
    return Rollup(pivot, DENSE, DISTINCT, ORDER, count_names=COUNTS[pivot])


def _key_sets(r: Rollup):
    spec = {}
    for kind, col, name in rollup_names(r):
        clock = next((c for c in _CLOCKS[1:] if name.endswith(f"_{c}")), None)
        if kind == "count":
            clock = next(c for c, n in r.count_names.items() if n == name)
        spec.setdefault(clock, []).append((kind, col, name))
    return [([c, r.pivot] if c else [r.pivot], spec[c]) for c in _CLOCKS]


def _places(kind, col):
    """Decimals to compare: gaps in seconds reach 1e9."""
    return 2 if col == "view_gap" and kind in ("mean", "std") else 6


NUDGE = 1e-9  # means of 2^n values with two decimals end in a 5


def _nudged(name: str, places: int):
    """Rounded as DuckDB does it, to the nearest integer of 10^-places, halves
    away from zero: Spark's ``round`` goes through a decimal number, most of the
    time of 490 columns."""
    unit = F.lit(float(10 ** places))
    value = (F.col(name).cast("double") + F.lit(NUDGE)) * unit
    even = F.rint(value)
    half = F.when(value - even == F.signum(value) * 0.5, F.signum(value)).otherwise(F.lit(0.0))
    return (even + half) / unit + F.lit(0.0)


def _register_rollup(pivot: str):
    r = _rollup(pivot)

    @query(f"pivot_rollup_{pivot.removesuffix('_id')}", stats_sql(WIDE, "wide", ["event_id"], _key_sets(r), ORDER, _places, NUDGE))
    def _q(spark, sf):
        base = wide_base(spark, sf).select(*dict.fromkeys([*ORDER, pivot, *r.named_clocks, *DENSE, *DISTINCT]))
        out = attach_rollups(base, [r])
        return out.select("event_id", *[
            F.col(n).cast("long").alias(n) if k in INT_KINDS else _nudged(n, _places(k, c)).alias(n)
            for k, c, n in rollup_names(r)])
    return _q


for _p in ("user_id", "article_id"):
    _register_rollup(_p)


_COUNT_SETS = [(keys, [("count", None, name)]) for name, keys in COUNT_KEY_SETS]


@query("counts_rollup", stats_sql(WIDE, "wide", ["event_id"], _COUNT_SETS))
def q_counts_rollup(spark, sf):
    """All twelve count windows (W6), counted per (entity, second) and merged up."""
    rows = wide_base(spark, sf).select("event_id", "impression_time", *dict.fromkeys(c for _, k in COUNT_KEY_SETS for c in k))
    out = count_features(rows, form="rollup", order=["impression_time", "event_id"])
    return out.select("event_id", *[F.col(n).cast("long").alias(n) for n, _ in COUNT_KEY_SETS])


# ------------------------------------- gaps and rolling means over them --

GAPS = ["article_before", "article_after", "user_article_before", "user_article_after"]
ROLLED = GAPS + DENSE


def _rolling_sql():
    frame = "ORDER BY impression_time, event_id ROWS BETWEEN {} PRECEDING AND CURRENT ROW"
    cols = ", ".join(f"ROUND(CASE WHEN count({c}) OVER w{w} = {w} THEN avg({c}) OVER w{w} END + {NUDGE}, 6) + 0.0 AS {c}_mean{w}"
                     for w in (3, 5, 7) for c in ROLLED)
    names = ", ".join([*GAPS, "user_article_before_2", "user_article_after_2"])
    windows = ", ".join(f"w{w} AS ({frame.format(w - 1)})" for w in (3, 5, 7))
    return with_(WIDE) + f""", g AS (
  SELECT *, {dur_s('impression_time', 'lag(impression_time) OVER a')} AS article_before,
    {dur_s('impression_time', 'lead(impression_time) OVER a')} AS article_after,
    {dur_s('impression_time', 'lag(impression_time) OVER u')} AS user_article_before,
    {dur_s('impression_time', 'lead(impression_time) OVER u')} AS user_article_after,
    {dur_s('impression_time', 'lag(impression_time, 2) OVER u')} AS user_article_before_2,
    {dur_s('impression_time', 'lead(impression_time, 2) OVER u')} AS user_article_after_2
  FROM wide WINDOW a AS (PARTITION BY article_id ORDER BY impression_time, event_id),
                   u AS (PARTITION BY user_id, article_id ORDER BY impression_time, event_id))
SELECT event_id, {names}, {cols} FROM g WINDOW {windows}"""


@query("order_features", _rolling_sql())
def q_order_features(spark, sf):
    """Gaps per article and per (user, article) (W2-W4), then the 42 rolling
    means of the frame over the gaps and the dense columns (W5)."""
    rows = wide_base(spark, sf).select("event_id", "user_id", "article_id", "impression_time", *DENSE)
    rows = B.gaps(rows, ["article_id"], "impression_time", ["event_id"], {1: ("article_before", "article_after")})
    rows = B.gaps(rows, ["user_id", "article_id"], "impression_time", ["event_id"],
                  {1: ("user_article_before", "user_article_after"), 2: ("user_article_before_2", "user_article_after_2")})
    rows = B.rolling(rows, ROLLED, (3, 5, 7), ORDER)
    return rows.select("event_id", *GAPS, "user_article_before_2", "user_article_after_2", *[
        r6(F.col(f"{c}_mean{w}") + F.lit(NUDGE)).alias(f"{c}_mean{w}") for w in (3, 5, 7) for c in ROLLED])
