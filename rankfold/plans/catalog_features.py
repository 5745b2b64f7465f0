"""History aggregates, lag/lead gaps, rolling means, clock counts and pivot
statistics (phase 2/3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankfold.functions.scalar import duration_seconds, with_time_features
from rankfold.operators import features as FT
from rankfold.operators import ordered as O
from rankfold.plans.oracle import ART, CAND, EV, dur_s, epoch_s, with_
from rankfold.plans.registry import query, r6
from rankfold.sources import staging as st

INT_KINDS = ("count", "nunique")


# ------------------------------------------------------------ bases -----

def ev_base(spark, sf):
    """Events as a history/impression log with article attributes and clocks."""
    ev = st.events_view(spark, sf)
    art = st.articles(spark, sf).select(
        "article_id", "article_type", "sentiment_score", "total_inviews", "published_time",
        F.col("category").alias("art_category"))
    j = ev.join(art, "article_id", "left")
    j = j.withColumn("click_gap", duration_seconds("impression_time", "published_time"))
    return with_time_features(j, "impression_time")


EVB = EV + ",\n" + ART + f""",
evb AS (
  SELECT ev.*, art.article_type, art.sentiment_score, art.total_inviews, art.published_time,
         art.category AS art_category,
         CAST(trunc((epoch_us(ev.impression_time) - epoch_us(art.published_time)) / 1000000.0) AS BIGINT)
           AS click_gap,
         CAST(dayofyear(ev.impression_time) AS INTEGER) AS dayofyear,
         CAST(isodow(ev.impression_time) * 24 + hour(ev.impression_time) AS INTEGER) AS day_hour,
         CAST(isodow(ev.impression_time) * 1440 + hour(ev.impression_time) * 60
              + minute(ev.impression_time) AS INTEGER) AS day_minute,
         {epoch_s('ev.impression_time')} AS total_seconds
  FROM ev LEFT JOIN art ON ev.article_id = art.article_id)"""


def _places(kind, col):
    """Decimals to compare: gaps in seconds reach 1e8, where the last digits of
    a mean or deviation depend on the order of summation."""
    return 2 if col == "click_gap" and kind in ("mean", "std") else 6


def _finish(df, row_cols, spec):
    """Round float statistics, widen integer ones, keep row identity."""
    cols = [F.col(c) for c in row_cols]
    for kind, col, name in spec:
        cols.append(F.col(name).cast("long").alias(name) if kind in INT_KINDS
                    else (F.round(F.col(name).cast("double"), _places(kind, col)) + F.lit(0.0)).alias(name))
    return df.select(*cols)


# ------------------------------------------------------ SQL generator ---

def _sql_agg(kind, col, order_sql):
    if kind == "count":
        return "count(*)"
    if kind == "nunique":
        return f"count(DISTINCT {col}) + max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END)"
    if kind == "mean":
        return f"avg({col})"
    if kind == "std":
        return f"stddev_samp({col})"
    if kind == "maxmin":
        return f"max({col}) - min({col})"
    if kind == "skew":
        d = f"({col} - mu_{col})"
        return (f"CASE WHEN min({col}) = max({col}) THEN NULL ELSE "
                f"avg(pow({d}, 3)) / pow(avg(pow({d}, 2)), 1.5) END")
    if kind == "first":
        return f"arg_min_null({col}, {order_sql})"
    if kind == "last":
        return f"arg_max_null({col}, {order_sql})"
    return f"{kind}({col})"   # min, max, median


def stats_sql(ctes: str, base: str, row_cols, key_sets, order=None, places=_places, nudge=0.0):
    """Oracle: one GROUP BY per key set joined back null-safely.  ``nudge`` is
    added before rounding, so that exact ties round the same way everywhere."""
    fused = {}
    for keys, spec in key_sets:
        fused.setdefault(tuple(keys), []).extend(spec)
    order_sql = "(" + ", ".join(order) + ")" if order else None
    parts, joins, outs = [ctes], [], [f"b.{c}" for c in row_cols]
    for i, (keys, spec) in enumerate(fused.items()):
        kl = ", ".join(keys)
        skew_cols = sorted({c for k, c, _ in spec if k == "skew"})
        src = base
        if skew_cols:
            mus = ", ".join(f"avg({c}) OVER (PARTITION BY {kl}) AS mu_{c}" for c in skew_cols)
            parts.append(f"m{i} AS (SELECT *, {mus} FROM {base})")
            src = f"m{i}"
        aggs = ", ".join(f"{_sql_agg(k, c, order_sql)} AS \"{n}\"" for k, c, n in spec)
        parts.append(f"g{i} AS (SELECT {kl}, {aggs} FROM {src} GROUP BY {kl})")
        cond = " AND ".join(f"b.{k} IS NOT DISTINCT FROM g{i}.{k}" for k in keys)
        joins.append(f"LEFT JOIN g{i} ON {cond}")
        for k, c, n in spec:
            outs.append(f"CAST(g{i}.\"{n}\" AS BIGINT) AS \"{n}\"" if k in INT_KINDS
                        else f"ROUND(CAST(g{i}.\"{n}\" AS DOUBLE) + {nudge}, {places(k, c)}) + 0.0 AS \"{n}\"")
    return ("WITH " + ",\n".join(parts) + f"\nSELECT {', '.join(outs)} FROM {base} b\n" + "\n".join(joins))


def _register_stats(name, key_sets, row_cols=("event_id",), order=("impression_time", "event_id")):
    sql = stats_sql(EVB, "evb", list(row_cols), key_sets, list(order))

    @query(name, sql)
    def _q(spark, sf):
        df = ev_base(spark, sf)
        out = FT.attach_stats(df, key_sets, order=list(order))
        spec = [s for _, sp in key_sets for s in sp]
        return _finish(out, list(row_cols), spec)
    return _q


# ---------------------------------------------------- pivot statistics --

DENSE = ["read_time", "sentiment_score", "click_gap", "total_inviews"]
NUNIQ = ["article_id", "article_type", "category", "user_id"]


def _pivots(kinds, nunique=()):
    return [FT.pivot_spec(p, list(nunique), DENSE, kinds) for p in ("user_id", "article_id")]


_register_stats("pivot_nunique", _pivots((), NUNIQ))
_register_stats("pivot_minmax", _pivots(("min", "max", "maxmin")))
_register_stats("pivot_mean", _pivots(("mean",)))
_register_stats("pivot_median", _pivots(("median",)))
_register_stats("pivot_std", _pivots(("std",)))
_register_stats("pivot_skew", _pivots(("skew",)))
_register_stats("pivot_first_last", _pivots(("first", "last")))
_register_stats("pivot_clock_stats", [
    FT.pivot_spec("user_id", ["article_type"], ["read_time"], ("mean", "median", "max"), clock="day_hour"),
    FT.pivot_spec("article_id", ["user_id"], ["read_time", "click_gap"], ("mean", "std", "first"),
                  clock="dayofyear"),
    FT.pivot_spec("user_id", ["category"], ["read_time"], ("min", "last"), clock="total_seconds"),
])
_register_stats("counts_user_clock", [
    (keys, [("count", None, name)]) for name, keys in FT.COUNT_KEY_SETS[:10]])
_register_stats("counts_user_type_day", [
    (keys, [("count", None, name)]) for name, keys in FT.COUNT_KEY_SETS[10:]])


# -------------------------------------------------- history aggregates --

HIST_DENSE = ["sentiment_score", "read_time", "click_gap"]
USER_SPEC = ([("nunique", c, f"{c}_nunique_gby_user") for c in ("article_id", "article_type", "category")]
             + [(k, c, f"{c}_{k}_gby_user") for k in ("mean", "min", "max", "std") for c in HIST_DENSE]
             + [("count", None, "user_count")])


def _hist_sql_aggs(spec):
    out = []
    for k, c, n in spec:
        e = _sql_agg(k, c, None)
        out.append(f"CAST({e} AS BIGINT) AS {n}" if k in INT_KINDS else f"ROUND(CAST({e} AS DOUBLE), {_places(k, c)}) AS {n}")
    return ", ".join(out)


@query("hist_user_stats", with_(EVB) + f"SELECT user_id, {_hist_sql_aggs(USER_SPEC)} FROM evb GROUP BY user_id")
def q_hist_user_stats(spark, sf):
    st_ = FT.group_stats(ev_base(spark, sf), ["user_id"], USER_SPEC)
    return _finish(st_, ["user_id"], USER_SPEC)


PAIR_SETS = [
    (["user_id", "article_id"], [("count", None, "user_article_count")]),
    (["user_id", "article_type"], [("count", None, "user_article_type_count")]),
    (["user_id", "category"], [("count", None, "user_category_count")]),
    (["article_type"], [("count", None, "article_type_count")]),
    (["category"], [("count", None, "category_count")]),
]
_register_stats("hist_pair_counts", PAIR_SETS)


def hist_long(spark, sf):
    """History in long form — one row per click, as the reference's history
    arrays are after their explode — with article attributes (category = the
    article's category).  Built from the event rows directly, so no user's
    history is ever held in one array."""
    from rankfold.functions.scalar import sentiment_to_int
    long = st.events_view(spark, sf).select("user_id", "article_id", "impression_time", "read_time",
                                            "scroll_percentage")
    art = st.articles(spark, sf).select("article_id", "article_type", "category", "sentiment_score",
                                        "sentiment_label", "published_time")
    j = long.join(art, "article_id", "left")
    return j.withColumns({"click_gap": duration_seconds("impression_time", "published_time"),
                          "sentiment_label": sentiment_to_int("sentiment_label")})


HIST_JOIN_COLS = (["article_id_nunique_gby_user", "article_type_nunique_gby_user", "category_nunique_gby_user"]
                  + [f"{c}_{k}_gby_user" for k in ("mean", "min", "max", "std")
                     for c in ("sentiment_score", "sentiment_label", "click_gap")]
                  + ["user_count", "user_id_nunique_gby_article", "article_count", "article_type_count",
                     "category_count", "user_article_count", "user_article_type_count", "user_category_count"])

_HS_DENSE = ["sentiment_score", "sentiment_label", "click_gap"]
_HS_SETS = [
    (["user_id"], [("nunique", c, f"{c}_nunique_gby_user") for c in ("article_id", "article_type", "category")]
     + [(k, c, f"{c}_{k}_gby_user") for k in ("mean", "min", "max", "std") for c in _HS_DENSE]
     + [("count", None, "user_count")]),
    (["article_id"], [("nunique", "user_id", "user_id_nunique_gby_article"), ("count", None, "article_count")]),
    (["article_type"], [("count", None, "article_type_count")]),
    (["category"], [("count", None, "category_count")]),
    (["user_id", "article_id"], [("count", None, "user_article_count")]),
    (["user_id", "article_type"], [("count", None, "user_article_type_count")]),
    (["user_id", "category"], [("count", None, "user_category_count")]),
]


def _hist_join_sql():
    hl = f"""hl AS (
  SELECT ev.user_id, ev.article_id, art.article_type, art.category, art.sentiment_score,
         CASE WHEN art.sentiment_label IS NULL THEN NULL WHEN art.sentiment_label = 'Positive' THEN 1 ELSE 0 END
           AS sentiment_label,
         CAST(trunc((epoch_us(ev.impression_time) - epoch_us(art.published_time)) / 1000000.0) AS BIGINT)
           AS click_gap
  FROM ev LEFT JOIN art ON ev.article_id = art.article_id)"""
    cj = """cj AS (SELECT c.impression_id, c.pos, c.user_id, c.article_id, a.article_type, a.category
  FROM cand c LEFT JOIN art a ON c.article_id = a.article_id)"""
    parts = [CAND, EV, ART, hl, cj]
    joins, outs = [], ["b.impression_id", "b.pos"]
    for i, (keys, spec) in enumerate(_HS_SETS):
        kl = ", ".join(keys)
        aggs = ", ".join(f"{_sql_agg(k, c, None)} AS {n}" for k, c, n in spec)
        parts.append(f"h{i} AS (SELECT {kl}, {aggs} FROM hl GROUP BY {kl})")
        joins.append(f"LEFT JOIN h{i} ON " + " AND ".join(f"b.{k} = h{i}.{k}" for k in keys))
        for k, c, n in spec:
            outs.append(f"CAST(h{i}.{n} AS BIGINT) AS {n}" if k in INT_KINDS
                        else f"ROUND(CAST(h{i}.{n} AS DOUBLE), {_places(k, c)}) AS {n}")
    return "WITH " + ",\n".join(parts) + f"\nSELECT {', '.join(outs)} FROM cj b\n" + "\n".join(joins)


@query("hist_features_joined", _hist_join_sql())
def q_hist_features_joined(spark, sf):
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "user_id", "article_id")
    art = st.articles(spark, sf).select("article_id", "article_type", "category")
    c = c.join(art, "article_id", "left")
    out = FT.history_stats(c, hist_long(spark, sf), dense=_HS_DENSE)
    spec = [s for _, sp in _HS_SETS for s in sp]
    return _finish(out, ["impression_id", "pos"], spec)


# ------------------------------------------------------ lag / lead ------

@query("user_lag_lead", """
WITH b AS (SELECT DISTINCT l_orderkey AS impression_id, o_custkey AS user_id, o_orderdate AS t
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT impression_id, user_id,
  CAST(trunc((epoch_us(t) - epoch_us(lag(t) OVER w)) / 1000000.0) AS BIGINT) AS user_before,
  CAST(trunc((epoch_us(t) - epoch_us(lead(t) OVER w)) / 1000000.0) AS BIGINT) AS user_after
FROM b WINDOW w AS (PARTITION BY user_id ORDER BY t, impression_id)""")
def q_user_lag_lead(spark, sf):
    b = st.behaviors(spark, sf).select("impression_id", "user_id", "impression_time")
    g = O.lag_lead_gaps(b, ["user_id"], "impression_time", ["impression_id"], {1: ("user_before", "user_after")})
    return g.select("impression_id", "user_id", "user_before", "user_after")


@query("article_lag_lead", with_(CAND) + f"""
SELECT impression_id, pos, article_id,
  {dur_s('impression_time', 'lag(impression_time) OVER w')} AS article_before,
  {dur_s('impression_time', 'lead(impression_time) OVER w')} AS article_after
FROM cand WINDOW w AS (PARTITION BY article_id ORDER BY impression_time, impression_id, pos)""")
def q_article_lag_lead(spark, sf):
    c = st.candidate_lines(spark, sf).select("impression_id", "pos", "article_id", "impression_time")
    g = O.lag_lead_gaps(c, ["article_id"], "impression_time", ["impression_id", "pos"],
                        {1: ("article_before", "article_after")})
    return g.select("impression_id", "pos", "article_id", "article_before", "article_after")


@query("user_article_lag2", with_(EV) + f"""
SELECT event_id,
  {dur_s('impression_time', 'lag(impression_time) OVER w')} AS user_article_before,
  {dur_s('impression_time', 'lead(impression_time) OVER w')} AS user_article_after,
  {dur_s('impression_time', 'lag(impression_time, 2) OVER w')} AS user_article_before_2,
  {dur_s('impression_time', 'lead(impression_time, 2) OVER w')} AS user_article_after_2
FROM ev WINDOW w AS (PARTITION BY user_id, article_id ORDER BY impression_time, event_id)""")
def q_user_article_lag2(spark, sf):
    ev = st.events_view(spark, sf).select("event_id", "user_id", "article_id", "impression_time")
    g = O.lag_lead_gaps(ev, ["user_id", "article_id"], "impression_time", ["event_id"],
                        {1: ("user_article_before", "user_article_after"),
                         2: ("user_article_before_2", "user_article_after_2")})
    return g.select("event_id", "user_article_before", "user_article_after",
                    "user_article_before_2", "user_article_after_2")


@query("user_lag_lead_chunked", with_(EV) + f"""
SELECT event_id,
  {dur_s('impression_time', 'lag(impression_time) OVER w')} AS user_before,
  {dur_s('impression_time', 'lead(impression_time) OVER w')} AS user_after
FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY impression_time, event_id)""")
def q_user_lag_lead_chunked(spark, sf):
    """The skew-safe form forced on: exact against the plain window."""
    ev = st.events_view(spark, sf).select("event_id", "user_id", "impression_time")
    g = O.lag_lead_gaps(ev, ["user_id"], "impression_time", ["event_id"], {1: ("user_before", "user_after")},
                        strategy="chunked", chunk_rows=1000)
    return g.select("event_id", "user_before", "user_after")


# ------------------------------------------------------ rolling means ---

def _rolling_sql(w):
    frame = f"ORDER BY impression_time, impression_id, pos ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW"
    cols = ", ".join(
        f"ROUND(CASE WHEN count({c}) OVER ({frame}) = {w} THEN avg({c}) OVER ({frame}) END, 6) AS {c}_mean{w}"
        for c in ("score_a", "quantity"))
    return with_(CAND) + f"SELECT impression_id, pos, {cols} FROM cand"


def _register_rolling(w):
    @query(f"rolling_global_{w}", _rolling_sql(w))
    def _q(spark, sf):
        c = st.candidate_lines(spark, sf).select("impression_id", "pos", "impression_time", "score_a", "quantity")
        r = O.rolling_means(c, ["score_a", "quantity"], [w], [], ["impression_time", "impression_id", "pos"])
        return r.select("impression_id", "pos", r6(f"score_a_mean{w}").alias(f"score_a_mean{w}"),
                        r6(f"quantity_mean{w}").alias(f"quantity_mean{w}"))
    return _q


for _w in (3, 5, 7):
    _register_rolling(_w)


@query("rolling_by_user_3", with_(EV) + """
SELECT event_id, ROUND(CASE WHEN count(read_time) OVER w = 3 THEN avg(read_time) OVER w END, 6) AS read_time_mean3
FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY impression_time, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def q_rolling_by_user(spark, sf):
    ev = st.events_view(spark, sf).select("event_id", "user_id", "impression_time", "read_time")
    r = O.rolling_means(ev, ["read_time"], [3], ["user_id"], ["impression_time", "event_id"])
    return r.select("event_id", r6("read_time_mean3").alias("read_time_mean3"))
