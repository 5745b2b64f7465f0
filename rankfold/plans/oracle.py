"""SQL (DuckDB dialect) versions of the staging views, used as CTEs by the
oracle strings.  They mirror ``rankfold.sources.staging`` column for column."""

CAND = """cand AS (
  SELECT l.l_orderkey AS impression_id, o.o_custkey AS user_id, o.o_orderdate AS impression_time,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l_linenumber, l_partkey,
              l_suppkey, l_extendedprice, l_shipdate, l_returnflag, l_discount, l_tax, l_quantity) - 1 AS BIGINT) AS pos,
         l.l_partkey AS article_id,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS line_label,
         l_discount AS score_a, l_extendedprice AS score_b, l_tax AS score_c, l_quantity AS quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

# candidates with the membership label (an article clicked anywhere in the impression)
CAND_LABELED = CAND + """,
cand_l AS (
  SELECT *, CAST(max(line_label) OVER (PARTITION BY impression_id, article_id) AS INTEGER) AS label FROM cand)"""

EV = """ev AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS article_id,
         ts AS impression_time, event_type AS category, value AS read_time,
         least(value * 2, 100.0) AS scroll_percentage,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS label
  FROM events)"""

ART = """art AS (
  SELECT p_partkey AS article_id, p_name AS title, p_type AS category, p_brand AS article_type,
         p_size AS total_inviews, p_size % 5 AS total_pageviews, p_retailprice AS total_read_time,
         p_size / 50.0 AS sentiment_score,
         CASE p_type WHEN 'PROMO' THEN 'Positive' WHEN 'STANDARD' THEN 'Neutral' WHEN 'SMALL' THEN 'Positive'
                     WHEN 'LARGE' THEN 'Negative' WHEN 'MEDIUM' THEN 'Neutral' WHEN 'ECONOMY' THEN 'Negative' END
           AS sentiment_label,
         p_size > 25 AS premium,
         TIMESTAMP '1992-01-01 00:00:00' + to_days(CAST(p_partkey % 2000 AS INTEGER)) AS published_time
  FROM part)"""


def epoch_s(col: str) -> str:
    """Floor epoch seconds of a naive timestamp."""
    return f"CAST(floor(epoch_us({col}) / 1000000.0) AS BIGINT)"


def dur_s(later: str, earlier: str) -> str:
    """Whole seconds later - earlier, truncated toward zero."""
    return f"CAST(trunc((epoch_us({later}) - epoch_us({earlier})) / 1000000.0) AS BIGINT)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
