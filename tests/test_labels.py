"""The label of candidate lines: one shuffled window, no map-side sum."""

from __future__ import annotations

import datetime

from rankfold.plans.catalog_core import labeled_candidates

LINES = [(1, 1, 7, 1, "R"), (1, 2, 7, 1, "N"), (1, 3, 8, 1, "N"), (1, 4, None, 1, "R"), (1, 5, None, 1, "A"), (2, 1, 7, 1, "N"),
         (2, 1, 7, 1, "N"), (3, 1, 9, 1, None), (4, 1, 9, 1, "R"), (None, 1, 9, 1, "R")]


def test_labels_are_maxima_over_lines_without_a_map_side_sum(spark, tmp_path):
    day = datetime.datetime(1995, 1, 1)
    rows = [(o, n, p, s, float(n), day, r, 0.1, 0.2, 3.0) for o, n, p, s, r in LINES]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, "
                          "l_shipdate timestamp_ntz, l_returnflag string, l_discount double, l_tax double, l_quantity double"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(o, 10 + o, day) for o in (1, 2, 3)] + [(2, 99, day)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    got = labeled_candidates(spark, str(tmp_path))
    assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()
    found = sorted((r["impression_id"], r["article_id"] or 0, r["user_id"], r["label"]) for r in got.collect())
    assert found == [(1, 0, 11, 1), (1, 0, 11, 1), (1, 7, 11, 1), (1, 7, 11, 1), (1, 8, 11, 0),
                     *[(2, 7, u, 0) for u in (12, 12, 99, 99)], (3, 9, 13, None)]
