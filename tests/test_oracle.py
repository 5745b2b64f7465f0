"""Every registered query with an oracle equals DuckDB on sf0.001 (or on the
tables that ORACLE_SF_DIR names); the rows-only queries run and return rows."""

import math
import os

import duckdb
import pandas as pd
import pytest

from rankfold.plans.registry import ORACLE, QUERIES, load_all
from rankfold.sources.staging import TABLES

from conftest import SF_SMALL

SF_DIR = os.environ.get("ORACLE_SF_DIR", SF_SMALL)
load_all()
SLOW = {"model_select", "stacked_scores", "fm_scores", "mlp_scores", "gbt_scores", "importances",
        "pairwise_rank_scores", "lr_scores"}


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, bool):
        return float(v)
    if isinstance(v, (int, float)) or (type(v).__module__ == "numpy" and not hasattr(v, "__len__")):
        f = float(v)
        return None if math.isnan(f) else round(f, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)),
                        key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    exp = con.execute(ORACLE[name]).df()
    gc, gr = _rows(got)
    ec, er = _rows(exp)
    assert gc == ec
    assert len(gr) == len(er)
    assert gr == er


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


@pytest.mark.parametrize("name", ["pairwise_products", "fm_interaction", "avg_pool", "softmax_attend"])
def test_rounded_arrays_hold_no_negative_zero(spark, name):
    """The sign of a zero counts where values are compared as bytes."""
    sf = "/root/testdata/sf0.01"
    got = QUERIES[name](spark, sf).toPandas()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")

    def flat(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        return [y for x in v for y in flat(x)] if isinstance(v, (list, tuple)) else [v]

    for frame in (got, con.execute(ORACLE[name]).df()):
        for col in frame.columns:
            assert not any(isinstance(x, float) and x == 0 and math.copysign(1, x) < 0 for v in frame[col] for x in flat(v)), col
