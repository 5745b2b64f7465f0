"""Sources and sinks round trips."""

import json
import os

from pyspark.sql import functions as F

from rankfold.sources import io
from rankfold.sources import staging as st

from conftest import SF_SMALL


def test_csv_with_schema_limit_and_glob(spark, tmp_path):
    df = st.table(spark, SF_SMALL, "customer").select("c_custkey", "c_mktsegment")
    io.write_csv(df, str(tmp_path / "c"))
    back = io.read_csv(spark, str(tmp_path / "c" / "*.csv"), "c_custkey long, c_mktsegment string", n_rows=10)
    assert back.count() == 10 and back.dtypes == [("c_custkey", "bigint"), ("c_mktsegment", "string")]


def test_blocked_parquet_and_block_stats(spark, tmp_path):
    df = st.table(spark, SF_SMALL, "orders").coalesce(1)
    io.write_parquet(df, str(tmp_path / "b"), block_rows=400)
    stats = io.block_stats(spark, str(tmp_path / "b"), batch_size=128)
    assert stats["num_samples"] == 1500 and stats["num_blocks"] == 4 and stats["num_batches"] == 12


def test_vocab_json_manifest_and_result_log(spark, tmp_path):
    vocab = spark.createDataFrame([("b", 2), ("a", 1)], "token string, id long")
    io.write_vocab_json(vocab, str(tmp_path / "v"))
    rows = [json.loads(x) for f in sorted(os.listdir(tmp_path / "v")) if f.endswith(".json")
            for x in open(tmp_path / "v" / f)]
    assert [r["id"] for r in rows] == [1, 2]
    sizes = spark.createDataFrame([("user_id", 27)], "feature string, vocab_size long")
    man = io.dataset_manifest({"train": vocab}, sizes, ["price"], "clk", {"seq": 5})
    assert man["samples"] == {"train": 2} and man["vocab_size"] == {"user_id": 27}
    io.append_results(spark, str(tmp_path / "log"), "exp1", "ds", "valid", {"AUC": 0.7})
    io.append_results(spark, str(tmp_path / "log"), "exp2", "ds", "valid", {"AUC": 0.8})
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 2 and log.agg(F.max("value")).first()[0] == 0.8


def test_union_and_exclude(spark):
    a = spark.createDataFrame([(1,), (2,)], "k long")
    b = spark.createDataFrame([(3,)], "k long")
    u = io.union_splits({"train": a, "test": b})
    assert sorted((r.k, r.split) for r in u.collect()) == [(1, "train"), (2, "train"), (3, "test")]
    assert [r.k for r in io.exclude_done(u, a, ["k"]).collect()] == [3]
