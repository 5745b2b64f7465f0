"""Readers and writers."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Lazy parquet scan (S1/S2): filters and projections reach the reader."""
    return spark.read.parquet(*paths)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None,
             sep: str = ",", n_rows: int | None = None, header: bool = True) -> DataFrame:
    """CSV scan with separator, declared types and optional row limit (S3).
    ``path`` may be a directory, a glob or a list; files are concatenated."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(path)
    return df.limit(n_rows) if n_rows else df


def read_score_files(spark: SparkSession, paths: dict[str, str], key: list[str],
                     score: str = "score", schema: str | T.StructType | None = None) -> DataFrame:
    """Several score CSVs side by side, aligned by key (S4): every key of any
    file, null where a file lacks it.  Give the
    ``schema`` to avoid a type-inference pass over every file."""
    def reader():
        r = spark.read.option("header", True)
        return r.schema(schema) if schema is not None else r.option("inferSchema", True)
    frames = [reader().csv(p).select(*key, F.col(score).cast("double").alias(name))
              for name, p in paths.items()]
    return reduce(lambda a, b: a.join(b, key, "full"), frames)


def read_embeddings(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """Pretrained (key, vector) parquet."""
    return spark.read.parquet(path).select(F.col(key).alias("key"), F.col(value).alias("value"))


def write_parquet(df: DataFrame, path: str, block_rows: int | None = None,
                  mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet sink; ``block_rows`` caps rows per file."""
    w = df.write.mode(mode)
    if block_rows:
        w = w.option("maxRecordsPerFile", block_rows)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def block_stats(spark: SparkSession, path: str, batch_size: int) -> dict:
    """Rows, files and batches of a blocked parquet directory."""
    df = spark.read.parquet(path)
    n = df.count()
    files = len(df.inputFiles())
    return {"num_samples": n, "num_blocks": files, "num_batches": -(-n // batch_size)}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with header."""
    df.write.mode(mode).option("header", True).csv(path)


def dataset_manifest(splits: dict[str, DataFrame], vocab_sizes: DataFrame | None = None,
                     numeric: list[str] | None = None, label: str = "click",
                     max_len: dict[str, int] | None = None) -> dict:
    """Sample counts per split, vocab sizes, numeric columns, label."""
    out = {"label": label, "numeric": list(numeric or []), "max_len": dict(max_len or {})}
    out["samples"] = {k: v.count() for k, v in splits.items()}
    if vocab_sizes is not None:
        out["vocab_size"] = {r["feature"]: int(r["vocab_size"]) for r in vocab_sizes.collect()}
    return out


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    """Manifest as one line of JSON, by Spark's writer: any file system."""
    line = spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def write_vocab_json(vocab: DataFrame, path: str, token: str = "token", id_col: str = "id") -> None:
    """Vocabulary sink ordered by id (S13); written by executors, not the driver."""
    vocab.select(token, id_col).orderBy(id_col).write.mode("overwrite").json(path)


def append_results(spark: SparkSession, path: str, exp_id: str, dataset_id: str, split: str,
                   metrics: dict[str, float]) -> None:
    """Append-only result log."""
    rows = [(exp_id, dataset_id, split, k, float(v)) for k, v in metrics.items()]
    df = spark.createDataFrame(rows, "exp_id string, dataset_id string, split string, metric string, value double")
    df.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)


def exclude_done(df: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not already done (S15): a left anti join."""
    return df.join(done.select(*key).distinct(), key, "left_anti")


def union_splits(splits: dict[str, DataFrame], split_col: str = "split") -> DataFrame:
    """Union of split tables by column name, tagging each row's split."""
    frames = [df.withColumn(split_col, F.lit(name)) for name, df in splits.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
