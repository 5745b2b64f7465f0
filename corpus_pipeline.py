"""The corpus pipeline: five stages over a table of documents.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; its result is written as Parquet in the shared folder and read again as
the next one's ``docs``.  All but the last return the columns of documents.

1. language id: rows that the classifier rejects go.
2. line dedup: lines (with near copies) that occur ``LINE_COUNT`` times or more
   keep their first occurrence only; a document whose lines are all gone goes.
   As in op5, every repeat counts: a passage of two documents that differ
   otherwise is not found by the next stage, which judges documents.
3. SimHash near-dedup: one document of each group stays.
4. benchmark decontamination: documents that hold a benchmark item go.
5. best-fit packing: token pieces with their sequence and offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm import decontam, langid, linededup, packing, simhash
from rankfold.llm.queries import tokenizer_path
from rankfold.llm.store import ship, stored

LINE_COUNT = 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return langid.keep_recognised(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    done = linededup.drop_repeated_lines(docs, min_count=LINE_COUNT)
    dropped = F.col(done.columns[-1])
    left = F.coalesce(F.length(F.trim("text")), F.lit(0))
    kept = done.where((dropped == 0) | (left > 0))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        kept = kept.withColumn("n_chars", F.when(dropped > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return kept.select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path()).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [("language id", language_id), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_dedup),
          ("benchmark decontamination", decontaminate), ("best-fit packing", best_fit_packing)]
ORACLE_SQL = None  # edit distance, SimHash, SVD and tokenizers have no SQL form; see tests/llm/test_pipeline.py


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
