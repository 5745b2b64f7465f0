"""Parquet blocks in row order (S7, S8): file n holds rows n * size to
(n + 1) * size of the table's order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.operators.index import global_index


def write_ordered_blocks(df: DataFrame, path: str, order: list[str], block_rows: int) -> None:
    """Write ``df`` as one file per block under ``path/block=<n>``, rows in
    ``order`` (a total order) within and across blocks.  The block number comes
    from the row's index and is the partitioning of the write, so a block is
    written by one task whatever the input's layout was."""
    if block_rows < 1:
        raise ValueError("block_rows must be positive")
    indexed = global_index(df, order, "row_index", 0)
    block = (F.col("row_index") - F.col("row_index") % block_rows) / block_rows
    (indexed.withColumn("block", block.cast("long")).repartition("block").sortWithinPartitions("block", "row_index")
     .write.partitionBy("block").parquet(path))


def block_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(block, first_row, end_row, rows, files) of every block; ``end_row`` is
    exclusive."""
    blocks = spark.read.parquet(path).select(F.col("block").cast("long").alias("block"), "row_index",
                                             F.col("_metadata.file_path").alias("file"))
    return blocks.groupBy("block").agg(F.min("row_index").alias("first_row"), (F.max("row_index") + 1).alias("end_row"),
                                       F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))


def read_block_range(spark: SparkSession, path: str, first: int, end: int) -> DataFrame:
    """Rows of the blocks ``first`` to ``end`` (exclusive); other files are not read."""
    return spark.read.parquet(path).where((F.col("block") >= first) & (F.col("block") < end))
