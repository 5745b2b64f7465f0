"""Shared-folder tables and binary files.

Every intermediate table or file is written by Spark's own writers (task
commit protocol, any Hadoop file system) under the folder that
``spark.checkpoint.dir`` names, so a lost executor never takes data with it
and no executor reads another one's local disk.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.session import ensure_checkpoint_dir


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: tasks import
    it whatever folder they run in.  The archive is code only; Spark copies it."""
    sc = spark.sparkContext
    if getattr(sc, "_rankfold_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(root):
        path = os.path.join(tempfile.mkdtemp(prefix="rankfold-code-"), "rankfold_code.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.join("rankfold", os.path.relpath(full, root)))
        sc.addPyFile(path)
    sc._rankfold_shipped = True


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the
    lineage ends here, and later readers see fixed rows."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_files(df: DataFrame, column: str, path: str, trailer: bytes) -> None:
    """Write each row's binary ``column`` as one file: its bytes, then
    ``trailer`` (a format's fixed last bytes).

    Spark's text writer copies a string's bytes unchanged and ends a row with
    ``lineSep``; one row per file and the trailer as separator make it a
    writer of arbitrary binary files on every Hadoop file system.
    """
    (df.select(F.col(column).cast("string").alias("value")).write
     .option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", trailer.decode("latin-1")).text(path))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the files that ``write_files`` wrote."""
    return (spark.read.format("binaryFile").load(path)
            .select("path", "length", "content").where(F.col("length") > 0))
