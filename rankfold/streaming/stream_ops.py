"""Structured Streaming counterparts of batch operators.

The reference has no stream processing; these are the incremental forms of
its batch features.  State lives in the checkpoint folder under the shared
``spark.checkpoint.dir`` (never a machine-local path on a cluster), so a
restarted query resumes exactly; sinks are parquet folders or
``foreachBatch`` writers, both idempotent per batch id.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rankfold.session import ensure_checkpoint_dir


def stream_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}-{uuid.uuid4().hex[:12]}"


def read_events_stream(spark: SparkSession, folder: str, file_glob: str = "events.parquet",
                       max_files_per_trigger: int = 1) -> DataFrame:
    """File-source stream over the parquet files of a folder; the schema is
    taken from the batch table (streams need a declared schema)."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{file_glob}").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder))


def windowed_counts(events: DataFrame, ts: str, keys: list[str], window: str = "1 minute",
                    watermark: str = "1 hour") -> DataFrame:
    """Per-window counts with late-data tolerance (Z2): a window is emitted
    once the watermark passes its end; its state is then dropped."""
    return (events.withWatermark(ts, watermark)
            .groupBy(F.window(ts, window).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n"))


def run_to_parquet(query_df: DataFrame, name: str, output_mode: str = "append") -> str:
    """Run a streaming query over everything available, write parquet, and
    return the output folder (checkpoint beside it)."""
    spark = query_df.sparkSession
    out = stream_folder(spark, name)
    q = (query_df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", out + "/_checkpoint").option("path", out + "/data")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out + "/data"


def run_foreach_batch(query_df: DataFrame, name: str, fn: Callable[[DataFrame, int], None]) -> str:
    """Run ``fn(batch_df, batch_id)`` for every micro-batch."""
    spark = query_df.sparkSession
    out = stream_folder(spark, name)
    q = (query_df.writeStream.foreachBatch(fn).option("checkpointLocation", out + "/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def block_scoring(events: DataFrame, transform: Callable[[DataFrame], DataFrame], name: str,
                  key: list[str]) -> str:
    """Incremental scoring (Z1): every micro-batch is transformed and
    written under ``batch_id=<n>`` with overwrite of that partition only, so
    a replayed batch replaces its own output instead of duplicating it."""
    out_holder = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        (transform(batch).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .parquet(f"{out_holder['out']}/data/batch_id={batch_id}"))

    spark = events.sparkSession
    out = stream_folder(spark, name)
    out_holder["out"] = out
    q = (events.writeStream.foreachBatch(write).option("checkpointLocation", out + "/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out + "/data"


GAP_SCHEMA = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("user_before", T.LongType())])
GAP_STATE = T.StructType([T.StructField("last_us", T.LongType()),
                          T.StructField("last_id", T.LongType())])


def _gap_fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Per user: seconds since the previous event, carried across batches.
    The state is one (timestamp, id) pair per user."""
    last_us, last_id = (state.get if state.exists else (None, None))
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return
    df = pd.concat(frames).sort_values(["ts_us", "event_id"], kind="mergesort")
    prev = df["ts_us"].shift(1)
    if last_us is not None:
        prev.iloc[0] = last_us
    gap = df["ts_us"] - prev
    # truncation toward zero of whole seconds, as the batch operator
    secs = np.sign(gap) * (gap.abs() // 1_000_000)
    out = pd.DataFrame({"event_id": df["event_id"].astype("int64"),
                        "user_id": df["user_id"].astype("int64"),
                        "user_before": secs.astype("Int64")})
    state.update((int(df["ts_us"].iloc[-1]), int(df["event_id"].iloc[-1])))
    yield out


def user_gaps(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Seconds since the user's previous event as a stateful stream (Z3).

    No state timeout: a processing-time timeout makes every trigger run
    extra no-data batches (an available-now run would not end); idle-user
    eviction belongs to a watermark-driven event-time timeout upstream."""
    import sys

    from pyspark import cloudpickle

    from rankfold.functions.scalar import epoch_micros
    # ship the state function by value: executors need not have this
    # package on their path (it only uses numpy and pandas)
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    src = events.select("event_id", "user_id", epoch_micros(ts).alias("ts_us"))
    return src.groupBy("user_id").applyInPandasWithState(
        _gap_fn, GAP_SCHEMA, GAP_STATE, "append", GroupStateTimeout.NoTimeout)
