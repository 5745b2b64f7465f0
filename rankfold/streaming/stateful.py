"""Event-time state with timers, and an upsert sink.

* ``ordered_gaps``: seconds since a user's previous event, right for late rows
  too.  A user's state is the events that later rows may still precede; a late
  row gets its gap, and the row after it is given out again with its new gap.
  An event-time timer drops the settled part of the state once the watermark
  passes, and the whole state after ``idle`` without events.
* ``upsert_windows``: window counts in update mode; each micro-batch replaces
  the windows that it changed, so the last, still open windows are there too.

Both write versions keyed by batch: a batch that is run again writes the same
rows again, and readers take the last version of a key.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rankfold.functions.scalar import epoch_micros
from rankfold.streaming.stream_ops import stream_folder

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
GAP_ROWS = "event_id long, user_id long, user_before long, version long"


class GapProcessor(StatefulProcessor):
    """State of a user, one value that is read and written once a batch: the
    events after the watermark and the last one before it, in order; ``rounds``,
    which counts the times a row was given out; and the pending timer.

    A user has one timer at most.  It is not moved with every batch: when it
    fires too early, it is set again for the last event then known."""

    def __init__(self, idle_ms: int) -> None:
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "ts_us array<bigint>, event_id array<bigint>, rounds bigint, timer_ms bigint")

    def _settle(self, rows: list[tuple[int, int]], watermark_us: int) -> list[tuple[int, int]]:
        """Events that a later row may still precede, and the one before them."""
        first = next((i for i, r in enumerate(rows) if r[0] > watermark_us), len(rows))
        return rows[max(0, first - 1):]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        times, events, n, timer = self.held.get() or ([], [], 0, None)
        held = list(zip(times, events))
        watermark = timerValues.getCurrentWatermarkInMs()
        if held and held[-1][0] // 1000 + self.idle_ms <= watermark:
            held = []  # the timer is due, and fires after this batch's rows
        known = set(held)
        new = {(r["ts_us"], r["event_id"]) for r in rows} - known
        if not new:
            return
        n += 1
        merged = sorted(known | new)
        for i, (t, event) in enumerate(merged):
            # New rows, and rows whose predecessor is new.
            if (t, event) in new or (i and merged[i - 1] in new):
                gap = None if i == 0 else (t - merged[i - 1][0]) // 1_000_000
                yield Row(event_id=event, user_id=key[0], user_before=gap, version=n)
        kept = self._settle(merged, watermark * 1000)
        if timer is None:
            timer = merged[-1][0] // 1000 + self.idle_ms
            self.handle.registerTimer(timer)
        self.held.update(([t for t, _ in kept], [e for _, e in kept], n, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        times, events, n, _ = self.held.get() or ([], [], 0, None)
        if not times:
            return iter(())
        due = times[-1] // 1000 + self.idle_ms
        if due <= timerValues.getCurrentWatermarkInMs():
            self.held.clear()  # idle: what comes later starts anew
        else:
            self.handle.registerTimer(due)
            self.held.update((times, events, n, due))
        return iter(())

    def close(self) -> None:
        pass


def ordered_gaps(events: DataFrame, ts: str = "ts", lateness: str = "1 hour", idle: str = "60 days") -> DataFrame:
    """Stream of (event_id, user_id, user_before, version): the last version
    of an event is its gap.  Needs the RocksDB state store."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    amount, unit = idle.split()
    idle_ms = int(pd.Timedelta(int(amount), unit.rstrip("s")).total_seconds() * 1000)
    rows = (events.withColumn("_at", F.timestamp_micros(epoch_micros(ts))).withWatermark("_at", lateness)
            .select("user_id", "event_id", epoch_micros(ts).alias("ts_us"), "_at"))
    return rows.groupBy("user_id").transformWithState(
        statefulProcessor=GapProcessor(idle_ms), outputStructType=GAP_ROWS, outputMode="Update", timeMode="EventTime")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state and timers need, for queries started
    inside; a batch commits its changes, not a copy of the store."""
    settings = {PROVIDER: ROCKSDB, CHANGELOG: "true"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_versions(query: DataFrame, name: str, output_mode: str = "update") -> str:
    """Run the stream over what is available; every micro-batch's rows go to
    their own folder, which a repeated batch overwrites.  Returns the folder."""
    spark = query.sparkSession
    out = stream_folder(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/data/batch={batch_id}")

    q = (query.writeStream.foreachBatch(write).outputMode(output_mode).option("checkpointLocation", f"{out}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{out}/data"


def latest(spark: SparkSession, folder: str, key: list[str], schema: str) -> DataFrame:
    """The last version of every key over all batches."""
    rows = spark.read.schema(f"{schema}, batch long").option("basePath", folder).parquet(folder)
    rest = [c for c in rows.columns if c not in key]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_r"))
    return newest.select(*key, *[F.col("_r")[c].alias(c) for c in rest if c != "batch"])


def upsert_windows(events: DataFrame, ts: str, keys: list[str], window: str, lateness: str, name: str) -> str:
    """Counts per window and key in update mode; returns the folder of versions."""
    counts = (events.withWatermark(ts, lateness).groupBy(F.window(ts, window).alias("w"), *keys)
              .agg(F.count(F.lit(1)).alias("n"))
              .select(F.unix_micros("w.start").alias("window_us"), *keys, "n"))
    return run_versions(counts, name)


def roll_up(counts: DataFrame, keys: list[str], seconds: int) -> DataFrame:
    """Finer window counts summed to windows of ``seconds`` (hours, days)."""
    width = seconds * 1_000_000
    start = F.col("window_us") - F.pmod(F.col("window_us"), F.lit(width))
    return counts.groupBy(start.alias("window_us"), *keys).agg(F.sum("n").alias("n"))
