"""Structured Streaming queries (phase 9): each runs the stream over the
whole events table with an available-now trigger and returns the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from rankfold.functions.scalar import epoch_micros
from rankfold.operators.encode import fit_scaler
from rankfold.plans.registry import query, r6
from rankfold.streaming import stateful
from rankfold.streaming import stream_ops as Z


@query("stream_minute_counts", f"""
WITH b AS (SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS ws, user_id FROM events),
mx AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events)
SELECT CAST(floor(epoch_us(ws) / 1000000.0) AS BIGINT) AS window_start, user_id, count(*) AS n
FROM b, mx WHERE ws + INTERVAL 1 MINUTE <= wm GROUP BY ws, user_id""")
def q_stream_minute_counts(spark, sf):
    """Per-minute user counts with a 1-hour watermark (Z2).  In append mode
    a window is final once the watermark (max event time - 1 hour) passes
    its end; later windows stay in state for the next data."""
    ev = Z.read_events_stream(spark, sf)
    # event time must be an instant: the wall clock is read as UTC micros
    ev = ev.withColumn("ts", F.timestamp_micros(epoch_micros("ts")))
    out = Z.run_to_parquet(Z.windowed_counts(ev, "ts", ["user_id"], "1 minute", "1 hour"), "minute_counts")
    res = spark.read.parquet(out)
    start = (F.unix_micros("window_start") / F.lit(1_000_000)).cast("long")
    return res.select(start.alias("window_start"), "user_id", "n")


@query("stream_user_gap", """
SELECT event_id, user_id,
  CAST(trunc((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1000000.0) AS BIGINT)
    AS user_before
FROM events""")
def q_stream_user_gap(spark, sf):
    """Seconds since the user's previous event, kept as per-user state (Z3)."""
    ev = Z.read_events_stream(spark, sf)
    out = Z.run_to_parquet(Z.user_gaps(ev), "user_gap")
    return spark.read.parquet(out).select("event_id", "user_id", "user_before")


@query("stream_block_scoring", """
WITH s AS (SELECT min(value) AS a, max(value) AS b FROM events)
SELECT event_id, ROUND((value - a) / CASE WHEN b = a THEN 1 ELSE b - a END, 6) AS score FROM events, s""")
def q_stream_block_scoring(spark, sf):
    """Incremental block scoring (Z1): a scaler fitted on the batch table is
    applied to every micro-batch through foreachBatch."""
    ev_batch = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    model = fit_scaler(ev_batch.select(F.col("value").alias("score")), ["score"], "minmax")
    ev = Z.read_events_stream(spark, sf)
    out = Z.block_scoring(ev.select("event_id", F.col("value").alias("score")),
                          lambda b: model.transform(b), "block_scoring", ["event_id"])
    return spark.read.parquet(out).select("event_id", r6("score").alias("score"))


def _arrivals(spark, sf, files: int = 6):
    """The events as ``files`` files in order of time, where every 17th event
    arrives one file late.  All cores read the table for a file, one writes it."""
    ev = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet")
    at = epoch_micros("ts")
    lo, hi = ev.agg(F.min(at), F.max(at)).first()
    width = max(1, (hi - lo) // files + 1)
    part = F.least(((at - F.lit(lo)) / F.lit(width)).cast("int") + (F.col("event_id") % 17 == 0).cast("int"), F.lit(files - 1))
    folder = Z.stream_folder(spark, "arrivals")
    for i in range(files):  # one after the other: the source reads files by their time
        ev.where(part == i).repartition(1).write.mode("append").parquet(folder)
    return folder, ev.schema


@query("stream_ordered_gap", """
SELECT event_id, user_id,
  CAST(trunc((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1000000.0) AS BIGINT)
    AS user_before
FROM events""")
def q_stream_ordered_gap(spark, sf):
    """Gaps from six files with late rows (Z3): state across batches, late rows
    put in order, the row after a late one given out again."""
    folder, schema = _arrivals(spark, sf)
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with stateful.rocksdb(spark):
        out = stateful.run_versions(stateful.ordered_gaps(ev, "ts", lateness="12 days"), "ordered_gap")
    return stateful.latest(spark, out, ["event_id"], stateful.GAP_ROWS).select("event_id", "user_id", "user_before")


@query("stream_window_counts", """
WITH e AS (SELECT user_id, epoch_us(ts) AS t FROM events),
w(level, width) AS (VALUES ('minute', 60000000), ('hour', 3600000000), ('day', 86400000000))
SELECT level, CAST((t - t % width) // 1000000 AS BIGINT) AS window_start, user_id, count(*) AS n
FROM e, w GROUP BY ALL""")
def q_stream_window_counts(spark, sf):
    """Minute counts by upsert, the open windows too, and their hours and days."""
    folder, schema = _arrivals(spark, sf)
    ev = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
          .withColumn("ts", F.timestamp_micros(epoch_micros("ts"))))
    out = stateful.upsert_windows(ev, "ts", ["user_id"], "1 minute", "12 days", "window_counts")
    minutes = stateful.latest(spark, out, ["window_us", "user_id"], "window_us long, user_id long, n long")
    levels = {"minute": minutes, "hour": stateful.roll_up(minutes, ["user_id"], 3600), "day": stateful.roll_up(minutes, ["user_id"], 86400)}
    rows = [df.select(F.lit(level).alias("level"), (F.col("window_us") / 1_000_000).cast("long").alias("window_start"), "user_id", "n")
            for level, df in levels.items()]
    return rows[0].union(rows[1]).union(rows[2])
