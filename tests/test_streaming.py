"""Streaming operators over a file source in a temp folder: watermark drops
late rows, per-user state carries across micro-batches."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from rankfold.functions.scalar import epoch_micros
from rankfold.streaming import stream_ops as Z

SCHEMA = "event_id long, ts timestamp_ntz, user_id long"


def _write(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def test_watermark_drops_late_rows_and_state_spans_batches(spark, tmp_path):
    src = tmp_path / "src"
    t0 = datetime(2024, 1, 1, 0, 0, 0)
    first = [(i, t0 + timedelta(minutes=i), 1) for i in range(0, 180, 10)]          # 00:00 .. 02:50
    late = [(1000, t0 + timedelta(minutes=5), 1)]                                   # behind the watermark
    later = [(2000 + i, t0 + timedelta(minutes=300 + i), 1) for i in range(3)]       # 05:00 .. 05:02
    _write(spark, src, first, "b1")
    schema = spark.read.parquet(f"{src}/b1").schema
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{src}/*").withColumn("ts", F.timestamp_micros(epoch_micros("ts"))))
    counts = Z.windowed_counts(stream, "ts", ["user_id"], "1 minute", "1 hour")
    q = (counts.writeStream.format("memory").queryName("wm_counts").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck1")).start())
    q.processAllAvailable()
    _write(spark, src, late + later, "b2")
    q.processAllAvailable()
    q.stop()
    got = spark.sql("SELECT window_start, n FROM wm_counts").collect()
    starts = sorted(r.window_start for r in got)
    # windows up to (05:02 - 1h) are final; the late 00:05 row was dropped
    assert all(r.n == 1 for r in got)
    assert len(starts) == len(first)

    gaps = Z.user_gaps(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/*"))
    q2 = (gaps.writeStream.format("memory").queryName("gaps").outputMode("append")
          .option("checkpointLocation", str(tmp_path / "ck2")).start())
    q2.processAllAvailable()
    q2.stop()
    g = {r.event_id: r.user_before for r in spark.sql("SELECT * FROM gaps").collect()}
    assert g[10] == 600 and g[0] is None
    assert len(g) == len(first) + len(late) + len(later)


def test_late_rows_are_put_in_order_and_idle_state_goes(spark, tmp_path):
    from rankfold.streaming import stateful
    src, t0 = str(tmp_path / "src"), datetime(2024, 1, 1)
    batches = [
        [(1, t0, 1), (3, t0 + timedelta(minutes=20), 1), (4, t0 + timedelta(minutes=1), 2)],
        [(2, t0 + timedelta(minutes=5), 1), (5, t0 + timedelta(minutes=30), 1)],  # event 2 is late
        [(6, t0 + timedelta(days=30), 3)],                                        # time moves on; users 1 and 2 idle
        [(7, t0 + timedelta(days=30, minutes=1), 1), (8, t0 + timedelta(days=30, minutes=2), 3)]]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    with stateful.rocksdb(spark):
        out = stateful.run_versions(stateful.ordered_gaps(stream, "ts", lateness="1 hour", idle="2 days"), "late")
    got = {r["event_id"]: r["user_before"] for r in stateful.latest(spark, out, ["event_id"], stateful.GAP_ROWS).collect()}
    assert got[1] is None and got[2] == 300 and got[3] == 900 and got[5] == 600 and got[8] == 120
    assert got[6] is None and got[4] is None
    assert got[7] is None  # the state of user 1 expired
    versions = spark.read.parquet(out).where("event_id = 3").count()
    assert versions == 2  # given out again after the late row


def test_open_windows_are_upserted(spark, tmp_path):
    from rankfold.streaming import stateful
    src, t0 = str(tmp_path / "src"), datetime(2024, 1, 1)
    for rows in ([(1, t0, 1), (2, t0 + timedelta(seconds=90), 1)], [(3, t0 + timedelta(seconds=30), 1)]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
              .withColumn("ts", F.timestamp_micros(epoch_micros("ts"))))
    out = stateful.upsert_windows(stream, "ts", ["user_id"], "1 minute", "1 hour", "upsert")
    minutes = stateful.latest(spark, out, ["window_us", "user_id"], "window_us long, user_id long, n long")
    assert sorted(r["n"] for r in minutes.collect()) == [1, 2]
    assert stateful.roll_up(minutes, ["user_id"], 3600).first()["n"] == 3


def test_a_user_has_one_timer_which_follows_the_last_event(spark, tmp_path):
    """State is read and written once a batch; a timer that fires early is set again."""
    from rankfold.streaming import stateful

    class Held:
        value, calls = None, 0

        def get(self):
            self.calls += 1
            return self.value

        def update(self, value):
            self.calls += 1
            self.value = value

        def clear(self):
            self.value = None

    class Handle:
        def __init__(self):
            self.timers = []

        def getValueState(self, name, schema):
            return Held()

        def registerTimer(self, at):
            self.timers.append(at)

    class Now:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    from pyspark.sql import Row
    hour = 3_600_000_000
    p = stateful.GapProcessor(idle_ms=2 * 3_600_000)
    p.init(handle := Handle())
    give = lambda ms, *rows: [(r["event_id"], r["user_before"], r["version"]) for r in p.handleInputRows(
        (1,), iter([Row(ts_us=t, event_id=e) for t, e in rows]), Now(ms))]
    assert give(0, (0, 1)) == [(1, None, 1)]
    assert give(0, (hour, 2)) == [(2, 3600, 2)]
    assert give(0, (hour // 2, 3)) == [(3, 1800, 3), (2, 1800, 3)] and give(0, (hour, 2)) == []
    assert handle.timers == [2 * 3_600_000] and p.held.calls == 7  # the repeated row changed nothing
    assert list(p.handleExpiredTimer((1,), Now(2 * 3_600_000), None)) == [] and p.held.value is not None
    assert handle.timers[1:] == [3 * 3_600_000]
    assert list(p.handleExpiredTimer((1,), Now(3 * 3_600_000), None)) == [] and p.held.value is None
