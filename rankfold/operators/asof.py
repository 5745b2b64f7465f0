"""As-of merge of events and samples.

Events and samples (or cutoffs) become one table, sorted once by (key, time):
at equal times samples come first, since a sample sees what lies strictly
before it.  A narrow pass carries, within a key, the number of events so far
and the last few of them.  A key may span any number of partitions: every
partition reports its first and last key's number of events and its last key's
last ``last_n`` events, and gets what was carried up to it.  No key's events are
ever held as one array, and a key with a third of all events is split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from rankfold.operators.selection import _starts
from rankfold.session import ensure_checkpoint_dir


def map_ids(events: DataFrame, item: str, ids: DataFrame, out: str | None = None) -> DataFrame:
    """Items replaced by their ids (``item``, ``id``); rows of unknown or null
    items go, as they have no place in a sequence."""
    named = ids.select(F.col(item).alias("_item"), F.col("id").cast("long").alias("_id"))
    return (events.join(named, F.col(item) == F.col("_item")).withColumn(out or item, F.col("_id")).drop("_item", "_id"))


def _tail(parts: list[pa.Table]) -> pa.Table | None:
    return pa.concat_tables(parts) if parts else None


def _edges(key: str, last_n: int):
    """Two rows a partition: its first key's and its last key's events."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _tail([pa.Table.from_batches([b]) for b in batches if b.num_rows])
        if table is None:
            return
        at = _starts(table, [key])
        event = table.column("_event").to_numpy()
        n = np.add.reduceat(event.astype(np.int64), at)
        pick = [0, len(at) - 1]
        items = table.column("_item").combine_chunks().fill_null(0).to_numpy()
        tails = []
        for i in pick:
            part = slice(at[i], at[i + 1] if i + 1 < len(at) else len(event))
            tails.append(items[part][event[part]][-last_n:].tolist() if last_n else [])
        names = table.select(["_pid", key]).take(pa.array(at[pick])).combine_chunks().to_batches()[0]
        yield pa.RecordBatch.from_arrays(
            [*names.columns, pa.array(n[pick]), pa.array(tails, pa.list_(pa.int64())), pa.array([0, 1], pa.int32()),
             pa.array([len(at) == 1] * 2)], names=["_pid", key, "_n", "_items", "_last", "_whole"])

    return run


def _carry(key: str, last_n: int, before):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _tail([pa.Table.from_batches([b]) for b in batches if b.num_rows])
        if table is None:
            return
        carried, items_before = before.value[table.column("_pid")[0].as_py()]
        rows = table.num_rows
        at = _starts(table, [key])
        run_of = np.repeat(np.arange(len(at)), np.diff(np.append(at, rows)))
        event = table.column("_event").to_numpy().astype(np.int64)
        ahead = np.cumsum(event) - event  # events of the partition before each row
        seen = ahead - ahead[at][run_of]
        count = seen + np.where(run_of == 0, carried, 0)
        pool = np.concatenate([np.array(items_before, np.int64), table.column("_item").combine_chunks().fill_null(0).to_numpy()[event > 0]])
        # Events of a row's key before it: the last ``last_n`` of pool[.. ahead + carried items].
        have = np.minimum(seen + np.where(run_of == 0, len(items_before), 0), last_n)
        end = ahead + len(items_before)
        offsets = np.concatenate([[0], np.cumsum(have)])
        index = np.arange(offsets[-1]) - np.repeat(offsets[:-1], have) + np.repeat(end - have, have)
        lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(pool[index] if len(index) else np.empty(0, np.int64)))
        out = table.drop_columns(["_pid", "_item"])
        done = pa.Table.from_arrays([*out.columns, pa.array(count), lists], names=[*out.column_names, "_seen", "_lasts"])
        yield from done.to_batches(max_chunksize=16_384)

    return run


def asof_merge(events: DataFrame, samples: DataFrame | None, key: str, ts: str, item: str, tiebreak: Sequence[str],
               last_n: int = 0, num_partitions: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(events with ``seq_pos``, samples with ``seq_len`` and ``last_items``).

    ``seq_pos`` is an event's 0-based place among its key's events in order of
    (ts, tiebreak, item); ``seq_len`` the number of the key's events strictly
    before the sample's ts, and ``last_items`` the last ``last_n`` of them,
    oldest first.  Items are long ids (``map_ids``)."""
    spark = events.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ev = events.select(F.col(key), F.col(ts), F.lit(True).alias("_event"), F.struct(*tiebreak).alias("_tie"),
                       F.col(item).cast("long").alias("_item"), F.struct(*events.columns).alias("_left"))
    rows = ev
    if samples is not None:
        right = samples.select(F.col(key), F.col(ts), F.lit(False).alias("_event"),
                               F.lit(None).cast("long").alias("_item"), F.struct(*samples.columns).alias("_right"))
        rows = ev.unionByName(right, allowMissingColumns=True)
    order = [key, ts, "_event", "_tie", "_item"]
    sorted_ = (rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
               .withColumn("_pid", F.spark_partition_id())).checkpoint(eager=True)
    kinds = {f.name: f for f in sorted_.schema}
    parts: dict[int, list] = {}
    edge = StructType([kinds["_pid"], kinds[key], StructField("_n", LongType()), StructField("_items", ArrayType(LongType())),
                       StructField("_last", IntegerType()), StructField("_whole", BooleanType())])
    for r in sorted_.mapInArrow(_edges(key, last_n), edge).collect():  # two rows a partition, last_n items each
        parts.setdefault(r["_pid"], [None, None])[r["_last"]] = r
    before, open_key, count, items = {}, (), 0, []
    for pid in sorted(parts):
        first, last = parts[pid]
        same = (first[key],) == open_key
        before[pid] = (count, items) if same else (0, [])
        if first["_whole"]:
            count, items = (count if same else 0) + first["_n"], ((items if same else []) + list(first["_items"]))[-last_n or len(items):]
        else:
            count, items = last["_n"], list(last["_items"])
        items = items[-last_n:] if last_n else []
        open_key = (last[key],)
    shared = spark.sparkContext.broadcast(before)  # last_n items a partition
    out_fields = [f for f in sorted_.schema if f.name not in ("_pid", "_item")]
    done = sorted_.mapInArrow(_carry(key, last_n, shared), StructType(
        [*out_fields, StructField("_seen", LongType()), StructField("_lasts", ArrayType(LongType()))]))
    placed = done.where("_event").select("_left.*", F.col("_seen").alias("seq_pos"))
    if samples is None:
        return placed, None
    return placed, done.where("NOT _event").select("_right.*", F.col("_seen").alias("seq_len"), F.col("_lasts").alias("last_items"))
