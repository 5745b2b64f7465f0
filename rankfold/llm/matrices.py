"""Sums of one matrix a partition, added by Spark before the driver reads them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCKS = 64  # pieces of a matrix that are added apart


def matrix_sum(rows: DataFrame, part: Callable[[Iterator[pa.RecordBatch]], np.ndarray], shape: tuple[int, int],
               dtype=np.float64) -> np.ndarray:
    """Sum over the partitions of ``part(batches)``, a matrix of ``shape``.

    Every partition cuts its matrix into at most ``BLOCKS`` pieces, which are
    shuffled and added by piece: there are as many matrices as cores, and the
    driver gets one."""
    step = max(1, -(-shape[0] // BLOCKS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = part(batches)
        for at in range(0, shape[0], step):
            yield pa.record_batch([pa.array([at], pa.int64()), pa.array([total[at:at + step].astype(dtype).tobytes()], pa.binary())],
                                  names=["at", "part"])

    def add(pieces: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in pieces:
            for at, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                piece = np.frombuffer(raw, dtype).astype(np.float64)
                total[at] = total[at] + piece if at in total else piece
        if total:
            yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                  names=["at", "part"])

    out = np.zeros(shape)
    kind = "at long, part binary"
    # equal pieces meet in one task, each of which holds some pieces only
    rows = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    for r in rows.mapInArrow(run, kind).repartition(min(BLOCKS, shape[0]), "at").mapInArrow(add, kind).collect():
        out[r["at"]:r["at"] + step] = np.frombuffer(r["part"]).reshape(-1, shape[1])
    return out
