"""Models on sparse vectors whose weights fit no single process.

Training rows lie in parts of ``PART_ROWS`` rows, the weights in ranges of
``RANGE_SLOTS`` slots.  A part knows the slots its rows name; a step sends it
their weights, and it sends its gradient on them back.  The driver holds a few
numbers a step and part, whatever the slots.  Parts are dealt by a row's first
slot, so a field of many values that comes first is read by one part each, but
by values of all slots after it: rows that share it may lie in several parts.
"""

from __future__ import annotations

import gc
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rankfold.session import written

PART_ROWS = 250_000
RANGE_SLOTS = 200_000
KEEP_STEPS = 3  # steps whose shuffle files may be needed again before the weights are checkpointed


def _cells(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries a row, slots and values of a batch of vectors, dense ones too."""
    vectors = vectors.storage if isinstance(vectors, pa.ExtensionArray) else vectors
    if vectors.null_count:
        raise ValueError("a vector is null")
    values, indices = vectors.field("values"), vectors.field("indices")
    sizes = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    dense = vectors.field("type").to_numpy(zero_copy_only=False) == 1
    at = np.empty(int(sizes.sum()), np.int64)
    rows = np.repeat(dense, sizes)
    at[~rows] = indices.flatten().to_numpy()
    at[rows] = (np.arange(len(at)) - np.repeat(sizes.cumsum() - sizes, sizes))[rows]
    return sizes, at, values.flatten().to_numpy()


def _pack(sizes: np.ndarray, at: np.ndarray, values: np.ndarray, **more) -> bytes:
    """Rows with the slots they name numbered from 0; ones are not kept."""
    slots, inverse = np.unique(at, return_inverse=True)
    odd = np.flatnonzero(values != 1)
    return pickle.dumps({"sizes": sizes.astype(np.int32), "slots": slots, "at": inverse.astype(np.int32),
                         "odd": odd.astype(np.int32), "values": values[odd], **more}, protocol=5)


class _Rows:
    """A packed part, with sums over a row's entries and over a slot's."""

    def __init__(self, raw: bytes) -> None:
        part = pickle.loads(raw)
        self.part, self.slots, self.at, self.sizes = part, part["slots"], part["at"], part["sizes"]
        self.n = len(self.sizes)
        self.value = np.ones(len(self.at))
        self.value[part["odd"]] = part["values"]
        self.row = np.repeat(np.arange(self.n, dtype=np.int32), self.sizes)
        self.filled = np.flatnonzero(self.sizes)
        self.starts = (self.sizes.cumsum(dtype=np.int64) - self.sizes)[self.filled]

    def by_row(self, cells: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, *cells.shape[1:]))
        if len(self.starts):
            out[self.filled] = np.add.reduceat(cells, self.starts, axis=0)
        return out

    def by_slot(self, cells: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, weights=cells, minlength=len(self.slots))


def _machine(rows: _Rows, weights: np.ndarray, intercept: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Raw score of every row, the factors' terms of every entry and their sums a row."""
    cells = weights[rows.at] * rows.value[:, None]
    sums = rows.by_row(cells)
    terms, total = cells[:, :-1], sums[:, :-1]
    raw = intercept + sums[:, -1] + 0.5 * ((total * total).sum(axis=1) - rows.by_row((terms * terms).sum(axis=1)))
    return raw, terms, total


def _sigmoid(raw: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-raw))


def _single(rdd: RDD) -> RDD:
    """One element a batch, as ``zip`` needs it."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _size(df: DataFrame, column: str) -> int:
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    return int(known) if known is not None else df.select(column).first()[0].size


# java.util.Random, from any place of its stream: Spark ML draws its first weights with it.
_MASK, _A, _C = (1 << 48) - 1, 0x5DEECE66D, 0xB
DRAWS = 1 << 17  # pairs drawn by one task


def _jump(steps: int) -> tuple[int, int]:
    """(a, c) of that many steps at once."""
    a, c, fa, fc = 1, 0, _A, _C
    while steps:
        if steps & 1:
            a, c = a * fa & _MASK, (c * fa + fc) & _MASK
        fa, fc, steps = fa * fa & _MASK, (fc * fa + fc) & _MASK, steps >> 1
    return a, c


def _gaussians(seed: int, chunk: int, draws: int) -> np.ndarray:
    """What ``nextGaussian`` gives from the pairs chunk * draws and on."""
    a, c = _jump(chunk * draws * 4 + 1)
    states = np.array([(((seed ^ _A) & _MASK) * a + c) & _MASK], np.uint64)
    while len(states) < 4 * draws:
        a, c = _jump(len(states))
        states = np.concatenate([states, (states * np.uint64(a) + np.uint64(c)) & np.uint64(_MASK)])
    s = states[:4 * draws].reshape(-1, 2)
    u = (((s[:, 0] >> np.uint64(22)) << np.uint64(27)) + (s[:, 1] >> np.uint64(21))).astype(np.float64) * 2.0 ** -53
    v = 2 * u.reshape(-1, 2) - 1
    norm = (v * v).sum(axis=1)
    kept = (norm < 1) & (norm > 0)
    v, norm = v[kept], norm[kept]
    return (v * np.sqrt(-2 * np.log(norm) / norm)[:, None]).ravel()


def first_weights(sc, size: int, k: int, seed: int, std: float, width: int) -> RDD:
    """(range, weights): slot by slot the k factors that Spark ML starts from, and a linear 0."""
    wanted, ranges, draws = size * k, -(-size // width), DRAWS
    chunks = int(wanted / 2 / 0.785 * 1.001 / draws) + 2
    while True:  # once: about 0.785 of the pairs are kept
        counts = sc.parallelize(range(chunks), chunks).map(lambda c: len(_gaussians(seed, c, draws))).collect()  # one number a task
        if sum(counts) >= wanted:
            break
        chunks *= 2
    begins = np.r_[0, np.cumsum(counts)].tolist()

    def deal(c: int):
        at, found = begins[c], _gaussians(seed, c, draws)
        found = found[:max(wanted - at, 0)]
        while len(found):
            r = at // (width * k)
            cut = found[:(r + 1) * width * k - at]
            yield r, (at, cut.tobytes())
            at, found = at + len(cut), found[len(cut):]

    def place(r: int, cells: Iterator) -> Iterator:
        n = min(width, size - r * width)
        out = np.zeros((n, k + 1))
        flat = np.zeros(n * k)
        for _, (at, raw) in cells:
            cut = np.frombuffer(raw)
            flat[at - r * width * k:at - r * width * k + len(cut)] = cut
        out[:, :k] = flat.reshape(n, k) * std
        yield r, out

    return sc.parallelize(range(chunks), chunks).flatMap(deal).partitionBy(ranges).mapPartitionsWithIndex(place)


class Parts:
    """Rows of ``df`` dealt to parts, and the ranges' lists of what each part reads."""

    def __init__(self, df: DataFrame, label: str, features: str) -> None:
        from rankfold.llm.store import ship
        spark, sc = df.sparkSession, df.sparkSession.sparkContext
        ship(spark)
        self.spark, self.sc, self.size, self.features, self.kept = spark, sc, _size(df, features), features, None
        self.width = RANGE_SLOTS
        self.ranges = max(1, -(-self.size // self.width))

        def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                sizes, at, values = _cells(b.column(1))
                labels = b.column(0)
                if labels.null_count or not np.isin(labels.to_numpy(), (0, 1)).all():
                    raise ValueError("a label is not 0 or 1")
                ends = pa.array(np.r_[0, sizes.cumsum()].astype(np.int32))
                first = np.full(len(sizes), -1)
                first[sizes > 0] = at[(sizes.cumsum() - sizes)[sizes > 0]]
                yield pa.RecordBatch.from_arrays([pa.array(first), labels, pa.ListArray.from_arrays(ends, pa.array(at)),
                                                  pa.ListArray.from_arrays(ends, pa.array(values))], names=["first", "y", "at", "value"])

        rows = written(df.select(F.col(label).cast("double"), features).mapInArrow(
            flat, "first long, y double, at array<long>, value array<double>"), "sparse-rows")
        self.n = rows.count()
        self.parts = max(sc.defaultParallelism, -(-self.n // PART_ROWS))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = list(batches)
            if found:
                t = pa.Table.from_batches(found).combine_chunks()
                at, value = t.column("at").combine_chunks(), t.column("value").combine_chunks()
                raw = _pack(at.value_lengths().to_numpy(), at.flatten().to_numpy(), value.flatten().to_numpy(), y=t.column("y").to_numpy())
                yield pa.record_batch([pa.array([raw], pa.binary())], names=["part"])

        # The last order columns split a first slot that many rows have.
        dealt = rows.repartitionByRange(self.parts, "first", F.xxhash64("at", "value"))
        self.parts = dealt.rdd.getNumPartitions()
        self.rows = _single(dealt.mapInArrow(pack, "part binary").rdd.mapPartitions(
            lambda it: [next((bytes(r["part"]) for r in it), None)])).persist(StorageLevel.MEMORY_AND_DISK)
        width, ranges = self.width, self.ranges

        def name(p: int, it: Iterator) -> Iterator:
            for raw in it:
                slots = pickle.loads(raw)["slots"] if raw else np.zeros(0, np.int64)
                cut = np.searchsorted(slots, np.arange(ranges + 1) * width)
                for r in range(ranges):
                    yield r, (p, (slots[cut[r]:cut[r + 1]] - r * width).astype(np.int32))

        self.routes = _single(self.rows.mapPartitionsWithIndex(name).partitionBy(ranges).mapPartitions(
            lambda it: [sorted((v for _, v in it), key=lambda x: x[0])]))

    def gradients(self, state: RDD, compute) -> RDD:
        """State elements have ``w`` (rows of weights) and ``routes``.  Gives, as
        one list a range, (part, gradient rows, numbers) of ``compute(rows, weights)``."""
        width, ranges = self.width, self.ranges

        def send(r: int, it: Iterator) -> Iterator:
            for s in it:
                for p, at in s["routes"]:
                    yield p, (r, s["w"][at])

        def work(p: int, it: Iterator) -> Iterator:
            for raw, came in it:
                if raw is None:
                    continue
                rows = _Rows(raw)
                gradient, numbers = compute(rows, np.concatenate([w for _, w in sorted(came, key=lambda x: x[0])]))
                cut = np.searchsorted(rows.slots, np.arange(ranges + 1) * width)
                for r in range(ranges):
                    yield r, (p, gradient[cut[r]:cut[r + 1]], numbers)

        came = _single(state.mapPartitionsWithIndex(send).partitionBy(self.parts).mapPartitions(lambda it: [[v for _, v in it]]))
        return _single(self.rows.zip(came).mapPartitionsWithIndex(work).partitionBy(ranges).mapPartitions(
            lambda it: [sorted((v for _, v in it), key=lambda x: x[0])]))

    def advanced(self, state: RDD, after: RDD, numbers, i: int) -> list:
        """Runs step ``i`` to the state ``after``; ``numbers`` of every range.

        Every ``KEEP_STEPS`` steps the state is checkpointed, and the shuffle files
        and the checkpoint that came before go."""
        after.persist(StorageLevel.MEMORY_AND_DISK)
        if i % KEEP_STEPS == 0:
            after.checkpoint()
        found = after.map(numbers).collect()  # some numbers a range
        state.unpersist()
        if i % KEEP_STEPS == 0:
            gc.collect()  # files of a shuffle go with the objects that name it
            self.sc._jvm.System.gc()
            self.forget()
            self.kept = after.getCheckpointFile()
        return found

    def forget(self) -> None:
        if self.kept:
            path = self.sc._jvm.org.apache.hadoop.fs.Path(self.kept)
            path.getFileSystem(self.sc._jsc.hadoopConfiguration()).delete(path, True)
            self.kept = None

    def model(self, state: RDD, cells, intercept: float, factor_size: int) -> SparseModel:
        """What a state's weights score, and an end to all that is kept."""
        weights = self.spark.createDataFrame(state.map(lambda s: (s["r"], bytearray(cells(s).tobytes()))), "r int, w binary")
        weights = written(weights, "sparse-weights")
        state.unpersist()
        self.rows.unpersist()
        self.forget()
        return SparseModel(weights, float(intercept), self.size, factor_size, self.width, self.features)


def _sum_of(state: dict, came: list) -> tuple[np.ndarray, float]:
    """Gradient of a range, and the sum of the parts' numbers."""
    total, numbers, routes = np.zeros_like(state["w"]), 0.0, dict(state["routes"])
    for p, gradient, own in came:
        total[routes[p]] += gradient
        numbers += own
    return total, numbers


@dataclass
class SparseMachine:
    """Spark ML's ``FMClassifier`` on sparse vectors (its first weights, AdamW
    steps over all rows, its stop), with weights and moments in ranges."""
    label: str = "label"
    features: str = "features"
    factor_size: int = 8
    step: float = 0.05
    reg: float = 0.001
    max_iter: int = 100
    tol: float = 1e-6
    std: float = 0.01
    seed: int = 2023

    def fit(self, df: DataFrame) -> SparseModel:
        step, reg = self.step, self.reg
        parts = Parts(df, self.label, self.features)
        first = _single(first_weights(parts.sc, parts.size, self.factor_size, self.seed, self.std, parts.width))

        def begin(it: Iterator) -> Iterator:
            for (r, w), routes in it:
                yield {"r": r, "w": w, "m": np.zeros_like(w), "v": np.zeros_like(w), "routes": routes, "moved": 0.0, "norm": 0.0, "own": 0.0}

        empty = parts.sc.emptyRDD()
        state = _single(first.zip(parts.routes).mapPartitions(begin))
        parts.advanced(empty, state, len, 0)
        b = mean = spread = 0.0
        for i in range(1, self.max_iter + 1 if parts.n else 1):
            def compute(rows: _Rows, weights: np.ndarray, b: float = b) -> tuple[np.ndarray, float]:
                raw, terms, total = _machine(rows, weights, b)
                off = _sigmoid(raw) - rows.part["y"]
                cells = off[rows.row] * rows.value
                gradient = [rows.by_slot(cells * (total[rows.row, f] - terms[:, f])) for f in range(terms.shape[1])]
                return np.stack([*gradient, rows.by_slot(cells)], axis=1), off.sum()

            def update(it: Iterator, i: int = i, n: int = parts.n) -> Iterator:
                for s, came in it:
                    total, own = _sum_of(s, came)
                    g = total / n
                    m, v = 0.9 * s["m"] + 0.1 * g, 0.999 * s["v"] + 0.001 * g * g
                    w = s["w"] - step * (m / (1 - 0.9 ** i)) / (np.sqrt(v / (1 - 0.999 ** i)) + 1e-8) - reg * s["w"]
                    yield s | {"w": w, "m": m, "v": v, "moved": ((w - s["w"]) ** 2).sum(), "norm": (w * w).sum(), "own": own}

            after = _single(state.zip(parts.gradients(state, compute)).mapPartitions(update))
            found = parts.advanced(state, after, lambda s: (s["moved"], s["norm"], s["own"]), i)
            state = after
            g = found[0][2] / parts.n
            mean, spread = 0.9 * mean + 0.1 * g, 0.999 * spread + 0.001 * g * g
            last, b = b, b - step * (mean / (1 - 0.9 ** i)) / (np.sqrt(spread / (1 - 0.999 ** i)) + 1e-8) - reg * b
            moved, norm = (sum(x[j] for x in found) + y for j, y in ((0, (b - last) ** 2), (1, b * b)))
            if i > 1 and np.sqrt(moved) < self.tol * max(np.sqrt(norm), 1.0):
                break
        return parts.model(state, lambda s: s["w"], b, self.factor_size)


class _LineSearchFailed(ArithmeticError):
    pass


def _wolfe(phi, fval: float, dd: float, t: float) -> float:
    """Breeze's ``StrongWolfeLineSearch``: the step that ``phi`` (t to value and
    slope) was asked for last."""
    def interpolated(a: tuple, b: tuple) -> float:
        d1 = a[2] + b[2] - 3 * (a[1] - b[1]) / (a[0] - b[0])
        root = d1 * d1 - a[2] * b[2]
        d2 = np.sqrt(root) if root >= 0 else np.nan
        at = b[0] - (b[0] - a[0]) * (b[2] + d2 - d1) / (b[2] - a[2] + 2 * d2)
        low, high = a[0] + 0.1 * (b[0] - a[0]), a[0] + 0.9 * (b[0] - a[0])
        return low if at < low else high if at > high else at

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(10):
            at = interpolated(high, low) if low[0] > high[0] else interpolated(low, high)
            c = (at, *phi(at))
            if c[1] > fval + 1e-4 * at * dd or c[1] >= low[1]:
                high = c
            else:
                if abs(c[2]) <= 0.9 * abs(dd):
                    return at
                if c[2] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _LineSearchFailed("zoom")

    if dd > 0:
        raise _LineSearchFailed("not a descent")
    low = (0.0, fval, dd)
    for i in range(10):
        c = (t, *phi(t))
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if c[1] > fval + 1e-4 * t * dd or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if abs(c[2]) <= 0.9 * abs(dd):
            return t
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _LineSearchFailed("too many steps")


def _direction(gram: np.ndarray, h: int) -> np.ndarray:
    """Two-loop recursion as shares of the vectors [h steps, h gradient changes,
    gradient], from their products alone."""
    share = np.zeros(2 * h + 1)
    share[2 * h] = 1.0
    along = np.zeros(h)
    if h:
        sy, yy = gram[h - 1, 2 * h - 1], gram[2 * h - 1, 2 * h - 1]
        if not sy >= 0:
            raise _LineSearchFailed("history")
    for i in reversed(range(h)):
        along[i] = gram[i] @ share / gram[i, h + i]
        if np.isnan(along[i]):
            raise _LineSearchFailed("history")
        share[h + i] -= along[i]
    if h:
        share *= sy / yy
    for i in range(h):
        share[i] += along[i] - gram[h + i] @ share / gram[i, h + i]
    return -share


@dataclass
class SparseLogistic:
    """Spark ML's binary ``LogisticRegression`` on sparse vectors (centred columns
    of unit deviation, L2, Breeze's L-BFGS with ten steps of history), with the
    weights, gradients and history in ranges; the driver has their products."""
    label: str = "label"
    features: str = "features"
    reg: float = 0.0
    max_iter: int = 100
    tol: float = 1e-6
    history: int = 10

    def fit(self, df: DataFrame) -> SparseModel:
        parts, reg, most = Parts(df, self.label, self.features), self.reg, self.history
        n, size, width = parts.n, parts.size, parts.width
        if not n:
            raise ValueError("no rows to fit")

        def moments(rows: _Rows, _: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return np.stack([rows.by_slot(rows.value), rows.by_slot(rows.value ** 2)], axis=1), np.array([rows.part["y"].sum()])

        def begin(it: Iterator) -> Iterator:
            for s, came in it:
                total, numbers = _sum_of(s, came)
                mean = total[:, 0] / n
                spread = np.maximum(total[:, 1] - n * mean * mean, 0.0)
                spread[spread < 1e-12 * total[:, 1]] = 0.0  # constant but for rounding
                std = np.sqrt(spread / max(n - 1, 1))
                inverse = np.divide(1.0, std, out=np.zeros_like(std), where=std > 0)
                zero = np.zeros_like(std)
                yield {"r": s["r"], "routes": s["routes"], "inverse": inverse, "centre": mean * inverse, "x": zero, "g": zero, "d": zero,
                       "trial": zero, "w": zero[:, None], "S": [], "Y": [], "numbers": numbers}

        blank = _single(parts.routes.mapPartitionsWithIndex(lambda r, it: (
            {"r": r, "routes": routes, "w": np.zeros((min(width, size - r * width), 2))} for routes in it)))
        state = _single(blank.zip(parts.gradients(blank, moments)).mapPartitions(begin))
        steps = 0
        positive = parts.advanced(parts.sc.emptyRDD(), state, lambda s: s["numbers"], steps)[0][0]
        if positive in (0, n):  # one class only
            return parts.model(state, lambda s: s["w"], np.inf if positive else -np.inf, 0)

        def evaluate(accept: float | None, first: bool, reset: bool, shares: np.ndarray | None, t: float, offset: float):
            """The state after the last step is taken (``accept``, its length) or
            not, with the gradient at x + t d; value, and products for the driver."""
            nonlocal state, steps

            def move(s: dict) -> dict:
                if accept is not None:
                    add = not first
                    s = s | {"x": s["x"] + accept * s["d"], "g": s["trial"], "S": [*s["S"], accept * s["d"]][-most:] if add else [],
                             "Y": [*s["Y"], s["trial"] - s["g"]][-most:] if add else []}
                if reset:
                    s = s | {"S": [], "Y": []}
                if shares is not None:
                    s = s | {"d": sum((a * v for a, v in zip(shares, [*s["S"], *s["Y"], s["g"]])), np.zeros_like(s["x"]))}
                return s | {"w": ((s["x"] + t * s["d"]) * s["inverse"])[:, None]}

            def compute(rows: _Rows, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                raw = offset + rows.by_row(weights[rows.at, 0] * rows.value)
                off = _sigmoid(raw) - rows.part["y"]
                return rows.by_slot(off[rows.row] * rows.value)[:, None], np.array([off.sum(), (np.logaddexp(0, raw) - rows.part["y"] * raw).sum()])

            def finish(it: Iterator) -> Iterator:
                for s, came in it:
                    total, numbers = _sum_of(s, came)
                    z = s["x"] + t * s["d"]
                    trial = (total[:, 0] * s["inverse"] - numbers[0] * s["centre"]) / n + reg * z
                    taken = shares is not None
                    basis = [*[*s["S"], t * s["d"]][-most:], *[*s["Y"], trial - s["g"]][-most:]] if taken else []
                    basis = np.stack([*basis, trial, s["centre"], z])
                    yield s | {"trial": trial, "numbers": (numbers, trial @ s["d"], basis @ basis.T)}

            moved = _single(state.map(move, preservesPartitioning=True)).persist(StorageLevel.MEMORY_AND_DISK)
            after = _single(moved.zip(parts.gradients(moved, compute)).mapPartitions(finish))
            steps += 1
            found = parts.advanced(state, after, lambda s: s["numbers"], steps)
            moved.unpersist()
            state = after
            gram = sum(x[2] for x in found)
            off, loss = found[0][0]
            return loss / n + 0.5 * reg * gram[-1, -1], sum(x[1] for x in found), gram, off / n

        def products(gram: np.ndarray, own: list) -> np.ndarray:
            """Products of steps, changes and gradient, the intercept's part included."""
            return gram[:-2, :-2] + np.outer(own, own)

        b = float(np.log(positive / (n - positive)))
        value, _, gram, slope = evaluate(None, True, False, None, 0.0, b)
        start, seen = value, [np.inf]
        S, Y = [], []  # of the intercept
        pending, first, reset, failed, i = 0.0, True, False, False, 0
        while True:
            own = [*S, *Y, slope]
            dots = products(gram, own)
            if i >= self.max_iter or (i and len(seen) >= 2 and abs(value - max(seen)) <= self.tol * abs(start)) or (
                    np.sqrt(dots[-1, -1]) <= max(self.tol * abs(value), 1e-8)):
                break
            try:
                shares = _direction(dots, len(S))
                db, dd = float(shares @ own), float(shares @ dots[-1])
                centre = gram[-2, :-2] @ shares, gram[-2, -1]  # of the direction and of x
                last = {}

                def phi(t: float) -> tuple[float, float]:
                    nonlocal pending, first, reset
                    value, along, found, off = evaluate(pending, first, reset, shares, t, b + t * db - (centre[1] + t * centre[0]))
                    pending, first, reset = None, False, False
                    last.update(value=value, gram=found, off=off)
                    return value, along + off * db

                t = _wolfe(phi, value, dd, 1.0 / np.sqrt(shares @ dots @ shares) if i == 0 else 1.0)
                if t * np.sqrt(dots[-1, -1]) < 1e-10:
                    raise _LineSearchFailed("step")
            except _LineSearchFailed:
                if failed:
                    break
                failed, reset, S, Y = True, True, [], []
                gram = gram[-3:, -3:]
                continue
            S, Y = [*S, t * db][-most:], [*Y, last["off"] - slope][-most:]
            b, slope, value, gram, pending, failed, i = b + t * db, last["off"], last["value"], last["gram"], t, False, i + 1
            seen = [*seen, value][-20:]
        self.iterations = i
        end, centre = pending, gram[-2, -1]
        return parts.model(state, lambda s: ((s["x"] + (end or 0.0) * s["d"]) * s["inverse"])[:, None], b - centre, 0)


@dataclass
class SparseModel:
    """``weights`` (r, w): a range's weights, factors and linear slot by slot."""
    weights: DataFrame
    intercept: float
    size: int
    factor_size: int
    width: int
    features: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the ``probability`` vector of both classes in place of the features.

        Rows are written once as blocks; a block asks the ranges for the weights
        of the slots it names."""
        from rankfold.llm.store import ship
        ship(df.sparkSession)
        features, width, k, b0, most = self.features, self.width, self.factor_size, self.intercept, PART_ROWS
        rest = [c for c in df.columns if c != features]

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, place = [], 0

            def block():
                t = pa.Table.from_batches(held)
                cells = [_cells(b.column(features)) for b in held]
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, t.select(rest).schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
                    w.write_table(t.select(rest).combine_chunks())
                raw = _pack(*[np.concatenate(x) for x in zip(*cells)])
                return pa.record_batch([pa.array([f"{TaskContext.get().partitionId()}-{place}"]), pa.array([raw], pa.binary()),
                                        pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "part", "rest"])

            for b in batches:
                held.append(b)
                if sum(x.num_rows for x in held) >= most:
                    yield block()
                    held, place = [], place + 1
            if sum(x.num_rows for x in held):
                yield block()

        blocks = written(df.mapInArrow(cut, "block string, part binary, rest binary"), "sparse-blocks")

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for name, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    slots = pickle.loads(raw)["slots"]
                    for r in np.unique(slots // width).tolist():
                        own = slots[slots // width == r] - r * width
                        yield pa.record_batch([pa.array([r], pa.int32()), pa.array([name]), pa.array([own.astype(np.int32).tobytes()], pa.binary())],
                                              names=["r", "block", "at"])

        def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
            if not asked.num_rows:
                return pa.table({"block": pa.array([], pa.string()), "r": pa.array([], pa.int32()), "w": pa.array([], pa.binary())})
            w = np.frombuffer(known.column("w")[0].as_py()).reshape(-1, k + 1)
            found = [w[np.frombuffer(at, np.int32)].tobytes() for at in asked.column("at").to_pylist()]
            return pa.table({"block": asked.column("block"), "r": asked.column("r"), "w": pa.array(found, pa.binary())})

        asked = blocks.select("block", "part").mapInArrow(ask, "r int, block string, at binary")
        answers = asked.groupBy("r").cogroup(self.weights.groupBy("r")).applyInArrow(answer, "block string, r int, w binary")
        schema = StructType([*[f for f in df.schema if f.name != features], StructField("_p", DoubleType())])

        def rate(own: pa.Table, came: pa.Table) -> pa.Table:
            rows = _Rows(own.column("part")[0].as_py())
            parts = sorted(zip(came.column("r").to_pylist(), came.column("w").to_pylist()))
            w = np.concatenate([np.zeros((0, k + 1)), *[np.frombuffer(x).reshape(-1, k + 1) for _, x in parts]])
            t = pa.ipc.open_stream(own.column("rest")[0].as_py()).read_all()
            return t.append_column("_p", pa.array(_sigmoid(_machine(rows, w, b0)[0])))

        done = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(rate, schema)
        return done.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - F.col("_p"), F.col("_p")))).drop("_p")
