"""Best-fit packing of token pieces into sequences of at most ``capacity``.

The number of pieces per length is all that the plan needs, so planning works
on a histogram of at most ``capacity`` rows whatever the corpus size:

1. The configuration linear program (fewest sequences that cover the
   histogram; a configuration is a multiset of lengths that fits) is solved
   approximately by multiplicative weights: each round prices the lengths,
   finds the most valuable configuration by knapsack dynamic programming, and
   lowers the prices of the lengths that it covers, until all are covered.
2. The fractional solution is rounded down; what is left, less than one use of
   each configuration, goes through best-fit decreasing on the histogram.  If
   wasteful configurations cost sequences, they are left to best fit too.
3. Best-fit decreasing of the whole histogram is the bound that the rounded
   plan must not exceed.

The plan is a table of slots (length, first rank, end rank, ...): the pieces
of one length are numbered, and a piece's number names its sequence and
offset.  The slot table depends on the capacity and the number of rounds
only, never on the number of pieces, so it is broadcast.

Edge cases: a null text is the end id alone; pieces of full length fill a
sequence each; an empty table gives no row; rows that share a doc_id are
packed each; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.llm.store import stored
from rankfold.llm.tokens import token_ids

Pattern = dict[int, int]  # length -> how many
GROUP_ROWS = 50_000  # pieces of one length that a task numbers together
ROUNDS = 200
RATES = (0.02, 1.0)  # of the price updates, in the order of trial


def knapsack(values: np.ndarray, lengths: np.ndarray, capacity: int) -> Pattern:
    """Most valuable multiset of ``lengths`` (ascending) within ``capacity``."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1, np.int64)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = fits[c]
        best[c], pick[c] = best[c - 1], -1
        if k:
            gain = best[c - lengths[:k]] + values[:k]
            j = int(gain.argmax())
            if gain[j] > best[c]:
                best[c], pick[c] = gain[j], j
    out: Pattern = defaultdict(int)
    c = capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            out[int(lengths[pick[c]])] += 1
            c -= int(lengths[pick[c]])
    return dict(out)


def fractional(hist: dict[int, int], capacity: int, rounds: int = ROUNDS, rate: float = RATES[0]) -> list[tuple[Pattern, float]]:
    """Approximate solution of the configuration program: configurations and
    how often each is used.  Together they use every length as often as it
    occurs.

    A round takes the most valuable configuration of the lengths that are not
    covered yet.  The first ``rounds`` use up half of the scarcest length's
    rest, so that later prices may combine it otherwise; the ones after use up
    the rest, so each ends a length and there are at most as many as lengths.
    ``rate`` is how fast covered lengths become cheap: slowly, configurations
    stay full; fast, lengths that are hard to combine go first."""
    lengths = np.array(sorted(hist), np.int64)
    need = np.array([hist[int(n)] for n in lengths], np.float64)
    left = need.copy()
    price = lengths / capacity  # a length's share of a sequence: the first dual guess
    used: dict[tuple, float] = defaultdict(float)
    done = 0
    while True:
        open_ = np.flatnonzero(left > 1e-9 * need)
        if not len(open_):
            return [(dict(p), x) for p, x in used.items()]
        at = {int(lengths[i]): i for i in open_}
        found = knapsack(price[open_], lengths[open_], capacity)
        found = {n: min(k, int(hist[n])) for n, k in found.items()}
        rows = np.array([at[n] for n in found])
        take = np.array(list(found.values()), np.float64)
        step = float((left[rows] / take).min()) * (0.5 if done < rounds else 1.0)
        used[tuple(sorted(found.items()))] += step
        left[rows] = np.maximum(0.0, left[rows] - step * take)
        left[rows[left[rows] <= 1e-9 * need[rows]]] = 0.0
        price[rows] *= np.exp(-rate * np.minimum(step * take / need[rows], 1.0))  # covered lengths become cheap
        done += 1


def best_fit(hist: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on the histogram, equal sequences together."""
    free: dict[int, list[tuple[Pattern, int]]] = defaultdict(list)
    for n in sorted(hist, reverse=True):
        left = hist[n]
        while left:
            room = min((r for r, v in free.items() if r >= n and v), default=None)
            if room is None:
                k = capacity // n
                if left >= k:
                    free[capacity - k * n].append(({n: k}, left // k))
                    left %= k
                else:
                    free[capacity - left * n].append(({n: left}, 1))
                    left = 0
                continue
            pattern, count = free[room].pop()
            k = min(room // n, left)
            filled = min(count, left // k)
            if filled < count:
                free[room].append((pattern, count - filled))
            free[room - k * n].append((pattern | {n: pattern.get(n, 0) + k}, filled))
            left -= k * filled
    return [x for v in free.values() for x in v]


def plan(hist: dict[int, int], capacity: int, rounds: int = ROUNDS) -> list[tuple[Pattern, int]]:
    """Configurations with counts that use every piece of ``hist`` once."""
    hist = {int(n): int(k) for n, k in hist.items() if k}
    whole = [({capacity: 1}, hist.pop(capacity))] if capacity in hist else []
    if not hist:
        return whole
    waste = lambda p: capacity - sum(n * k for n, k in p.items())
    total = lambda plan_: sum(c for _, c in plan_)

    def rounded(program: list[tuple[Pattern, float]], most: int) -> list[tuple[Pattern, int]]:
        """Whole uses of the configurations that waste at most ``most``; best fit for what is left."""
        left, out = dict(hist), []
        for pattern, x in program:
            count = min([int(x + 1e-6), *(left[n] // k for n, k in pattern.items())]) if waste(pattern) <= most else 0
            if count:
                out.append((pattern, count))
                for n, k in pattern.items():
                    left[n] -= k * count
        return out + best_fit({n: k for n, k in left.items() if k}, capacity)

    best = plain = best_fit(hist, capacity)
    for rate in RATES:
        program = sorted(fractional(hist, capacity, rounds, rate), key=lambda e: (waste(e[0]), -e[1]))
        found = min((rounded(program, most) for most in (capacity, capacity // 10, capacity // 100, 0)), key=total)
        if total(found) <= total(plain):
            best = found  # the program's plan keeps the bound
            break
    return whole + best


def slots(configurations: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, per sequence, offset)."""
    cursor: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for pattern, count in configurations:
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            out.append((n, cursor[n], cursor[n] + k * count, sequence, k, offset))
            cursor[n] += k * count
            offset += k * n
        sequence += count
    return out


def pack(pieces: DataFrame, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) plus sequence_id and
    offset.

    A piece of full length is a sequence of its own: it gets a negative number
    where it lies, without a shuffle.  The shorter pieces of one length are
    numbered in groups of about ``GROUP_ROWS``, so a length that a third of all
    pieces share is numbered by many tasks; the group sizes (one row per length
    and per ``GROUP_ROWS`` pieces) give each group its first number.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    held = stored(pieces.withColumn("_at", F.monotonically_increasing_id()), "pieces")
    whole = held.where(F.col("length") == capacity).select(
        *names, (F.lit(-1) - F.col("_at")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = held.where(F.col("length") < capacity)
    hist = {r["length"]: r["count"] for r in short.groupBy("length").count().collect()}  # under capacity rows
    groups = spark.createDataFrame([(n, -(-k // GROUP_ROWS)) for n, k in hist.items()], "length long, _groups long").coalesce(1)
    short = (short.join(F.broadcast(groups), "length")
             .withColumn("_group", F.pmod("_at", "_groups")).drop("_groups"))
    before, seen = [], defaultdict(int)
    sizes = short.groupBy("length", "_group").count()  # one row per length and per GROUP_ROWS pieces
    for n, g, k in sorted(tuple(r) for r in sizes.collect()):
        before.append((n, g, seen[n]))
        seen[n] += k
    table = slots(plan(hist, capacity, rounds))
    group = spark.createDataFrame(before, "length long, _group long, _before long").coalesce(1)
    slot = spark.createDataFrame(
        table, "_length long, _first long, _end long, _sequence long, _each long, _offset long").coalesce(1)
    ranked = (short.withColumn("_n", F.row_number().over(Window.partitionBy("length", "_group").orderBy("_at")) - 1)
              .join(F.broadcast(group), ["length", "_group"])
              .withColumn("_rank", F.col("_before") + F.col("_n")))
    fits = ((F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first"))
            & (F.col("_rank") < F.col("_end")))
    at = F.col("_rank") - F.col("_first")
    packed = (
        ranked.join(F.broadcast(slot), fits)
        .select(*names, (F.col("_sequence") + F.floor(at / F.col("_each"))).cast("long").alias("sequence_id"),
                (F.col("_offset") + F.pmod(at, F.col("_each")) * F.col("length")).alias("offset")))
    return whole.union(packed)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Tokenize, cut and pack a document table: (doc_id, piece, start, length,
    ids, sequence_id, offset)."""
    return pack(token_ids(docs, tokenizer, end_id, piece=capacity), capacity)
