"""User click sequences and point-in-time prefixes.

Sequences are kept in *long form* — ``(user, seq_pos, item, time)`` — and
only turned into arrays where the array is bounded (the last ``max_len``
items a model reads).  Positions come from one sort across partitions with a
carried count, so a user with a third of all clicks is never sorted or collected
in one task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankfold.functions.lists import pad_sequence
from rankfold.functions.scalar import clip_max, duration_days, duration_hours, iso_weekday, ntz_lit
from rankfold.operators.boundary import running_sums


def positions(df: DataFrame, keys: list[str], order: list[str], out: str = "seq_pos", strategy: str = "auto") -> DataFrame:
    """0-based position of each row inside its key, in ``order`` (ties must be
    broken by the caller), plus ``seq_n`` = rows of the key.

    By default rows are sorted once across partitions and counted with a carry
    (``boundary.running_sums``), so a key of any size is split; ``window`` is for
    keys whose rows are bounded."""
    if strategy == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
        return df.withColumns({out: (F.row_number().over(w) - 1).cast("long"), "seq_n": n})
    done = running_sums(df, keys, order, {out: F.lit(1.0)}, {out: "seq_n"})
    return done.withColumns({out: (F.col(out) - 1).cast("long"), "seq_n": F.col("seq_n").cast("long")})


def sequence_long(hist: DataFrame, user: str, item: str, ts: str, tiebreak: list[str],
                  dedupe: bool = True, strategy: str = "auto") -> DataFrame:
    """One row per (user, item) click in time order with its position.

    Duplicate (user, item) pairs keep the earliest click (the reference keeps
    an arbitrary one); rows with a NULL item are dropped."""
    h = hist.where(F.col(item).isNotNull())
    if dedupe:
        w_first = F.min_by(F.struct(ts, *tiebreak), F.struct(ts, *tiebreak))
        h = h.groupBy(user, item).agg(w_first.alias("_f")).select(
            user, item, *[F.col(f"_f.{c}").alias(c) for c in [ts, *tiebreak]])
    return positions(h, [user], [ts, *tiebreak, item], "seq_pos", strategy)


def assemble(long: DataFrame, keys: list[str], value: str, max_len: int,
             pos: str = "seq_pos", out: str | None = None) -> DataFrame:
    """Array of ``value`` by position, of the last ``max_len`` positions only:
    rows are filtered before collecting, so every array is bounded."""
    out = out or f"{value}_seq"
    src = long.where(F.col(pos) >= F.col("seq_n") - F.lit(max_len))
    g = src.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(pos, value))).alias("_l"))
    return g.select(*keys, F.transform("_l", lambda x: x[value]).alias(out))


def cutoff_lengths(long: DataFrame, user: str, ts: str, cutoffs: dict[str, object]) -> DataFrame:
    """Per user, the number of sequence items strictly before each cutoff,
    all cutoffs in one pass (D3); the full length is ``seq_len_full``."""
    aggs = [F.count(F.when(F.col(ts) < (ntz_lit(c) if isinstance(c, datetime) else F.lit(c)), 1)).alias(name)
            for name, c in cutoffs.items()]
    return long.groupBy(user).agg(*aggs, F.count(F.lit(1)).alias("seq_len_full"))


def prefix(seq_col: str, len_col: str):
    """``seq[:seq_len]``."""
    return F.slice(F.col(seq_col), 1, F.coalesce(F.col(len_col), F.lit(0)).cast("int"))


def last_n_padded(seq_col: str, len_col: str | None, max_len: int):
    """The last ``max_len`` items of the (point-in-time) prefix, pre-padded
    with 0 (D6)."""
    s = prefix(seq_col, len_col) if len_col else F.col(seq_col)
    return pad_sequence(s, max_len, 0, padding="pre", truncating="pre")


def lookup_items(df: DataFrame, row_key: list[str], seq_col: str, items: DataFrame,
                 item_key: str, attrs: list[str]) -> DataFrame:
    """For every element of a padded id sequence, the item's attributes as
    parallel arrays (J7); PAD/unknown ids get NULL attributes."""
    ex = df.select(*row_key, F.posexplode(seq_col).alias("_p", item_key))
    j = ex.join(items.select(item_key, *attrs), item_key, "left")
    g = j.groupBy(*row_key).agg(F.array_sort(F.collect_list(F.struct("_p", *attrs))).alias("_l"))
    return g.select(*row_key, *[F.transform("_l", _field(a)).alias(f"{seq_col}_{a}") for a in attrs])


def _field(name: str):
    # one-argument lambda: transform() passes the index to two-argument ones
    return lambda x: x[name]


def sample_clock_features(df: DataFrame, ts: str, published: str) -> DataFrame:
    """Publish age in days/hours with the reference's clips, impression hour
    and ISO weekday (D5, F9, P13).  The 3- and 7-day copies keep the
    reference's column names."""
    days = duration_days(ts, published).cast("int")
    hours = duration_hours(ts, published).cast("int")
    return df.withColumns({
        "pulish_3day": clip_max(days, 3),
        "pulish_7day": clip_max(days, 7),
        "publish_days": clip_max(days, 30),
        "publish_hours": clip_max(hours, 24),
        "impression_hour": F.hour(ts),
        "impression_weekday": iso_weekday(ts),
    })
