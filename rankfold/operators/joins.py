"""Key joins: lookups with a checked broadcast, horizontal concat by key
(J1-J5, J8, J10, X10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A lookup side is broadcast only when its row count is known to be below
# this bound; above it the join is a shuffle join (AQE may still convert it
# from runtime statistics, which are measured, not guessed).
DEFAULT_BROADCAST_ROWS = 2_000_000


def lookup_join(df: DataFrame, lookup: DataFrame, on: str | list[str], how: str = "left",
                max_broadcast_rows: int | None = None) -> DataFrame:
    """Left join of a fact table with a dimension/lookup table.

    ``max_broadcast_rows``: count the lookup side (one small action) and
    hint a broadcast only if it is below the bound.  Without it Catalyst and
    AQE choose from file-size statistics and runtime shuffle sizes, bounded by
    ``spark.sql.autoBroadcastJoinThreshold``.
    """
    if max_broadcast_rows is not None and lookup.count() <= max_broadcast_rows:
        lookup = F.broadcast(lookup)
    return df.join(lookup, on, how)


def lookup_with_default(df: DataFrame, table: DataFrame, key: str, value: str, out: str,
                        default=None, table_key: str | None = None) -> DataFrame:
    """Map ``key`` through a (key -> value) table; unmatched -> ``default``."""
    t = table.select(F.col(table_key or key).alias(key), F.col(value).alias(out))
    j = df.join(t, key, "left")
    if default is not None:
        j = j.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return j


def concat_by_key(frames: list[DataFrame], key: list[str], how: str = "full") -> DataFrame:
    """Horizontal concat of feature/score frames, aligned by the full row key
    rather than by row position (J8); a frame without the key gives nulls."""
    return reduce(lambda a, b: a.join(b, key, how), frames)


def attach_pretrained(vocab: DataFrame, emb: DataFrame, dim: int, key: str = "key",
                      value: str = "value", id_col: str = "id") -> DataFrame:
    """Pretrained vector for every vocab id; missing keys get a zero vector."""
    j = vocab.join(emb.select(F.col(key).alias("token"), F.col(value).alias("_v")), "token", "left")
    zeros = F.array_repeat(F.lit(0.0), dim)
    return j.select(id_col, "token", F.coalesce(F.col("_v").cast("array<double>"), zeros).alias(value))
