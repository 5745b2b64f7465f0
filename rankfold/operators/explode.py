"""List explosion and membership labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_candidates(df: DataFrame, list_col: str = "article_ids_inview",
                       out_col: str = "article_id", pos_col: str = "pos",
                       keep_empty: bool = True) -> DataFrame:
    """One row per element with its 0-based position.

    An empty or null list yields one row with null element and position, as
    a list explode does in the reference.  The position is part of the row
    key downstream, so candidates never need to be matched by row order.
    """
    fn = F.posexplode_outer if keep_empty else F.posexplode
    others = [c for c in df.columns if c != list_col]
    out = df.select(*others, fn(list_col).alias(pos_col, out_col))
    return out.withColumn(pos_col, F.col(pos_col).cast("long"))


def explode_parallel(df: DataFrame, list_cols: list[str], rename: dict[str, str] | None = None,
                     strict: bool = True) -> DataFrame:
    """Explode several equally long lists together.

    ``arrays_zip`` pads unequal lists with nulls; the reference raises, so
    with ``strict`` a row whose lists differ in length fails the task via
    ``raise_error`` instead of producing padded rows.
    """
    rename = rename or {}
    others = [c for c in df.columns if c not in list_cols]
    zipped = F.arrays_zip(*[F.col(c) for c in list_cols])
    if strict and len(list_cols) > 1:
        sizes = [F.coalesce(F.size(c), F.lit(-1)) for c in list_cols]
        same = F.lit(True)
        for s in sizes[1:]:
            same = same & (s == sizes[0])
        zipped = F.when(same, zipped).otherwise(
            F.raise_error(F.lit("explode_parallel: lists of unequal length")))
    out = df.select(*others, F.inline_outer(zipped))
    return out.withColumnsRenamed({c: rename.get(c, c) for c in list_cols if c in rename})


def is_in_list(item: str | Column, list_col: str | Column) -> Column:
    """``item`` is an element of ``list_col``; a null list or a list holding a
    null gives false rather than null (X3)."""
    i = F.col(item) if isinstance(item, str) else item
    lst = F.col(list_col) if isinstance(list_col, str) else list_col
    return F.coalesce(F.array_contains(lst, i), F.lit(False))


def label_candidates(df: DataFrame, item: str = "article_id", clicked: str = "article_ids_clicked",
                     label: str = "label", test_split: bool = False) -> DataFrame:
    """label = item in clicked list (int 0/1); -1 for an unlabeled split."""
    value = F.lit(-1) if test_split else is_in_list(item, clicked).cast("int")
    return df.withColumn(label, value)


def strip_suffix(df: DataFrame, suffix: str = "_fixed") -> DataFrame:
    """Rename every column ending in ``suffix`` to the name without it."""
    return df.withColumnsRenamed({c: c[: -len(suffix)] for c in df.columns if c.endswith(suffix)})
