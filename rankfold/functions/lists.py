"""Per-row list functions (X4-X7, F17-F21, O6), all higher-order Spark
expressions: no Python in the row path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankfold.functions.scalar import epoch_micros

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _non_null(a: Column) -> Column:
    return F.filter(a, lambda x: x.isNotNull())


def list_len(a: ColumnOrName) -> Column:
    """Number of elements; NULL list -> NULL."""
    return F.when(_c(a).isNotNull(), F.size(_c(a)))


def list_mean(a: ColumnOrName) -> Column:
    """Mean of the non-null elements; empty -> NULL."""
    v = _non_null(_c(a))
    total = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.when(F.size(v) > 0, total / F.size(v))


def list_median(a: ColumnOrName) -> Column:
    """Median of the non-null elements, mid-point average for even counts."""
    s = F.array_sort(_non_null(_c(a)))
    n = F.size(s)
    lo = F.element_at(s, F.floor((n + 1) / 2).cast("int")).cast("double")
    hi = F.element_at(s, F.floor(n / 2).cast("int") + 1).cast("double")
    return F.when(n > 0, (lo + hi) / 2)


def list_diff(a: ColumnOrName) -> Column:
    """Successive differences a[i] - a[i-1] (n-1 values); fewer than two -> []."""
    x = _c(a)
    n = F.size(x)
    steps = F.transform(F.sequence(F.lit(2), n), lambda i: F.element_at(x, i) - F.element_at(x, i - 1))
    return F.when(n > 1, steps).otherwise(F.array().cast("array<double>"))


def time_list_diff_median_seconds(a: ColumnOrName) -> Column:
    """Median gap of a timestamp list in whole seconds, truncated."""
    micros = F.transform(_c(a), lambda t: epoch_micros(t))
    med = list_median(list_diff(micros))
    return (med / F.lit(1_000_000.0)).cast("long")


def pad_sequence(a: ColumnOrName, max_len: int, value=0, padding: str = "post",
                 truncating: str | None = None, element_type: str = "long") -> Column:
    """Keras-style pad/truncate to exactly ``max_len``.

    ``truncating='pre'`` keeps the last ``max_len`` elements, ``'post'`` the
    first; ``padding`` puts the fill values before (``pre``) or after.  A
    NULL list becomes all padding.
    """
    truncating = truncating or padding
    typ = f"array<{element_type}>"
    x = F.coalesce(_c(a).cast(typ), F.array().cast(typ))
    n = F.size(x)
    if truncating == "pre":
        cut = F.when(n > max_len, F.slice(x, n - max_len + 1, max_len)).otherwise(x)
    else:
        cut = F.slice(x, 1, max_len)
    fill = F.array_repeat(F.lit(value).cast(element_type), F.greatest(F.lit(max_len) - F.size(cut), F.lit(0)))
    return F.concat(fill, cut) if padding == "pre" else F.concat(cut, fill)


def non_pad_mask(a: ColumnOrName) -> Column:
    """1 where the element is not padding (> 0), else 0."""
    return F.transform(_c(a), lambda x: (x > 0).cast("int"))


def kmax_in_order(a: ColumnOrName, k: int) -> Column:
    """The k largest elements, listed in their original order."""
    idx = F.transform(_c(a), lambda x, i: F.struct(x.alias("v"), i.alias("i")))
    by_value = F.array_sort(idx, lambda l, r: F.when(l["v"] > r["v"], -1).when(l["v"] < r["v"], 1)
                            .otherwise(l["i"] - r["i"]))
    top = F.slice(by_value, 1, k)
    by_pos = F.array_sort(top, lambda l, r: l["i"] - r["i"])
    return F.transform(by_pos, lambda s: s["v"])


def split_tokens(s: ColumnOrName, splitter: str | None = None, lower: bool = False) -> Column:
    """Split text by a literal separator; ``None`` = runs of whitespace."""
    c = _c(s)
    if lower:
        c = F.lower(c)
    if splitter is None:
        return F.filter(F.split(F.trim(c), r"\s+"), lambda t: t != "")
    import re
    return F.split(c, re.escape(splitter))


def rank_string(ranks: ColumnOrName) -> Column:
    """``[a,b,c]`` from an int list."""
    return F.concat(F.lit("["), F.array_join(F.transform(_c(ranks), lambda x: x.cast("string")), ","), F.lit("]"))
