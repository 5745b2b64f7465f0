"""Column functions: clocks, durations, ratios, clips, buckets, hashes.

All of them are plain ``Column -> Column`` expressions, so they stay inside
whole-stage codegen and compose with any projection.  Integer outputs use the
reference's widths only where a caller asks (``cast``); by default they are
``int``/``long`` as Spark produces them.
"""

from __future__ import annotations

import hashlib
import json

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

_EPOCH = datetime(1970, 1, 1)


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- time -----

def ntz_lit(dt: datetime) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal, independent of the session and
    Python time zones (a Python datetime literal would go through both)."""
    return F.lit(dt.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def epoch_micros(ts: ColumnOrName) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ (wall clock) value."""
    return F.timestamp_diff("MICROSECOND", ntz_lit(_EPOCH), _c(ts).cast("timestamp_ntz"))


def epoch_seconds(ts: ColumnOrName) -> Column:
    """Floor of epoch milliseconds // 1000, i.e. whole seconds rounded down."""
    m = epoch_micros(ts)
    return ((m - F.pmod(m, F.lit(1_000_000))) / F.lit(1_000_000)).cast("long")


def iso_weekday(ts: ColumnOrName) -> Column:
    """1 = Monday .. 7 = Sunday (``weekday`` is 0-based from Monday)."""
    return F.weekday(_c(ts)) + F.lit(1)


def _trunc_div(d: Column, n: int) -> Column:
    # exact integer division toward zero: ``%`` keeps the dividend's sign
    return ((d - d % F.lit(n)) / F.lit(n)).cast("long")


def duration_seconds(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole elapsed seconds ``later - earlier``, truncated toward zero, signed."""
    return _trunc_div(epoch_micros(later) - epoch_micros(earlier), 1_000_000)


def duration_hours(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return _trunc_div(epoch_micros(later) - epoch_micros(earlier), 3_600_000_000)


def duration_days(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    return _trunc_div(epoch_micros(later) - epoch_micros(earlier), 86_400_000_000)


TIME_FEATURE_NAMES = ["day", "hour", "minute", "dayofweek", "dayofyear", "total_seconds",
                      "hour_minute", "6hour", "12hour", "is_day", "day_hour", "day_minute"]


def time_feature_columns(ts: ColumnOrName) -> dict[str, Column]:
    """The twelve clock features derived from one timestamp (F1-F8)."""
    t = _c(ts)
    hour = F.hour(t)
    minute = F.minute(t)
    dow = iso_weekday(t)
    return {
        "day": F.dayofmonth(t),
        "hour": hour,
        "minute": minute,
        "dayofweek": dow,
        "dayofyear": F.dayofyear(t),
        "total_seconds": epoch_seconds(t),
        "hour_minute": (hour + minute / F.lit(60.0)).cast("float"),
        "6hour": F.floor(hour / 6).cast("int"),
        "12hour": F.floor(hour / 12).cast("int"),
        "is_day": F.floor(F.pmod(hour + 6, F.lit(24)) / 12).cast("int"),
        "day_hour": dow * 24 + hour,
        "day_minute": dow * 1440 + hour * 60 + minute,
    }


def with_time_features(df: DataFrame, ts: str, prefix: str = "") -> DataFrame:
    cols = time_feature_columns(ts)
    return df.withColumns({prefix + k: v for k, v in cols.items()})


def parse_timestamp(s: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.to_timestamp_ntz(_c(s), F.lit(fmt))


def parse_timestamp_any(s: ColumnOrName) -> Column:
    """Accept ``2017-05-06 00:00:00`` and ``2017/5/6 0:00`` alike (tiny CSV)."""
    c = _c(s)
    return F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
                      F.try_to_timestamp(c, F.lit("yyyy/M/d H:mm")),
                      F.try_to_timestamp(c, F.lit("yyyy/M/d H:mm:ss")))


# ------------------------------------------- hourly-log string clocks ----

def _yymmddhh_date(c: Column) -> Column:
    return F.to_date(F.concat(F.lit("20"), F.substring(c, 1, 6)), "yyyyMMdd")


def yymmddhh_weekday(s: ColumnOrName) -> Column:
    """``YYMMDDHH`` -> weekday with 0 = Sunday .. 6 = Saturday (``%w``)."""
    return F.dayofweek(_yymmddhh_date(_c(s))) - F.lit(1)


def yymmddhh_weekend(s: ColumnOrName) -> Column:
    return F.dayofweek(_yymmddhh_date(_c(s))).isin(1, 7).cast("int")


def yymmddhh_hour(s: ColumnOrName) -> Column:
    return F.substring(_c(s), 7, 2).cast("int")


# --------------------------------------------------- numeric buckets ----

def log_square_bucket(v: ColumnOrName) -> Column:
    """v > 2 -> floor(ln(v)^2); otherwise int(v) (truncation toward zero)."""
    c = _c(v)
    return (F.when(c > 2, F.floor(F.pow(F.log(c), 2)))
            .otherwise(c.cast("long"))).cast("long")


def country_code(s: ColumnOrName) -> Column:
    """First two characters; null -> empty string."""
    return F.coalesce(F.substring(_c(s), 1, 2), F.lit(""))


# Upper edges of the age buckets "1".."7"; valid ages are [1, 95].
AGE_BUCKET_EDGES = [10, 20, 30, 40, 50, 60]
AGE_MIN, AGE_MAX = 1, 95


def age_bucket(age: ColumnOrName) -> Column:
    a = _c(age).cast("double")
    expr = F.when(a.isNull() | (a < AGE_MIN) | (a > AGE_MAX), F.lit(""))
    for i, edge in enumerate(AGE_BUCKET_EDGES, start=1):
        expr = expr.when(a <= edge, F.lit(str(i)))
    return expr.otherwise(F.lit(str(len(AGE_BUCKET_EDGES) + 1)))


def clip_max(c: ColumnOrName, upper) -> Column:
    """Upper clip that keeps nulls null (``least`` would skip them)."""
    x = _c(c)
    return F.when(x > F.lit(upper), F.lit(upper)).otherwise(x)


def clip_range(c: ColumnOrName, lower, upper) -> Column:
    x = _c(c)
    return F.when(x < F.lit(lower), F.lit(lower)).when(x > F.lit(upper), F.lit(upper)).otherwise(x)


def log1p10(c: ColumnOrName) -> Column:
    """log10(1 + x)."""
    return F.log10(F.lit(1.0) + _c(c))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den with NULL for a zero or null denominator (ANSI-safe)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


# The sentiment label that maps to 1; every other label maps to 0.
POSITIVE_SENTIMENT = "Positive"


def sentiment_to_int(label: ColumnOrName) -> Column:
    c = _c(label)
    return F.when(c.isNull(), F.lit(None)).when(c == F.lit(POSITIVE_SENTIMENT), F.lit(1)).otherwise(F.lit(0))


def stable_hash(cols: list[ColumnOrName], seed: int = 42) -> Column:
    """60-bit hash that any engine reproduces: the first 15 hex digits of the md5
    of the values and the seed, joined by ``|`` (a null counts as empty)."""
    text = F.concat_ws("|", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_bucket(c: ColumnOrName, num_buckets: int, seed: int = 42) -> Column:
    """Stable bucket id in [0, num_buckets); a null counts as the empty string."""
    return F.pmod(stable_hash([c], seed), F.lit(num_buckets))


def param_hash(params: dict, length: int = 8) -> str:
    """Identifier of a parameter set: the first ``length`` hex digits of the md5
    of the sorted characters of its JSON text (keys sorted, values as strings,
    four blanks of indent)."""
    text = json.dumps({k: str(params[k]) for k in sorted(params)}, indent=4)
    return hashlib.md5("".join(sorted(text)).encode()).hexdigest()[:length]


def ratio_features(df: DataFrame, read_time: str = "total_read_time",
                   pageviews: str = "total_pageviews", inviews: str = "total_inviews",
                   words: str = "body_len") -> DataFrame:
    """``read_pageviews``, ``read_inviews``, ``read_time_word`` ratios."""
    cols = {
        "read_pageviews": safe_ratio(read_time, pageviews),
        "read_inviews": safe_ratio(read_time, inviews),
    }
    if words in df.columns:
        cols["read_time_word"] = safe_ratio(read_time, words)
    return df.withColumns(cols)


def length_features(df: DataFrame, cols: list[str], mode: str = "per_row",
                    suffix: str = "_len") -> DataFrame:
    """``<col>_len`` for text and list columns.

    ``per_row``: characters of a string / elements of a list (the evident
    intent).  ``rowcount``: the column's length as the reference's code
    computes it — the number of rows of the frame, one count action.
    """
    types = dict(df.dtypes)
    if mode == "rowcount":
        n = df.count()
        return df.withColumns({c + suffix: F.lit(float(n)).cast("float") for c in cols})
    return df.withColumns({c + suffix: (F.size(c) if types[c].startswith("array") else F.length(c)).cast("float")
                           for c in cols})


# ------------------------------------------------ named preprocessors ----

_PREPROCESSORS = {
    "convert_weekday": yymmddhh_weekday,
    "convert_weekend": yymmddhh_weekend,
    "convert_hour": yymmddhh_hour,
    "convert_to_bucket": log_square_bucket,
    "extract_country_code": country_code,
    "bucketize_age": age_bucket,
    "log_transform": log1p10,
}


def register_preprocess(name: str, fn) -> None:
    """Add a named ``Column -> Column`` preprocessor (user extension point)."""
    _PREPROCESSORS[name] = fn


def preprocess_column(name: str, col: ColumnOrName) -> Column:
    """Apply a preprocessor declared by name in a feature config (no eval)."""
    if name not in _PREPROCESSORS:
        raise KeyError(f"unknown preprocess function {name!r}")
    return _PREPROCESSORS[name](col)


def apply_preprocess(df: DataFrame, specs: list[dict]) -> DataFrame:
    """specs: ``[{"name": out, "preprocess": "fn(src)" | "copy_from(src)" | None, "dtype": ...}]``."""
    import re
    cols = {}
    for spec in specs:
        call = spec.get("preprocess")
        out = spec["name"]
        if call:
            m = re.fullmatch(r"\s*(\w+)\((\w*)\)\s*", call)
            if not m:
                raise ValueError(f"bad preprocess call {call!r}")
            fn, arg = m.group(1), m.group(2) or out
            cols[out] = F.col(arg) if fn == "copy_from" else preprocess_column(fn, arg)
        if spec.get("dtype"):
            cols[out] = cols.get(out, F.col(out)).cast(spec["dtype"])
    return df.withColumns(cols) if cols else df
