"""Column expressions that the operators share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: str | Column) -> Column:
    """The value, or null if it is NaN or infinite: not evaluable is never a number."""
    v = as_column(c).cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def clamp(c: str | Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.greatest(as_column(c), F.lit(low)), F.lit(high))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.when(b != 0, a / b)


def mean_where(value: Column, condition: Column) -> Column:
    return F.avg(F.when(condition, value))


def weighted_mean(value: str | Column, weight: str | Column) -> Column:
    """Mean over rows whose value and weight are finite and whose weight is above zero; null without such rows."""
    v, w = finite(value), finite(weight)
    use = v.isNotNull() & (w > 0)
    return F.try_divide(F.sum(F.when(use, v * w)), F.sum(F.when(use, w)))


def median(c: str | Column) -> Column:
    return F.percentile(as_column(c), F.lit(0.5))


def half_even(c: Column) -> Column:
    """Rounding to whole numbers with halves to even."""
    return F.bround(c, 0)


def intensity_class(od: str | Column, cuts: Sequence[float] = (0.2, 0.4, 0.6)) -> Column:
    """Classes 0, 1+, 2+, 3+ of half-open intervals; null stays null."""
    v = finite(od)
    return F.when(v < cuts[0], "0").when(v < cuts[1], "1+").when(v < cuts[2], "2+").when(v.isNotNull(), "3+")


#: Weight of each intensity class in an H-score (fixed values).
CLASS_WEIGHTS = {"0": 0, "1+": 1, "2+": 2, "3+": 3}


def class_weight(label: str | Column, weights: Mapping[str, int] = CLASS_WEIGHTS) -> Column:
    out = F.lit(None).cast("double")
    for name, weight in weights.items():
        out = F.when(as_column(label) == name, F.lit(float(weight))).otherwise(out)
    return out


def h_score(label: str | Column) -> Column:
    """100 times the mean class weight: 0 to 300."""
    return F.lit(100.0) * F.avg(class_weight(label))


def parse_bool(c: str | Column) -> Column:
    """True and false words as booleans; other words raise."""
    word = F.lower(F.trim(as_column(c)))
    return (
        F.when(word.isin("true", "t", "1", "yes", "y"), True)
        .when(word.isin("false", "f", "0", "no", "n", ""), False)
        .when(word.isNull(), None)
        .otherwise(F.raise_error(F.concat(F.lit("not a boolean: "), word)).cast("boolean"))
    )


def or_default(c: str | Column, default) -> Column:
    """Trimmed text, or the default where it is missing or empty."""
    return F.coalesce(F.nullif(F.trim(as_column(c)), F.lit("")), F.lit(default))


def file_token(c: str | Column) -> Column:
    """Text made fit for a file name."""
    token = F.regexp_replace(F.trim(as_column(c)), "[^A-Za-z0-9_.-]+", "_")
    return or_default(F.regexp_replace(token, "^_+|_+$", ""), "unnamed")


def pixels_of(um: str | Column, um_per_pixel: str | Column, fallback: float, least: float) -> Column:
    """A length in pixels from micrometres where the scale is known, else the fallback; whole, and ``least`` at least."""
    scale = finite(um_per_pixel)
    return F.greatest(half_even(F.when(scale > 0, as_column(um) / scale).otherwise(F.lit(fallback))), F.lit(least))
