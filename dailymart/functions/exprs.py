"""Column builders with exact decimal arithmetic.

``avg`` over a narrow decimal keeps only a few digits, so a later ``round`` would round twice. The
averages here divide an exact decimal sum by an exact count and round once, half away from zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SUM = T.DecimalType(30, 6)
_COUNT = T.DecimalType(18, 0)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp(c: Column | str, lo=None, hi=None) -> Column:
    """Limit ``c`` to [lo, hi]. NULL stays NULL (``greatest``/``least`` would skip it)."""
    c = _column(c)
    out = c
    if hi is not None:
        out = F.when(c > F.lit(hi), F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(c < F.lit(lo), F.lit(lo)).otherwise(out)
    return out


def count_where(predicate: Column) -> Column:
    """Rows where the predicate is true; a NULL predicate does not count."""
    return F.count_if(predicate)


def exact_avg(c: Column | str, digits: int, where: Column | None = None) -> Column:
    """Average rounded once to ``digits``; NULL over no values. For integer and decimal columns."""
    c = _column(c)
    if where is not None:
        c = F.when(where, c)
    return exact_ratio(F.sum(c), F.count(c), digits)


def exact_ratio(total: Column, count: Column, digits: int) -> Column:
    """An exact sum over its count, rounded once to ``digits``; NULL over no values."""
    quotient = total.cast(_SUM) / F.nullif(count, F.lit(0)).cast(_COUNT)
    return F.round(quotient, digits).cast(T.DecimalType(18, digits))


def avg_where(c: Column | str, predicate: Column, digits: int) -> Column:
    return exact_avg(c, digits, where=predicate)


def mean(c: Column | str) -> Column:
    """Unrounded average as a double: exact sum over exact count, so row order cannot change it."""
    c = _column(c)
    return mean_ratio(F.sum(c), F.count(c))


def mean_ratio(total: Column, count: Column) -> Column:
    """An exact sum over its count as a double; NULL over no values."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")


def pct(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole for non-negative counts, half up, as a decimal; NULL when ``whole`` is 0.

    The quotient is taken in BIGINT (twice the scaled part plus the whole, over twice the whole, is the
    half-up rounding), which is exact and far cheaper than dividing 38-digit decimals.
    """
    doubled = part.cast("bigint") * F.lit(200 * 10**digits) + whole.cast("bigint")
    units = F.call_function("div", doubled, F.nullif(whole.cast("bigint") * 2, F.lit(0).cast("bigint")))
    return (units.cast("decimal(10,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(T.DecimalType(12, digits))


def safe_corr(x: Column | str, y: Column | str, digits: int = 3) -> Column:
    """Pearson correlation over rows where both sides are present; NULL for zero variance.

    The built-in ``corr`` divides by zero under ANSI mode when one side is constant.
    """
    x, y = _column(x).cast("double"), _column(y).cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    ratio = F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))
    return F.round(ratio.cast(T.DecimalType(20, 12)), digits).cast(T.DecimalType(8, digits))


def domain_order(c: Column | str, labels: Sequence[str]) -> Column:
    """Sort key that puts ``labels`` in the given order and anything else last."""
    position = F.array_position(F.array(*[F.lit(v) for v in labels]), _column(c))
    return F.nullif(position, F.lit(0)).asc_nulls_last()


def month_of(c: Column | str) -> Column:
    return F.trunc(_column(c), "month")


def weekday_label(c: Column | str) -> Column:
    """Full weekday name, blank-padded to nine characters."""
    return F.rpad(F.date_format(_column(c), "EEEE"), 9, " ")


def text_key(*parts: Column | str) -> Column:
    """Parts joined by '-'; NULL when any part is NULL."""
    columns = [_column(p).cast("string") for p in parts]
    pieces: list[Column] = []
    for i, c in enumerate(columns):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(c)
    return F.concat(*pieces)
