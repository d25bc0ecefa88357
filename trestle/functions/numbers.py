"""Numeric Column functions (D3, D4, D18, D23, X-14..X-18, A-11, A-12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div0(n, d) -> Column:
    """D3: ``DIV0``: 0 when the divisor is 0; NULL in, NULL out."""
    n, d = _col(n), _col(d)
    return F.when(n.isNull() | d.isNull(), F.lit(None).cast("double")).when(d == 0, F.lit(0.0)).otherwise(n / d)


def safe_div(n, d) -> Column:
    """D4: plain division whose zero divisor yields NULL instead of failing the whole mart."""
    return F.try_divide(_col(n).cast("double"), _col(d).cast("double"))


def least_strict(*cs) -> Column:
    """D18: ``LEAST`` that is NULL as soon as any argument is NULL."""
    cols = [_col(c) for c in cs]
    any_null = cols[0].isNull()
    for c in cols[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cols))


def sum_or_null(c) -> Column:
    """A-11: ``NULLIF(SUM(c), 0)``: a zero total means 'no override'."""
    return F.nullif(F.sum(_col(c)), F.lit(0))


def to_int(c) -> Column:
    """D23: float -> integer rounds (the dialect) instead of truncating (Spark)."""
    return F.round(_col(c)).cast("bigint")


def floor_text(c) -> Column:
    """X-15: ``floor`` of a numeric text; NULL when the text is not a number."""
    return F.floor(_col(c).try_cast("double"))


def try_number(c, type_: str = "double") -> Column:
    """D11: the dialect casts text silently in numeric contexts; here bad text becomes NULL."""
    return _col(c).try_cast(type_)
