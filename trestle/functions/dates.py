"""Date and time Column functions with the warehouse dialect's semantics (D13-D15, D20, D22, X-22..X-29, M-1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_floor(c) -> Column:
    """X-24: first day of the month, kept as DATE (``date_trunc`` on a DATE stays a DATE, D15)."""
    return F.trunc(F.to_date(_col(c)), "MM")


def shift_date(c, n: int, unit: str) -> Column:
    """X-25: ``dateadd(unit, n, c)`` on a DATE; month/year shifts clamp to the month end."""
    c = F.to_date(_col(c))
    unit = unit.lower()
    if unit == "day":
        return F.date_add(c, n)
    if unit == "week":
        return F.date_add(c, 7 * n)
    if unit == "month":
        return F.add_months(c, n)
    if unit == "year":
        return F.add_months(c, 12 * n)
    raise ValueError(f"unsupported unit {unit!r}")


def days_between(start, end) -> Column:
    """X-26: ``datediff(day, start, end)``."""
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def month_diff(start, end) -> Column:
    """D13: ``datediff(month, start, end)`` counts month boundaries crossed, not whole months."""
    s, e = _col(start), _col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def month_end(c) -> Column:
    """X-28."""
    return F.last_day(_col(c))


def shift_zone(c, src: str, dst: str) -> Column:
    """X-29: wall-clock conversion of a zone-less timestamp from ``src`` to ``dst`` (DST aware)."""
    return F.convert_timezone(F.lit(src), F.lit(dst), _col(c).cast("timestamp_ntz"))


def _pivot_two_digit_year(d: Column, pivot_year: int = 1970) -> Column:
    """D14: two-digit years are read in [pivot, pivot + 100); Spark reads them in [2000, 2100)."""
    return F.when(F.year(d) >= pivot_year + 100, F.add_months(d, -1200)).otherwise(d)


def first_of_month(c) -> Column:
    """M-1: 'Mon-YY' (any case) if it parses, else ISO text with a trailing ' 00:00:00'; floored to the month."""
    c = _col(c)
    short = _pivot_two_digit_year(F.try_to_date(F.initcap(c), "MMM-yy"))
    iso = F.try_to_date(F.replace(c, F.lit(" 00:00:00"), F.lit("")), "yyyy-MM-dd")
    return F.trunc(F.coalesce(short, iso), "MM")


def parse_ts(c, *formats: str) -> Column:
    """X-22: first format that parses wins; NULL when none does (auto-detection of D22 as an ordered list)."""
    c = _col(c)
    if not formats:
        formats = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy hh:mm a", "MM/dd/yyyy")
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def parse_date(c, *formats: str) -> Column:
    """X-23: ``try_to_date`` over an ordered list of formats."""
    c = _col(c)
    if not formats:
        return F.try_to_date(c)
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def date_lit(d) -> Column:
    """A DATE literal from a ``datetime.date`` (or a Column passed through)."""
    if isinstance(d, Column):
        return d
    return F.lit(d.isoformat()).cast("date")
