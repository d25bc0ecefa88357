"""Rule lists turned into CASE expressions (X-20, P-8, §2.12 'rules as data')."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_rules(rules: Iterable[tuple[Column, object]], default=None) -> Column:
    """X-20: searched CASE, first match wins; a NULL predicate does not match, so it falls through to ELSE."""
    out = None
    for pred, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        out = F.when(pred, v) if out is None else out.when(pred, v)
    if out is None:
        return F.lit(default)
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def include_company(c, excluded: Iterable[str], lo: int, hi: int) -> Column:
    """P-8: company kept when not listed and its number is outside ``[lo, hi]``; returns 1/0."""
    c = F.col(c) if isinstance(c, str) else c
    n = c.try_cast("int")
    keep = (~c.isin(*list(excluded))) & ((n < lo) | (n > hi))
    return F.when(keep, 1).otherwise(0)


def grade(value, bands: Iterable[tuple[str, Column]], fallback: str = "F") -> Column:
    """Grade from ordered bands ``[(grade, predicate)]``; no match (incl. NULL value) gives ``fallback``."""
    return case_rules([(pred, g) for g, pred in bands], fallback)
