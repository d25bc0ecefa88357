"""Text Column functions (X-1..X-13, X-21, P-5, P-6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_text(c) -> Column:
    """X-1: ``trim`` casts numbers and dates to text first."""
    return F.trim(_col(c).cast("string"))


def strip_html(c) -> Column:
    """X-3: remove tags, then the ``&nbsp;`` entity."""
    return F.regexp_replace(F.regexp_replace(_col(c), r"<[^>]+>", ""), "&nbsp;", "")


def regex_group(c, pattern: str, group: int = 1) -> Column:
    """X-4/D7: capture group of the first match, NULL when there is no match."""
    return F.nullif(F.regexp_extract(_col(c), pattern, group), F.lit(""))


def part(c, sep: str, n: int) -> Column:
    """X-5/D10: ``split_part`` (1-based; '' when out of range)."""
    return F.split_part(_col(c), F.lit(sep), F.lit(n))


def word(c, i: int, sep: str = " ") -> Column:
    """X-6/D9: ``split(c, sep)[i]``, 0-based, NULL when out of range."""
    return F.get(F.split(_col(c), sep), i)


def region_code(c) -> Column:
    """X-8: ``lpad(left(c, 2) || '00', 4, '0')``."""
    return F.lpad(F.concat(F.left(_col(c), F.lit(2)), F.lit("00")), 4, "0")


def like_any(c, patterns) -> Column:
    """P-5: true when any LIKE pattern matches."""
    c = _col(c)
    out = None
    for p in patterns:
        m = c.like(p)
        out = m if out is None else (out | m)
    return out


def contains_ci(c, s: str) -> Column:
    """P-6/X-10: case-folded contains."""
    return F.lower(_col(c)).contains(s.lower())


def as_number(c, strict: bool = False) -> Column:
    """X-13/D2: ``to_number`` has scale 0, so text is rounded half away from zero to an integer."""
    c = _col(c)
    return c.cast("decimal(38,0)") if strict else c.try_cast("decimal(38,0)")


def parse_amount(c, any_hyphen_null: bool = False) -> Column:
    """X-12: accounting text to a whole number.

    '-' (after trim) and 'nan' are NULL; '(1,234)' is -1234; commas are dropped; the value is rounded to an
    integer (D2).  With ``any_hyphen_null`` every text containing a hyphen is NULL (so '-5' is NULL too).
    Text that still does not parse is NULL rather than an error.
    """
    c = _col(c)
    no_commas = F.replace(c, F.lit(","), F.lit(""))
    bracketed = F.replace(F.replace(no_commas, F.lit("("), F.lit("")), F.lit(")"), F.lit(""))
    hyphen_null = c.contains("-") if any_hyphen_null else (F.trim(c) == "-")
    return (F.when(hyphen_null, F.lit(None))
            .when(F.trim(c) == "nan", F.lit(None))
            .when(c.like("%(%)%"), -1 * _to_int(bracketed))
            .otherwise(_to_int(no_commas)))


def _to_int(c: Column) -> Column:
    return c.try_cast("decimal(38,0)")


# --- boolean text ---------------------------------------------------------------------------------------------
# The text tokens the dialect's to_boolean accepts (case-insensitive, D21).
TRUE_TOKENS = ("true", "t", "yes", "y", "on", "1")
FALSE_TOKENS = ("false", "f", "no", "n", "off", "0")


def as_bool(c) -> Column:
    """X-21: dialect ``to_boolean`` on text; unknown text is NULL instead of an error."""
    v = F.lower(F.trim(_col(c).cast("string")))
    return F.when(v.isin(*TRUE_TOKENS), F.lit(True)).when(v.isin(*FALSE_TOKENS), F.lit(False))

