"""Column-level helpers carrying the warehouse dialect's semantics."""

from trestle.functions.dates import (date_lit, days_between, first_of_month, month_diff, month_end, month_floor,  # noqa: F401
                                     parse_date, parse_ts, shift_date, shift_zone)
from trestle.functions.numbers import (div0, floor_text, least_strict, safe_div,  # noqa: F401
                                       sum_or_null, to_int, try_number)
from trestle.functions.rules import case_rules, grade, include_company  # noqa: F401
from trestle.functions.text import (as_bool, as_number, contains_ci, like_any, parse_amount, part,  # noqa: F401
                                    regex_group, region_code, strip_html, trim_text, word)
