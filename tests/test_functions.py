"""Edge cases of the column helpers, with hand-worked expected values (dialect rules D1-D23)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from trestle.functions import (as_bool, as_number, case_rules, days_between, div0, first_of_month, floor_text,
                               include_company, least_strict, month_diff, parse_amount, parse_ts, part, regex_group,
                               region_code, safe_div, shift_date, strip_html, word)


def one_col(spark, values, type_="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {type_}")


def test_parse_amount_accounting_text(spark):
    df = one_col(spark, ["-", " - ", "nan", "1,234.50", "(1,234)", "-5", None, "12.4", "abc"])
    got = rows(df.select(parse_amount("v").alias("a"), parse_amount("v", any_hyphen_null=True).alias("m")))
    assert got == [
        (None, None), (None, None), (None, None),
        (Decimal("1235"), Decimal("1235")),     # scale 0 rounds half away from zero (D2)
        (Decimal("-1234"), Decimal("-1234")),   # brackets are negative
        (Decimal("-5"), None),                  # the margin rule drops any text with a hyphen
        (None, None), (Decimal("12"), Decimal("12")), (None, None),
    ]


def test_first_of_month(spark):
    df = one_col(spark, ["Jan-25", "JAN-25", "Jan-75", "2025-01-31 00:00:00", "2024-02-29", "junk", None])
    got = [r[0] for r in rows(df.select(first_of_month("v")))]
    assert got == [dt.date(2025, 1, 1), dt.date(2025, 1, 1), dt.date(1975, 1, 1), dt.date(2025, 1, 1),
                   dt.date(2024, 2, 1), None, None]


def test_as_bool_tokens(spark):
    df = one_col(spark, ["on", "No", "1", None, "TRUE", " off ", "y", "maybe"])
    assert [r[0] for r in rows(df.select(as_bool("v")))] == [True, False, True, None, True, False, True, None]


def test_fc_number_text_order_and_floor(spark):
    df = one_col(spark, ["2025 FC9", "2025 FC10", "2025 FC2.6", "2025 FC3.1", "2025 BASE"])
    fc = df.select(regex_group("v", r"FC([0-9.]+)").alias("fc"))
    assert [r[0] for r in rows(fc)] == ["9", "10", "2.6", "3.1", None]
    assert rows(fc.agg(F.max("fc"))) == [("9",)]           # D12: '9' > '10' as text
    assert [r[0] for r in rows(fc.select(floor_text("fc")))] == [9, 10, 2, 3, None]


def test_split_helpers(spark):
    df = one_col(spark, ["Great Lakes EDU", "Central HC", "X"])
    got = rows(df.select(word("v", 0), word("v", 1), word("v", 2), part("v", " ", 2), part("v", " ", 5)))
    assert got == [("Great", "Lakes", "EDU", "Lakes", ""), ("Central", "HC", None, "HC", ""), ("X", None, None, "", "")]


def test_region_code(spark):
    df = one_col(spark, ["0410", "1230", "0000"])
    assert [r[0] for r in rows(df.select(region_code("v")))] == ["0400", "1200", "0000"]


def test_strip_html(spark):
    df = one_col(spark, ["<p>a&nbsp;b</p>", "no tags", None])
    assert [r[0] for r in rows(df.select(strip_html("v")))] == ["ab", "no tags", None]


def test_div0_and_safe_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 0.0), (3.0, 2.0), (4.0, None)], "n double, d double")
    got = rows(df.select(div0("n", "d"), safe_div("n", "d")))
    assert got == [(0.0, None), (None, None), (1.5, 1.5), (None, None)]


def test_month_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 31), dt.date(2025, 2, 1)), (dt.date(2024, 12, 15), dt.date(2025, 1, 14))],
                               "a date, b date")
    got = rows(df.select(month_diff("a", "b"), days_between("a", "b")))
    assert got == [(1, 1), (1, 30)]                         # D13: Jan 31 -> Feb 1 is one month


def test_shift_date_clamps_month_end(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),)], "d date")
    got = rows(df.select(shift_date("d", 1, "month"), shift_date("d", -1, "week"), shift_date("d", -8, "year")))
    assert got == [(dt.date(2024, 2, 29), dt.date(2024, 1, 24), dt.date(2016, 1, 31))]


def test_parse_ts_twelve_hour_clock(spark):
    df = one_col(spark, ["03/04/2025 01:30 PM", "03/04/2025 12:05 AM", "bad"])
    got = [r[0] for r in rows(df.select(parse_ts("v", "MM/dd/yyyy hh:mm a")))]
    assert got == [dt.datetime(2025, 3, 4, 13, 30), dt.datetime(2025, 3, 4, 0, 5), None]


def test_case_rules_first_match_and_null_falls_through(spark):
    df = spark.createDataFrame([(20.0,), (10.0,), (-0.5,), (None,)], "x double")
    g = case_rules([(F.col("x") > 15, "A"), (F.col("x").between(0, 15), "B"), (F.col("x").between(-10, -1), "C")], "F")
    assert [r[0] for r in rows(df.select(g))] == ["A", "B", "F", "F"]   # gap at -0.5 and NULL grade F


def test_include_company(spark):
    df = one_col(spark, ["41", "70", "71", "104", "105", "136", "abc"])
    got = [r[0] for r in rows(df.select(include_company("v", ["41"], 71, 104)))]
    assert got == [0, 1, 0, 0, 1, 1, 0]


def test_least_strict_null(spark):
    df = spark.createDataFrame([(None, 1), (3, 1)], "a int, b int")
    assert [r[0] for r in rows(df.select(least_strict(F.lit(0), F.col("a"))))] == [None, 0]   # D18


def test_as_number_rounds(spark):
    df = one_col(spark, ["12.7", "-0.5", "x"])
    assert [r[0] for r in rows(df.select(as_number("v")))] == [Decimal("13"), Decimal("-1"), None]


def test_regex_no_match_is_null_d7(spark):
    df = one_col(spark, ["2025 BASE", "2025 FC"])
    assert [r[0] for r in rows(df.select(regex_group("v", r"FC([0-9.]+)")))] == [None, None]


def test_text_in_numeric_context_d11(spark):
    from trestle.functions import try_number

    df = one_col(spark, ["2017", " 12.5 ", "n/a"])
    assert [r[0] for r in rows(df.select(try_number("v")))] == [2017.0, 12.5, None]


def test_month_floor_stays_date_d15(spark):
    from pyspark.sql.types import DateType

    from trestle.functions import month_floor

    df = spark.createDataFrame([(dt.date(2025, 3, 17),)], "d date").select(month_floor("d").alias("m"))
    assert isinstance(df.schema["m"].dataType, DateType)
    assert rows(df) == [(dt.date(2025, 3, 1),)]


def test_concat_propagates_null_d16(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert [r[0] for r in rows(df.select(F.concat("x", F.lit(" FC"), "y")))] == [None, "a FCb"]


def test_union_is_positional_d19(spark):
    from trestle.operators.reshape import stack_rows

    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int").selectExpr("k", "v")
    assert rows(stack_rows(a, b)) == [(1, "x"), (2, "y")]


def test_float_to_int_rounds_d23(spark):
    from trestle.functions import to_int

    df = spark.createDataFrame([(2.5,), (-2.5,), (2.4,)], "x double")
    assert [r[0] for r in rows(df.select(to_int("x")))] == [3, -3, 2]
