"""TEXT format codes against the text that spreadsheets show."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import excel as X
from tessera.functions.text_format import sections

NUMBERS = [
    (1234.567, "0", "1235"), (1234.567, "0.0", "1234.6"), (1234.567, "#,##0.00", "1,234.57"), (-1234.567, "#,##0.00", "-1,234.57"),
    (0.285, "0%", "29%"), (0.2855, "0.0%", "28.6%"), (0.0, "#", ""), (5.0, "0.#", "5."), (5.25, "0.0##", "5.25"), (5.0, "0.??", "5.  "), (5.0, "???0", "   5"),
    (1234567.0, "#,##0,", "1,235"), (1234567.0, "0.0,,", "1.2"), (1234567.0, "#,##0.0,,\"M\"", "1.2M"), (123456789.0, "000-00-0000", "123-45-6789"),
    (5551234567.0, "(###) ###-####", "(555) 123-4567"), (5551234.0, "(###) ###-####", "() 555-1234"), (7.0, "00000", "00007"), (7.0, "0,000", "0,007"),
    (12345.678, "0.00E+00", "1.23E+04"), (0.00012345, "0.0E+0", "1.2E-4"), (12345.678, "##0.0E+0", "12.3E+3"), (999999.0, "0.0E-0", "1.0E6"), (0.0, "0.00E+00", "0.00E+00"),
    (5.0, '"Total: "0" units"', "Total: 5 units"), (5.0, r"\#0", "#5"), (1.5, "$#,##0.00", "$1.50"), (-1.5, "$#,##0.00", "-$1.50"), (1.5, "[$€-407]0.0", "€1.5"),
    (5.0, "0;(0);-", "5"), (-5.0, "0;(0);-", "(5)"), (0.0, "0;(0);-", "-"), (-5.0, "0.0;[Red](0.0)", "(5.0)"), (0.0, "0;(0)", "0"), (-3.0, "0;;", ""), (3.0, "0_);(0)", "3 "),
    (150.0, '[>=100]"high";[<0]"low";0', "high"), (-2.0, '[>=100]"high";[<0]"low";0', "low"), (50.0, '[>=100]"high";[<0]"low";0', "50"),
    (1234.5, "General", "1234.5"), (12.0, "General", "12"), (2.5, "0", "3"), (-2.5, "0", "-3"), (1e15, "#,##0", "1,000,000,000,000,000"), (0.5, "#.00", ".50"), (1.0, "0 0 0", "0 0 1"),
]

T = dt.datetime(2024, 3, 5, 14, 7, 9, 250000)
DATES = [
    ("yyyy-mm-dd", "2024-03-05"), ("d/m/yy", "5/3/24"), ("dddd, mmmm d, yyyy", "Tuesday, March 5, 2024"), ("ddd mmm dd", "Tue Mar 05"), ("mmmmm", "M"),
    ("h:mm AM/PM", "2:07 PM"), ("hh:mm:ss", "14:07:09"), ("h:mm:ss.00", "14:07:09.25"), ("mm:ss", "07:09"), ("hh A/P", "02 P"), ("yyyy\"年\"m\"月\"", "2024年3月"),
    ("[h]:mm", f"{(dt.date(2024, 3, 5) - dt.date(1899, 12, 30)).days * 24 + 14}:07"), ("m", "3"), ("h \"h\" m", "14 h 7"), ("yyyymmdd-hhmm", "20240305-1407"),
]


def test_numbers(spark):
    df = spark.range(1)
    got = df.select(*[X.TEXT(F.lit(v), code).alias(f"c{i}") for i, (v, code, _) in enumerate(NUMBERS)]).first()
    assert [(c, g) for (_, c, _), g in zip(NUMBERS, got)] == [(c, w) for _, c, w in NUMBERS]


def test_dates(spark):
    got = spark.range(1).select(*[X.TEXT(F.lit(T), code).alias(f"c{i}") for i, (code, _) in enumerate(DATES)]).first()
    assert list(got) == [w for _, w in DATES]
    day = F.lit(dt.date(2024, 3, 5))
    one = spark.range(1).select(X.TEXT(day, "dd.mm.yyyy").alias("a"), X.TEXT(day, "hh:mm").alias("b"), X.TEXT(F.lit(45356.75), "yyyy-mm-dd hh:mm", serial=True).alias("c")).first()
    assert tuple(one) == ("05.03.2024", "00:00", "2024-03-05 18:00")


def test_text_and_nulls(spark):
    df = spark.createDataFrame([("abc", 1.0), ("12", None), (None, -1.0)], "s string, x double")
    got = df.select(X.TEXT("s", '0.0;-0.0;0;"<"@">"').alias("a"), X.TEXT("x", "0.0").alias("b"), X.TEXT("s", "@").alias("c")).collect()
    assert [tuple(r) for r in got] == [("<abc>", "1.0", "abc"), ("12.0", None, "12"), (None, "-1.0", None)]


def test_codes_that_cannot_be_read():
    for code in ("# ?/?", "[nosuch]0", "0;0;0;0;0"):
        with pytest.raises(ValueError):
            X.TEXT(F.lit(1.0), code)
    assert sections('0;"a;b";;@') == ["0", '"a;b"', "", "@"] and sections("") == [""]
