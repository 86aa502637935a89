from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripledger.functions import (
    blank_to,
    clean_upper,
    currency,
    first_part,
    fit_length,
    inclusive_days,
    parse_date,
    parse_decimal,
    parse_int,
    scaled,
    sum_or_zero,
    thousands,
    title_case,
)


def run(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_money_text(texts):
    good = ["1.234,56", "0,005", "-0,005", "1234.5", " 7 ", "", "   ", None, "99.999.999,99"]
    expected = [D("1234.56"), D("0.01"), D("-0.01"), D("12345.00"), D("7.00"), None, None, None,
                D("99999999.99")]
    assert run(texts(*good), parse_decimal("x")) == expected
    assert run(texts(*good), parse_decimal("x", strict=False)) == expected


@pytest.mark.parametrize("bad", ["abc", "123456789,00", "1 2", "99.999.999,995"])
def test_bad_money_text(texts, bad):
    assert run(texts(bad), parse_decimal("x", strict=False)) == [None]
    with pytest.raises(PySparkException):
        run(texts(bad), parse_decimal("x"))


def test_date_text(texts):
    good = ["31/12/2025", "1/2/2025", " 01/02/2025 ", "", None]
    expected = [date(2025, 12, 31), date(2025, 2, 1), date(2025, 2, 1), None, None]
    assert run(texts(*good), parse_date("x")) == expected
    for bad in ("31/02/2025", "2025-01-01"):
        assert run(texts(bad), parse_date("x", strict=False)) == [None]
        with pytest.raises(PySparkException):
            run(texts(bad), parse_date("x"))


def test_integer_text(texts):
    assert run(texts(" 12 ", "", None, "-3"), parse_int("x")) == [12, None, None, -3]
    assert run(texts("1.5"), parse_int("x", strict=False)) == [None]
    with pytest.raises(PySparkException):
        run(texts("1.5"), parse_int("x"))


def test_strict_parsing_does_not_depend_on_ansi(spark, texts):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for parse in (parse_decimal, parse_date, parse_int):
            with pytest.raises(PySparkException):
                run(texts("abc"), parse("x"))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_total_and_days(spark):
    df = spark.createDataFrame(
        [(D("1.10"), None, D("0.05"), "2025-01-01", "2025-01-03"),
         (None, None, None, "2025-01-03", "2025-01-01"), (D("1.00"), D("2.00"), D("5.00"), None, "2025-01-01")],
        "a decimal(10,2), b decimal(10,2), c decimal(10,2), s string, e string")
    out = df.select(sum_or_zero(["a", "b"], ["c"]).alias("t"),
                    inclusive_days(F.to_date("s"), F.to_date("e")).alias("d"))
    assert out.schema["t"].dataType.simpleString() == "decimal(12,2)"
    assert [tuple(r) for r in out.collect()] == [(D("1.05"), 3), (D("0.00"), -1), (D("-2.00"), None)]


def test_text_clean_up(texts):
    assert run(texts("A/B, C/D", "A/B", " x ,y", ""), first_part("x")) == ["A/B", "A/B", "x", ""]
    assert run(texts("Aéreo", " Aéreo ", "", "  ", None), blank_to("x", "-")) == [
        "Aéreo", "Aéreo", "-", "-", "-"]
    assert run(texts(" sp", "são ", None), clean_upper("x")) == ["SP", "SÃO", None]
    assert run(texts("abc   ", "abcdef", None), fit_length("x", 4)) == ["abc ", "abcd", None]


def test_title_case_is_that_of_python(texts):
    names = ["MARIA DA-SILVA", "joão d'ávila", " ana  3b c. ", "", "o'neil-SOUZA", "x/y(z) éa", "ÇA VA"]
    assert run(texts(*names), title_case("x")) == [n.title().strip() for n in names]


def test_display_text(spark):
    values = [D("0.00"), D("1234567.80"), D("-1234.50"), D("999.99")]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(12,2)")
    assert run(df, currency("x")) == [f"R$ {float(v):,.2f}" for v in values]
    counts = [0, 12, 1234567]
    df = spark.createDataFrame([(v,) for v in counts], "x long")
    assert run(df, thousands("x")) == [f"{v:,}" for v in counts]
    df = spark.createDataFrame([(123456789,), (1499999,)], "x long")
    assert run(df, scaled("x", "M")) == ["R$ 123M", "R$ 1M"]
    assert run(df, scaled("x", "k")) == ["R$ 123,457k", "R$ 1,500k"]
