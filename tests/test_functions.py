"""Column expressions: accent keys (both modes), number/date parsing, exact rounding."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from stellata.functions import (accent_key, avg_half_up, dash_to_zero, ibge_code, ibge_name,
                                locale_number, number_text, parse_mixed_date, ratio_half_up,
                                starts_with_code, strip_dot_zero, strip_ws, tolerant_float,
                                xml_escape)
from stellata.functions.text import ACCENTED, COMPAT_PLAIN, CORRECT_PLAIN


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()[0]


def test_accent_maps_lengths():
    assert len(ACCENTED) == 46 and len(CORRECT_PLAIN) == 46 and len(COMPAT_PLAIN) == 48


@pytest.mark.parametrize("name,correct,compat", [
    ("Abatiá", "ABATIA", "ABATIA"),
    ("  Foz do Iguaçu ", "FOZ DO IGUACU", "FOZ DO IGUAUU"),
    ("Maringá", "MARINGA", "MARINGA"),
    ("Paranaguá", "PARANAGUA", "PARANAGUA"),
    ("São José dos Pinhais", "SAO JOSE DOS PINHAIS", "SAO JOSA DOS PINHAIS"),
    ("Cândido de Abreu", "CANDIDO DE ABREU", "CANDIDO DE ABREU"),
    ("Mauá da Serra", "MAUA DA SERRA", "MAUA DA SERRA"),
    ("Pérola", "PEROLA", "PAROLA"),
    ("Ortigueira", "ORTIGUEIRA", "ORTIGUEIRA"),
    ("Guaíra", "GUAIRA", "GUAERA"),
    ("Ibiporã", "IBIPORA", "IBIPORA"),
    ("Tibagi ó ú", "TIBAGI O U", "TIBAGI I O"),
])
def test_accent_key(spark, name, correct, compat):
    assert one(spark, accent_key("x", "correct"), name) == correct
    assert one(spark, accent_key("x", "compat"), name) == compat


def test_accent_key_rejects_unknown_mode():
    with pytest.raises(ValueError):
        accent_key("x", "other")


def test_code_and_name(spark):
    assert one(spark, ibge_code("x"), "410010 ABATIA") == "410010"
    assert one(spark, ibge_name("x"), "410010 ABATIA") == "ABATIA"
    assert one(spark, starts_with_code("x"), "410010 ABATIA") is True
    assert one(spark, starts_with_code("x"), "Total") is False
    assert one(spark, starts_with_code("x"), "41001 X") is False


@pytest.mark.parametrize("text,want", [("-", 0), (None, 0), (" 12 ", 12), ("0", 0)])
def test_dash_to_zero(spark, text, want):
    assert one(spark, dash_to_zero("x"), text) == want


@pytest.mark.parametrize("text,want", [
    ("", None), ("-9999", None), ("-9999.0", None), ("null", None), ("NULL", None), ("-", None),
    ("-9999,00", None), ("-9999.00", None), ("abc", None), ("NaN", None), ("Infinity", None),
    (None, None), (" 12,5 ", 12.5), ("0", 0.0), ("-3.25", -3.25), ("1e2", 100.0),
])
def test_tolerant_float(spark, text, want):
    assert one(spark, tolerant_float("x"), text) == want


def test_tolerant_float_keeps_sentinel_when_asked(spark):
    assert one(spark, tolerant_float("x", null_sentinel=False), "-9999.00") == -9999.0


@pytest.mark.parametrize("text,want", [("1.234,56", "1234.56"), ("32,93", "32.93"),
                                       ("12.345.678,9", "12345678.90"), ("x", None)])
def test_locale_number(spark, text, want):
    got = one(spark, locale_number("x", 12, 2), text)
    assert (str(got) if got is not None else None) == want


@pytest.mark.parametrize("text,want", [("2018-01-31", "2018-01-31"), ("2019/02/28", "2019-02-28"),
                                       ("03/04/2020", "2020-04-03"), (" 2021-12-01 ", "2021-12-01"),
                                       ("31/02/2020", None), ("sem data", None)])
def test_parse_mixed_date(spark, text, want):
    got = one(spark, parse_mixed_date("x"), text)
    assert (str(got) if got else None) == want


@pytest.mark.parametrize("value,want", [("32.50", "32.5"), ("7.00", "7"), ("0.50", ".5"),
                                        ("-0.25", "-.25"), ("120", "120"), ("100.10", "100.1")])
def test_number_text(spark, value, want):
    assert one(spark, number_text(F.col("x").cast("decimal(10,2)")), value) == want


def test_small_text_helpers(spark):
    assert one(spark, strip_ws("x"), "\t a b \r\n") == "a b"
    assert one(spark, strip_dot_zero("x"), "1234.0") == "1234"
    assert one(spark, strip_dot_zero("x"), "1234.05") == "1234.05"
    assert one(spark, xml_escape("x"), 'a&b<c>"d\'') == "a&amp;b&lt;c&gt;&quot;d&apos;"


def _half_up(num: int, den: int, scale: int) -> Decimal:
    return (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


def test_ratio_half_up_matches_exact_decimal(spark):
    rnd = random.Random(7)
    cases = [(1, 8), (3, 8), (-3, 8), (41, 40), (-41, 40), (1, 3), (2, 3), (5, -8), (0, 5),
             (10 ** 14 + 5, 10 ** 3), (-(10 ** 16) - 5, 10), (7, 10 ** 12 + 1)]
    cases += [(rnd.randint(-10 ** 9, 10 ** 9), rnd.randint(1, 10 ** 4)) for _ in range(300)]
    df = spark.createDataFrame(cases, "n bigint, d bigint")
    got = df.select("n", "d", ratio_half_up("n", "d", 2).alias("r")).collect()
    for n, d, r in got:
        assert r == _half_up(n, d, 2), (n, d, r)


def test_ratio_half_up_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None)], "n bigint, d bigint")
    assert [r[0] for r in df.select(ratio_half_up("n", "d", 2)).collect()] == [None, None]


def test_avg_half_up_ties_and_nulls(spark):
    df = spark.createDataFrame([("a", 1.01), ("a", 1.02), ("b", None), ("c", 2.5), ("c", None)],
                               "g string, v double")
    got = dict(df.groupBy("g").agg(avg_half_up("v", 2, 2).alias("m")).collect())
    assert got == {"a": Decimal("1.02"), "b": None, "c": Decimal("2.50")}
