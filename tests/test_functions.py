import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bronzeway import values as v
from bronzeway.functions import dates, numbers, recode, text


def test_null_tokens_become_null(column):
    cases = [*v.NULL_TOKENS, None, "NULL", " NA", "", "x"]
    assert column(lambda c: text.null_token(c, v.NULL_TOKENS), cases) == [None] * 7 + ["NULL", " NA", "", "x"]


@pytest.mark.parametrize("fill", [v.CLASSIFICATION_FILL, v.LAYOUT_FILL])
def test_null_tokens_with_a_default(column, fill):
    got = column(lambda c: text.null_token(c, v.NULL_TOKENS, fill), ["(null)", None, "Reta"])
    assert got == [fill, fill, "Reta"]


def test_weekday(column):
    got = column(
        lambda c: text.lower_without(c, v.WEEKDAY_SUFFIX),
        ["Segunda-feira", "SEXTA-FEIRA", "Domingo", "a-feirab-feira", None],
    )
    assert got == ["segunda", "sexta", "domingo", "ab", None]


def test_dates(column):
    cases = {
        "2017-01-31": datetime.date(2017, 1, 31),
        "31/01/07": datetime.date(2007, 1, 31),
        "31/01/99": datetime.date(2099, 1, 31),
        "31/01/2010": datetime.date(2010, 1, 31),
        "31/02/2010": None,
        "2017-02-30": None,
        "1/2/2010": None,
        "2017-01-31 00:00": None,
        "xx": None,
        "(null)": None,
        None: None,
    }
    got = column(lambda c: dates.date_by_shape(c, v.DATE_SHAPES, v.DATE_OTHERWISE), list(cases))
    assert got == list(cases.values())


def test_decimal_comma(column):
    cases = {
        "12,5": 12.5, "12.5": 12.5, " 7 ": 7.0, ",5": 0.5, "-1,25": -1.25, "1e2": 100.0,
        "1.234,5": None, "1,2,3": None, "abc": None, "": None, None: None,
        "inf": float("inf"), "-Infinity": float("-inf"), "1d": 1.0, "0x1p3": 8.0,
    }
    assert column(lambda c: numbers.comma_float(c), list(cases)) == list(cases.values())


def test_int(column):
    cases = {
        "12": 12, "12.9": 12, "-1.9": -1, " 7. ": 7, "+3": 3, ".5": 0, "-.5": 0,
        "2147483647": 2147483647, "-2147483648": -2147483648, "000000000000012": 12,
        "1e3": None, "abc": None, "": None, "-": None, None: None, "12. 5": None,
        "3000000000": None, "2147483648": None, "99999999999999999999": None,
    }
    assert column(lambda c: numbers.lenient_int(c), list(cases)) == list(cases.values())


@settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(st.text(alphabet="0123456789.+-eEdfna \t", max_size=14), min_size=50, max_size=200)
)
def test_numbers_equal_the_lenient_casts(spark, texts):
    """The casts of a session without ANSI mode are what the results must equal."""
    rows = spark.createDataFrame([(t,) for t in texts], "c string")
    c = F.col("c")
    ours = rows.select(numbers.lenient_int(c), numbers.comma_float(c)).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        lenient = rows.select(c.cast("int"), F.translate(c, ",", ".").cast("float")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert [repr(tuple(r)) for r in ours] == [repr(tuple(r)) for r in lenient]


def test_zero_pad(column):
    cases = [1, 101, 1234, 0, -5, None]
    assert column(lambda c: numbers.padded_code(c, 3, "null"), cases, "int") == [
        "001", "101", "1234", "000", "-05", "null",
    ]
    assert column(lambda c: numbers.padded_code(c, 3), [None, 7], "int") == [None, "007"]


def test_lookup(column):
    mapping = {"a": "1", "b": "1", "c": "2"}
    cases = ["a", "b", "c", "d", "gone", None]
    assert column(lambda c: recode.lookup(c, mapping, ["gone"]), cases) == ["1", "1", "2", "d", None, None]
    assert column(lambda c: recode.lookup(c, mapping, keep=False), cases) == ["1", "1", "2", None, None, None]


def test_rules_in_order(column):
    cases = {
        "colisão com objeto fixo": "colisão com objeto",
        "objeto: colisão e queda": "colisão com objeto",
        "queda de motocicleta": "queda do veiculo",
        "queda de pedestre": "queda do veiculo",
        "atropelamento de pedestre": "atropelamento de pessoa",
        "saída de leito carroçável": "saída de pista",
        "uma saída de leito carroçável": "uma saída de leito carroçável",
        "capotamento": "capotamento",
        None: None,
    }
    assert column(lambda c: recode.by_rules(c, v.TYPE_RULES), list(cases)) == list(cases.values())
    assert column(lambda c: recode.by_rules(c, v.TYPE_RULES, keep=False), ["capotamento"]) == [None]


def test_unknown_rule_kind():
    with pytest.raises(ValueError):
        recode.by_rules(F.lit("x"), [("regex", "x", "y")])


def test_digit_mask(column):
    assert column(lambda c: text.digit_mask(c), ["31/01/07", "-23,5", "x", None]) == [
        "DD/DD/DD", "-DD,D", "x", None,
    ]


def test_label_cut(column):
    got = column(lambda c: text.cut_label(c), ["é" * 34, "é" * 35, "é" * 36, None])
    assert got == ["é" * 34, "é" * 35 + "...", "é" * 35 + "...", None]


@pytest.mark.parametrize(
    "style, cases",
    [
        ("grouped", {1234567.0: "1,234,567", 0.5: "0", 1.5: "2", 999.0: "999"}),
        ("mil", {12345.0: "12 mil", 1000.0: "1 mil", 999.7: "999", 3.0: "3", 2e6: "2000 mil"}),
        ("mil_round", {12999.0: "12 mil", 999.7: "1000", 0.5: "0", 1.5: "2"}),
        ("k1", {12345.0: "12.3", 1250.0: "1.2", 1350.0: "1.4", 1234567.0: "1234.6"}),
        ("pct1", {0.1234: "12.3%", 0.0: "0.0%", 1.0: "100.0%"}),
    ],
)
def test_number_text(column, style, cases):
    assert column(lambda c: text.number_text(c, style), list(cases), "double") == list(cases.values())


@given(st.floats(min_value=0, max_value=1e7, allow_nan=False))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_number_text_as_python_formats(column, x):
    assert column(lambda c: text.number_text(c, "k1"), [x], "double") == [f"{x / 1e3:.1f}"]
    assert column(lambda c: text.number_text(c, "grouped"), [x], "double") == [f"{x:,.0f}"]


def test_unknown_style():
    with pytest.raises(ValueError):
        text.number_text(F.lit(1), "words")


def test_within_years(column):
    days = [datetime.date(1999, 12, 31), datetime.date(2000, 1, 1), datetime.date(2001, 12, 31),
            datetime.date(2002, 1, 1), None]
    assert column(lambda c: dates.within_years(c, 2000, 2001), days, "date") == [
        False, True, True, False, None,
    ]
