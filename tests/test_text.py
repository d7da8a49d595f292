import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import values
from metacurate.functions import text as t

CSV = [
    ("liver, heart, lung", ["liver", "heart", "lung"]),
    ('"liver, left lobe"', ["liver, left lobe"]),
    ("cow,,  ,pig", ["cow", "", "", "pig"]),
    ('",40 weeks"', [",40 weeks"]),
    ('"  ,kept as is"', ["  ,kept as is"]),
    ('"open', None),
    ('"closed"   ', ["closed"]),
    ('"closed" not at the end', None),
    ('"open, with a comma', None),
    ('"male","female"', ["male", "female"]),
    ("   north shed, pen 4   ", ["north shed", "pen 4"]),
    ('"day 1, morning", "fed", "rain, wind, hail"', ["day 1, morning", "fed", "rain, wind, hail"]),
    ('plain,"quoted, twice",tight, "one, after, a space"', ["plain", "quoted, twice", "tight", "one, after, a space"]),
    ("a,b,,", ["a", "b"]),
    (",,,", []),
    ("x", ["x"]),
    ("'it, is', b", ["'it, is'", "b"]),
    ('"a" b, c"', ['a" b, c']),
]


def column(spark, items, kind="string"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, s {kind}").coalesce(1)


def apply(spark, items, fn, kind="string"):
    return values(column(spark, items, kind).orderBy("i").select(fn(F.col("s"))))


def test_split_delimited(spark):
    got = apply(spark, [line for line, _ in CSV], lambda c: t.split_delimited(c, on_error="null"))
    assert got == [fields for _, fields in CSV]


@pytest.mark.parametrize("line", [line for line, fields in CSV if fields is None])
def test_split_delimited_fails_on_unclosed_quote(spark, line):
    with pytest.raises(Exception, match="unclosed quote"):
        apply(spark, [line], t.split_delimited)


def test_split_delimited_rejects_unknown_mode():
    with pytest.raises(ValueError):
        t.split_delimited(None, on_error="ignore")


def test_camel_case_both_ways(spark):
    names = ["variable_name", "VARIABLE_NAME", "_var_x_short", "__variable__name___", "health status", "", None]
    camel = apply(spark, names, t.lower_camel)
    assert camel == ["variableName", "variableName", "varXShort", "variableName", "healthStatus", "", None]
    assert apply(spark, camel, t.words_from_camel) == [
        "variable name", "variable name", "var x short", "variable name", "health status", "", None,
    ]


def test_camel_case_breaks_words_at_word_characters_only(spark):
    assert apply(spark, ["a -b c", "état élevé"], t.lower_camel) == ["a -bC", "étatÉlevé"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text("abcxyz", min_size=1, max_size=5), min_size=1, max_size=4), min_size=1, max_size=20))
def test_camel_case_round_trip(spark, phrases):
    phrases = [" ".join(p) for p in phrases]
    assert apply(spark, phrases, lambda c: t.words_from_camel(t.lower_camel(c))) == phrases


def test_trim_takes_any_whitespace(spark):
    padded = ["\t a b \n", " x ", "   ", ""]
    assert apply(spark, padded, t.trim_all) == ["a b", "x", "", ""]
    assert apply(spark, padded, t.ltrim_all) == ["a b \n", "x ", "", ""]
    assert apply(spark, padded, t.rtrim_all) == ["\t a b", " x", "", ""]


def test_upper_first(spark):
    assert apply(spark, ["abC", "é", "x", "", None], t.upper_first) == ["AbC", "É", "X", "", None]


def test_readable_size(spark):
    sizes = [0, 1023, 1024, 1152, 1536, 1048575, 1024**2, 1024**5, 2 * 1024**6, -5, None]
    assert apply(spark, sizes, t.readable_size, "bigint") == [
        "0B", "1023B", "1.00kB", "1.12kB", "1.50kB", "1024.00kB", "1.00MB", "1.00PB", "2048.00PB", "-5B", None,
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 2**50), min_size=1, max_size=50))
def test_readable_size_agrees_with_printf(spark, sizes):
    def plain(n):
        unit = 0
        value = float(n)
        while value >= 1024 and unit < 5:
            value /= 1024
            unit += 1
        return f"{n}B" if unit == 0 else f"{value:.2f}{t.SIZE_UNITS[unit]}"

    assert apply(spark, sizes, t.readable_size, "bigint") == [plain(n) for n in sizes]


def test_clean_description(spark):
    raw = ["  one\n\ttwo   three \n", "a\nb", None]
    assert apply(spark, raw, t.clean_description) == ["one two three", "ab", None]


def test_terms_and_labels(spark):
    assert apply(spark, ["EFO_0001_x", "plain", None], t.term_reference) == ["EFO:0001_x", "plain", None]
    assert apply(spark, ["S1"], lambda c: t.project_label("LAB-", c)) == ["LAB-S1"]
    assert apply(spark, ["R1", None], lambda c: t.cross_references([("DB", c), ("X", F.lit("7"))])) == [
        "DB-R1;X-7", "X-7",
    ]
