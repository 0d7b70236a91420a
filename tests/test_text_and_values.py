import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldbook.functions import text, values


def one(spark, column, **inputs):
    df = spark.createDataFrame([tuple(inputs.values())], list(inputs))
    return df.select(column).first()[0]


@pytest.mark.parametrize(
    "s", ["", "o'neil-smith llc.", "3rd éa x1Y", "ALL CAPS  two", "straße ßa", "a\tb\nc", " already marked x"]
)
def test_title_case_equals_str_title(spark, s):
    assert one(spark, text.title_case(F.col("s")), s=s) == s.title()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcXYZ09 '-.\t\n"), max_size=20), min_size=1, max_size=30))
def test_title_case_property(spark, strings):
    df = spark.createDataFrame([(s,) for s in strings], "s string")
    got = [r[0] for r in df.select(text.title_case(F.col("s"))).collect()]
    assert got == [s.title() for s in strings]
    again = [r[0] for r in spark.createDataFrame([(g,) for g in got], "s string").select(text.title_case(F.col("s"))).collect()]
    assert again == got


def test_text_functions(spark):
    s = F.col("s")
    assert one(spark, text.strip(s), s=" \t a b \n") == "a b"
    assert one(spark, text.swap_case(s), s="aBc1") == "AbC1"
    assert one(spark, text.reverse_words(s), s=" one two  three ") == "three two one"
    assert one(spark, text.swap_pairs(s), s="abcde") == "badce"
    assert one(spark, text.interchange(s, 3, 1), s="abcde") == "adcbe"
    assert one(spark, text.interchange(s, 0, 9), s="abc") == "abc"
    assert one(spark, text.integer_tokens(s), s="12 ab 3x 7 ") == [12, 7]
    assert one(spark, text.letter_tokens(s), s="12 ab 3x é ") == ["ab", "é"]


@pytest.mark.parametrize("mark, want", [(100, "A"), (90, "A"), (89.9, "B"), (60, "C"), (40, "D"), (0, "F"), (-1, None), (101, None)])
def test_grades(spark, mark, want):
    assert one(spark, values.grade(F.col("m")), m=float(mark)) == want


@pytest.mark.parametrize("n, want", [(3, 13.0), (4, 42.0), (-3, -13.0), (0, 0.0)])
def test_parity(spark, n, want):
    assert one(spark, values.parity_adjust(F.col("n")), n=n) == pytest.approx(want)


def test_interest(spark):
    rule = values.simple_interest(F.col("k"), F.col("a"), F.col("m"))
    assert one(spark, rule, k="Saving", a=20000.0, m=6).asDict() == {"eligible": True, "interest": 600.0, "reason": "ok"}
    assert one(spark, rule, k="Saving", a=10.0, m=6).asDict() == {"eligible": False, "interest": None, "reason": "minimum is 10000"}
    assert one(spark, rule, k="Current", a=5000.0, m=6).asDict() == {"eligible": True, "interest": None, "reason": "ok"}


def test_safe_functions(spark):
    assert one(spark, values.safe_divide(F.col("a"), F.col("b")), a=1.0, b=0.0).asDict() == {"value": None, "error": "division by zero"}
    assert one(spark, values.safe_int(F.col("s")), s=" -12 ").asDict() == {"value": -12, "error": None}
    assert one(spark, values.safe_int(F.col("s")), s="9223372036854775808").asDict() == {"value": 2**63, "error": None}
    assert one(spark, values.safe_int(F.col("s")), s="1" * 39).asDict() == {"value": None, "error": "too many digits"}
    assert one(spark, values.safe_int(F.col("s")), s="1.5").asDict() == {"value": None, "error": "not a whole number"}


def test_lists(spark):
    a, b = F.array(F.lit(1), F.lit(4)).cast("array<bigint>"), F.array(F.lit(3)).cast("array<bigint>")
    get = lambda lists: one(spark, values.combine_lists(lists), x=1)
    assert get([a]) == [1, 4]
    assert get([a, b]) == [5]
    assert get([a, b, b]) == [11]
    assert get([a, b, b, b]) == [1, 16, 9, 9, 9, 1, 3, 3, 3]
    assert one(spark, values.identity_matrix(2), x=1) == [[1.0, 0.0], [0.0, 1.0]]


def test_whole_days_round_down(spark):
    t = F.to_timestamp
    assert one(spark, values.whole_days(t("a"), t("b")), a="2024-01-01 12:00:00", b="2024-01-03 11:00:00") == 1
    assert one(spark, values.whole_days(t("a"), t("b")), a="2024-01-03 11:00:00", b="2024-01-01 12:00:00") == -2
