"""Missing-value rules, keys and codes, text expressions on edge cases."""

import unicodedata

import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quadrat.functions import keys as K, language as L, missing as M, text as X


def values(spark, data, schema, *exprs):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*exprs).collect()]


def test_missing_counts_as_largest(spark):
    got = values(spark, [(1.0,), (5.0,), (None,)], "x double", M.gt_m("x", 3), M.ge_m("x", 5), M.lt_m("x", 3), M.le_m("x", 5), M.ne_m("x", 1.0))
    assert got == [(False, False, True, True, False), (True, True, False, True, True), (True, True, False, False, True)]


def test_sentinels_touch_only_their_type(spark):
    df = spark.createDataFrame([("Not Stated", "a", -99, 2.0), ("", "b", 3, -100.0)], "s string, t string, i int, d double")
    out = M.recode_sentinel_numbers(M.recode_sentinel_strings(df, ["Not Stated"]), [-99, -100])
    assert rows(out, "t") == [(None, "a", None, 2.0), (None, "b", 3, None)]


def test_zero_code_precedes_negative_codes(spark):
    assert values(spark, [(-100.0,), (-5.0,), (2.0,), (None,)], "x double", M.zero_then_missing("x")) == [(0.0,), (None,), (2.0,), (None,)]


def test_flags(spark):
    got = values(spark, [("Y",), ("N",), (None,)], "a string", M.yes_no("a"), M.flag(F.col("a") == "Y"),
                 M.flag(F.col("a") == "Y", F.col("a").isNotNull()), M.dummy(F.col("a") == "Y", "a"))
    assert got == [(1, 1, 1, 1), (0, 0, 0, 0), (None, 0, None, None)]


def test_year_must_be_known_type_need_not(spark):
    data = [(1970, None), (None, "Journal"), (1970, "Patent"), (1990, "Journal")]
    assert [r[0] for r in values(spark, data, "y int, d string", M.known_year_and_type("y", 1980, "d", "Patent"))] == [True, False, False, False]


def test_filters(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 2)], "a int, b int")
    assert (M.drop_all_missing(df).count(), M.complete_cases(df, ["a", "b"]).count()) == (2, 1)
    assert M.drop_when(df, F.col("b") > 1).count() == 2 and M.keep_when(df, F.col("b") > 1).count() == 1
    assert values(spark, [("72001",), (None,)], "f string", M.has_prefix("f", "72"), M.slice_equals("f", 2, "001"))[0] == (True, True)
    assert [r[0] for r in values(spark, [("a", "b"), ("", "b")], "a string, b string", M.all_present(["a", "b"]))] == [True, False]


def test_padding_keeps_long_values(spark):
    assert [r[0] for r in values(spark, [("1",), ("123456",)], "x string", K.zero_pad("x", 5))] == ["00001", "123456"]
    assert values(spark, [(1001.0,)], "x double", K.zero_pad("x", 5)) == [("01001",)]


def test_numbers_from_text(spark):
    got = values(spark, [("1,234",), (".",), ("0",), ("n/a",), (None,)], "x string", K.number_from_text("x", blank_mark="."), K.number_from_text("x"))
    assert got == [(1234, 1234), (None, None), (None, 0), (None, None), (None, None)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aBc '-1é_", max_size=12), min_size=1, max_size=8))
def test_title_case_is_python_title(spark, texts):
    got = [r[0] for r in values(spark, [(t,) for t in texts], "x string", K.title_case("x"))]
    assert got == [t.title() for t in texts]


def test_interval_ceiling(spark):
    data = [("36000 - 48000",), ("<=36000",), (">3600000",), (None,)]
    assert [r[0] for r in values(spark, data, "x string", K.interval_ceiling("x", {"<=36000": "36000", ">3600000": "3600000"}))] == [48000.0, 36000.0, 3600000.0, None]


def test_codes(spark):
    df = spark.createDataFrame([("b", 10), ("a", 15), (None, None), ("b", 61)], "v string, age int")
    assert [r.code for r in K.encode_sorted(df, "v", "code").orderBy(F.col("v").asc_nulls_last(), "age").collect()] == [1, 2, 2, None]
    assert [tuple(r) for r in K.one_hot(df, "v", "p").orderBy("age").select("p1", "p2").collect()] == [(None, None), (0, 1), (1, 0), (0, 1)]
    assert [r[0] for r in df.orderBy("age").select(K.range_code("age", [(15, 25, 1), (61, None, 61)])).collect()] == [61, None, 1, 61]
    assert rows(K.group_id(df, ["v", "age"], "g").filter("g is not null"), "g") == [("a", 15, 1), ("b", 10, 2), ("b", 61, 3)]
    with pytest.raises(Exception, match="no code for"):
        df.select(K.recode("v", {"a": 1}, strict=True)).collect()
    assert K.label_of(K.set_label(df, {"age": "Age"}), "age") == "Age"
    swapped = K.swap_key_value(spark.createDataFrame([(1, "x"), (2, "x")], "k int, n string"), "k", "n")
    assert rows(swapped) == [("x", 2)]


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab \t\n  ", max_size=20))
def test_squeeze_is_python_split_join(spark, text):
    once = values(spark, [(text,)], "x string", X.squeeze("x"))[0][0]
    assert once == " ".join(text.split())


def test_unicode_and_markup(spark):
    data = [("ﬁ é <b>x</b>&amp;y<script>z</script>",), (None,)]
    got = values(spark, data, "x string", X.normalise("NFKC")("x"), X.html_text(F.col("x")), X.decomposed_text(F.col("x")))
    assert got[0] == ("fi é <b>x</b>&amp;y<script>z</script>", "ﬁ é x&y", unicodedata.normalize("NFKD", "fi é x&y")) and got[1] == (None, None, None)


def test_name_pieces(spark):
    one = lambda t, e: values(spark, [(t,)], "x string", e)[0][0]
    assert one("a!!b??c", X.sentence_marks("x")) == "a. b. c"
    assert one("a. . b...", X.collapse_dots("x")) == "a. b."
    assert one("The cat of AN act", X.drop_words("x", ["the", "of", "an"])) == " cat   act"
    assert one("  New-Delhi 12 ", X.clean_place("x")) == "New-Delhi" and one("12", X.clean_place("x")) is None
    assert one("Other", X.drop_placeholder("x")) == "" and one(None, X.drop_placeholder("x")) == ""
    assert one("x", X.join_name_parts(F.lit(""), F.lit(""))) == "" and one("x", X.join_name_parts(F.lit(""), F.lit("d"))) == ". d"
    assert one("", X.title_and_body("x", F.lit(""))) == "" and one("t", X.title_and_body("x", F.lit(""))) == "t"
    assert one("go(1,\n'v')", X.capture(F.lit("zz"), r"go\((\d),'(.)'\)", 2, fallback="x")) == "v"


def test_language(spark):
    data = [("The cat is on the mat",), ("le chat est dans la maison",), ("",), ("zzz",), (None,)]
    assert [r[0] for r in values(spark, data, "x string", L.language("x"))] == ["en", "fr", "nan", "nan", "nan"]


def test_injected_detector_failures(spark):
    def load():
        def predict(texts):
            if "bad" in texts[0]:
                raise ValueError("no")
            return ["xx"]
        return predict

    out = L.detect_with(spark.createDataFrame([("ok",), ("bad",), ("",)], "t string"), "t", load)
    assert rows(out, "t") == [("", "nan", False), ("bad", None, True), ("ok", "xx", False)]
