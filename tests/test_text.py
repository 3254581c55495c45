import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticelens.functions.text import (
    clean_entities,
    clean_light,
    clean_title,
    join_keyword_columns,
    keyword_list,
    register_functions,
    token_window,
    word_tokens,
)

GOLDEN = [
    (None, "", ""),
    ("", "", ""),
    ("  ", "", ""),
    ("Road design (phase 2) [urgent]", "Road design phase 2 urgent", "Road design (phase 2) [urgent]"),
    ("A/B: it´s #1", "A B its 1", "A/B: it´s #1"),
    ("a &#40;x&#41; b", "a b x", "a (x) b"),
    ("(y] z", "z y", "(y] z"),
    ("(a/b:c) d", "d a/b:c", "(a/b:c) d"),
    ("(p\nq) r", "(p q) r", "(p q) r"),
    ("() e", "() e", "() e"),
    ("((n) m)", "m) (n", "((n) m)"),
    ("a&nbsp;&nbsp;b　c\x1cd", "a b c d", "a b c d"),
    ("R&amp;amp;D &amp D &am E", "R&amp;D & D &am E", "R&amp;D & D &am E"),
    ("한글(가) 공고", "한글 공고 가", "한글(가) 공고"),
]


def test_golden_rows(spark):
    df = spark.createDataFrame([(n, t) for n, (t, _, _) in enumerate(GOLDEN)], "n int, t string")
    rows = df.select("n", clean_title(F.col("t")), clean_light(F.col("t"))).collect()
    got = {r[0]: (r[1], r[2]) for r in rows}
    assert got == {n: (strong, light) for n, (_, strong, light) in enumerate(GOLDEN)}


def test_entity_only_clean(spark):
    df = spark.createDataFrame([("a&lt;b",), (None,), ("a  b",)], "t string")
    assert [r[0] for r in df.select(clean_entities(F.col("t"))).collect()] == ["a<b", "", "a  b"]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=200, max_size=200))
def test_light_clean_equals_python(spark, texts):
    texts = [t.replace("\x00", "") for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = dict(df.select("n", clean_light(F.col("t"))).collect())
    for n, t in enumerate(texts):
        assert got[n] == re.sub(r"\s+", " ", html.unescape(t)).strip()


def test_strong_clean_is_idempotent_without_brackets(spark):
    texts = ["a / b: c # d", "x´s   y'z", "plain"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    once = clean_title(F.col("t"))
    assert all(a == b for a, b in df.select(once, clean_title(once)).collect())


@pytest.mark.parametrize("null_as_nan,expected", [(False, []), (True, ["nan"])])
def test_keyword_list(spark, null_as_nan, expected):
    df = spark.createDataFrame([(" a, b ,, 　c\t",), (None,)], "k string")
    got = [r[0] for r in df.select(keyword_list(F.col("k"), null_as_nan)).collect()]
    assert got == [["a", "b", "c"], expected]


def test_joined_keyword_columns_skip_null(spark):
    df = spark.createDataFrame([("x", "a", None, "c")], "l string, Keyword_1 string, Keyword_2 string, MyKeyword string")
    assert df.select(join_keyword_columns(df.columns)).first()[0] == "a, c"


def test_word_tokens_keep_hangul_and_drop_stop_words(spark):
    df = spark.createDataFrame([("The 공고 a service_x and AND 가 b2",)], "t string")
    tokens = df.select(word_tokens(F.col("t"), ["and"])).first()[0]
    assert tokens == ["the", "공고", "service_x", "b2"]


def test_token_window_cuts_and_pads(spark):
    df = spark.createDataFrame([(["a"] * 5,), (["b"],), ([],)], "t array<string>")
    rows = df.select(token_window(F.col("t"), 3).alias("w")).select("w.*").collect()
    assert [r.tokens for r in rows] == [["a"] * 3, ["b", "[PAD]", "[PAD]"], ["[PAD]"] * 3]
    assert [r["mask"] for r in rows] == [[1, 1, 1], [1, 0, 0], [0, 0, 0]]


def test_sql_registration(spark):
    register_functions(spark)
    assert spark.sql("SELECT html_unescape('a&amp;b')").first()[0] == "a&b"
