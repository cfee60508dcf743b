import string

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sifter.functions.text import clean_text, digit_tokens, strip_ws, words

WS_CHARS = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0        　"
texts = st.text(alphabet=st.sampled_from(list(string.ascii_letters + "éÀß0123456789.,") + list(WS_CHARS)), max_size=60)


@settings(max_examples=60, deadline=None)
@given(st.lists(texts, min_size=1, max_size=20))
def test_clean_text_equals_python_split_join(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", clean_text("t").alias("c")).collect()}
    for i, x in enumerate(xs):
        assert got[i] == " ".join(x.lower().split())


def test_clean_text_idempotent_and_null(spark):
    df = spark.createDataFrame([("  A B\n\nC  ",), (None,)], "t string")
    r = df.select(clean_text("t").alias("a"), clean_text(clean_text("t")).alias("b")).collect()
    assert r[0].a == "a b c" == r[0].b
    assert r[1].a is None


def test_strip_words_digits(spark):
    df = spark.createDataFrame([("　 page 3 of 12 \n",)], "t string")
    r = df.select(strip_ws("t").alias("s"), words("t").alias("w"), digit_tokens("t").alias("d")).first()
    assert r.s == "page 3 of 12"
    assert r.w == ["page", "3", "of", "12"]
    assert r.d == ["3", "12"]
