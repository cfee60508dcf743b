from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sifter.operators.chunk import (pack, recursive_chunker, separator_chunker, split_documents,
                                    split_recursive, split_separator, token_chunker)

words = st.text(alphabet="abcdefgh", min_size=1, max_size=12)


def model_pack(pieces, size, overlap, sep):
    """Straightforward restatement of the packing contract."""
    out, cur = [], []

    def total(c):
        return sum(len(p) for p in c) + len(sep) * max(len(c) - 1, 0)

    for d in pieces:
        if cur and total(cur) + len(d) + len(sep) > size:
            t = sep.join(cur).strip()
            if t:
                out.append(t)
            while cur and (total(cur) > overlap or total(cur) + len(d) + len(sep) > size):
                cur.pop(0)
        cur.append(d)
    t = sep.join(cur).strip()
    if t:
        out.append(t)
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(words, max_size=40), st.integers(5, 60), st.integers(0, 60), st.sampled_from(["", " ", "\n\n"]))
def test_pack_matches_model(pieces, size, overlap, sep):
    assert pack(pieces, size, overlap, sep) == model_pack(pieces, size, overlap, sep)


@settings(max_examples=200, deadline=None)
@given(st.lists(words, max_size=60), st.integers(13, 80))
def test_chunks_fit_and_zero_overlap_concatenates(ws, size):
    text = " ".join(ws)
    chunks = split_recursive(text, size, 0)
    assert all(len(c) <= size for c in chunks)
    assert "".join(c.replace(" ", "") for c in chunks) == text.replace(" ", "")


@settings(max_examples=100, deadline=None)
@given(st.lists(words, max_size=60), st.integers(13, 80), st.integers(0, 12))
def test_overlapping_chunks_keep_every_word(ws, size, overlap):
    text = " ".join(ws)
    chunks = split_recursive(text, size, overlap)
    assert set(" ".join(chunks).split()) == set(ws)


def test_oversize_piece_emitted_whole():
    assert split_separator("a\n" + "x" * 30 + "\nb", size=10, overlap=0, separator="\n") == ["a", "x" * 30, "b"]


def test_recursive_falls_back_to_characters():
    long_word = "y" * 25
    out = split_recursive(long_word, size=10, overlap=0)
    assert "".join(out) == long_word and all(len(c) <= 10 for c in out)


def test_spark_chunkers_equal_python(spark):
    docs = [(1, "one two three four five six seven eight nine ten " * 20), (2, "short"), (3, None), (4, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = split_documents(df, recursive_chunker(60, 15)).orderBy("doc_id", "chunk_pos").collect()
    want = [(d, i, c) for d, t in docs if t for i, c in enumerate(split_recursive(t, 60, 15))]
    assert [(r.doc_id, r.chunk_pos, r.chunk_text) for r in got] == want
    sep = split_documents(df, separator_chunker(50, 10, " ")).count()
    assert sep == sum(len(split_separator(t, 50, 10, " ")) for _, t in docs if t)


def test_token_chunker_windows(spark):
    df = spark.createDataFrame([(" ".join(str(i) for i in range(10)),)], "t string")
    r = df.select(token_chunker(4, 1)(F.col("t")).alias("c")).first().c
    assert r == ["0 1 2 3", "3 4 5 6", "6 7 8 9"]
    r0 = df.select(token_chunker(5, 0)(F.col("t")).alias("c")).first().c
    assert r0 == ["0 1 2 3 4", "5 6 7 8 9"]


def test_token_length_function():
    n_words = lambda s: len(s.split())  # noqa: E731  (X3: size counted in words)
    assert split_recursive("a b c d e f g h", 3, 1, length=n_words) == ["a b c", "c d e", "e f g", "g h"]
    assert split_separator("p q\nr s t\nu", 3, 0, "\n", length=n_words) == ["p q", "r s t", "u"]
