"""Keywords and extractive summaries, row by row (no shuffle).

keywords: letter-run tokens (lower case, 2+ letters, stop words removed)
counted per document; top ``n`` by (count desc, token).
summary: sentences scored by the summed keyword counts of their tokens
divided by their token count; the best ``n`` by (score desc, position),
re-joined in text order.
"""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sifter.functions.text import WS_RUN

# Stop words removed before keyword counting (en, fr, de, es).
STOP_WORDS = (
    "the", "and", "of", "to", "in", "a", "is", "it", "that", "for", "on", "with", "as", "was",
    "by", "this", "are", "be", "at", "or", "from", "an",
    "le", "la", "les", "de", "des", "du", "un", "une", "et", "en", "est", "que", "qui", "dans",
    "pour", "par", "sur", "au", "aux", "avec", "ou", "pas",
    "der", "die", "das", "und", "ein", "eine", "zu", "den", "dem", "mit", "von", "ist", "im",
    "für", "auf", "sich", "nicht",
    "el", "los", "las", "y", "que", "con", "para", "por", "se", "del", "al", "una", "no",
)
SENTENCE_SPLIT = r"(?<=[.!?])" + WS_RUN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyword_tokens(text) -> Column:
    toks = F.regexp_extract_all(F.lower(_c(text)), F.lit(r"\p{L}+"), 0)
    return F.filter(toks, lambda t: (F.length(t) >= 2) & ~t.isin(*STOP_WORDS))


def sentences(text) -> Column:
    parts = F.split(_c(text), SENTENCE_SPLIT)
    parts = F.transform(parts, lambda s: F.regexp_replace(s, f"^{WS_RUN}|{WS_RUN}$", ""))
    return F.filter(parts, lambda s: s != "")


def _most_frequent(tokens, n: int) -> list[tuple[str, int]]:
    return sorted(Counter(tokens).items(), key=lambda x: (-x[1], x[0]))[:n]


def top_keywords(text, n: int = 10) -> Column:
    """array<struct<keyword, cnt>>: the ``n`` most frequent (ties by keyword).
    Tokens are cut on the JVM side and counted per row in an Arrow batch."""
    @F.pandas_udf("array<struct<keyword:string,cnt:bigint>>")
    def top(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda t: None if t is None else [{"keyword": k, "cnt": c} for k, c in _most_frequent(t, n)])
    return top(keyword_tokens(text))


def keywords_topn(df: DataFrame, id_col: str, text_col: str, n: int = 10) -> DataFrame:
    """(id, rank, keyword, cnt) for the ``n`` most frequent keywords, row by row."""
    return (df.select(id_col, F.posexplode(top_keywords(text_col, n)).alias("_p", "_k"))
              .select(id_col, (F.col("_p") + 1).cast("long").alias("rank"), "_k.keyword", "_k.cnt"))


def summary(text, n_keywords: int = 10, n_sentences: int = 5) -> Column:
    """The best sentences joined by a space in text order; null without any."""
    @F.pandas_udf("string")
    def best(parts: pd.Series, tokens: pd.Series, every: pd.Series) -> pd.Series:
        def one(sents, toks, all_):
            if sents is None or not len(sents):
                return None
            weight = dict(_most_frequent(all_, n_keywords))
            score = [sum(weight.get(t, 0) for t in ts) / max(len(ts), 1) for ts in toks]
            chosen = sorted(sorted(range(len(score)), key=lambda i: (-score[i], i))[:n_sentences])
            return " ".join(sents[i] for i in chosen)
        return pd.Series([one(*x) for x in zip(parts, tokens, every, strict=True)], dtype=object)
    s = sentences(text)
    return best(s, F.transform(s, keyword_tokens), keyword_tokens(text))


def summary_topn(df: DataFrame, id_col: str, text_col: str, n_keywords: int = 10,
                 n_sentences: int = 5) -> DataFrame:
    """(id, summary) of the rows with a sentence, row by row."""
    out = df.select(id_col, summary(text_col, n_keywords, n_sentences).alias("summary"))
    return out.where(F.col("summary").isNotNull())
