"""Embedding: text column -> ``array<float>`` column, by encoder name.

Encoders are Column -> Column functions. The built-in ones are hashed
term-frequency encoders (pure SQL). A model-backed encoder plugs in through
``model_encoder``: an iterator ``pandas_udf`` that loads the model once per
Python worker and encodes Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType


Encoder = Callable[[Column], Column]


def hashed_encoder(dim: int) -> Encoder:
    from sifter.functions.embedding import hashed_tf
    return lambda c: hashed_tf(c, dim)


# Registry of encoder names usable in configs and grids.
ENCODERS: dict[str, Encoder] = {
    "hash64": hashed_encoder(64),
    "hash128": hashed_encoder(128),
    "hash256": hashed_encoder(256),
}


def register_encoder(name: str, encoder: Encoder) -> None:
    ENCODERS[name] = encoder


def model_encoder(load: Callable[[], Callable[[list[str]], list[list[float]]]]) -> Encoder:
    """Wrap a model loader as an encoder. ``load()`` runs once per Python
    worker and returns ``encode(texts) -> vectors``."""
    @F.pandas_udf(ArrayType(FloatType()))
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for s in batches:
            mask = s.notna()
            vectors = iter(encode(s[mask].tolist()) if mask.any() else ())
            yield pd.Series([next(vectors) if there else None for there in mask], index=s.index, dtype=object)
    return _enc


def embed(df: DataFrame, text_col: str, encoder: str | Encoder = "hash64",
          out_col: str = "embedding") -> DataFrame:
    """Add ``out_col`` = encoder(text)."""
    fn = ENCODERS[encoder] if isinstance(encoder, str) else encoder
    return df.withColumn(out_col, fn(F.col(text_col)))
