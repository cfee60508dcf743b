"""Chat formatting: typed content parts, flattened by a visitor into one
marked chunk per turn, with a loss mask and attachment records [native].

A turn is ``parts array<struct<kind, text, uri, units>>``. The visitor goes
through the parts in order: text is escaped and copied, every other kind
(``image``, ``audio``, ``document``, anything else) becomes a numbered
placeholder ``<|kind:n|>`` and an attachment record with its expanded token
count. The chunk of a turn is::

    <|im_start|>ROLE\\nBODY<|im_end|>\\n

and the formatted conversation is its chunks in order. Control strings begin
with ``<|``; a text keeps that pair apart by one more backslash between ``<``
and ``|`` (``<`` + n backslashes + ``|`` is written with n + 1), which loses
nothing and leaves no ``<|`` in the body. Roles are URL-encoded.

Chunks are made row by row, before anything is shuffled. One conversation's
rows meet only where its digest is asked for: in one string, or, if a conversation
is longer than MOST bytes, in a stream of sorted turns that feeds the digest
(Python: Spark SQL has no digest that is fed piece by piece).

Nulls and ties: a null text is the empty text, a null role the empty role, a
null ``parts`` no parts; a null conversation id is a conversation of its own;
null turns come first; turns that repeat are ordered by role, then text, and
rows that repeat are formatted twice. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
WS_PARTS = "array<struct<kind:string,text:string,uri:string,units:bigint>>"
#: Units of one expanded token: pixels of an image patch, milliseconds of audio, characters of a document.
UNITS_PER_TOKEN = {"image": 28 * 28, "audio": 40, "document": 4}

#: Bytes of one conversation whose digest is taken from one string.
MOST = 256 << 20


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def text_part(text: Column) -> Column:
    """A turn that is one text part."""
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text, F.lit("")).alias("text"),
                            F.lit(None).cast("string").alias("uri"), F.lit(None).cast("bigint").alias("units")))


def _tokens(part: Column) -> Column:
    per = F.lit(1)
    for kind, n in UNITS_PER_TOKEN.items():
        per = F.when(part["kind"] == kind, F.lit(n)).otherwise(per)
    return F.greatest(F.ceil(F.coalesce(part["units"], F.lit(0)) / per), F.lit(1).cast("bigint"))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def format_turns(turns: DataFrame, parts: Column, keys: list[str] | None = None, role_col: str = "role",
                 loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per turn: ``keys``, ``chunk`` (text of the formatted
    conversation), ``loss_start`` and ``loss_end`` (code points in the chunk
    that the loss covers; equal where it covers none) and ``attachments``
    (ordinal, kind, uri, tokens)."""
    keys = keys or ["conv_id", "turn"]
    parts = F.coalesce(parts.cast(WS_PARTS), F.array().cast(WS_PARTS))
    t = turns.select(*[F.col(k) for k in keys], F.coalesce(F.col(role_col), F.lit("")).alias("_role"), parts.alias("_parts"))
    media = F.filter("_parts", lambda p: ~_is_text(p))
    ordinal = lambda i: F.size(F.filter(F.slice("_parts", 1, i + 1), lambda p: ~_is_text(p)))
    body = F.array_join(F.transform("_parts", lambda p, i: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit(""))))
                                    .otherwise(F.concat(F.lit("<|"), F.url_encode(p["kind"]), F.lit(":"), ordinal(i), F.lit("|>")))), "")
    head = F.concat(F.lit(START), F.url_encode("_role"), F.lit("\n"))
    t = t.select(*keys, "_role", body.alias("_body"), head.alias("_head"),
                 F.transform(media, lambda p, i: F.struct((i + 1).alias("ordinal"), p["kind"].alias("kind"), p["uri"].alias("uri"),
                                                          _tokens(p).alias("tokens"))).alias("attachments"))
    return t.select(*keys, F.concat("_head", "_body", F.lit(END + "\n")).alias("chunk"),
                    F.length("_head").alias("loss_start"),
                    (F.length("_head") + F.when(F.col("_role").isin(*loss_roles), F.length("_body")).otherwise(0)).alias("loss_end"),
                    "attachments")


def read_turns(chunks: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The way back: role and text of each chunk, and the text under its loss
    mask, unescaped. Placeholders stay as they are."""
    keys = keys or ["conv_id", "turn"]
    at = F.instr("chunk", "\n")
    body = F.substr(F.col("chunk"), at + 1, F.length("chunk") - at - len(END) - 1)
    under = F.substr(F.col("chunk"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    return chunks.select(*keys, F.url_decode(F.substr(F.col("chunk"), F.lit(len(START) + 1), at - len(START) - 1)).alias("role"),
                         unescape(body).alias("text"), unescape(under).alias("loss_text"),
                         F.length("chunk").alias("chunk_chars"))


def _fed(key: str):
    """The digests of sorted (key, role, text, loss_text, chunk_chars), a conversation's turns fed one by one."""
    names = [key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, of, kind = False, None, None

        def closed() -> pa.RecordBatch:
            row = (of, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars)
            return pa.RecordBatch.from_arrays([pa.array([x], kind if i == 0 else None) for i, x in enumerate(row)], names=names)

        for batch in batches:
            kind = batch.schema.field(key).type
            for k, role, text, under, size in zip(*(batch[c].to_pylist() for c in (key, "role", "text", "loss_text", "chunk_chars")), strict=True):
                if not begun or k != of:
                    if begun:
                        yield closed()
                    begun, of, n, loss_chars, chars, turns, loss = True, k, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                n, loss_chars, chars = n + 1, loss_chars + len(under), chars + size
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(under.encode())
        if begun:
            yield closed()

    return found


def conversation_digests(read: DataFrame, key: str = "conv_id", order: str = "turn", most: int = MOST) -> DataFrame:
    """Per conversation: turn count and digests of what ``read_turns`` gave."""
    size = F.sum(F.octet_length("role") + F.octet_length("text") + F.octet_length("loss_text") + 2)
    longest = read.groupBy(key).agg(size.alias("n")).agg(F.max("n")).first()[0] or 0
    if longest > most:
        kind = read.schema[key].dataType.simpleString()
        r = read.select(key, order, "role", "text", "loss_text", "chunk_chars").repartition(key)
        r = r.sortWithinPartitions(key, order, "role", "text", "loss_text").drop(order)
        return r.mapInArrow(_fed(key), f"`{key}` {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    per = read.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "role", "text", F.col("loss_text").alias("l")))).alias("t"),
        F.sum(F.length("loss_text")).cast("bigint").alias("loss_chars"),
        F.sum("chunk_chars").cast("bigint").alias("formatted_chars"))
    turns = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("t", lambda x: x["l"]), "")
    return per.select(key, "n_turns", F.sha2(turns, 256).alias("turns_sha256"), "loss_chars",
                      F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
