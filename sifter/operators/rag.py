"""Retrieval-augmented generation as DataFrame steps.

context  : top-k hits of a question -> one text in rank order (grouped by
           question; the kNN output is already partitioned by question, so
           the group-by reuses that exchange)
prompt   : a template split at its ``{slot}``s when the plan is built, then
           one ``concat`` — text inside a context or question is never
           re-expanded
generate : a pluggable generator over Arrow batches (``mapInPandas``); each
           row is timed and a failing row is kept with its error instead of
           failing the task
history  : the previous turns of a conversation via a window frame
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sifter.functions.text import strip_ws, truncate_words

DEFAULT_TEMPLATE = (
    "Sources, best first:\n\n"
    "{context}\n\n"
    "Reply to the question from these sources alone.\n"
    "Question: {question}\n"
)
_SLOT = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def assemble_context(hits: DataFrame, q_id: str, text_col: str = "chunk_text", rank_col: str = "rank",
                     sep: str = "\n\n", out_col: str = "context", extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """(q_id, *extra_keys, context, sources, n_sources) in one aggregation:
    ``sources`` is the array of source texts in rank order."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), F.col(text_col).alias("t"))))
    return (hits.groupBy(q_id, *extra_keys)
                .agg(ordered.alias("_o"), F.count(F.lit(1)).alias("n_sources"))
                .select(q_id, *extra_keys, "n_sources",
                        F.transform("_o", lambda x: x["t"]).alias("sources"))
                .withColumn(out_col, F.array_join("sources", sep)))


def template_parts(template: str) -> list[tuple[str, str]]:
    """[("lit", text) | ("slot", name)] in order."""
    parts, pos = [], 0
    for m in _SLOT.finditer(template):
        if m.start() > pos:
            parts.append(("lit", template[pos:m.start()]))
        parts.append(("slot", m.group(1)))
        pos = m.end()
    if pos < len(template):
        parts.append(("lit", template[pos:]))
    return parts


def fill_prompt(template: str = DEFAULT_TEMPLATE, **slots: Column) -> Column:
    cols = []
    for kind, v in template_parts(template):
        if kind == "lit":
            cols.append(F.lit(v))
        else:
            if v not in slots:
                raise KeyError(f"template slot {{{v}}} has no column")
            cols.append(F.coalesce(slots[v], F.lit("")))
    return F.concat(*cols)


# ------------------------------------------------------------------ generators

class ContextWindowExceeded(ValueError):
    pass


def _words(s: str | None) -> list[str]:
    return (s or "").split()


def extractive_top1(max_new_tokens: int = 256, max_prompt_tokens: int | None = None):
    """Deterministic stand-in model: answers with the first
    ``max_new_tokens`` words of the best-ranked source."""
    def gen(row: dict) -> str:
        if max_prompt_tokens is not None and len(_words(row.get("prompt"))) > max_prompt_tokens:
            raise ContextWindowExceeded(f"prompt longer than {max_prompt_tokens} tokens")
        sources = row.get("sources")
        first = sources[0] if sources is not None and len(sources) else ""
        return " ".join(_words(first)[:max_new_tokens])
    return gen


def extractive_lead(max_new_tokens: int = 256, max_prompt_tokens: int | None = None):
    """Deterministic stand-in model: the first ``max_new_tokens`` words of
    the whole context."""
    def gen(row: dict) -> str:
        if max_prompt_tokens is not None and len(_words(row.get("prompt"))) > max_prompt_tokens:
            raise ContextWindowExceeded(f"prompt longer than {max_prompt_tokens} tokens")
        return " ".join(_words(row.get("context"))[:max_new_tokens])
    return gen


def extractive_prompt(max_new_tokens: int = 256, max_prompt_tokens: int | None = None):
    """Deterministic stand-in model that sees the prompt alone: its first
    words, as far as the context window goes."""
    def gen(row: dict) -> str:
        return " ".join(_words(row.get("prompt"))[:max_prompt_tokens][:max_new_tokens])
    return gen


# name -> factory(**options) -> row -> answer. Model-backed generators are
# registered the same way; the factory runs once per task. A factory made by
# ``batched`` gives a function of many rows at once.
GENERATORS: dict[str, Callable[..., Callable[[dict], str]]] = {
    "extractive/top1": extractive_top1,
    "extractive/lead": extractive_lead,
    "extractive/prompt": extractive_prompt,
}


def register_generator(name: str, factory: Callable[..., Callable[[dict], str]]) -> None:
    GENERATORS[name] = factory


def batched(factory: Callable[..., Callable[[list[dict]], list[str]]]) -> Callable[..., Callable]:
    """Marks a factory whose generators take a list of rows and give a list of
    answers (a model fed in batches). If a batch fails, its rows are tried one
    by one, so that only those that fail alone are lost."""
    def made(**options):
        gen = factory(**options)

        def many(rows: list[dict]) -> list[str]:
            return gen(rows)
        many.batch = True
        return many
    return made


def _answers(fn: Callable, rows: list[dict]) -> list[tuple[str | None, float, str | None]]:
    """(answer, seconds, error) of each row."""
    def one(row: dict, call: Callable) -> tuple[str | None, float, str | None]:
        t0 = time.perf_counter()
        try:
            return call(row), time.perf_counter() - t0, None
        except Exception as e:  # noqa: BLE001  (a failed answer is a row, not a task failure)
            return None, time.perf_counter() - t0, f"{type(e).__name__}: {e}"

    if not getattr(fn, "batch", False):
        return [one(r, fn) for r in rows]
    t0 = time.perf_counter()
    try:
        got = list(fn(rows))
        if len(got) != len(rows):
            raise ValueError(f"{len(got)} answers to {len(rows)} rows")
    except Exception:  # noqa: BLE001
        return [one(r, lambda x: fn([x])[0]) for r in rows]
    return [(a, (time.perf_counter() - t0) / len(rows), None) for a in got]


def truncated(prompt: Column, max_tokens: int) -> Column:
    """A prompt cut to a model's context window (X5), for generators that should answer rather than fail."""
    return truncate_words(prompt, max_tokens)


def generate(df: DataFrame, generator: str | Callable[[dict], str], out_col: str = "answer",
             options: dict | None = None, llm_col: str | None = None) -> DataFrame:
    """Adds ``out_col`` (stripped answer, null on failure), ``time`` (seconds
    spent on the row) and ``error`` (null on success).

    With ``llm_col`` the generator name is read per row (a grid of models in
    one pass); otherwise ``generator`` is a registry name or a callable.
    """
    opts = dict(options or {})
    fields = list(df.schema.fields) + [T.StructField(out_col, T.StringType(), True),
                                       T.StructField("time", T.DoubleType(), True),
                                       T.StructField("error", T.StringType(), True)]
    schema = T.StructType(fields)
    cols = df.columns

    known = dict(GENERATORS)  # workers know no registry but the one imported

    def run(batches):
        made: dict[str, Callable] = {}
        for pdf in batches:
            names = pdf[llm_col].to_numpy() if llm_col else np.full(len(pdf), "" if callable(generator) else generator, object)
            rows = pdf.to_dict("records")
            got: list = [None] * len(rows)
            for name in dict.fromkeys(names):
                if name not in made:
                    made[name] = generator if callable(generator) else known[name](**opts)
                at = np.flatnonzero(names == name)
                for i, x in zip(at, _answers(made[name], [rows[i] for i in at])):
                    got[i] = x
            out = pdf[cols].copy()
            for j, c in enumerate((out_col, "time", "error")):
                out[c] = pd.Series([x[j] for x in got], index=pdf.index, dtype="float64" if c == "time" else object)
            yield out

    return df.mapInPandas(run, schema).withColumn(out_col, strip_ws(F.col(out_col)))


def split_failures(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, dead-letter rows)."""
    return df.where(F.col(error_col).isNull()), df.where(F.col(error_col).isNotNull())


def answer_questions(questions: DataFrame, hits: DataFrame, q_id: str, generator: str, template: str = DEFAULT_TEMPLATE,
                     options: dict | None = None) -> DataFrame:
    """Questions (q_id, question, ...) answered from their ranked hits; one
    without hits is asked with an empty context."""
    rows = without_context(questions.join(assemble_context(hits, q_id), q_id, "left"))
    return generate(rows.withColumn("prompt", fill_prompt(template, context=F.col("context"), question=F.col("question"))), generator, options=options)


def without_context(rows: DataFrame) -> DataFrame:
    """Questions that found nothing stay, with an empty context."""
    return rows.withColumns({"context": F.coalesce("context", F.lit("")), "n_sources": F.coalesce("n_sources", F.lit(0)),
                             "sources": F.coalesce("sources", F.array().cast("array<string>"))})


# ------------------------------------------------------------------ chat history

def history_window(order_col: str = "turn", key: str = "conv_id", max_turns: int | None = None):
    start = Window.unboundedPreceding if max_turns is None else -max_turns
    return Window.partitionBy(key).orderBy(order_col).rowsBetween(start, -1)


def with_history(df: DataFrame, key: str = "conv_id", order_col: str = "turn",
                 fields: tuple[str, ...] = ("turn", "role", "text"), max_turns: int | None = None,
                 out_col: str = "history") -> DataFrame:
    """Each row gets the ordered array of its previous turns (unbounded by
    default, as a conversation grows; ``max_turns`` bounds it)."""
    w = history_window(order_col, key, max_turns)
    return df.withColumn(out_col, F.collect_list(F.struct(*fields)).over(w))


def history_blocks(df: DataFrame, key: str = "conv_id", order_col: str = "turn", line: Column | None = None, block: int = 256) -> tuple[DataFrame, DataFrame]:
    """History without its square: (blocks, refs).

    blocks: (key, _blk, n, lines): the lines of ``block`` consecutive turn
    numbers, in order. refs: (key, order, _blk, n_prev): a turn refers to all
    blocks before its own and to the lines of its own block that come before
    it. Both are as large as the turns, and a long conversation is spread over
    tasks by its blocks; ``history_texts`` makes texts of the turns asked for."""
    line = line if line is not None else F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")))
    rows = df.select(key, F.col(order_col).alias("_t"), line.alias("_line"), F.floor(F.col(order_col) / F.lit(block)).cast("long").alias("_blk"))
    # turns that share a number follow each other by their lines
    blocks = rows.groupBy(key, "_blk").agg(F.array_sort(F.collect_list(F.struct("_t", "_line"))).alias("lines"))
    blocks = blocks.withColumn("n", F.size("lines").cast("long"))
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)  # a row a block
    placed = blocks.select(key, "_blk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    refs = blocks.select(key, "_blk", F.posexplode("lines").alias("_i", "_x")).join(placed, [key, "_blk"])
    refs = refs.select(key, F.col("_x")["_t"].alias(order_col), "_blk", F.col("_i").cast("long").alias("_i"), (F.col("_first") + F.col("_i")).cast("long").alias("n_prev"))
    return blocks, refs


def history_texts(blocks: DataFrame, asked: DataFrame, key: str = "conv_id", order_col: str = "turn", sep: str = "\n", out_col: str = "history") -> DataFrame:
    """(key, order, n_prev, history) of the refs in ``asked``: a join with the
    blocks up to each turn's own; a block is joined into one text first."""
    text = blocks.select(key, F.col("_blk").alias("_b"), F.transform("lines", lambda x: x["_line"]).alias("_lines"))
    refs = asked.select(key, "_blk", "_i").distinct()
    whole = refs.join(text.select(key, "_b", F.array_join("_lines", sep).alias("_text")), key).where(F.col("_b") < F.col("_blk"))
    own = refs.join(text.withColumnRenamed("_b", "_blk"), [key, "_blk"]).where("_i > 0").select(
        key, "_blk", "_i", F.col("_blk").alias("_b"), F.array_join(F.slice("_lines", F.lit(1), F.col("_i").cast("int")), sep).alias("_text"))
    parts = whole.select(own.columns).unionByName(own)
    joined = parts.groupBy(key, "_blk", "_i").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_b", "_text"))), lambda x: x["_text"]), sep).alias(out_col))
    return asked.join(joined, [key, "_blk", "_i"], "left").select(key, order_col, "n_prev", F.coalesce(out_col, F.lit("")).alias(out_col))


def qa_pairs(conversations: DataFrame, key: str = "conv_id", order_col: str = "turn") -> DataFrame:
    """(conv_id, turn, question, reference): a user turn and the assistant
    turn that follows it."""
    w = Window.partitionBy(key).orderBy(order_col)
    nxt = conversations.select(key, order_col, "role", "text",
                               F.lead("role").over(w).alias("_nrole"), F.lead("text").over(w).alias("_ntext"))
    return (nxt.where((F.col("role") == "user") & (F.col("_nrole") == "assistant"))
               .select(key, order_col, F.col("text").alias("question"), F.col("_ntext").alias("reference")))


def history_sizes(df: DataFrame, key: str = "conv_id", order_col: str = "turn", text_col: str = "text",
                  role_col: str = "role", block: int = 4096) -> DataFrame:
    """(key, order, n_prev, prev_chars, prev_role): size of what each turn
    sees of the turns before it, without placing a whole conversation in
    one task. Turns are cut into blocks of ``block`` consecutive turn
    numbers; block totals (one row per block) are prefix-summed per
    conversation, and each block adds its own running sums. A conversation
    holding a third of all turns is spread over many blocks."""
    rows = df.select(key, order_col, role_col, F.length(text_col).cast("long").alias("_len"),
                     F.floor(F.col(order_col) / F.lit(block)).cast("long").alias("_blk"))
    blocks = rows.groupBy(key, "_blk").agg(
        F.count(F.lit(1)).alias("_bn"), F.sum("_len").alias("_bl"),
        F.max_by(role_col, order_col).alias("_brole"))
    wb = Window.partitionBy(key).orderBy("_blk")
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(key, "_blk",
                           F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_pn"),
                           F.coalesce(F.sum("_bl").over(before), F.lit(0)).alias("_pl"),
                           F.lag("_brole").over(wb).alias("_prole"))
    wl = Window.partitionBy(key, "_blk").orderBy(order_col)
    local = rows.select(key, order_col, "_blk",
                        F.count(F.lit(1)).over(wl.rowsBetween(Window.unboundedPreceding, -1)).alias("_ln"),
                        F.coalesce(F.sum("_len").over(wl.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_ll"),
                        F.lag(role_col).over(wl).alias("_lrole"))
    return (local.join(blocks, [key, "_blk"])
                 .select(key, order_col,
                         (F.col("_pn") + F.col("_ln")).cast("long").alias("n_prev"),
                         (F.col("_pl") + F.col("_ll")).cast("long").alias("prev_chars"),
                         F.coalesce("_lrole", "_prole").alias("prev_role")))
