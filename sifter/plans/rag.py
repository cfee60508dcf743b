"""Registered RAG, evaluation and experiment-analytics queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sifter.functions.embedding import packed_counts
from sifter.functions.text import clean_text, words
from sifter.functions.vectors import cosine_distance, round_distance
from sifter.operators.embed import embed
from sifter.operators.evaluate import (config_report, exclude_label, mean_by_config, relabel_all_strings)
from sifter.operators.folded import knn_widths
from sifter.operators.knn import knn
from sifter.operators.rag import (DEFAULT_TEMPLATE, answer_questions, assemble_context, fill_prompt, generate,
                                  history_blocks, history_texts, qa_pairs, split_failures, without_context)
from sifter.plans.common import CHUNK_KEY, dense_recursive_chunks, questions, recursive_chunks, table
from sifter.session import checkpoint_dir, scratch_path

# Grid of the benchmark: retrieval depth x generator x encoder.
GRID_K = (2, 3, 4)
GRID_LLM = ("extractive/top1", "extractive/lead")
GRID_ENCODERS = ("hash64", "hash128", "hash256")
# Relabel rules of the analysis (pattern -> short name), in order.
RELABEL_RULES = (
    ("extractive/top1", "top1"),
    ("extractive/lead", "lead"),
    ("hash64", "tf64"),
    ("hash128", "tf128"),
    ("hash256", "tf256"),
)


def retrieve(chunks: DataFrame, qs: DataFrame, k: int, q_id: str = "item_id",
             encoder: str = "hash64", c_id=CHUNK_KEY) -> DataFrame:
    """Top-k chunks with their text for each question of ``qs``
    (q_id, question) — both sides embedded with ``encoder``."""
    ch = embed(chunks, "chunk_text", encoder)
    qv = embed(qs, "question", encoder)
    return knn(qv, ch, k, q_id=q_id, c_id=c_id, carry=["doc_id", "chunk_text"])


def answered(spark: SparkSession, sf_dir: str, k: int = 2, generator: str = "extractive/lead",
             options: dict | None = None) -> DataFrame:
    """Benchmark questions -> top-k -> context -> prompt -> answer."""
    qs = questions(spark, sf_dir).select("item_id", "question")
    return answered_from(retrieve(recursive_chunks(spark, sf_dir), qs, k), qs, generator, options)


def answered_from(hits: DataFrame, qs: DataFrame, generator: str, options: dict | None = None) -> DataFrame:
    """Questions answered from their hits; one without hits has no context."""
    return answer_questions(qs, hits, "item_id", generator, options=options)


def q_context_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-2 chunk texts per question joined in rank order."""
    qs = questions(spark, sf_dir).select("item_id", "question")
    hits = retrieve(recursive_chunks(spark, sf_dir), qs, 2)
    return assemble_context(hits, "item_id").select("item_id", "context", "n_sources")


def q_prompt_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: the prompt template filled with context and question."""
    qs = questions(spark, sf_dir).select("item_id", "question")
    hits = retrieve(recursive_chunks(spark, sf_dir), qs, 2)
    ctx = assemble_context(hits, "item_id")
    return qs.join(ctx, "item_id").select(
        "item_id", fill_prompt(DEFAULT_TEMPLATE, context=F.col("context"), question=F.col("question")).alias("prompt"))


def q_generate_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 + R4: answers of the extractive top-1 generator (256-token budget)."""
    return answered(spark, sf_dir, 2, "extractive/top1").select("item_id", "answer")


def q_rag_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 + V10: stateless question answering over the corpus."""
    a = answered(spark, sf_dir, 2, "extractive/lead")
    return a.select("item_id", F.size(words(F.col("prompt"))).cast("long").alias("prompt_tokens"), "answer")


def q_rag_with_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answer plus the source chunks it was given (k = 3)."""
    qs = questions(spark, sf_dir).select("item_id", "question")
    checkpoint_dir(spark)
    hits = retrieve(dense_recursive_chunks(spark, sf_dir), qs, 3, c_id="chunk_id").checkpoint()  # the answers' sources, found once
    ans = answered_from(hits, qs, "extractive/top1").select("item_id", "answer")
    return hits.join(ans, "item_id").select("item_id", F.col("rank").alias("source_rank"), "chunk_id", "doc_id", "answer")


def q_split_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A generator with a 220-token context window fails on longer
    prompts; good rows and dead letters come out side by side."""
    a = answered(spark, sf_dir, 2, "extractive/lead", {"max_prompt_tokens": 220})
    good, dead = split_failures(a)
    return (good.select("item_id", F.lit("ok").alias("status"), F.size(words(F.col("answer"))).cast("long").alias("n"))
            .unionByName(dead.select("item_id", F.lit("failed").alias("status"),
                                     F.size(words(F.col("prompt"))).cast("long").alias("n"))))


def q_chat_history_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 + W4: every turn with the history it sees, oldest first; stop
    commands are left out. Turns refer to blocks of lines, so no conversation
    is one task; the texts are made for all turns here, since all are asked for."""
    checkpoint_dir(spark)
    blocks, refs = history_blocks(spoken(spark, sf_dir))
    h = history_texts(blocks, refs.checkpoint())
    return h.select("conv_id", "turn", "n_prev", F.md5("history").alias("history_md5"))


def q_chat_history_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much every turn sees of the turns before it (count, chars,
    last role), in turn blocks, so that no conversation is one task."""
    from sifter.operators.rag import history_sizes
    return history_sizes(table(spark, sf_dir, "conversations"))


def with_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations in which some user turns are stop commands, and some
    only look like one (they are answered)."""
    c = table(spark, sf_dir, "conversations")
    n = F.col("conv_id") + F.col("turn")
    text = (F.when((F.col("role") == "user") & (n % 7 == 3), "exit").when((F.col("role") == "user") & (n % 7 == 5), " Quit")
             .otherwise(F.col("text")))
    return c.withColumn("text", text)


def spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns without the stop commands."""
    from sifter.functions.text import is_stop_command
    stop = (F.col("role") == "user") & is_stop_command("text")
    return with_stops(spark, sf_dir).where(~F.coalesce(stop, F.lit(False)))


def qa_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """QA set from conversations: (qid, conv_id, turn, question, reference)."""
    qa = qa_pairs(table(spark, sf_dir, "conversations"))
    return qa.select(F.format_string("%d:%d", "conv_id", "turn").alias("qid"), "conv_id", "turn",
                     clean_text("question").alias("question"), "reference")


def score(answer: DataFrame, encoder: str, a_col: str = "answer", r_col: str = "reference") -> DataFrame:
    """V9: cosine distance between the encoded answer and reference. Hashed
    encoders score in one pass; other encoders embed both columns."""
    if encoder.startswith("hash"):
        from sifter.functions.embedding import hashed_cosine_distance
        return answer.withColumn("score", hashed_cosine_distance(clean_text(a_col), clean_text(r_col),
                                                                 int(encoder[4:])))
    e = embed(embed(answer.withColumn("_a", clean_text(a_col)).withColumn("_r", clean_text(r_col)),
                    "_a", encoder, "_av"), "_r", encoder, "_rv")
    return e.withColumn("score", round_distance(cosine_distance("_av", "_rv"))).drop("_a", "_r", "_av", "_rv")


def q_score_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9 on the QA set itself: distance of each user turn to the reply."""
    qa = qa_questions(spark, sf_dir)
    return score(qa, "hash64", "question", "reference").select("conv_id", "turn", "score")


def evaluated(spark: SparkSession, sf_dir: str, chunks: DataFrame, encoder: str, ks=(2,),
              llms=("extractive/lead",), qa: DataFrame | None = None, options: dict | None = None) -> DataFrame:
    """QA questions answered for every (k, llm) with one ranking to max(k)."""
    qa = qa if qa is not None else qa_questions(spark, sf_dir)
    hits = retrieve(chunks, qa.select("qid", "question"), max(ks), q_id="qid", encoder=encoder)
    return answered_grid(qa, hits, encoder, ks, llms, options)


def answered_grid(qa: DataFrame, hits: DataFrame, encoder: str, ks, llms, options: dict | None) -> DataFrame:
    """The QA set answered from ranked hits for every (k, llm), and scored;
    an answer that several cells give is scored once."""
    kk = F.explode(F.array(*[F.lit(k).cast("long") for k in ks])).alias("k")
    hk = hits.select("*", kk).where(F.col("rank") <= F.col("k"))
    ctx = assemble_context(hk, "qid", extra_keys=("k",))
    ll = F.explode(F.array(*[F.lit(x) for x in llms])).alias("llm")
    cells = qa.select("*", F.explode(F.array(*[F.lit(k).cast("long") for k in ks])).alias("k"))
    rows = (without_context(cells.join(ctx, ["qid", "k"], "left")).select("*", ll)
              .withColumn("prompt", fill_prompt(DEFAULT_TEMPLATE, context=F.col("context"),
                                                question=F.col("question"))))
    gen = generate(rows, "", llm_col="llm", options=options).drop("context", "sources", "n_sources", "prompt")
    if len(ks) * len(llms) == 1:
        return score(gen, encoder).withColumn("transformer", F.lit(encoder))
    same = gen.groupBy("qid", "answer").agg(F.any_value("reference").alias("reference"), F.any_value("question").alias("question"),
                                            F.any_value("conv_id").alias("conv_id"), F.any_value("turn").alias("turn"),
                                            F.collect_list(F.struct("k", "llm", "time", "error")).alias("_cells"))  # a row a cell
    return score(same, encoder).withColumn("transformer", F.lit(encoder)).select("*", F.inline("_cells")).drop("_cells")


def q_evaluate_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + J2: answer the QA set (k = 2) and score against the reference."""
    ev = evaluated(spark, sf_dir, recursive_chunks(spark, sf_dir), "hash64")
    return ev.select("conv_id", "turn", "answer", "score")


def grid(spark: SparkSession, sf_dir: str, options: dict | None = None) -> DataFrame:
    """E2 + E3 + J3: every (k, llm, encoder) cell over the whole QA set.
    Chunks are cut once, and one pass over their tokens makes the counts that
    the vectors of all encoders are made of; one search ranks keys alone to the
    largest k for every encoder, and the texts of what was found are joined to them."""
    checkpoint_dir(spark)
    chunks = recursive_chunks(spark, sf_dir).select("doc_id", "chunk_pos", "chunk_text")
    qa = qa_questions(spark, sf_dir).checkpoint(eager=True)
    widths = tuple(int(e[4:]) for e in GRID_ENCODERS)
    # written once, in the shared folder: the search reads the counts, the join the texts
    at = scratch_path(spark, "grid-chunks")
    chunks.withColumn("counts", packed_counts("chunk_text", widths[-1])).write.parquet(at)
    chunks = spark.read.parquet(at)
    asked = qa.select("qid", packed_counts("question", widths[-1]).alias("counts"))
    found = knn_widths(asked, chunks, max(GRID_K), widths, q_id="qid", c_id=CHUNK_KEY).withColumn("encoder", F.format_string("hash%d", "width")).drop("width")
    hits = found.join(chunks.select(*CHUNK_KEY, "chunk_text"), list(CHUNK_KEY)).checkpoint(eager=True)
    g = reduce(DataFrame.unionByName, [answered_grid(qa, hits.where(F.col("encoder") == e).drop("encoder"), e, GRID_K, GRID_LLM, options) for e in GRID_ENCODERS])
    return g.select("qid", "conv_id", "turn", "question", F.col("reference").alias("ref"),
                    F.col("answer").alias("response"), "score", "time", "error", "llm", "transformer", "k")


def q_benchmark_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir).select("conv_id", "turn", "llm", "transformer", "k", "response", "score")


def q_benchmark_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: attempts, successes and failures per cell; prompts of more than
    220 words are beyond the generators' window and fail."""
    g = grid(spark, sf_dir, {"max_prompt_tokens": 220})
    return g.groupBy("llm", "transformer", "k").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("error").isNull()).alias("ok"),
        F.count_if(F.col("error").isNotNull()).alias("failed"))


def q_mean_score_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 + A1 + O2: mean score per (llm, transformer, k)."""
    return mean_by_config(grid(spark, sf_dir), "score", "mean_score")


def q_mean_time_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean seconds per answer per (llm, transformer, k); times differ
    from run to run, so the query tells that every cell was timed."""
    g = grid(spark, sf_dir)
    counts = g.groupBy("llm", "transformer", "k").agg(F.count("time").alias("answers"), F.avg("time").alias("mean_time"))
    return counts.select("llm", "transformer", "k", "answers", (F.col("mean_time") >= 0).alias("timed"))


def q_sorted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the means in ascending order of mean score."""
    return mean_by_config(grid(spark, sf_dir), "score", "mean_score").orderBy("mean_score", "llm", "transformer", "k")


def q_relabel_all_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: relabel rules applied to every string column."""
    g = relabel_all_strings(grid(spark, sf_dir).drop("error"), RELABEL_RULES)
    return g.select("qid", "llm", "transformer", "k", "score")


def q_exclude_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop one relabelled model; rows with a missing label stay."""
    g = relabel_all_strings(grid(spark, sf_dir).drop("error"), RELABEL_RULES)
    return exclude_label(g, "llm", "lead").select("qid", "llm", "transformer", "k", "score")


def q_config_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 + A2: one report line per cell."""
    g = relabel_all_strings(grid(spark, sf_dir).drop("error"), RELABEL_RULES)
    return config_report(mean_by_config(g, "score", "mean_score"), "mean_score", "average score")


def q_limit_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3 + O4: the first 100 questions in id order (the benchmark's data
    limit is the feature here)."""
    b = table(spark, sf_dir, "benchmark")
    return b.orderBy("item_id").limit(100).select("item_id", clean_text("text").alias("question"))


def q_preview_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document, as a look at what was loaded (one row is the feature)."""
    return table(spark, sf_dir, "documents").orderBy("doc_id").limit(1).select("doc_id", "source", "text")


def q_truncated_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X5 + R3: prompts cut to a window of 220 words, and the answer of a
    generator that reads nothing but the prompt."""
    from sifter.operators.rag import truncated
    qs = questions(spark, sf_dir).select("item_id", "question")
    hits = retrieve(recursive_chunks(spark, sf_dir), qs, 2)
    a = answer_questions(qs, hits, "item_id", "extractive/prompt", options={"max_prompt_tokens": 220, "max_new_tokens": 64})
    return a.select("item_id", F.md5(truncated(F.col("prompt"), 220)).alias("prompt_md5"), "answer")


QUERIES = {
    "truncated_prompts": q_truncated_prompts,
    "context_assembly": q_context_assembly,
    "prompt_fill": q_prompt_fill,
    "generate_answers": q_generate_answers,
    "rag_batch": q_rag_batch,
    "rag_with_sources": q_rag_with_sources,
    "split_failures": q_split_failures,
    "chat_history_sizes": q_chat_history_sizes,
    "chat_history_window": q_chat_history_window,
    "score_answers": q_score_answers,
    "evaluate_qa": q_evaluate_qa,
    "benchmark_grid": q_benchmark_grid,
    "benchmark_counts": q_benchmark_counts,
    "mean_score_by_config": q_mean_score_by_config,
    "mean_time_by_config": q_mean_time_by_config,
    "sorted_means": q_sorted_means,
    "relabel_all_strings": q_relabel_all_strings,
    "exclude_label": q_exclude_label,
    "config_report": q_config_report,
    "limit_questions": q_limit_questions,
    "preview_document": q_preview_document,
}
