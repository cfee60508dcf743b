from pyspark.sql import functions as F

from sifter.operators.evaluate import config_report, exclude_label, mean_by_config, relabel_all_strings
from sifter.operators.rag import assemble_context, fill_prompt, generate, qa_pairs, split_failures, with_history


def test_prompt_slots_not_expanded_inside_values(spark):
    df = spark.createDataFrame([("ctx {question}", "why {context}?")], "c string, q string")
    p = df.select(fill_prompt("C={context}|Q={question}", context=F.col("c"), question=F.col("q")).alias("p")).first().p
    assert p == "C=ctx {question}|Q=why {context}?"


def test_context_in_rank_order(spark):
    hits = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "z")], "qid long, rank long, chunk_text string")
    got = {r.qid: r.context for r in assemble_context(hits, "qid").collect()}
    assert got == {1: "a\n\nb", 2: "z"}


def test_generator_failures_split_and_timed(spark):
    df = spark.createDataFrame([(1, "short prompt", "ctx one two"), (2, "w " * 50, "ctx")],
                               "id long, prompt string, context string")
    out = generate(df, "extractive/lead", options={"max_prompt_tokens": 10, "max_new_tokens": 2})
    good, dead = split_failures(out)
    assert [(r.id, r.answer) for r in good.collect()] == [(1, "ctx one")]
    d = dead.collect()
    assert [r.id for r in d] == [2] and "ContextWindowExceeded" in d[0].error
    assert all(r.time >= 0 for r in out.collect())


def test_history_and_qa_pairs(spark):
    conv = spark.createDataFrame([(1, 0, "user", "q0"), (1, 1, "assistant", "a0"), (1, 2, "user", "q1"),
                                  (1, 3, "user", "q2"), (1, 4, "assistant", "a2")], "conv_id long, turn long, role string, text string")
    h = {r.turn: [x.text for x in r.history] for r in with_history(conv).collect()}
    assert h[0] == [] and h[3] == ["q0", "a0", "q1"]
    assert [(r.turn, r.reference) for r in qa_pairs(conv).orderBy("turn").collect()] == [(0, "a0"), (3, "a2")]


def test_analytics(spark):
    df = spark.createDataFrame([("org/m1", "enc/x", 2, 1.0, "q org/m1"), ("org/m1", "enc/x", 2, 3.0, "q"),
                                (None, "enc/x", 2, 5.0, "q"), ("org/m2", "enc/x", 2, None, "q")],
                               "llm string, transformer string, k long, score double, question string")
    r = relabel_all_strings(df, [("org/m1", "m1"), ("enc/", "")])
    assert r.where(F.col("score") == 1.0).first().question == "q m1"  # substrings of any text column too
    kept = exclude_label(r, "llm", "m1")
    assert sorted((x.llm or "") for x in kept.collect()) == ["", "org/m2"]  # null label kept
    means = {(x.llm): x.mean_score for x in mean_by_config(r, "score", "mean_score").collect()}
    assert means == {"m1": 2.0, "org/m2": None}  # null key dropped, null score skipped
    line = config_report(mean_by_config(r, "score", "mean_score").where(F.col("llm") == "m1"), "mean_score", "average score").first().report
    assert line == "average score of m1 with x at k=2: 2.000000"


def test_history_sizes_blocks_equal_single_window(spark):
    from sifter.operators.rag import history_sizes
    rows = [(c, t, "user" if t % 3 else "assistant", "x" * (t % 7)) for c in (1, 2) for t in range(0, 40, 1 + c)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {}
    for c in (1, 2):
        seen = [r for r in rows if r[0] == c]
        for i, r in enumerate(seen):
            want[(c, r[1])] = (i, sum(len(x[3]) for x in seen[:i]), seen[i - 1][2] if i else None)
    for block in (1, 3, 4096):  # one turn per block, a few, everything in one block
        got = {(r.conv_id, r.turn): (r.n_prev, r.prev_chars, r.prev_role)
               for r in history_sizes(conv, block=block).collect()}
        assert got == want, block


def test_batched_generator_gets_batches_and_isolates_failures(spark):
    from sifter.operators.rag import batched, generate

    def factory(prefix=""):
        sizes = []

        def gen(rows):
            sizes.append(len(rows))
            if any(r["q"] == "bad" for r in rows):
                raise ValueError("no answer")
            return [f"{prefix}{r['q']}:{len(rows)}:{max(sizes)}" for r in rows]
        return gen
    df = spark.createDataFrame([(i, "ask") for i in range(50)], "i long, q string").coalesce(1)
    got = generate(df, batched(factory)(prefix="> "))
    assert {r.answer for r in got.collect()} == {"> ask:50:50"} and got.where("error is not null or time is null").count() == 0
    mixed = generate(spark.createDataFrame([(1, "a"), (2, "bad"), (3, "c")], "i long, q string").coalesce(1), batched(factory)())
    rows = {r.i: (r.answer, r.error) for r in mixed.collect()}
    assert rows == {1: ("a:1:3", None), 2: (None, "ValueError: no answer"), 3: ("c:1:3", None)}


def test_history_blocks_are_linear_and_spread(spark):
    """One conversation of 2,000 turns and some short ones: blocks and refs hold
    each line once; the texts of the turns asked for equal a plain join."""
    from sifter.operators.rag import history_blocks, history_texts
    turns = [(1, t, "user", f"line {t}") for t in range(2000)] + [(c, t, None, None if t == 1 else f"{c}-{t}") for c in (2, 3) for t in (0, 1, 5, 300)] + [(2, 5, None, "again")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    blocks, refs = history_blocks(df, block=64)
    assert refs.count() == len(turns) and sum(len(r.lines) for r in blocks.collect()) == len(turns)
    assert blocks.where("conv_id = 1").count() == 32 and blocks.agg(F.max("n")).first()[0] == 64
    line = lambda r: f"{r[2] or ''}: {r[3] or ''}"
    for row in history_texts(blocks, refs.where("turn in (0, 5, 63, 64, 65, 300, 1999)")).collect():
        same = sorted(((r[1], line(r)) for r in turns if r[0] == row.conv_id))
        assert row.history == "\n".join(x for _, x in same[:row.n_prev]) and same[row.n_prev][0] == row.turn


def test_model_encoder_loads_once_a_worker_and_keeps_nulls(spark):
    from sifter.operators.embed import embed, model_encoder

    def load():
        calls = []

        def encode(texts):
            calls.append(len(texts))
            return [[float(len(t)), float(len(calls))] for t in texts]
        return encode
    df = spark.createDataFrame([(i, None if i % 5 == 0 else "x" * i) for i in range(40)], "i long, t string").coalesce(1)
    got = {r.i: r.embedding for r in embed(df, "t", model_encoder(load)).collect()}
    assert all(got[i] is None if i % 5 == 0 else list(got[i]) == [float(i), 1.0] for i in got) and len(got) == 40
