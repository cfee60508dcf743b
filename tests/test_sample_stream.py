import datetime
import hashlib
import json
import tempfile

from pyspark.sql import functions as F

from sifter.functions.agents import attributes, weight
from sifter.operators.sample import weighted_choice
from sifter.operators.rag import GENERATORS, register_generator
from sifter.streaming.chat import chat_history_stream
from sifter.streaming.jobs import file_stream, run_available

UAS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Safari/605.1.15",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.91",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Linux; Android 10; K) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:120.0) Gecko/20100101 Firefox/120.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 OPR/105.0.0.0",
    "curl/8.4.0",
]


def test_user_agent_attributes_and_weights(spark):
    df = spark.createDataFrame([(u,) for u in UAS], "ua string").select(attributes("ua").alias("a")).select("a.*")
    rows = df.collect()
    assert [(r.browser, r.browser_version, r.os) for r in rows[:6]] == [
        ("Chrome", 120, "Windows"), ("Firefox", 121, "Windows"), ("Safari", 17, "Mac OS X"),
        ("Edge", 120, "Windows"), ("Chrome", 119, "Linux"), ("Chrome Mobile", 120, "Android")]
    assert rows[9].browser == "Other" and rows[9].browser_version is None
    w = df.select(weight("browser", "browser_version", "os", F.lit(0.0)).alias("w"),
                  weight("browser", "browser_version", "os", F.lit(0.0), strict=True).alias("s")).collect()
    assert w[0].w == 1000 + 100 + 50 + 1200 + 150 - 50  # as written: +50 and -50 always apply
    assert w[0].s == 1000 + 100 + 1200 + 150


def test_weighted_choice_frequencies(spark):
    items = spark.createDataFrame([(g, i, float(i)) for g in range(4000) for i in (1, 2, 3, 4)] + [(0, 9, 0.0), (0, 8, None)], "g long, item long, w double")
    draws = weighted_choice(items, "w", ["item"], ["g"], draws=2, seed=5)
    freq = {r.item: r["count"] / 8000 for r in draws.groupBy("item").count().collect()}
    for i in (1, 2, 3, 4):
        assert abs(freq[i] - i / 10) < 0.025
    again = weighted_choice(items.repartition(5), "w", ["item"], ["g"], draws=2, seed=5)
    assert sorted(draws.collect()) == sorted(again.collect())
    many = weighted_choice(items.where("g = 1"), "w", ["item"], draws=70)
    assert sorted(r.draw for r in many.collect()) == list(range(70))


def test_chat_stream_restart_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="sifter-stream-")
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", "x" * (t + 1)) for c in (1, 2) for t in range(6)]
    schema = "conv_id long, turn long, role string, text string"
    # later turns arrive first; the stream is stopped and restarted in between
    spark.createDataFrame([r for r in turns if r[1] >= 3], schema).write.parquet(root + "/in/a")
    src = file_stream(spark, root + "/in/*", schema)
    run_available(chat_history_stream(src), root + "/ck", root + "/out")
    assert spark.read.parquet(root + "/out").count() == 0  # nothing released: turn 0 missing
    spark.createDataFrame([r for r in turns if r[1] < 3], schema).write.parquet(root + "/in/b")
    run_available(chat_history_stream(file_stream(spark, root + "/in/*", schema)), root + "/ck", root + "/out")
    got = {(r.conv_id, r.turn): (r.n_prev, r.history, r.late) for r in spark.read.parquet(root + "/out").collect()}
    line = lambda t: f"{'user' if t % 2 == 0 else 'assistant'}: {'x' * (t + 1)}"
    assert got == {(c, t): (t, "\n".join(line(i) for i in range(t)), False) for c in (1, 2) for t in range(6)}


def test_chat_stream_gaps_nulls_and_stops(spark):
    root = tempfile.mkdtemp(prefix="sifter-stream-")
    rows = [(1, 0, "user", "exit"), (1, 1, "user", " Exit"), (1, 2, "assistant", "exit"), (1, 3, "user", None), (2, 5, "user", "a"), (2, 7, "user", "b"), (None, 0, "user", "x")]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(root + "/in/a")
    run_available(chat_history_stream(file_stream(spark, root + "/in/*", schema), max_pending=1), root + "/ck", root + "/out")
    got = {(r.conv_id, r.turn): (r.history, r.late) for r in spark.read.parquet(root + "/out").collect()}
    assert got == {(1, 1): ("", False), (1, 2): ("user:  Exit", False), (1, 3): ("user:  Exit\nassistant: exit", False), (2, 5): ("", True)}


def test_chat_stream_long_conversation_waits(spark):
    """3,000 turns scattered over four micro-batches: far more wait than come in order."""
    root, n = tempfile.mkdtemp(prefix="sifter-stream-"), 3000
    schema = "conv_id long, turn long, role string, text string"
    rows = spark.createDataFrame([(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(n)], schema)
    rows.repartition(4, F.xxhash64("conv_id", "turn")).write.parquet(root + "/in")
    run_available(chat_history_stream(file_stream(spark, root + "/in", schema)), root + "/ck", root + "/out")
    got = spark.read.parquet(root + "/out").select("turn", "n_prev", F.md5("history").alias("h"), "late").collect()
    line = [f"{'user' if t % 2 == 0 else 'assistant'}: t{t}" for t in range(n)]
    assert {(r.turn, r.n_prev, r.h, r.late) for r in got} == {
        (t, t, hashlib.md5("\n".join(line[:t]).encode()).hexdigest(), False) for t in range(n)} and len(got) == n


def test_chat_state_written_does_not_grow_with_the_history(spark):
    """3,000 turns in ten batches, in order: the bytes written to the state stay
    about the same from batch to batch, and later turns see earlier answers."""
    register_generator("echo/history", lambda **_: (lambda row: f"{len(row['history'])}:{row['question']}:{row['history'][-1] if row['history'] else ''}"[:60]))
    root, n = tempfile.mkdtemp(prefix="sifter-stream-"), 3000
    schema = "conv_id long, turn long, role string, text string"
    try:
        for b in range(10):
            rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t} " + "x" * 40) for t in range(b * 300, b * 300 + 300)]
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/in/{b}")
        stream = chat_history_stream(file_stream(spark, root + "/in/*", schema), texts=False, generator="echo/history")
        q = (stream.writeStream.option("checkpointLocation", root + "/ck").format("parquet").option("path", root + "/out").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        GENERATORS.pop("echo/history")
    written = [p["stateOperators"][0]["customMetrics"]["rocksdbTotalBytesWritten"] for p in map(lambda p: p if isinstance(p, dict) else json.loads(p.json), q.recentProgress) if p["stateOperators"]]
    written = [w for w in written if w]
    assert len(written) >= 9 and max(written) < 2 * min(written)
    lines, want = [], set()
    for t in range(0, n, 2):
        text = f"t{t} " + "x" * 40
        answer = f"{len(lines)}:{text}:{lines[-1] if lines else ''}"[:60].strip()
        want.add((t, len(lines), hashlib.md5("\n".join(lines).encode()).hexdigest(), answer))
        lines += [f"user: {text}", f"assistant: {answer}"]
    got = spark.read.parquet(root + "/out").select("turn", "n_prev", "history_md5", "answer").collect()
    assert set(map(tuple, got)) == want and len(got) == len(want)


def test_chat_timer_releases_and_failed_answers_are_rows(spark):
    import time

    from sifter.operators.rag import ContextWindowExceeded

    def failing(**_):
        def gen(row):
            if "bad" in row["question"]:
                raise ContextWindowExceeded("too long")
            return " fine "
        return gen
    register_generator("failing", failing)
    root = tempfile.mkdtemp(prefix="sifter-stream-")
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, "user", "good"), (1, 1, "user", "bad"), (1, 2, "user", "good again"), (2, 4, "user", "late one"), (2, 4, "user", "twice")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(root + "/in/a")
    try:
        stream = chat_history_stream(file_stream(spark, root + "/in/*", schema), timeout_ms=500, generator="failing", template="{question}")
        q = stream.writeStream.option("checkpointLocation", root + "/ck").format("parquet").option("path", root + "/out").trigger(processingTime="1 second").start()
        for _ in range(60):
            time.sleep(1)
            if q.recentProgress and spark.read.schema("conv_id long").parquet(root + "/out").count() >= 5:
                break
        q.stop()
    finally:
        GENERATORS.pop("failing")
    got = {(r.conv_id, r.turn, r.text): (r.answer, r.error, r.history, r.late) for r in spark.read.parquet(root + "/out").collect()}
    assert got == {(1, 0, "good"): ("fine", None, "", False), (1, 1, "bad"): (None, "ContextWindowExceeded: too long", "user: good\nassistant: fine", False),
                   (1, 2, "good again"): ("fine", None, "user: good\nassistant: fine\nuser: bad\nassistant: ", False),
                   (2, 4, "late one"): ("fine", None, "", True), (2, 4, "twice"): ("fine", None, "user: late one\nassistant: fine", True)}


def test_link_state_is_bounded_and_result_equals_the_unbounded_one(spark):
    """Eight batches of new and old links, an hour of event time apart: the state holds the last hours' alone."""
    from sifter.streaming.jobs import link_dedup_stream, seen_links, seen_writer
    root = tempfile.mkdtemp(prefix="sifter-links-")
    page = lambda hrefs: "<html><nav>" + "".join(f'<a href="{h}">x</a>' for h in hrefs) + "</nav></html>"
    schema, want = "page_id long, url string, html string, at timestamp", set()
    for b in range(8):
        hrefs = [f"/new/{b}/{i}" for i in range(20)] + ["/always"] + [f"/new/{max(b - 5, 0)}/{i}" for i in range(5)]
        want |= set(hrefs)
        spark.createDataFrame([(b, "u", page(hrefs), datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=b))], schema).coalesce(1).write.parquet(f"{root}/in/{b:02d}")
        stream = link_dedup_stream(file_stream(spark, root + "/in/*", schema), "at", "2 hours")
        q = stream.writeStream.option("checkpointLocation", root + "/ck").foreachBatch(seen_writer(root + "/seen", 4)).trigger(availableNow=True).start()
        q.awaitTermination()
        rows = [p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: p if isinstance(p, dict) else json.loads(p.json), q.recentProgress) if p["stateOperators"]]
        assert max(rows) <= 5 * 26
    got = [r.href for r in seen_links(spark, root + "/seen").collect()]
    assert sorted(got) == sorted(want)
    first = {r.href: r.page_id for r in seen_links(spark, root + "/seen").collect()}
    assert first["/always"] == 0 and first["/new/3/0"] == 3
    again = spark.createDataFrame([("/always", 99), ("/fresh", 99)], "href string, page_id long")
    for _ in range(2):  # a replayed batch writes the same
        seen_writer(root + "/seen", 4)(again, 1000)
    assert sorted(r.href for r in seen_links(spark, root + "/seen").collect()) == sorted(want | {"/fresh"})


def test_chat_without_texts_takes_rows_and_asks_the_store_once_a_turn():
    from pyspark.sql import Row

    from sifter.streaming.chat import Chat

    class Store(dict):
        asked, value, lines = 0, None, ()

        def get(self):
            self.asked += 1
            return self.value if self.value else iter(self.lines) if self.lines else None

        def getValue(self, key):
            self.asked += 1
            return dict.get(self, key)

        def containsKey(self, key):
            self.asked += 1
            return key in self

        def update(self, value):
            self.value = value

        def exists(self):
            self.asked += 1
            return self.value is not None

        def updateValue(self, key, value):
            self[key] = value

        def removeKey(self, key):
            del self[key]

    class Lines(list):
        def get(self):
            return iter(self)

        def appendList(self, new):
            self.extend(new)

    chat = Chat(0, None, None, None, None, False, None, {}, None)
    chat.at, chat.pending, chat.lines, chat.answer = Store(), Store(), Lines(), None

    def given(*turns):
        return list(chat.handleInputRows((7,), iter([Row(conv_id=7, turn=t, role="user", text=f"t{t}") for t in turns]), None))

    assert given(2, 1) == [] and sorted(chat.pending) == [(1, 0), (2, 0)]
    chat.at.asked = chat.pending.asked = 0
    out = given(0)
    assert all(isinstance(r, Row) for r in out) and [(r.conv_id, r.turn, r.n_prev, r.history) for r in out] == [(7, 0, 0, None), (7, 1, 1, None), (7, 2, 2, None)]
    # each of the turns 0 to 3, and once more behind each of the two that waited
    assert not chat.pending and chat.at.asked == 1 and chat.pending.asked <= 6
