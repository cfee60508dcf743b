"""Chat as keyed state, a row a turn.

``transformWithState`` keeps for each conversation: the next turn's number and
how many wait (a value), the turns that arrived before their predecessor (a
map, a row each), and the lines of the history (a list that is appended to).
What a micro-batch writes is what is new in it, however long the history is.

A turn waits for its predecessor. One that never comes holds the rest up until
``timeout_ms`` has passed (a timer) or, if ``max_pending`` is given, more turns
than that wait; then they are released in order, flagged ``late``. With neither
they wait on. A conversation without a turn for ``idle_ms`` is forgotten. Both
times keep the query scheduling batches, so they are off by default (an
``availableNow`` run then ends when the input is consumed).

With a generator the conversation's own answers are its history: each user turn
is answered in its place, from the context found for it and the history so far,
and the pair (question, answer) is appended; assistant turns of the input are
passed over. Without one all turns are history as they come.

Streams without texts hand rows to and fro, those with texts frames, which are
made for each conversation and batch anew but end at BLOCK_CHARS.

The state store has to keep a row a key: RocksDB, with change logs, is set for
the session when a chat stream is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sifter.functions.text import STOP_COMMANDS, clean_text

OUT = ("conv_id bigint, turn bigint, role string, text string, n_prev bigint, history string, history_md5 string, "
       "answer string, error string, late boolean")
COLUMNS = [c.split()[0] for c in OUT.split(", ")]
#: Turns with what was found for them: the input of a stream that answers.
ASKED = "conv_id bigint, turn bigint, role string, text string, context string, sources array<string>"
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
#: Characters of history handed on at once.
BLOCK_CHARS = 8 << 20


def history_line(role: str | None, text: str | None) -> str:
    """One turn as history shows it."""
    return f"{role or ''}: {text or ''}"


class Chat(StatefulProcessor):
    def __init__(self, first_turn: int, timeout_ms: int | None, idle_ms: int | None, max_turns: int | None, max_pending: int | None,
                 texts: bool, factory, options: dict, template: str | None):
        self.first_turn, self.timeout_ms, self.idle_ms, self.max_turns, self.max_pending = first_turn, timeout_ms, idle_ms, max_turns, max_pending
        self.frames = texts  # rows cost a conversation far less than frames, but frames end at BLOCK_CHARS
        self.texts, self.factory, self.options, self.template = texts, factory, options, template  # the factory travels: workers know no registry but the one imported

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.at = handle.getValueState("at", "next bigint, waiting bigint, touched bigint")
        self.pending = handle.getMapState("pending", "turn bigint, copy bigint", "role string, text string, context string, sources array<string>")
        self.lines = handle.getListState("lines", "line string")
        self.answer = self.factory(**self.options) if self.factory else None

    def close(self) -> None:
        pass

    def _read(self, rows: Iterator) -> Iterator[tuple]:
        """(turn, role, text, context, sources) of frames or rows."""
        for x in rows:
            if self.frames:
                extra = [x[c] if c in x else [None] * len(x) for c in ("context", "sources")]
                yield from zip(x["turn"], x["role"], x["text"], *extra, strict=True)
            else:
                found = x.asDict()
                yield tuple(found.get(c) for c in ("turn", "role", "text", "context", "sources"))

    def _made(self, out: list[tuple]) -> Iterator:
        if self.frames:
            yield pd.DataFrame(out, columns=COLUMNS)
        else:
            yield from (Row(*COLUMNS)(*x) for x in out)

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        nxt, waiting = self._place()
        new: dict[int, list] = {}
        for turn, *what in self._read(rows):
            what[3] = [str(x) for x in what[3]] if what[3] is not None else None
            new.setdefault(int(turn), []).append(tuple(what))
        released = []
        while True:
            early = sorted(t for t in new if t < nxt)  # comes again, or after it was given up
            for t in early:
                released += [(t, x, True) for x in new.pop(t)]
            held = self._held(nxt) if waiting else []
            here = held + new.pop(nxt, [])
            if not here:
                break
            waiting -= len(held)
            released += [(nxt, x, i > 0) for i, x in enumerate(here)]
            nxt += 1
        for t, held in new.items():
            waiting += len(held)
            self._hold(t, held)
        if self.max_pending is not None and waiting > self.max_pending:
            nxt, waiting = self._give_up(released, nxt, waiting, self.max_pending)
        yield from self._release(key, released, nxt, waiting, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        nxt, waiting = self._place()
        if waiting and self.timeout_ms is not None:
            released: list = []
            nxt, waiting = self._give_up(released, nxt, waiting, 0)
            yield from self._release(key, released, nxt, waiting, timerValues)
        elif self.idle_ms is not None and self.at.exists() and timerValues.getCurrentProcessingTimeInMs() - self.at.get()[2] >= self.idle_ms:
            for state in (self.at, self.pending, self.lines):
                state.clear()

    def _place(self) -> tuple[int, int]:
        at = self.at.get()
        return tuple(at[:2]) if at is not None else (self.first_turn, 0)

    def _held(self, turn: int) -> list:
        """The waiting rows of a turn, which are taken out."""
        out = []
        while (row := self.pending.getValue((turn, len(out)))) is not None:  # each call goes to the store and back
            out.append(tuple(row))
        for i in range(len(out)):
            self.pending.removeKey((turn, i))
        return out

    def _hold(self, turn: int, rows: list) -> None:
        copy = 0
        for what in rows:
            while self.pending.containsKey((turn, copy)):
                copy += 1
            self.pending.updateValue((turn, copy), what)
            copy += 1

    def _give_up(self, released: list, nxt: int, waiting: int, most: int) -> tuple[int, int]:
        """Releases the first waiting turns until ``most`` wait, and those that follow on."""
        for turn in sorted({k[0] for k in self.pending.keys()}):
            if waiting <= most and turn != nxt:
                break
            here = self._held(turn)
            waiting -= len(here)
            released += [(turn, x, turn != nxt or i > 0) for i, x in enumerate(here)]
            nxt = max(nxt, turn + 1)
        return nxt, waiting

    def _release(self, key, released: list, nxt: int, waiting: int, timers) -> Iterator:
        from sifter.operators.rag import template_parts
        history = [x[0] for x in self.lines.get()] if released else []
        before, out, chars = len(history), [], 0
        digest = hashlib.md5("\n".join(history).encode())
        for turn, (role, text, context, sources), late in released:
            if role == "user" and text in STOP_COMMANDS:  # a stop command is neither answered nor remembered
                continue
            if self.answer and role != "user":
                continue
            answer = error = None
            if self.answer:
                row = {"conv_id": key[0], "turn": turn, "question": text, "context": context or "", "sources": sources or [], "history": history}
                row["prompt"] = "".join(v if kind == "lit" else str(row.get(v) or "") for kind, v in template_parts(self.template or ""))
                try:
                    answer = self.answer(row).strip()
                except Exception as e:  # noqa: BLE001  (a failed answer is a row, not a task failure)
                    error = f"{type(e).__name__}: {e}"
            out.append((key[0], turn, role, text, len(history), "\n".join(history) if self.texts else None, digest.hexdigest(), answer, error, late))
            chars += len(out[-1][5] or "")
            new = [history_line(role, text)] + ([history_line("assistant", answer)] if self.answer else [])
            digest.update("".join(("\n" if history or i else "") + x for i, x in enumerate(new)).encode())
            history += new
            if self.max_turns is not None:
                history = history[-self.max_turns:] if self.max_turns else []
                digest = hashlib.md5("\n".join(history).encode())
            if chars > BLOCK_CHARS:
                yield from self._made(out)
                out, chars = [], 0
        if self.max_turns is not None:  # bounded, and rewritten
            self.lines.put([(x,) for x in history]) if history else self.lines.clear()
        elif len(history) > before:
            self.lines.appendList([(x,) for x in history[before:]])
        now = timers.getCurrentProcessingTimeInMs() if self.timeout_ms is not None or self.idle_ms is not None else 0
        self.at.update((nxt, waiting, now))
        if waiting and self.timeout_ms is not None:
            self.handle.registerTimer(now + self.timeout_ms)
        if self.idle_ms is not None:
            self.handle.registerTimer(now + self.idle_ms)
        if out:
            yield from self._made(out)


def chat_history_stream(turns: DataFrame, first_turn: int = 0, timeout_ms: int | None = None, max_turns: int | None = None,
                        max_pending: int | None = None, idle_ms: int | None = None, texts: bool = True, generator: str | None = None,
                        options: dict | None = None, template: str | None = None) -> DataFrame:
    """turns: streaming (conv_id, turn, role, text), with a generator also
    (context, sources) -> each released turn with the history it sees: how many
    lines (``n_prev``), their digest, and with ``texts`` the lines themselves,
    oldest first (all, or the last ``max_turns``); with a generator its
    ``answer``, or the ``error`` that it ended with."""
    from sifter.operators.rag import GENERATORS
    for k, v in STORE.items():
        turns.sparkSession.conf.set(k, v)
    given = [c for c in ("context", "sources") if c in turns.columns]
    t = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", *given).where("conv_id is not null and turn is not null")
    chat = Chat(first_turn, timeout_ms, idle_ms, max_turns, max_pending, texts, GENERATORS[generator] if generator else None, dict(options or {}), template)
    keyed = t.groupBy("conv_id")
    return (keyed.transformWithStateInPandas if chat.frames else keyed.transformWithState)(chat, OUT, "Append", "None" if timeout_ms is None and idle_ms is None else "ProcessingTime")


def context_writer(corpus: DataFrame, path: str, k: int = 2, encoder: str = "hash64"):
    """Batch writer for ``writeStream.foreachBatch``: all turns of a
    micro-batch with what ``corpus`` (doc_id, chunk_pos, chunk_text, embedding)
    holds on the user turns. A replayed batch overwrites its own folder."""
    from sifter.operators.embed import embed
    from sifter.operators.knn import knn
    from sifter.operators.rag import assemble_context

    def write(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
        asked = rows.where(F.col("role") == "user").select("_row", clean_text("text").alias("question"))
        hits = knn(embed(asked, "question", encoder), corpus, k, q_id="_row", c_id=("doc_id", "chunk_pos"), carry=["chunk_text"])
        found = rows.join(assemble_context(hits, "_row"), "_row", "left")
        found.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text", "context", "sources").write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")

    return write


def asked_stream(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """What ``context_writer`` has written, as a stream."""
    return spark.readStream.schema(ASKED).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{path}/*")
