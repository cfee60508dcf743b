"""Secret scan, fingerprints, language ID, packing, mixing, URL filter and chat formatting on small tables."""

import base64
import bz2
import gzip
import hashlib
import json
import lzma
import random
import re
import struct
import urllib.parse
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sifter.llm import chat_format as chat
from sifter.llm import fingerprint as fp
from sifter.llm import language_id as lid
from sifter.llm import mixing, packing, url_filter
from sifter.llm.secrets import scan_secrets, scan_text

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_findings(t):
    f = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    f += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    f += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(f)


def test_base_findings_stay(spark):
    rng = random.Random(1)
    bits = ["secret=", "Token: ", "api_key='", "AKIA", "deadbeef" * 3, "ABCDEFGHIJKL", "0123456789abcdef", " ", "\n", "ſecret=", "password=token: abcdefghijklmn", "é", "%41", "=="]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(40))), "clash") for i in range(300)] + [(400, None, ""), (401, "", ""), (402, "a" * 300_000, "")]
    got = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, found string")).collect()
    assert len(got) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        assert [(f.start, f.rank, f.end) for f in r.secrets.found if f.base] == base_findings(texts[r.doc_id] or "")
    assert scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


SECRET = 'my password = "hunter2-hunter2"'


@pytest.mark.parametrize("wrap", [
    lambda s: urllib.parse.quote(s, safe=""),
    lambda s: urllib.parse.quote(urllib.parse.quote(s, safe=""), safe=""),
    lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
    lambda s: "".join(f"&#{ord(c)};" for c in s),
    lambda s: base64.b64encode(s.encode()).decode(),
    lambda s: "path/" + base64.urlsafe_b64encode(s.encode()).decode(),
    lambda s: base64.encodebytes((s + "." * 300).encode()).decode(),
    lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
    lambda s: base64.b64encode(bz2.compress(base64.b64encode(zlib.compress(s.encode())))).decode(),
    lambda s: urllib.parse.quote(base64.b64encode(base64.b64encode(s.encode())).decode(), safe=""),
])
def test_layers_are_unwrapped_and_mapped(wrap):
    text = "été " + wrap(SECRET) + " end"
    found = [f for f in scan_text(text)[2] if not f[4] and f[3] == "assign" and f[5].startswith("hunter2")]
    assert found
    for start, end, *_ in found:
        assert 4 <= start < end <= len(text) - 4


def test_spans_map_exactly():
    text = "x pass%77ord=abcdefghijk%6C y"
    (f,) = [f for f in scan_text(text)[2] if not f[4]]
    assert text[f[0]:f[1]] == "pass%77ord=abcdefghijk%6C" and f[5] == "abcdefghijkl"


def test_layer_that_decodes_to_itself_ends():
    assert scan_text("V" * 100_000)[2] == []
    assert scan_text("%25" * 50_000 + "41")[2] == []


def test_fingerprints():
    import pyarrow as pa
    texts = ["", None, "one\ntwo\nthree four five six", "two\n\n three  four five six \none", "two\nthree four five six", "one", "ein langer Absatz " * 5000]
    f = fp.fingerprints(pa.array(texts))
    assert f[0] == f[1] == bytes(len(f[0])) and f[2] == f[3] != f[4]
    assert fp.subtract(f[2], f[5]) == f[4] and fp.add(f[5], f[4]) == f[2]
    near = fp.likeness([f[0], f[2], f[2], f[2], f[0]], [f[1], f[3], f[4], f[6], f[5]])
    assert near[0] == near[1] == 1 and 0 < near[2] < 1 and near[3] < 0.2 and near[4] == 0


def test_compare_with_next_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i * 7 % 301, "".join(rng.choice("ab \né漢") for _ in range(rng.randrange(200))), "x") for i in range(301)] + [(5, None, "x"), (5, "same id", "x"), (9000, "z" * 100_000, "x")]
    got = fp.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string, guard string")).collect()
    order = sorted([(i, t or "") for i, t, _ in rows], key=lambda r: (r[0], r[1].encode()))
    want = sorted((i, len(t), hashlib.sha256(fp.edited(t, order[(k + 1) % len(order)][1]).encode()).hexdigest()) for k, (i, t) in enumerate(order))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    one = fp.compare_with_next(spark.createDataFrame([(None, "only")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1
    assert fp.compare_with_next(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    names, matrix = lid.train(docs.where(~lid.held_out()))
    r = lid.identify(docs.where(lid.held_out()).withColumn("score_", F.lit(1)), names, matrix).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert r[0] > 0.97 and 0 <= r[1] <= r[2] <= 1
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 % —"), (4, "der die und nicht " * 100_000), (5, "x")], "doc_id long, text string")
    got = {x.doc_id: x for x in lid.identify(odd, names, matrix).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred == "de" and got[5].lang_pred in names
    assert got[1].score == 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert lid.train(empty)[0] == [] and lid.identify(odd, *lid.train(empty)).where("lang_pred <> 'und'").count() == 0
    direct, score = lid.posterior(["der die und nicht"], names, matrix)
    assert direct == ["de"]


def test_pieces_in_chunks_equal_whole():
    c = lid.normalised("Ein Satz, 3 Wörter!")
    assert "".join(map(chr, c)) == " ein satz wörter "
    whole = [g.tolist() for g in lid._grams(c)]
    lid.PIECE, keep = 5, lid.PIECE
    try:
        parts = [g.tolist() for g in lid._grams(c)]
    finally:
        lid.PIECE = keep
    assert sorted(x for g in whole for x in g) == sorted(x for g in parts for x in g)


TOKENIZERS = pytest.importorskip("public_tokenizers")


def test_packing_round_trip(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["Der", "Straße.", "it's", "3.14", "ÉTÉ,", "naïve!", "日本語", "<|endoftext|>", "x" * 30]) for _ in range(rng.randrange(400))), 0) for i in range(150)]
    rows += [(None, None, 0), (7, rows[7][1], 0), (900, "word" * 40_000, 0), (901, "no end " * 9000, 0), (902, "", 0)]
    path = TOKENIZERS.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    ids = {t: whole.encode(t or "", add_special_tokens=False).ids + [2] for _, t, _ in rows}
    for block in (packing.BLOCK, 9000):
        got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, length long").coalesce(2), path, 2, block=block).collect()
        by, seq = {}, {}
        for r in got:
            by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
            seq.setdefault(r.sequence_id, []).append(r)
        for s in seq.values():
            s.sort(key=lambda r: r.offset)
            assert [r.offset for r in s] == [sum(x.length for x in s[:i]) for i in range(len(s))] and sum(r.length for r in s) <= 4096
        for i, t, _ in set(rows):
            e, pieces = ids[t], by[i, len(ids[t])]
            copies = sum(1 for r in rows if r[:2] == (i, t))
            assert sum(r.length for r in pieces) == copies * len(e)
            for r in pieces:
                assert zlib.crc32(struct.pack(f"<{r.length}I", *e[r.start:r.start + r.length])) == r.ids_crc32
        size = [sum(r.length for r in s) for s in seq.values()]
        assert sum(4096 - n for n in size if n & (n - 1)) < 0.05 * sum(size)  # few, short documents; hard cuts cost 64 tokens each
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), path, 2).count() == 0


def test_cuts_are_optimal():
    import numpy as np
    rng = random.Random(4)
    for _ in range(200):
        at = np.cumsum([0] + [rng.randrange(1, 9) for _ in range(rng.randrange(1, 30))])
        pen = np.array([rng.choice([0.0, 1.0, 5.0]) for _ in at])
        waste = lambda n: 0 if n & (n - 1) == 0 else 16 - n
        best = [0.0] + [9e9] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = min(best[i] + waste(int(at[j] - at[i])) + pen[j] for i in range(j) if at[j] - at[i] <= 16)
        c = [0, *packing.cuts(at, pen, 16)]
        cost = sum(waste(int(at[b] - at[a])) + pen[b] for a, b in zip(c, c[1:]))
        assert c[-1] == len(at) - 1 and all(at[b] - at[a] <= 16 for a, b in zip(c, c[1:])) and cost == pytest.approx(best[-1])


def test_mix_targets_and_copies(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 30)), rng.choice(["a", "b", "B", None, "é"]) if i % 3 else "hot", "x") for i in range(3000)]
    rows += [(None, None, "empty", "x"), (1, "w w", "a", "x"), (1, "w w", "a", "x"), (4000, "w", "tiny", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = mixing.plan_mix(docs).collect()
    assert sorted(got, key=str) == sorted(mixing.plan_mix(docs.repartition(7)).collect(), key=str)
    size = {}
    for _, t, s, _ in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted([s for s in size if s is not None], key=lambda s: s.encode()) + [None]
    w = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), sum(size.values())
    while True:
        total = sum(w[s] for s in open_)
        full = {s for s in open_ if 3 * size[s] < rest * w[s] / total}
        if not full:
            break
        for s in full:
            target[s] = 3.0 * size[s]
        rest -= sum(3 * size[s] for s in full)
        open_ -= full
    target |= {s: rest * w[s] / total for s in open_}
    assert sorted({round(r.target, 6) for r in got}) == sorted({round(x, 6) for x in target.values()})
    assert all(0 <= r.copies <= 3 for r in got) and len(got) == len(rows)
    assert abs(sum(r.copies * r.size for r in got) - sum(size.values())) < 0.1 * sum(size.values())
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.plan_mix(docs.limit(0)).count() == mixing.mix(docs.limit(0)).count() == 0
    mixing.FEW, keep = 0, mixing.FEW  # the joined way
    try:
        assert mixing.mix(docs).count() == sum(r.copies for r in got)
    finally:
        mixing.FEW = keep


def test_url_filter(spark):
    rows = [(1, "https://WWW.Example.com/en/1?x", 0), (2, "http://a.example.com/en/", 0), (3, "https://shop.net/fr/x#y", None), (4, "ftp://shop.net/en", None),
            (5, None, None), (6, "no scheme", None), (7, "x://", 1), (8, "http://xcom/", None), (9, "http://com", None), (10, "a://b://c/d", None)]
    rows += [(100 + i, "http://bad.host.org/x", 1) for i in range(60)] + [(200 + i, "http://good.host2.org/x", 0) for i in range(60)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, bad int")).collect()}
    assert len(got) == len(rows)
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("example.com/en/", "block")
    assert (got[3].host, got[3].path, got[3].rule, got[3].verdict) == ("shop.net", "/fr/x", "net/fr/", "block")
    assert [got[i].rule for i in (4, 5, 6, 7, 8, 9)] == [None] * 6 and (got[5].host, got[5].path) == ("", "") and got[10].host == "b:"
    assert got[100].verdict == "block" and got[200].verdict == "allow"
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, bad int")).count() == 0


def test_chat_round_trip(spark):
    rng = random.Random(6)
    bits = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "<\\|", "\n", "é", "assistant", "$1", " "]
    rows = [(c, t, rng.choice(["user", "assistant", "sys tem\n", None]), "".join(rng.choice(bits) for _ in range(rng.randrange(12))), "x")
            for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(50, 0, "assistant", None, "x"), (50, 0, "assistant", "tie", "x"), (50, 0, "assistant", "tie", "x"), (51, None, "user", "w" * 200_000, "x"), (None, 1, "assistant", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, chunk string")
    got = chat.read_turns(chat.format_turns(df, chat.text_part(F.col("text")))).collect()
    assert sorted(((r.conv_id, r.turn, r.role, r.text) for r in got), key=str) == sorted(((c, t, r or "", x or "") for c, t, r, x, _ in rows), key=str)
    assert all(r.loss_text == (r.text if r.role == "assistant" else "") for r in got)
    d = {r.conv_id: r for r in chat.conversation_digests(chat.read_turns(chat.format_turns(df, chat.text_part(F.col("text"))))).collect()}
    assert d[50].n_turns == 3 and d[50].loss_sha256 == hashlib.sha256(b"tietie").hexdigest() and len(d) == 43


def test_chat_parts(spark):
    parts = [("text", "look <|image:1|>", None, None), ("image", None, "s3://a.png", 784 * 3 + 1), ("text", " and ", None, None), ("audio", None, "b.wav", 80), (None, "!", None, None), ("document", None, None, None)]
    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], "conv_id long, turn long, role string, p array<struct<kind:string,text:string,uri:string,units:bigint>>")
    a, b = chat.format_turns(df, F.col("p")).orderBy("turn").collect()
    assert a.chunk == "<|im_start|>assistant\nlook <\\|image:1|><|image:1|> and <|audio:2|>!<|document:3|><|im_end|>\n"
    assert [(x.ordinal, x.kind, x.uri, x.tokens) for x in a.attachments] == [(1, "image", "s3://a.png", 4), (2, "audio", "b.wav", 2), (3, "document", None, 1)]
    assert b.chunk == "<|im_start|>user\n<|im_end|>\n" and json.dumps(b.attachments) == "[]" and b.loss_start == b.loss_end


def _b64(raw):
    return base64.b64encode(raw).decode()


@pytest.mark.parametrize("wrap", [
    lambda s: _b64(gzip.compress(gzip.compress(s.encode()))),
    lambda s: _b64(lzma.compress(zlib.compress(s.encode()))),
    lambda s: _b64(bz2.compress(b"x" * 99 + lzma.compress(gzip.compress(s.encode())))),
    lambda s: _b64(gzip.compress(b"first ") + gzip.compress(s.encode())),
    lambda s: _b64(bz2.compress(s[:9].encode()) + bz2.compress(s[9:].encode())),
    lambda s: "path/" + _b64(zlib.compress(s.encode())),
    lambda s: urllib.parse.quote(gzip.compress(s.encode()), safe=""),
    lambda s: "".join(f"\\x{b:02x}" for b in zlib.compress(s.encode())),
])
def test_packed_layers_anywhere_are_unwrapped(wrap):
    test_layers_are_unwrapped_and_mapped(wrap)


@pytest.mark.parametrize("inner", [
    lambda s: s.encode(),
    lambda s: gzip.compress(s.encode()),
    lambda s: _b64(s.encode()).encode(),
])
def test_long_layers_are_scanned_whole(inner):
    long = _b64(gzip.compress(b"-" * 999 + b".\n" * (9 << 20) + inner(SECRET)))
    cut, _, found = scan_text("see " + long)
    assert cut == 1 and any(f[3] == "assign" and f[5].startswith("hunter2") for f in found)
    parts = scan_text("see " + _b64(gzip.compress(b"word\n" * 999 + inner(SECRET) + b"\nword!\n" * 999)), max_layer=500)[2]
    assert any(f[5].startswith("hunter2") for f in parts)


def test_likeness_of_a_line_repeated_often():
    import pyarrow as pa
    text = "the same three\n" * 50_000
    f = fp.fingerprints(pa.array([text, fp.edited(text, "x")]))
    assert 0.9 < fp.likeness(f[:1], f[1:])[0] < 1
    one = fp.fingerprints(pa.array(["the same three"]))[0]
    assert fp.subtract(fp.add(f[0], one), one) == f[0]
    words = "word " * 40_000
    f = fp.fingerprints(pa.array([words, fp.edited(words, "")]))
    assert fp.likeness(f[:1], f[1:])[0] > 0.9


def test_chat_digests_of_long_conversations_are_fed(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["é", "<|", "", None, "w" * 5000])) for c in (1, 2, None) for t in [None, *range(30), 3, 3]]
    read = chat.read_turns(chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), chat.text_part(F.col("text"))))
    whole, fed = chat.conversation_digests(read), chat.conversation_digests(read, most=100)
    assert whole.columns == fed.columns and sorted(whole.collect(), key=str) == sorted(fed.collect(), key=str) and fed.count() == 3
    assert "collect_list" not in fed._jdf.queryExecution().toString()


def test_words_by_ranks_equal_the_tokenizer():
    """Words put together from parts that are merged by ranks, against the tokenizer on whole words."""
    import struct

    from sifter.llm import packing
    words = packing._words(public_tokenizers.path("word_bpe_49k.json"))
    assert words.ranked is not None and words.splits
    rng = random.Random(11)
    letters, marks = "abcdefghijklmnopqrstuvwxyzéàüßñæøABCDEFGÉ", "!&(-/:-@[`{~.,;\"'#"
    some = ["".join(rng.choice(marks) for _ in range(rng.randrange(3))) + "".join(rng.choice(letters) for _ in range(rng.randrange(1, 14)))
            + "".join(rng.choice(marks) for _ in range(rng.randrange(3))) for _ in range(20_000)] + ["don't", "l'été", "<|endoftext|>x", "漢字", "ÿ", "...", "a"]
    want = [e.ids for e in words.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
    assert words.of(some) == [struct.pack(f"<{len(i)}I", *i) for i in want]


def test_posterior_equals_a_plain_naive_bayes():
    """Counts, smoothing and posteriors by plain Python, over a batch whose texts are scored in pieces."""
    import math

    import numpy as np
    rng = random.Random(4)
    words = {"en": "the and of with this house water".split(), "de": "der und mit dieses haus wasser nicht".split(), "fr": "le et avec cette maison eau pas".split()}
    say = lambda l, n: " ".join(rng.choice(words[l]) for _ in range(n))
    learned = {l: [say(l, 20) for _ in range(5)] for l in words}

    def grams(text):
        c, out = [int(x) for x in lid.normalised(text)], []
        for i in range(len(c)):
            h = 0
            for k in range(min(lid.ORDERS, len(c) - i)):
                h = (h + c[i + k]) * lid._MULTIPLY[k] % 2**32
                out.append(((h ^ (h >> 15)) * 0x2C1B3C6D % 2**32) >> 16)
        return out
    names = sorted(words)
    counts = np.full((3, lid.BUCKETS), lid.ALPHA)
    for j, l in enumerate(names):
        for t in learned[l]:
            for g in grams(t):
                counts[j, g] += 1
    matrix = np.hstack([np.log(counts / counts.sum(1, keepdims=True)), np.log(np.full((3, 1), 1 / 3))]).astype(np.float32)
    texts = [say(rng.choice(names), rng.randrange(1, 9)) for _ in range(60)] + [None, "", "12", "haus the", "x", say("fr", 400)]
    keep = lid.GRAMS, lid.CELLS
    for lid.GRAMS, lid.CELLS in (keep, (50, 40)):
        pred, score = lid.posterior(texts, names, matrix)
        for t, p, s in zip(texts, pred, score):
            g = grams(t) if len(lid.normalised(t)) else None
            if g is None:
                assert (p, s) == ("und", 0.0)
                continue
            log = [float(matrix[j, -1]) + sum(float(matrix[j, x]) for x in g) for j in range(3)]
            want = [math.exp(x - max(log)) for x in log]
            assert p == names[log.index(max(log))] and abs(s - max(want) / sum(want)) < 1e-4
    lid.GRAMS, lid.CELLS = keep


def test_null_ids_are_learned_from_and_mixed_by_their_texts(spark):
    rows = [(None, f"the house and the water number {i} are with this", "en", "a") for i in range(3000)] + [(i, f"das haus und wasser {i}", "de", "b") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names, matrix = lid.train(docs, per_language=200)
    got = lid.identify(spark.createDataFrame([(None, "this water and the house", 5)], "doc_id long, text string, score int"), names, matrix).first()
    assert (got.lang_pred, got.doc_id) == ("en", None) and 0 < got.score <= 1
    many = spark.createDataFrame([(None if i % 2 else 7, f"w{i} " * 4, f"s{i % 3}") for i in range(6000)], "doc_id long, text string, source string")
    plan = mixing.plan_mix(many).groupBy("target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")).collect()
    assert all(abs(r.taken - r.target) < 0.1 * r.target for r in plan)
    with pytest.raises(ValueError, match="labels"):
        lid.train(docs.withColumn("lang", F.concat("lang", F.col("text"))))


def test_judge_keeps_columns_with_clashing_names(spark):
    d = spark.createDataFrame([(1, "http://a.net/es/x", 1, "r", "b", "c", "h")], "page_id long, url string, bad int, rate string, _r string, bound string, host string")
    got = url_filter.judge(d)
    assert got.columns == ["page_id", "url", "bad", "rate", "_r", "bound", "host", "path", "rule", "verdict"]
    assert tuple(got.first()) == (1, "http://a.net/es/x", 1, "r", "b", "c", "a.net", "/es/x", "net/es/", "block")


@pytest.mark.parametrize("ranked, splits", [(True, True), (False, True), (False, False)])
def test_packing_looks_a_word_up_once_however_often_it_occurs(ranked, splits):
    """op7's time goes with a batch's different words, not with all; ids and positions are the tokenizer's."""
    import pyarrow as pa

    class Counted(dict):
        asked = 0

        def get(self, *a):
            self.asked += 1
            return super().get(*a)

    words = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    words.parts, words.words = Counted(), Counted()
    words.ranked, words.splits = words.ranked if ranked else None, splits
    texts = ["Der Hund. der  HUND! (l'été) " * 500, "", "\x1c Ende.\x1cx a.\u3000b! <|endoftext|>.", "Ende.\u3000ja\x00 日本語! Hund"]
    want, after, closed = [], [], []
    for t in texts:  # of white space, a text's words are parted by ASCII's alone where it holds one of four control characters
        for w in re.findall(r"[^\x20\x09-\x0D]+", t) if "\x1c" in t else t.split():
            want += (ids := words.tokenizer.encode(w, add_special_tokens=False).ids)
            closed += [len(want)] if ids and words.ends[ids[-1]] else []
        want.append(2)
        after.append(len(want))
    got = packing.tokenized(pa.array(texts), words, 2)
    assert (got[0].tolist(), got[1].tolist(), sorted(set(got[2].tolist()))) == (want, after, closed)
    assert words.parts.asked + words.words.asked < 50  # of 2,512 words
