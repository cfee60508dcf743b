"""Sharding, cross-tokenizer alignment and the Merkle manifest against brute force on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import public_tokenizers
from sifter.llm import alignment, merkle, sharding
from sifter.llm.queries import op13_merkle

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
# columns whose names clash with inner ones
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, number long, tree int, idx int, run string, shard string, slot string, row string, pairs int, id int, n int"
EXTRA = (7, 1, 2, "r", "s", "t", "u", 3, 4, 5)


def rows(seed=3, n=300):
    rng = random.Random(seed)
    words = "the a of  naïve 漢字 don't Été U.S. \n\t 12345 tokenization antidisestablishmentarianism <s> <|endoftext|> « x   　 😀 ▁".split(" ")
    out = [(None, None, None, None, None), (None, None, None, None, None), (1, "s", "en", 3, ""), (2, "s", None, 1, " "), (3, None, "en", 9, "same"), (3, None, "en", 9, "same"),
           (3, "s", "en", 9, "SAME"), (4, "", "", 0, "a▁b"), (5, "é", "en", 1, "word " * 20_000), (6, "lone", "en", 5, " x   y\x00z")]
    out += [(i, f"s{i % 3}" if i % 5 else "s0", "en", i, " ".join(rng.choice(words[:-1] if i % 7 else words) for _ in range(rng.randrange(60)))) for i in range(10, n)]
    rng.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame([r + EXTRA for r in data], SCHEMA)


# sharding

@pytest.mark.parametrize("n", [1, 2, 5, 17, 101, 1000])
def test_network_is_a_permutation_and_goes_back(spark, n):
    d = spark.range(n).select(F.col("id").alias("number"))
    steps = sharding.walk_length(d, n)
    shard, slot = sharding.located(F.col("number"), n, 8, steps)
    got = d.select("number", shard.alias("shard"), slot.alias("slot"))
    back = got.select("number", sharding.number_at(F.col("shard"), F.col("slot"), n, 8, 2 * n).alias("back")).collect()
    assert sorted(r.slot * 8 + r.shard for r in got.collect()) == list(range(n))
    assert all(r.number == r.back for r in back)


def test_shards_of_awkward_rows(spark, tmp_path):
    data = rows()
    d = frame(spark, data)
    got = sharding.shard_rows(d).collect()
    want = Counter((r[0], len((r[4] or "").encode()) + 1, zlib.crc32((r[4] or "").encode())) for r in data)
    assert Counter((r.id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_rows(d.repartition(5)).collect()  # another order and layout, the same shards
    key = lambda r: (r.id, r.size, r.text_crc32, r.tie, r.shard, r.slot)
    assert Counter(map(key, again)) == Counter(map(key, got))
    moved = sharding.shard_rows(d, seed="other").collect()
    assert Counter(map(key, moved)) != Counter(map(key, got))

    sharding.write_shards(d, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert Counter((r.doc_id, r.shard, r.slot) for r in back.collect()) == Counter((r.id, r.shard, r.slot) for r in got)
    assert Counter((r.doc_id, r.source, r.text, r.number) for r in back.collect()) == Counter((r[0], r[1], r[4], 7) for r in data)


def test_no_rows(spark, tmp_path):
    d = frame(spark, [])
    assert sharding.shard_rows(d).count() == 0
    assert alignment.align(d, *PATHS).count() == 0 and alignment.score_alignment(d, *PATHS).count() == 0
    m = merkle.build(d.select(F.col("doc_id").alias("id"), F.col("source").alias("group"), merkle.leaf([F.col("text")]).alias("leaf")))
    assert m.root is None and merkle.with_paths(m).count() == 0


def test_shuffle_is_even(spark):
    """Neighbours part: of the 1000 first numbers, each shard gets about an eighth, and ranks do not correlate."""
    n = 100_000
    got = spark.range(n).select(F.col("id").alias("number"), sharding.located(F.col("id"), n, 8, 3)[0].alias("shard"), sharding.located(F.col("id"), n, 8, 3)[1].alias("slot"))
    first = got.where("number < 1000").groupBy("shard").count().collect()
    assert all(80 <= r["count"] <= 170 for r in first) and len(first) == 8
    assert abs(got.agg(F.corr("number", "slot")).first()[0]) < 0.02


# alignment

def brute(texts):
    """Whole texts through the tokenizers, every pair of tokens compared."""
    t = alignment.tokenizers(*PATHS)
    docs = []
    for text in texts:
        s = " " + (text or "")
        a, b = t.a.encode(s, add_special_tokens=False).ids, t.b.encode(text or "")
        if not text or b"".join(t.bytes_a[i] for i in a) != s.encode() or b"".join(t.bytes_b[i] for i in b) != s.encode():
            docs.append(None)
            continue
        spans = []
        for ids, table in ((a, t.bytes_a), (b, t.bytes_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(out)
        links = [(x, y) for x, (s0, e0, _) in enumerate(spans[0]) for y, (s1, e1, _) in enumerate(spans[1]) if s0 < e1 and s1 < e0]
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = ["|".join(",".join(str(i) for _, e, i in side if lo < e <= hi) for side in spans) for lo, hi in zip([0, *common], common)]
        docs.append((spans, links, common, ";".join(groups)))
    held, best = Counter(), Counter()
    for d in docs:
        if d:
            held.update({(d[0][0][x][2], d[0][1][y][2]) for x, y in d[1]})
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    out = []
    for d in docs:
        if not d:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        (sa, sb), links, common, groups = d
        counts = [(sa[x][2], held[sa[x][2], sb[y][2]]) for x, y in links]
        out.append((len(sa), len(sb), len(common), len(links), sum(n == best[a] for a, n in counts), sum(n for _, n in counts), hashlib.sha256(groups.encode()).hexdigest()))
    return out, docs


@pytest.mark.parametrize("most_pairs", [alignment.MOST, 0])
def test_alignment_equals_brute_force(spark, most_pairs):
    data = [r for r in rows(n=120) if len(r[4] or "") < 10_000]
    real = [(r.doc_id + 1000, "s", "en", 1, r.text[:600]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    data += real
    want, _ = brute([r[4] for r in data])
    got = alignment.score_alignment(frame(spark, data), *PATHS, most_pairs=most_pairs).collect()
    assert Counter((r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) == Counter((d[0], *w) for d, w in zip(data, want))
    assert any(not w[0] for w in want) and sum(bool(w[0]) for w in want) > 100


def test_align_gives_tokens_and_links(spark):
    data = [r for r in rows(n=60) if len(r[4] or "") < 10_000 and r[0] not in (None, 3)]
    _, docs = brute([r[4] for r in data])
    want = {r[0]: d for r, d in zip(data, docs)}
    for r in alignment.align(frame(spark, data), *PATHS).collect():
        if want[r.id] is None:
            assert not (r.a or r.b or r.cuts or r.link_a)
            continue
        (sa, sb), links, common, _ = want[r.id]
        assert (r.a, r.ends_a, r.b, r.ends_b) == ([x[2] for x in sa], [x[1] for x in sa], [x[2] for x in sb], [x[1] for x in sb])
        assert r.cuts == common and list(zip(r.link_a, r.link_b)) == sorted(links)


def test_segments_equal_whole_texts():
    """Cutting at spaces changes no token, on random texts of white space, marks and letters."""
    import numpy as np
    t, rng = alignment.tokenizers(*PATHS), random.Random(5)
    alphabet = [" ", " ", " ", "\n", "\t", " ", " ", "　", "a", "b", "é", "漢", "1", "'s", "'", ".", "«", "’", "😀", "\x00", "\x1c", "<s>", "▁"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 30)))
        raw = np.frombuffer((" " + text).encode(), np.uint8)
        k = alignment.Block(t, raw, np.array([0, len(raw)]))
        if "▁" in text:
            assert not k.good[0]
        else:
            assert k.a.tolist() == t.a.encode(" " + text, add_special_tokens=False).ids and k.b.tolist() == t.b.encode(text), repr(text)


# manifest

def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree_paths(leaves, fanout):
    """(root, for each leaf its (before, after) lists, level by level)."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        runs = [level[i:i + fanout] for i in range(0, len(level), fanout)]
        for leaf, i in enumerate(at):
            run, slot = runs[i // fanout], i % fanout
            paths[leaf].append((run[:slot], run[slot + 1:]))
        at = [i // fanout for i in at]
        level = [digest(*r) for r in runs]
    return level[0], paths


def brute_manifest(data, fanout=16):
    order = lambda r: (r[0] is not None, r[0] or 0)
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append((r, digest(*map(enc, r))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = []
    for g in names:
        groups[g].sort(key=lambda x: (order(x[0]), x[1]))
        subs.append(tree_paths([x[1] for x in groups[g]], fanout))
    root, tops = tree_paths([s[0] for s in subs], fanout)
    out = []
    for g, (sub, paths), top in zip(names, subs, tops):
        for (r, leaf), own in zip(groups[g], paths):
            steps = own + top
            low = None if r[4] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
            d = digest(*map(enc, (*r[:4], low))) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else leaf
            for before, after in steps:
                d = digest(*before, d, *after)
            out.append((r[0], leaf, sub, root, digest(*[x for b, a in steps for x in b + a]), d, d == root))
    return out


def test_manifest_equals_brute_force(spark, tmp_path):
    data = rows(n=700)  # one source of some 350 rows, lone ones, null and empty ones
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_merkle(spark, str(tmp_path))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got.columns == columns
    want = brute_manifest(data)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert 0 < sum(not w[-1] for w in want) < len(want) / 3


@pytest.mark.parametrize("fanout,n_groups,n", [(2, 1, 1), (2, 1, 37), (4, 70, 200), (16, 40, 41), (16, 1, 16), (16, 1, 17)])
def test_fanouts_and_many_groups(spark, fanout, n_groups, n):
    data = [(i, f"g{i % n_groups}", "en", i, f"Text {i}") for i in range(n)]
    d = frame(spark, data)
    m = merkle.build(d.select(F.col("doc_id").alias("id"), F.col("source").alias("group"), merkle.leaf([F.col(c) for c in merkle.COLUMNS]).alias("leaf")), fanout)
    got = merkle.with_paths(m).select("id", merkle.text_of(F.col("leaf")), merkle.text_of(F.col("subroot")), F.lit(m.root), F.sha2(merkle.proof(F.col("steps")), 256),
                                      merkle.folded(merkle.text_of(F.col("leaf")), F.col("steps")))
    want = brute_manifest(data, fanout)
    assert Counter(tuple(r)[:5] for r in got.collect()) == Counter(w[:5] for w in want)
    assert all(r[5] == m.root for r in got.collect())


def test_fanout_is_a_power_of_two(spark):
    with pytest.raises(ValueError):
        merkle.build(spark.createDataFrame([(1, "a", bytearray(32))], "id long, `group` string, leaf binary"), 3)
