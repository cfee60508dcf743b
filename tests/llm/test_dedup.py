"""Exact, near and substring dedup against brute force, on texts with the awkward cases."""

import hashlib
import random
import re

import pytest

from sifter.llm import minhash_dedup
from sifter.llm.exact_dedup import exact_dedup
from sifter.llm.minhash_dedup import contract, least_matches, near_duplicates
from sifter.llm.substring_dedup import COVER, PERIOD, remove_repeats

SCHEMA = "doc_id long, text string, run long, node string"  # extra columns whose names clash with inner ones
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], SCHEMA)


def prose(rng, n):
    return " ".join(rng.choice("aurel bora cinder dust ember fjord gale hollow iris juniper kelp loam mire nettle".split())
                    + str(rng.randrange(40)) for _ in range(n))


def awkward(seed):
    rng = random.Random(seed)
    base = prose(rng, 300)
    rows = [(None, None), (None, base), (1, ""), (2, "   "), (3, None), (4, base), (4, base), (4, prose(rng, 80)), (5, base.replace(" ", " \n", 3)),
            (6, prose(rng, 20_000)), (7, "one two"), (8, "ONE  two"), (9, "word"), (10, "\x0bword "), (11, "été ß 漢字 word")]
    for i in range(20, 60):  # near copies
        w = base.split()
        for _ in range(rng.randrange(1, 12)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(9999)}"
        rows.append((i, " ".join(w)))
    shared = prose(rng, 70)
    for i in range(60, 90):  # a passage in many documents
        rows.append((i, prose(rng, rng.randrange(5, 90)) + " " + shared + " " + prose(rng, 40)))
    for i in range(90, 120):
        rows.append((i, prose(rng, rng.randrange(1, 120))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("leaf_bits", [None, 1, 5])
def test_exact_dedup_equals_grouping(spark, leaf_bits):
    rows = awkward(1)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    got = exact_dedup(frame(spark, rows), leaf_bits=leaf_bits).collect()
    assert len(got) == len(rows)
    kept = {}
    for r in got:
        (text,) = [t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256]
        ids = [i for i in groups[text] if i is not None]
        assert r.keep_id == (min(ids) if ids else None) and r.group_size == len(groups[text])
        kept[text] = kept.get(text, 0) + r.kept
        assert not r.kept or r.id == r.keep_id
    assert all(n == 1 for n in kept.values())  # of rows that repeat an id, one stays
    assert exact_dedup(frame(spark, [])).count() == 0


def shingles(text, size):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, size, percent):
    rows = awkward(2)
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    want = []
    for a, (i, _) in enumerate(rows):
        ids = [rows[b][0] for b in range(len(rows)) if root(b) == root(a) and rows[b][0] is not None]
        c = (min(ids) if ids else None) if sets[a] else i
        want.append((i, len(sets[a]), c, c == i))
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows), shingle=size, percent=percent).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert near_duplicates(frame(spark, [])).count() == 0


def test_what_a_list_makes_is_no_more_than_its_classes(spark, monkeypatch):
    """Many texts of one passage, few of them linked: pairs do not become rows, and every link counts."""
    rng = random.Random(11)
    base = prose(rng, 150).split()
    rows = []
    for i in range(120):  # edits from a few places, so that some texts are linked by way of others
        w = list(base)
        for k in rng.sample(range(12), rng.randrange(1, 7)):
            w[12 * k + 5] = f"edit{k}x{rng.randrange(4)}"
        rows.append((i, " ".join(w)))
    sets = [shingles(t, 3) for _, t in rows]
    seen = {}

    def counted(name):
        inner = getattr(minhash_dedup, name)

        def call(rows, *args):
            out = inner(rows, *args)
            seen[name] = (rows, out)
            return out
        monkeypatch.setattr(minhash_dedup, name, call)

    counted("_linked")
    counted("_blocks")
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, rows), shingle=3, percent=85).collect()}
    label = list(range(len(rows)))
    pairs = [(a, b) for b in range(len(rows)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in rows:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    assert got == dict(enumerate(label)) and 2 < len(set(label)) < 100
    assert seen["_linked"][1].count() <= seen["_linked"][0].count() == seen["_blocks"][1].count()


def test_joined_equals_brute_force_in_every_block(spark, monkeypatch):
    """Classes of several lists, of which none is linked yet: links of blocks join what brute force joins."""
    rng = random.Random(12)
    monkeypatch.setattr(minhash_dedup, "CELL", 5)
    base = [rng.randrange(1 << 40) for _ in range(200)]
    texts = [" ".join(f"w{x if rng.random() > .02 * (i % 4) else rng.randrange(1 << 40)}" for x in base) for i in range(40)]
    frame_ = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    sets = frame_.mapInArrow(minhash_dedup._sets(3), "id bigint, n bigint, sig binary, shingles array<bigint>")
    lists = sets.selectExpr("explode(array(7L, -3L, id % 3)) AS token", "id", "id AS label", "n", "0L AS own", "sig")
    links = minhash_dedup._linked(lists, sets, 80).collect()
    alone = [shingles(t, 3) for t in texts]
    real = {(a, b) for b in range(40) for a in range(b) if 100 * len(alone[a] & alone[b]) >= 80 * len(alone[a] | alone[b])}
    assert {(r.a, r.b) for r in links} <= real

    def parts(edges):
        label = list(range(40))
        for _ in label:
            for a, b in edges:
                label[a] = label[b] = min(label[a], label[b])
        return label
    assert parts(real) == parts([(r.a, r.b) for r in links]) and 1 < len(set(parts(real))) < 40


def test_least_matches_is_the_binomial_tail():
    assert least_matches(85) == 39 and least_matches(80) == 34 and least_matches(100) == 64


def test_contract_joins_long_chains(spark):
    n = 60
    order = list(range(n))
    random.Random(3).shuffle(order)
    labels = spark.createDataFrame([(i, i) for i in range(2 * n)], "id long, label long")
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(n + 1, n + 2)], "a long, b long")
    got = {r.id: r.label for r in contract(labels, edges).collect()}
    assert all(got[i] == 0 for i in range(n)) and got[n + 2] == n + 1 and got[n] == n and len(got) == 2 * n


def test_contract_does_not_multiply_the_planners_estimate(spark):
    labels = spark.createDataFrame([(i, i) for i in range(64)], "id long, label long")
    for step in (1, 2, 4):
        edges = spark.createDataFrame([(i, i + step) for i in range(0, 64, 2 * step)], "a long, b long")
        labels = contract(labels, edges)
    assert {r.label for r in labels.collect()} == set(range(0, 64, 8))
    assert int(labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) < 1 << 40


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_remove_repeats_equals_brute_force(spark):
    rows = awkward(4)
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - 49):
            if i is not None:
                first[tuple(w[k:k + 50])] = min(first.get(tuple(w[k:k + 50]), i), i)
    want = []
    for (i, _), w in zip(rows, words):
        gone = {k + j for k in range(len(w) - 49) if i is not None and first[tuple(w[k:k + 50])] < i for j in range(50)}
        want.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(w[2] for w in want) > 5000
    assert remove_repeats(frame(spark, [])).count() == 0


def test_remove_repeats_with_frequent_anchors(spark):
    """A passage in most documents, several times in some: dealt as a heavy anchor."""
    rng = random.Random(5)
    p = prose(rng, 64)
    rows = [(i, prose(rng, 5) + f" {p} " + prose(rng, 5) + (f" {p}" if i % 3 == 0 else "")) for i in range(400)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(frame(spark, rows)).collect()}
    assert got[0] == 0 and all(got[i] >= (128 if i % 3 == 0 else 64) for i in range(1, 400))


@pytest.mark.parametrize("seed", [7, 8])
def test_remove_repeats_at_any_alignment(spark, seed):
    """A passage at random offsets: its anchors are frequent at some alignments only."""
    rng = random.Random(seed)
    p = prose(rng, 64)
    rows = [(i, f"{prose(rng, rng.randrange(1, 60))} {p} {prose(rng, 5)}") for i in range(400)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(frame(spark, rows)).collect()}
    assert got[0] == 0 and all(got[i] >= 64 for i in range(1, 400))
