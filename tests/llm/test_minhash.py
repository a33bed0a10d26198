import itertools
import random
import re

import pytest

from barforge.llm import minhash
from barforge.llm.components import connected

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, size, threshold):
    sets, root = {}, {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations([i for i in sets if sets[i]], 2):
        both = len(sets[a] & sets[b])
        if 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("size", [2, 5])
def test_equals_brute_force(spark, words, size):
    rng, rows = random.Random(1), []
    base, chain = words(120, 0).split(), words(80, 1).split()
    for _ in range(150):  # a group of near copies on both sides of the threshold
        edited = base[:]
        for _ in range(rng.randint(0, 18)):
            edited[rng.randrange(len(edited))] = words(1, rng.random())
        rows.append(" ".join(edited))
    for _ in range(40):  # a chain: neighbours alike, ends apart
        chain = chain[:]
        for _ in range(3):
            chain[rng.randrange(80)] = words(1, rng.random())
        rows.append(" ".join(chain))
    rows += [" ".join(base[:100] + words(22, k).split()) for k in range(60)]  # a shared passage
    rows += [None, "", "  \n", "x", " X", "y z", "y  z\t"]
    rng.shuffle(rows)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(rows)]
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, size, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("sends", [0, 1, 1000])
def test_large_buckets_equal_brute_force(spark, words, monkeypatch, sends):
    """Families of many blocks, and buckets of more than two that are divided by rare shingles: no link is lost."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 6)
    monkeypatch.setattr(minhash, "FAMILY_SENDS", sends)
    rng, rows = random.Random(3), []
    base = words(150, 11).split()
    for _ in range(120):
        edited = base[:]
        for _ in range(rng.choice([0, 3, 6, 20, 40])):
            edited[rng.randrange(len(edited))] = words(1, rng.random())
        rows.append(" ".join(edited))
    rows = list(enumerate(rows + [" ".join(base[:110] + words(40, k).split()) for k in range(100)]))
    rng.shuffle(rows)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 2, 80)


def test_a_shared_passage_brings_nothing_together(spark, words):
    """Texts of one passage and words of their own: none is compared, however many there are."""
    passage = words(140, 1)
    rows = [(i, passage + " " + words(60, 100 + i)) for i in range(1500)]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    values = minhash._sets(texts, 5)
    members = texts.selectExpr("doc_id as rep", "doc_id as component")
    assert minhash._rare(members, values, 80).count() == 0
    assert minhash.near_duplicates(texts, 5).where("not kept").count() == 0


def test_repeated_ids(spark, words):
    a, b, c = words(80, 1), words(80, 2), words(80, 3)
    rows = [(5, a), (6, a + " z"), (6, b), (9, b + " y"), (11, "only one"), (11, "only one"), (None, c), (None, c), (12, None)]
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect())
    want = [("5", "5", True), ("6", "5", False), ("6", "6", True), ("9", "6", False), ("11", "11", True), ("11", "11", True), ("12", "12", True), ("None", "None", True), ("None", "None", False)]
    assert got == sorted(want)
    kept = minhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == sorted([("5", a), ("6", b), ("11", "only one"), ("None", c), ("12", "")])


def test_ids_of_other_types(spark, words):
    rows = [("b", words(60, 1)), ("a", words(60, 1) + " x"), ("c", words(60, 2)), (None, "")]
    got = {r.doc_id: (r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string"), 5).collect()}
    assert got == {"a": ("a", True), "b": ("a", False), "c": ("c", True), None: (None, True)}


def test_edges(spark, edge):
    got = minhash.near_duplicates(edge, 2).collect()
    assert len(got) == edge.count()
    by = {r.doc_id: r for r in got}
    assert [by[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1] and all(by[i].kept for i in (1, 2, 3, 4, 5))
    assert by[6].component_id == 5 and not by[6].kept and by[None].kept
    kept = minhash.keep_one(edge, 2)
    assert kept.columns == edge.columns and kept.count() == len(got) - 2
    assert minhash.near_duplicates(edge.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (101, 99), (99, 101)]
    got = {r.id: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 99: 99, 101: 99}
