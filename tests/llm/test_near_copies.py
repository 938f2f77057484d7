"""Near copies at a likeness of five-word shingles, against all pairs."""

import random

import numpy as np
import pytest
from vulnlake.llm import near_copies
from vulnlake.llm.tables import table

from tests.llm import brute


def test_shingles_and_minima():
    text = b"one Two  three four five six one two three four five"
    assert len(near_copies.shingle_set(text)) == len(brute.word_shingles(text.decode()))
    assert list(near_copies.shingle_set(b"A b")) == list(near_copies.shingle_set(b"a  B ")) and len(near_copies.shingle_set(b" ")) == 0
    rng = random.Random(1)
    words = [f"w{rng.randrange(5000)}" for _ in range(300_000)]
    long_ = " ".join(words).encode()
    assert len(near_copies.shingle_set(long_)) == len(brute.word_shingles(long_.decode()))
    a = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 2000, np.uint64))
    least = near_copies.minima([a[:1800], a[200:], a[:1800]])
    assert abs((least[0] == least[1]).mean() - 0.8) < 0.12 and (least[0] == least[2]).all()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents_against_all_pairs(spark, sf):
    docs = table(spark, f"/root/testdata/{sf}", "documents")
    texts = dict(map(tuple, docs.select("doc_id", "text").collect()))
    least = {}
    for i, t in sorted(texts.items()):
        least.setdefault(t, i)
    first = {i: t for t, i in least.items()}
    pairs = brute.alike(first)
    want = brute.joined(first, pairs)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()}
    assert set(got) == set(texts)
    found = sum(got[a] == got[b] for a, b in pairs)
    print(f"\n{sf}: {len(texts)} documents, {len(pairs)} pairs of different texts, found {found}")
    assert found >= 0.98 * len(pairs)
    # whatever is joined is joined by verified pairs
    assert all(want[least[texts[got[i]]]] == want[least[t]] for i, t in texts.items())


def _copies(rng, n, base, changed):
    for _ in range(n):
        words = list(base)
        for i in rng.sample(range(len(words)), changed):
            words[i] = f"x{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("bucket", [near_copies.BUCKET, 40])
def test_large_groups_and_shared_passages(spark, bucket):
    """A group of 300 near copies stays one group, in parts too; texts that share half their words stay apart."""
    rng = random.Random(2)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    copies = list(_copies(rng, 300, base, 2))
    shared = [" ".join(base[:150] + [f"y{rng.randrange(10**6)}" for _ in range(150)]) for _ in range(200)]
    docs = spark.createDataFrame(brute.rows(copies + shared), brute.DOCS)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, bucket=bucket).collect()}
    want = brute.joined(range(500), brute.alike(dict(enumerate(copies + shared))))
    assert got == want
    assert len(set(got.values())) == 201


def test_edge_cases(spark):
    texts = [None, "", " \t\n", "one", "One", "a b", "a  b", "word " * 30000, "x y z", "É é É"]
    data = brute.rows(texts) + [(None, "one", "en", "s", 3), (None, "alone", "en", "s", 3), (4, "One", "en", "s", 3), (4, "other", "en", "s", 5)]
    docs = spark.createDataFrame(data, brute.DOCS).selectExpr("*", "1 as key", "2 as node", "3 as `a.b`")
    got = sorted(map(tuple, near_copies.near_copies(docs).collect()), key=str)
    want = [(0, 0), (1, 0), (2, 0), (3, 3), (4, 3), (4, 3), (None, 3), (5, 5), (6, 5), (7, 7), (8, 8), (9, 9), (None, None), (4, 4)]
    assert got == sorted(want, key=str)
    assert near_copies.near_copies(docs.limit(0)).collect() == []


def test_parts_of_a_bucket_lose_no_link(spark):
    """Thirty pairs of twins under one key, dealt into parts of ten: the trees miss some, the rest has them."""
    rng = np.random.default_rng(3)
    sketches = rng.integers(0, 256, (30, near_copies.BANDS * near_copies.ROWS), np.uint8)
    data = [(k, k, 100, sketches[k // 2].tobytes()) for k in range(60)]
    nodes = spark.createDataFrame(data, "h1 bigint, node bigint, n bigint, sketch binary")
    keyed = near_copies._buckets(nodes.selectExpr("7L as key", "h1"), 10)
    found = near_copies._pairs(keyed, nodes, near_copies.LIKENESS, 10)
    trees = set(map(tuple, found.collect()))
    joined = found.selectExpr("b as node", "a as root")
    rest = set(map(tuple, near_copies._rest(keyed, nodes, joined, found, near_copies.LIKENESS, 10).collect()))
    assert trees < trees | rest == {(k, k + 1) for k in range(0, 60, 2)} and not trees & rest


def _sets_of(rng, n, base, kept):
    """Sets of `kept` of the base's shingles each and others of their own."""
    return [np.unique(np.r_[rng.choice(base, kept, False), rng.integers(0, 1 << 62, len(base) - kept)]) for _ in range(n)]


def _likeness(a, b):
    both = len(np.intersect1d(a, b))
    return both / (len(a) + len(b) - both)


def test_forest_joins_what_all_links_join():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 200)
    sets = _sets_of(rng, 30, base, 192) + _sets_of(rng, 30, base, 184) + _sets_of(rng, 20, rng.integers(0, 1 << 62, 200), 190)
    least = near_copies.minima([s.view(np.uint64) for s in sets])
    sketches, sizes = (least >> np.uint64(56)).astype(np.uint8), np.array([len(s) for s in sets])
    root = np.array([k // 2 if k < 20 else k + 100 for k in range(len(sets))])
    likely = lambda a, b: near_copies._estimates(sketches, sizes, a, np.array([b]), near_copies.LIKENESS)[0] > 0
    n = len(sets)
    links = [(a, b) for a in range(n) for b in range(a + 1, n) if likely(a, b) and _likeness(sets[a], sets[b]) >= near_copies.LIKENESS]
    known = [(a, b) for a in range(n) for b in range(a + 1, n) if root[a] == root[b]]
    left, right = near_copies.forest(sketches, sizes, root, np.concatenate(sets), near_copies.LIKENESS)
    found = list(zip(left.tolist(), right.tolist()))
    assert found and set(found) <= set(links) and len(found) < n < len(links)
    assert brute.joined(range(n), found + known) == brute.joined(range(n), links + known)


@pytest.mark.parametrize("cell", [near_copies.CELL, 3000])
def test_pairs_below_the_likeness_never_become_rows(spark, monkeypatch, cell):
    """150 texts that are likely but not alike and 10 twins of them, under one key: only the twins' links come out, also from parts by size."""
    monkeypatch.setattr(near_copies, "CELL", cell)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 200)
    sets = _sets_of(rng, 150, base, 184)
    sets += [np.unique(np.r_[s[:-4], rng.integers(0, 1 << 62, 4)]) for s in sets[:10]]
    least = (near_copies.minima([s.view(np.uint64) for s in sets]) >> np.uint64(56)).astype(np.uint8)
    data = [(k, k, len(s), least[k].tobytes()) for k, s in enumerate(sets)]
    nodes = spark.createDataFrame(data, "h1 bigint, node bigint, n bigint, sketch binary")
    shingles = spark.createDataFrame([(k, s.tolist()) for k, s in enumerate(sets)], "node bigint, shingles array<bigint>")
    keyed = near_copies._buckets(nodes.selectExpr("7L as key", "h1"), near_copies.BUCKET)
    none = spark.createDataFrame([], "node bigint, root bigint")
    pairs = spark.createDataFrame([], "a bigint, b bigint")
    likely = near_copies._rest(keyed, nodes, none, pairs, near_copies.LIKENESS, near_copies.BUCKET).count()
    given = lambda wanted: shingles.join(wanted, "node")
    found = [(r.a, r.b) for r in near_copies._rest(keyed, nodes, none, pairs, near_copies.LIKENESS, near_copies.BUCKET, given).collect()]
    n = len(sets)
    want = [(a, b) for a in range(n) for b in range(a + 1, n) if _likeness(sets[a], sets[b]) >= near_copies.LIKENESS]
    assert brute.joined(range(n), found) == brute.joined(range(n), want)
    assert likely > 5000 and len(found) == len(want) == 10
