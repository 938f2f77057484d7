"""Operator 9 against brute force."""

import random

import numpy as np
import pytest
from vulnlake.llm import golay, queries

from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_codewords_meet_at_one_bit():
    values = np.random.default_rng(1).integers(0, 1 << 22, 3000)
    index, n = golay.codewords(values)
    assert set(n) <= {1, 6}
    keys = np.split(index, np.cumsum(n)[:-1])
    for bit in range(22):
        other, m = golay.codewords(values ^ (1 << bit))
        for a, b in zip(keys, np.split(other, np.cumsum(m)[:-1])):
            assert set(a) & set(b)


def test_any_two_within_two_bits_share_a_key():
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(400)]
    near = [x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for x in base]
    row, key = golay.fuzzy_keys(np.array(base + near, np.uint64).astype(np.int64))
    keys = [set(key[row == i]) for i in range(800)]
    assert all(keys[i] & keys[400 + i] for i in range(400))


def dense(n, seed):
    rng = random.Random(seed)
    center = rng.getrandbits(64)
    out = {center}
    while len(out) < n:
        x = rng.choice(sorted(out)[: n // 2]) if rng.random() < 0.5 else center
        for _ in range(rng.randrange(1, 4)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return out


@pytest.mark.parametrize("limit", [golay.GROUP_LIMIT, 20])
def test_components_of_links(spark, limit):
    rng = random.Random(3)
    values = dense(300, 4) | {rng.getrandbits(64) for _ in range(100)}
    signed = np.array(sorted(values), np.uint64).astype(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = dict(golay.stars(golay.near_links(frame, limit), "t").collect())
    want = brute.smallest_reachable([(x, x % 2**64) for x in signed], 2)
    assert {x: got.get(x, x) for x in signed} == want


def test_search_from_link_to_link_joins_the_same():
    values = np.array(sorted(dense(500, 5)), np.uint64)
    a, b = golay.spanning_links(values)
    assert len(a) < len(values)
    assert golay._near(a, b).all()


def test_documents_equal_brute_force(spark):
    got = {r[0]: (r[1], r[2]) for r in queries.QUERIES["op9_near_duplicates"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = [(i, brute.fingerprint(t)) for i, t in docs]
    least = brute.smallest_reachable(prints, 2)
    assert got == {i: (f"{p:016x}", least[i]) for i, p in prints}
    assert len({c for _, c in got.values()}) < len(got)


def test_edge_cases(spark):
    texts = [None, "", " \t\n", "one", "One", "a b", "a  b", "word " * 30000, "x y z", "É é É"]
    data = brute.rows(texts) + [(None, "one", "en", "s", 3), (4, "One", "en", "s", 3)]
    docs = spark.createDataFrame(data, brute.DOCS).selectExpr("*", "1 as fp", "2 as component_id")
    got = sorted(map(tuple, golay.near_duplicates(docs).collect()), key=str)
    prints = [(r[0] if r[0] is not None else 99, brute.fingerprint(r[1])) for r in data]
    least = brute.smallest_reachable(prints, 2)
    want = [(i, (p + 2**63) % 2**64 - 2**63, least[i if i is not None else 99]) for (i, p), r in zip(prints, data) for i in [r[0]]]
    assert got == sorted(want, key=str)
    kept = golay.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in want})
    assert golay.near_duplicates(docs.limit(0)).collect() == []
