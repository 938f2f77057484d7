"""Operator 4 against brute force."""

import numpy as np
import pytest
from vulnlake.llm import multi_index, queries

SF = "/root/testdata/sf0.01"


def brute(rows, k=20):
    """{query: [(score, id), ...]} for ids divisible by 20, over distinct (id, vector) rows"""
    rows = [(i, np.asarray(v, float)) for i, v in rows]
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            out[i] = sorted(((-(v * w).sum(), j) for j, w in rows if j != i))[:k]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r)
    assert all([r.rank for r in own] == list(range(1, len(own) + 1)) for own in out.values())
    return out


def test_radii_cover_every_split_of_errors():
    rng = np.random.default_rng(1)
    for radius in (0, 1, 7, 8, 9, 28, 29, 63):
        allowed = multi_index.radii(radius)
        for _ in range(300):
            errors = rng.multinomial(radius, rng.dirichlet(np.ones(multi_index.SUBSTRINGS)))
            assert any(e <= a for e, a in zip(errors, allowed))


def test_probing_retrieves_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    q = rng.integers(0, 2**63, 30).astype(np.uint64)
    p = rng.integers(0, 2**63, 400).astype(np.uint64)
    p[:60] = np.repeat(q, 2) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))
    vec = lambda n: np.ones((n, 1))
    for radius in (2, 26):
        allowed = multi_index.radii(radius)
        got = []
        for i in range(multi_index.SUBSTRINGS):
            if allowed[i] >= 0:
                a, b, _ = multi_index._cell(i, allowed[i], allowed, radius, 1000, (np.arange(30), q, vec(30)), (np.arange(400), p, vec(400)))
                got += list(zip(a.tolist(), b.tolist()))
        want = np.argwhere(np.bitwise_count(q[:, None] ^ p[None, :]) <= radius).tolist()
        assert sorted(got) == sorted(map(tuple, want))


def test_recall_and_scores_on_tables(spark):
    got = by_query(queries.QUERIES["op4_nearest"](spark, SF).collect())
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows)
    vectors = {i: np.asarray(v, float) for i, v in rows}
    assert set(got) == set(want)
    assert all(len(own) == 20 for own in got.values())
    hits = sum(len({r.vec_id for r in own} & {j for _, j in want[i]}) for i, own in got.items())
    assert hits / sum(map(len, want.values())) >= 0.9
    for i, own in got.items():
        for r in own:
            assert r.score == pytest.approx((vectors[i] * vectors[r.vec_id]).sum(), abs=1e-12)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def exact(spark, data, radius, blocks=None):
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").selectExpr("*", "1 as code", "'x' as node")
    return by_query(multi_index.nearest(frame, lambda x: x % 20 == 0, radius=radius).collect())


@pytest.mark.parametrize("radius", [64, 3])
def test_ties_copies_and_norms(spark, monkeypatch, radius):
    """A radius of 3 finds too little, so the search without a limit must give the same."""
    monkeypatch.setattr(multi_index, "QUERY_BLOCK", 3)
    monkeypatch.setattr(multi_index, "PART_ROWS", 40)
    rng = np.random.default_rng(3)
    data = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(150)]
    data += [(i, [1.0, 2.0, 0.0, 0.0, 1.0, 3.0]) for i in range(200, 260)]
    data = [(i, v) for i, v in data if any(v)]
    got = exact(spark, data, radius)
    want = brute(data)
    assert {i: [(r.score, r.vec_id) for r in own] for i, own in got.items()} == {i: [(-s, j) for s, j in w] for i, w in want.items()}


def test_rows_that_take_no_part(spark):
    bad = [(20, None), (40, [0.0, 0.0]), (60, [1.0, None]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (120, []), (140, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (2, [-1.0, 0.0])]
    got = exact(spark, good + bad, None)
    assert {i: [r.vec_id for r in own] for i, own in got.items()} == {0: [1, 2]}
    assert exact(spark, good[:1], None) == {}
    assert exact(spark, bad[:3], None) == {}


def test_every_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.integers(-3, 4, (2, 5, 9)[i % 3]).astype(float).tolist()) for i in range(130)]
    data = [(i, v) for i, v in data if any(v)]
    got = exact(spark, data, 64)
    want = {}
    for n in (2, 5, 9):
        want |= brute([(i, v) for i, v in data if len(v) == n])
    assert {i: [(r.score, r.vec_id) for r in own] for i, own in got.items()} == {i: [(-s, j) for s, j in w] for i, w in want.items()}
    assert {len(dict(data)[i]) for i in got} == {2, 5, 9}


def test_an_id_with_two_lengths_is_a_query_for_each(spark):
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0, 1.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0, 1.0])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    rows = multi_index.nearest(frame, lambda x: x % 20 == 0, radius=64).collect()
    assert sorted(map(tuple, rows)) == [(0, 1, 1, 2.0), (0, 1, 2, 4.0)]
