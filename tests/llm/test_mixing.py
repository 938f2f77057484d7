"""Operator 13 against exact shares, the law of its sampling and its SQL."""

import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from vulnlake.llm import mixing, queries

from tests.check_oracle import compare, connect
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def shares(sizes, weights=(5, 2, 1), most=3):
    """Target per source, one round after the other."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        left = total - most * sum(sizes[s] for s in held)
        open_ = sum(weight[s] for s in order if s not in held)
        want = {s: Fraction(most * sizes[s]) if s in held else Fraction(weight[s] * left, open_) for s in order}
        above = {s for s in order if want[s] > most * sizes[s]}
        if not above:
            return want
        held |= above


def checked(rows, data):
    """Every document once, targets as they should be, words near them."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id, r.source, r.size) for r in rows if r.doc_id is not None) == sorted(
        (i, s, size(t)) for i, t, _, s, _ in data if i is not None)
    sizes, longest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, t, _, s, _ in data:
        sizes[s] += size(t)
        longest[s] = max(longest[s], size(t))
    want = shares(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        rate = want[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert abs(r.copies - rate) < 1
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * longest[s]
    return want


def test_query_on_tables(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = queries.QUERIES["op13_source_mix"](spark, SF).collect()
    checked(rows, data)
    assert sorted(rows) == sorted(queries.QUERIES["op13_source_mix"](spark, SF).collect())
    assert compare(queries.QUERIES["op13_source_mix"](spark, SF), connect(SF), queries.ORACLES["op13_source_mix"]) is None


def documents(rng, sizes):
    """sizes: documents per source, some of them small enough to reach their limit."""
    return [(i, " ".join("w" * rng.randrange(1, 40)) , "en", s, 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]


@pytest.mark.parametrize("sizes", [
    {"a": 3, "b": 900, "c": 900, "d": 5, None: 2}, {"a": 1, "b": 2, "c": 4, "d": 800}, {"hot": 3000, "é": 10, "z": 10, "": 10}, {"one": 50},
])
def test_limits_are_shared_out(spark, sizes):
    data = documents(random.Random(1), sizes)
    rows = mixing.mix(spark.createDataFrame(data, brute.DOCS)).collect()
    want = checked(rows, data)
    assert sum(want.values()) == sum(r.size for r in rows)


def test_nulls_repeats_and_clashing_names(spark):
    data = [(1, "a b c", "en", "s", 1)] * 500 + [(None, "x y", None, None, None)] * 200 + [(2, None, None, "empty", 1), (3, " \t\x0b", None, "empty", 1)]
    data += [(4, "long " * 300_000, None, "t", 1), (5, "e f", None, "t", 1)]
    docs = spark.createDataFrame(data, brute.DOCS).selectExpr("*", "1 as size", "2 as at", "3 as row", "4 as `a.b`", "5 as copies")
    rows = mixing.mix(docs).collect()
    checked(rows, data)
    assert sorted(rows, key=str) == sorted(mixing.mix(docs.repartition(7)).collect(), key=str)
    assert {(r.target, r.taken, r.copies) for r in rows if r.source == "empty"} == {(0.0, 0, 0)}
    copies = mixing.emit(mixing.mix(docs))
    assert copies.count() == sum(r.copies for r in rows)
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.emit(mixing.mix(docs.limit(0))).collect() == []


def test_only_empty_texts(spark):
    docs = spark.createDataFrame(brute.rows([None, "", " "]), brute.DOCS)
    assert {(r.size, r.source_size, r.target, r.taken) for r in mixing.mix(docs).collect()} == {(0, 0, 0.0, 0)}
