"""Operator 7 against the law of sizes."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from vulnlake.llm import queries, shards

from tests.llm import brute

SF = "/root/testdata/sf0.01"


def whole(rows, documents, n):
    """Checks every row; returns the shards' loads."""
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in documents
    )
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    slots, loads = defaultdict(list), [0] * n
    for r in rows:
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def test_longest_first_is_the_greedy_rule():
    assert shards.longest_first([3, 3, 2, 2, 2], 2) == [0, 1, 0, 1, 0]
    rng = random.Random(1)
    sizes = [rng.randrange(1, 1000) for _ in range(500)]
    loads = [0] * 7
    want = [0] * 500
    for i in sorted(range(500), key=lambda i: -sizes[i]):
        want[i] = loads.index(min(loads))
        loads[want[i]] += sizes[i]
    assert shards.longest_first(sizes, 7) == want
    assert max(loads) - min(loads) < 1000


def test_query_on_tables(spark):
    rows = queries.QUERIES["op7_shards"](spark, SF).collect()
    documents = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    loads = whole(rows, documents, 40)
    text = dict(documents)
    where = defaultdict(set)
    for r in rows:
        where[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    largest = max(sum(len(t.encode()) + 16 for _, t in documents if t == x) for x in text.values())
    assert max(loads) - min(loads) <= largest


def test_many_rows_are_nearly_equal(spark):
    rng = random.Random(2)
    data = brute.rows([str(i) + "x" * min(5000, int(rng.expovariate(0.01))) for i in range(20000)])
    docs = spark.createDataFrame(data, brute.DOCS)
    loads = whole(shards.shard_documents(docs).collect(), [r[:2] for r in data], 40)
    assert max(loads) < 1.001 * sum(loads) / 40


@pytest.mark.parametrize("chunk", [1000, 3])
def test_edge_cases(spark, monkeypatch, chunk):
    monkeypatch.setattr(shards, "CHUNK_ROWS", chunk)
    texts = [None, "", "a", "a", "long " * 40000, "é"] + ["copy of a text"] * 400 + [str(i) for i in range(300)]
    data = [*brute.rows(texts), (None, "a", "en", "s", 1), (2, "a", "en", "s", 1)]
    docs = spark.createDataFrame(data, brute.DOCS).selectExpr("*", "1 as shard", "2 as g", "3 as rid")
    rows = shards.shard_documents(docs, shards=5).collect()
    whole(rows, [r[:2] for r in data], 5)
    assert len({r.shard for r in rows if r.text_crc32 == zlib.crc32(b"a")}) == 1
    assert len({r.shard for r in rows if r.text_crc32 == zlib.crc32(b"copy of a text")}) == 1
    assert shards.shard_documents(docs.limit(0)).collect() == []
