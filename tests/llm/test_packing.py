"""Operator 8: pieces by the public tokeniser, and sequences that are whole."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer
from vulnlake.llm import packing, queries

from tests.llm import brute

PATH = P.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def whole(rows, documents, tokenizer, capacity):
    """Checks every contract of the rows; returns the number of sequences and its lower bound."""
    want, total = [], 0
    for i, text in documents:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        total += len(ids)
        first = len(ids) % capacity or capacity
        starts = [0, *range(first, len(ids), capacity)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want.append((i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(sequences), -(-total // capacity)


def test_best_fit_takes_the_fullest_bin():
    bins, offsets, fill = packing.best_fit(np.array([6, 5, 4, 3, 2, 10]), 10)
    assert bins.tolist() == [1, 2, 1, 2, 2, 0]
    assert offsets.tolist() == [0, 0, 6, 5, 8, 0]
    assert fill.tolist() == [10, 10, 10]


def test_cut():
    assert packing.cut(5, 10) == [(0, 5)]
    assert packing.cut(10, 10) == [(0, 10)]
    assert packing.cut(11, 10) == [(0, 1), (1, 10)]
    assert packing.cut(30, 10) == [(0, 10), (10, 10), (20, 10)]


@pytest.mark.parametrize("local,group", [(1 << 16, 4096), (5, 6)])
def test_rounds_keep_every_piece(spark, tokenizer, local, group):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "it's", "x", "über", "  ", "<|endoftext|>"]) for _ in range(rng.randrange(0, 90))) for _ in range(300)]
    data = [*brute.rows([*texts, None, "", "w " * 5000]), (None, "no id", "en", "s", 5), (3, texts[3], "en", "s", 1)]
    docs = spark.createDataFrame(data, brute.DOCS).repartition(6).selectExpr("*", "1 as piece", "2 as bin", "3 as group_")
    rows = packing.pack(docs, PATH, capacity=40, local=local, group=group).collect()
    n, least = whole(rows, [r[:2] for r in data], tokenizer, 40)
    assert n <= least * 1.05 + 1
    assert packing.pack(docs.limit(0), PATH).collect() == []


def test_items_that_never_fit_together(spark, tokenizer):
    docs = spark.createDataFrame(brute.rows(["x " * 9] * 60 + ["x"]), brute.DOCS).repartition(8)
    rows = packing.pack(docs, PATH, capacity=20, local=3, group=4).collect()
    n, _ = whole(rows, [(i, "x " * 9) for i in range(60)] + [(60, "x")], tokenizer, 20)
    assert n == 60


def test_query_on_tables(spark, tokenizer):
    rows = queries.QUERIES["op8_residual_packing"](spark, SF).collect()
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    n, least = whole(rows, documents, tokenizer, 1024)
    assert n <= least * 1.01 + 1
