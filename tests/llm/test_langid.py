"""Operator 1: held-out accuracy, and the batch product against sums in plain Python."""

import zlib

import numpy as np
from vulnlake.llm import langid, queries

from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op1_language_id"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(got) == len(docs)
    right = total = 0
    for i, lang, text in docs:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.held_out and lang is not None:
            total += 1
            right += r.lang_pred == lang
    assert right / total > 0.97


def test_scores_equal_sums_one_by_one(monkeypatch):
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b", "c"], np.log([0.2, 0.3, 0.5]), rng.normal(-5, 1, (langid.BUCKETS, 3)).astype(np.float32))
    texts = [b"x", "Hällo 12 wörld".encode(), b"a" * 50, b"short text"]
    got = langid.score(texts, model)
    monkeypatch.setattr(langid, "SPAN", 4)
    assert np.allclose(got, langid.score(texts, model))
    for t, row in zip(texts, got):
        points = langid._points(t)
        total = model.prior.copy()
        for n in langid.ORDERS:
            for k in range(len(points) - n + 1):
                total += model.table[langid._grams(points[k : k + n], n)[0]]
        want = np.exp(total - total.max())
        assert np.allclose(row, want / want.sum())


def test_edge_cases(spark):
    texts = [None, "", "123 !?", "the of and that", "der die das und", "x" * 300000, "漢字"]
    data = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate(zip(texts, [None, "en", "en", "en", "de", None, None]))]
    data += [(i, "the of and", "en", "s", 1) for i in range(100, 140)] + [(i, "der die und", "de", "s", 1) for i in range(200, 240)]
    data += [(None, "der und", "de", "s", 1), (3, "the of and that", "en", "s", 1)]
    docs = spark.createDataFrame(data, brute.DOCS).selectExpr("*", "1 as language", "2 as score")
    out = langid.predict(docs, langid.train(docs))
    assert out.columns == [*docs.columns, "language"]
    rows = [(r[0], r[-1]) for r in out.collect()]
    got = dict(rows)
    assert len(rows) == len(data)
    assert [got[i].lang_pred for i in (0, 1, 2, 3, 4)] == ["und", "und", "und", "en", "de"]
    assert got[0].score == 0.0 and got[6].lang_pred in ("en", "de")
    empty = docs.limit(0)
    assert langid.predict(empty, langid.train(empty)).collect() == []
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.language.lang_pred for r in langid.predict(unlabelled, langid.train(unlabelled)).collect()} == {"und"}


def test_training_never_sees_held_out_rows(spark):
    ids = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    docs = spark.createDataFrame([(i, "text here", "xx", "s", 1) for i in ids], brute.DOCS)
    assert langid.train(docs).languages == []
