"""Operator 5 against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from vulnlake.llm import queries, suffixes

from tests.llm import brute

SF = "/root/testdata/sf0.01"


def expected(texts, window, least_words=0):
    """(n_bytes, n_removed, n_spans, kept_sha256) per text; only runs of repeated bytes with so many words are removed."""
    data = [(t or "").encode() for t in texts]
    times = {}
    for d in data:
        for p in range(len(d) - window + 1):
            w = d[p : p + window]
            times[w] = times.get(w, 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - window + 1):
            if times[d[p : p + window]] > 1:
                gone[p : p + window] = b"\1" * window
        for run in re.finditer(b"\x01+", bytes(gone)):
            if len(re.findall(rb"[^\x20\x09-\x0D]+", d[run.start() : run.end()])) < least_words:
                gone[run.start() : run.end()] = bytes(run.end() - run.start())
        kept = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order_is_the_sorted_order():
    rng = random.Random(1)
    for alphabet in (b"a", b"ab", b"abcdefgh", bytes(range(256))):
        for n in (1, 2, 17, 400):
            raw = bytes(rng.choice(alphabet) for _ in range(n))
            order = suffixes.suffix_order(np.frombuffer(raw, np.uint8), n + 1)
            assert order.tolist() == sorted(range(n), key=lambda i: raw[i:])


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdefghij"])
def test_repeated_starts(alphabet):
    rng = random.Random(2)
    parts = [bytes(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(30)]
    parts += [p[3:] for p in parts[:5]]
    found = suffixes.repeated_starts(parts, 9)
    every = [p[i : i + 9] for p in parts for i in range(len(p) - 8)]
    assert found.tolist() == [every.count(w) > 1 for w in every]


def generated(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randrange(1, 9)))
    shared = ["".join(word() for _ in range(12)) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = ["".join(word() for _ in range(rng.randrange(0, 20)))]
        for _ in range(rng.randrange(0, 3)):
            s = rng.choice(shared)
            parts += [s[rng.randrange(0, 20) :], word()]
        texts.append("".join(parts))
    return [*texts, texts[0], texts[0], "ab" * 80, "c" * 90, "", None, "é" * 30]


@pytest.mark.parametrize("limit", [2048, 3])
def test_documents_equal_brute_force(spark, limit):
    texts = generated(3)
    docs = spark.createDataFrame(brute.rows(texts), brute.DOCS).selectExpr("*", "1 as spans", "'x' as mark", "2 as row")
    got = suffixes.remove_repeats(docs, window=24, gram=9, group_limit=limit).orderBy("doc_id").collect()
    assert [tuple(r.repeats)[:4] for r in got] == expected(texts, 24)
    assert [r.text for r in got] == texts
    assert got[-2].repeats.text is None
    assert got[0].repeats.text == "" and got[0].mark == "x"


def test_repeated_rows_and_ids(spark):
    texts = ["abcdefghij klmnopqr stuvwx", "something else that is long", "short"]
    data = [*brute.rows(texts), *brute.rows(texts[:1]), (None, texts[1], "en", "s", 3), (2, None, "en", "s", 0)]
    docs = spark.createDataFrame(data, brute.DOCS)
    got = suffixes.remove_repeats(docs, window=12, gram=5).collect()
    assert sorted(tuple(r.repeats)[:4] for r in got) == sorted(expected([r[1] for r in data], 12))
    assert suffixes.remove_repeats(docs.limit(0), window=12, gram=5).collect() == []


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 200)
    texts = generated(5, 10)
    texts.append("".join(t or "" for t in texts))
    data = np.frombuffer(texts[-1].encode(), np.uint8)
    docs = spark.createDataFrame(brute.rows(texts), brute.DOCS)
    got = suffixes.remove_repeats(docs, window=24, gram=9).orderBy("doc_id").collect()
    assert [tuple(r.repeats)[:4] for r in got] == expected(texts, 24)
    assert len(data) > 400


def test_whole_points():
    text = "aéb".encode()
    assert suffixes.whole_points(text, [(0, 2)]) == [(0, 1)]
    assert suffixes.whole_points(text, [(2, 4)]) == [(3, 4)]
    assert suffixes.whole_points(text, [(2, 3)]) == []


def test_query_on_tables(spark):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op5_suffix_dedup"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], expected([r.text for r in docs], 400)))
    assert got == want
    assert sum(x[1] for x in got.values()) > 0


def test_planted_passages_of_over_50_words_go_from_400_bytes_on(spark, tmp_path):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    own = lambda: " ".join(word(6) for _ in range(40))
    # 57 words and their spaces, the last word as long as it takes
    passages = {size: " ".join([word(6) for _ in range(56)] + [word(size - 56 * 7)]) for size in (399, 400, 401, 440)}
    texts = [f"{own()}{a}{p}{b}{own()}" for p in passages.values() for a, b in ("()", "[]", "{}")] + [own() for _ in range(5)]
    spark.createDataFrame(brute.rows(texts), brute.DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op5_suffix_dedup"](spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got] == expected(texts, 400)
    assert [r.n_removed for r in got] == [0] * 3 + [400] * 3 + [401] * 3 + [440] * 3 + [0] * 5
    assert all(r.n_bytes == len(t.encode()) for r, t in zip(got, texts))


def test_runs_with_few_words_stay(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 7)))
    shared = [" ".join(word() for _ in range(n)) for n in (9, 10, 11, 30)]
    texts = [" ".join(word() for _ in range(5)) + f" {s} " + " ".join(word() for _ in range(5)) for s in shared for _ in range(3)]
    docs = spark.createDataFrame(brute.rows([*texts, None, ""]), brute.DOCS).selectExpr("*", "1 as repeats")
    got = suffixes.remove_repeats(docs, window=20, gram=7, least_words=10, into="repeats_").orderBy("doc_id").collect()
    assert [tuple(r.repeats_)[:4] for r in got] == expected([*texts, None, ""], 20, 10)
    assert [r.repeats for r in got] == [1] * len(got) and len({r.repeats_.n_spans for r in got}) == 2
