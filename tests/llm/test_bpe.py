"""Operator 6 against the public library and by exact round trips."""

import hashlib
import random
import unicodedata

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from vulnlake.llm import bpe, queries

from tests.llm import brute

PATH = P.path("byte_bpe_multi_50k.tiktoken")
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def same(library, texts):
    got = [
        part.tolist()
        for ids, counts in bpe.coder(PATH).encode([t.encode() for t in texts])
        for part in np.split(ids, np.cumsum(counts)[:-1])
    ]
    assert len(got) == len(texts)
    want = [library.encode_ordinary(t) for t in texts]
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_every_assigned_character_in_context(library):
    points = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    rng = random.Random(1)
    for context in ("a{}a", "1{}1", "!{}!", " {}", "{} x", "  {}'s", "'{}"):
        same(library, ["\n".join(context.format(c) for c in rng.sample(points, 3000))])


def test_random_strings(library):
    rng = random.Random(2)
    parts = ["a", "s", "t", "re", "ve", "ll", "d", "m", "'", "''", " ", "  ", "\n", "\t", " ", "é", "ß", "1", "٣", "!", "…", "漢", "🙂", "r", "v", "l", "e", "\0"]
    same(library, ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 30))) for _ in range(20000)])


def test_edges(library):
    same(library, ["", " ", "  ", "a ", "a  ", " a", "it's", "'s", "'re", "'r", "x'", "''s", " 's", "\n\n a", "<|endoftext|>"])
    same(library, ["'l", "l", "'v", "e", "abc", "z" * 5000, "ab" * 3000, "!" * 2000])


def test_long_text_in_parts(library, monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["it's ", "  ", "we'll", "x" * 30, "\n\n", "12 ", "?!"]) for _ in range(400))
    monkeypatch.setattr(bpe, "SCAN", 50)
    same(library, [text, "y" * 400, " " * 300 + "a"])


def test_scan_is_the_step_by_step_result():
    rng = np.random.default_rng(4)
    basic, compose, leads, _ = bpe._monoid()
    kinds = rng.integers(0, 9, 10000)
    state, want = 0, []
    for k in kinds.tolist():
        state = bpe._step(state, k)
        want.append(state)
    assert leads[bpe._scan(basic[kinds], compose)].tolist() == want


def test_offsets_and_decoding(spark):
    texts = ["It's a test, naïve 漢字!", None, "", "x"]
    docs = spark.createDataFrame(brute.rows(texts), brute.DOCS).selectExpr("*", "1 as coded", "2 as row")
    got = bpe.encode(docs, PATH).orderBy("doc_id").collect()
    c = bpe.coder(PATH)
    for row, text in zip(got, texts):
        raw = (text or "").encode()
        ids, offsets = row[-1]
        assert c.decode(np.array(ids, np.int64)) == raw
        assert [raw[a:b] for a, b in zip(offsets, offsets[1:])] == [c.decode(np.array([i])) for i in ids]
        assert offsets[-1] == len(raw)
    assert bpe.encode(docs.limit(0), PATH).collect() == []
    assert bpe.round_trip(docs.select("text"), PATH).count() == 4


def test_query_on_tables(spark, library):
    got = {r[0]: tuple(r)[1:] for r in queries.QUERIES["op6_byte_bpe"](spark, SF).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    for i, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(text or "")
        assert got.pop(i) == (len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode()))
    assert not got
