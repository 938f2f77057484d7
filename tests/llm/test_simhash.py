"""Operator 3 against a plain version."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from vulnlake.llm import queries, simhash

from tests.llm import brute

SF = "/root/testdata/sf0.01"


def ring(rows):
    """{(doc_id, text): (n_chars, sha256 of the edited text, next text)} for rows of distinct ids"""
    rows = sorted(rows)
    out = {}
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), after)
    return out


def votes(spark, text):
    """Fingerprint from the terms as the operator hashes them, summed one by one."""
    row = spark.createDataFrame([(text,)], "text string").select(simhash.words(F.col("text")).alias("words")).select(
        F.explode(simhash.terms(F.col("words"))).alias("t")
    ).select("t.h", F.xxhash64("t.h").alias("h2"), "t.w").collect()
    total = sum(r.w for r in row)
    out = []
    for name in ("h", "h2"):
        out.append(sum(1 << b for b in range(64) if 2 * sum(r.w for r in row if r[name] >> b & 1) > total))
    return f"{out[0]:016x}{out[1]:016x}"


def test_terms(spark):
    texts = ["a b c d e f g", "A  b\tC", "", "\n ", None]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(simhash.words(F.col("text")).alias("words"))
    rows = rows.select(simhash.terms(F.col("words")).alias("t")).collect()
    assert [None if r.t is None else len(r.t) for r in rows] == [3, 1, None, None, None]


def test_edited_texts_and_votes(spark):
    rng = random.Random(1)
    words = ["the", "Quick", "brown", "fäh", "jumps", "🙂", "over", "lazily", "\n"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in range(25)]
    texts += [None, "", "x", "same words here", "same words here"]
    docs = spark.createDataFrame(brute.rows(texts, 5), brute.DOCS).selectExpr("*", "1 as f1", "'x' as mark", "2 as part")
    got = {r.doc_id: r for r in simhash.fingerprint_documents(docs).collect()}
    want = ring([(5 + i, t) for i, t in enumerate(texts)])
    assert {i: (r.n_chars, r.edited_sha256) for i, r in got.items()} == {i: w[:2] for i, w in want.items()}
    for i, r in got.items():
        assert r.fingerprint == votes(spark, texts[i - 5] or "")
        after = got[i + 1 if i + 1 in got else 5]
        differ = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128
        assert r.near_next == differ(r.fingerprint, after.fingerprint)
        assert r.near_edited == differ(r.fingerprint, r.edited_fingerprint)


def test_repeated_rows_and_null_ids(spark):
    data = [(None, "n one", "en", "s", 1), *brute.rows(["a b", "c d"]), *brute.rows(["a b"]), (1, "other", "en", "s", 1), (None, None, None, None, None)]
    docs = spark.createDataFrame(data, brute.DOCS)
    got = simhash.fingerprint_documents(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(r[0]), len(r[1] or "")) for r in data)
    assert len({r.fingerprint for r in got if r.doc_id == 0}) == 1
    one = simhash.fingerprint_documents(docs.where("text = 'c d'")).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(3, 1.0)]
    assert simhash.fingerprint_documents(docs.limit(0)).collect() == []


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(128) for _ in range(40)]
    for x in base[:20]:
        for flips in (1, 2, 3, 4):
            y = x
            for bit in rng.sample(range(128), flips):
                y ^= 1 << bit
            base.append(y)
    signed = lambda v: (v + 2**63) % 2**64 - 2**63
    rows = [(signed(x >> 64), signed(x & (2**64 - 1))) for x in base]
    frame = spark.createDataFrame(rows + rows[:5], "f1 long, f2 long")
    asked = spark.createDataFrame(rows[:60], "f1 long, f2 long")
    got = sorted(map(tuple, simhash.near(asked, frame).collect()))
    want = sorted((*rows[i], *rows[j]) for i in range(60) for j in range(len(base)) if (base[i] ^ base[j]).bit_count() <= 3)
    assert got == want


@pytest.fixture(scope="module")
def found(spark):
    return queries.QUERIES["op3_fingerprints"](spark, SF).collect()


def test_query_on_tables(spark, found):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = ring(docs)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in found} == {i: w[:2] for i, w in want.items()}
    by_text = {}
    for i, t in docs:
        by_text.setdefault(t, set()).add(next(r.fingerprint for r in found if r.doc_id == i))
    assert all(len(v) == 1 for v in by_text.values())
    longer = [r for r in found if r.n_chars > 500]
    mean = lambda x: sum(x) / len(x)
    assert mean([r.near_edited for r in longer]) > mean([r.near_next for r in longer]) + 0.1


def test_neighbours_equal_brute_force(found):
    prints = [int(r.fingerprint, 16) for r in found]
    for r, p in zip(found, prints):
        want = sum((p ^ x).bit_count() <= 3 for x in prints) - 1 if r.doc_id % 20 == 0 else None
        assert r.n_near == want


def test_plan_has_no_python(spark):
    plan = queries.QUERIES["op3_fingerprints"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
