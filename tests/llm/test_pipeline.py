"""The pipeline, stage by stage against plain versions, each on what its predecessor kept."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer
from vulnlake.llm import langid, queries

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_packing import whole
from tests.llm.test_secret_scan import PLANTED
from tests.llm.test_suffixes import expected

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows before every stage and after the last one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(corpus_pipeline.cut_lineage(stage(spark, out[-1], SF), f"test-{k}"))
    return out


def test_stages_return_documents(steps):
    for frame in steps[1:-1]:
        assert frame.schema.simpleString() == steps[0].schema.simpleString()


def test_language(steps):
    before = {r.doc_id: r for r in steps[0].collect()}
    kept = {r.doc_id: r for r in steps[1].collect()}
    found = {r.doc_id: r.language for r in langid.predict(steps[0], langid.train(steps[0])).collect()}
    assert set(kept) == {i for i, x in found.items() if x.lang_pred != "und" and x.score >= 0.5}
    assert all(kept[i] == before[i] for i in kept)
    assert len(kept) > 0.95 * len(before)


def test_near_duplicates(steps):
    before = {r.doc_id: r for r in steps[1].collect()}
    least = brute.joined(before, brute.alike({i: r.text for i, r in before.items()}))
    assert {r.doc_id: r for r in steps[2].collect()} == {i: before[i] for i in set(least.values())}


def test_repeated_strings(steps):
    before = steps[2].orderBy("doc_id").collect()
    after = steps[3].orderBy("doc_id").collect()
    want = expected([r.text for r in before], corpus_pipeline.PASSAGE_WINDOW, corpus_pipeline.PASSAGE_WORDS)
    for a, b, (n_bytes, n_removed, n_spans, _) in zip(before, after, want, strict=True):
        assert a.doc_id == b.doc_id and b.n_chars == len(b.text)
        assert n_bytes - n_removed <= len(b.text.encode()) <= n_bytes - n_removed + 6 * n_spans
        assert (n_removed > 0) == (a.text != b.text)


def test_secrets(steps):
    before = steps[3].orderBy("doc_id").collect()
    after = steps[4].orderBy("doc_id").collect()
    masked = 0
    for a, b in zip(before, after, strict=True):
        assert a.doc_id == b.doc_id and b.n_chars == len(b.text)
        planted = PLANTED.findall(a.text)
        masked += sum(x not in b.text for x in planted)
        if not planted:
            assert b.text == a.text
    assert masked >= 0.9 * sum(len(PLANTED.findall(a.text)) for a in before)


def test_packing(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    tokenizer.encode_special_tokens = True
    n, least = whole(steps[5].collect(), [(r.doc_id, r.text) for r in steps[4].collect()], tokenizer, 1024)
    assert n <= least * 1.02 + 1


def test_query_runs_all_stages(spark, steps):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = queries.QUERIES["pipeline"](spark, SF).select(*key).collect()
    assert sorted(got) == sorted(steps[5].select(*key).collect())


def test_nulls_and_repeated_rows(spark, tmp_path):
    data = [*brute.rows([None, "", "one text here that is short", "123"]), (None, None, None, None, None), (2, "one text here that is short", "en", "s", 1)]
    docs = spark.createDataFrame(data, brute.DOCS)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r.doc_id for r in rows] == [2]
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("name", ["language", "repeats", "row", "a.b", "Language", "spans", "key"])
def test_stages_keep_columns_of_any_name(spark, name):
    """Every stage but the last gives back a further column, whatever its name, and works on nulls and repeated rows."""
    texts = [None, "", "one text here that is short", "password = 'Tr0ub4dor9x&3zQ!' and more words", "Ein kurzer Text."]
    docs = spark.createDataFrame([*brute.rows(texts), (2, texts[2], "en", "s", 1)], brute.DOCS).selectExpr("*", f"7 as `{name}`")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        for frame in (docs, docs.limit(0)):
            done = stage(spark, frame, SF)
            assert done.columns == docs.columns
            assert {r[name] for r in done.collect()} <= {7}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 6


def test_passages_of_over_fifty_words_go(spark):
    """Passages go from all documents, the words around them stay; passages of fewer words stay whole."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("aeinrstlo") for _ in range(rng.randrange(2, 10)))
    some = lambda n: " ".join(word() for _ in range(n))
    long_, short = [some(n) for n in (55, 60, 80)], [some(n) for n in (30, 44)]
    docs = [(some(40), p, some(40)) for p in long_ + short for _ in range(3)] + [(some(100), "", "") for _ in range(10)]
    frame = spark.createDataFrame(brute.rows([" ".join(d) for d in docs]), brute.DOCS)
    stage = dict(corpus_pipeline.STAGES)["suffix_array_dedup"]
    for r in stage(spark, frame, SF).collect():
        before, passage, after = docs[r.doc_id]
        if passage in long_:
            assert r.text.startswith(before[:-10]) and r.text.endswith(after[10:]) and len(r.text) <= len(before) + len(after) + 2
        else:
            assert r.text == " ".join(docs[r.doc_id])
