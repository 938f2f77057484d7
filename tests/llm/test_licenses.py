"""Operator 10: every window against every template by brute force."""

import random

import numpy as np
from vulnlake.llm import licenses, queries

from tests.llm import brute

SF = "/root/testdata/sf0.01"


def expected(text):
    """{(template, containment)} over all windows, without bands"""
    own = licenses.WORD.findall((text or "").lower().encode())
    shingles = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    out = {}
    for t, (_, template) in enumerate(licenses.TEMPLATES):
        want = licenses.shingle_set(template.lower().encode())
        size = 1 << (len(want) - 1).bit_length()
        for s in range(0, len(shingles), size):
            share = len(want & set(shingles[s : s + 2 * size])) / len(want)
            if share >= licenses.CONTAINMENT:
                out[t] = max(out.get(t, 0), share)
    return set(out.items())


def generated():
    rng = random.Random(1)
    filler = lambda n: " ".join(rng.choice(["alpha", "beta", "the", "License", "under", "of", "work", "é"]) for _ in range(n))
    texts = []
    for k in range(120):
        template = licenses.TEMPLATES[k % len(licenses.TEMPLATES)][1].split()
        for _ in range(rng.randrange(0, 1 + len(template) // 12)):
            template[rng.randrange(len(template))] = "changed"
        texts.append(f"{filler(rng.randrange(0, 300))} {' '.join(template)} {filler(rng.randrange(0, 300))}")
    return texts


def test_places_equal_brute_force():
    texts = generated()
    best = {}
    for d, t, a, b, share in licenses.matches([x.encode() for x in texts]):
        best[d, t] = max(best.get((d, t), 0), share)
        held = licenses.shingle_set(texts[d].encode()[a:b].lower())
        assert share <= len(held & licenses.shingle_set(licenses.TEMPLATES[t][1].lower().encode())) / len(
            licenses.shingle_set(licenses.TEMPLATES[t][1].lower().encode())
        )
    got = [{(t, s) for (d, t), s in best.items() if d == k} for k in range(len(texts))]
    assert got == [expected(t) for t in texts]
    assert sum(map(len, got)) > 80


def test_bands_reach_the_promised_probability():
    for family in licenses.families():
        for own in family.sets:
            held = -(-len(own) * 8 // 10)
            similarity = held / (2 * family.size + len(own) - held)
            assert (1 - similarity) ** family.bands <= licenses.MISS * 1.01


def test_two_places_are_two_rows():
    text = ("Released under the MIT License. " + "some other words here now " * 20) * 2
    rows = licenses.matches([b"", text.encode(), b"Released under the MIT License"])
    assert [(d, licenses.TEMPLATES[t][0], share) for d, t, _, _, share in rows] == [(1, "MIT", 1.0), (1, "MIT", 1.0), (2, "MIT", 1.0)]
    assert [text[a:b] for d, _, a, b, _ in rows if d == 1] == ["Released under the MIT License"] * 2


def test_hash_of_words_and_shingles():
    starts, ends, value = licenses.words(b"one two, one\xc3\xa9 one two")
    assert [(int(a), int(b)) for a, b in zip(starts, ends)] == [(0, 3), (4, 7), (9, 14), (15, 18), (19, 22)]
    assert value[0] == value[3] and value[1] == value[4] and len(set(value.tolist())) == 3
    assert len(licenses.chained(value)) == 1 and len(licenses.chained(value[:4])) == 0
    assert np.array_equal(licenses.permuted(value, 1)[[0, 1]], licenses.permuted(value, 1)[[3, 4]])


def test_edge_cases(spark):
    texts = [None, "", "short", "Licensed under CC BY-NC 4.0.", "word " * 50000 + "Released under the MIT License. " + "word " * 50000]
    data = [*brute.rows(texts), (None, texts[3], None, None, None), (3, texts[3], "en", "s", 1)]
    docs = spark.createDataFrame(data, brute.DOCS).selectExpr("*", "1 as license", "2 as start")
    got = sorted((str(r.doc_id), r.license) for r in licenses.scan(docs).collect())
    assert got == [("3", "CC-BY-NC-4.0"), ("3", "CC-BY-NC-4.0"), ("4", "MIT"), ("None", "CC-BY-NC-4.0")]
    assert licenses.scan(docs.limit(0)).collect() == []


def test_query_on_tables(spark):
    got = {}
    for r in queries.QUERIES["op10_license_scan"](spark, SF).collect():
        key = (r.template, r.containment)
        got.setdefault(r.doc_id, {})
        got[r.doc_id][r.template] = max(got[r.doc_id].get(r.template, 0), key[1])
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {i: dict(e) for i, t in docs if (e := expected(t))}
    assert got == want and len(want) > 0
