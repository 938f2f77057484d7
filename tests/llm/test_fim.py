"""Operator 12: cuts against lists of lines, restored texts, and its SQL."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from vulnlake.llm import fim, queries, skip_list

from tests.check_oracle import compare, connect
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def plain(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < 50:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def random_text(rng, longest):
    return "".join(rng.choice(["\n", "\n", "a", "é", "字", "\U0001f600", "\r", " ", "word "]) for _ in range(rng.randrange(longest)))


@pytest.mark.parametrize("part", [1, 3, 64, 1 << 18])
def test_every_rank_is_reached(monkeypatch, part):
    monkeypatch.setattr(skip_list, "LANE", 3)
    rng = random.Random(part)
    for text in ["", "\n", "a", "a\n", "\n\n\n", "é\nb", *(random_text(rng, 120) for _ in range(60))]:
        lines = re.findall(r"[^\n]*\n|[^\n]+", text)
        made = skip_list.SkipList(text.encode(), part)
        assert (made.units, made.chars) == (len(lines), len(text))
        for rank in range(len(lines) + 1):
            head = "".join(lines[:rank])
            assert made.reach(rank) == (len(head), len(head.encode()))


def test_lanes_above_lanes():
    text = "".join(f"{'é' * (i % 7)}\n" for i in range(5000))
    made = skip_list.SkipList(text.encode(), 8)
    assert len(made.lanes) > 2
    ends = [i + 1 for i, c in enumerate(text) if c == "\n"]
    for rank in (1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096, 4999, 5000):
        assert made.reach(rank) == (ends[rank - 1], len(text[: ends[rank - 1]].encode()))


def test_documents_of_all_kinds(spark):
    rng = random.Random(1)
    texts = [None, "", "<P>", "a<S>b\n", "x\n<M", "<", "P>\n<P", "<<S\n>S>\n<M", "no line", "\n" * 500, "long " * 400_000 + "\n" + "é" * 100_000]
    data = [*brute.rows(texts + [random_text(rng, 200) for _ in range(300)]), (None, "a\nb\nc", None, None, None), (3, "a<S>b\n", "en", "s", 1)]
    docs = spark.createDataFrame(data, brute.DOCS).selectExpr("*", "1 as n", "2 as form", "3 as output", "4 as `a.b`", "5 as name")
    done = fim.fill_in_middle(docs)
    rows = done.select("*", fim.restore(F.col("output"), F.col("form")).alias("restored")).collect()
    want = sorted(((i, *plain(i, t), t or "") for i, t, *_ in data), key=str)
    assert sorted((tuple(r) for r in rows), key=str) == want
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(docs.limit(0)).collect() == []


def test_rates(spark):
    docs = spark.createDataFrame(brute.rows([f"a{i}\nb\n" for i in range(400)]), brute.DOCS)
    forms = [r.form for r in fim.fill_in_middle(docs, rate=30, suffix_first=100).collect()]
    assert set(forms) == {"plain", "spm"} and 60 < forms.count("spm") < 180


def test_query_on_tables(spark):
    run, sql = queries.QUERIES["op12_fill_in_middle"], queries.ORACLES["op12_fill_in_middle"]
    assert compare(run(spark, SF), connect(SF), sql) is None
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in run(spark, SF).collect():
        n, form, prefix, middle, output = plain(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
