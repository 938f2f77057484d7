"""Operator 2: the forest against the rule on findings that it has not met, with hard negatives; labels of people; linear scans."""

import random
import time

import pytest
from pyspark.sql import functions as F
from vulnlake.llm import secret_scan
from vulnlake.llm.secret_examples import examples
from vulnlake.llm.tables import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").select("doc_id", "text", F.col("source").alias("path"))


@pytest.fixture(scope="module")
def scanner(docs):
    return secret_scan.learn(docs, path="path")


def _shares(truth, said):
    hits = sum(t and s for t, s in zip(truth, said))
    return hits / max(1, sum(said)), hits / max(1, sum(truth))


def test_forest_clears_what_the_rule_takes_for_secrets(docs, scanner):
    """Values and surroundings of documents that were never learned from."""
    held = docs.where(secret_scan.held_out(F.col("doc_id")))
    rows = secret_scan.planted(held, scanner.corpus, 400, seed=99).collect()
    truth = [r["label"] == 1 for r in rows]
    said = (scanner.forest.probability(secret_scan.np.array([r["features"] for r in rows])) >= secret_scan.DECISION).tolist()
    forest, rule = _shares(truth, said), _shares(truth, [r["ruled"] == 1 for r in rows])
    print(f"\nfindings {len(rows)}, forest (precision, recall) {forest}, rule {rule}")
    by_kind = {}
    for r, s in zip(rows, said):
        by_kind.setdefault((r["kind"], r["label"]), []).append((s, r["ruled"]))
    for (kind, label), own in sorted(by_kind.items(), key=lambda x: x[0][1]):
        print(f"{kind:34s} {label} n {len(own):4d} forest {sum(s for s, _ in own) / len(own):.3f} rule {sum(r for _, r in own) / len(own):.3f}")
    assert sum(s != (r["ruled"] == 1) for s, r in zip(said, rows)) > 100
    assert forest[0] > 0.95 and forest[1] > 0.95
    assert forest[0] > rule[0] + 0.05 and forest[1] > rule[1]


def test_score_is_the_forest_alone(scanner):
    """Not overridden by the rule, in either direction; a published format needs no forest."""
    text = b"primary_key=order_items_2024 password=Tr0ub4dor&3zQx " + b"AKIA" + b"A1" * 8
    found = {text[c.start : c.end]: (c, p) for c, p in scanner.scan(text, "src/a")}
    for value, (c, p) in found.items():
        own = scanner.forest.probability(secret_scan.np.array([secret_scan.features(text, c, "src/a", scanner.corpus)]))[0]
        assert p == (1.0 if secret_scan.published(value) else own)
    assert secret_scan.labelled(b"order_items_2024", b"primary_key") == 1 and found[b"order_items_2024"][1] < 0.5


def test_labels_of_people_decide(spark, docs, scanner):
    """The same findings with turned labels give a forest that says the opposite."""
    found = secret_scan.findings(docs.where(~secret_scan.held_out(F.col("doc_id"))), scanner.corpus).cache()
    turned = found.select("doc_id", "start", (1 - F.col("label")).alias("label"))
    other = secret_scan.learn(docs, path="path", labels=turned, places=0)
    rows = found.collect()
    said = other.forest.probability(secret_scan.np.array([r["features"] for r in rows])) >= 0.5
    assert sum(s == (r["label"] == 0) for s, r in zip(said, rows)) > 0.9 * len(rows)


def test_examples_are_candidates():
    rng = random.Random(1)
    seen = 0
    for kind, before, value, after, label in examples(rng, [b"corpus", b"words"]):
        assert isinstance(kind, str) and label in (0, 1)
        text = b"some words " + before + value + after + b" more words"
        seen += any(value[:4] in text[c.start : c.end] for c in secret_scan.candidates(text))
    assert seen >= 20


@pytest.mark.parametrize("line", [b"key=a://b&", b"key=", b"password='", b"token=))))))))", b"key:a:"])
def test_long_lines_are_read_once(line):
    start = time.time()
    secret_scan.candidates(line * (1_000_000 // len(line)))
    assert time.time() - start < 20


def test_values_up_to_white_space_as_before():
    text = b"token=abcdefgh12).; pwd='unclosed12 x key=a://b&key=0123456789 secret= \n12345678"
    got = [(text[c.start : c.end], c.name, c.quoted) for c in secret_scan._secret_values(text)]
    assert got == [(b"abcdefgh12", b"token", False), (b"unclosed12", b"pwd", True), (b"0123456789", b"key", False)]
