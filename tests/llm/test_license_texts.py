"""Operator 10: full license texts."""

import random

import pytest
from vulnlake.llm import license_texts, licenses

from tests.llm import brute

TEXTS = dict(license_texts.templates())
FIRST = len(licenses.TEMPLATES)
ALL = licenses.all_templates()


def best(text):
    return [ALL[p[1]][0] for p in licenses.places([b"", text.encode(), b"some other words of another text"], ALL) if p[5]]


def altered(text, share, seed=3):
    """The text with a share of its words replaced, in blocks of eight."""
    rng, words = random.Random(seed), text.split()
    for _ in range(int(len(words) * share / 8)):
        at = rng.randrange(len(words) - 8)
        words[at : at + 8] = ["changed"] * 8
    return " ".join(words)


@pytest.mark.parametrize("name", sorted(TEXTS))
def test_every_text_names_its_license_alone(name):
    text = TEXTS[name]
    commented = "\n".join(f" * {line}" for line in text.split("\n"))
    filler = "alpha beta gamma delta " * 700
    assert best(text) == best(commented) == best(filler + text + filler) == [name]
    assert best(altered(text, 0.06)) == [name]
    assert name not in best(altered(text, 0.8))


def test_terms_stand_without_preamble_and_appendix():
    assert "Preamble" not in TEXTS["GPL-3.0"] and "How to Apply" not in TEXTS["GPL-3.0"] + TEXTS["GPL-2.0"]
    assert "APPENDIX" not in TEXTS["Apache-2.0"] and "Exhibit A - Source" not in TEXTS["MPL-2.0"]
    assert "Remote Network Interaction" in TEXTS["AGPL-3.0"] and "Use with the GNU Affero" not in TEXTS["AGPL-3.0"]
    assert license_texts.terms("no headings here") == "no headings here" and license_texts.terms("") == ""


def test_places_of_texts_equal_brute_force():
    texts = [altered(TEXTS[n], share, seed) for seed, n in enumerate(sorted(TEXTS)) for share in (0.0, 0.1, 0.17, 0.2, 0.3)]
    got = {}
    for d, t, _, _, share in licenses.matches([x.encode() for x in texts], ALL):
        got[d, t] = max(got.get((d, t), 0), share)
    want = {}
    for d, text in enumerate(texts):
        own = licenses.WORD.findall(text.lower().encode())
        shingles = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
        for t in range(FIRST, len(ALL)):
            full = licenses.shingle_set(ALL[t][1].lower().encode())
            size = 1 << (len(full) - 1).bit_length()
            for s in range(0, len(shingles), size):
                share = len(full & set(shingles[s : s + 2 * size])) / len(full)
                if share >= licenses.CONTAINMENT:
                    want[d, t] = max(want.get((d, t), 0), share)
    assert {k: v for k, v in got.items() if k[1] >= FIRST} == want and len(want) > 20


def test_bands_and_least_counts():
    for family in licenses.families(ALL):
        for own in family.sets:
            held = -(-len(own) * 8 // 10)
            assert family.fewest <= held
            assert (1 - held / (2 * family.size + len(own) - held)) ** family.bands <= licenses.MISS * 1.01


def test_scan_of_license_files(spark):
    names = ["AGPL-3.0", "GPL-3.0", "Apache-2.0", "LGPL-2.1"]
    docs = spark.createDataFrame(brute.rows([None, "", *(TEXTS[n] for n in names)]), brute.DOCS)
    rows = licenses.scan(docs).where("best").orderBy("doc_id").collect()
    assert [(r.license, r.template >= FIRST, r.containment) for r in rows] == [(n, True, 1.0) for n in names]


def test_templates_from_a_folder(spark, tmp_path):
    (tmp_path / "Own-1.0+.txt").write_text("A notice of our own house\nthat nobody else has.")
    (tmp_path / "Other 2.txt").write_text("Another text that is held in this folder.")
    (tmp_path / "notes.md").write_text("no template at all, as its name says")
    templates = license_texts.read_templates(spark, str(tmp_path))
    assert sorted(templates.columns) == ["license", "text"]
    docs = spark.createDataFrame(brute.rows(["a notice of our own house that nobody else has"]), brute.DOCS)
    assert [r.license for r in licenses.scan(docs, templates=templates).collect()] == ["Own-1.0+"]
    assert {r.license for r in templates.collect()} == {"Own-1.0+", "Other 2"}


@pytest.mark.parametrize("text,most,message", [("four words and no", 1000, "fewer than 5"), ("five words and some more", 10, "more than 10")])
def test_unusable_templates_raise(spark, monkeypatch, text, most, message):
    monkeypatch.setattr(licenses, "MOST_TEXT", most)
    templates = spark.createDataFrame([("X", text)], "license string, text string")
    with pytest.raises(ValueError, match=message):
        licenses.scan(spark.createDataFrame(brute.rows(["x"]), brute.DOCS), templates=templates)
