"""Operator 10: the license that a place names, among similar ones."""

import pytest
from vulnlake.llm import licenses

from tests.llm import brute

CONDITIONS = dict(licenses.TEMPLATES)["BSD-3-Clause"]
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
LINE = "This work is licensed under the GNU General Public License, version {}"
CASES = [
    (LINE.format(2), {"GPL-2.0"}),
    (LINE.format(3), {"GPL-3.0"}),
    (LINE.format(4), set()),
    (CONDITIONS, {"BSD-3-Clause"}),
    (CONDITIONS.split(" 3. ")[0] + " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS", {"BSD-2-Clause"}),
    (CONDITIONS.split(" 1. ")[0], set()),
    (GNU.format("General Public License", 3), {"GPL-3.0-or-later"}),
    (GNU.format("General Public License", 2), {"GPL-2.0-or-later"}),
    (GNU.format("Affero General Public License", 3), {"AGPL-3.0-or-later"}),
    (GNU.format("Lesser General Public License", 3), {"LGPL-3.0-or-later"}),
    (f"{LINE.format(2)}. Some other words between the two lines here. {LINE.format(3)}", {"GPL-2.0", "GPL-3.0"}),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\nint x;", {"(MIT OR Apache-2.0)"}),
    ("# SPDX-License-Identifier: EPL-2.0.\n", {"EPL-2.0"}),
]


def test_every_template_names_its_license_or_leaves_it_open():
    for t, (name, text) in enumerate(licenses.TEMPLATES):
        best = {licenses.TEMPLATES[p[1]][0] for p in licenses.places([f"some words {text} and more words".encode()]) if p[5]}
        assert best == {name} or (not best and set() in licenses.distinguishing()[t])


def test_names_of_similar_licenses(spark):
    filler = "alpha beta gamma delta " * 30
    docs = spark.createDataFrame(brute.rows([f"{filler}{t} {filler}" for t, _ in CASES]), brute.DOCS)
    got = [set() for _ in CASES]
    for r in licenses.scan(docs).where("best").collect():
        got[r.doc_id].add(r.license)
    assert got == [want for _, want in CASES]


@pytest.mark.parametrize("text,n", [("a notice of our own house that nobody else has", 1), (LINE.format(3), 0)])
def test_templates_from_a_table(spark, text, n):
    templates = spark.createDataFrame([("Own-1.0", "A notice of our own house that nobody else has."), (None, "x")], "license string, text string")
    rows = licenses.scan(spark.createDataFrame(brute.rows([text]), brute.DOCS), templates=templates).collect()
    assert [(r.license, r.best) for r in rows] == [("Own-1.0", True)] * n
