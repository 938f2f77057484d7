"""All base vectors of v2 and v3 against decimal arithmetic written out from the specifications."""

import itertools
import math
from decimal import ROUND_HALF_UP, Decimal as D

from pyspark.sql import functions as F

from vulnlake.functions import cvss


def _scores(spark, vectors):
    rows = spark.createDataFrame([(v,) for v in vectors], "v string")
    out = rows.select("v", cvss.score_vector(F.col("v")).alias("s")).collect()
    return {r["v"]: r["s"] for r in out}


def _v3(version, v):
    d = lambda table, k: D(str(table[k]))
    changed = v["S"] == "C"
    iss = 1 - (1 - d(cvss.V3_CIA, v["C"])) * (1 - d(cvss.V3_CIA, v["I"])) * (1 - d(cvss.V3_CIA, v["A"]))
    if changed:
        impact = D("7.52") * (iss - D("0.029")) - D("3.25") * (iss - D("0.02")) ** 15
    else:
        impact = D("6.42") * iss
    pr = cvss.V3_PR_CHANGED if changed else cvss.V3_PR_UNCHANGED
    expl = D("8.22") * d(cvss.V3_AV, v["AV"]) * d(cvss.V3_AC, v["AC"]) * d(pr, v["PR"]) * d(cvss.V3_UI, v["UI"])
    if impact <= 0:
        base = 0.0
    else:
        total = min((D("1.08") if changed else D(1)) * (impact + expl), D(10))
        if version == "3.1":
            steps = int((total * 100000).quantize(D(1), ROUND_HALF_UP))
            base = steps / 100000 if steps % 10000 == 0 else (steps // 10000 + 1) / 10
        else:
            base = math.ceil(total * 10) / 10
    return base, round(float(expl), 1), round(float(impact), 1)


def test_every_v3_base_vector(spark):
    names = list(cvss.V3_BASE)
    expected = {}
    for version in ("3.0", "3.1"):
        for values in itertools.product(*cvss.V3_BASE.values()):
            v = dict(zip(names, values))
            text = f"CVSS:{version}/" + "/".join(f"{k}:{x}" for k, x in v.items())
            expected[text] = _v3(version, v)
    got = _scores(spark, expected)
    for text, (base, expl, impact) in expected.items():
        s = got[text]
        assert (s["base_score"], s["exploitability_score"], s["impact_score"]) == (base, expl, impact), text


def test_every_v2_base_vector(spark):
    names = list(cvss.V2_BASE)
    expected = {}
    for values in itertools.product(*cvss.V2_BASE.values()):
        v = dict(zip(names, values))
        expl = 20 * D(str(cvss.V2_AV[v["AV"]])) * D(str(cvss.V2_AC[v["AC"]])) * D(str(cvss.V2_AU[v["Au"]]))
        c, i, a = (1 - D(str(cvss.V2_CIA[v[m]])) for m in "CIA")
        impact = D("10.41") * (1 - c * i * a)
        factor = D(0) if impact == 0 else D("1.176")
        base = ((D("0.6") * impact + D("0.4") * expl - D("1.5")) * factor).quantize(D("0.1"), ROUND_HALF_UP)
        expected["/".join(f"{k}:{x}" for k, x in v.items())] = (
            abs(float(base)),
            round(20.0 * cvss.V2_AV[v["AV"]] * cvss.V2_AC[v["AC"]] * cvss.V2_AU[v["Au"]], 1),
            round(float(impact), 1),
        )
    got = _scores(spark, expected)
    for text, want in expected.items():
        s = got[text]
        assert (s["base_score"], s["exploitability_score"], s["impact_score"]) == want, text
        assert s["version"] == "2.0"


def test_known_vectors(spark):
    known = {
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H": (9.8, 3.9, 5.9, "CRITICAL"),
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:C/C:H/I:H/A:H": (10.0, 3.9, 6.0, "CRITICAL"),
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:R/S:C/C:L/I:L/A:N": (6.1, 2.8, 2.7, "MEDIUM"),
        "AV:N/AC:M/Au:N/C:P/I:P/A:P": (6.8, 8.6, 6.4, "MEDIUM"),
        "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:N/I:N/A:N": (0.0, 3.9, 0.0, "NONE"),
    }
    got = _scores(spark, known)
    for text, want in known.items():
        s = got[text]
        assert (s["base_score"], s["exploitability_score"], s["impact_score"], s["base_severity"]) == want


def test_malformed_vectors_are_null(spark):
    bad = [
        "", "garbage", "CVSS:3.1/AV:N", "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:X",
        "CVSS:3.1/AV:N/AV:L/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H", "CVSS:3.2/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H",
        "AV:N/AC:L/Au:N/C:C/I:C", "cvss:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H",
        "CVSS:4.0/AV:N/AC:L/AT:N/PR:N/UI:N/VC:H/VI:H/VA:H/SC:N/SI:N",
    ]
    assert all(s is None for s in _scores(spark, bad).values())


def test_v4_is_decoded_without_a_base_score(spark):
    text = " CVSS:4.0/AV:N/AC:L/AT:P/PR:N/UI:P/VC:H/VI:L/VA:N/SC:N/SI:N/SA:N "
    row = (
        spark.createDataFrame([(text,)], "v string")
        .select(cvss.score_vector(F.col("v")).alias("s"), cvss.decode_vector(F.col("v")).alias("d"))
        .first()
    )
    assert row["s"]["version"] == "4.0" and row["s"]["base_score"] is None and row["s"]["base_severity"] is None
    d = row["d"]
    assert (d["attack_requirements"], d["user_interaction"], d["scope"]) == ("PRESENT", "PASSIVE", None)
    assert (d["confidentiality_impact"], d["integrity_impact"], d["availability_impact"]) == ("HIGH", "LOW", "NONE")


def test_decoding(spark):
    rows = spark.createDataFrame(
        [("CVSS:3.0/AV:A/AC:H/PR:L/UI:R/S:C/C:L/I:N/A:H",), ("AV:N/AC:M/Au:S/C:P/I:C/A:N",), ("AV:n/AC:L/AC:H",)],
        "v string",
    )
    d3, d2, odd = [r[0] for r in rows.select(cvss.decode_vector(F.col("v"))).collect()]
    assert (d3["attack_vector"], d3["scope"], d3["user_interaction"]) == ("ADJACENT_NETWORK", "CHANGED", "REQUIRED")
    # v2 values without a v3 word pass through.
    assert (d2["attack_complexity"], d2["confidentiality_impact"], d2["integrity_impact"]) == ("M", "P", "C")
    assert d2["privileges_required"] is None
    assert (odd["attack_vector"], odd["attack_complexity"]) == ("NETWORK", "HIGH")


def test_versions(spark):
    vectors = ["CVSS:3.1/AV:N", "CVSS:4.0/AV:N", "AV:N/AC:L", "x", "cvss:3.0/AV:N", "  CVSS:3.0/AV:L "]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "i int, v string")
    got = [r[0] for r in rows.orderBy("i").select(cvss.vector_version(F.col("v"))).collect()]
    assert got == ["3.1", "4.0", "2.0", None, "3.0", "3.0"]


def test_severity(spark):
    rows = spark.createDataFrame([(0.0,), (3.9,), (4.0,), (6.9,), (7.0,), (8.9,), (9.0,), (None,)], "s double")
    got = [r[0] for r in rows.select(cvss.severity_band(F.col("s"))).collect()]
    assert got == ["NONE", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL", None]
