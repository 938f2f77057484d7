"""CVSS vectors as column expressions: version, decoding, base score and severity.

Weights and formulas are those of the public FIRST specifications for v2, v3.0 and v3.1.
A v4.0 vector is decoded and checked; its base score needs the specification's large lookup
table and stays null unless the input supplies one.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from vulnlake.functions.nested import let, strip
from vulnlake.functions.risk import round_binary

# ---- fixed values: words for the metric values -----------------------------------------------
WORDS_V3 = {
    "attack_vector": ("AV", {"N": "NETWORK", "A": "ADJACENT_NETWORK", "L": "LOCAL", "P": "PHYSICAL"}),
    "attack_complexity": ("AC", {"L": "LOW", "H": "HIGH"}),
    "privileges_required": ("PR", {"N": "NONE", "L": "LOW", "H": "HIGH"}),
    "user_interaction": ("UI", {"N": "NONE", "R": "REQUIRED"}),
    "scope": ("S", {"U": "UNCHANGED", "C": "CHANGED"}),
    "confidentiality_impact": ("C", {"H": "HIGH", "L": "LOW", "N": "NONE"}),
    "integrity_impact": ("I", {"H": "HIGH", "L": "LOW", "N": "NONE"}),
    "availability_impact": ("A", {"H": "HIGH", "L": "LOW", "N": "NONE"}),
}
WORDS_V4 = {
    "attack_vector": ("AV", {"N": "NETWORK", "A": "ADJACENT_NETWORK", "L": "LOCAL", "P": "PHYSICAL"}),
    "attack_complexity": ("AC", {"L": "LOW", "H": "HIGH"}),
    "attack_requirements": ("AT", {"N": "NONE", "P": "PRESENT"}),
    "privileges_required": ("PR", {"N": "NONE", "L": "LOW", "H": "HIGH"}),
    "user_interaction": ("UI", {"N": "NONE", "P": "PASSIVE", "A": "ACTIVE"}),
    "confidentiality_impact": ("VC", {"H": "HIGH", "L": "LOW", "N": "NONE"}),
    "integrity_impact": ("VI", {"H": "HIGH", "L": "LOW", "N": "NONE"}),
    "availability_impact": ("VA", {"H": "HIGH", "L": "LOW", "N": "NONE"}),
}

# ---- fixed values: metric weights ------------------------------------------------------------
V3_AV = {"N": 0.85, "A": 0.62, "L": 0.55, "P": 0.2}
V3_AC = {"L": 0.77, "H": 0.44}
V3_UI = {"N": 0.85, "R": 0.62}
V3_PR_UNCHANGED = {"N": 0.85, "L": 0.62, "H": 0.27}
V3_PR_CHANGED = {"N": 0.85, "L": 0.68, "H": 0.5}
V3_CIA = {"H": 0.56, "L": 0.22, "N": 0.0}
V2_AV = {"L": 0.395, "A": 0.646, "N": 1.0}
V2_AC = {"H": 0.35, "M": 0.61, "L": 0.71}
V2_AU = {"M": 0.45, "S": 0.56, "N": 0.704}
V2_CIA = {"N": 0.0, "P": 0.275, "C": 0.660}

# ---- fixed values: the metrics a vector may carry; the mandatory ones come first --------------
V3_BASE = {"AV": "NALP", "AC": "LH", "PR": "NLH", "UI": "NR", "S": "UC", "C": "HLN", "I": "HLN", "A": "HLN"}
V3_OPTIONAL = {
    "E": "XHFPU", "RL": "XUWTO", "RC": "XCRU", "CR": "XHML", "IR": "XHML", "AR": "XHML",
    "MAV": "XNALP", "MAC": "XLH", "MPR": "XNLH", "MUI": "XNR", "MS": "XUC",
    "MC": "XNLH", "MI": "XNLH", "MA": "XNLH",
}
V2_BASE = {"AV": "LAN", "AC": "HML", "Au": "MSN", "C": "NPC", "I": "NPC", "A": "NPC"}
V2_OPTIONAL_TOKENS = [
    "E:(?:U|POC|F|H|ND)", "RL:(?:OF|TF|W|U|ND)", "RC:(?:UC|UR|C|ND)",
    "CDP:(?:N|L|LM|MH|H|ND)", "TD:(?:N|L|M|H|ND)",
    "CR:(?:L|M|H|ND)", "IR:(?:L|M|H|ND)", "AR:(?:L|M|H|ND)",
]
V4_BASE = {
    "AV": "NALP", "AC": "LH", "AT": "NP", "PR": "NLH", "UI": "NPA",
    "VC": "HLN", "VI": "HLN", "VA": "HLN", "SC": "HLN", "SI": "HLN", "SA": "HLN",
}
V4_OPTIONAL = {
    "E": "XAPU", "CR": "XHML", "IR": "XHML", "AR": "XHML", "MAV": "XNALP", "MAC": "XLH",
    "MAT": "XNP", "MPR": "XNLH", "MUI": "XNPA", "MVC": "XHLN", "MVI": "XHLN", "MVA": "XHLN",
    "MSC": "XHLN", "MSI": "XSHLN", "MSA": "XSHLN", "S": "XNP", "AU": "XNY", "R": "XAUI",
    "V": "XDC", "RE": "XLMH", "U": "",
}
V4_URGENCY = "U:(?:X|Clear|Green|Amber|Red)"


def vector_version(vector: Column) -> Column:
    """Declared version; a vector without prefix that starts with AV: is 2.0; else null."""
    text = strip(vector)
    head = F.substring_index(text, "/", 1)
    return F.when(F.upper(F.substring(head, 1, 5)) == "CVSS:", head.substr(F.lit(6), F.length(head))).when(
        text.startswith("AV:"), F.lit("2.0")
    )


def parse(vector: Column) -> Column:
    """Struct of text, version and the map of metrics, split once for all later steps.

    A repeated metric keeps its last value under the session default spark.sql.mapKeyDedupPolicy =
    LAST_WIN, which `vulnlake.session` sets.
    """

    def split(text: Column) -> Column:
        return F.struct(
            text.alias("text"),
            vector_version(text).alias("version"),
            F.str_to_map(text, F.lit("/"), F.lit(":")).alias("metrics"),
        )

    return F.when(vector.isNotNull(), let(strip(vector), split))


def metric(parsed: Column, name: str) -> Column:
    """Value of one metric, null when absent."""
    return F.try_element_at(parsed["metrics"], F.lit(name))


def _lookup(key: Column, table: dict) -> Column:
    """Value of `key` in a small fixed table (a folded map literal), null when it is not there."""
    pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items())
    return F.try_element_at(F.create_map(*pairs), key)


def _word(value: Column, words: dict) -> Column:
    return F.coalesce(_lookup(F.upper(value), words), F.upper(value))


def decode(parsed: Column) -> Column:
    """Struct of the categorical columns of a parsed vector."""
    none = F.lit(None).cast("string")

    def words(table: dict, name: str) -> Column:
        return _word(metric(parsed, table[name][0]), table[name][1]) if name in table else none

    is_v4 = F.coalesce(parsed["version"].startswith("4"), F.lit(False))
    return F.struct(
        *(
            F.when(is_v4, words(WORDS_V4, name)).otherwise(words(WORDS_V3, name)).alias(name)
            for name in [*WORDS_V3, "attack_requirements"]
        )
    )


def decode_vector(vector: Column) -> Column:
    """Struct of the categorical columns; unknown values pass through in upper case."""
    return let(parse(vector), decode)


def _tokens(base: dict, optional: dict, extra: list[str] = ()) -> str:
    parts = [f"{k}:[{v}]" for k, v in {**base, **optional}.items() if v]
    return "(?:" + "|".join([*parts, *extra]) + ")"


def _well_formed(parsed: Column, prefix: str, base: dict, token: str) -> Column:
    """Only known metric tokens, each metric once, every mandatory metric present."""
    shape = parsed["text"].rlike(f"^{prefix}{token}(?:/{token})*$")
    tokens = F.length(parsed["text"]) - F.length(F.replace(parsed["text"], F.lit("/"))) + 1
    present = reduce(Column.__and__, (metric(parsed, name).isNotNull() for name in base))
    return shape & (F.size(parsed["metrics"]) == tokens) & present


def scorable(parsed: Column) -> Column:
    """True for a well-formed vector of a known version."""
    text = parsed["text"]
    v3 = _tokens(V3_BASE, V3_OPTIONAL)
    v4 = _tokens(V4_BASE, V4_OPTIONAL, [V4_URGENCY])
    v2 = _tokens(V2_BASE, {}, V2_OPTIONAL_TOKENS)
    good = (
        F.when(text.startswith("CVSS:3."), _well_formed(parsed, r"CVSS:3\.[01]/", V3_BASE, v3))
        .when(text.startswith("CVSS:4.0/"), _well_formed(parsed, r"CVSS:4\.0/", V4_BASE, v4))
        .when(text.startswith("AV:"), _well_formed(parsed, "", V2_BASE, v2))
    )
    return F.coalesce(good, F.lit(False))


def severity_band(score: Column) -> Column:
    """Qualitative band of a base score."""
    return (
        F.when(score <= 0.0, "NONE")
        .when(score < 4.0, "LOW")
        .when(score < 7.0, "MEDIUM")
        .when(score < 9.0, "HIGH")
        .when(score.isNotNull(), "CRITICAL")
    )


def _product_left(c: Column, i: Column, a: Column) -> Column:
    return F.lit(1.0) - (F.lit(1.0) - c) * (F.lit(1.0) - i) * (F.lit(1.0) - a)


def _round_up(value: Column, version: Column) -> Column:
    """One decimal upwards: v3.1 works on the value in steps of 1e-5, v3.0 on the value itself."""
    steps = F.round(value * 100000).cast("bigint")
    v31 = F.when(steps % 10000 == 0, steps / F.lit(100000.0)).otherwise(
        (F.floor(steps / F.lit(10000.0)) + 1) / F.lit(10.0)
    )
    return F.when(version == "3.1", v31).otherwise(F.ceil(value * 10 - 1e-9) / F.lit(10.0))


def _score_v3(parsed: Column) -> Column:
    changed = metric(parsed, "S") == "C"
    weights = F.struct(
        changed.alias("changed"),
        (
            F.lit(8.22)
            * _lookup(metric(parsed, "AV"), V3_AV)
            * _lookup(metric(parsed, "AC"), V3_AC)
            * F.when(changed, _lookup(metric(parsed, "PR"), V3_PR_CHANGED)).otherwise(
                _lookup(metric(parsed, "PR"), V3_PR_UNCHANGED)
            )
            * _lookup(metric(parsed, "UI"), V3_UI)
        ).alias("exploitability"),
        _product_left(*(_lookup(metric(parsed, m), V3_CIA) for m in ("C", "I", "A"))).alias("iss"),
    )

    def impact(w: Column) -> Column:
        iss = w["iss"]
        value = F.when(
            w["changed"], 7.52 * (iss - 0.029) - 3.25 * F.pow(iss - 0.02, F.lit(15.0))
        ).otherwise(6.42 * iss)
        return F.struct(w["changed"].alias("changed"), w["exploitability"].alias("expl"), value.alias("impact"))

    def final(s: Column) -> Column:
        total = F.when(s["changed"], 1.08 * (s["impact"] + s["expl"])).otherwise(s["impact"] + s["expl"])
        base = F.when(s["impact"] <= 0, F.lit(0.0)).otherwise(
            _round_up(F.least(total, F.lit(10.0)), parsed["version"])
        )
        return F.struct(
            base.cast("double").alias("base_score"),
            F.round(s["expl"], 1).alias("exploitability_score"),
            F.round(s["impact"], 1).alias("impact_score"),
        )

    return let(let(weights, impact), final)


def _score_v2(parsed: Column) -> Column:
    raw = F.struct(
        (
            F.lit(20.0)
            * _lookup(metric(parsed, "AV"), V2_AV)
            * _lookup(metric(parsed, "AC"), V2_AC)
            * _lookup(metric(parsed, "Au"), V2_AU)
        ).alias("expl"),
        (F.lit(10.41) * _product_left(*(_lookup(metric(parsed, m), V2_CIA) for m in ("C", "I", "A")))).alias("impact"),
    )

    def final(s: Column) -> Column:
        factor = F.when(s["impact"] == 0, F.lit(0.0)).otherwise(F.lit(1.176))
        base = F.round((0.6 * s["impact"] + 0.4 * s["expl"] - 1.5) * factor + 1e-9, 1)
        return F.struct(
            base.cast("double").alias("base_score"),
            round_binary(s["expl"], 1).alias("exploitability_score"),
            round_binary(s["impact"], 1).alias("impact_score"),
        )

    return let(raw, final)


def score(parsed: Column) -> Column:
    """Scores of a parsed vector; null when it is not well formed."""
    none = F.struct(
        *(F.lit(None).cast("double").alias(n) for n in ("base_score", "exploitability_score", "impact_score"))
    )
    version = parsed["version"]
    scored = (
        F.when(version == "2.0", _score_v2(parsed)).when(version.startswith("3"), _score_v3(parsed)).otherwise(none)
    )

    def shape(s: Column) -> Column:
        return F.struct(
            version.alias("version"),
            s["base_score"].alias("base_score"),
            severity_band(s["base_score"]).alias("base_severity"),
            s["exploitability_score"].alias("exploitability_score"),
            s["impact_score"].alias("impact_score"),
        )

    return F.when(scorable(parsed), let(scored, shape))


def score_vector(vector: Column) -> Column:
    """Struct version, base_score, base_severity, exploitability_score, impact_score.

    Null for a vector that is not well formed; v4.0 keeps its version with null scores.
    """
    return let(parse(vector), score)
