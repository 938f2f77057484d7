import json

import pytest
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.operators import quality
from vulnlake.plans.normalize import normalize_epss, normalize_kev, normalize_nvd

ENVELOPE = {"event_id": "e", "payload_sha256": "s", "fetched_at": "2024-06-01T00:00:00.000000Z", "ingestion_run_id": "r"}


def _read(spark, source, payloads, envelopes=None):
    """Envelopes as they come from JSON lines."""
    envelopes = envelopes or [{} for _ in payloads]
    lines = [json.dumps({**ENVELOPE, **e, "payload": p}) for p, e in zip(payloads, envelopes)]
    rows = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, v string")
    return rows.select("i", F.from_json("v", schemas.bronze(source)).alias("r")).orderBy("i").select("r.*")


def _metric(score, type_="Primary", **data):
    return {"type": type_, "cvssData": {"baseScore": score, **data}, "exploitabilityScore": 1.0, "impactScore": 2.0}


def _one(spark, metrics=None, **payload):
    return normalize_nvd(_read(spark, "nvd", [{"id": "CVE-2024-0001", "metrics": metrics, **payload}])).first()


def test_version_comes_before_type(spark):
    row = _one(spark, {"cvssMetricV40": [_metric(4.0, "Secondary")], "cvssMetricV31": [_metric(9.0)]})
    assert (row["cvss_version"], row["cvss_base_score"]) == ("4.0", 4.0)


def test_primary_comes_first_inside_a_version(spark):
    row = _one(spark, {"cvssMetricV31": [_metric(1.0, "Secondary"), _metric(2.0), _metric(3.0)]})
    assert row["cvss_base_score"] == 2.0
    assert _one(spark, {"cvssMetricV30": [_metric(1.0, "Secondary"), _metric(2.0, "Other")]})["cvss_base_score"] == 1.0


def test_null_attribute_of_the_chosen_version_stays_null(spark):
    row = _one(spark, {"cvssMetricV31": [_metric(5.0)], "cvssMetricV30": [_metric(5.0, scope="CHANGED")]})
    assert row["cvss_version"] == "3.1" and row["scope"] is None


def test_old_version_names(spark):
    item = _metric(5.0, accessVector="NETWORK", accessComplexity="LOW", authentication="NONE")
    row = _one(spark, {"cvssMetricV2": [{**item, "baseSeverity": "MEDIUM"}]})
    assert (row["cvss_version"], row["attack_vector"], row["attack_complexity"]) == ("2.0", "NETWORK", "LOW")
    assert (row["privileges_required"], row["cvss_base_severity"]) == ("NONE", "MEDIUM")
    assert row["user_interaction"] is None and row["scope"] is None


def test_missing_nested_parts(spark):
    row = _one(spark)
    assert row["cvss_version"] is None and row["cvss_base_score"] is None and row["description_en"] is None
    assert (row["cwe_ids"], row["reference_urls"], row["reference_count"], row["cpe_match_count"]) == ([], [], 0, 0)
    assert row["_reject_reason"] is None


def test_nested_values(spark):
    row = _one(
        spark,
        descriptions=[{"lang": "en", "value": "a"}, {"lang": "fr", "value": "b"}, {"lang": "en", "value": "c"}],
        weaknesses=[
            {"description": [{"lang": "en", "value": "CWE-1"}, {"lang": "es", "value": "CWE-9"}]},
            {"description": None},
            {"description": [{"lang": "en", "value": "CWE-2"}, {"lang": "en", "value": "CWE-1"}]},
        ],
        references=[{"url": "u1"}, {"url": None}],
        configurations=[{"nodes": [{"cpeMatch": [{}, {}]}, {"cpeMatch": None}]}, {"nodes": None}, {"nodes": [{"cpeMatch": [{}]}]}],
        published="2024-01-02T03:04:05.678",
    )
    assert row["description_en"] == "c" and row["cwe_ids"] == ["CWE-1", "CWE-2"]
    assert row["reference_urls"] == ["u1", None] and row["reference_count"] == 2 and row["cpe_match_count"] == 3
    assert str(row["published_at"]) == "2024-01-02 03:04:05.678000"


def test_silver_columns_match_the_tables(spark):
    for source, normalize in (("nvd", normalize_nvd), ("epss", normalize_epss), ("kev", normalize_kev)):
        silver = quality.accepted(normalize(_read(spark, source, [{}])))
        want = {f.name: f.dataType for f in schemas.silver(source).fields}
        assert {f.name: f.dataType for f in silver.schema.fields} == want


def test_nvd_reasons_in_order(spark):
    bad_score = {"cvssMetricV31": [_metric(10.5)]}
    payloads = [{"id": "x", "metrics": bad_score}] * 3 + [{"id": "CVE-2024-0001", "metrics": bad_score}, {"id": "CVE-2024-0001"}]
    envelopes = [{"event_id": None, "payload_sha256": None}, {"payload_sha256": None}, {}, {}, {}]
    got = normalize_nvd(_read(spark, "nvd", payloads, envelopes))
    assert [r["_reject_reason"] for r in got.collect()] == [
        "missing_event_id", "missing_payload_sha256", "invalid_cve_id", "invalid_cvss_score", None,
    ]
    counts = {r["reason"]: r["n"] for r in quality.reason_counts(got).collect()}
    assert counts == {"missing_event_id": 1, "missing_payload_sha256": 1, "invalid_cve_id": 1, "invalid_cvss_score": 1, None: 1}


def test_epss_reasons(spark):
    good = {"cve": "CVE-2024-0001", "epss": 0.5, "percentile": 0.5, "score_date": "2024-01-01"}
    payloads = [
        good, {**good, "epss": None}, {**good, "epss": 1.2}, {**good, "percentile": -0.1}, {**good, "cve": None},
        {**good, "score_date": "2024-13-40"}, {**good, "score_date": None},
    ]
    got = [r["_reject_reason"] for r in normalize_epss(_read(spark, "epss", payloads)).collect()]
    assert got == [None, None, "invalid_epss_value", "invalid_epss_value", "invalid_cve_id"] + ["missing_observation_date"] * 2


def test_kev_date_is_checked_before_the_id(spark):
    payloads = [
        {"cveID": "x", "dateAdded": "2024-13-40"}, {"cveID": "x", "dateAdded": "2024-01-01"}, {"cveID": "x"},
        {"cveID": "CVE-2024-0001", "dateAdded": "2024-01-01", "dueDate": "soon"},
    ]
    rows = normalize_kev(_read(spark, "kev", payloads)).collect()
    assert [r["_reject_reason"] for r in rows] == ["missing_date_added", "invalid_cve_id", "missing_date_added", None]
    assert rows[3]["due_date"] is None


@pytest.mark.parametrize("bad", ["not json", '{"event_id": 5', '{"payload": {"epss": "high"}}'])
def test_malformed_lines_are_rejected_not_lost(spark, tmp_path, bad):
    from vulnlake.sources import bronze

    good = json.dumps({**ENVELOPE, "payload": {"cve": "CVE-2024-0001", "epss": 0.1, "score_date": "2024-01-01"}})
    folder = tmp_path / "source=epss"
    folder.mkdir()
    import gzip

    with gzip.open(folder / "a.jsonl.gz", "wt") as f:
        f.write(good + "\n" + bad + "\n")
    (folder / "a.jsonl.gz.manifest.json").write_text('{\n"path": "x"\n}')
    got = normalize_epss(bronze.read_bronze(spark, str(tmp_path), "epss"))
    counts = {r["reason"]: r["n"] for r in quality.reason_counts(got).collect()}
    assert counts == {None: 1, "missing_event_id": 1}


def test_rejects_go_to_their_reason(spark, tmp_path):
    got = normalize_nvd(_read(spark, "nvd", [{"id": "x"}, {"id": "y"}, {"id": "CVE-2024-0001"}], [{}, {"event_id": None}, {}]))
    quality.write_rejected(got, f"{tmp_path}/r")
    assert {p.name for p in (tmp_path / "r").glob("reason=*")} == {"reason=invalid_cve_id", "reason=missing_event_id"}
    back = spark.read.parquet(f"{tmp_path}/r")
    assert back.count() == 2 and {"_reject_reason", "reason"} <= set(back.columns)


def test_a_metric_without_a_score_does_not_hide_a_scored_one(spark):
    from pyspark.sql import functions as F

    from vulnlake import schemas
    from vulnlake.plans import normalize

    envelope = schemas.bronze("nvd")
    payload = envelope["payload"].dataType
    metric = lambda score, version: {"type": "Primary", "cvssData": {"version": version, "baseScore": score}}
    both = {"cvssMetricV40": [metric(None, "4.0")], "cvssMetricV31": [metric(9.8, "3.1")]}
    only = {"cvssMetricV40": [metric(None, "4.0")]}
    rows = spark.createDataFrame([({"metrics": both},), ({"metrics": only},), ({"metrics": {}},)], schemas.StructType().add("payload", payload))
    got = [r.m for r in rows.select(normalize.pick_metric(F.col("payload.metrics")).alias("m")).collect()]
    assert [(m.cvss_version, m.cvss_base_score) if m else None for m in got] == [("3.1", 9.8), ("4.0", None), None]
