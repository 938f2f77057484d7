import base64
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vulnlake.operators import quality
from vulnlake.plans import ingest, validate
from vulnlake.sources import bronze, catalog, messages, osv, scores

AT = "2024-06-02 01:02:03"
V31 = "CVSS:3.1/AV:N/AC:L/PR:N/UI:N/S:U/C:H/I:H/A:H"
V30 = "CVSS:3.0/AV:N/AC:L/PR:N/UI:R/S:C/C:L/I:L/A:N"
V2 = "AV:N/AC:M/Au:N/C:P/I:P/A:P"
V4 = "CVSS:4.0/AV:N/AC:L/AT:N/PR:N/UI:N/VC:H/VI:H/VA:H/SC:N/SI:N/SA:N"


def _docs():
    return {
        "CVE-2024-0001": {
            "summary": " one ", "details": "two\n", "published": "2024-01-02T03:04:05.987654321Z", "modified": "2024-02-01T00:00:00Z",
            "severity": [{"type": "x", "score": s} for s in (V2, V31, "junk", "", V31.replace("C:H", "C:N"), V4, V30)],
            "references": [{"type": "WEB", "url": "u"}, {"type": "WEB"}, {"type": "WEB", "url": ""}],
            "affected": [{"database_specific": {"cpes": ["a", "b"]}}, {"database_specific": None}],
            "database_specific": {"cwe_ids": ["CWE-1", None, "", "CWE-1"], "unresolved_ranges": [{"cpes": ["b", "c", ""]}, {}]},
        },
        "CVE-2024-0002": {"withdrawn": "2024-01-01T00:00:00Z"},
        "CVE-2024-0003": {"details": "  ** REJECT ** x"},
        "CVE-2024-0004": {"details": "Rejected reason: x"},
        "CVE-2024-0005": {"details": "** RESERVED ** x"},
        "CVE-2024-0006": {"details": "only ** REJECT ** inside", "withdrawn": "", "database_specific": {"cna_assigner": "me"}},
        "": {"summary": "no id"},
    }


@pytest.fixture(scope="module")
def osv_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("osv")
    for i, (id_, doc) in enumerate(_docs().items()):
        (folder / f"{i}.json").write_text(json.dumps({"id": id_, **doc}, indent=2))
    (folder / "broken.json").write_text('{"id": "CVE-2024-9999", ')
    (folder / "notes.txt").write_text("ignored")
    return str(folder)


def test_osv_files_and_status(spark, osv_dir):
    docs = osv.read_osv(spark, osv_dir)
    assert docs.count() == 8
    status = osv.doc_status(F.col("id"), F.col("withdrawn"), F.col("details"))
    stats = quality.status_counts(docs, F.lit("nvd"), status).first()
    assert (stats["fetched"], stats["published"], stats["skipped"], stats["invalid"]) == (8, 2, 4, 2)
    assert osv.read_osv(spark, osv_dir, max_records=3).count() == 3


def test_osv_to_nvd(spark, osv_dir):
    rows = {r["id"]: r for r in osv.adapt(osv.read_osv(spark, osv_dir)).select("payload.*").collect()}
    one = rows["CVE-2024-0001"]
    assert one["descriptions"][0]["value"] == "one\n\ntwo" and one["sourceIdentifier"] == "osv.dev"
    assert (one["published"], one["lastModified"]) == ("2024-01-02T03:04:05.987", "2024-02-01T00:00:00.000")
    m = one["metrics"]
    assert [x["cvssData"]["baseScore"] for x in m["cvssMetricV31"]] == [9.8, 9.1]
    assert m["cvssMetricV30"][0]["cvssData"]["baseScore"] == 6.1 and m["cvssMetricV30"][0]["cvssData"]["scope"] == "CHANGED"
    v2 = m["cvssMetricV2"][0]
    assert (v2["baseSeverity"], v2["cvssData"]["accessVector"], v2["cvssData"]["authentication"]) == ("MEDIUM", "NETWORK", None)
    v4 = m["cvssMetricV40"][0]
    assert v4["cvssData"]["baseScore"] is None and v4["cvssData"]["version"] == "4.0"
    assert [w["description"][0]["value"] for w in one["weaknesses"]] == ["CWE-1", "CWE-1"]
    assert [r["url"] for r in one["references"]] == ["u"]
    cpes = one["configurations"][0]["nodes"][0]["cpeMatch"]
    assert [c["criteria"] for c in cpes] == ["b", "c", "a"] and all(c["vulnerable"] for c in cpes)
    six = rows["CVE-2024-0006"]
    assert six["sourceIdentifier"] == "me" and six["vulnStatus"] == "Published"
    assert (six["weaknesses"], six["references"], six["configurations"]) == ([], [], [])
    assert all(six["metrics"][k] is None for k in ("cvssMetricV40", "cvssMetricV31", "cvssMetricV30", "cvssMetricV2"))
    assert rows["CVE-2024-0002"]["vulnStatus"] == "Withdrawn" and rows["CVE-2024-0002"]["descriptions"] == []


def test_osv_envelopes(spark, osv_dir):
    out = ingest.osv_envelopes(osv.read_osv(spark, osv_dir), "run", F.lit(AT).cast("timestamp"))
    rows = {r["source_record_id"]: r for r in out.collect()}
    assert set(rows) == {"CVE-2024-0001", "CVE-2024-0006"}
    assert rows["CVE-2024-0001"]["effective_date"] == "2024-01-02"
    # without a publication date the fetch date stands in
    assert rows["CVE-2024-0006"]["effective_date"] == "2024-06-02"
    r = rows["CVE-2024-0001"]
    identity = f"nvd|CVE-2024-0001|2024-01-02|{r['payload_sha256']}"
    assert r["event_id"] == hashlib.sha256(identity.encode()).hexdigest()


@pytest.fixture(scope="module")
def scores_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("epss")
    body = "cve,epss,percentile\nCVE-2024-0001,0.00432,0.73421\nCVE-2024-0002,,0.1\nCVE-2024-0003,x,0.1\nCVE-2024-0004,1.2,0.1\nCVE-2024-0005,0.5,\n,0.1,0.1\nCVE-2024-0006,0.1,nan\n\n"
    with gzip.open(folder / "epss_scores-2024-06-01.csv.gz", "wt") as f:
        f.write("#model_version:v2024.01.01,score_date:2024-05-31T00:00:00+0000\n" + body)
    with gzip.open(folder / "epss_scores-2024-06-02.csv.gz", "wt") as f:
        f.write("CVE-2024-0001,0.2,0.3\r\n")
    return str(folder)


def test_score_files(spark, scores_dir):
    rows = scores.typed_scores(scores.read_score_files(spark, scores_dir)).collect()
    got = {(r["cve"], str(r["score_date"])): r for r in rows}
    assert len(rows) == 8
    first = got[("CVE-2024-0001", "2024-05-31")]
    assert (first["epss_value"], first["percentile_value"], first["model_version"]) == (0.00432, 0.73421, "v2024.01.01")
    second = got[("CVE-2024-0001", "2024-06-02")]
    assert (second["epss_value"], second["model_version"], second["status"]) == (0.2, "", "published")
    assert got[("CVE-2024-0005", "2024-05-31")]["percentile_value"] == 0.0
    bad = {r["cve"] for r in rows if r["status"] == "invalid"}
    assert bad == {"CVE-2024-0002", "CVE-2024-0003", "CVE-2024-0004", None, "CVE-2024-0006"}


def test_score_files_are_chosen_by_date_before_they_are_read(spark, scores_dir):
    read = lambda **k: scores.read_score_files(spark, scores_dir, **k)
    assert {r["cve"] for r in read(start="2024-06-02").collect()} == {"CVE-2024-0001"}
    assert read(end="2024-06-01").count() == 7 and read(days_of_month=[1, 15]).count() == 7
    assert read(start="2024-06-03").count() == 0
    first = read(end="2024-06-01")
    first.collect()
    node = first._jdf.queryExecution().executedPlan().toString()
    assert "file_name" in node


def test_score_envelopes(spark, scores_dir):
    typed = scores.typed_scores(scores.read_score_files(spark, scores_dir))
    rows = ingest.score_envelopes(typed, "run", F.lit(AT).cast("timestamp")).collect()
    assert {r["source_record_id"] for r in rows} == {
        "CVE-2024-0001|2024-05-31", "CVE-2024-0005|2024-05-31", "CVE-2024-0001|2024-06-02"
    }


@pytest.fixture(scope="module")
def catalog_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("kev") / "catalog.json"
    entries = [
        {"cveID": "CVE-2024-0001", "dateAdded": "2024-01-05", "cwes": ["CWE-1"]}, {"cveID": "CVE-2024-0002"},
        {"dateAdded": "2024-01-05"}, {"cveID": "CVE-2024-0003", "dateAdded": "2024-13-40"},
        {"cveID": "CVE-2024-0004", "dateAdded": "2023-01-05"}, {"cveID": "CVE-2024-0005", "dateAdded": "2025-01-05"},
    ]
    path.write_text(json.dumps({"catalogVersion": "v7", "dateReleased": "2024-06-01T00:00:00Z", "vulnerabilities": entries}, indent=1))
    return str(path)


def test_catalog(spark, catalog_file):
    rows = catalog.explode_catalog(catalog.read_catalog(spark, catalog_file))
    assert rows.count() == 6 and {r[0] for r in rows.select("catalog_version").collect()} == {"v7"}
    status = catalog.entry_status(F.col("cveID"), F.col("dateAdded"), "2024-01-01", "2024-12-31")
    got = {(r["status"], r["n"]) for r in rows.groupBy(status.alias("status")).agg(F.count("*").alias("n")).collect()}
    assert got == {("published", 1), ("invalid", 3), ("skipped", 2)}
    out = ingest.catalog_envelopes(rows, "run", F.lit(AT).cast("timestamp"), "2024-01-01", "2024-12-31").collect()
    assert [r["source_record_id"] for r in out] == ["CVE-2024-0001"]
    assert out[0]["source_modified_at"] == "2024-01-05T00:00:00.000000Z" and out[0]["payload"]["catalog_version"] == "v7"


def test_ingest_writes_bronze_and_manifest(spark, osv_dir, scores_dir, catalog_file, tmp_path):
    root = str(tmp_path / "bronze")
    ingest.run_ingest(
        spark, root, run_id="r1", fetched_at=AT, osv_dir=osv_dir, scores_dir=scores_dir, catalog_path=catalog_file
    )
    for source, n in (("nvd", 2), ("epss", 3), ("kev", 3)):
        rows = bronze.read_bronze(spark, root, source)
        assert rows.count() == n
        first = rows.first()
        assert (first["source"], first["ingestion_run_id"], first["run_id"]) == (source, "r1", "r1")
        manifest = bronze.read_manifest(spark, f"{root}/_manifests/source={source}")
        assert manifest.agg(F.sum("record_count")).first()[0] == n
        assert quality.integrity_summary(quality.file_report(bronze.file_facts(spark, root, source), manifest)).first()["passed"]
    summary = validate.validate_bronze(spark, root, f"{root}/_manifests").first()
    assert summary["passed"] and summary["records_total"] == 8 and summary["duplicate_event_ids"] == 0
    # A second run adds its own files to the manifest and leaves the first ones alone.
    ingest.run_ingest(spark, root, run_id="r2", fetched_at=AT, catalog_path=catalog_file)
    manifest = bronze.read_manifest(spark, f"{root}/_manifests/source=kev")
    report = quality.file_report(bronze.file_facts(spark, root, "kev"), manifest)
    summary = quality.integrity_summary(report).first()
    assert summary["passed"] and summary["records_total"] == 6 and manifest.count() == summary["files_checked"]
    assert validate.validate_bronze(spark, root, f"{root}/_manifests").first()["duplicate_event_ids"] == 3


def test_files_roll_over(spark, tmp_path):
    rows = spark.range(25).coalesce(1).select(
        F.col("id").cast("string").alias("event_id"), F.lit("epss").alias("source"), F.lit("r").alias("ingestion_run_id")
    )
    bronze.write_bronze(rows, str(tmp_path), "epss", "2024-06-01", max_records=10)
    files = list((tmp_path / "source=epss" / "ingest_date=2024-06-01" / "run_id=r").glob("*.json.gz"))
    assert len(files) == 3
    assert bronze.records_per_file(1000) == 10_000 and bronze.records_per_file(1024 * 1024) == 64
    assert bronze.records_per_file(10**9) == 1


def _write(path, lines, cut=None):
    data = gzip.compress(("\n".join(lines) + "\n").encode())
    path.write_bytes(data if cut is None else data[:cut])
    return hashlib.sha256(path.read_bytes()).hexdigest()


def test_file_report_finds_every_defect(spark, tmp_path):
    folder = tmp_path / "source=epss" / "ingest_date=2024-06-01" / "run_id=r"
    folder.mkdir(parents=True)
    lines = [json.dumps({"event_id": f"e{i}", "pad": "x" * 50 * i}) for i in range(40)]
    sha = {name: _write(folder / f"{name}.jsonl.gz", lines) for name in ("good", "alone", "hash", "count", "blank")}
    sha["blank"] = _write(folder / "blank.jsonl.gz", [lines[0], "", lines[1]])
    sha["short"] = _write(folder / "short.jsonl.gz", lines, cut=-20)
    said = [("good", sha["good"], 40), ("hash", "0", 40), ("count", sha["count"], 39), ("blank", sha["blank"], 2), ("short", sha["short"], 40)]
    manifest = spark.createDataFrame(
        [(f"file:{folder}/{n}.jsonl.gz", "epss", c, h, AT) for n, h, c in said],
        "path string, source string, record_count bigint, sha256 string, created_at string",
    ).withColumn("path", bronze._canonical(F.col("path")))
    report = quality.file_report(bronze.file_facts(spark, str(tmp_path), "epss"), manifest)
    got = {r["path"].rsplit("/", 1)[1].split(".")[0]: r["status"] for r in report.collect()}
    assert got == {
        "good": "ok", "alone": "missing_manifest", "hash": "sha256_mismatch", "count": "record_count_mismatch",
        "blank": "ok", "short": "unreadable",
    }
    summary = quality.integrity_summary(report).first()
    assert not summary["passed"] and summary["files_checked"] == 6 and summary["parse_errors"] == 1
    assert summary["records_total"] == 40 * 3 + 2


def test_duplicate_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("",), ("",)], "event_id string")
    assert [tuple(r) for r in quality.duplicate_ids(df).collect()] == [("a", 2)]


def test_messages(spark):
    rows = [
        ("t.nvd", 0, 1, b'{"event_id": "a", "n": 1}'), ("t.nvd", 0, 2, b'{"event_id": "a"'), ("t.kev", 1, 3, b'{"n": 2}'),
        ("t.kev", 1, 4, None), ("t.other", 1, 5, b"{}"), ("t.kev", 1, 6, b'{"event_id": "b", "n": "x"}'),
    ]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value binary")
    topics = {"nvd": "t.nvd", "kev": "t.kev"}
    routed = messages.route(df, topics)
    assert {(r["offset"], r["source"]) for r in routed.collect()} == {(1, "nvd"), (2, "nvd"), (3, "kev"), (4, "kev"), (6, "kev")}
    assert messages.route(df, topics, source="kev").count() == 3 and messages.route(df, topics, max_messages=2).count() == 2
    assert df.select(messages.source_of(F.col("topic"), topics)).filter("`coalesce(try_element_at(map(t.nvd, nvd, t.kev, kev), topic), unknown)` = 'unknown'").count() == 1
    parsed = messages.parse(routed, StructType.fromDDL("event_id string, n int"), ["event_id"])
    assert [r["record"]["event_id"] for r in messages.good_records(parsed).collect()] == ["a"]
    dead = {r["original_offset"]: r for r in messages.dead_letters(parsed, F.lit(AT).cast("timestamp")).collect()}
    assert set(dead) == {2, 3, 4, 6}
    assert base64.b64decode(dead[2]["raw_value_base64"]) == rows[1][3] and dead[4]["raw_value_base64"] == ""
    assert dead[3]["error_type"] == "MissingField" and dead[3]["error_message"] == "missing: event_id"


def test_rows_without_a_date_are_not_published(spark):
    from vulnlake.sources import scores

    rows = spark.createDataFrame(
        [("CVE-2024-1000", "0.5", "0.5", None), ("CVE-2024-1000", "0.5", "0.5", "2024-01-01")], "cve string, epss string, percentile string, d string"
    ).selectExpr("cve", "epss", "percentile", "cast(d as date) as score_date")
    assert [r.status for r in scores.typed_scores(rows).orderBy("score_date").collect()] == ["invalid", "published"]


def test_a_null_part_of_the_identity_does_not_vanish(spark):
    from pyspark.sql import functions as F

    from vulnlake.functions.hashing import event_id

    parts = spark.createDataFrame([("a", None, "x"), ("a", "", "x"), (None, "a", "x")], "r string, d string, p string")
    ids = [r[0] for r in parts.select(event_id(F.lit("s"), F.col("r"), F.col("d"), F.col("p"))).collect()]
    assert len(set(ids)) == 3


def test_no_manifest_folder_is_a_finding(spark, tmp_path):
    from vulnlake.sources import bronze

    assert bronze.read_manifest(spark, f"{tmp_path}/none").count() == 0
