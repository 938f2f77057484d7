"""Bronze envelopes to typed Silver rows with a reject reason.

Each function returns one frame: the Silver columns plus `_reject_reason` (null for good rows).
`quality.accepted` and `quality.rejected` split it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.functions.checks import bad_id, first_reason, missing, out_of_range
from vulnlake.functions.nested import best_of, count_nested, distinct_values, last_of, length_of, let
from vulnlake.functions.times import DATE_PATTERN, parse_ts
from vulnlake.operators.quality import REASON

ENGLISH, PRIMARY = "en", "Primary"


def _in_common_shape(version: str):
    """Function from a metric of the version to the shape all versions share."""
    return lambda item: F.when(item.isNotNull(), _common_shape(item, version, version == "2.0"))


def _common_shape(item: Column, version: str, old: bool) -> Column:
    data = item["cvssData"]
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(version).alias("cvss_version"),
        data["vectorString"].alias("cvss_vector"),
        data["baseScore"].cast("double").alias("cvss_base_score"),
        (item["baseSeverity"] if old else data["baseSeverity"]).alias("cvss_base_severity"),
        (F.coalesce(data["attackVector"], data["accessVector"]) if old else data["attackVector"]).alias(
            "attack_vector"
        ),
        (
            F.coalesce(data["attackComplexity"], data["accessComplexity"]) if old else data["attackComplexity"]
        ).alias("attack_complexity"),
        (data["authentication"] if old else data["privilegesRequired"]).alias("privileges_required"),
        (none if old else data["userInteraction"]).alias("user_interaction"),
        (none if old else data["scope"]).alias("scope"),
        data["confidentialityImpact"].alias("confidentiality_impact"),
        data["integrityImpact"].alias("integrity_impact"),
        data["availabilityImpact"].alias("availability_impact"),
        item["exploitabilityScore"].cast("double").alias("exploitability_score"),
        item["impactScore"].cast("double").alias("impact_score"),
    )


def pick_metric(metrics: Column) -> Column:
    """The newest version with a base score, else the newest present; inside it the first Primary entry, else the first.

    The version decides before the type does, and a null attribute of the chosen metric stays null. A metric without a
    score never hides a scored one of an older version.
    """
    versions = {"4.0": "cvssMetricV40", "3.1": "cvssMetricV31", "3.0": "cvssMetricV30", "2.0": "cvssMetricV2"}
    found = F.array(
        *(
            let(best_of(metrics[name], lambda m: m["type"] == PRIMARY), _in_common_shape(version))
            for version, name in versions.items()
        )
    )
    return let(
        F.filter(found, lambda m: m.isNotNull()),
        lambda present: best_of(present, lambda m: m["cvss_base_score"].isNotNull()),
    )


def weakness_ids(weaknesses: Column) -> Column:
    """Distinct English weakness ids."""
    return distinct_values(
        weaknesses,
        lambda w: F.transform(F.filter(w["description"], lambda d: d["lang"] == ENGLISH), lambda d: d["value"]),
    )


def cpe_count(configurations: Column) -> Column:
    return count_nested(
        configurations, lambda c: count_nested(c["nodes"], lambda node: length_of(node["cpeMatch"]))
    )


def english_text(descriptions: Column) -> Column:
    return last_of(descriptions, lambda d: d["lang"] == ENGLISH)["value"]


def _identity() -> list[tuple[str, Column]]:
    return [
        ("missing_event_id", missing(F.col("event_id"))),
        ("missing_payload_sha256", missing(F.col("payload_sha256"))),
    ]


def normalize_nvd(envelopes: DataFrame) -> DataFrame:
    p = F.col("payload")
    flat = envelopes.withColumn("_m", pick_metric(p["metrics"])).select(
        "event_id",
        p["id"].alias("cve_id"),
        parse_ts(p["published"]).alias("published_at"),
        parse_ts(p["lastModified"]).alias("last_modified_at"),
        p["vulnStatus"].alias("vuln_status"),
        p["sourceIdentifier"].alias("source_identifier"),
        english_text(p["descriptions"]).alias("description_en"),
        "_m.*",
        weakness_ids(p["weaknesses"]).alias("cwe_ids"),
        F.coalesce(
            F.transform(p["references"], lambda r: r["url"]), F.array().cast("array<string>")
        ).alias("reference_urls"),
        length_of(p["references"]).alias("reference_count"),
        cpe_count(p["configurations"]).cast("int").alias("cpe_match_count"),
        parse_ts(F.col("fetched_at")).alias("fetched_at"),
        "ingestion_run_id",
        "payload_sha256",
    )
    rules = [
        *_identity(),
        ("invalid_cve_id", bad_id(F.col("cve_id"))),
        ("invalid_cvss_score", out_of_range(F.col("cvss_base_score"), 0.0, 10.0)),
    ]
    return flat.withColumn(REASON, first_reason(rules))


def normalize_epss(envelopes: DataFrame) -> DataFrame:
    p = F.col("payload")
    flat = envelopes.select(
        "event_id",
        p["cve"].alias("cve_id"),
        F.try_to_date(p["score_date"], DATE_PATTERN).alias("observation_date"),
        p["epss"].cast("double").alias("epss_score"),
        p["percentile"].cast("double").alias("epss_percentile"),
        p["model_version"].alias("epss_model_version"),
        parse_ts(F.col("fetched_at")).alias("fetched_at"),
        "ingestion_run_id",
        "payload_sha256",
    )
    rules = [
        *_identity(),
        ("invalid_cve_id", bad_id(F.col("cve_id"))),
        (
            "invalid_epss_value",
            out_of_range(F.col("epss_score"), 0.0, 1.0) | out_of_range(F.col("epss_percentile"), 0.0, 1.0),
        ),
        ("missing_observation_date", missing(F.col("observation_date"))),
    ]
    return flat.withColumn(REASON, first_reason(rules))


def normalize_kev(envelopes: DataFrame) -> DataFrame:
    """A missing or unreadable date is reported before a bad id."""
    p = F.col("payload")
    flat = envelopes.select(
        "event_id",
        p["cveID"].alias("cve_id"),
        p["vendorProject"].alias("vendor_project"),
        p["product"].alias("product"),
        p["vulnerabilityName"].alias("vulnerability_name"),
        F.try_to_date(p["dateAdded"], DATE_PATTERN).alias("date_added"),
        F.try_to_date(p["dueDate"], DATE_PATTERN).alias("due_date"),
        p["requiredAction"].alias("required_action"),
        p["knownRansomwareCampaignUse"].alias("known_ransomware_campaign_use"),
        p["shortDescription"].alias("short_description"),
        p["notes"].alias("notes"),
        p["cwes"].alias("cwes"),
        p["catalog_version"].alias("catalog_version"),
        parse_ts(p["catalog_date_released"]).alias("catalog_date_released"),
        parse_ts(F.col("fetched_at")).alias("fetched_at"),
        "ingestion_run_id",
        "payload_sha256",
    )
    rules = [
        *_identity(),
        ("missing_date_added", missing(F.col("date_added"))),
        ("invalid_cve_id", bad_id(F.col("cve_id"))),
    ]
    return flat.withColumn(REASON, first_reason(rules))


NORMALIZERS = {"nvd": normalize_nvd, "epss": normalize_epss, "kev": normalize_kev}
