"""Explicit schemas of every file and table. Field names and types are fixed values:
they must match the published record formats (NVD, OSV, EPSS, KEV) and the stored tables."""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

ENVELOPE_FIELDS = """
    event_id string, event_schema_version string, source string, source_record_id string,
    event_type string, effective_date string, source_modified_at string, fetched_at string,
    ingestion_run_id string, payload_sha256 string
"""

_CVSS3 = """struct<source:string,type:string,
    cvssData:struct<version:string,vectorString:string,baseScore:double,baseSeverity:string,
        attackVector:string,attackComplexity:string,privilegesRequired:string,userInteraction:string,
        scope:string,confidentialityImpact:string,integrityImpact:string,availabilityImpact:string>,
    exploitabilityScore:double,impactScore:double>"""

_CVSS2 = """struct<source:string,type:string,
    cvssData:struct<version:string,vectorString:string,baseScore:double,attackVector:string,
        accessVector:string,attackComplexity:string,accessComplexity:string,authentication:string,
        confidentialityImpact:string,integrityImpact:string,availabilityImpact:string>,
    baseSeverity:string,exploitabilityScore:double,impactScore:double>"""

NVD_PAYLOAD = f"""struct<id:string,sourceIdentifier:string,published:string,lastModified:string,
    vulnStatus:string,
    descriptions:array<struct<lang:string,value:string>>,
    metrics:struct<cvssMetricV40:array<{_CVSS3}>,cvssMetricV31:array<{_CVSS3}>,
        cvssMetricV30:array<{_CVSS3}>,cvssMetricV2:array<{_CVSS2}>>,
    weaknesses:array<struct<source:string,type:string,
        description:array<struct<lang:string,value:string>>>>,
    references:array<struct<url:string,source:string>>,
    configurations:array<struct<nodes:array<struct<
        cpeMatch:array<struct<vulnerable:boolean,criteria:string>>>>>>>"""

EPSS_PAYLOAD = """struct<cve:string,epss:double,percentile:double,score_date:string,
    model_version:string>"""

KEV_PAYLOAD = """struct<cveID:string,vendorProject:string,product:string,
    vulnerabilityName:string,dateAdded:string,dueDate:string,requiredAction:string,
    knownRansomwareCampaignUse:string,shortDescription:string,notes:string,cwes:array<string>,
    catalog_version:string,catalog_date_released:string>"""


PAYLOADS = {"nvd": NVD_PAYLOAD, "epss": EPSS_PAYLOAD, "kev": KEV_PAYLOAD}

OSV = """
    id string, summary string, details string, published string, modified string,
    withdrawn string, severity array<struct<type:string,score:string>>,
    references array<struct<type:string,url:string>>,
    affected array<struct<database_specific:struct<cpes:array<string>>>>,
    database_specific struct<cna_assigner:string,cwe_ids:array<string>,
        unresolved_ranges:array<struct<cpes:array<string>>>>
"""

KEV_CATALOG = """
    catalogVersion string, dateReleased string,
    vulnerabilities array<struct<cveID:string,vendorProject:string,product:string,
        vulnerabilityName:string,dateAdded:string,dueDate:string,requiredAction:string,
        knownRansomwareCampaignUse:string,shortDescription:string,notes:string,
        cwes:array<string>>>
"""

SILVER_NVD = """
    event_id string not null, cve_id string not null, published_at timestamp,
    last_modified_at timestamp, vuln_status string, source_identifier string,
    description_en string, cvss_version string, cvss_vector string, cvss_base_score double,
    cvss_base_severity string, attack_vector string, attack_complexity string,
    privileges_required string, user_interaction string, scope string,
    confidentiality_impact string, integrity_impact string, availability_impact string,
    exploitability_score double, impact_score double, cwe_ids array<string>,
    reference_urls array<string>, reference_count int, cpe_match_count int,
    fetched_at timestamp, ingestion_run_id string, payload_sha256 string
"""

SILVER_EPSS = """
    event_id string not null, cve_id string not null, observation_date date,
    epss_score double, epss_percentile double, epss_model_version string,
    fetched_at timestamp, ingestion_run_id string, payload_sha256 string
"""

SILVER_KEV = """
    event_id string not null, cve_id string not null, vendor_project string, product string,
    vulnerability_name string, date_added date, due_date date, required_action string,
    known_ransomware_campaign_use string, short_description string, notes string,
    cwes array<string>, catalog_version string, catalog_date_released timestamp,
    fetched_at timestamp, ingestion_run_id string, payload_sha256 string
"""

# Silver table per source, as directory name and columns.
SILVER = {
    "nvd": ("nvd_vulnerabilities", SILVER_NVD),
    "epss": ("epss_daily", SILVER_EPSS),
    "kev": ("kev_catalog", SILVER_KEV),
}

MANIFEST = """
    path string, source string, record_count bigint, sha256 string, created_at string,
    first_offset bigint, last_offset bigint
"""

# What a file or the dead letters of a run hold of a message log: stretches of offsets without a hole.
OFFSETS = """
    source string, topic string, partition int, run_id string, file string, first_offset bigint, last_offset bigint,
    records bigint
"""

# What became of the records of one run or batch.
INGEST_COUNTS = "source string, run_id string, fetched bigint, published bigint, skipped bigint, invalid bigint, failed bigint"
SILVER_COUNTS = "source string, load string, batch bigint, fetched bigint, accepted bigint, rejected bigint"
SINK_COUNTS = "source string, run_id string, fetched bigint, written bigint, dead_letters bigint"

CVSS_CATEGORICAL = [
    "attack_vector",
    "attack_complexity",
    "privileges_required",
    "user_interaction",
    "scope",
    "confidentiality_impact",
    "integrity_impact",
    "availability_impact",
]

CVSS_NUMERIC = [
    "cvss_base_score",
    "exploitability_score",
    "impact_score",
    "cwe_count",
    "reference_count",
    "cpe_match_count",
]


@cache
def struct(ddl: str) -> StructType:
    """Column list as a schema (needs an active session)."""
    return StructType.fromDDL(" ".join(ddl.split()))


def bronze(source: str) -> StructType:
    """Envelope of one source."""
    return struct(f"{ENVELOPE_FIELDS}, payload {PAYLOADS[source]}")


def silver(source: str) -> StructType:
    return struct(SILVER[source][1])
