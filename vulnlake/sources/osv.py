"""OSV documents: reading, filtering and reshaping to the NVD record form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.functions import cvss
from vulnlake.functions.nested import let, strip, strip_left
from vulnlake.functions.times import millisecond_text, parse_rfc3339

# Placeholder records start their details with one of these (fixed values).
REJECT_PREFIXES = ["** REJECT **", "Rejected reason:", "** RESERVED **"]
ORIGIN = "osv.dev"

# NVD metric array per CVSS version, by the version's leading text.
METRIC_ARRAYS = {"cvssMetricV40": "4", "cvssMetricV31": "3.1", "cvssMetricV30": "3.0", "cvssMetricV2": "2"}


def read_osv(
    spark: SparkSession,
    path: str,
    *,
    glob: str = "*.json",
    one_per_file: bool = True,
    max_records: int | None = None,
) -> DataFrame:
    """Documents of a directory, one per file or one per line.

    An unreadable document becomes a row with a null id. `max_records` is the caller's own limit.
    """
    docs = (
        spark.read.schema(schemas.struct(schemas.OSV))
        .option("multiLine", one_per_file)
        .option("pathGlobFilter", glob)
        .json(path)
    )
    return docs if max_records is None else docs.orderBy("id").limit(max_records)


def is_withdrawn(withdrawn: Column, details: Column) -> Column:
    """Withdrawn, rejected or merely reserved."""
    head = strip_left(F.coalesce(details, F.lit("")))
    marked = F.lit(False)
    for prefix in REJECT_PREFIXES:
        marked = marked | head.startswith(prefix)
    return (F.coalesce(withdrawn, F.lit("")) != "") | marked


def doc_status(id_: Column, withdrawn: Column, details: Column) -> Column:
    """skipped for withdrawn documents, invalid without an id, else published."""
    return (
        F.when(is_withdrawn(withdrawn, details), "skipped")
        .when(F.coalesce(strip(id_), F.lit("")) == "", "invalid")
        .otherwise("published")
    )


def description_text(summary: Column, details: Column) -> Column:
    """Summary and details separated by an empty line, or whichever is there."""
    parts = F.filter(F.array(strip(summary), strip(details)), lambda t: F.coalesce(t, F.lit("")) != "")
    return F.array_join(parts, "\n\n")


def _metric(vector: Column) -> Column:
    """One severity vector as decoded and scored parts."""
    return let(
        cvss.parse(vector),
        lambda p: F.struct(p["text"].alias("vector"), cvss.score(p).alias("s"), cvss.decode(p).alias("d")),
    )


def _as_v3(m: Column) -> Column:
    return F.struct(
        F.lit(ORIGIN).alias("source"),
        F.lit("Primary").alias("type"),
        F.struct(
            m["s"]["version"].alias("version"),
            m["vector"].alias("vectorString"),
            m["s"]["base_score"].alias("baseScore"),
            m["s"]["base_severity"].alias("baseSeverity"),
            m["d"]["attack_vector"].alias("attackVector"),
            m["d"]["attack_complexity"].alias("attackComplexity"),
            m["d"]["privileges_required"].alias("privilegesRequired"),
            m["d"]["user_interaction"].alias("userInteraction"),
            m["d"]["scope"].alias("scope"),
            m["d"]["confidentiality_impact"].alias("confidentialityImpact"),
            m["d"]["integrity_impact"].alias("integrityImpact"),
            m["d"]["availability_impact"].alias("availabilityImpact"),
        ).alias("cvssData"),
        m["s"]["exploitability_score"].alias("exploitabilityScore"),
        m["s"]["impact_score"].alias("impactScore"),
    )


def _as_v2(m: Column) -> Column:
    return F.struct(
        F.lit(ORIGIN).alias("source"),
        F.lit("Primary").alias("type"),
        F.struct(
            m["s"]["version"].alias("version"),
            m["vector"].alias("vectorString"),
            m["s"]["base_score"].alias("baseScore"),
            m["d"]["attack_vector"].alias("attackVector"),
            m["d"]["attack_vector"].alias("accessVector"),
            m["d"]["attack_complexity"].alias("attackComplexity"),
            m["d"]["attack_complexity"].alias("accessComplexity"),
            m["d"]["privileges_required"].alias("authentication"),
            m["d"]["confidentiality_impact"].alias("confidentialityImpact"),
            m["d"]["integrity_impact"].alias("integrityImpact"),
            m["d"]["availability_impact"].alias("availabilityImpact"),
        ).alias("cvssData"),
        m["s"]["base_severity"].alias("baseSeverity"),
        m["s"]["exploitability_score"].alias("exploitabilityScore"),
        m["s"]["impact_score"].alias("impactScore"),
    )


def _declares(version: str):
    return lambda m: m["s"]["version"].startswith(version)


def metrics(severity: Column) -> Column:
    """Severity vectors as NVD metric arrays by version; vectors that cannot be scored drop out."""
    vectors = F.transform(severity, lambda s: strip(s["score"]))
    scored = F.filter(F.transform(F.filter(vectors, lambda v: v != ""), _metric), lambda m: m["s"].isNotNull())

    def arrays(items: Column) -> Column:
        out = []
        for name, version in METRIC_ARRAYS.items():
            of_version = F.filter(items, _declares(version))
            shaped = F.transform(of_version, _as_v2 if name == "cvssMetricV2" else _as_v3)
            out.append(F.when(F.array_size(of_version) > 0, shaped).alias(name))
        return F.struct(*out)

    return let(scored, arrays)


def cpe_list(database_specific: Column, affected: Column) -> Column:
    """Distinct non-empty CPE strings of both places, first seen first."""
    empty = F.array().cast("array<string>")
    ranges = F.flatten(
        F.transform(database_specific["unresolved_ranges"], lambda r: F.coalesce(r["cpes"], empty))
    )
    products = F.flatten(
        F.transform(affected, lambda a: F.coalesce(a["database_specific"]["cpes"], empty))
    )
    both = F.concat(F.coalesce(ranges, empty), F.coalesce(products, empty))
    return F.array_distinct(F.filter(both, lambda c: F.coalesce(c, F.lit("")) != ""))


def nvd_payload() -> Column:
    """The NVD record of an OSV document, over the columns of `schemas.OSV`."""
    col = F.col
    text = description_text(col("summary"), col("details"))
    descriptions = let(
        text,
        lambda t: F.filter(
            F.array(F.struct(F.lit("en").alias("lang"), t.alias("value"))), lambda d: d["value"] != ""
        ),
    )
    weaknesses = F.transform(
        F.filter(col("database_specific.cwe_ids"), lambda c: F.coalesce(c, F.lit("")) != ""),
        lambda c: F.struct(
            F.lit(ORIGIN).alias("source"),
            F.lit("Primary").alias("type"),
            F.array(F.struct(F.lit("en").alias("lang"), c.alias("value"))).alias("description"),
        ),
    )
    references = F.transform(
        F.filter(col("references"), lambda r: F.coalesce(r["url"], F.lit("")) != ""),
        lambda r: F.struct(r["url"].alias("url"), r["type"].alias("source")),
    )
    configurations = let(
        cpe_list(col("database_specific"), col("affected")),
        lambda cpes: F.filter(
            F.array(
                F.struct(
                    F.array(
                        F.struct(
                            F.transform(
                                cpes, lambda c: F.struct(F.lit(True).alias("vulnerable"), c.alias("criteria"))
                            ).alias("cpeMatch")
                        )
                    ).alias("nodes")
                )
            ),
            lambda _: F.array_size(cpes) > 0,
        ),
    )
    assigner = col("database_specific.cna_assigner")
    withdrawn = F.coalesce(col("withdrawn"), F.lit("")) != ""
    return F.struct(
        strip(col("id")).alias("id"),
        F.when(F.coalesce(assigner, F.lit("")) != "", assigner).otherwise(F.lit(ORIGIN)).alias("sourceIdentifier"),
        millisecond_text(parse_rfc3339(col("published"))).alias("published"),
        millisecond_text(parse_rfc3339(col("modified"))).alias("lastModified"),
        F.when(withdrawn, "Withdrawn").otherwise("Published").alias("vulnStatus"),
        descriptions.alias("descriptions"),
        metrics(F.coalesce(col("severity"), F.array().cast("array<struct<type:string,score:string>>"))).alias(
            "metrics"
        ),
        F.coalesce(weaknesses, F.array()).alias("weaknesses"),
        F.coalesce(references, F.array()).alias("references"),
        configurations.alias("configurations"),
    )


def adapt(docs: DataFrame, column: str = "payload") -> DataFrame:
    """Add the NVD record as a struct column."""
    return docs.withColumn(column, nvd_payload().cast(" ".join(schemas.NVD_PAYLOAD.split())))
