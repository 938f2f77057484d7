"""Accepting, rejecting and counting records; file integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.operators.latest import latest

REASON = "_reject_reason"
# What can become of a source record.
STATUSES = ("published", "skipped", "invalid", "failed")


def accepted(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col(REASON).isNotNull())


def write_rejected(annotated: DataFrame, path: str, mode: str = "append") -> None:
    """One job for all reasons: a directory per reason."""
    (
        rejected(annotated)
        .withColumn("reason", F.col(REASON))
        .write.mode(mode)
        .partitionBy("reason")
        .parquet(path)
    )


def reason_counts(annotated: DataFrame) -> DataFrame:
    return annotated.groupBy(F.col(REASON).alias("reason")).agg(F.count("*").alias("n"))


def status_counts(df: DataFrame, source: Column, status: Column) -> DataFrame:
    """Ingest statistics per source in one pass: fetched, published, skipped, invalid."""
    flagged = df.select(source.alias("source"), status.alias("_status"))
    return flagged.groupBy("source").agg(
        F.count("*").alias("fetched"),
        *(F.count_if(F.col("_status") == kind).alias(kind) for kind in STATUSES),
    )


def duplicate_ids(df: DataFrame, id_: str = "event_id") -> DataFrame:
    """Ids seen more than once, with their count; empty ids do not take part."""
    present = df.filter(F.col(id_).isNotNull() & (F.col(id_).cast("string") != ""))
    return present.groupBy(id_).agg(F.count("*").alias("n")).filter("n > 1")


def file_report(facts: DataFrame, manifest: DataFrame) -> DataFrame:
    """One row per data file: what the files are against what the manifest says.

    Status is the first of missing_manifest, unreadable, sha256_mismatch, record_count_mismatch,
    ok; the two mismatch flags can both be set. A file without manifest does not count records. Of
    several manifest rows for a file the newest counts.
    """
    said = latest(manifest, ["path"], "created_at", ["sha256", "record_count"]).select(
        "path", F.col("sha256").alias("said_sha256"), F.col("record_count").alias("said_count"), F.lit(1).alias("_said")
    )
    known = F.col("_said").isNotNull()
    sha_bad = known & ~F.col("sha256").eqNullSafe(F.col("said_sha256"))
    count_bad = known & F.col("readable") & (F.col("record_count") != F.col("said_count"))
    count_bad = F.coalesce(count_bad, F.lit(False))
    status = (
        F.when(~known, "missing_manifest")
        .when(~F.col("readable"), "unreadable")
        .when(sha_bad, "sha256_mismatch")
        .when(count_bad, "record_count_mismatch")
        .otherwise("ok")
    )
    return facts.join(said, "path", "left").select(
        "path",
        "source",
        status.alias("status"),
        sha_bad.alias("sha256_mismatch"),
        count_bad.alias("record_count_mismatch"),
        F.when(known & F.col("readable"), F.col("record_count")).otherwise(F.lit(0)).alias("records"),
    )


def integrity_summary(report: DataFrame) -> DataFrame:
    """One row over all files; passed when every file is ok."""
    return report.agg(
        F.count("*").alias("files_checked"),
        F.coalesce(F.sum("records"), F.lit(0)).cast("bigint").alias("records_total"),
        F.count_if(F.col("status") == "missing_manifest").alias("missing_manifest"),
        F.count_if("sha256_mismatch").alias("sha256_mismatch"),
        F.count_if("record_count_mismatch").alias("record_count_mismatch"),
        F.count_if(F.col("status") == "unreadable").alias("parse_errors"),
        F.coalesce(F.bool_and(F.col("status") == "ok"), F.lit(True)).alias("passed"),
    )
