"""Integrity of the Bronze log over all sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.operators import quality
from vulnlake.sources import bronze


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def bronze_report(spark: SparkSession, root: str, manifest_root: str, sources: tuple[str, ...]) -> DataFrame:
    """One row per data file with its status (see `quality.file_report`)."""
    facts = _all([bronze.file_facts(spark, root, s) for s in sources])
    return quality.file_report(facts, bronze.read_manifest(spark, manifest_root))


def bronze_duplicates(spark: SparkSession, root: str, sources: tuple[str, ...]) -> DataFrame:
    """Event ids that occur more than once; reported, but no failure, as delivery is at least once."""
    ids = [bronze.read_bronze(spark, root, s).select("event_id") for s in sources]
    return quality.duplicate_ids(_all(ids))


def validate_bronze(
    spark: SparkSession, root: str, manifest_root: str, sources: tuple[str, ...] = ("nvd", "epss", "kev")
) -> DataFrame:
    """One row: counts per defect, the number of duplicate ids, and whether all files are sound."""
    duplicates = bronze_duplicates(spark, root, sources).agg(F.count("*")).scalar()
    summary = quality.integrity_summary(bronze_report(spark, root, manifest_root, sources))
    return summary.withColumn("duplicate_event_ids", duplicates)
