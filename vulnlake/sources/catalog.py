"""Catalog of exploited vulnerabilities: one JSON document with an array of entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.functions.times import parse_date


def read_catalog(
    spark: SparkSession, path: str, *, glob: str = "*.json", one_per_file: bool = True
) -> DataFrame:
    return (
        spark.read.schema(schemas.struct(schemas.KEV_CATALOG))
        .option("multiLine", one_per_file)
        .option("pathGlobFilter", glob)
        .json(path)
    )


def explode_catalog(
    catalog: DataFrame,
    entries: str = "vulnerabilities",
    version: str = "catalogVersion",
    released: str = "dateReleased",
) -> DataFrame:
    """One row per entry with its catalog's version and release date."""
    return catalog.select(
        F.explode(entries).alias("entry"),
        F.coalesce(version, F.lit("")).alias("catalog_version"),
        F.coalesce(released, F.lit("")).alias("catalog_date_released"),
    ).select("entry.*", "catalog_version", "catalog_date_released")


def entry_status(id_: Column, added: Column, start: str | None = None, end: str | None = None) -> Column:
    """invalid without id or date, skipped outside the optional date range, else published."""
    date = parse_date(added)
    status = F.when((F.coalesce(id_, F.lit("")) == "") | date.isNull(), "invalid")
    if start is not None:
        status = status.when(date < F.lit(start).cast("date"), "skipped")
    if end is not None:
        status = status.when(date > F.lit(end).cast("date"), "skipped")
    return status.otherwise("published")
