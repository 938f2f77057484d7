"""Counts that are observed while a job writes, and stored beside what it wrote."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.sources.tables import read_or_empty


def observed(df: DataFrame, measures: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation of `measures` over those that the next action reads, in the same pass."""
    watch = Observation()
    return df.observe(watch, *(c.alias(name) for name, c in measures.items())), watch


def status_measures(status: Column, kinds: tuple[str, ...]) -> dict[str, Column]:
    """All rows as `fetched`, and those of each kind."""
    return {"fetched": F.count(F.lit(1)), **{kind: F.count_if(status == kind) for kind in kinds}}


def values(watch: Observation) -> dict[str, int]:
    """What was observed; the action must have run.

    Spark may find while it runs that a plan has no rows and drop the observation with it. Its row then has no columns, which cannot be
    converted; nothing was seen.
    """
    try:
        found = watch.get
    except Py4JJavaError as error:
        if "java.lang.AssertionError" not in str(error.java_exception):
            raise
        return {}
    return {k: v or 0 for k, v in found.items()}


def store(spark: SparkSession, path: str, ddl: str, rows: list[dict]) -> None:
    """Write one row per source of a run; the same run replaces its rows."""
    schema = schemas.struct(ddl)
    data = [tuple(r.get(f.name, 0) for f in schema.fields) for r in rows]
    spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").parquet(path)


def read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.struct(ddl))
