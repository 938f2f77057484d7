"""Input tables and tables that Spark derives from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake import session
from vulnlake.session import cut_lineage

__all__ = ["configure", "cut_lineage", "free_name", "pick", "table"]

# Rows of whole texts that cross to Python at once: some megabytes, both in the JVM and in the worker.
BATCH_ROWS = "1000"


def configure(spark: SparkSession) -> SparkSession:
    """The package's defaults, and Arrow batches for rows that hold whole texts."""
    session.configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def pick(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that further columns of the caller can never clash with derived ones."""
    return docs.select(*(F.col(f"`{c}`") for c in columns))


def free_name(docs: DataFrame, name: str) -> str:
    """The name, lengthened until no column of `docs` has it in any spelling."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name
