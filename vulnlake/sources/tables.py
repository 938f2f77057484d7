"""Silver and Gold tables as Parquet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from vulnlake import schemas

OBSERVATIONS = "observations"
YEAR, MONTH = "observation_year", "observation_month"


def read_or_empty(spark: SparkSession, path: str, schema: StructType, by_folder: bool = False) -> DataFrame:
    """Parquet under `path` with the given columns, or an empty frame when there is none.

    With `by_folder` columns that are not in the files come from the names of their folders.
    """
    try:
        found = spark.read.schema(schema).option("recursiveFileLookup", str(not by_folder).lower()).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return found


def read_silver(spark: SparkSession, silver_root: str, source: str) -> DataFrame:
    return read_or_empty(spark, f"{silver_root}/{schemas.SILVER[source][0]}", schemas.silver(source))


def write_observations(observations: DataFrame, gold_root: str) -> None:
    """Overwrite Gold, partitioned by year and month.

    The rebalance hint brings a month together in few files of the advisory size; adaptive
    execution splits a month that is too large for one task.
    """
    (
        observations.hint("rebalance", YEAR, MONTH)
        .write.mode("overwrite")
        .partitionBy(YEAR, MONTH)
        .parquet(f"{gold_root}/{OBSERVATIONS}")
    )


def read_observations(spark: SparkSession, gold_root: str) -> DataFrame:
    return spark.read.parquet(f"{gold_root}/{OBSERVATIONS}")
