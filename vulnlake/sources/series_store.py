"""A daily series on disk: one row per (key, day), partitioned by month and bucketed by key.

Readers that group, window or join by the key need no shuffle of the series, and a range of days reads its months only. New
fetches are merged month by month; a fetch that is already there, or older than what is there, changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vulnlake.operators.latest import first_per_key
from vulnlake.session import cut_lineage, make_dir

MONTH = "series_month"


def month_of(day: Column) -> Column:
    """The month as a number, such as 202401."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """An insert replaces the months it has rows of."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@dataclass(frozen=True)
class SeriesStore:
    """The series under `path`, known to the session's catalog as the table `name`.

    `schema` has the columns of the fetches. Of several fetches of a (key, day) the one that is newest by `by` counts, then the
    greatest by `ties`, which should tell any two apart.
    """

    spark: SparkSession
    name: str
    path: str
    schema: StructType
    key: str
    day: str
    by: str
    ties: tuple[str, ...]
    buckets: int = 64

    def open(self) -> SeriesStore:
        """Make the table known to this session, with the months that are on disk."""
        make_dir(self.spark, self.path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        self.spark.sql(
            f"create table if not exists `{self.name}` ({columns}, {MONTH} int) using parquet partitioned by ({MONTH}) "
            f"clustered by (`{self.key}`) sorted by (`{self.key}`, `{self.day}`) into {self.buckets} buckets location '{self.path}'"
        )
        self.spark.catalog.recoverPartitions(self.name)
        return self

    def read(self, months: list[int] | None = None) -> DataFrame:
        """The series, or some months of it; `series_month` comes last."""
        rows = self.spark.table(f"`{self.name}`")
        return rows if months is None else rows.where(F.col(MONTH).isin(months))

    def months(self) -> list[int]:
        """The months on disk, by the catalog."""
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"show partitions `{self.name}`").collect())

    def stage(self, rows: DataFrame) -> tuple[DataFrame, list[date]]:
        """(all rows of the months that `rows` change, the days that change): what `apply` will write.

        Fetches without a key or day do not take part. Only months that occur in `rows` are read. Days, unlike rows, are
        bounded by the calendar, so they may reach the driver.
        """
        names = self.schema.names
        order = [F.desc_nulls_last(self.by), *(F.desc(c) for c in self.ties)]
        fetched = rows.select(*names).where(F.col(self.key).isNotNull() & F.col(self.day).isNotNull())
        newest = first_per_key(fetched, [self.key, self.day], order).withColumn(MONTH, month_of(F.col(self.day)))
        newest = cut_lineage(newest, "series-new")
        months, on_disk = sorted(r[0] for r in newest.select(MONTH).distinct().collect()), set(self.months())
        met = [m for m in months if m in on_disk]
        marked = newest.withColumn("_new", F.lit(1))
        merged = marked
        if met:  # only months that are on disk are put in order again
            both = self.read(met).withColumn("_new", F.lit(0)).unionByName(marked.where(F.col(MONTH).isin(met)))
            merged = cut_lineage(first_per_key(both, [self.key, self.day], [*order, F.asc("_new")]), "series-merged").unionByName(
                marked.where(~F.col(MONTH).isin(met))
            )
        days = sorted(r[0] for r in merged.where("_new = 1").select(self.day).distinct().collect())
        changed = sorted({d.year * 100 + d.month for d in days})
        return merged.where(F.col(MONTH).isin(changed)).select(*names, MONTH), days

    def apply(self, staged: DataFrame) -> None:
        """Replace the months of `staged`: a file per month and bucket, in the order of key and day, which the write itself sorts."""
        with _dynamic_overwrite(self.spark):
            staged.repartition(self.buckets, self.key).write.insertInto(f"`{self.name}`", overwrite=True)

    def merge(self, rows: DataFrame) -> list[date]:
        """Stage and apply; returns the days that changed."""
        staged, days = self.stage(rows)
        if days:
            self.apply(staged)
        return days
