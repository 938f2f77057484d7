"""Chronological train/validation/test splits: whole dates, never random rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.sources.tables import MONTH, YEAR

NAMES = ("train", "val", "test")
MIN_POSITIVES = {"train": 50, "val": 15, "test": 15}


def split_bounds(df: DataFrame, day: str, train_ratio: float = 0.60, val_ratio: float = 0.20) -> DataFrame:
    """One row with the first and last date and the number of dates of each split.

    The sorted set of distinct dates is as small as the calendar; a timestamp counts as its date. Too few dates
    raise an error.
    """
    dates = df.agg(F.array_sort(F.collect_set(F.col(day).cast("date"))).alias("dates")).withColumn("n", F.array_size("dates"))
    share = lambda r: F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(r)).cast("int"))
    sized = dates.withColumns({"train_n": share(train_ratio), "val_n": share(val_ratio)}).withColumn(
        "test_n", F.col("n") - F.col("train_n") - F.col("val_n")
    )
    message = F.concat(F.lit("not enough distinct dates to split: "), F.col("n").cast("string"))
    checked = F.when(F.col("test_n") < 1, F.raise_error(message).cast("int")).otherwise(F.col("test_n"))
    sized = sized.withColumn("test_n", checked)
    at = lambda i: F.get("dates", i)
    return sized.select(
        at(F.lit(0)).alias("train_start"),
        at(F.col("train_n") - 1).alias("train_end"),
        at(F.col("train_n")).alias("val_start"),
        at(F.col("train_n") + F.col("val_n") - 1).alias("val_end"),
        at(F.col("train_n") + F.col("val_n")).alias("test_start"),
        at(F.col("n") - 1).alias("test_end"),
        F.col("train_n").alias("train_count"),
        F.col("val_n").alias("val_count"),
        F.col("test_n").alias("test_count"),
        F.col("n").alias("total_count"),
    )


def split_name(day: str, train_end: Column, val_end: Column) -> Column:
    return F.when(F.col(day) <= train_end, "train").when(F.col(day) <= val_end, "val").otherwise("test")


def assign_splits(df: DataFrame, bounds: DataFrame, day: str) -> DataFrame:
    """Add the column `split`; the two boundary dates enter as scalar subqueries."""
    train_end, val_end = (bounds.select(c).scalar() for c in ("train_end", "val_end"))
    return df.withColumn("split", split_name(day, train_end, val_end))


def date_slice(df: DataFrame, day: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Rows of a date range; on a table stored by year and month the partitions are pruned as well."""
    stored_by_month = YEAR in df.columns and MONTH in df.columns
    month = F.col(YEAR) * 12 + F.col(MONTH) if stored_by_month else None
    if start is not None:
        df = df.filter(F.col(day) >= F.lit(start))
        df = df if month is None else df.filter(month >= start.year * 12 + start.month)
    if end is not None:
        df = df.filter(F.col(day) <= F.lit(end))
        df = df if month is None else df.filter(month <= end.year * 12 + end.month)
    return df


def split_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy("split").agg(
        F.count("*").alias("rows"), F.count_if(F.col(label) == 1).alias("positives")
    )


def require_positives(counts: DataFrame, minimum: dict[str, int] = MIN_POSITIVES) -> dict[str, dict[str, int]]:
    """Rows and positives per split (three rows); raises when a split has too few positives."""
    found = {r["split"]: {"rows": r["rows"], "positives": r["positives"]} for r in counts.collect()}
    for name, least in minimum.items():
        have = found.get(name, {}).get("positives", 0)
        if have < least:
            raise ValueError(f"{name} split has only {have} positives (minimum {least})")
    return found
