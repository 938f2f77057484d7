"""One row per key: latest or earliest record.

`row_number() = 1` is planned with a WindowGroupLimit on both sides of the shuffle: each task
drops all but its own best row per key first, so a key with very many versions does not travel
to, or pile up in, one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in the given order; end the order with a unique column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def latest(df: DataFrame, keys: list[str], by: str, tie_break: list[str]) -> DataFrame:
    return first_per_key(df, keys, [F.desc_nulls_last(by), *(F.desc(c) for c in tie_break)])


def earliest(df: DataFrame, keys: list[str], by: str, tie_break: list[str]) -> DataFrame:
    """Earliest by `by`; rows without a value sort first, as in an ascending order."""
    return first_per_key(df, keys, [F.asc_nulls_first(by), *(F.asc(c) for c in tie_break)])


def earliest_date(df: DataFrame, key: str, by: str) -> DataFrame:
    """Key and earliest date only: a plain min, which combines before the shuffle."""
    return df.groupBy(key).agg(F.min(by).alias(by))
