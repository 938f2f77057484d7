"""Outcome labels over several horizons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.functions.risk import within_horizon

HORIZONS = (7, 30, 90)


def label_columns(
    df: DataFrame, day: str, added: str, as_of: Column, horizons: tuple[int, ...] = HORIZONS, name: str = "kev"
) -> DataFrame:
    """Label a frame that already carries the outcome date `added` (null when it never happened)."""
    until = F.datediff(F.col(added), F.col(day))
    return df.withColumns(
        {
            f"days_until_{name}": until,
            f"ever_in_{name}": F.col(added).isNotNull().cast("int"),
            **{f"{name}_within_{h}_days": within_horizon(until, h) for h in horizons},
            "label_as_of_date": as_of,
        }
    )


def add_labels(
    df: DataFrame,
    outcomes: DataFrame,
    key: str,
    day: str,
    added: str,
    as_of: Column,
    horizons: tuple[int, ...] = HORIZONS,
    name: str = "kev",
) -> DataFrame:
    """Left join to the outcome table (one row per key), then the labels.

    No broadcast hint: the planner broadcasts the outcomes while they are below the session's
    size threshold and sorts and merges beyond it.
    """
    dates = outcomes.select(key, F.col(added).alias(f"{name}_date_added"))
    return label_columns(df.join(dates, key, "left"), day, f"{name}_date_added", as_of, horizons, name)
