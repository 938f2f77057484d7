"""Which (key, date) rows belong to the dataset."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spine(series: DataFrame, key: str, day: str) -> DataFrame:
    return series.select(key, day).distinct()


def with_record(spine_df: DataFrame, dimension: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keep keys that have a dimension record and bring some of its columns along."""
    return spine_df.join(dimension.select(key, *columns), key, "inner")


def published_by(df: DataFrame, published: str, day: str) -> DataFrame:
    """Rows whose subject was published on or before the day."""
    return df.filter(F.col(published) <= F.col(day))


def not_known_yet(df: DataFrame, outcomes: DataFrame, key: str, day: str, added: str) -> DataFrame:
    """Drop rows whose outcome was already on record on the day (anti-join with a date condition)."""
    known = outcomes.select(F.col(key).alias("_key"), F.col(added).alias("_added"))
    return df.join(known, (df[key] == known["_key"]) & (known["_added"] <= df[day]), "left_anti")


def right_censor(df: DataFrame, day: str, as_of: date | Column, horizon: int) -> DataFrame:
    """Keep days whose whole label window lies before the as-of date."""
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return df.filter(F.col(day) <= F.date_sub(limit, horizon))


def exclude_known(df: DataFrame, days_until: str = "days_until_kev") -> DataFrame:
    return df.filter(F.col(days_until).isNull() | (F.col(days_until) > 0))


def as_of_date(outcomes: DataFrame, series: DataFrame, fetched: str = "fetched_at") -> DataFrame:
    """One row: last fetch date of the outcomes, else of the series (null when both are empty)."""
    last_outcome = outcomes.agg(F.to_date(F.max(fetched))).scalar()
    return series.agg(F.coalesce(last_outcome, F.to_date(F.max(fetched))).alias("label_as_of_date"))


def resolve_range(
    start: date | None, end: date | None, lookback_days: int = 180, today: date | None = None
) -> tuple[date, date]:
    """Explicit dates, or the last `lookback_days` up to today."""
    today = today or datetime.now(timezone.utc).date()
    start = start or today - timedelta(days=lookback_days)
    end = end or today
    if start > end:
        raise ValueError(f"start {start} is after end {end}")
    return start, end


def parse_days_of_month(text: str | None) -> list[int] | None:
    """'1,15' as [1, 15]; empty means every day."""
    days = sorted({int(part) for part in (text or "").split(",") if part.strip()})
    if any(not 1 <= d <= 31 for d in days):
        raise ValueError(f"day of month out of range: {text}")
    return days or None


def sampled_days(
    df: DataFrame,
    day: str,
    *,
    start: date | str | None = None,
    end: date | str | None = None,
    days_of_month: list[int] | None = None,
) -> DataFrame:
    """Thin a series to a date range and to some days of the month; a filter, so it prunes the scan."""
    if start is not None and end is not None and str(start) > str(end):
        raise ValueError(f"start {start} is after end {end}")
    if start is not None:
        df = df.filter(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col(day) <= F.lit(end).cast("date"))
    return df.filter(F.dayofmonth(day).isin(days_of_month)) if days_of_month else df


def calendar(spark, start: str, end: str, days_of_month: list[int] | None = None) -> DataFrame:
    """The dates of a range, thinned to some days of the month."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return sampled_days(spark.range(1).select(F.explode(days).alias("day")), "day", days_of_month=days_of_month)
