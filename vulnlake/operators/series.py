"""Trailing-window statistics of a daily series.

Input is one row per (key, day) after `latest`, so a key holds at most one row per calendar day:
the window partitions are bounded by the calendar, not by the raw volume of a hot key. All frames
share one partitioning and one sort; there is no self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.functions.times import day_number

# Day numbers are counted from here in slope sums, which keeps the products small and exact.
SLOPE_ORIGIN = 18_262  # 2020-01-01
THRESHOLDS = (0.1, 0.5)


def threshold_name(value: float) -> str:
    return str(value).replace(".", "_")


def _slope(n: Column, sx: Column, sxx: Column, sy: Column, sxy: Column) -> Column:
    """Least-squares slope from moments; 0 when all days are equal.

    A row without a score still counts in n, sx and sxx. Shifting the day origin changes neither
    numerator nor denominator.
    """
    denominator = n * sxx - sx * sx
    return F.when(denominator == 0, F.lit(0.0)).otherwise((n * sxy - sx * sy) / denominator)


def trailing_features(
    series: DataFrame,
    key: str,
    day: str,
    score: str,
    *,
    prefix: str = "epss",
    lags: tuple[int, ...] = (1, 7, 30),
    windows: tuple[int, ...] = (7, 30),
    thresholds: tuple[float, ...] = THRESHOLDS,
    keep: tuple[str, ...] = (),
    spine: DataFrame | None = None,
) -> DataFrame:
    """Lags, rolling statistics, counts, deltas and slopes of `score` per (key, day).

    A window of w days covers [day - w + 1, day]; a lag reads exactly that many days back.
    Without `spine` every day of the series gives a row. With it, output has the rows of `spine`
    (key, day), which need not be in the series: they enter the same windows as rows without a score.
    """
    rows = series.select(key, day, F.col(score).cast("double").alias(score), *keep, F.lit(1).alias("_seen"))
    if spine is not None:
        marks = spine.select(key, day).distinct().withColumn("_wanted", F.lit(1))
        rows = rows.join(marks, [key, day], "full")
    x = day_number(F.col(day)) - SLOPE_ORIGIN
    # A spine row that is not in the series takes no part in any sum.
    rows = rows.withColumns(
        {
            "_day": day_number(F.col(day)),
            "_x": F.when(F.col("_seen") == 1, x.cast("bigint")),
            "_xx": F.when(F.col("_seen") == 1, (x * x).cast("bigint")),
            "_xy": x * F.col(score),
        }
    )
    ordered = Window.partitionBy(key).orderBy("_day")
    out: dict[str, Column] = {}
    for lag in lags:
        out[f"{prefix}_lag_{lag}d"] = F.max(score).over(ordered.rangeBetween(-lag, -lag))
    for w in windows:
        frame = ordered.rangeBetween(1 - w, 0)
        out[f"{prefix}_mean_{w}d"] = F.avg(score).over(frame)
        out[f"{prefix}_max_{w}d"] = F.max(score).over(frame)
        out[f"{prefix}_min_{w}d"] = F.min(score).over(frame)
        out[f"{prefix}_stddev_{w}d"] = F.stddev_samp(score).over(frame)
        out[f"_n_{w}"] = F.count("_seen").over(frame)
        out[f"_sx_{w}"] = F.sum("_x").over(frame)
        out[f"_sxx_{w}"] = F.sum("_xx").over(frame)
        out[f"_sy_{w}"] = F.sum(score).over(frame)
        out[f"_sxy_{w}"] = F.sum("_xy").over(frame)
    longest = max(windows)
    frame = ordered.rangeBetween(1 - longest, 0)
    for t in thresholds:
        above = F.when(F.col(score) > t, 1).otherwise(0)
        out[f"{prefix}_days_above_{threshold_name(t)}_{longest}d"] = F.sum(above).over(frame)
    windowed = rows.select("*", *(c.alias(name) for name, c in out.items()))
    if spine is not None:
        windowed = windowed.filter("_wanted = 1")
    return windowed.select(
        key,
        day,
        F.col(score).alias(f"{prefix}_current"),
        *keep,
        *(name for name in out if not name.startswith("_")),
        F.col(f"_n_{longest}").alias(f"{prefix}_days_observed_{longest}d"),
        *((F.col(score) - F.col(f"{prefix}_lag_{lag}d")).alias(f"{prefix}_delta_{lag}d") for lag in lags),
        *(
            _slope(*(F.col(f"{m}_{w}") for m in ("_n", "_sx", "_sxx", "_sy", "_sxy"))).alias(
                f"{prefix}_slope_{w}d"
            )
            for w in windows
        ),
    )


def range_join(
    spine: DataFrame, series: DataFrame, key: str, day: str, lookback: int, columns: list[str]
) -> DataFrame:
    """The join form: every spine row with the series rows of [day - lookback, day], left outer.

    A series row is placed in its own block of `lookback + 1` days and in the next one, so the
    range condition becomes an equi-join on (key, block) with at most two blocks per row.
    """
    block = lookback + 1
    left = spine.withColumn("_day", day_number(F.col(day))).withColumn("_block", F.floor(F.col("_day") / block))
    right = (
        series.select(
            F.col(key).alias("_key"), day_number(F.col(day)).alias("_series_day"), F.col(day).alias("series_date"), *columns
        )
        .withColumn("_at", F.floor(F.col("_series_day") / block))
        .withColumn("_series_block", F.explode(F.array(F.col("_at"), F.col("_at") + 1)))
    )
    in_range = (F.col("_series_day") <= F.col("_day")) & (F.col("_series_day") >= F.col("_day") - lookback)
    same = (F.col(key) == F.col("_key")) & (F.col("_block") == F.col("_series_block"))
    joined = left.join(right, same & in_range, "left")
    return joined.withColumn("days_back", F.col("_day") - F.col("_series_day")).drop(
        "_key", "_day", "_block", "_series_day", "_at", "_series_block"
    )


def dimension_features(df: DataFrame, dimension: DataFrame, key: str, columns: list[Column | str]) -> DataFrame:
    """Left equi-join of selected dimension columns."""
    return df.join(dimension.select(key, *columns), key, "left")
