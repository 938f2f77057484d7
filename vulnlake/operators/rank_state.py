"""Stored states that merge over days: counts per threshold, and summaries of quantiles.

Both are written once per day of data. A window of days costs its states; the rows behind them are not read again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.operators import ranking, rolling
from vulnlake.session import cut_lineage
from vulnlake.sources.tables import read_or_empty

THRESHOLDS = "threshold double, pos bigint, n bigint, day date"
SUMMARY = "value double, weight bigint, slack bigint, day date"
# Share of a day's rows by which a rank read from its summary may be too small.
RANK_ERROR = 0.001


def _save(state: DataFrame, path: str) -> None:
    """Write the days of `state`; a day that is there is replaced, other days stay."""
    state.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return read_or_empty(spark, path, schemas.struct(ddl), by_folder=True)


def _in_windows(state: DataFrame, windows: list[tuple[str, date, date]]) -> DataFrame:
    """The state once for every window that its day is in, as `window`; days of no window are not read."""
    first, last = min(w[1] for w in windows), max(w[2] for w in windows)
    spans = F.array(*(
        F.when(F.col("day").between(F.lit(a).cast("date"), F.lit(b).cast("date")), F.lit(name)) for name, a, b in windows
    ))
    kept = state.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return kept.withColumn("window", F.explode(F.array_compact(spans)))


# ---- counts per threshold --------------------------------------------------------------------------------
def save_thresholds(df: DataFrame, score: str, label: str, day: str, path: str) -> None:
    """Rows and positives per day and distinct score. Rows without a day, score or label do not take part."""
    present = df.where(F.col(day).isNotNull()).select(F.col(score).alias("_score"), F.col(label).alias("_label"), F.col(day).alias("day"))
    counts = ranking.threshold_counts(present, "_score", "_label", ["day"])
    _save(counts.select("threshold", "pos", "n", "day"), path)


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, THRESHOLDS)


def window_metrics(state: DataFrame, windows: list[tuple[str, date, date]]) -> DataFrame:
    """(window, area_under_pr, area_under_roc) over the rows of the days from first to last of each (name, first, last).

    Counts of the same threshold on several days add up, so the areas are those of the rows themselves. A window without rows has no result.
    """
    merged = _in_windows(state, windows).groupBy("window", "threshold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    return ranking.areas(merged, ["window"])


# ---- summaries of quantiles ------------------------------------------------------------------------------
def summarise(df: DataFrame, score: str, day: str, error: float = RANK_ERROR) -> DataFrame:
    """(value, weight, slack, day): of the scores of a day in order, every s-th and the last, with the rows since the one before.

    s is the whole number below `error` times the day's rows, 1 at least, and slack = s - 1. Up to any value a summary counts
    at most as many rows as there are, and at most `slack` fewer. Ranks are found by sums over ranges: no day is in one task.
    """
    if not 0 < error < 1:
        raise ValueError("the rank error is a share between 0 and 1")
    rows = df.where(F.col(day).isNotNull() & F.col(score).isNotNull()).select(F.col(day).alias("day"), F.col(score).cast("double").alias("value"))
    counts = rows.groupBy("day", "value").agg(F.count("*").alias("n"))
    placed = rolling.in_order(counts, ["day", "value"], "summary")
    before = rolling.totals_before(placed, ["day"], {"below": F.col("n")}).select(F.col(rolling.AT).alias("_row"), "below")
    sizes = placed.groupBy(F.col("day").alias("_day")).agg(F.sum("n").alias("total"))
    ranked = placed.join(before, F.col(rolling.AT) == F.col("_row")).join(sizes, F.col("day") == F.col("_day"))
    step = F.greatest(F.lit(1), F.floor(F.col("total") * F.lit(error))).cast("bigint")
    ranked = ranked.withColumns({"step": step, "upto": F.col("below") + F.col("n")})
    # points at the ranks s, 2s, ... and at the last rank; equal values are one point
    last = F.when(F.col("upto") == F.col("total"), F.col("total")).otherwise(F.expr("upto div step") * F.col("step"))
    points = F.when(F.col("below") == F.col("total"), F.lit(0)).otherwise(F.expr("below div step") * F.col("step"))
    kept = ranked.withColumn("weight", (last - points).cast("bigint")).where("weight > 0")
    return kept.select("value", "weight", (F.col("step") - 1).alias("slack"), "day")


def save_summaries(df: DataFrame, score: str, day: str, path: str, error: float = RANK_ERROR) -> None:
    _save(summarise(df, score, day, error), path)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, SUMMARY)


def window_cuts(summaries: DataFrame, windows: list[tuple[str, date, date]], n: int = ranking.CUT_COUNT) -> DataFrame:
    """(window, position, cut, most_error): n quantiles of every window, from the summaries of its days.

    The cut of position i answers the rank ceil(i * rows / (n - 1)), the first one rank 1. It is the least value up to which the summaries
    count so many rows. All rows up to it are at least that many, and those below it fewer than the rank plus `most_error`, the sum of the days' slacks,
    which is below the rank error times the rows.
    """
    found = _in_windows(summaries, windows)
    slacks = found.groupBy("window", "day").agg(F.max("slack").alias("slack"), F.sum("weight").alias("rows")).groupBy(
        F.col("window").alias("_window")
    ).agg(F.sum("slack").alias("most_error"), F.sum("rows").alias("rows"))
    merged = found.groupBy("window", "value").agg(F.sum("weight").alias("weight"))
    placed = rolling.in_order(merged, ["window", "value"], "cuts")
    before = rolling.totals_before(placed, ["window"], {"below": F.col("weight")}).select(F.col(rolling.AT).alias("_row"), "below")
    ranked = placed.join(before, F.col(rolling.AT) == F.col("_row")).join(slacks, F.col("window") == F.col("_window"))
    ranked = ranked.withColumn("upto", F.col("below") + F.col("weight"))
    return ranking.quantile_positions(ranked, "below", "upto", "rows", n).select(
        "window", "position", F.col("value").alias("cut"), "most_error"
    )
