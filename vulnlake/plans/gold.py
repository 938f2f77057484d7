"""The observation dataset: one row per (key, day) with features known that day and later labels.

Shuffles: the series once by (key, day) to pick the latest fetch, once by key for all trailing
windows; dimension and outcomes once by key. The joins reuse the window's partitioning by key.
Nothing is cached or collected; the as-of date enters as a literal or a scalar subquery.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.operators import cohort, labels, latest, series
from vulnlake.sources import tables

NVD_COLUMNS = [
    "cvss_base_score",
    "cvss_version",
    "cvss_base_severity",
    "cvss_vector",
    "attack_vector",
    "attack_complexity",
    "privileges_required",
    "user_interaction",
    "scope",
    "confidentiality_impact",
    "integrity_impact",
    "availability_impact",
    "exploitability_score",
    "impact_score",
    "cwe_ids",
    "reference_count",
    "cpe_match_count",
]


def observations(
    daily: DataFrame,
    dimension: DataFrame,
    outcomes: DataFrame,
    *,
    key: str,
    day: str,
    score: str,
    published: str,
    added: str,
    as_of: date | Column,
    horizons: tuple[int, ...] = labels.HORIZONS,
    censor_days: int | None = None,
    keep: tuple[str, ...] = (),
    lags: tuple[int, ...] = (1, 7, 30),
    windows: tuple[int, ...] = (7, 30),
    thresholds: tuple[float, ...] = series.THRESHOLDS,
    prefix: str = "epss",
    label: str = "kev",
) -> DataFrame:
    """Gold rows from already de-duplicated inputs.

    `daily` has one row per (key, day), `dimension` one per key with the date `published`, `outcomes`
    one per key with the date `added`. Days after the censoring limit can never be part of an earlier
    day's lookback, so the limit applies to the series itself and reaches its scan. Cohort filters
    that depend on the key's record come after the windows, which need the unfiltered lookback.
    """
    limit = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    complete = cohort.right_censor(daily, day, limit, max(horizons) if censor_days is None else censor_days)
    features = series.trailing_features(
        complete, key, day, score, prefix=prefix, lags=lags, windows=windows, thresholds=thresholds, keep=keep
    )
    eligible = cohort.published_by(features.join(dimension, key), published, day)
    dates = outcomes.select(key, F.col(added).alias(f"{label}_date_added"))
    at_risk = eligible.join(dates, key, "left").filter(
        F.col(f"{label}_date_added").isNull() | (F.col(f"{label}_date_added") > F.col(day))
    )
    labelled = labels.label_columns(at_risk, day, f"{label}_date_added", limit, horizons, label)
    return labelled.withColumns(
        {
            "vulnerability_age_days": F.datediff(F.col(day), F.col(published)),
            "observation_year": F.year(day),
            "observation_month": F.month(day),
        }
    )


def nvd_dimension(nvd: DataFrame) -> DataFrame:
    """Latest record per CVE with the derived columns of the dataset."""
    newest = latest.latest(nvd, ["cve_id"], "fetched_at", ["event_id"])
    return newest.select(
        "cve_id",
        *NVD_COLUMNS,
        F.col("published_at").alias("nvd_published_at"),
        F.col("fetched_at").alias("nvd_fetched_at"),
        F.to_date("published_at").alias("published_date"),
        F.size("cwe_ids").alias("cwe_count"),
        F.col("cvss_base_score").isNotNull().cast("int").alias("has_cvss"),
    )


def build_observations(
    nvd: DataFrame,
    epss: DataFrame,
    kev: DataFrame,
    *,
    label_as_of_date: date | None = None,
    horizons: tuple[int, ...] = labels.HORIZONS,
    censor_days: int | None = None,
) -> DataFrame:
    """Gold from the three Silver tables; empty tables give a frame with the same columns."""
    if label_as_of_date is None:
        as_of = cohort.as_of_date(kev, epss).scalar()
    else:
        as_of = F.lit(label_as_of_date).cast("date")
    return observations(
        latest.latest(epss, ["cve_id", "observation_date"], "fetched_at", ["event_id"]),
        nvd_dimension(nvd),
        latest.earliest_date(kev, "cve_id", "date_added"),
        key="cve_id",
        day="observation_date",
        score="epss_score",
        published="published_date",
        added="date_added",
        as_of=as_of,
        horizons=horizons,
        censor_days=censor_days,
        keep=("epss_percentile", "epss_model_version"),
    ).withColumnRenamed("epss_percentile", "epss_percentile_current")


def run_gold(spark: SparkSession, silver_root: str, gold_root: str, **options) -> DataFrame:
    """Silver on disk to Gold on disk; returns the written table."""
    nvd, epss, kev = (tables.read_silver(spark, silver_root, s) for s in ("nvd", "epss", "kev"))
    tables.write_observations(build_observations(nvd, epss, kev, **options), gold_root)
    return tables.read_observations(spark, gold_root)
