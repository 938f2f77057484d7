"""Shapes of the physical plans that matter at scale."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.operators import latest, learning, ranking, series
from vulnlake.plans import gold, normalize
from vulnlake.sources import tables


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("silver"))
    for source, (name, _) in schemas.SILVER.items():
        spark.createDataFrame([], schemas.silver(source)).write.parquet(f"{root}/{name}/load=a/batch=0")
    return [tables.read_silver(spark, root, s) for s in ("nvd", "epss", "kev")]


def test_gold_shuffles_the_series_twice_and_joins_without_another(spark, silver, no_broadcast):
    plan = _plan(gold.build_observations(*silver, label_as_of_date=date(2024, 6, 1)))
    assert plan.count("Exchange hashpartitioning") == 4
    assert plan.count("SortMergeJoin") == 2 and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert len(re.findall(r"^\W*Window \[", plan, re.M)) == 3


def test_gold_filter_and_columns_reach_the_scan(silver):
    plan = _plan(gold.build_observations(*silver, label_as_of_date=date(2024, 6, 1)))
    assert "LessThanOrEqual(observation_date,2024-03-03)" in plan
    for unused in ("description_en", "reference_urls", "source_identifier", "short_description"):
        assert unused not in plan


def test_all_frames_share_one_window(spark):
    daily = spark.range(10).select(
        (F.col("id") % 3).alias("k"), F.lit("2024-01-01").cast("date").alias("d"), F.col("id").cast("double").alias("s")
    )
    plan = _plan(series.trailing_features(daily, "k", "d", "s"))
    assert plan.count("Exchange") == 1 and len(re.findall(r"^\W*Window \[", plan, re.M)) == 1


def test_range_join_is_an_equi_join(spark, no_broadcast):
    daily = spark.range(10).select((F.col("id") % 3).alias("k"), F.lit("2024-01-01").cast("date").alias("d"))
    plan = _plan(series.range_join(daily, daily, "k", "d", 30, []))
    assert "SortMergeJoin [k" in plan and "NestedLoop" not in plan


def test_top_k_cuts_each_group_before_the_shuffle(spark):
    rows = spark.range(100_000).select("id", (F.col("id") % 3).alias("day"), F.col("id").alias("score"), F.lit(1).alias("label"))
    plan = _plan(ranking.top_k_per_group(rows, "score", "label", 5000, "id", ["day"]))
    assert plan.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in _plan(ranking.top_k(rows, "score", "label", 5, "id"))


def test_weights_need_no_join_and_no_window(spark):
    plan = _plan(learning.balanced_weight(spark.range(9).select((F.col("id") % 2).alias("label")), "label"))
    assert "Join" not in plan and "Window" not in plan


def test_normalisation_is_one_stage_without_shuffle_or_python(spark):
    for source, normalizer in normalize.NORMALIZERS.items():
        df = spark.createDataFrame([], schemas.bronze(source))
        plan = _plan(normalizer(df))
        assert "Exchange" not in plan and "Python" not in plan


def test_earliest_date_combines_before_the_shuffle(spark):
    plan = _plan(latest.earliest_date(spark.range(9).select((F.col("id") % 3).alias("k"), F.col("id").alias("d")), "k", "d"))
    assert "partial_min" in plan
