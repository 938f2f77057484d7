"""Feature stages, class weights and the two gradient-boosted models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.functions.risk import clamp_unit
from vulnlake.schemas import CVSS_CATEGORICAL, CVSS_NUMERIC
from vulnlake.session import cut_lineage

TARGET = "epss_current"
LABEL = "kev_within_90_days"
PREDICTED_EPSS = "pred_epss"
PREDICTED_KEV = "pred_kev_prob"
WEIGHT = "class_weight"
ROWS = "n_rows"


def feature_stages(
    categorical: list[str], numeric: list[str], output: str = "features", prefix: str = ""
) -> list:
    """Index, one-hot encode and assemble; unseen and null categories get their own slot.

    `prefix` keeps the helper columns of two pipelines on one frame apart.
    """
    indexed = [f"{prefix}{c}_idx" for c in categorical]
    encoded = [f"{prefix}{c}_oh" for c in categorical]
    return [
        StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        VectorAssembler(inputCols=encoded + numeric, outputCol=output, handleInvalid="keep"),
    ]


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.fillna(0.0, subset=columns)


def collapse(df: DataFrame, features: list[str], *, label: str | None = None, target: str | None = None) -> DataFrame:
    """One weighted row per distinct feature combination (and label), with the mean target.

    The features describe the vulnerability and not the day, so the daily rows of one vulnerability
    agree on them. Squared error and log loss have the same objective over weighted distinct rows as over
    the rows themselves, which turns every boosting pass from all rows into the distinct ones. Split candidates are
    sampled from other rows, so trees can differ where rows are many. The result is written once to the shared folder,
    as each fitting stage reads it again, in partitions of the size that adaptive execution aims at.
    """
    keys = [*features, label] if label is not None else features
    values = [F.avg(target).alias(target)] if target is not None else []
    grouped = df.groupBy(*keys).agg(F.count("*").cast("double").alias(ROWS), *values)
    return cut_lineage(grouped.hint("rebalance"), "training")


def by_combination(model: PipelineModel, df: DataFrame, keys: list[str], value: Column, output: str) -> DataFrame:
    """Add `output`, the value that the model gives to a row's `keys`, which must be all columns it reads.

    The daily rows of one vulnerability agree on its features, so the model is asked once per distinct combination, and its answers are
    written to the shared folder and joined to the rows; nulls and NaN are values like others. Combinations are few bytes and much
    work, so they are dealt to all cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    distinct = model.transform(df.select(*keys).distinct().repartition(cores))
    answers = cut_lineage(distinct.select(*(F.col(k).alias(f"_of_{k}") for k in keys), value.alias(output)), "answers")
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys))
    return df.join(answers, same, "left").select(*df.columns, output)


def balanced_weight(
    df: DataFrame, label: str = LABEL, weight: str = WEIGHT, rows: str | None = None
) -> DataFrame:
    """total / (2 * rows of the class), so both classes weigh the same; 1 for an absent class.

    With `rows` a row stands for that many and its weight is multiplied. The class counts are one
    aggregated row read as scalar subqueries: no window over two huge label groups, no join, no collect.
    """
    n = F.lit(1.0) if rows is None else F.col(rows)
    counts = df.agg(
        F.sum(F.when(F.col(label).isNotNull(), n)).alias("total"),
        F.sum(F.when(F.col(label) == 1, n)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, n)).alias("neg"),
    )

    def of(column: str):
        return counts.select(F.coalesce(F.col("total") / (F.col(column) * 2), F.lit(1.0))).scalar()

    return df.withColumn(weight, n * F.when(F.col(label) == 1, of("pos")).otherwise(of("neg")))


def train_exploit_model(
    df: DataFrame,
    *,
    target: str = TARGET,
    categorical: list[str] = CVSS_CATEGORICAL,
    numeric: list[str] = CVSS_NUMERIC,
    seed: int = 42,
    max_iter: int = 40,
    max_depth: int = 5,
) -> PipelineModel:
    """Regression of the observed score on the vector's features."""
    model = GBTRegressor(
        featuresCol="features_a", labelCol=target, weightCol=ROWS, predictionCol=PREDICTED_EPSS,
        maxIter=max_iter, maxDepth=max_depth, seed=seed,
    )
    indexer, *stages = feature_stages(categorical, numeric, "features_a", "a_")
    rows = fill_zero(df.select(*categorical, *numeric, target).filter(F.col(target) >= 0.0), numeric)
    weighted = collapse(rows, [*categorical, *numeric], target=target)
    # categories are ordered by how many rows have them, not by how many distinct combinations
    return Pipeline(stages=[indexer.fit(rows), *stages, model]).fit(weighted)


def apply_exploit_model(model: PipelineModel, df: DataFrame, numeric: list[str] = CVSS_NUMERIC) -> DataFrame:
    """Add the predicted score, limited to [0, 1]."""
    keys = [*model.stages[0].getInputCols(), *numeric]
    return by_combination(model, fill_zero(df, numeric), keys, clamp_unit(F.col(PREDICTED_EPSS)), PREDICTED_EPSS)


def train_outcome_model(
    df: DataFrame,
    *,
    label: str = LABEL,
    categorical: list[str] = CVSS_CATEGORICAL,
    numeric: list[str] = CVSS_NUMERIC,
    seed: int = 42,
    max_iter: int = 40,
    max_depth: int = 5,
) -> PipelineModel:
    """Weighted classification of the label on the vector's features and the predicted score."""
    inputs = [*numeric, PREDICTED_EPSS]
    model = GBTClassifier(
        featuresCol="features_b", labelCol=label, weightCol=WEIGHT,
        maxIter=max_iter, maxDepth=max_depth, seed=seed,
    )
    indexer, *stages = feature_stages(categorical, inputs, "features_b", "b_")
    rows = fill_zero(df.select(*categorical, *inputs, label).filter(F.col(label).isNotNull()), inputs)
    weighted = collapse(rows, [*categorical, *inputs], label=label)
    return Pipeline(stages=[indexer.fit(rows), *stages, model]).fit(balanced_weight(weighted, label, rows=ROWS))


def apply_outcome_model(model: PipelineModel, df: DataFrame, numeric: list[str] = CVSS_NUMERIC) -> DataFrame:
    """Add the probability of a positive label."""
    inputs = [*numeric, PREDICTED_EPSS]
    keys = [*model.stages[0].getInputCols(), *inputs]
    return by_combination(model, fill_zero(df, inputs), keys, vector_to_array(F.col("probability")).getItem(1), PREDICTED_KEV)
