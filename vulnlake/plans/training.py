"""Train both models in time order, tune the blend, evaluate, and store everything."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.functions.risk import blended_score
from vulnlake.operators import learning, ranking, splits
from vulnlake.schemas import CVSS_CATEGORICAL, CVSS_NUMERIC
from vulnlake.session import cut_lineage

ADJUSTED = "adjusted_risk"
DEFAULT_WEIGHTS = (0.20, 0.30, 0.50)


def _long(df: DataFrame, section: str, keys: list[str]) -> DataFrame:
    """Metric columns as (section, item, metric, value) rows."""
    metrics = [c for c in df.columns if c not in keys]
    item = F.concat_ws("/", *keys) if keys else F.lit("all")
    typed = df.select(item.alias("item"), *(F.col(c).cast("double").alias(c) for c in metrics))
    return typed.unpivot(["item"], metrics, "metric", "value").select(F.lit(section).alias("section"), "*")


def score_rows(
    df: DataFrame, exploit_model: PipelineModel, outcome_model: PipelineModel, numeric: list[str] = CVSS_NUMERIC
) -> DataFrame:
    """Rows with both predictions."""
    return learning.apply_outcome_model(
        outcome_model, learning.apply_exploit_model(exploit_model, df, numeric), numeric
    )


def run_training(
    observations: DataFrame,
    *,
    key: str = "cve_id",
    day: str = "observation_date",
    target: str = learning.TARGET,
    label: str = learning.LABEL,
    base_score: str = "cvss_base_score",
    categorical: list[str] = CVSS_CATEGORICAL,
    numeric: list[str] = CVSS_NUMERIC,
    train_ratio: float = 0.60,
    val_ratio: float = 0.20,
    min_positives: dict[str, int] = splits.MIN_POSITIVES,
    k: int = 100,
    step: float = 0.05,
    seed: int = 42,
    max_iter: int = 40,
    max_depth: int = 5,
    model_dir: str | None = None,
) -> DataFrame:
    """The report as (section, item, metric, value) rows; models and tables go to `model_dir`.

    `observations` should be a stored table: it is scanned for the split dates, for each fit and for
    scoring. The scored validation and test rows are written once to the shared folder, since tuning
    and every metric read them again.
    """
    spark = observations.sparkSession
    # The bounds are one row of dates; as literals they prune the stored months of every later scan.
    found = splits.split_bounds(observations, day, train_ratio, val_ratio).first()
    bounds = spark.createDataFrame([found])
    name = splits.split_name(day, F.lit(found["train_end"]), F.lit(found["val_end"]))
    counts = cut_lineage(splits.split_counts(observations.withColumn("split", name), label), "split-counts")
    splits.require_positives(counts, min_positives)

    train = splits.date_slice(observations, day, end=found["train_end"])
    fit = dict(categorical=categorical, numeric=numeric, seed=seed, max_iter=max_iter, max_depth=max_depth)
    exploit_model = learning.train_exploit_model(train, target=target, **fit)
    predicted = learning.apply_exploit_model(exploit_model, train, numeric)
    outcome_model = learning.train_outcome_model(predicted, label=label, **fit)

    later = splits.date_slice(observations, day, start=found["val_start"]).withColumn("split", name)
    pred = [learning.PREDICTED_EPSS, learning.PREDICTED_KEV]
    columns = dict.fromkeys([key, day, "split", target, label, base_score, *pred])
    scored = cut_lineage(
        score_rows(later, exploit_model, outcome_model, numeric).select(*columns), "scored"
    )
    val, test = (scored.filter(F.col("split") == name) for name in ("val", "test"))

    tuned = ranking.best_weights(ranking.tune_weights(val, base_score, *pred, label, step=step)).first()
    weights = (tuned["w1"], tuned["w2"], tuned["w3"]) if tuned else DEFAULT_WEIGHTS
    blend = blended_score(F.col(base_score), *(F.col(p) for p in pred), *weights)
    weight_table = spark.createDataFrame(
        [(*weights, tuned["pr_auc"] if tuned else None)],
        "w1_cvss double, w2_exploit double, w3_kev double, validation_pr_auc double",
    )
    cuts = ranking.percentile_cuts(val.withColumn(ADJUSTED, blend), ADJUSTED)
    ranked, scores = test.withColumn(ADJUSTED, blend).withColumn(base_score, F.col(base_score).cast("double")), [base_score, ADJUSTED]
    score_counts = ranking.score_counts(ranked, scores, label, day)
    compared = ranking.compare_scores(ranked, scores, label, k, key, day, score_counts)
    dated = ranking.areas_by_date(score_counts, day).withColumn(day, F.col(day).cast("string"))
    sections = [
        _long(counts, "splits", ["split"]),
        _long(ranking.regression_metrics(scored, learning.PREDICTED_EPSS, target, ["split"]), "model_a", ["split"]),
        _long(ranking.classification_metrics(scored, learning.PREDICTED_KEV, label, ["split"]), "model_b", ["split"]),
        _long(weight_table, "weights", []),
        _long(compared, "test_ranking", ["score_name"]),
        _long(dated, "test_ranking_by_date", ["score_name", day]),
    ]
    report = reduce(DataFrame.unionByName, sections)
    if model_dir is not None:
        exploit_model.write().overwrite().save(f"{model_dir}/model_a_epss")
        outcome_model.write().overwrite().save(f"{model_dir}/model_b_kev")
        weight_table.write.mode("overwrite").parquet(f"{model_dir}/weights")
        cuts.write.mode("overwrite").parquet(f"{model_dir}/score_percentiles")
        report.write.mode("overwrite").parquet(f"{model_dir}/report")
        bounds.write.mode("overwrite").parquet(f"{model_dir}/split_bounds")
        return spark.read.parquet(f"{model_dir}/report")
    return cut_lineage(report, "report")


def load_models(model_dir: str) -> tuple[PipelineModel, PipelineModel]:
    return PipelineModel.load(f"{model_dir}/model_a_epss"), PipelineModel.load(f"{model_dir}/model_b_kev")


def load_weights(spark: SparkSession, model_dir: str) -> tuple[float, float, float]:
    """The stored weights (one row), or the defaults when none are stored."""
    from pyspark.errors import AnalysisException

    try:
        row = spark.read.parquet(f"{model_dir}/weights").first()
    except AnalysisException:
        return DEFAULT_WEIGHTS
    return (row["w1_cvss"], row["w2_exploit"], row["w3_kev"])
