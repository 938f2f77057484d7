"""Score a table of CVSS vectors with the stored models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.functions import cvss
from vulnlake.functions.risk import blended_score, priority
from vulnlake.operators.learning import PREDICTED_EPSS, PREDICTED_KEV
from vulnlake.operators.ranking import add_percentile
from vulnlake.plans.training import ADJUSTED, score_rows
from vulnlake.schemas import CVSS_CATEGORICAL, CVSS_NUMERIC


def with_decoded(df: DataFrame, vector: str = "cvss_vector", base_score: str | None = None) -> DataFrame:
    """Add the categorical columns and, where the input lacks them, scores and zero counts."""
    parsed = df.withColumn("_p", cvss.parse(F.col(vector)))
    decoded = parsed.withColumns({"_d": cvss.decode(F.col("_p")), "_s": cvss.score(F.col("_p"))})
    base = F.col("_s.base_score") if base_score is None else F.col(base_score)
    given = set(df.columns)
    computed = {
        "cvss_base_score": base,
        "exploitability_score": F.col("_s.exploitability_score"),
        "impact_score": F.col("_s.impact_score"),
    }
    numbers = {
        name: computed.get(name, F.lit(0)) for name in CVSS_NUMERIC if name not in given or name == base_score
    }
    words = {name: F.col(f"_d.{name}") for name in CVSS_CATEGORICAL if name not in given}
    return decoded.withColumns({**words, **numbers}).drop("_p", "_d", "_s")


def score_vectors(
    df: DataFrame,
    exploit_model: PipelineModel,
    outcome_model: PipelineModel,
    weights: tuple[float, float, float],
    *,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add both predictions, the blended score and, with cut points, its percentile and priority."""
    scored = score_rows(df, exploit_model, outcome_model)
    scored = scored.withColumn(
        ADJUSTED,
        blended_score(F.col("cvss_base_score"), F.col(PREDICTED_EPSS), F.col(PREDICTED_KEV), *weights),
    ).withColumn("cvss_only_priority", F.col("cvss_base_score"))
    if cuts is None:
        return scored
    ranked = add_percentile(scored, ADJUSTED, cuts, "adjusted_risk_percentile")
    return ranked.withColumn("priority_0_10", priority(F.col("adjusted_risk_percentile")))
