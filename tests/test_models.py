import random
from datetime import date, timedelta

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from vulnlake import session
from vulnlake.operators import learning, splits
from vulnlake.plans import scoring, training

VECTORS = [
    f"CVSS:3.1/AV:{av}/AC:{ac}/PR:{pr}/UI:N/S:U/C:{c}/I:H/A:L"
    for av in "NALP" for ac in "LH" for pr in "NLH" for c in "HLN"
]


@pytest.fixture(scope="module")
def observations(spark, tmp_path_factory):
    """Network vectors carry a high score and become positives; everything else rarely does."""
    random.seed(41)
    rows = []
    for i in range(1800):
        vector = random.choice(VECTORS)
        network = "AV:N" in vector
        score = min(1.0, max(0.0, (0.7 if network else 0.1) + random.gauss(0, 0.05)))
        label = int(random.random() < (0.6 if network else 0.03))
        rows.append((f"CVE-2024-{i:05d}", date(2024, 1, 1) + timedelta(days=i % 50), vector, score, label))
    df = spark.createDataFrame(
        rows, "cve_id string, observation_date date, cvss_vector string, epss_current double, kev_within_90_days int"
    )
    path = str(tmp_path_factory.mktemp("obs"))
    scoring.with_decoded(df).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_collapsed_training_equals_training_on_rows(spark, observations):
    cats, nums = learning.CVSS_CATEGORICAL, learning.CVSS_NUMERIC
    model = learning.train_exploit_model(observations, max_iter=5)
    mine = learning.apply_exploit_model(model, observations)
    stages = learning.feature_stages(cats, nums, "f")
    raw = GBTRegressor(featuresCol="f", labelCol="epss_current", predictionCol="p", maxIter=5, maxDepth=5, seed=42)
    rows = learning.fill_zero(observations, nums)
    theirs = Pipeline(stages=[*stages, raw]).fit(rows).transform(rows).select("cve_id", "p")
    gap = mine.join(theirs, "cve_id").agg(F.max(F.abs(F.col("pred_epss") - F.col("p")))).first()[0]
    assert gap < 0.02
    again = learning.apply_exploit_model(learning.train_exploit_model(observations, max_iter=5), observations)
    same = mine.select("cve_id", "pred_epss").join(again.select("cve_id", F.col("pred_epss").alias("q")), "cve_id")
    assert same.filter(F.abs(F.col("pred_epss") - F.col("q")) > 1e-9).count() == 0


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "label int")
    got = {r["label"]: r["class_weight"] for r in learning.balanced_weight(df, "label").collect()}
    assert got == {1: 2.0, 0: pytest.approx(4 / 6)}
    one = learning.balanced_weight(df.filter("label = 0"), "label").first()
    assert one["class_weight"] == 0.5
    rows = spark.createDataFrame([(1, 1.0), (0, 3.0)], "label int, n double")
    collapsed = {r["label"]: r["class_weight"] for r in learning.balanced_weight(rows, "label", rows="n").collect()}
    assert collapsed == {1: 2.0, 0: pytest.approx(2.0)}


def test_unseen_and_null_categories_are_kept(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, n double")
    test = spark.createDataFrame([("zzz", 1.0), (None, 1.0)], "c string, n double")
    model = Pipeline(stages=learning.feature_stages(["c"], ["n"], "f")).fit(train)
    assert model.transform(test).count() == 2


def test_training_scoring_and_reload(spark, observations, tmp_path):
    report = training.run_training(observations, max_iter=5, max_depth=3, k=20, model_dir=str(tmp_path))
    found = {(r["section"], r["item"], r["metric"]): r["value"] for r in report.collect()}
    assert found[("splits", "train", "rows")] + found[("splits", "val", "rows")] + found[("splits", "test", "rows")] == 1800
    assert found[("model_a", "test", "r2")] > 0.9
    assert found[("model_b", "test", "area_under_roc")] > 0.8
    assert found[("test_ranking", "adjusted_risk", "pr_auc")] > found[("test_ranking", "cvss_base_score", "pr_auc")]
    weights = training.load_weights(spark, str(tmp_path))
    assert sum(weights) == pytest.approx(1.0)
    assert training.load_weights(spark, str(tmp_path / "none")) == training.DEFAULT_WEIGHTS
    cuts = spark.read.parquet(f"{tmp_path}/score_percentiles")
    assert cuts.count() == 101
    vectors = spark.createDataFrame([(VECTORS[0],), (VECTORS[-1],), ("junk",)], "cvss_vector string")
    scored = scoring.score_vectors(
        scoring.with_decoded(vectors), *training.load_models(str(tmp_path)), weights, cuts=cuts
    ).collect()
    rows = {r["cvss_vector"]: r for r in scored}
    high, low = rows[VECTORS[0]], rows[VECTORS[-1]]
    assert high["pred_kev_prob"] > low["pred_kev_prob"] and high["adjusted_risk"] > low["adjusted_risk"]
    assert all(0 <= r["pred_epss"] <= 1 and 0 <= r["pred_kev_prob"] <= 1 for r in scored)
    assert all(0 <= r["adjusted_risk_percentile"] <= 100 and 0 <= r["priority_0_10"] <= 10 for r in scored)
    given = scoring.with_decoded(vectors.withColumn("cvss_base_score", F.lit(7.0)))
    assert {r["cvss_base_score"] for r in given.collect()} == {7.0}


def test_too_few_positives(spark, observations):
    with pytest.raises(ValueError, match="positives"):
        training.run_training(observations, max_iter=1, min_positives={"train": 10**6})


def _days(spark, n):
    return spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=i),) for i in range(n)] * 2, "day date")


@pytest.mark.parametrize("n", [3, 4, 5, 10, 17, 72])
def test_split_bounds(spark, n):
    row = splits.split_bounds(_days(spark, n), "day").first()
    train_n, val_n = max(1, int(n * 0.6)), max(1, int(n * 0.2))
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(n)]
    assert (row["train_count"], row["val_count"], row["test_count"]) == (train_n, val_n, n - train_n - val_n)
    assert (row["train_start"], row["train_end"]) == (days[0], days[train_n - 1])
    assert (row["val_start"], row["val_end"]) == (days[train_n], days[train_n + val_n - 1])
    assert (row["test_start"], row["test_end"]) == (days[train_n + val_n], days[-1])


def test_too_few_dates_raise(spark):
    with pytest.raises(Exception, match="not enough distinct dates"):
        splits.split_bounds(_days(spark, 2), "day").collect()


def test_splits_are_disjoint_ordered_and_complete(spark):
    df = _days(spark, 23).withColumn("label", F.lit(1))
    parts = splits.assign_splits(df, splits.split_bounds(df, "day"), "day")
    spans = {r["split"]: (r["a"], r["b"], r["n"]) for r in parts.groupBy("split").agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count("*").alias("n")).collect()}
    assert spans["train"][1] < spans["val"][0] and spans["val"][1] < spans["test"][0]
    assert sum(s[2] for s in spans.values()) == 46
    assert splits.require_positives(splits.split_counts(parts, "label"), {"train": 1})["val"]["rows"] == spans["val"][2]


def test_date_slices_prune_the_stored_months(spark, tmp_path):
    df = _days(spark, 100).withColumns({"observation_year": F.year("day"), "observation_month": F.month("day")})
    df.write.partitionBy("observation_year", "observation_month").parquet(f"{tmp_path}/o")
    stored = spark.read.parquet(f"{tmp_path}/o")
    start, end = date(2024, 2, 10), date(2024, 3, 5)
    got = splits.date_slice(stored, "day", start, end)
    assert got.count() == 2 * 25 and splits.date_slice(df.drop("observation_year"), "day", start, end).count() == 50
    plan = got._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "observation_year" in pruned and "observation_month" in pruned


class _Session:
    """Stands in for a session that has no shared folder."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()


def test_shared_folder(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    local = _Session("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
    with pytest.raises(ValueError):
        session.shared_dir(_Session("spark://host:7077"))


def test_models_are_asked_once_per_combination(spark, observations):
    """The same predictions as over the rows, nulls and unseen values among them; no model runs over the rows themselves."""
    cats, nums = learning.CVSS_CATEGORICAL, learning.CVSS_NUMERIC
    odd = observations.limit(40).withColumns({
        "cve_id": F.concat(F.lit("odd-"), "cve_id"), cats[0]: F.lit(None).cast("string"), cats[1]: F.lit("unseen"),
        nums[0]: F.lit(None).cast(observations.schema[nums[0]].dataType), nums[1]: F.lit(float("nan")).cast(observations.schema[nums[1]].dataType),
    })
    rows = observations.unionByName(odd)
    exploit = learning.train_exploit_model(observations, max_iter=3)
    predicted = learning.apply_exploit_model(exploit, rows)
    outcome = learning.train_outcome_model(learning.apply_exploit_model(exploit, observations), max_iter=3)
    done = learning.apply_outcome_model(outcome, predicted)
    assert done.columns == [*rows.columns, "pred_epss", "pred_kev_prob"]
    clamped = learning.clamp_unit(F.col("pred_epss"))
    plain = exploit.transform(learning.fill_zero(rows, nums)).withColumn("pred_epss", clamped).select(*rows.columns, "pred_epss")
    plain = outcome.transform(plain).select("cve_id", "pred_epss", learning.vector_to_array("probability")[1].alias("pred_kev_prob"))
    want = {r[0]: r[1:] for r in map(tuple, plain.collect())}
    got = {r[0]: r[1:] for r in map(tuple, done.select("cve_id", "pred_epss", "pred_kev_prob").collect())}
    assert len(want) == rows.count() == done.count() and got == want
    assert "UDF" not in done._jdf.queryExecution().toString()
