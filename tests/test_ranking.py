import random
from bisect import bisect_right
from datetime import date

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from vulnlake.functions.risk import blended_score
from vulnlake.operators import ranking

DAYS = [date(2024, 1, d) for d in (1, 2, 3, 4)]


def _rows(n, seed, score=lambda: random.random(), rate=0.2):
    random.seed(seed)
    return [(i, DAYS[i % 3], score(), 1 if random.random() < rate else 0) for i in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id int, day date, score double, label int")


def _pr(rows):
    """Area by the definition: all thresholds, trapezoids, first point at the first precision."""
    total = sum(r[1] for r in rows)
    points, tp, n = [], 0, 0
    for s in sorted({r[0] for r in rows}, reverse=True):
        tp += sum(r[1] for r in rows if r[0] == s)
        n += sum(1 for r in rows if r[0] == s)
        points.append((tp / total, tp / n))
    points.insert(0, (0.0, points[0][1]))
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:]))


@pytest.mark.parametrize(
    "score",
    [
        lambda: random.random(),
        lambda: float(random.randint(0, 5)),
        lambda: random.choice([0.03, 0.030000001, 0.030000002, 0.9]),
        lambda: 0.5,
        lambda: random.uniform(-1e6, 1e6),
    ],
)
def test_pr_and_roc_equal_the_evaluator(spark, score):
    rows = _rows(300, 3, score)
    df = _frame(spark, rows)
    got = ranking.classification_metrics(df, "score", "label").first()
    wrapped = df.withColumn("v", array_to_vector(F.array(F.lit(0.0), F.col("score"))))
    for name, metric in (("area_under_pr", "areaUnderPR"), ("area_under_roc", "areaUnderROC")):
        want = BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol="v", metricName=metric, numBins=0
        ).evaluate(wrapped)
        assert got[name] == pytest.approx(want, abs=1e-12)
    assert got["area_under_pr"] == pytest.approx(_pr([(r[2], r[3]) for r in rows]), abs=1e-12)


@pytest.mark.parametrize("outlier", [[], [(1000, DAYS[0], 1e6, 1)]])
def test_many_ranges_give_the_same_area(spark, outlier):
    rows = _rows(500, 5) + outlier
    df = _frame(spark, rows)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        totals = ranking.running_totals(ranking.threshold_counts(df, "score", "label"))
        got = ranking.pr_auc(df, "score", "label").first()[0]
        per_date = {r["day"]: r["pr_auc"] for r in ranking.pr_auc(df, "score", "label", ["day"]).collect()}
        ordered = [(r["tp"], r["cnt"]) for r in totals.orderBy(F.desc("threshold")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == pytest.approx(_pr([(round(r[2], 9), r[3]) for r in rows]), abs=1e-12)
    for day, area in per_date.items():
        assert area == pytest.approx(_pr([(round(r[2], 9), r[3]) for r in rows if r[1] == day]), abs=1e-12)
    assert ordered == sorted(ordered) and ordered[-1] == (sum(r[3] for r in rows), len(rows))


def test_null_labels_and_scores_are_left_out(spark):
    rows = _rows(100, 9)
    df = _frame(spark, rows + [(1000, DAYS[0], 0.99, None), (1001, DAYS[0], None, 1)])
    assert ranking.pr_auc(df, "score", "label").first()[0] == pytest.approx(_pr([(r[2], r[3]) for r in rows]))


def test_by_date_skips_dates_without_positives(spark):
    rows = _rows(200, 11) + [(900 + i, DAYS[3], i / 10, 0) for i in range(5)]
    df = _frame(spark, rows)
    got = ranking.pr_auc_by_date(df, "score", "label", "day").first()
    per_date = [_pr([(r[2], r[3]) for r in rows if r[1] == d]) for d in DAYS[:3]]
    assert (got["dates_scored"], got["dates_without_positives"]) == (3, 1)
    assert got["macro_pr_auc"] == pytest.approx(sum(per_date) / 3)


def _hits(rows, k):
    return sum(r[3] for r in sorted(rows, key=lambda r: (-r[2], r[0]))[:k])


def test_top_k(spark):
    rows = _rows(200, 13, lambda: float(random.randint(0, 20)))
    df = _frame(spark, rows)
    total = sum(r[3] for r in rows)
    for k in (1, 10, 150, 500):
        got = ranking.top_k(df, "score", "label", k, "id").first()
        assert got["precision_at_k"] == pytest.approx(_hits(rows, k) / k)
        assert got["recall_at_k"] == pytest.approx(_hits(rows, k) / total)
        assert (got["k"], got["positives_total"]) == (k, total)
    dated = ranking.top_k_by_date(df, "score", "label", 10, "id", "day").first()
    per = [[r for r in rows if r[1] == d] for d in DAYS[:3]]
    assert dated["mean_precision_at_k"] == pytest.approx(sum(_hits(p, 10) / 10 for p in per) / 3)
    assert dated["mean_recall_at_k"] == pytest.approx(sum(_hits(p, 10) / sum(r[3] for r in p) for p in per) / 3)


def test_top_k_without_positives_or_rows(spark):
    none = _frame(spark, [(1, DAYS[0], 0.5, 0)])
    got = ranking.top_k(none, "score", "label", 5, "id").first()
    assert (got["precision_at_k"], got["recall_at_k"], got["positives_total"]) == (0.0, 0.0, 0)
    empty = ranking.top_k(none.filter("id = 2"), "score", "label", 5, "id").first()
    assert (empty["precision_at_k"], empty["recall_at_k"], empty["positives_total"]) == (0.0, 0.0, 0)
    assert ranking.top_k_by_date(none, "score", "label", 5, "id", "day").first()["dates_scored"] == 0


def test_compare_scores_agrees_with_the_single_metrics(spark):
    df = _frame(spark, _rows(200, 17)).withColumn("other", F.round(F.col("score") * 7 % 1, 2))
    both = {r["score_name"]: r for r in ranking.compare_scores(df, ["score", "other"], "label", 10, "id", "day").collect()}
    for name in ("score", "other"):
        assert both[name]["pr_auc"] == pytest.approx(ranking.pr_auc(df, name, "label").first()[0])
        assert both[name]["precision_at_k"] == ranking.top_k(df, name, "label", 10, "id").first()["precision_at_k"]
        dated = ranking.pr_auc_by_date(df, name, "label", "day").first()
        assert both[name]["macro_pr_auc"] == pytest.approx(dated["macro_pr_auc"])


def test_exact_cuts_against_sorted_rows(spark):
    for n_rows in (1, 5, 100, 257):
        rows = _rows(n_rows, n_rows, lambda: float(random.randint(0, 40)) / 4)
        ordered = sorted(r[2] for r in rows)
        want = [ordered[max(-(-i * n_rows // 100), 1) - 1] for i in range(101)]
        got = ranking.exact_percentile_cuts(_frame(spark, rows), "score").orderBy("position").collect()
        assert [r["position"] for r in got] == list(range(101)) and [r["cut"] for r in got] == want


def test_approximate_cuts_are_close_and_monotone(spark):
    df = _frame(spark, _rows(2000, 23))
    exact = [r["cut"] for r in ranking.exact_percentile_cuts(df, "score").orderBy("position").collect()]
    approx = [r["cut"] for r in ranking.percentile_cuts(df, "score").orderBy("position").collect()]
    assert len(approx) == 101 and approx == sorted(approx)
    assert max(abs(a - b) for a, b in zip(exact, approx)) < 0.01


def test_add_percentile(spark):
    df = _frame(spark, _rows(300, 29))
    cuts = ranking.exact_percentile_cuts(df, "score")
    values = sorted(r["cut"] for r in cuts.collect())
    for row in ranking.add_percentile(df, "score", cuts).collect():
        assert row["percentile"] == round(100.0 * bisect_right(values, row["score"]) / 101, 2)


def test_weight_grid_and_tuning(spark):
    grid = ranking.weight_grid()
    assert len(grid) == 231 and grid[0] == (0.0, 0.0, 1.0) and grid[-1] == (1.0, 0.0, 0.0)
    assert all(abs(sum(w) - 1) < 1e-12 for w in grid) and grid == sorted(grid)
    random.seed(31)
    rows = [(random.randint(0, 100) / 10, random.random(), random.random(), int(random.random() < 0.3)) for _ in range(150)]
    df = spark.createDataFrame(rows, "c double, p double, q double, label int")
    tuned = {(r["w1"], r["w2"], r["w3"]): r["pr_auc"] for r in ranking.tune_weights(df, "c", "p", "q", "label").collect()}
    assert set(tuned) == set(grid)
    for w in (grid[0], grid[100], grid[230]):
        scored = df.withColumn("s", blended_score(F.col("c"), F.col("p"), F.col("q"), *w))
        assert tuned[w] == pytest.approx(ranking.pr_auc(scored, "s", "label").first()[0], abs=1e-9)
    best = ranking.best_weights(ranking.tune_weights(df, "c", "p", "q", "label")).first()
    assert best["pr_auc"] == max(tuned.values())


def test_equal_areas_keep_the_first_grid_point(spark):
    df = spark.createDataFrame([(5.0, 0.5, 0.5, 1), (5.0, 0.5, 0.5, 0)], "c double, p double, q double, label int")
    best = ranking.best_weights(ranking.tune_weights(df, "c", "p", "q", "label")).first()
    assert (best["w1"], best["w2"], best["w3"]) == (0.0, 0.0, 1.0)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0), (None, 1.0), (1.0, None)], "p double, t double")
    got = ranking.regression_metrics(df, "p", "t").first()
    assert got["rmse"] == pytest.approx((2 / 3) ** 0.5) and got["mae"] == pytest.approx(2 / 3)
    assert got["r2"] == pytest.approx(1 - 2 / (2 / 3))


def test_tiny_scores_keep_their_order(spark):
    rows = spark.createDataFrame([(i * 1e-11, int(i == 10)) for i in range(1, 11)], "s double, y int")
    assert ranking.pr_auc(rows, "s", "y").first()[0] == 1.0


def test_null_group_is_a_group(spark):
    rows = spark.createDataFrame([("a", 0.1, 1, 1), (None, 0.2, 1, 2), (None, 0.3, 0, 3)], "g string, s double, y int, i int")
    assert {r.g: r.pr_auc for r in ranking.pr_auc(rows, "s", "y", ["g"]).collect()}.keys() == {"a", None}
    top = {r.g: r.positives_total for r in ranking.top_k_per_group(rows, "s", "y", 1, "i", ["g"]).collect()}
    assert top == {"a": 1, None: 1}


def test_percentile_with_any_number_of_cuts(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(1000)], "s double")
    for n in (2, 101, 201, 901):
        cuts = ranking.exact_percentile_cuts(rows, "s", n)
        found = {r.s: r.percentile for r in ranking.add_percentile(rows, "s", cuts).collect()}
        points = sorted(r.cut for r in cuts.collect())
        assert len(points) == n
        assert all(found[x] == round(100.0 * sum(c <= x for c in points) / n, 2) for x in (0.0, 499.0, 998.0, 999.0))
