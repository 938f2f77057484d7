"""States that merge over days, and pruned tuning, against the plain forms."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from vulnlake.operators import rank_state, ranking

D0 = date(2024, 1, 1)
WINDOWS = [("first", D0, D0 + timedelta(days=2)), ("all", D0, D0 + timedelta(days=30)), ("none", date(2020, 1, 1), date(2020, 2, 1))]


@pytest.fixture(autouse=True)
def several_ranges(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def _rows(seed, n=3000, distinct=None):
    rng = random.Random(seed)
    score = (lambda: float(rng.randrange(distinct))) if distinct else rng.random
    return [(D0 + timedelta(days=min(int(rng.expovariate(0.5)), 9)), score(), rng.randrange(2)) for _ in range(n)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "day date, score double, label int")


@pytest.mark.parametrize("distinct", [None, 7])
def test_areas_of_windows_are_those_of_the_rows(spark, tmp_path, distinct):
    rows = [*_rows(1, distinct=distinct), (None, 0.5, 1), (D0, None, 1), (D0, 0.5, None)]
    path = str(tmp_path / "state")
    early, late = [r for r in rows if r[0] is None or r[0] <= D0 + timedelta(days=1)], [r for r in rows if r[0] and r[0] > D0 + timedelta(days=1)]
    for part in (early, late, late):  # a day that is saved again is replaced
        rank_state.save_thresholds(_frame(spark, part), "score", "label", "day", path)
    got = {r["window"]: r for r in rank_state.window_metrics(rank_state.read_thresholds(spark, path), WINDOWS).collect()}
    assert set(got) == {"first", "all"}
    for name, a, b in WINDOWS[:2]:
        want = ranking.classification_metrics(_frame(spark, [r for r in rows if r[0] and a <= r[0] <= b]), "score", "label").first()
        assert got[name].area_under_pr == pytest.approx(want.area_under_pr, abs=1e-12)
        assert got[name].area_under_roc == pytest.approx(want.area_under_roc, abs=1e-12)


def test_only_days_of_the_windows_are_read(spark, tmp_path):
    path = str(tmp_path / "state")
    rank_state.save_thresholds(_frame(spark, _rows(2, 200)), "score", "label", "day", path)
    found = rank_state._in_windows(rank_state.read_thresholds(spark, path), WINDOWS[:1])
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert ">= 2024-01-01" in filters and "<= 2024-01-03" in filters
    assert {r.day for r in found.collect()} <= {D0 + timedelta(days=k) for k in range(3)}


def _summary(values, error):
    """Plain form: (value, weight) and slack of one day."""
    values, step = sorted(values), max(1, int(len(values) * error))
    points, before = {}, 0
    for rank, value in enumerate(values, 1):
        if rank % step == 0 or rank == len(values):
            points[value] = points.get(value, 0) + rank - before
            before = rank
    return points, step - 1


@pytest.mark.parametrize(("error", "distinct"), [(0.05, None), (0.2, 9), (0.0001, None), (0.9, None), (0.3, 1)])
def test_summaries_and_their_bound(spark, tmp_path, error, distinct):
    rows = [*_rows(3, 1500, distinct), (None, 0.5, 1), (D0, None, 1)]
    made = rank_state.summarise(_frame(spark, rows), "score", "day", error).collect()
    days = {}
    for day, score, _ in rows:
        if day and score is not None:
            days.setdefault(day, []).append(score)
    for day, values in days.items():
        points, slack = _summary(values, error)
        # equal values next to each other are one point
        assert {r.value: r.weight for r in made if r.day == day} == points
        assert {r.slack for r in made if r.day == day} == {slack}
    rank_state.save_summaries(_frame(spark, rows), "score", "day", str(tmp_path / "s"), error)
    cuts = rank_state.window_cuts(rank_state.read_summaries(spark, str(tmp_path / "s")), WINDOWS, 21).collect()
    for name, a, b in WINDOWS[:2]:
        values = sorted(v for d, own in days.items() if a <= d <= b for v in own)
        mine = sorted((r.position, r.cut, r.most_error) for r in cuts if r["window"] == name)
        assert [p for p, _, _ in mine] == list(range(21)) and [c for _, c, _ in mine] == sorted(c for _, c, _ in mine)
        for position, cut, most in mine:
            rank = max(1, -(-position * len(values) // 20))
            at_most, below = sum(v <= cut for v in values), sum(v < cut for v in values)
            assert at_most >= rank and below < rank + most and most <= error * len(values)


def test_no_rows_and_bad_errors(spark, tmp_path):
    none = _frame(spark, [])
    assert rank_state.summarise(none, "score", "day").collect() == []
    empty = rank_state.read_summaries(spark, str(tmp_path / "none"))
    assert rank_state.window_cuts(empty, WINDOWS).collect() == []
    with pytest.raises(ValueError):
        rank_state.summarise(none, "score", "day", 0)


@pytest.mark.parametrize("kind", ["continuous", "few", "one positive"])
def test_pruned_tuning_finds_the_same_point(spark, kind):
    rng = random.Random(4)

    def row():
        label = 0 if kind == "one positive" else int(rng.random() < 0.2)
        value = (lambda: rng.randrange(5) / 4) if kind == "few" else rng.random
        return (10 * (0.5 * value() + 0.5 * label * rng.random()), 0.7 * value() + 0.3 * label, value(), label)

    rows = [row() for _ in range(4000)] + [(None, 0.1, 0.2, 1), (1.0, 0.1, 0.2, None)]
    frame = spark.createDataFrame(rows, "cvss double, p1 double, p2 double, label int")
    want = ranking.best_weights(ranking.tune_weights(frame, "cvss", "p1", "p2", "label", step=0.1)).first()
    got = ranking.best_weights_pruned(frame, "cvss", "p1", "p2", "label", step=0.1).first()
    assert (got.w1, got.w2, got.w3) == (want.w1, want.w2, want.w3)
    assert got.pr_auc == pytest.approx(want.pr_auc, abs=1e-12)
    # ties and a single positive leave wide bounds; then more points are evaluated, never a worse one chosen
    assert got.exact_points <= (33 if kind == "continuous" else 66)


def test_bounds_hold_for_every_point(spark):
    rng = random.Random(5)
    rows = [(rng.random() * 10, rng.random(), rng.random(), int(rng.random() < 0.3)) for _ in range(2000)]
    inputs = spark.createDataFrame(rows, "_cvss double, _exploit double, _outcome double, pos int").withColumn("n", F.lit(1))
    points = ranking.weight_grid(0.25)
    blended = ranking._blended(inputs, points, list(range(len(points)))).groupBy("_point", "threshold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    exact = {r._point: r.a for r in ranking.running_totals(blended, ["_point"]).groupBy("_point").agg(ranking._pr_area().alias("a")).collect()}
    binned = blended.groupBy("_point", F.floor(F.col("threshold") * 3).cast("double").alias("threshold")).agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    bounds = ranking.running_totals(binned, ["_point"]).groupBy("_point").agg(*ranking._area_bounds()).collect()
    assert len(bounds) == len(points) and all(b.lower <= exact[b._point] + 1e-12 and exact[b._point] <= b.upper + 1e-12 for b in bounds)


@pytest.mark.parametrize("kind", ["continuous", "few", "rising", "wide"])
def test_bounds_of_cells_hold_for_every_point(spark, kind):
    rng = random.Random(6)

    def row():
        value = (lambda: rng.randrange(4) / 3) if kind == "few" else rng.random
        a, b, c = value(), value(), value()
        # `rising`: precision is greatest in the middle, so ties with later positives matter
        chance = {"few": c, "rising": 0.9 if 0.4 < c < 0.6 else 0.1}.get(kind, 0.3)
        return (10 * a if rng.random() > 0.1 else None, b * (1000 if kind == "wide" else 1), c, int(rng.random() < chance))

    rows = [row() for _ in range(2000)] + [(1.0, None, 0.5, 1), (1.0, 0.5, None, 0)]
    inputs = spark.createDataFrame(rows, "_cvss double, _exploit double, _outcome double, pos int").withColumn("n", F.lit(1))
    points = ranking.weight_grid(0.25)
    counts = ranking._blended(inputs, points, list(range(len(points)))).groupBy("_point", "threshold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    exact = {r._point: r.a for r in ranking.running_totals(counts, ["_point"]).groupBy("_point").agg(ranking._pr_area().alias("a")).collect()}
    for cells, bins in ((3, 16), (20, 2048)):
        bounds = {r._point: r.upper for r in ranking._cell_bounds(inputs, points, cells, bins).collect()}
        assert set(bounds) == set(exact) and all(exact[k] <= bounds[k] + 1e-12 for k in exact)


def test_rows_are_not_multiplied_by_points_that_cells_rule_out(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(10 * rng.random(), rng.random(), 0.6 * rng.random() + 0.4 * label, label) for label in (int(rng.random() < 0.3) for _ in range(20_000))]
    frame = spark.createDataFrame(rows, "cvss double, p1 double, p2 double, label int")
    asked, blended = [], ranking._blended
    monkeypatch.setattr(ranking, "_blended", lambda inputs, points, chosen: asked.append(len(chosen)) or blended(inputs, points, chosen))
    got = ranking.best_weights_pruned(frame, "cvss", "p1", "p2", "label", step=0.1).first()
    want = ranking.best_weights(ranking.tune_weights(frame, "cvss", "p1", "p2", "label", step=0.1)).first()
    assert (got.w1, got.w2, got.w3) == (want.w1, want.w2, want.w3) and max(asked) <= 22


def test_one_aggregate_gives_every_curve(spark):
    """Areas per date and pooled from the stored counts are those of the rows."""
    frame = _frame(spark, _rows(6, 800)).withColumn("other", F.col("score") * -1).withColumn("id", F.monotonically_increasing_id())
    counts = ranking.score_counts(frame, ["score", "other"], "label", "day")
    got = {(r.score_name, r.day): r.pr_auc for r in ranking.areas_by_date(counts, "day").collect()}
    for name in ("score", "other"):
        want = {(name, r.day): r.pr_auc for r in ranking.pr_auc(frame, name, "label", ["day"]).collect()}
        assert {k: v for k, v in got.items() if k[0] == name} == pytest.approx(want)
    whole = {r.score_name: r.pr_auc for r in ranking.compare_scores(frame, ["score", "other"], "label", 5, "id", "day", counts).collect()}
    assert whole == pytest.approx({n: ranking.pr_auc(frame, n, "label").first()[0] for n in ("score", "other")})
