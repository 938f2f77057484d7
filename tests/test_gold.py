import random
from datetime import date, datetime, timedelta
from statistics import fmean, stdev

import pytest
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.operators import cohort, labels, latest, series
from vulnlake.plans import gold
from vulnlake.sources import tables

D0 = date(2024, 1, 1)


def _day(n):
    return D0 + timedelta(days=n)


def _series(spark, rows):
    return spark.createDataFrame([(k, _day(d), s) for k, d, s in rows], "id string, day date, score double")


def _brute(points, day, lags, windows, thresholds):
    """Features of one key on one day from a list of (day, score)."""
    at = dict(points)
    out = {"s_current": at.get(day)}
    for lag in lags:
        out[f"s_lag_{lag}d"] = at.get(day - lag)
        out[f"s_delta_{lag}d"] = (
            None if at.get(day) is None or at.get(day - lag) is None else at[day] - at[day - lag]
        )
    for w in windows:
        inside = [(d, s) for d, s in points if day - w < d <= day]
        ys = [s for _, s in inside if s is not None]
        out[f"s_mean_{w}d"] = fmean(ys) if ys else None
        out[f"s_max_{w}d"], out[f"s_min_{w}d"] = max(ys, default=None), min(ys, default=None)
        out[f"s_stddev_{w}d"] = stdev(ys) if len(ys) > 1 else None
        n = len(inside)
        sx, sxx = sum(d - day for d, _ in inside), sum((d - day) ** 2 for d, _ in inside)
        sy, sxy = sum(ys), sum((d - day) * s for d, s in inside if s is not None)
        den = n * sxx - sx * sx
        slope = 0.0 if den == 0 else (n * sxy - sx * sy) / den if ys else None
        out[f"s_slope_{w}d"] = slope if n else None
    longest = max(windows)
    inside = [(d, s) for d, s in points if day - longest < d <= day]
    out[f"s_days_observed_{longest}d"] = len(inside)
    for t in thresholds:
        name = f"s_days_above_{str(t).replace('.', '_')}_{longest}d"
        out[name] = sum(1 for _, s in inside if s is not None and s > t)
    return out


LAGS, WINDOWS, LIMITS = (1, 7, 30), (7, 30), (0.1, 0.5)


def _random_points(seed):
    random.seed(seed)
    data = {}
    for key in "abcd":
        days = sorted(random.sample(range(100), 50))
        data[key] = [(d, None if random.random() < 0.1 else random.random()) for d in days]
    data["single"] = [(5, 0.5)]
    data["gap"] = [(0, 0.2), (31, 0.4), (61, 0.6)]
    return data


def _check(got, data, spine):
    rows = {(r["id"], r["day"]): r for r in got.collect()}
    assert set(rows) == {(k, _day(d)) for k, d in spine}
    for key, day in spine:
        want = _brute(data[key], day, LAGS, WINDOWS, LIMITS)
        row = rows[(key, _day(day))]
        for name, value in want.items():
            if value is None:
                assert row[name] is None, (key, day, name)
            else:
                assert row[name] == pytest.approx(value, abs=1e-9), (key, day, name)


def test_trailing_features_against_brute_force(spark):
    data = _random_points(1)
    rows = [(k, d, s) for k, points in data.items() for d, s in points]
    got = series.trailing_features(_series(spark, rows), "id", "day", "score", prefix="s")
    _check(got, data, [(k, d) for k, d, _ in rows])


def test_trailing_features_for_days_outside_the_series(spark):
    data = _random_points(2)
    rows = [(k, d, s) for k, points in data.items() for d, s in points]
    spine = [(k, d) for k in data for d in range(0, 140, 7)]
    marks = spark.createDataFrame([(k, _day(d)) for k, d in spine], "id string, day date")
    got = series.trailing_features(_series(spark, rows), "id", "day", "score", prefix="s", spine=marks)
    rows_ = {(r["id"], r["day"]): r for r in got.collect()}
    assert set(rows_) == {(k, _day(d)) for k, d in spine}
    _check(got, data, spine)


def test_join_form_equals_window_form(spark):
    data = _random_points(3)
    rows = [(k, d, s) for k, points in data.items() for d, s in points]
    daily = _series(spark, rows)
    joined = series.range_join(daily.select("id", "day"), daily, "id", "day", 30, ["score"])
    week = F.col("days_back") <= 6
    by_join = joined.groupBy("id", "day").agg(
        F.avg(F.when(week, F.col("score"))).alias("mean"), F.count("days_back").alias("n"),
        F.max(F.when(F.col("days_back") == 30, F.col("score"))).alias("lag"),
    )
    by_window = series.trailing_features(daily, "id", "day", "score", prefix="s")
    both = by_join.join(by_window, ["id", "day"])
    assert both.count() == len(rows)
    wrong = both.filter(
        ~F.col("lag").eqNullSafe(F.col("s_lag_30d"))
        | ~F.round("mean", 9).eqNullSafe(F.round("s_mean_7d", 9))
    )
    assert wrong.count() == 0


def test_later_rows_never_change_a_feature(spark):
    data = _random_points(4)
    rows = [(k, d, s) for k, points in data.items() for d, s in points]
    cut = 60
    whole = series.trailing_features(_series(spark, rows), "id", "day", "score").filter(F.col("day") <= _day(cut))
    past = series.trailing_features(_series(spark, [r for r in rows if r[1] <= cut]), "id", "day", "score")
    assert whole.exceptAll(past).count() == 0 and past.exceptAll(whole).count() == 0


# ---- the dataset from Silver ------------------------------------------------------------------------


def _ts(n):
    return datetime(2024, 1, 1) + timedelta(days=n)


def _nvd(spark, rows):
    base = {f.name: None for f in schemas.silver("nvd").fields}
    full = [
        {**base, "event_id": f"n{i}", "cwe_ids": ["CWE-1", "CWE-2"], "reference_count": 3, "cpe_match_count": 1, **r}
        for i, r in enumerate(rows)
    ]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.silver("nvd").fields) for r in full], schemas.silver("nvd"))


def _epss(spark, rows):
    out = [
        (f"e{i}", cve, _day(d), score, 0.5, "v1", fetched, "run", "sha") for i, (cve, d, score, fetched) in enumerate(rows)
    ]
    return spark.createDataFrame(out, schemas.silver("epss"))


def _kev(spark, rows):
    names = [f.name for f in schemas.silver("kev").fields]
    base = dict.fromkeys(names)
    out = [
        tuple({**base, "event_id": f"k{i}", "cve_id": c, "date_added": _day(d), "fetched_at": _ts(f)}[n] for n in names)
        for i, (c, d, f) in enumerate(rows)
    ]
    return spark.createDataFrame(out, schemas.silver("kev"))


def _inputs(spark):
    days = [0, 10, 20, 30, 110, 111]
    cves = ["same", "plus1", "plus7", "plus8", "plus30", "plus90", "plus91", "never", "unknown", "late"]
    epss = [(c, d, 0.1 + d / 1000, _ts(d)) for c in cves for d in days] + [("never", 10, 0.9, _ts(50))]
    nvd = [
        {"cve_id": c, "published_at": _ts(15 if c == "late" else -5), "fetched_at": _ts(1), "cvss_base_score": 5.0}
        for c in cves if c != "unknown"
    ]
    nvd.append({"cve_id": "never", "published_at": _ts(-5), "fetched_at": _ts(2), "cvss_base_score": None})
    kev = [(f"plus{n}", 20 + n, 200) for n in (1, 7, 8, 30, 90, 91)] + [("same", 20, 200), ("plus7", 60, 150)]
    return _nvd(spark, nvd), _epss(spark, epss), _kev(spark, kev)


def test_gold_cohort_and_labels(spark):
    got = gold.build_observations(*_inputs(spark))
    rows = {(r["cve_id"], r["observation_date"]): r for r in got.collect()}
    assert "unknown" not in {c for c, _ in rows}
    assert ("late", _day(10)) not in rows and ("late", _day(20)) in rows
    # as of day 200, the label window of day 111 is incomplete and that of day 110 is complete
    assert ("never", _day(110)) in rows and ("never", _day(111)) not in rows
    assert ("same", _day(10)) in rows and ("same", _day(20)) not in rows
    expected = {"plus1": (1, 1, 1), "plus7": (1, 1, 1), "plus8": (0, 1, 1), "plus30": (0, 1, 1),
                "plus90": (0, 0, 1), "plus91": (0, 0, 0), "never": (0, 0, 0)}
    for cve, want in expected.items():
        r = rows[(cve, _day(20))]
        assert tuple(r[f"kev_within_{h}_days"] for h in (7, 30, 90)) == want
        assert r["label_as_of_date"] == _day(200) and r["vulnerability_age_days"] == 25
    assert rows[("plus7", _day(20))]["days_until_kev"] == 7 and rows[("never", _day(20))]["days_until_kev"] is None
    # the latest fetch wins, in the series and in the dimension
    assert rows[("never", _day(10))]["epss_current"] == 0.9
    assert rows[("never", _day(10))]["has_cvss"] == 0 and rows[("plus1", _day(10))]["has_cvss"] == 1
    assert rows[("never", _day(30))]["epss_lag_30d"] == pytest.approx(0.1)
    assert rows[("never", _day(30))]["epss_days_above_0_5_30d"] == 1
    assert rows[("never", _day(20))]["cwe_count"] == 2


def test_gold_given_date_and_horizons(spark):
    got = gold.build_observations(*_inputs(spark), label_as_of_date=_day(40), horizons=(5, 10))
    assert got.agg(F.max("observation_date")).first()[0] == _day(30)
    assert {"kev_within_5_days", "kev_within_10_days"} <= set(got.columns)


def test_gold_of_empty_tables_keeps_its_columns(spark):
    nvd, epss, kev = _inputs(spark)
    whole = gold.build_observations(nvd, epss, kev)
    no_kev = gold.build_observations(nvd, epss, kev.filter("false"))
    assert no_kev.columns == whole.columns
    assert {r["kev_within_90_days"] for r in no_kev.collect()} == {0}
    # without outcomes the last score fetch is the as-of date
    assert no_kev.first()["label_as_of_date"] == _day(111)
    empty = gold.build_observations(nvd.filter("false"), epss.filter("false"), kev.filter("false"))
    assert empty.columns == whole.columns and empty.count() == 0


def test_gold_round_trip_and_partitions(spark, tmp_path):
    nvd, epss, kev = _inputs(spark)
    for source, df in (("nvd", nvd), ("epss", epss)):
        df.write.parquet(f"{tmp_path}/silver/{schemas.SILVER[source][0]}")
    got = gold.run_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", label_as_of_date=_day(200))
    want = gold.build_observations(nvd, epss, kev.filter("false"), label_as_of_date=_day(200))
    assert sorted(got.columns) == sorted(want.columns) and got.count() == want.count()
    assert (tmp_path / "gold" / "observations" / "observation_year=2024" / "observation_month=1").is_dir()
    again = gold.run_gold(spark, f"{tmp_path}/silver", f"{tmp_path}/gold", label_as_of_date=_day(200))
    assert again.count() == want.count()


def test_read_or_empty(spark, tmp_path):
    empty = tables.read_silver(spark, f"{tmp_path}/none", "kev")
    assert empty.count() == 0 and empty.columns == schemas.silver("kev").fieldNames()


def test_ties_resolve_the_same_way_every_time(spark):
    rows = [("a", i, "t") for i in range(50)]
    df = spark.createDataFrame(rows, "k string, id int, at string").repartition(8)
    assert latest.latest(df, ["k"], "at", ["id"]).first()["id"] == 49
    assert latest.earliest(df, ["k"], "at", ["id"]).first()["id"] == 0


def test_a_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select("id", (F.col("id") % 2).alias("k"))
    plan = latest.latest(df, ["k"], "id", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan[plan.index("Exchange"):]


def test_censoring_and_days(spark):
    days = spark.createDataFrame([(_day(i),) for i in range(60)], "day date")
    kept = cohort.right_censor(days, "day", _day(50), 10)
    assert kept.agg(F.max("day")).first()[0] == _day(40)
    picked = cohort.sampled_days(days, "day", start=_day(0), end=_day(58), days_of_month=[1, 15, 31])
    assert [r[0].day for r in picked.orderBy("day").collect()] == [1, 15, 31, 1, 15]
    assert cohort.parse_days_of_month("15, 1,1") == [1, 15] and cohort.parse_days_of_month("") is None
    for bad in ("0", "32"):
        with pytest.raises(ValueError):
            cohort.parse_days_of_month(bad)
    with pytest.raises(ValueError):
        cohort.sampled_days(days, "day", start=_day(2), end=_day(1))
    assert cohort.resolve_range(None, None, 10, today=_day(20)) == (_day(10), _day(20))
    assert cohort.resolve_range(_day(1), None, today=_day(20)) == (_day(1), _day(20))
    with pytest.raises(ValueError):
        cohort.resolve_range(_day(2), _day(1))
    assert cohort.calendar(spark, "2024-02-01", "2024-03-31", [30, 31]).count() == 2


def test_anti_join_equals_filtered_left_join(spark):
    spine = spark.createDataFrame([("a", _day(i)) for i in range(10)] + [("b", _day(1))], "id string, day date")
    added = spark.createDataFrame([("a", _day(5))], "id string, added date")
    kept = cohort.not_known_yet(spine, added, "id", "day", "added")
    assert sorted((r["id"], r["day"]) for r in kept.collect()) == sorted([("a", _day(i)) for i in range(5)] + [("b", _day(1))])
    labelled = labels.add_labels(spine, added, "id", "day", "added", F.lit(_day(99)), (7,))
    assert cohort.exclude_known(labelled).count() == 6
