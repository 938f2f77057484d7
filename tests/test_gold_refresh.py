"""The bucketed series and Gold that is refreshed month by month, against full rebuilds."""

import random
import re
import uuid
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.operators import latest
from vulnlake.plans import gold, gold_refresh
from vulnlake.sources import series_store
from vulnlake.sources.series_store import MONTH, SeriesStore

D0 = date(2024, 1, 10)
ROWS = "id string, day date, score double, fetched int, ev string"
OPTIONS = {"score": "score", "published": "published", "added": "added", "horizons": (5, 20)}


def _store(spark, path):
    return SeriesStore(
        spark, f"s_{uuid.uuid4().hex}", str(path), schemas.struct(ROWS), "id", "day", "fetched", ("ev",), 2
    ).open()


def _rows(spark, rows):
    return spark.createDataFrame([(k, D0 + timedelta(days=d), s, f, f"{k}{d}{f}") for k, d, s, f in rows], ROWS)


def _dimension(spark, published):
    return spark.createDataFrame([(k, D0 + timedelta(days=d), w) for k, (d, w) in published.items()], "id string, published date, word string")


def _outcomes(spark, added):
    return spark.createDataFrame([(k, D0 + timedelta(days=d)) for k, d in added.items()], "id string, added date")


def _full(spark, rows, dimension, outcomes, as_of):
    daily = latest.latest(_rows(spark, rows), ["id", "day"], "fetched", ["ev"])
    return gold.observations(daily, dimension, outcomes, key="id", day="day", as_of=as_of, **OPTIONS)


def _values(frame, columns):
    rows = frame.select(*columns).collect()
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows) if rows else []


def _check(spark, root, rows, dimension, outcomes, as_of):
    want = _full(spark, rows, dimension, outcomes, as_of)
    key = lambda t: tuple(str(v) for v in t)
    got = gold_refresh.read_gold(spark, root)
    a = sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in got.select(*want.columns).collect()), key=key)
    b = sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in want.collect()), key=key)
    assert a == b and a


def test_a_fetch_that_is_not_newer_changes_nothing(spark, tmp_path):
    store = _store(spark, tmp_path / "s")
    assert store.merge(_rows(spark, [("a", 0, 0.1, 2), ("a", 0, 0.2, 3), ("a", 40, 0.3, 1), ("b", 0, None, 1)])) == [D0, D0 + timedelta(days=40)]
    assert store.merge(_rows(spark, [("a", 0, 0.9, 2), ("a", 0, 0.2, 3), ("a", 40, 0.3, 1)])) == []
    assert store.merge(_rows(spark, [("a", 40, 0.5, 2), ("c", 41, 0.5, 2)])) == [D0 + timedelta(days=40), D0 + timedelta(days=41)]
    nulls = spark.createDataFrame([(None, D0, 0.1, 1, "x"), ("a", None, 0.1, 1, "x")], ROWS)
    assert store.merge(nulls) == [] and store.merge(nulls.limit(0)) == []
    assert {(r.id, r.day, r.score) for r in store.read().collect()} == {
        ("a", D0, 0.2), ("a", D0 + timedelta(days=40), 0.5), ("b", D0, None), ("c", D0 + timedelta(days=41), 0.5)}
    assert store.months() == [202401, 202402]
    again = SeriesStore(spark, f"t_{uuid.uuid4().hex}", store.path, store.schema, "id", "day", "fetched", ("ev",), 2).open()
    assert again.read([202402]).count() == 2


def test_series_is_not_shuffled_and_months_are_pruned(spark, tmp_path):
    store = _store(spark, tmp_path / "s")
    store.merge(_rows(spark, [(k, d, 0.1, 1) for k in "abcd" for d in range(0, 200, 3)]))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dimension, outcomes = _dimension(spark, {"a": (0, "x")}), _outcomes(spark, {"b": 3})
        built = gold_refresh.touched_rows(store, {202403}, dimension, outcomes, as_of=D0 + timedelta(days=190), **OPTIONS)
        plan = built._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # one shuffle each for the dimension and the outcomes, none between the scan of the series and its window
    assert plan.count("Exchange hashpartitioning") == 2 and "Bucketed: true" in plan
    series = plan[plan.index("Window"):]
    assert "Exchange" not in series[: series.index("FileScan")]
    assert set(re.findall(r"series_month=(\d+)", " ".join(built.inputFiles()))) == {"202401", "202402", "202403"}


def test_outcomes_with_a_shuffle_of_their_own_leave_the_series_in_its_buckets(spark, tmp_path):
    """More shuffle partitions than buckets do not pull the series out of its buckets."""
    store = _store(spark, tmp_path / "s")
    store.merge(_rows(spark, [(k, d, 0.1, 1) for k in "abcd" for d in range(0, 200, 3)]))
    found = latest.earliest_date(_outcomes(spark, {"b": 3}).repartition(3), "id", "added")
    facts = gold_refresh.stored_facts(_dimension(spark, {"a": (0, "x")}), found)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = gold_refresh.touched_rows(store, {202403}, *facts, as_of=D0 + timedelta(days=190), **OPTIONS)
        plan = built._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert set(re.findall(r"Exchange hashpartitioning\(\S+, (\d+)\)", plan)) == {"2"}


def test_only_months_on_disk_are_put_in_order_again(spark, tmp_path, monkeypatch):
    wrote, cut = [], series_store.cut_lineage
    monkeypatch.setattr(series_store, "cut_lineage", lambda df, name: wrote.append(name) or cut(df, name))
    store = _store(spark, tmp_path / "s")
    assert len(store.merge(_rows(spark, [("a", 0, 0.1, 1), ("a", 40, 0.2, 1)]))) == 2 and wrote == ["series-new"]
    # one month is there, the other is not
    assert store.merge(_rows(spark, [("a", 0, 0.5, 2), ("b", 0, 0.6, 1), ("a", 80, 0.3, 1)])) == [D0, D0 + timedelta(days=80)]
    assert wrote == ["series-new", "series-new", "series-merged"]
    assert sorted((r.id, (r.day - D0).days, r.score) for r in store.read().collect()) == [("a", 0, 0.5), ("a", 40, 0.2), ("a", 80, 0.3), ("b", 0, 0.6)]


def test_months():
    assert gold_refresh.months_needed({202403}, 30) == {202401, 202402, 202403}
    assert gold_refresh.months_needed({202401}, 30) == {202312, 202401}
    assert gold_refresh.months_after([date(2023, 12, 5)], 30) == {202312, 202401}
    assert gold_refresh.months_after([], 30) == set() == gold_refresh.months_needed(set(), 30)


def test_loads_equal_a_full_rebuild(spark, tmp_path):
    """New days, late fetches, corrected fetches, new keys, other records and outcomes, a later and an earlier as-of date."""
    rng = random.Random(5)
    store, root = _store(spark, tmp_path / "s"), str(tmp_path / "gold")
    published, added, rows = {"a": (0, "x"), "b": (5, "y")}, {"b": 100}, []

    def load(new, day):
        rows.extend(new)
        as_of = D0 + timedelta(days=day)
        dimension, outcomes = _dimension(spark, published), _outcomes(spark, added)
        done = gold_refresh.refresh(store, root, _rows(spark, new), dimension, outcomes, as_of, **OPTIONS)
        _check(spark, root, rows, dimension, outcomes, as_of)
        return done

    load([(k, d, rng.random(), 1) for k in "abc" for d in range(0, 70) if rng.random() < 0.6], 80)
    done = load([(k, d, rng.random(), 1) for k in "abc" for d in range(70, 100)], 105)
    assert set(done) == {202403, 202404} or 202401 not in done
    published["c"] = (20, "z")
    load([("a", 3, 0.77, 2), ("c", 31, 0.5, 1), ("c", 31, 0.6, 0)], 105)
    added["a"] = 40
    load([("a", 99, 0.1, 0)], 105)
    published["b"], added["c"] = (6, "w"), 15
    load([("d", 50, 0.5, 1)], 90)
    assert gold_refresh.refresh(
        store, root, _rows(spark, [("a", 3, 0.77, 2)]), _dimension(spark, published), _outcomes(spark, added), D0 + timedelta(days=90), **OPTIONS
    ) == {}


def test_a_failed_refresh_is_made_up_for(spark, tmp_path, monkeypatch):
    store, root = _store(spark, tmp_path / "s"), str(tmp_path / "gold")
    dimension, outcomes = _dimension(spark, {"a": (0, "x")}), _outcomes(spark, {})
    first, late = [("a", d, d / 100, 1) for d in range(60)], [("a", 2, 0.9, 2)]
    as_of = D0 + timedelta(days=100)
    gold_refresh.refresh(store, root, _rows(spark, first), dimension, outcomes, as_of, **OPTIONS)
    with monkeypatch.context() as broken:
        broken.setattr(gold_refresh, "touched_rows", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            gold_refresh.refresh(store, root, _rows(spark, late), dimension, outcomes, as_of, **OPTIONS)
    done = gold_refresh.refresh(store, root, _rows(spark, late).limit(0), dimension, outcomes, as_of, **OPTIONS)
    assert set(done) == {202401, 202402}
    _check(spark, root, first + late, dimension, outcomes, as_of)


def test_months_without_rows_go(spark, tmp_path):
    store, root = _store(spark, tmp_path / "s"), str(tmp_path / "gold")
    dimension, as_of = _dimension(spark, {"a": (0, "x"), "b": (0, "x")}), D0 + timedelta(days=120)
    rows = [("a", 0, 0.1, 1), ("b", 40, 0.1, 1)]
    gold_refresh.refresh(store, root, _rows(spark, rows), dimension, _outcomes(spark, {}), as_of, **OPTIONS)
    gold_refresh.refresh(store, root, _rows(spark, []), dimension, _outcomes(spark, {"b": 20}), as_of, **OPTIONS)
    assert [r.id for r in gold_refresh.read_gold(spark, root).collect()] == ["a"]
