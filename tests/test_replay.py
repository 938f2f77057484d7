"""Events that arrive again are found, however late."""

import random

from pyspark.sql import functions as F

from vulnlake.plans import ingest
from vulnlake.sources import bronze, tables
from vulnlake.streaming import silver
from vulnlake.streaming.replay import EventIndex


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "event_id string")


def _got(frame):
    return sorted(r[0] for r in frame.collect())


def test_index_equals_a_set(spark, tmp_path):
    """Batches of random ids, small and crowded filters: the same as a set of all ids so far."""
    for bits, hashes in ((64, 2), (1 << 16, 7)):
        rng, seen = random.Random(bits), set()
        index = EventIndex(spark, f"{tmp_path}/{bits}", "q", 4, bits, hashes)
        for batch in range(4):
            ids = [f"e{rng.randrange(400)}" for _ in range(150)]
            rows = _ids(spark, ids)
            assert _got(index.known(index.ids(rows), batch)) == sorted(set(ids) & seen)
            assert _got(index.first_arrivals(rows, batch)) == sorted(set(ids) - seen)
            # a repeated batch does not see itself
            assert _got(index.first_arrivals(rows, batch)) == sorted(set(ids) - seen)
            seen |= set(ids)


def test_most_new_ids_are_not_looked_up(spark, tmp_path):
    index = EventIndex(spark, str(tmp_path), "q", 4, 1 << 14, 7)
    index.add(index.ids(_ids(spark, [f"a{i}" for i in range(3000)])), 0)
    new = index.ids(_ids(spark, [f"b{i}" for i in range(3000)]))
    assert index.may_be_known(new, 1).count() < 150
    old = index.ids(_ids(spark, [f"a{i}" for i in range(500)]))
    assert index.may_be_known(old, 1).count() == 500


def test_rows_of_an_id_that_comes_once_are_not_shuffled(spark, tmp_path):
    """Whole rows are sorted by id only where the batch itself repeats ids; the filter has one word per id."""
    index = EventIndex(spark, str(tmp_path), "q", 4, 1 << 14, 7)
    rows = _ids(spark, [f"a{i}" for i in range(300)]).withColumn("payload", F.lit("x"))
    for batch in range(2):
        kept = index.first_arrivals(rows, batch)
        assert "Window" not in kept._jdf.queryExecution().executedPlan().toString() and kept.count() == (300 if batch == 0 else 0)
    ids = index.ids(rows)
    assert index._words(ids).count() == 300


def test_rows_without_an_id_stay_apart(spark, tmp_path):
    index = EventIndex(spark, str(tmp_path), "q")
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", 3)], "event_id string, v int")
    for batch in range(2):
        kept = sorted(r.v for r in index.first_arrivals(rows, batch).collect())
        assert kept == ([1, 2, 3] if batch == 0 else [1, 2])
    assert index.first_arrivals(rows.limit(0), 2).collect() == []


def test_other_loads_are_seen(spark, tmp_path):
    first, second = (EventIndex(spark, str(tmp_path), name) for name in ("q1", "q2"))
    first.first_arrivals(_ids(spark, ["a", "b"]), 0)
    assert _got(second.first_arrivals(_ids(spark, ["b", "c"]), 0)) == ["c"]


def test_silver_has_each_event_once(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(40).select(
        F.format_string("CVE-2024-%05d", "id").alias("cve"), F.lit(0.5).alias("epss_value"), F.lit(0.5).alias("percentile_value"),
        F.lit("2024-06-01").cast("date").alias("score_date"), F.lit("v").alias("model_version"), F.lit("published").alias("status"),
    )
    for run, part in enumerate((rows.where("cve < 'CVE-2024-00030'"), rows)):
        envelopes = ingest.score_envelopes(part, f"r{run}", F.lit("2024-06-02 01:02:03").cast("timestamp"))
        bronze.write_bronze(envelopes.unionByName(envelopes), f"{root}/bronze", "epss", "2024-06-01")
        done = silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints", sources=("epss",), replay_proof=True)
    kept = tables.read_silver(spark, f"{root}/silver", "epss")
    assert kept.count() == 40 == kept.select("event_id").distinct().count()
    assert sorted(r.accepted for r in done.collect()) == [10, 30]
    write = silver.batch_writer("epss", f"{root}/silver", f"{root}/checkpoints/epss_to_silver", True)
    write(bronze.read_bronze(spark, f"{root}/bronze", "epss").where("run_id = 'r1'"), 1)
    assert tables.read_silver(spark, f"{root}/silver", "epss").count() == 40
