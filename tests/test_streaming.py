import json

import pytest
from pyspark.sql import functions as F

from vulnlake.plans import ingest
from vulnlake.sources import bronze, tables
from vulnlake.streaming import silver, sink

AT = "2024-06-02 01:02:03"


def _envelopes(spark, ids, run="r1"):
    rows = spark.createDataFrame([(i,) for i in ids], "i int").select(
        F.when(F.col("i") % 10 == 9, F.lit("bad")).otherwise(F.format_string("CVE-2024-%05d", "i")).alias("cve"),
        F.lit(0.5).alias("epss_value"), F.lit(0.5).alias("percentile_value"),
        F.lit("2024-06-01").cast("date").alias("score_date"), F.lit("v").alias("model_version"),
        F.lit("published").alias("status"),
    )
    return ingest.score_envelopes(rows, run, F.lit(AT).cast("timestamp"))


def _silver(spark, root):
    return tables.read_silver(spark, f"{root}/silver", "epss")


def _run(spark, root, **options):
    silver.run_silver(
        spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints", sources=("epss",), **options
    )


def test_new_files_are_processed_once(spark, tmp_path):
    root = str(tmp_path)
    bronze.write_bronze(_envelopes(spark, range(20)), f"{root}/bronze", "epss", "2024-06-01")
    _run(spark, root)
    assert _silver(spark, root).count() == 18
    _run(spark, root)
    assert _silver(spark, root).count() == 18
    bronze.write_bronze(_envelopes(spark, range(20, 30)), f"{root}/bronze", "epss", "2024-06-02")
    _run(spark, root)
    assert _silver(spark, root).count() == 27
    rejects = spark.read.parquet(silver.rejected_path(f"{root}/silver", "epss"))
    assert {(r["reason"], r["count"]) for r in rejects.groupBy("reason").count().collect()} == {("invalid_cve_id", 3)}


def test_a_repeated_batch_leaves_no_duplicates(spark, tmp_path):
    root = str(tmp_path)
    bronze.write_bronze(_envelopes(spark, range(20)), f"{root}/bronze", "epss", "2024-06-01")
    _run(spark, root)
    write = silver.batch_writer("epss", f"{root}/silver", f"{root}/checkpoints/epss_to_silver")
    write(bronze.read_bronze(spark, f"{root}/bronze", "epss"), 0)
    assert _silver(spark, root).count() == 18
    rejects = spark.read.parquet(silver.rejected_path(f"{root}/silver", "epss"))
    assert rejects.count() == 2


def test_a_new_checkpoint_keeps_older_loads(spark, tmp_path):
    root = str(tmp_path)
    bronze.write_bronze(_envelopes(spark, range(5)), f"{root}/bronze", "epss", "2024-06-01")
    _run(spark, root)
    silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/other", sources=("epss",))
    both = _silver(spark, root)
    assert both.count() == 10 and both.select("event_id").distinct().count() == 5


def test_replays_add_no_new_ids(spark, tmp_path):
    root = str(tmp_path)
    for run in ("r1", "r2"):
        bronze.write_bronze(_envelopes(spark, range(8), run), f"{root}/bronze", "epss", "2024-06-01")
    _run(spark, root)
    rows = _silver(spark, root)
    assert rows.count() == 16 and rows.select("event_id").distinct().count() == 8


def test_dedup_drops_replays_within_and_across_batches(spark, tmp_path):
    root = str(tmp_path)
    for run in ("r1", "r2"):
        bronze.write_bronze(_envelopes(spark, range(8), run), f"{root}/bronze", "epss", "2024-06-01")
    _run(spark, root, dedup_delay="1 hour")
    assert _silver(spark, root).count() == 8
    bronze.write_bronze(_envelopes(spark, range(4, 12), "r3"), f"{root}/bronze", "epss", "2024-06-01")
    _run(spark, root, dedup_delay="1 hour")
    rows = _silver(spark, root)
    assert rows.count() == 11 and rows.select("event_id").distinct().count() == 11


def test_dedup_keeps_records_without_id_apart(spark, tmp_path):
    folder = tmp_path / "bronze" / "source=epss"
    folder.mkdir(parents=True)
    import gzip

    with gzip.open(folder / "a.jsonl.gz", "wt") as f:
        f.writelines(json.dumps({"payload": {"cve": f"c{i}"}}) + "\n" for i in range(5))
    _run(spark, str(tmp_path), dedup_delay="1 hour")
    rejects = spark.read.parquet(silver.rejected_path(f"{tmp_path}/silver", "epss"))
    assert rejects.count() == 5 and rejects.select("cve_id").distinct().count() == 5


def test_several_batches(spark, tmp_path):
    root = str(tmp_path)
    for day in range(1, 4):
        bronze.write_bronze(
            _envelopes(spark, range(day * 10, day * 10 + 5)).coalesce(1), f"{root}/bronze", "epss", f"2024-06-0{day}"
        )
    _run(spark, root, max_files_per_trigger=1)
    assert _silver(spark, root).count() == 15
    batches = {p.name for p in (tmp_path / "silver" / "epss_daily").glob("load=*/batch=*")}
    assert batches == {"batch=0", "batch=1", "batch=2"}


def test_triggers(spark, tmp_path):
    root = str(tmp_path)
    bronze.write_bronze(_envelopes(spark, range(5)), f"{root}/bronze", "epss", "2024-06-01")
    args = (spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints")
    with pytest.raises(ValueError):
        silver.start_silver_streams(*args, trigger="sometimes")
    (query,) = silver.start_silver_streams(
        *args, trigger="processingTime", processing_time="1 second", sources=("epss",)
    )
    try:
        assert query.name == "epss_to_silver"
        query.processAllAvailable()
    finally:
        query.stop()
    assert _silver(spark, root).count() == 5


def test_all_sources_run_side_by_side(spark, tmp_path):
    root = str(tmp_path)
    bronze.write_bronze(_envelopes(spark, range(5)), f"{root}/bronze", "epss", "2024-06-01")
    for source in ("nvd", "kev"):
        (tmp_path / "bronze" / f"source={source}").mkdir(parents=True)
    silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints")
    assert _silver(spark, root).count() == 5
    assert tables.read_silver(spark, f"{root}/silver", "kev").count() == 0


TOPICS = {"nvd": "raw.nvd", "epss": "raw.epss", "kev": "raw.kev"}
LOG = "topic string, partition int, offset bigint, value string"


def _log(spark, path, rows):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)


def _message(i, source="epss", **changes):
    record = {
        "event_id": f"e{i}", "event_schema_version": "1.0.0", "source": source, "source_record_id": f"r{i}",
        "event_type": "source.raw_record", "effective_date": "2024-06-01", "source_modified_at": None,
        "fetched_at": "2024-06-01T00:00:00Z", "ingestion_run_id": "r1", "payload_sha256": "s",
        "payload": {"cve": f"CVE-2024-{i:05d}", "epss": 0.5, "score_date": "2024-06-01", "extra": [1, {"a": 2}]},
    }
    return json.dumps({**record, **changes})


def test_message_log_to_bronze_and_dead_letters(spark, tmp_path):
    log, root = str(tmp_path / "log"), str(tmp_path / "bronze")
    good = [("raw.epss", 0, i, _message(i)) for i in range(5)] + [("raw.kev", 0, 5, _message(5, "kev"))]
    bad = [
        ("raw.epss", 0, 10, "junk"), ("raw.epss", 0, 11, _message(11, event_id=None)), ("raw.epss", 0, 12, None),
        ("raw.epss", 0, 13, _message(13, effective_date="2024-13-40")), ("raw.epss", 0, 14, _message(14, source="other")),
        ("raw.epss", 0, 15, _message(15, payload=[1])),
    ]
    _log(spark, log, good + bad + [("unrelated", 0, 20, _message(20))])

    def run():
        stream = spark.readStream.schema(LOG).parquet(log)
        sink.start_bronze_sink(stream, TOPICS, root, f"{tmp_path}/checkpoint", "2024-06-01").awaitTermination()

    run()
    epss = bronze.read_bronze(spark, root, "epss")
    assert {r["event_id"] for r in epss.collect()} == {f"e{i}" for i in range(5)}
    assert bronze.read_bronze(spark, root, "kev").count() == 1 and bronze.read_bronze(spark, root, "nvd").count() == 0
    raw = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt.gz").text(f"{root}/source=epss")
    assert {r[0] for r in raw.collect()} == {_message(i) for i in range(5)}
    letters = {r["original_offset"]: r for r in spark.read.json(sink.dead_letter_path(root)).collect()}
    assert {k: v["error_type"] for k, v in letters.items()} == {
        10: "MalformedRecord", 11: "MissingField", 12: "MalformedRecord", 13: "InvalidField", 14: "InvalidField", 15: "InvalidField",
    }
    _log(spark, log, [("raw.epss", 0, 30, _message(30))])
    run()
    assert bronze.read_bronze(spark, root, "epss").count() == 6
    write = sink.batch_sink(TOPICS, root, f"{tmp_path}/checkpoint", "2024-06-01", "all", 10_000)
    write(spark.createDataFrame([("raw.epss", 0, 30, _message(30))], LOG), 1)
    assert bronze.read_bronze(spark, root, "epss").count() == 6
    silver.run_silver(spark, root, f"{tmp_path}/silver", f"{tmp_path}/silver-checkpoints", sources=("epss",))
    assert _silver(spark, str(tmp_path)).count() == 6
