"""Files by rows and bytes, stretches of offsets, observed counts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vulnlake import session
from vulnlake.operators import counts, rolling
from vulnlake.plans import ingest
from vulnlake.sources import bronze
from vulnlake.streaming import silver, sink

LOG = "topic string, partition int, offset bigint, value string"
TOPICS = {"epss": "raw.epss", "kev": "raw.kev"}


@pytest.fixture(autouse=True)
def several_ranges(spark):
    """Small tables, too, are split into ranges."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def _files(sizes, max_records, max_bytes):
    """A file ends where the total of rows or of bytes crosses a multiple of its limit."""
    out, before, total = [], None, 0
    for i, size in enumerate(sizes):
        tile = (total // max_bytes, i // max_records)
        if tile != before:
            out.append([])
        out[-1].append(i)
        before, total = tile, total + size
    return out


@pytest.mark.parametrize(("max_records", "max_bytes"), [(7, 10_000), (1000, 300), (7, 300), (1, 10**9), (10**9, 10**12), (10**9, 1)])
def test_files_end_at_rows_or_bytes(spark, max_records, max_bytes):
    rng = random.Random(max_bytes)
    rows = [(g, i, rng.choice([0, 1, 40, 400])) for g, n in (("a", 500), ("b", 3), (None, 60)) for i in range(n)]
    frame = spark.createDataFrame(rows, "g string, i int, size int").repartition(5)
    placed = rolling.in_order(frame, ["g", "i"], "test")
    got = rolling.cut_files(placed, ["g"], F.col("size"), max_records, max_bytes).collect()
    assert len(got) == len(rows)
    for g in ("a", "b", None):
        want = _files([s for h, _, s in rows if h == g], max_records, max_bytes)
        mine = {}
        for r in got:
            if r.g == g:
                mine.setdefault(r.file_number, []).append(r.i)
        assert [sorted(mine[k]) for k in range(len(mine))] == want
        sizes = [sum(s for h, i, s in rows if h == g and i in own) for own in map(set, want)]
        assert all(len(f) <= max_records for f in want) and all(s < max_bytes + 400 for s in sizes)


def _anew(sizes, max_records, max_bytes):
    """Rows in the files of a writer that counts rows and bytes anew for every file."""
    out, rows, total = [[]], 0, 0
    for i, size in enumerate(sizes):
        if rows >= max_records or total >= max_bytes:
            out.append([])
            rows = total = 0
        out[-1].append(i)
        rows, total = rows + 1, total + size
    return out


@pytest.mark.parametrize(("max_records", "max_bytes", "same"), [(7, 2801, True), (7, 10_000, True), (1, 1000, True), (7, 900, False), (10**9, 300, False)])
def test_bytes_end_files_only_where_rows_do_not_suffice(spark, max_records, max_bytes, same):
    rng = random.Random(max_bytes)
    rows = [(g, i, rng.choice([0, 1, 40, 400])) for g, n in (("a", 500), ("b", 3), (None, 60)) for i in range(n)]
    placed = rolling.in_order(spark.createDataFrame(rows, "g string, i int, size int").repartition(5), ["g", "i"], "test")
    got = rolling.cut_files(placed, ["g"], F.col("size"), max_records, max_bytes, bytes_if_needed=True).collect()
    assert len(got) == len(rows)
    for g in ("a", "b", None):
        sizes = [s for h, _, s in rows if h == g]
        mine = {}
        for r in got:
            if r.g == g:
                mine.setdefault(r.file_number, []).append(r.i)
        files = [sorted(mine[k]) for k in range(len(mine))]
        whole = [list(range(k, min(k + max_records, len(sizes)))) for k in range(0, len(sizes), max_records)]
        cuts = {f[0] for f in _files(sizes, max_records, max_bytes)}
        want = []
        for part in whole:
            for i in part:
                if i == part[0] or (sum(sizes[j] for j in part[:-1]) >= max_bytes and i in cuts):
                    want.append([])
                want[-1].append(i)
        assert files == want
        assert all(len(f) <= max_records and sum(sizes[i] for i in f) < max_bytes + 400 for f in files)
        if same:
            assert files == _anew(sizes, max_records, max_bytes)


def test_a_row_looks_among_the_files_of_its_block(spark):
    """A range of many small files has no list of all of them."""
    rows = spark.range(0, 10_000, 1, 1).selectExpr("if(id < 9000, 'a', null) as g", "id as i", "1 as size")
    placed = rolling.in_order(rows, ["g", "i"], "test").cache()
    files = rolling.file_bounds(placed, ["g"], F.col("size"), 2, 10**9)
    lists = rolling.block_lists(placed, files, ["g"])
    most = (1 << rolling.BLOCK_BITS) // 2 + 1
    assert lists.agg(F.max(F.size("_files"))).first()[0] <= most < files.where("g = 'a'").count() // 4
    # no block that has no rows
    blocks = placed.groupBy("g", F.shiftright(rolling.AT, rolling.BLOCK_BITS)).agg(F.count("*")).count()
    assert lists.count() == blocks
    got = rolling.cut_files(placed, ["g"], F.col("size"), 2, 10**9)
    wrong = got.where("file_number <> if(g is null, i - 9000, i) div 2").count()
    assert (got.count(), wrong) == (10_000, 0)


def test_positions_count_rows_of_a_group_over_ranges(spark):
    rows = spark.createDataFrame([(g, p, i) for g, n in (("a", 400), ("b", 1), (None, 90)) for p in (0, None) for i in range(n)], "g string, p int, i int")
    placed = rolling.in_order(rows.repartition(3), ["g", "p", "i"], "test")
    assert placed.select(F.shiftright(rolling.AT, rolling.RANGE_BITS)).distinct().count() > 1
    got = rolling.positions(placed, ["g", "p"], "n").collect()
    assert len(got) == 982 and all(r.n == r.i for r in got)


def test_limits_must_be_positive_and_no_rows_give_no_files(spark):
    placed = rolling.in_order(spark.createDataFrame([], "g string, i int, size int"), ["g", "i"], "test")
    assert rolling.cut_files(placed, ["g"], F.col("size"), 5, 5).collect() == []
    with pytest.raises(ValueError):
        rolling.file_bounds(placed, ["g"], F.col("size"), 0, 5)


def test_a_hot_group_is_split_between_ranges(spark):
    frame = spark.range(20_000).select(F.lit("hot").alias("g"), F.col("id").alias("i"), F.lit(10).alias("size"))
    placed = rolling.in_order(frame.repartition(8), ["g", "i"], "test")
    assert placed.select(F.shiftright(rolling.AT, rolling.RANGE_BITS)).distinct().count() > 1
    got = rolling.cut_files(placed, ["g"], F.col("size"), 300, 1 << 40).groupBy("file_number").agg(F.min("i"), F.max("i"), F.count("*"))
    assert sorted(map(tuple, got.collect())) == [(k, 300 * k, min(300 * k + 299, 19_999), min(300, 20_000 - 300 * k)) for k in range(67)]


def test_stretches_gaps_and_overlaps(spark):
    offsets = [(f, p, o) for f, p, part in [("x", 0, [0, 1, 2, 5, 6]), ("y", 0, [6, 7, 10, 11, 12]), ("z", 0, [11, 12, 12, 20]), ("x", 1, [4])] for o in part]
    found = rolling.offset_intervals(spark.createDataFrame(offsets, "f string, p int, o bigint"), ["f", "p"], "o")
    assert {tuple(r) for r in found.collect()} == {
        ("x", 0, 0, 2, 3), ("x", 0, 5, 6, 2), ("y", 0, 6, 7, 2), ("y", 0, 10, 12, 3), ("z", 0, 11, 12, 2), ("z", 0, 20, 20, 1), ("x", 1, 4, 4, 1)}
    audit = {tuple(r) for r in rolling.offset_audit(found, ["p"]).collect()}
    assert audit == {(0, "gap", 3, 4), (0, "overlap", 6, 6), (0, "gap", 8, 9), (0, "overlap", 11, 12), (0, "gap", 13, 19)}


def test_audit_equals_counting_every_offset(spark):
    rng = random.Random(3)
    parts = [(p, a, a + rng.randrange(9)) for p in range(3) for a in rng.sample(range(200), 25)]
    frame = spark.createDataFrame(parts, "p int, first_offset bigint, last_offset bigint")
    got = {(r.p, r.kind, o) for r in rolling.offset_audit(frame, ["p"]).collect() for o in range(r.first_offset, r.last_offset + 1)}
    want = set()
    for p in range(3):
        times = {}
        for _, a, b in (x for x in parts if x[0] == p):
            for o in range(a, b + 1):
                times[o] = times.get(o, 0) + 1
        want |= {(p, "overlap", o) for o, n in times.items() if n > 1} | {(p, "gap", o) for o in range(min(times), max(times)) if o not in times}
    assert got == want
    rows = rolling.offset_audit(frame, ["p"]).orderBy("p", "first_offset").collect()
    assert all(a.p != b.p or a.kind != b.kind or a.last_offset + 1 < b.first_offset for a, b in zip(rows, rows[1:]))


def _message(i, source):
    return json.dumps({
        "event_id": f"e{i}", "source": source, "source_record_id": f"r{i}", "event_type": "source.raw_record", "effective_date": "2024-06-01",
        "fetched_at": "2024-06-01T00:00:00Z", "ingestion_run_id": "r1", "payload_sha256": "s", "payload": {"x": "y" * (i % 50)},
    })


def test_sink_rolls_by_bytes_and_a_repeated_batch_replaces_everything(spark, tmp_path):
    root = str(tmp_path / "bronze")
    rows = [("raw.epss", i % 2, i // 2, _message(i, "epss") if i % 10 else "junk") for i in range(200)] + [("raw.kev", 0, 7, "junk")]
    spark.createDataFrame(rows, LOG).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(LOG).parquet(str(tmp_path / "log"))
    sink.start_bronze_sink(stream, TOPICS, root, f"{tmp_path}/checkpoint", "2024-06-01", max_bytes=4000).awaitTermination()

    def state():
        files = bronze.lines(spark, root).groupBy("path").agg(F.sum(bronze.line_bytes()).alias("b")).collect()
        manifest = bronze.read_manifest(spark, f"{root}/_manifests").drop("created_at").orderBy("path").collect()
        offsets = bronze.read_offsets(spark, bronze.offsets_path(root)).collect()
        return sorted(files), [r.asDict() | {"sha256": None} for r in manifest], sorted(map(str, offsets)), sorted(
            tuple(r) for r in sink.stream_counts(spark, root).drop("run_id").collect())

    files, manifest, _, found = before = state()
    assert len(files) > 5 and all(r.b < 4000 + 400 for r in files) and len(manifest) == len(files)
    assert found == [("epss", 200, 180, 20), ("kev", 1, 0, 1)]
    assert sum(r["record_count"] for r in manifest) == 180 and all(r["first_offset"] <= r["last_offset"] for r in manifest)
    assert sink.offset_gaps(spark, root).collect() == []
    write = sink.batch_sink(TOPICS, root, f"{tmp_path}/checkpoint", "2024-06-01", "all", 10_000, 4000)
    write(spark.createDataFrame(rows, LOG), 0)
    assert [f.b for f in state()[0]] == [f.b for f in files] and state()[3] == found and state()[2] == before[2]
    shared = tmp_path.parent.parent
    assert not list((shared / "shared0" / "vulnlake").glob("sink-*"))


def test_sink_files_are_full_where_bytes_do_not_bind(spark, tmp_path):
    """The bytes of all files together end none of them."""
    root = str(tmp_path / "bronze")
    rows = [("raw.epss", 0, i, _message(i, "epss")) for i in range(195)]
    spark.createDataFrame(rows, LOG).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(LOG).parquet(str(tmp_path / "log"))
    sink.start_bronze_sink(
        stream, TOPICS, root, f"{tmp_path}/checkpoint", "2024-06-01", max_records=20, max_bytes=8000
    ).awaitTermination()
    files = bronze.lines(spark, root).groupBy("path").agg(F.count("*").alias("n"), F.sum(bronze.line_bytes()).alias("b")).orderBy("path").collect()
    assert [r.n for r in files] == [20] * 9 + [15]
    assert max(r.b for r in files) < 8000 < sum(r.b for r in files) / 2


def test_scratch_folders_go_with_their_job(spark):
    with session.scratch(spark, "job"):
        inner = session.new_dir(spark, "a")
        assert session.cut_lineage(spark.range(5), "b").count() == 5
        spark.range(3).write.parquet(inner)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(inner)
    assert "/job-" not in session.new_dir(spark, "c")


def test_counts_are_observed_in_the_pass_that_writes(spark, tmp_path):
    rows = spark.range(1000).withColumn("status", F.when(F.col("id") % 10 == 0, "invalid").otherwise("published"))
    seen, watch = counts.observed(rows, counts.status_measures(F.col("status"), ("published", "invalid", "failed")))
    seen.where("status = 'published'").write.parquet(str(tmp_path / "a"))
    assert counts.values(watch) == {"fetched": 1000, "published": 900, "invalid": 100, "failed": 0}


def test_silver_returns_its_counts(spark, tmp_path):
    rows = spark.range(30).select(
        F.when(F.col("id") % 10 == 9, F.lit("bad")).otherwise(F.format_string("CVE-2024-%05d", "id")).alias("cve"), F.lit(0.5).alias("epss_value"),
        F.lit(0.5).alias("percentile_value"), F.lit("2024-06-01").cast("date").alias("score_date"), F.lit("v").alias("model_version"),
        F.lit("published").alias("status"),
    )
    root = str(tmp_path)
    envelopes = ingest.score_envelopes(rows, "r", F.lit("2024-06-02 01:02:03").cast("timestamp"))
    bronze.write_bronze(envelopes, f"{root}/bronze", "epss", "2024-06-01")
    done = silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints", sources=("epss",))
    assert [(r.source, r.fetched, r.accepted, r.rejected) for r in done.collect()] == [("epss", 30, 27, 3)]
