"""Rolled Bronze files, offsets and counts of the message sink, from the events as a log."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.inputs import query, table, text
from driver_queries.ingest_queries import BRONZE_ROWS, FETCHED, RUN, TOPICS, by_type, event_envelopes, write_types_but
from vulnlake.operators import rolling
from vulnlake.plans import validate
from vulnlake.session import new_dir, rename_files, scratch
from vulnlake.sources import bronze, messages, tables
from vulnlake.streaming import silver, sink

# ---- files by rows and bytes -----------------------------------------------------------------------------
ROLL_RECORDS, ROLL_BYTES = 700, 1 << 16


@query(
    "bronze_roll",
    f"""with l as (select event_type as source, event_id, strlen(repeat(coalesce(props, ''), cast(event_id % 9 + 1 as integer))) + 1 as b from events),
    t as (select source, event_id, b, coalesce(sum(b) over w, 0) as bytes_before, row_number() over (partition by source order by event_id) - 1 as rows_before
          from l window w as (partition by source order by event_id rows between unbounded preceding and 1 preceding)),
    f as (select source, min(event_id) as first, count(*) as records, cast(sum(b) as bigint) as bytes from t
          group by source, bytes_before // {ROLL_BYTES}, rows_before // {ROLL_RECORDS})
    select source, cast(row_number() over (partition by source order by first) - 1 as bigint) as file, records, bytes from f""",
)
def bronze_roll(spark, sf):
    """Records of mixed size in files that end at a number of rows or bytes; numbers, rows and bytes of the files as they lie there."""
    root = new_dir(spark, "roll")
    lines = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), "event_id",
        F.expr("repeat(coalesce(props, ''), cast(event_id % 9 + 1 as int))").alias("value"),
    )
    with scratch(spark, "roll"):
        placed = rolling.in_order(lines, ["source", "event_id"], "lines")
        bronze.write_rolled(placed, root, FETCHED[:10], RUN, max_records=ROLL_RECORDS, max_bytes=ROLL_BYTES)
    files = bronze.lines(spark, root).groupBy("path").agg(
        F.count("*").alias("records"), F.sum(bronze.line_bytes()).alias("bytes")
    )
    return files.select(
        F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source"),
        F.regexp_extract("path", f"/run_id={RUN}-([0-9]+)/", 1).cast("bigint").alias("file"), "records", "bytes",
    )


# ---- offsets ---------------------------------------------------------------------------------------------
SINK_RECORDS = 300
# Offsets that never arrive, and those that arrive once more.
LOST, AGAIN = "offset_ % 97 = 5", "offset_ % 89 in (7, 8)"

LOG = f"""m as (select event_id as n, event_type as topic, cast(event_id % 3 as integer) as part,
        row_number() over (partition by event_type, event_id % 3 order by event_id) - 1 as offset_ from events
        where event_type in ('view', 'click', 'purchase')),
    g as (select m.*, case topic when 'view' then 'nvd' when 'click' then 'epss' else 'kev' end as source, batch,
        n % 11 <> 0 and n % 13 <> 0 as good from m join (select unnest([0, 1]) as batch) on batch = 0 or {AGAIN} where not ({LOST}))"""


def _log(spark, sf):
    """The messages, numbered by ranges of events, so that no task sees a whole partition of the log; the values are spelled after that."""
    n = F.col("event_id")
    record = F.to_json(F.struct(
        F.when(n % 13 != 0, F.concat(F.lit("e"), text(n))).alias("event_id"),
        messages.source_of(F.col("topic"), TOPICS).alias("source"), text(n).alias("source_record_id"),
        F.lit("source.raw_record").alias("event_type"), text(F.col("ts").cast("date")).alias("effective_date"),
        F.lit("2024-06-01T00:00:00Z").alias("fetched_at"), F.lit(RUN).alias("ingestion_run_id"),
        F.sha2("props", 256).alias("payload_sha256"), F.struct(F.col("value")).alias("payload"),
    ))
    wanted = table(spark, sf, "events").where(F.col("event_type").isin(*TOPICS.values())).select(
        F.col("event_type").alias("topic"), (n % 3).cast("int").alias("partition"), n, "ts", "value", "props"
    )
    placed = rolling.in_order(wanted, ["topic", "partition", "event_id"], "log")
    return rolling.positions(placed, ["topic", "partition"], "offset").select(
        "topic", "partition", "offset", F.when(n % 11 == 0, F.lit("{")).otherwise(record).alias("value")
    ).where(f"not ({LOST.replace('offset_', 'offset')})")


def _run_log(spark, sf):
    """Two runs of the sink: all messages, then those that are delivered again."""
    root = new_dir(spark, "log")
    log = _log(spark, sf)
    for part in (log, log.where(AGAIN.replace("offset_", "offset"))):
        part.write.mode("append").parquet(f"{root}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{root}/log")
        sink.start_bronze_sink(
            stream, TOPICS, f"{root}/bronze", f"{root}/checkpoint", FETCHED[:10], max_records=SINK_RECORDS
        ).awaitTermination()
    return f"{root}/bronze"


@query(
    "manifest_offsets",
    f"""with {LOG}, f as (select *, (row_number() over (partition by source, batch order by part, offset_) - 1) // {SINK_RECORDS} as file
        from g where good)
    select source, cast(batch as bigint) as batch, cast(file as bigint) as file, count(*) as records, min(offset_) as first_offset,
        max(offset_) as last_offset, true as hashed from f group by source, batch, file""",
)
def manifest_offsets(spark, sf):
    """What the manifests say of the files that the sink wrote, held against the files themselves."""
    root = _run_log(spark, sf)
    manifest = bronze.read_manifest(spark, f"{root}/_manifests")
    facts = bronze.file_facts(spark, root, "*").select("path", F.col("sha256").alias("own"), F.col("record_count").alias("n"))
    run = F.regexp_extract("path", "-([0-9]+)-([0-9]{5,})/", 1), F.regexp_extract("path", "-([0-9]+)-([0-9]{5,})/", 2)
    return manifest.join(facts, "path").select(
        "source", run[0].cast("bigint").alias("batch"), run[1].cast("bigint").alias("file"), F.col("record_count").alias("records"),
        "first_offset", "last_offset", ((F.col("sha256") == F.col("own")) & (F.col("record_count") == F.col("n"))).alias("hashed"),
    )


@query(
    "offset_gaps",
    f"""with {LOG}, s as (select topic, part, offset_, count(*) as times from g group by all),
    e as (select topic, part, unnest(range(min(offset_), max(offset_) + 1)) as offset_ from s group by topic, part),
    k as (select topic, part, offset_, case when times is null then 'gap' when times > 1 then 'overlap' end as kind
          from e left join s using (topic, part, offset_)),
    i as (select *, offset_ - row_number() over (partition by topic, part, kind order by offset_) as run from k where kind is not null)
    select topic, part as "partition", kind, min(offset_) as first_offset, max(offset_) as last_offset from i group by topic, part, kind, run""",
)
def offset_gaps(spark, sf):
    """Offsets that neither a file nor a dead letter holds, and those that several hold, by the stored stretches alone."""
    return sink.offset_gaps(spark, _run_log(spark, sf))


# ---- counts ----------------------------------------------------------------------------------------------


@query(
    "stream_counts",
    f"""with {LOG}, {BRONZE_ROWS}
    select 'sink' as step, source, count(*) as fetched, count(*) filter (good) as good, count(*) filter (not good) as bad from g group by source
    union all select 'silver', 'epss', count(*), count(*) filter (cve <> 'X' and epss <= 1), count(*) filter (cve = 'X' or epss > 1) from bronze_rows""",
)
def stream_counts(spark, sf):
    """Counts that the sink and the stream to Silver observed while they wrote."""
    sunk = sink.stream_counts(spark, _run_log(spark, sf)).groupBy("source").agg(
        F.sum("fetched").alias("fetched"), F.sum("written").alias("good"), F.sum("dead_letters").alias("bad")
    )
    root = new_dir(spark, "counted")
    bronze.write_bronze(event_envelopes(spark, sf), f"{root}/bronze", "epss", FETCHED[:10])
    done = silver.run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints", sources=("epss",))
    kept = done.groupBy("source").agg(F.sum("fetched").alias("fetched"), F.sum("accepted").alias("good"), F.sum("rejected").alias("bad"))
    columns = ["source", "fetched", "good", "bad"]
    return sunk.select(F.lit("sink").alias("step"), *columns).unionByName(kept.select(F.lit("silver").alias("step"), *columns))


# ---- replays ---------------------------------------------------------------------------------------------


@query(
    "stream_replay",
    f"with {BRONZE_ROWS} select record, count(*) as times from bronze_rows where cve <> 'X' and epss <= 1 group by record",
)
def stream_replay(spark, sf):
    """Every seventh event arrives again long after any watermark, by a query that starts anew; Silver has each event once."""
    root = new_dir(spark, "replay")
    rows = event_envelopes(spark, sf)
    for part, checkpoint in ((rows, "first"), (rows.where(F.col("source_record_id").cast("bigint") % 7 == 0), "second")):
        bronze.write_bronze(part, f"{root}/bronze", "epss", FETCHED[:10])
        silver.run_silver(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/{checkpoint}", sources=("epss",), replay_proof=True
        )
    kept = tables.read_silver(spark, f"{root}/silver", "epss").select(
        (F.regexp_extract("cve_id", "([0-9]+)$", 1).cast("bigint") - 10000).alias("record")
    )
    return kept.groupBy("record").agg(F.count("*").alias("times"))


# ---- unreadable files ------------------------------------------------------------------------------------


@query(
    "bronze_unreadable",
    """select count(*) filter (event_type <> 'click') as records_total, cast(0 as bigint) as missing_manifest,
        cast(1 as bigint) as parse_errors, cast(0 as integer) as passed from events""",
)
def bronze_unreadable(spark, sf):
    """Files per event type; one file, which has all records of its type and its manifest, is no gzip file at all."""
    root = new_dir(spark, "unreadable")
    write_types_but(spark, sf, root, "click")
    folder = f"{bronze.source_path(root, 'epss')}/ingest_date={FETCHED[:10]}/run_id=click"
    lines = by_type(spark, sf, "click").select(F.to_json(F.struct("*")).alias("value"))
    lines.write.option("compression", "deflate").text(folder)
    rename_files(spark, folder, ".txt.deflate", ".txt.gz")
    bronze.write_manifest(spark, root, "epss", f"{root}/_manifests/source=epss", FETCHED)
    summary = validate.validate_bronze(spark, root, f"{root}/_manifests", ("epss",))
    return summary.select("records_total", "missing_manifest", "parse_errors", F.col("passed").cast("int").alias("passed"))
