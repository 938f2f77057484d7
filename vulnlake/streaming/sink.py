"""Message log to Bronze: good envelopes to their source's files, bad messages to the dead letters."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vulnlake import schemas
from vulnlake.operators import counts, rolling
from vulnlake.operators.latest import latest
from vulnlake.session import make_dir, scratch
from vulnlake.sources import bronze, messages
from vulnlake.streaming.silver import query_id


def dead_letter_path(bronze_root: str) -> str:
    return f"{bronze_root}/_dead_letters"


def counts_path(bronze_root: str) -> str:
    return f"{bronze_root}/_counts/sink"


def batch_sink(
    topics: dict[str, str], bronze_root: str, checkpoint: str, ingest_date: str, source: str, max_records: int,
    max_bytes: int = bronze.MAX_BYTES_PER_FILE,
) -> Callable[[DataFrame, int], None]:
    """Write one micro-batch. Each batch owns its run ids and replaces what lies under them when repeated.

    The messages are put in the order of source, partition and offset, parsed and stored in one job, which also counts them. From there one
    job writes the files of all sources, rolled by rows and bytes, and one the dead letters. A value is stored as it
    arrived, so no payload field is lost. Offsets are the stream's checkpoint, which advances after the files, their manifest rows, their
    stretches of offsets and the counts are in place.
    """
    wanted = list(topics) if source == "all" else [source]
    known: dict[str, str] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if "id" not in known:
            known["id"] = query_id(spark, checkpoint)
            for name in wanted:
                make_dir(spark, bronze.source_path(bronze_root, name))
        run = f"{known['id']}-{batch_id}"
        good = F.col("error").isNull()
        measures = {f"{name}_{kind}": F.count_if((F.col("source") == name) & is_so)
                    for name in wanted for kind, is_so in (("written", good), ("dead_letters", ~good))}
        watch = None

        def parsed(routed: DataFrame) -> DataFrame:
            nonlocal watch
            kept = messages.parse_envelopes(routed).select("topic", "partition", "offset", "value", "source", "error", rolling.AT)
            seen, watch = counts.observed(kept, measures)
            return seen

        with scratch(spark, "sink"):
            routed = messages.route(batch, topics, source=source).select("topic", "partition", "offset", "value", "source")
            placed = rolling.in_order(routed, ["source", "partition", "offset"], "messages", parsed)
            found = counts.values(watch)
            named = bronze.write_rolled(
                placed.where(good), bronze_root, ingest_date, run, max_records=max_records, max_bytes=max_bytes, bytes_if_needed=True
            )
            messages.dead_letters(placed, F.current_timestamp()).write.mode("overwrite").json(
                f"{dead_letter_path(bronze_root)}/run_id={run}"
            )
            rows = [{"source": n, "run_id": run, "written": found.get(f"{n}_written", 0), "dead_letters": found.get(f"{n}_dead_letters", 0)}
                    for n in wanted]
            if any(r["written"] or r["dead_letters"] for r in rows):
                own = ["source", "topic", "partition", "offset", "file", rolling.AT]
                letters = placed.where(~good).withColumn("file", F.lit(None).cast("string"))
                created_at = datetime.now(UTC).isoformat(timespec="microseconds")
                bronze.write_run_manifest(spark, bronze_root, run, created_at, named.select(*own).unionByName(letters.select(*own)))
            stored = [{**r, "fetched": r["written"] + r["dead_letters"]} for r in rows]
            counts.store(spark, f"{counts_path(bronze_root)}/run_id={run}", schemas.SINK_COUNTS, stored)

    return write


def stream_counts(spark: SparkSession, bronze_root: str) -> DataFrame:
    """(source, run_id, fetched, written, dead_letters) of every batch, as counted while it was stored."""
    return counts.read(spark, counts_path(bronze_root), schemas.SINK_COUNTS)


def offset_gaps(spark: SparkSession, bronze_root: str) -> DataFrame:
    """(topic, partition, kind, first_offset, last_offset): offsets that no file and no dead letter holds, and those that several hold."""
    return rolling.offset_audit(bronze.read_offsets(spark, bronze.offsets_path(bronze_root)), ["topic", "partition"])


def totals(spark: SparkSession, bronze_root: str, topics: dict[str, str]) -> DataFrame:
    """(source, consumed, written, dead_letters) over all batches, from the manifests and the dead letters."""
    files = latest(bronze.read_manifest(spark, f"{bronze_root}/_manifests"), ["path"], "created_at", ["sha256", "record_count"])
    written = files.select("source", F.col("record_count").alias("written"), F.lit(0).cast("bigint").alias("dead_letters"))
    letters = spark.read.schema("original_topic string").json(dead_letter_path(bronze_root)).select(
        messages.source_of(F.col("original_topic"), topics).alias("source"),
        F.lit(0).cast("bigint").alias("written"), F.lit(1).cast("bigint").alias("dead_letters"),
    )
    summed = written.unionByName(letters).groupBy("source").agg(
        F.sum("written").alias("written"), F.sum("dead_letters").alias("dead_letters")
    )
    return summed.select("source", (F.col("written") + F.col("dead_letters")).alias("consumed"), "written", "dead_letters")


def start_bronze_sink(
    stream: DataFrame,
    topics: dict[str, str],
    bronze_root: str,
    checkpoint: str,
    ingest_date: str,
    *,
    source: str = "all",
    trigger: str = "availableNow",
    processing_time: str = "30 seconds",
    max_records: int = bronze.MAX_RECORDS_PER_FILE,
    max_bytes: int = bronze.MAX_BYTES_PER_FILE,
) -> StreamingQuery:
    """Start the sink over a stream with topic, partition, offset and value."""
    when = {"availableNow": True} if trigger == "availableNow" else {"processingTime": processing_time}
    return (
        stream.writeStream.foreachBatch(batch_sink(topics, bronze_root, checkpoint, ingest_date, source, max_records, max_bytes))
        .option("checkpointLocation", checkpoint)
        .queryName("bronze_sink")
        .trigger(**when)
        .start()
    )
