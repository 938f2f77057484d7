"""Bronze to Silver by Structured Streaming, one query per source."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vulnlake import schemas
from vulnlake.operators import counts
from vulnlake.operators.quality import REASON, accepted, write_rejected
from vulnlake.plans.normalize import NORMALIZERS
from vulnlake.session import delete_dir, scratch
from vulnlake.sources import bronze
from vulnlake.streaming.replay import EventIndex


# A backlog is worked off in batches of so many files.
MAX_FILES_PER_TRIGGER = 1000


def rejected_path(silver_root: str, source: str) -> str:
    return f"{silver_root}/rejected/source={source}"


def counts_path(silver_root: str) -> str:
    return f"{silver_root}/_counts"


def stream_counts(spark: SparkSession, silver_root: str) -> DataFrame:
    """(source, load, batch, fetched, accepted, rejected) of every batch."""
    return counts.read(spark, counts_path(silver_root), schemas.SILVER_COUNTS)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query, stored with its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def index_path(silver_root: str, source: str) -> str:
    return f"{silver_root}/_events/source={source}"


def batch_writer(
    source: str, silver_root: str, checkpoint: str, replay_proof: bool = False
) -> Callable[[DataFrame, int], None]:
    """Write one micro-batch: good rows to the table, bad rows by reason.

    With `replay_proof` only the first arrival of an event is written, by an index of all events that has no end of memory.

    What the batch fetched, accepted and rejected is observed in the pass that writes the good rows, and stored.
    Each batch owns the directory load=<query id>/batch=<n> and overwrites it, so a batch that Spark
    repeats after a failure leaves no duplicates, and a new checkpoint never touches older loads.
    """
    table, _ = schemas.SILVER[source]
    known: dict[str, str] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        if "id" not in known:
            known["id"] = query_id(batch.sparkSession, checkpoint)
        with scratch(batch.sparkSession, "silver"):
            write_batch(batch, batch_id)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        load = f"load={known['id']}/batch={batch_id}"
        if replay_proof:
            batch = EventIndex(batch.sparkSession, index_path(silver_root, source), known["id"]).first_arrivals(batch, batch_id)
        annotated = NORMALIZERS[source](batch)
        bad = F.col(REASON).isNotNull()
        measures = {"fetched": F.count(F.lit(1)), "accepted": F.count_if(~bad), "rejected": F.count_if(bad)}
        seen, watch = counts.observed(annotated, measures)
        accepted(seen).write.mode("overwrite").parquet(f"{silver_root}/{table}/{load}")
        found = counts.values(watch)
        # nothing is held: only a batch that has rejects is read once more for them
        rejects = f"{rejected_path(silver_root, source)}/{load}"
        if found.get("rejected"):
            write_rejected(annotated, rejects, "overwrite")
        else:
            delete_dir(batch.sparkSession, rejects)
        row = {"source": source, "load": known["id"], "batch": batch_id, **found}
        counts.store(batch.sparkSession, f"{counts_path(silver_root)}/source={source}/{load}", schemas.SILVER_COUNTS, [row])

    return write


def dedup(envelopes: DataFrame, delay: str, id_: str = "event_id") -> DataFrame:
    """Drop events that are replayed within `delay` of the first arrival.

    The clock is the time of arrival, so no record is ever late and dropped for its age, and the
    state expires after `delay`. Records without an id stay apart from each other for validation.
    """
    timed = envelopes.withColumns(
        {"_arrived": F.current_timestamp(), "_dedup_key": F.coalesce(F.col(id_), F.expr("uuid()"))}
    )
    return timed.withWatermark("_arrived", delay).dropDuplicatesWithinWatermark(["_dedup_key"]).drop(
        "_arrived", "_dedup_key"
    )


def start_silver_streams(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    checkpoint_root: str,
    *,
    trigger: str = "availableNow",
    processing_time: str = "10 seconds",
    sources: tuple[str, ...] = ("nvd", "epss", "kev"),
    dedup_delay: str | None = None,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    replay_proof: bool = False,
) -> list[StreamingQuery]:
    """Start the named, checkpointed queries; `trigger` is availableNow or processingTime.

    `dedup_delay` drops replays within that time of the first arrival by stream state, `replay_proof` all of them by the index.
    """
    if trigger not in ("availableNow", "processingTime"):
        raise ValueError(f"unknown trigger: {trigger}")
    when = {"availableNow": True} if trigger == "availableNow" else {"processingTime": processing_time}
    queries = []
    for source in sources:
        checkpoint = f"{checkpoint_root}/{source}_to_silver"
        stream = bronze.read_bronze(spark, bronze_root, source, stream=True, max_files=max_files_per_trigger)
        if dedup_delay is not None:
            stream = dedup(stream, dedup_delay)
        queries.append(
            stream.writeStream.foreachBatch(batch_writer(source, silver_root, checkpoint, replay_proof))
            .option("checkpointLocation", checkpoint)
            .queryName(f"{source}_to_silver")
            .trigger(**when)
            .start()
        )
    return queries


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, checkpoint_root: str, **options) -> DataFrame:
    """Process what is there and return, when every query has finished, the stored counts of all batches."""
    for query in start_silver_streams(spark, bronze_root, silver_root, checkpoint_root, **options):
        query.awaitTermination()
    return stream_counts(spark, silver_root)
