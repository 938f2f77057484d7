"""Content hashes and the deterministic event envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCHEMA_VERSION = "1.0.0"
EVENT_TYPE = "source.raw_record"
NULL_PART = "\x00"


def canonical_json(payload: Column, schema: StructType) -> Column:
    """JSON text with the top-level fields in name order and nulls kept.

    Nested fields follow the declared schema, so equal content always gives equal text.
    """
    fields = [payload[name].alias(name) for name in sorted(schema.fieldNames())]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def sha256_text(text: Column) -> Column:
    return F.sha2(text, 256)


def event_id(source: Column, record_id: Column, effective_date: Column, payload_sha: Column) -> Column:
    """Hash of the record's identity; the run and the fetch time do not take part.

    A null part has a spelling of its own: it neither vanishes nor equals an empty text.
    """
    parts = [source, record_id, effective_date.cast("string"), payload_sha]
    return F.sha2(F.concat_ws("|", *(F.coalesce(p, F.lit(NULL_PART)) for p in parts)), 256)


def wrap(
    df: DataFrame,
    *,
    source: str,
    record_id: Column,
    effective_date: Column,
    payload: str,
    run_id: str | Column,
    fetched_at: Column,
    modified_at: Column | None = None,
) -> DataFrame:
    """Wrap the struct column `payload` of every row in an envelope."""
    schema = df.schema[payload].dataType
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    hashed = df.select(
        F.lit(source).alias("source"),
        record_id.alias("source_record_id"),
        effective_date.cast("string").alias("effective_date"),
        (modified_at if modified_at is not None else F.lit(None)).cast("string").alias("source_modified_at"),
        fetched_at.cast("string").alias("fetched_at"),
        run.alias("ingestion_run_id"),
        sha256_text(canonical_json(F.col(payload), schema)).alias("payload_sha256"),
        F.col(payload).alias("payload"),
    )
    return hashed.select(
        event_id(
            F.col("source"), F.col("source_record_id"), F.col("effective_date"), F.col("payload_sha256")
        ).alias("event_id"),
        F.lit(SCHEMA_VERSION).alias("event_schema_version"),
        "source",
        "source_record_id",
        F.lit(EVENT_TYPE).alias("event_type"),
        "effective_date",
        "source_modified_at",
        "fetched_at",
        "ingestion_run_id",
        "payload_sha256",
        "payload",
    )
