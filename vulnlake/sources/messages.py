"""A mixed message log (topic, partition, offset, value): routing, parsing and dead letters.

Works on any DataFrame or stream with those columns, such as Spark's Kafka source.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vulnlake import schemas
from vulnlake.functions.times import parse_date

ERROR_TEXT_LIMIT = 2000
SOURCES = ("nvd", "epss", "kev")
# Fields an envelope must carry (fixed values).
ENVELOPE_REQUIRED = [
    "event_id", "source", "source_record_id", "event_type", "effective_date", "fetched_at",
    "ingestion_run_id", "payload_sha256", "payload",
]
UNKNOWN = "unknown"


def read_log(
    spark: SparkSession, servers: str, topics: list[str], *, starting_offsets: str = "earliest", stream: bool = True
) -> DataFrame:
    """The topics through Spark's Kafka source, where that connector is on the class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    options = {
        "kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": starting_offsets
    }
    return reader.options(**options).load().select("topic", "partition", "offset", "value")


def source_of(topic: Column, topics: dict[str, str]) -> Column:
    """Source name of a topic; `topics` maps source to topic."""
    pairs = F.create_map(*chain.from_iterable((F.lit(t), F.lit(s)) for s, t in topics.items()))
    return F.coalesce(F.try_element_at(pairs, topic), F.lit(UNKNOWN))


def route(
    messages: DataFrame, topics: dict[str, str], *, source: str = "all", max_messages: int | None = None
) -> DataFrame:
    """Add the source column; keep the topics of one source, or those of all known sources."""
    wanted = list(topics.values()) if source == "all" else [topics[source]]
    routed = messages.filter(F.col("topic").isin(wanted)).withColumn("source", source_of(F.col("topic"), topics))
    return routed if max_messages is None else routed.limit(max_messages)


def parse(
    messages: DataFrame,
    schema: StructType,
    required: list[str],
    value: str = "value",
    valid: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Add `record` (parsed value) and `error` (null for a good message).

    A message is bad when it is not a JSON object of the schema, lacks a required field, or has a
    field for which its check in `valid` does not hold.
    """
    corrupt = StructType(list(schema.fields)).add("_corrupt", "string")
    parsed = F.from_json(
        F.col(value).cast("string"), corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    out = messages.withColumn("_parsed", parsed)
    broken = F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    absent = F.concat_ws(
        ", ", *(F.when(F.col(f"_parsed.{name}").isNull(), F.lit(name)) for name in required)
    )
    wrong = F.concat_ws(
        ", ",
        *(
            F.when(~F.coalesce(holds(F.col(f"_parsed.{name}")), F.lit(False)), F.lit(name))
            for name, holds in (valid or {}).items()
        ),
    )
    error = (
        F.when(broken, F.lit("not a JSON record"))
        .when(absent != "", F.concat(F.lit("missing: "), absent))
        .when(wrong != "", F.concat(F.lit("invalid: "), wrong))
    )
    fields = F.struct(*(F.col(f"_parsed.{f.name}").alias(f.name) for f in schema.fields))
    return out.withColumn("error", error).withColumn("record", F.when(error.isNull(), fields)).drop("_parsed")


def parse_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Check the values as envelopes; the payload stays JSON text, whatever its fields."""
    schema = schemas.struct(f"{schemas.ENVELOPE_FIELDS}, payload string")
    valid = {
        "source": lambda c: c.isin(*SOURCES),
        "effective_date": lambda c: parse_date(c).isNotNull(),
        "fetched_at": lambda c: c.try_cast("timestamp").isNotNull(),
        "payload": lambda c: c.startswith("{"),
    }
    return parse(messages, schema, ENVELOPE_REQUIRED, value, valid)


def good_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull())


def dead_letters(parsed: DataFrame, failed_at: Column, value: str = "value") -> DataFrame:
    """Quarantine records of the bad messages; the raw value survives as base64."""
    kind = (
        F.when(F.col("error").startswith("missing: "), "MissingField")
        .when(F.col("error").startswith("invalid: "), "InvalidField")
        .otherwise("MalformedRecord")
    )
    return parsed.filter(F.col("error").isNotNull()).select(
        F.col("topic").alias("original_topic"),
        F.col("partition").alias("original_partition"),
        F.col("offset").alias("original_offset"),
        failed_at.alias("failed_at"),
        kind.alias("error_type"),
        F.substring("error", 1, ERROR_TEXT_LIMIT).alias("error_message"),
        F.base64(F.coalesce(F.col(value).cast("binary"), F.lit("").cast("binary"))).alias("raw_value_base64"),
    )
