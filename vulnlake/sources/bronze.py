"""The Bronze log: gzip JSON lines under source=/ingest_date=/run_id=, with a manifest table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.operators import rolling
from vulnlake.sources.tables import read_or_empty

# Data files only: sidecars such as `x.jsonl.gz.manifest.json` do not match.
DATA_GLOB = "*.{json,jsonl,txt}.gz"
MAX_RECORDS_PER_FILE = 10_000
MAX_BYTES_PER_FILE = 64 * 1024 * 1024


def records_per_file(
    record_bytes: int, max_records: int = MAX_RECORDS_PER_FILE, max_bytes: int = MAX_BYTES_PER_FILE
) -> int:
    """Rows after which a file of equal records rolls over; `write_rolled` measures them."""
    return max(1, min(max_records, max_bytes // max(1, record_bytes)))


def source_path(root: str, source: str) -> str:
    return f"{root}/source={source}"


def manifest_path(root: str, source: str) -> str:
    return f"{root}/_manifests/source={source}"


def write_bronze(
    envelopes: DataFrame,
    root: str,
    source: str,
    ingest_date: str,
    *,
    max_records: int = MAX_RECORDS_PER_FILE,
    mode: str = "append",
) -> None:
    """Append envelopes of one source. The record keeps its own source and run id."""
    (
        envelopes.withColumn("ingest_date", F.lit(ingest_date))
        .withColumn("run_id", F.col("ingestion_run_id"))
        .write.mode(mode)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .option("ignoreNullFields", "false")
        .partitionBy("ingest_date", "run_id")
        .json(source_path(root, source))
    )


def line_bytes(value: str = "value") -> Column:
    """Bytes of a record in its file, with the line feed."""
    return F.octet_length(value) + 1


def write_rolled(
    placed: DataFrame, root: str, ingest_date: str, run: str, *, max_records: int = MAX_RECORDS_PER_FILE, max_bytes: int = MAX_BYTES_PER_FILE,
    bytes_if_needed: bool = False,
) -> DataFrame:
    """Write the lines `value` of all sources in one job, a file per source and file number; returns the rows with `file`.

    `placed` is the result of `rolling.in_order` by source and the order of writing. A file ends where the lines or the
    plain bytes of its source cross a multiple of `max_records` or `max_bytes`, with `bytes_if_needed` at bytes only where lines alone would let
    it grow beyond them. File n of a run lies alone under run_id=<run>-<n>, which a repeated write replaces.
    """
    cut = rolling.cut_files(placed, ["source"], line_bytes(), max_records, max_bytes, bytes_if_needed)
    named = cut.withColumn("file", F.format_string(f"{run}-%05d", "file_number"))
    lines = named.withColumns({"ingest_date": F.lit(ingest_date), "run_id": F.col("file")})
    (
        lines.repartition("source", "run_id").sortWithinPartitions("source", "run_id", rolling.AT)
        .select("source", "ingest_date", "run_id", F.col("value").cast("string").alias("value"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
        .partitionBy("source", "ingest_date", "run_id").text(root)
    )
    return named


def read_bronze(
    spark: SparkSession, root: str, source: str, *, stream: bool = False, max_files: int | None = None
) -> DataFrame:
    """Envelopes of one source with the fixed schema; malformed lines become all-null rows.

    Columns after the schema come from the directories (ingest_date, run_id).
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.schema(schemas.bronze(source))
        .option("pathGlobFilter", DATA_GLOB)
        .json(source_path(root, source))
    )


def lines(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("pathGlobFilter", DATA_GLOB)
        .option("recursiveFileLookup", "true")
        .option("ignoreCorruptFiles", "true")
        .option("lineSep", "\n")
        .text(path)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )


def file_facts(spark: SparkSession, root: str, source: str, run_id: str | None = None) -> DataFrame:
    """One row per data file: path, sha256, record_count, and whether it decompresses whole.

    All files of the source (`*` for every source), or those of one run (which may be a pattern).

    The gzip trailer holds the plain size; a truncated file cannot match it. Files are hashed as
    binary (their size is capped by the writer) and counted as text, both on the executors.
    """
    path = source_path(root, source) + (f"/ingest_date=*/run_id={run_id}" if run_id else "")
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", DATA_GLOB)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    trailer_bytes = F.regexp_extract_all(F.hex(F.substring("content", -4, 4)), F.lit("(..)"))
    trailer = F.conv(F.array_join(F.reverse(trailer_bytes), ""), 16, 10).cast("bigint")
    hashed = files.select(
        F.col("path"), F.sha2("content", 256).alias("sha256"), trailer.alias("plain_bytes")
    )
    counted = (
        lines(spark, path)
        .groupBy("path")
        .agg(
            F.count_if(F.trim("value") != "").alias("record_count"),
            F.sum(F.octet_length("value") + 1).alias("line_bytes"),
        )
    )
    whole = (F.coalesce("line_bytes", F.lit(0)) - F.col("plain_bytes")).isin(0, 1)
    return (
        hashed.withColumn("path", _canonical(F.col("path")))
        .join(counted.withColumn("path", _canonical(F.col("path"))), "path", "left")
        .select(
            "path",
            F.regexp_extract("path", "/source=([^/]+)/", 1).alias("source") if source == "*" else F.lit(source).alias("source"),
            F.coalesce("record_count", F.lit(0)).alias("record_count"),
            "sha256",
            F.coalesce(whole, F.lit(False)).alias("readable"),
        )
    )


def _canonical(path):
    """file:/x and file:///x name the same file."""
    return F.regexp_replace(path, r"^([a-z0-9]+):/+", "$1:/")


def write_manifest(
    spark: SparkSession, root: str, source: str, manifest_path: str, created_at: str, run_id: str | None = None
) -> None:
    """Hash and count the finished files of one source (or run) in a second job and store the result."""
    (
        file_facts(spark, root, source, run_id)
        .select("path", "source", "record_count", "sha256", F.lit(created_at).alias("created_at"))
        .write.mode("append")
        .parquet(manifest_path)
    )


def write_run_manifest(spark: SparkSession, root: str, run: str, created_at: str, files: DataFrame) -> None:
    """Manifest rows of the files of one rolled run, with their first and last offsets, and the stretches of offsets themselves.

    `files` has source, topic, partition, offset and `file`, the run id of the row's file or null for a dead letter. Both tables of a run are
    replaced when it is repeated.
    """
    # dead letters have no file that bounds them; a part of their range does
    piece = F.coalesce("file", F.shiftright(rolling.AT, 13).cast("string")).alias("piece")
    keys = ["source", "topic", "partition", "file", "piece"]
    found = rolling.offset_intervals(files.select("source", "topic", "partition", "file", piece, "offset"), keys, "offset")
    kept = found.withColumn("run_id", F.lit(run)).select(*schemas.struct(schemas.OFFSETS).names)
    kept.write.mode("overwrite").parquet(f"{offsets_path(root)}/run_id={run}")
    ends = read_offsets(spark, f"{offsets_path(root)}/run_id={run}").where("file is not null").groupBy(
        F.col("source").alias("of"), "file"
    ).agg(F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
    facts = file_facts(spark, root, "*", f"{run}-*").withColumn("file", F.regexp_extract("path", "/run_id=([^/]+)/", 1))
    joined = facts.join(ends.withColumnRenamed("file", "in"), (F.col("source") == F.col("of")) & (F.col("file") == F.col("in")), "left")
    (
        joined.withColumn("created_at", F.lit(created_at)).select(*schemas.struct(schemas.MANIFEST).names)
        .write.mode("overwrite").parquet(f"{root}/_manifests/run_id={run}")
    )


def offsets_path(root: str) -> str:
    return f"{root}/_offsets"


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """All stretches of offsets below the path."""
    return read_or_empty(spark, path, schemas.struct(schemas.OFFSETS))


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """All manifest rows below the path; none where nothing has been written yet. Files that no message log filled have no offsets."""
    return read_or_empty(spark, manifest_path, schemas.struct(schemas.MANIFEST))
