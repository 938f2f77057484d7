"""Source files to Bronze envelopes, as one batch job per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.functions.hashing import wrap
from vulnlake.functions.times import parse_date, parse_rfc3339
from vulnlake.operators import counts, quality
from vulnlake.sources import bronze, catalog, osv, scores

ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def iso_text(ts: Column) -> Column:
    return F.date_format(ts, ISO_TEXT)


def osv_envelopes(docs: DataFrame, run_id: str, fetched_at: Column) -> DataFrame:
    """Envelopes of the published documents; the fetch date stands in for a missing publication date."""
    good = docs.filter(osv.doc_status(F.col("id"), F.col("withdrawn"), F.col("details")) == "published")
    return wrap(
        osv.adapt(good),
        source="nvd",
        record_id=F.col("payload.id"),
        effective_date=F.coalesce(parse_date(F.col("payload.published")), F.to_date(fetched_at)),
        payload="payload",
        run_id=run_id,
        fetched_at=iso_text(fetched_at),
        modified_at=iso_text(parse_rfc3339(F.col("modified"))),
    )


def score_envelopes(rows: DataFrame, run_id: str, fetched_at: Column) -> DataFrame:
    """Envelopes of the valid rows of daily score files (output of `scores.typed_scores`)."""
    day = F.col("score_date").cast("string")
    payload = F.struct(
        F.col("cve").alias("cve"),
        F.col("epss_value").alias("epss"),
        F.col("percentile_value").alias("percentile"),
        day.alias("score_date"),
        F.col("model_version").alias("model_version"),
    )
    good = rows.filter("status = 'published'").withColumn("payload", payload)
    return wrap(
        good,
        source="epss",
        record_id=F.concat_ws("|", F.col("cve"), day),
        effective_date=F.col("score_date"),
        payload="payload",
        run_id=run_id,
        fetched_at=iso_text(fetched_at),
    )


def catalog_envelopes(
    entries: DataFrame, run_id: str, fetched_at: Column, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Envelopes of the catalog entries (output of `catalog.explode_catalog`) in the date range."""
    status = catalog.entry_status(F.col("cveID"), F.col("dateAdded"), start, end)
    payload = F.struct(*(F.col(c) for c in entries.columns))
    added = parse_date(F.col("dateAdded"))
    return wrap(
        entries.filter(status == "published").withColumn("payload", payload),
        source="kev",
        record_id=F.col("cveID"),
        effective_date=added,
        payload="payload",
        run_id=run_id,
        fetched_at=iso_text(fetched_at),
        modified_at=iso_text(added.cast("timestamp")),
    )


def osv_counts(docs: DataFrame) -> DataFrame:
    """Ingest statistics of the documents: what was fetched, published, skipped and refused."""
    return quality.status_counts(docs, F.lit("nvd"), osv.doc_status(F.col("id"), F.col("withdrawn"), F.col("details")))


def score_counts(rows: DataFrame) -> DataFrame:
    return quality.status_counts(rows, F.lit("epss"), F.col("status"))


def catalog_counts(entries: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    return quality.status_counts(entries, F.lit("kev"), catalog.entry_status(F.col("cveID"), F.col("dateAdded"), start, end))


def run_ingest(
    spark: SparkSession,
    bronze_root: str,
    *,
    run_id: str,
    fetched_at: str,
    osv_dir: str | None = None,
    scores_dir: str | None = None,
    catalog_path: str | None = None,
    max_records: int = bronze.MAX_RECORDS_PER_FILE,
) -> DataFrame | None:
    """Write Bronze and its manifests for whichever sources are given; returns the stored counts of each source.

    Source rows are counted by status in the pass that writes their envelopes; nothing is read again for the counts.
    """
    at = F.lit(fetched_at).cast("timestamp")
    jobs = {}

    def watched(source: str, rows: DataFrame, status: Column) -> DataFrame:
        seen, watches[source] = counts.observed(rows, counts.status_measures(status, quality.STATUSES))
        return seen

    watches: dict[str, Observation] = {}
    if osv_dir is not None:
        docs = osv.read_osv(spark, osv_dir)
        status = osv.doc_status(F.col("id"), F.col("withdrawn"), F.col("details"))
        jobs["nvd"] = osv_envelopes(watched("nvd", docs, status), run_id, at)
    if scores_dir is not None:
        rows = scores.typed_scores(scores.read_score_files(spark, scores_dir))
        jobs["epss"] = score_envelopes(watched("epss", rows, F.col("status")), run_id, at)
    if catalog_path is not None:
        entries = catalog.explode_catalog(catalog.read_catalog(spark, catalog_path))
        status = catalog.entry_status(F.col("cveID"), F.col("dateAdded"))
        jobs["kev"] = catalog_envelopes(watched("kev", entries, status), run_id, at)
    for source, envelopes in jobs.items():
        bronze.write_bronze(envelopes, bronze_root, source, fetched_at[:10], max_records=max_records)
        bronze.write_manifest(spark, bronze_root, source, bronze.manifest_path(bronze_root, source), fetched_at, run_id)
    if not jobs:
        return None
    stored = [{"source": s, "run_id": run_id, **counts.values(w)} for s, w in watches.items()]
    path = f"{bronze_root}/_counts/ingest/run_id={run_id}/sources={'-'.join(jobs)}"
    counts.store(spark, path, schemas.INGEST_COUNTS, stored)
    return counts.read(spark, path, schemas.INGEST_COUNTS).drop("run_id")
