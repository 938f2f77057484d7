"""Sources, envelopes, Bronze files, routing and streams, fed from the driver's tables.

Files are written to a new directory of the shared folder for every run and read back with the
library's readers.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from driver_queries.inputs import VECTORS, query, r6, sql6, table, text, vectors
from driver_queries.silver_queries import BAND, SCORED
from vulnlake.functions import hashing
from vulnlake.plans import ingest, validate
from vulnlake.session import new_dir
from vulnlake.sources import bronze, catalog, messages, osv, scores, tables
from vulnlake.streaming import silver, sink

FETCHED = "2024-06-01 00:00:00"
RUN = "run1"


def _fetched():
    return F.lit(FETCHED).cast("timestamp")


# ---- OSV documents -----------------------------------------------------------------------------------


def osv_docs(spark, sf):
    """One document per part; some withdrawn, rejected or without an id."""
    n, size = F.col("p_partkey"), F.col("p_size")
    none = F.lit(None).cast("string")
    cpe = lambda i: F.concat(F.lit("cpe:"), text(i))
    return vectors(spark, sf).select(
        F.when(n % 43 == 0, F.lit(" ")).otherwise(F.concat(F.lit("CVE-2021-"), text(n + 10000))).alias("id"),
        F.when(n % 3 != 0, F.col("p_name")).alias("summary"),
        F.when(n % 31 == 0, F.lit("  ** REJECT ** no"))
        .when(n % 29 == 0, F.lit("Rejected reason: no"))
        .when(n % 2 == 0, F.concat(F.lit(" "), F.col("p_type"), F.lit("\n")))
        .alias("details"),
        F.concat(F.lit("2021-02-03T04:05:06."), F.lpad(text(n), 9, "0"), F.lit("Z")).alias("published"),
        F.lit("2022-02-03T04:05:06Z").alias("modified"),
        F.when(n % 37 == 0, F.lit("2022-01-01T00:00:00Z")).otherwise(none).alias("withdrawn"),
        F.array(
            F.struct(F.lit("CVSS").alias("type"), F.col("vector").alias("score")),
            F.struct(F.lit("CVSS").alias("type"), F.lit("broken").alias("score")),
        ).alias("severity"),
        F.array(
            F.struct(F.lit("WEB").alias("type"), F.concat(F.lit("https://x/"), text(n)).alias("url")),
            F.struct(F.lit("WEB").alias("type"), none.alias("url")),
        ).alias("references"),
        F.array(F.struct(F.struct(F.array(cpe(size), cpe(size + 1), cpe(size)).alias("cpes")).alias("database_specific"))).alias("affected"),
        F.struct(
            F.when(n % 2 == 0, F.col("p_brand")).alias("cna_assigner"),
            F.array(F.concat(F.lit("CWE-"), text(size)), F.lit("")).alias("cwe_ids"),
            F.array(F.struct(F.array(cpe(size + 1), cpe(size + 2)).alias("cpes"))).alias("unresolved_ranges"),
        ).alias("database_specific"),
    )


OSV_STATUS = """case when p_partkey % 37 = 0 or p_partkey % 31 = 0 or p_partkey % 29 = 0 then 'skipped'
    when p_partkey % 43 = 0 then 'invalid' else 'published' end"""


@query(
    "drop_withdrawn",
    "select 'CVE-2021-' || (p_partkey + 10000) as id from part where not (p_partkey % 37 = 0 or p_partkey % 31 = 0 or p_partkey % 29 = 0) and p_partkey % 43 <> 0 union all select ' ' from part where not (p_partkey % 37 = 0 or p_partkey % 31 = 0 or p_partkey % 29 = 0) and p_partkey % 43 = 0",
)
def drop_withdrawn(spark, sf):
    return osv_docs(spark, sf).filter(~osv.is_withdrawn(F.col("withdrawn"), F.col("details"))).select("id")


@query(
    "osv_scan",
    f"""with {VECTORS} select case when p_partkey % 43 = 0 then ' ' else 'CVE-2021-' || (p_partkey + 10000) end as id,
        case when p_partkey % 3 <> 0 then p_name end as summary, vector, 'CWE-' || p_size as cwe from vectors""",
)
def osv_scan(spark, sf):
    """Write the documents as JSON lines and read them with the document schema."""
    path = new_dir(spark, "osv")
    osv_docs(spark, sf).write.json(path)
    docs = osv.read_osv(spark, path, one_per_file=False)
    return docs.select(
        "id", "summary", F.col("severity")[0]["score"].alias("vector"), F.col("database_specific.cwe_ids")[0].alias("cwe")
    )


@query(
    "osv_adapt",
    f"""with {SCORED}, p as (select v.*, s.version, s.base_score, s.exploitability_score, s.impact_score,
        trim(case when p_partkey % 2 = 0 then p_type end) as d, case when v.p_partkey % 3 <> 0 then p_name end as s_
        from vectors v left join scored s using (p_partkey) where {OSV_STATUS} = 'published')
    select 'CVE-2021-' || (p_partkey + 10000) as id, case when p_partkey % 2 = 0 then p_brand else 'osv.dev' end as assigner,
        '2021-02-03T04:05:06.' || substr(lpad(cast(p_partkey as varchar), 9, '0'), 1, 3) as published,
        case when s_ is not null and d is not null then s_ || chr(10) || chr(10) || d else coalesce(s_, d, '') end as description,
        case version when '4.0' then 'cvssMetricV40' when '3.1' then 'cvssMetricV31' when '3.0' then 'cvssMetricV30'
            when '2.0' then 'cvssMetricV2' end as metric, {sql6('base_score')} as base_score, {BAND} as severity,
        {sql6('impact_score')} as impact_score,
        'CWE-' || p_size as cwes, 'https://x/' || p_partkey as urls,
        'cpe:' || (p_size + 1) || ',cpe:' || (p_size + 2) || ',cpe:' || p_size as cpes from p""",
)
def osv_adapt(spark, sf):
    status = osv.doc_status(F.col("id"), F.col("withdrawn"), F.col("details"))
    adapted = osv.adapt(osv_docs(spark, sf).filter(status == "published")).select("payload.*")
    names = ["cvssMetricV40", "cvssMetricV31", "cvssMetricV30", "cvssMetricV2"]
    first = {m: F.get(F.col(f"metrics.{m}"), F.lit(0)) for m in names}

    def of_first(field):
        return F.coalesce(*(field(m, first[m]) for m in names))

    return adapted.select(
        "id", F.col("sourceIdentifier").alias("assigner"), "published",
        F.coalesce(F.get("descriptions", F.lit(0))["value"], F.lit("")).alias("description"),
        F.coalesce(*(F.when(first[m].isNotNull(), m) for m in names)).alias("metric"),
        r6(of_first(lambda m, x: x["cvssData"]["baseScore"])).alias("base_score"),
        of_first(lambda m, x: x["baseSeverity"] if m == "cvssMetricV2" else x["cvssData"]["baseSeverity"]).alias("severity"),
        r6(of_first(lambda m, x: x["impactScore"])).alias("impact_score"),
        F.array_join(F.transform("weaknesses", lambda w: w["description"][0]["value"]), ",").alias("cwes"),
        F.array_join(F.transform("references", lambda r: r["url"]), ",").alias("urls"),
        F.array_join(F.transform(F.col("configurations")[0]["nodes"][0]["cpeMatch"], lambda c: c["criteria"]), ",").alias("cpes"),
    )


# ---- daily score files -------------------------------------------------------------------------------


def _score_lines(spark, sf):
    """Lines of one file per day: comment, header and one line per event."""
    events = table(spark, sf, "events").select("event_id", text(F.col("ts").cast("date")).alias("day"), "value")
    n = F.col("event_id")
    data = F.concat_ws(
        ",",
        F.concat(F.lit("CVE-2024-"), text(n + 10000)),
        F.when(n % 19 == 0, F.lit("")).when(n % 23 == 0, F.lit("x")).when(n % 29 == 0, F.lit("1.5")).otherwise(
            text(F.round(F.col("value") / 500.0, 4).cast("decimal(6,4)"))
        ),
        F.when(n % 7 == 0, F.lit("")).otherwise(text(((n % 100) / 100.0).cast("decimal(4,2)"))),
    )
    head = events.select("day").distinct()
    stamp = F.concat(F.lit("#model_version:v1,score_date:"), F.col("day"), F.lit("T00:00:00+0000"))
    return (
        events.select("day", F.lit(2).alias("part"), data.alias("value"))
        .union(head.select("day", F.lit(0), stamp))
        .union(head.select("day", F.lit(1), F.lit("cve,epss,percentile")))
    )


def _score_files(spark, sf):
    path = new_dir(spark, "scores")
    (
        _score_lines(spark, sf).repartition("day").sortWithinPartitions("day", "part").drop("part")
        .write.partitionBy("day").option("compression", "gzip").text(path)
    )
    return scores.typed_scores(scores.read_score_files(spark, path, glob="*.txt.gz"))


SCORES = """s as (select event_id, 'CVE-2024-' || (event_id + 10000) as cve, cast(cast(ts as date) as varchar) as score_date,
        'v1' as model_version, case when event_id % 19 = 0 or event_id % 23 = 0 then null when event_id % 29 = 0 then 1.5
            else round(value / 500.0::double, 4) end as epss,
        case when event_id % 7 = 0 then 0.0 else (event_id % 100) / 100.0::double end as percentile,
        case when event_id % 19 = 0 or event_id % 23 = 0 or event_id % 29 = 0 then 'invalid' else 'published' end as status from events)"""


@query(
    "epss_file_parse",
    f"with {SCORES} select cve, score_date, model_version, {sql6('epss')} as epss, {sql6('percentile')} as percentile, status from s",
)
def epss_file_parse(spark, sf):
    return _score_files(spark, sf).select(
        "cve", text("score_date").alias("score_date"), "model_version", r6(F.col("epss_value")).alias("epss"),
        r6(F.col("percentile_value")).alias("percentile"), "status",
    )


@query(
    "epss_file_dates",
    """select cast(case when event_id % 2 = 0 then '2024-02-03' end as varchar) as score_date,
        case event_id % 2 when 0 then 'published' else 'invalid' end as status, count(*) as n from events group by all""",
)
def epss_file_dates(spark, sf):
    """Files that state their date, and files that have none, neither stated nor in the name: their rows are not published."""
    path = new_dir(spark, "score-dates")
    for k, comment in enumerate(["#model_version:v1,score_date:2024-02-03T00:00:00+0000", "#model_version:v1"]):
        rows = table(spark, sf, "events").where(F.col("event_id") % 2 == k).select(
            F.expr("event_id div 5000").alias("file"), F.lit(1).alias("part"),
            F.concat(F.lit("CVE-2024-"), text(F.col("event_id") + 10000), F.lit(",0.5,0.5")).alias("value"),
        )
        # every file begins with its comment line
        lines = rows.select("file", F.lit(0).alias("part"), F.lit(comment).alias("value")).distinct().unionByName(rows)
        sorted_ = lines.repartition("file").sortWithinPartitions("file", "part").select("file", "value")
        sorted_.write.option("compression", "gzip").partitionBy("file").text(f"{path}/{k}")
    found = scores.typed_scores(scores.read_score_files(spark, path, glob="*.txt.gz"))
    return found.groupBy(text("score_date").alias("score_date"), "status").agg(F.count("*").alias("n"))


# ---- catalog -----------------------------------------------------------------------------------------


def kev_catalogs(spark, sf):
    """One catalog document per order with two entries.

    An order is few bytes and its entries are much work, so orders are dealt by key: a file of few row groups does not leave them to as few tasks.
    """
    n = F.col("o_orderkey")
    none = F.lit(None).cast("string")

    def entry(i):
        return F.struct(
            F.when((n + i) % 17 != 0, F.concat(F.lit("CVE-2022-"), text(n * 2 + i + 10000))).alias("cveID"),
            F.col("o_orderpriority").alias("vendorProject"),
            F.col("o_orderstatus").alias("product"),
            none.alias("vulnerabilityName"),
            F.when((n + i) % 13 == 0, F.lit("2024-13-40")).otherwise(text(F.date_add(F.col("o_orderdate").cast("date"), i))).alias("dateAdded"),
            none.alias("dueDate"), none.alias("requiredAction"), F.lit("Unknown").alias("knownRansomwareCampaignUse"),
            none.alias("shortDescription"), none.alias("notes"),
            F.array(F.lit(f"CWE-{i}")).alias("cwes"),
        )

    return table(spark, sf, "orders").repartition("o_orderkey").select(
        F.concat(F.lit("v"), text(n % 10)).alias("catalogVersion"),
        F.lit("2024-01-01T00:00:00.000Z").alias("dateReleased"),
        F.array(entry(0), entry(1)).alias("vulnerabilities"),
    )


KEV_ENTRIES = """k as (select case when (o_orderkey + i) % 17 <> 0 then 'CVE-2022-' || (o_orderkey * 2 + i + 10000) end as cve,
        o_orderpriority as vendor, o_orderstatus as product,
        case when (o_orderkey + i) % 13 <> 0 then cast(o_orderdate as date) + cast(i as integer) end as added, 'CWE-' || i as cwe,
        'v' || (o_orderkey % 10) as version, o_orderkey, i from orders, range(2) r(i))"""
KEV_STATUS = """case when cve is null or added is null then 'invalid' when added < date '1996-01-01' or added > date '1999-12-31'
        then 'skipped' else 'published' end"""


def _entries(spark, sf):
    return catalog.explode_catalog(kev_catalogs(spark, sf))


@query(
    "catalog_explode",
    f"with {KEV_ENTRIES} select cve, vendor, version, cwe, cast(added as varchar) as added, {KEV_STATUS} as status from k",
)
def catalog_explode(spark, sf):
    path = new_dir(spark, "catalog")
    kev_catalogs(spark, sf).write.json(path)
    rows = catalog.explode_catalog(catalog.read_catalog(spark, path, one_per_file=False))
    status = catalog.entry_status(F.col("cveID"), F.col("dateAdded"), "1996-01-01", "1999-12-31")
    return rows.select(
        F.col("cveID").alias("cve"), F.col("vendorProject").alias("vendor"), F.col("catalog_version").alias("version"),
        F.col("cwes")[0].alias("cwe"), F.when(F.col("dateAdded") != "2024-13-40", F.col("dateAdded")).alias("added"),
        status.alias("status"),
    )


STATUS_COUNTS = """count(*) as fetched, count(*) filter (status = 'published') as published,
        count(*) filter (status = 'skipped') as skipped, count(*) filter (status = 'invalid') as invalid,
        count(*) filter (status = 'failed') as failed"""


@query(
    "ingest_stats",
    f"""with d as (select {OSV_STATUS} as status from part), {SCORES}, {KEV_ENTRIES}, e as (select {KEV_STATUS} as status from k)
    select 'nvd' as source, {STATUS_COUNTS} from d union all select 'epss', {STATUS_COUNTS} from s
    union all select 'kev', {STATUS_COUNTS} from e""",
)
def ingest_stats(spark, sf):
    """The counts of all three sources, as the ingest job reports them."""
    counts = [
        ingest.osv_counts(osv_docs(spark, sf)), ingest.score_counts(_score_files(spark, sf)),
        ingest.catalog_counts(_entries(spark, sf), "1996-01-01", "1999-12-31"),
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


KEV_JSON = """'{"catalog_date_released":"2024-01-01T00:00:00.000Z","catalog_version":"' || version || '","cveID":"' || cve ||
    '","cwes":["' || cwe || '"],"dateAdded":"' || added || '","dueDate":null,"knownRansomwareCampaignUse":"Unknown","notes":null,"product":"' ||
    product || '","requiredAction":null,"shortDescription":null,"vendorProject":"' || vendor || '","vulnerabilityName":null}'"""


@query(
    "ingest_envelopes",
    f"""with {KEV_ENTRIES}, e as (select cve, cast(added as varchar) as effective_date, sha256({KEV_JSON}) as payload_sha256
        from k where {KEV_STATUS} = 'published')
    select sha256('kev|' || cve || '|' || effective_date || '|' || payload_sha256) as event_id, 'kev' as source,
        cve as source_record_id, effective_date, payload_sha256, 'run1' as ingestion_run_id,
        '2024-06-01T00:00:00.000000Z' as fetched_at, effective_date || 'T00:00:00.000000Z' as source_modified_at from e""",
)
def ingest_envelopes(spark, sf):
    out = ingest.catalog_envelopes(_entries(spark, sf), RUN, _fetched(), "1996-01-01", "1999-12-31")
    return out.select(
        "event_id", "source", "source_record_id", "effective_date", "payload_sha256", "ingestion_run_id", "fetched_at",
        "source_modified_at",
    )


# ---- Bronze ------------------------------------------------------------------------------------------


def event_envelopes(spark, sf, events=None):
    """Score envelopes of the events (all, dealt by key, if none are given), some of them invalid for Silver."""
    n = F.col("event_id")
    payload = F.struct(
        F.when(n % 17 == 0, F.lit("X")).otherwise(F.concat(F.lit("CVE-2024-"), text(n + 10000))).alias("cve"),
        F.when(n % 23 == 0, F.lit(1.5)).otherwise(F.col("value") / 500.0).alias("epss"),
        ((n % 100) / 100.0).alias("percentile"),
        text(F.col("ts").cast("date")).alias("score_date"),
        F.col("event_type").alias("model_version"),
    )
    rows = (table(spark, sf, "events").repartition("event_id") if events is None else events).withColumn("payload", payload)
    return hashing.wrap(
        rows, source="epss", record_id=text(n), effective_date=F.col("ts").cast("date"), payload="payload",
        run_id=RUN, fetched_at=ingest.iso_text(_fetched()),
    )


def by_type(spark, sf, of):
    """Envelopes of the events whose type is `of`, to be written by one task: events are brought there before they are wrapped."""
    events = table(spark, sf, "events").where(F.col("event_type") == of).coalesce(1)
    return event_envelopes(spark, sf, events).withColumn("ingestion_run_id", F.lit(of))


def write_types_but(spark, sf, root, of):
    """Bronze of the events of all other types, with the type as run id. One type is written after the other, so no task sorts wrapped events by type."""
    events = table(spark, sf, "events").where(F.col("event_type") != of)
    for (name,) in events.select("event_type").distinct().collect():
        own = event_envelopes(spark, sf, events.where(F.col("event_type") == name)).withColumn("ingestion_run_id", F.lit(name))
        bronze.write_bronze(own, root, "epss", FETCHED[:10])


def _bronze(spark, sf, name):
    root = new_dir(spark, name)
    bronze.write_bronze(event_envelopes(spark, sf), root, "epss", FETCHED[:10])
    return root


BRONZE_ROWS = """bronze_rows as (select event_id as record, case when event_id % 17 = 0 then 'X' else 'CVE-2024-' || (event_id + 10000) end as cve,
        case when event_id % 23 = 0 then 1.5 else value / 500.0::double end as epss, (event_id % 100) / 100.0::double as percentile,
        cast(cast(ts as date) as varchar) as day, event_type as model_version from events)"""


@query(
    "bronze_scan",
    f"""with {BRONZE_ROWS} select record, 'epss' as source, cve, {sql6('epss')} as epss, day, 'run1' as run_id,
        '2024-06-01' as ingest_date from bronze_rows""",
)
def bronze_scan(spark, sf):
    rows = bronze.read_bronze(spark, _bronze(spark, sf, "bronze-scan"), "epss")
    return rows.select(
        F.col("source_record_id").cast("bigint").alias("record"), "source", F.col("payload.cve").alias("cve"),
        r6(F.col("payload.epss")).alias("epss"), F.col("payload.score_date").alias("day"), "run_id",
        text("ingest_date").alias("ingest_date"),
    )


def _with_manifest(spark, sf, name):
    root = _bronze(spark, sf, name)
    bronze.write_manifest(spark, root, "epss", f"{root}/_manifests/source=epss", FETCHED)
    return root, bronze.read_manifest(spark, f"{root}/_manifests/source=epss")


@query(
    "bronze_manifest",
    "select 'epss' as source, count(*) as records, cast(64 as integer) as hash_length, cast(1 as integer) as distinct_paths from events",
)
def bronze_manifest(spark, sf):
    _, manifest = _with_manifest(spark, sf, "bronze-manifest")
    return manifest.groupBy("source").agg(
        F.sum("record_count").alias("records"), F.min(F.length("sha256")).alias("hash_length"),
        (F.count_distinct("path") == F.count("*")).cast("int").alias("distinct_paths"),
    )


@query(
    "bronze_validate",
    """select count(*) as records_total, cast(0 as bigint) as missing_manifest, cast(0 as bigint) as sha256_mismatch,
        cast(0 as bigint) as record_count_mismatch, cast(0 as bigint) as parse_errors, cast(0 as bigint) as duplicate_event_ids, cast(1 as integer) as passed from events""",
)
def bronze_validate(spark, sf):
    root, _ = _with_manifest(spark, sf, "bronze-validate")
    summary = validate.validate_bronze(spark, root, f"{root}/_manifests", ("epss",))
    return summary.drop("files_checked").withColumn("passed", F.col("passed").cast("int"))


@query(
    "bronze_defects",
    """select count(*) filter (event_type <> 'view') as records_total, cast(1 as bigint) as missing_manifest,
        cast(1 as bigint) as sha256_mismatch, cast(1 as bigint) as record_count_mismatch, cast(0 as bigint) as parse_errors,
        cast(0 as bigint) as duplicate_event_ids, cast(0 as integer) as passed from events""",
)
def bronze_defects(spark, sf):
    """Files per event type; the manifest of one, which has all records of its type, is missing, and two have another hash or count there."""
    root = new_dir(spark, "bronze-defects")
    bronze.write_bronze(by_type(spark, sf, "view"), root, "epss", FETCHED[:10], max_records=0)
    write_types_but(spark, sf, root, "view")
    bronze.write_manifest(spark, root, "epss", f"{root}/_true/source=epss", FETCHED)
    said = bronze.read_manifest(spark, f"{root}/_true/source=epss")
    run = F.regexp_extract("path", "run_id=([^/]+)", 1)
    first = F.col("path") == F.min("path").over(Window.partitionBy(run))
    altered = said.withColumns({"run": run, "first": first}).where("run <> 'view'").withColumns({
        "sha256": F.when(F.expr("first and run = 'click'"), F.sha2("sha256", 256)).otherwise(F.col("sha256")),
        "record_count": F.when(F.expr("first and run = 'purchase'"), F.col("record_count") + 1).otherwise(F.col("record_count")),
    }).drop("run", "first")
    altered.write.parquet(f"{root}/_manifests/source=epss")
    summary = validate.validate_bronze(spark, root, f"{root}/_manifests", ("epss",))
    return summary.drop("files_checked").withColumn("passed", F.col("passed").cast("int"))


# ---- message log ---------------------------------------------------------------------------------------
TOPICS = {"nvd": "view", "epss": "click", "kev": "purchase"}


def _messages(spark, sf):
    """The events as messages; some values broken, some empty objects."""
    n = F.col("event_id")
    value = F.when(n % 13 == 0, F.substring("props", 1, 4)).when(n % 17 == 0, F.lit("{}")).otherwise(F.col("props"))
    return table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), (n % 3).cast("int").alias("partition"), n.alias("offset"),
        value.cast("binary").alias("value"), F.col("ts"),
    )


@query(
    "topic_route",
    """select event_id as "offset", event_type as topic, case event_type when 'view' then 'nvd' when 'click' then 'epss'
        else 'kev' end as source from events where event_type in ('view', 'click', 'purchase')""",
)
def topic_route(spark, sf):
    return messages.route(_messages(spark, sf), TOPICS).select("offset", "topic", "source")


@query(
    "dead_letter",
    """select event_type as original_topic, cast(event_id % 3 as integer) as original_partition, event_id as original_offset,
        strftime(ts, '%Y-%m-%d %H:%M:%S') as failed_at,
        case when event_id % 13 = 0 then 'MalformedRecord' else 'MissingField' end as error_type,
        case when event_id % 13 = 0 then 'not a JSON record' else 'missing: k' end as error_message,
        to_base64(encode(case when event_id % 13 = 0 then substr(props, 1, 4) else '{}' end)) as raw_value_base64
    from events where event_id % 13 = 0 or event_id % 17 = 0""",
)
def dead_letter(spark, sf):
    from pyspark.sql.types import StructType

    parsed = messages.parse(_messages(spark, sf), StructType.fromDDL("k int"), ["k"])
    return messages.dead_letters(parsed, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


# ---- streams -------------------------------------------------------------------------------------------


def _run_streams(spark, sf, name):
    """Bronze of the three sources, then the streams to Silver."""
    root = new_dir(spark, name)
    bronze_root, silver_root = f"{root}/bronze", f"{root}/silver"
    bronze.write_bronze(event_envelopes(spark, sf), bronze_root, "epss", FETCHED[:10])
    kev = ingest.catalog_envelopes(_entries(spark, sf), RUN, _fetched())
    bronze.write_bronze(kev, bronze_root, "kev", FETCHED[:10])
    bronze.write_bronze(ingest.osv_envelopes(osv_docs(spark, sf), RUN, _fetched()), bronze_root, "nvd", FETCHED[:10])
    silver.run_silver(spark, bronze_root, silver_root, f"{root}/checkpoints")
    return silver_root


@query(
    "silver_stream",
    f"""with {SCORED}, {BRONZE_ROWS}, {KEV_ENTRIES}, n as (select v.p_partkey, s.base_score from vectors v left join scored s
        using (p_partkey) where {OSV_STATUS} = 'published')
    select 'nvd' as source, 'CVE-2021-' || (p_partkey + 10000) as cve_id, '2021-02-03' as day, {sql6('base_score')} as score from n
    union all select 'epss' as source, cve as cve_id, day, {sql6('epss')} as score from bronze_rows where cve <> 'X' and epss <= 1
    union all select 'kev', cve, cast(added as varchar), null from k where cve is not null and added is not null""",
)
def silver_stream(spark, sf):
    root = _run_streams(spark, sf, "silver")
    epss = tables.read_silver(spark, root, "epss").select(
        F.lit("epss").alias("source"), "cve_id", text("observation_date").alias("day"), r6(F.col("epss_score")).alias("score")
    )
    kev = tables.read_silver(spark, root, "kev").select(
        F.lit("kev").alias("source"), "cve_id", text("date_added").alias("day"), F.lit(None).cast("double").alias("score")
    )
    nvd = tables.read_silver(spark, root, "nvd").select(
        F.lit("nvd").alias("source"), "cve_id", text(F.to_date("published_at")).alias("day"), r6(F.col("cvss_base_score")).alias("score")
    )
    return epss.union(kev).union(nvd)


@query(
    "message_sink",
    """select cast(event_id as varchar) as record, case event_type when 'view' then 'nvd' when 'click' then 'epss' else 'kev' end as source,
        case when event_id % 11 = 0 then 'MalformedRecord' when event_id % 13 = 0 then 'MissingField'
            when event_id % 17 = 0 then 'InvalidField' else 'good' end as outcome
    from events where event_type in ('view', 'click', 'purchase')""",
)
def message_sink(spark, sf):
    """The events as a message log, streamed to Bronze files and dead letters."""
    root = _run_sink(spark, sf)
    letters = spark.read.json(sink.dead_letter_path(f"{root}/bronze")).select(
        text("original_offset").alias("record"),
        messages.source_of(F.col("original_topic"), TOPICS).alias("source"),
        F.col("error_type").alias("outcome"),
    )
    for source in TOPICS:
        rows = bronze.read_bronze(spark, f"{root}/bronze", source)
        letters = letters.union(rows.select(F.col("source_record_id"), "source", F.lit("good")))
    return letters


@query(
    "sink_totals",
    """select case event_type when 'view' then 'nvd' when 'click' then 'epss' else 'kev' end as source, count(*) as consumed,
        count(*) filter (event_id % 11 <> 0 and event_id % 13 <> 0 and event_id % 17 <> 0) as written,
        count(*) filter (event_id % 11 = 0 or event_id % 13 = 0 or event_id % 17 = 0) as dead_letters, true as sound
    from events where event_type in ('view', 'click', 'purchase') group by 1""",
)
def sink_totals(spark, sf):
    """What the sink has read, written and refused, and whether its files are as their manifests say."""
    root = f"{_run_sink(spark, sf)}/bronze"
    sound = validate.validate_bronze(spark, root, f"{root}/_manifests", tuple(TOPICS)).select("passed").scalar()
    return sink.totals(spark, root, TOPICS).withColumn("sound", sound)


def _run_sink(spark, sf):
    n = F.col("event_id")
    topic = F.col("event_type")
    record = F.to_json(
        F.struct(
            F.when(n % 13 != 0, F.concat(F.lit("e"), text(n))).alias("event_id"),
            messages.source_of(topic, TOPICS).alias("source"),
            text(n).alias("source_record_id"),
            F.lit("source.raw_record").alias("event_type"),
            F.when(n % 17 == 0, F.lit("2024-13-40")).otherwise(text(F.col("ts").cast("date"))).alias("effective_date"),
            F.lit("2024-06-01T00:00:00Z").alias("fetched_at"),
            F.lit(RUN).alias("ingestion_run_id"),
            F.sha2("props", 256).alias("payload_sha256"),
            F.struct(F.col("value")).alias("payload"),
        )
    )
    root = new_dir(spark, "sink")
    log = table(spark, sf, "events").select(
        topic.alias("topic"), (n % 3).cast("int").alias("partition"), n.alias("offset"),
        F.when(n % 11 == 0, F.lit("{")).otherwise(record).alias("value"),
    )
    log.write.parquet(f"{root}/log")
    stream = spark.readStream.schema(log.schema).parquet(f"{root}/log")
    sink.start_bronze_sink(stream, TOPICS, f"{root}/bronze", f"{root}/checkpoint", FETCHED[:10]).awaitTermination()
    return root


@query(
    "silver_rejects",
    f"""with {BRONZE_ROWS} select reason, count(*) as n from (select case when cve = 'X' then 'invalid_cve_id'
        when epss > 1 then 'invalid_epss_value' end as reason from bronze_rows) where reason is not null group by 1""",
)
def silver_rejects(spark, sf):
    root = _run_streams(spark, sf, "rejects")
    rejects = spark.read.parquet(silver.rejected_path(root, "epss"))
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query("stream_dedup", "select event_id as record from events")
def stream_dedup(spark, sf):
    """Every event arrives twice; the stream keeps one of each."""
    root = _bronze(spark, sf, "dedup")
    bronze.write_bronze(event_envelopes(spark, sf), root, "epss", FETCHED[:10])
    stream = silver.dedup(bronze.read_bronze(spark, root, "epss", stream=True), "1 hour")
    out = f"{root}/out"
    (
        stream.select(F.col("source_record_id").cast("bigint").alias("record"))
        .writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start(out).awaitTermination()
    )
    return spark.read.parquet(out)
