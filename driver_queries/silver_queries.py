"""Column functions, validation and normalisation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from driver_queries.inputs import VECTORS, query, r6, sql6, table, text, vectors
from vulnlake.functions import checks, cvss, hashing, nested, times
from vulnlake.operators import quality
from vulnlake.plans import normalize
from vulnlake.sources import messages

# ---- dates ---------------------------------------------------------------------------------------
# One timestamp in seven spellings, by the event's number.
SPELLINGS = [
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "dd/MM/yyyy",
]
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _spelled(spark, sf):
    kind = F.col("event_id") % len(SPELLINGS)
    spelled = F.when(kind == 0, F.date_format("ts", SPELLINGS[0]))
    for i, pattern in enumerate(SPELLINGS[1:], 1):
        spelled = spelled.when(kind == i, F.date_format("ts", pattern))
    return table(spark, sf, "events").withColumn("spelled", spelled)


@query(
    "parse_ts",
    """select event_id, case event_id % 7
        when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
        when 1 then strftime(date_trunc('millisecond', ts) - interval 2 hour, '%Y-%m-%d %H:%M:%S.%f')
        when 2 then strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f')
        when 3 then strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
        when 4 then strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%f')
        when 5 then strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S.%f') end as parsed from events""",
)
def parse_ts(spark, sf):
    rows = _spelled(spark, sf)
    return rows.select("event_id", F.date_format(times.parse_ts(F.col("spelled")), MICROS).alias("parsed"))


@query(
    "parse_ts_nano",
    """select event_id, case when event_id % 5 = 4 then null
        else strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad(cast(date_part('millisecond', ts)::bigint % 1000 as varchar), 3, '0') end as parsed
    from events""",
)
def parse_ts_nano(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 4, F.date_format("ts", "yyyy/MM/dd"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("774Z")))
        .alias("spelled"),
    )
    return rows.select("event_id", times.millisecond_text(times.parse_rfc3339(F.col("spelled"))).alias("parsed"))


@query(
    "parse_date",
    """select event_id, case event_id % 3 when 0 then cast(cast(ts as date) as varchar)
        when 1 then strftime(ts, '%Y-%m-%d') end as parsed from events""",
)
def parse_date(spark, sf):
    kind = F.col("event_id") % 3
    spelled = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.concat(F.date_format("ts", "yyyy"), F.lit("-13-40")))
    )
    return table(spark, sf, "events").select("event_id", text(times.parse_date(spelled)).alias("parsed"))


# ---- hashes ----------------------------------------------------------------------------------------


@query(
    "event_hash",
    """with p as (select event_id, cast(cast(ts as date) as varchar) as day,
        sha256('{"kind":"' || event_type || '","props":"' || replace(props, '"', '\\"') || '","user":' || user_id || '}') as payload_sha256 from events)
    select event_id as record, payload_sha256, sha256('nvd|' || event_id || '|' || day || '|' || payload_sha256) as event_id from p""",
)
def event_hash(spark, sf):
    payload = F.struct(F.col("user_id").alias("user"), F.col("props"), F.col("event_type").alias("kind"))
    rows = table(spark, sf, "events").withColumn("payload", payload)
    wrapped = hashing.wrap(
        rows, source="nvd", record_id=text("event_id"), effective_date=F.col("ts").cast("date"),
        payload="payload", run_id="run", fetched_at=text("ts"),
    )
    return wrapped.select(F.col("source_record_id").cast("bigint").alias("record"), "payload_sha256", "event_id")


@query("json_parse", """select event_id, cast(json_extract_string(props, '$.k') as integer) as k,
    '{"k":' || json_extract_string(props, '$.k') || '}' as again from events""")
def json_parse(spark, sf):
    """A record through the library: parsed from the log's value, and back as canonical text."""
    schema = StructType.fromDDL("k int")
    log = table(spark, sf, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    parsed = messages.good_records(messages.parse(log, schema, ["k"]))
    return parsed.select("event_id", "record.k", hashing.canonical_json(F.col("record"), schema).alias("again"))


# ---- arrays ----------------------------------------------------------------------------------------
# The words of a document line by line: a line is a group, a word an element. Every text is whole.
LINES = "string_split(text, chr(10))"


def _words(spark, sf):
    lines = F.split("text", "\n")
    elements = F.transform(
        lines,
        lambda line: F.struct(
            F.transform(
                F.split(line, " "),
                lambda w: F.struct(F.when(F.length(w) % 2 == 0, "en").otherwise("fr").alias("lang"), w.alias("value")),
            ).alias("description")
        ),
    )
    return table(spark, sf, "documents").select("doc_id", elements.alias("groups"), lines.alias("lines"))


@query(
    "nested_distinct",
    f"""select doc_id, len(list_distinct(list_filter(flatten(list_transform({LINES}, lambda l: string_split(l, ' '))),
            lambda w: length(w) % 2 = 0))) as n,
        md5(array_to_string(list_sort(list_distinct(list_filter(flatten(list_transform({LINES}, lambda l: string_split(l, ' '))),
            lambda w: length(w) % 2 = 0))), ' ')) as words from documents""",
)
def nested_distinct(spark, sf):
    found = _words(spark, sf).select("doc_id", normalize.weakness_ids(F.col("groups")).alias("w"))
    return found.select(
        "doc_id", F.size("w").cast("bigint").alias("n"), F.md5(F.array_join(F.array_sort("w"), " ")).alias("words")
    )


@query(
    "nested_count",
    f"""select doc_id, cast(list_sum(list_transform({LINES}, lambda l: len(string_split(l, ' ')))) as integer) as n from documents""",
)
def nested_count(spark, sf):
    counted = nested.count_nested(F.col("groups"), lambda g: nested.length_of(g["description"]))
    return _words(spark, sf).select("doc_id", counted.alias("n"))


@query(
    "array_len",
    f"""select doc_id, cast(len({LINES}) as integer) as n, cast(0 as integer) as none from documents""",
)
def array_len(spark, sf):
    none = F.lit(None).cast("array<string>")
    return _words(spark, sf).select(
        "doc_id", nested.length_of(F.col("lines")).alias("n"), nested.length_of(none).alias("none")
    )


@query(
    "last_match",
    f"select doc_id, list_filter({LINES}, lambda l: length(l) % 2 = 0)[-1] as line from documents",
)
def last_match(spark, sf):
    return _words(spark, sf).select(
        "doc_id", nested.last_of(F.col("lines"), lambda line: F.length(line) % 2 == 0).alias("line")
    )


@query(
    "best_element",
    f"select doc_id, coalesce(list_filter({LINES}, lambda l: length(l) % 5 = 0)[1], {LINES}[1]) as line from documents",
)
def best_element(spark, sf):
    best = nested.best_of(F.col("lines"), lambda line: F.length(line) % 5 == 0)
    return _words(spark, sf).select("doc_id", best.alias("line"))


# ---- CVSS -----------------------------------------------------------------------------------------


@query(
    "cvss_version",
    f"""with {VECTORS} select p_partkey, case when vector like 'CVSS:%' then regexp_extract(vector, '^CVSS:([^/]*)', 1)
        when vector like 'AV:%' then '2.0' end as version from vectors""",
)
def cvss_version(spark, sf):
    return vectors(spark, sf).select("p_partkey", cvss.vector_version(F.col("vector")).alias("version"))


def _decode_sql(name: str) -> str:
    def words(metric, table_):
        value = f"regexp_extract(vector, '(?:^|/){metric}:([^/]*)', 1)"
        cases = " ".join(f"when '{k}' then '{w}'" for k, w in table_.items())
        return f"case when regexp_matches(vector, '(?:^|/){metric}:') then case upper({value}) {cases} else upper({value}) end end"

    v4 = words(*cvss.WORDS_V4[name]) if name in cvss.WORDS_V4 else "null"
    v3 = words(*cvss.WORDS_V3[name]) if name in cvss.WORDS_V3 else "null"
    return f"case when vector like 'CVSS:4%' then {v4} else {v3} end as {name}"


DECODED = [*cvss.WORDS_V3, "attack_requirements"]


@query("cvss_decode", f"with {VECTORS} select p_partkey, {', '.join(map(_decode_sql, DECODED))} from vectors")
def cvss_decode(spark, sf):
    return vectors(spark, sf).select("p_partkey", cvss.decode_vector(F.col("vector")).alias("d")).select(
        "p_partkey", *(F.col(f"d.{n}") for n in DECODED)
    )


def _weight_sql(metric: str, table_: dict) -> str:
    cases = " ".join(f"when '{k}' then {w}::double" for k, w in table_.items())
    return f"(case regexp_extract(vector, '(?:^|/){metric}:([^/]*)', 1) {cases} end)"


def _product_sql(table_: dict) -> str:
    return "(1.0::double - " + " * ".join(f"(1.0::double - {_weight_sql(m, table_)})" for m in "CIA") + ")"


SCORED = f"""{VECTORS}, w as (select p_partkey, vector,
        case when vector like 'CVSS:3.1%' then '3.1' when vector like 'CVSS:3.0%' then '3.0'
             when vector like 'CVSS:4.0%' then '4.0' when vector like 'AV:%' then '2.0' end as version,
        vector like '%/S:C/%' as changed,
        {_product_sql(cvss.V3_CIA)} as iss,
        8.22::double * {_weight_sql('AV', cvss.V3_AV)} * {_weight_sql('AC', cvss.V3_AC)} *
            (case when vector like '%/S:C/%' then {_weight_sql('PR', cvss.V3_PR_CHANGED)} else {_weight_sql('PR', cvss.V3_PR_UNCHANGED)} end) *
            {_weight_sql('UI', cvss.V3_UI)} as expl3,
        20.0::double * {_weight_sql('AV', cvss.V2_AV)} * {_weight_sql('AC', cvss.V2_AC)} * {_weight_sql('Au', cvss.V2_AU)} as expl2,
        10.41::double * {_product_sql(cvss.V2_CIA)} as impact2 from vectors),
    i as (select *, case when changed then 7.52::double * (iss - 0.029::double) - 3.25::double * power(iss - 0.02::double, 15)
            else 6.42::double * iss end as impact3 from w),
    b as (select *, least(case when changed then 1.08::double * (impact3 + expl3) else impact3 + expl3 end, 10.0::double) as total from i),
    scored as (select p_partkey, vector, version,
        case when version = '2.0' then round((0.6::double * impact2 + 0.4::double * expl2 - 1.5::double)
                * (case when impact2 = 0 then 0.0 else 1.176 end)::double + 1e-9, 1)
             when version = '4.0' then null
             when impact3 <= 0 then 0.0
             when version = '3.0' then ceil(total * 10 - 1e-9) / 10
             when cast(round(total * 100000) as bigint) % 10000 = 0 then round(total * 100000) / 100000
             else (cast(round(total * 100000) as bigint) // 10000 + 1) / 10.0::double end as base_score,
        case when version = '2.0' then round(expl2 - 1e-9, 1) when version <> '4.0' then round(expl3, 1) end as exploitability_score,
        case when version = '2.0' then round(impact2, 1) when version <> '4.0' then round(impact3, 1) end as impact_score
        from b where regexp_matches(vector, '/S?A:[A-Z]$'))"""
BAND = """case when base_score <= 0 then 'NONE' when base_score < 4 then 'LOW' when base_score < 7 then 'MEDIUM'
        when base_score < 9 then 'HIGH' when base_score is not null then 'CRITICAL' end"""


@query(
    "cvss_score",
    f"""with {SCORED} select v.p_partkey, s.version, {sql6('s.base_score')} as base_score, {BAND} as base_severity,
        {sql6('s.exploitability_score')} as exploitability_score, {sql6('s.impact_score')} as impact_score
    from vectors v left join scored s using (p_partkey)""",
)
def cvss_score(spark, sf):
    scored = vectors(spark, sf).select("p_partkey", cvss.score_vector(F.col("vector")).alias("s"))
    return scored.select(
        "p_partkey", "s.version", r6(F.col("s.base_score")).alias("base_score"), "s.base_severity",
        r6(F.col("s.exploitability_score")).alias("exploitability_score"),
        r6(F.col("s.impact_score")).alias("impact_score"),
    )


@query(
    "severity_band",
    f"with s as (select l_orderkey, l_linenumber, l_partkey, l_quantity / 5.0 as base_score from lineitem) select l_orderkey, l_linenumber, l_partkey, {BAND} as band from s",
)
def severity_band(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", cvss.severity_band(F.col("l_quantity") / 5.0).alias("band")
    )


# ---- validation -------------------------------------------------------------------------------------
ID_SQL = """case event_id % 6 when 0 then null when 1 then 'CVE-24-' || event_id when 2 then 'cve-2024-' || (10000 + event_id)
    else 'CVE-' || (2000 + user_id % 25) || '-' || (1000 + event_id) end"""


def _ids():
    kind = F.col("event_id") % 6
    number = F.col("event_id")
    return (
        F.when(kind == 0, F.lit(None))
        .when(kind == 1, F.concat(F.lit("CVE-24-"), number.cast("string")))
        .when(kind == 2, F.concat(F.lit("cve-2024-"), (number + 10000).cast("string")))
        .otherwise(
            F.concat(F.lit("CVE-"), (F.col("user_id") % 25 + 2000).cast("string"), F.lit("-"), (number + 1000).cast("string"))
        )
    )


@query("id_pattern", "select event_id, cast(event_id % 6 < 3 as integer) as bad from events")
def id_pattern(spark, sf):
    return table(spark, sf, "events").select("event_id", checks.bad_id(_ids()).cast("int").alias("bad"))


@query(
    "range_check",
    """select event_id, cast(coalesce(v < 0 or v > 100, false) as integer) as bad from
    (select event_id, case when event_id % 9 = 0 then null else value - 5 end as v from events)""",
)
def range_check(spark, sf):
    value = F.when(F.col("event_id") % 9 != 0, F.col("value") - 5)
    return table(spark, sf, "events").select("event_id", checks.out_of_range(value, 0.0, 100.0).cast("int").alias("bad"))


REASONS_SQL = f"""reasons as (select event_id, case when event_type = 'error' then 'missing_event_id'
        when event_id % 6 < 3 then 'invalid_cve_id' when value > 100 then 'invalid_cvss_score' end as reason from events)"""


def _reasons(spark, sf):
    reason = checks.first_reason([
        ("missing_event_id", F.col("event_type") == "error"),
        ("invalid_cve_id", checks.bad_id(_ids())),
        ("invalid_cvss_score", checks.out_of_range(F.col("value"), 0.0, 100.0)),
    ])
    return table(spark, sf, "events").withColumn(quality.REASON, reason)


@query("reject_reason", f"with {REASONS_SQL} select event_id, reason from reasons")
def reject_reason(spark, sf):
    return _reasons(spark, sf).select("event_id", F.col(quality.REASON).alias("reason"))


@query("reject_counts", f"with {REASONS_SQL} select reason, count(*) as n from reasons group by 1")
def reject_counts(spark, sf):
    return quality.reason_counts(_reasons(spark, sf))


@query(
    "duplicate_ids",
    "select md5(props || user_id) as event_id, count(*) as n from events group by 1 having count(*) > 1",
)
def duplicate_ids(spark, sf):
    ids = table(spark, sf, "events").select(F.md5(F.concat("props", text("user_id"))).alias("event_id"))
    return quality.duplicate_ids(ids)


# ---- normalisation ------------------------------------------------------------------------------------


def _envelope(rows, payload, record):
    """Envelope columns around `payload`, with some identities missing."""
    return rows.select(
        F.when(record % 53 != 0, F.concat(F.lit("e"), record.cast("string"))).alias("event_id"),
        F.date_format(F.lit("2024-06-01").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("fetched_at"),
        F.lit("run").alias("ingestion_run_id"),
        F.when(record % 59 != 0, F.concat(F.lit("s"), record.cast("string"))).alias("payload_sha256"),
        payload.alias("payload"),
        record.alias("record"),
    )


def _identity_sql(record: str) -> str:
    return f"""case when {record} % 53 <> 0 then 'e' || {record} end as event_id,
        case when {record} % 59 <> 0 then 's' || {record} end as payload_sha256"""


@query(
    "normalize_epss",
    f"""with p as (select {_identity_sql("event_id")}, {ID_SQL} as cve_id,
        case when event_id % 31 = 0 then null when event_id % 37 = 0 then null else cast(cast(ts as date) as varchar) end as observation_date,
        case when event_id % 41 = 0 then null when event_id % 23 = 0 then 1.2 else value / 500.0 end as epss_score,
        case when event_id % 29 = 0 then -0.5 else (event_id % 100) / 100.0 end as epss_percentile,
        'v' || event_type as epss_model_version, event_id as record from events)
    select * exclude (record), case when event_id is null then 'missing_event_id' when payload_sha256 is null then 'missing_payload_sha256'
        when record % 6 < 3 then 'invalid_cve_id'
        when epss_score > 1 or epss_percentile < 0 then 'invalid_epss_value'
        when observation_date is null then 'missing_observation_date' end as reason,
        '2024-06-01 00:00:00' as fetched_at from p""",
)
def normalize_epss(spark, sf):
    n = F.col("event_id")
    day = F.col("ts").cast("date").cast("string")
    payload = F.struct(
        _ids().alias("cve"),
        F.when(n % 41 == 0, F.lit(None)).when(n % 23 == 0, F.lit(1.2)).otherwise(F.col("value") / 500.0).alias("epss"),
        F.when(n % 29 == 0, F.lit(-0.5)).otherwise((n % 100) / 100.0).alias("percentile"),
        F.when(n % 31 == 0, F.lit("2024-13-40")).when(n % 37 == 0, F.lit(None)).otherwise(day).alias("score_date"),
        F.concat(F.lit("v"), F.col("event_type")).alias("model_version"),
    )
    source = _envelope(table(spark, sf, "events"), payload, n)
    silver = normalize.normalize_epss(source)
    return silver.select(
        "event_id", "payload_sha256", "cve_id", text("observation_date").alias("observation_date"), "epss_score",
        "epss_percentile", "epss_model_version",
        F.col(quality.REASON).alias("reason"), F.date_format("fetched_at", "yyyy-MM-dd HH:mm:ss").alias("fetched_at"),
    )


KEV_COLUMNS = {
    "vendorProject": ("vendor_project", "o_orderpriority"),
    "product": ("product", "o_orderstatus"),
}


@query(
    "normalize_kev",
    f"""with p as (select {_identity_sql("o_orderkey")},
        case when o_orderkey % 19 = 0 then 'X-' || o_orderkey else 'CVE-' || year(o_orderdate) || '-' || (10000 + o_orderkey) end as cve_id,
        o_orderpriority as vendor_project, o_orderstatus as product,
        case when o_orderkey % 11 <> 0 then cast(cast(o_orderdate as date) as varchar) end as date_added,
        cast(cast(o_orderdate as date) + 14 as varchar) as due_date, 'CWE-' || (o_orderkey % 900) as cwe,
        cast(o_totalprice as varchar) as notes from orders)
    select * exclude (notes), case when event_id is null then 'missing_event_id' when payload_sha256 is null then 'missing_payload_sha256'
        when date_added is null then 'missing_date_added' when cve_id like 'X%' then 'invalid_cve_id' end as reason from p""",
)
def normalize_kev(spark, sf):
    n = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("date")
    none = F.lit(None).cast("string")
    payload = F.struct(
        F.when(n % 19 == 0, F.concat(F.lit("X-"), text(n)))
        .otherwise(F.concat(F.lit("CVE-"), text(F.year(day)), F.lit("-"), text(n + 10000)))
        .alias("cveID"),
        F.col("o_orderpriority").alias("vendorProject"),
        F.col("o_orderstatus").alias("product"),
        none.alias("vulnerabilityName"),
        F.when(n % 22 == 0, F.lit("2024-13-40")).when(n % 11 != 0, text(day)).alias("dateAdded"),
        text(F.date_add(day, 14)).alias("dueDate"),
        none.alias("requiredAction"), none.alias("knownRansomwareCampaignUse"), none.alias("shortDescription"),
        none.alias("notes"),
        F.array(F.concat(F.lit("CWE-"), text(n % 900))).alias("cwes"),
        none.alias("catalog_version"), none.alias("catalog_date_released"),
    )
    silver = normalize.normalize_kev(_envelope(table(spark, sf, "orders"), payload, n))
    return silver.select(
        "event_id", "payload_sha256", "cve_id", "vendor_project", "product", text("date_added").alias("date_added"),
        text("due_date").alias("due_date"), F.array_join("cwes", ",").alias("cwe"), F.col(quality.REASON).alias("reason"),
    )


def _nvd_payload():
    """Metric arrays of four versions, present by the part's number; Primary comes second."""
    n, size = F.col("p_partkey"), F.col("p_size")

    def data(v, score, old):
        common = [
            F.lit(v).alias("version"), F.concat(F.lit(f"vector{v}/"), text(n)).alias("vectorString"),
            score.alias("baseScore"),
        ]
        impacts = [F.lit(x).alias(f"{x}Impact") for x in ("confidentiality", "integrity", "availability")]
        none = F.lit(None).cast("string")
        if old:
            fields = ["accessVector", "accessComplexity", "authentication"]
            return F.struct(*common, none.alias("attackVector"), *(F.lit(f"{f}{v}").alias(f) for f in fields),
                            none.alias("attackComplexity"), *impacts)
        fields = ["attackVector", "attackComplexity", "privilegesRequired", "userInteraction", "scope"]
        return F.struct(*common, F.lit(f"SEV{v}").alias("baseSeverity"), *(F.lit(f"{f}{v}").alias(f) for f in fields), *impacts)

    def item(v, type_, score, old):
        extra = [F.lit(f"SEV{v}").alias("baseSeverity")] if old else []
        return F.struct(
            F.lit("src").alias("source"), F.lit(type_).alias("type"), data(v, score, old).alias("cvssData"), *extra,
            (score / 2).alias("exploitabilityScore"), (score / 4).alias("impactScore"),
        )

    def versions(v, every, base, old=False):
        both = F.array(item(v, "Secondary", base, old), item(v, "Primary", base + 0.5, old))
        return F.when(n % every == 0, F.when(n % 4 < 2, both).otherwise(F.array(item(v, "Secondary", base, old))))

    base = F.when(n % 41 == 0, F.lit(10.25)).otherwise(size / 5.5)
    word = lambda w: F.struct(F.lit("en").alias("lang"), w.alias("value"))
    return F.struct(
        F.when(n % 17 == 0, F.lit("CVE-1-1")).otherwise(F.concat(F.lit("CVE-2020-"), text(n + 10000))).alias("id"),
        F.col("p_brand").alias("sourceIdentifier"),
        F.lit("2020-01-02T03:04:05.678").alias("published"),
        F.lit("not a time").alias("lastModified"),
        F.col("p_type").alias("vulnStatus"),
        F.array(
            word(F.lit("first")), F.struct(F.lit("fr").alias("lang"), F.lit("autre").alias("value")), word(F.col("p_name"))
        ).alias("descriptions"),
        F.struct(
            versions("4.0", 7, base + 0.25).alias("cvssMetricV40"), versions("3.1", 2, base).alias("cvssMetricV31"),
            versions("3.0", 3, base - 0.125).alias("cvssMetricV30"), versions("2.0", 5, base, True).alias("cvssMetricV2"),
        ).alias("metrics"),
        F.transform(
            F.split("p_name", " "),
            lambda w: F.struct(F.lit("s").alias("source"), F.lit("Primary").alias("type"), F.array(word(w), word(F.lit("CWE-1"))).alias("description")),
        ).alias("weaknesses"),
        F.when(n % 3 > 0, F.transform(F.sequence(F.lit(1), size % 4 + 1), lambda i: F.struct(F.concat(F.lit("u"), text(i)).alias("url"), F.lit("s").alias("source")))).alias("references"),
        F.transform(
            F.sequence(F.lit(1), size % 3 + 1),
            lambda i: F.struct(
                F.array(
                    F.struct(F.array_repeat(F.struct(F.lit(True).alias("vulnerable"), F.lit("cpe").alias("criteria")), size % 5).alias("cpeMatch"))
                ).alias("nodes")
            ),
        ).alias("configurations"),
    )


def nvd_silver(spark, sf):
    return normalize.normalize_nvd(_envelope(table(spark, sf, "part"), _nvd_payload(), F.col("p_partkey")))


NVD = f"""n as (select *, case when p_partkey % 7 = 0 then '4.0' when p_partkey % 2 = 0 then '3.1' when p_partkey % 3 = 0 then '3.0'
            when p_partkey % 5 = 0 then '2.0' end as v,
        case when p_partkey % 41 = 0 then 10.25::double else p_size / 5.5::double end as base from part),
    m as (select *, base + case v when '4.0' then 0.25 when '3.0' then -0.125 else 0.0 end + case when p_partkey % 4 < 2 then 0.5 else 0.0 end as raw from n),
    nvd as (select {_identity_sql("p_partkey")}, p_partkey,
        case when p_partkey % 17 = 0 then 'CVE-1-1' else 'CVE-2020-' || (p_partkey + 10000) end as cve_id, v as cvss_version,
        'vector' || v || '/' || p_partkey as cvss_vector, case when v is not null then raw end as score, 'SEV' || v as cvss_base_severity,
        case when v = '2.0' then 'accessVector2.0' else 'attackVector' || v end as attack_vector,
        case when v = '2.0' then 'accessComplexity2.0' else 'attackComplexity' || v end as attack_complexity,
        case when v = '2.0' then 'authentication2.0' else 'privilegesRequired' || v end as privileges_required,
        case when v <> '2.0' then 'userInteraction' || v end as user_interaction, case when v <> '2.0' then 'scope' || v end as scope,
        p_name as description_en, p_brand as source_identifier, p_type as vuln_status,
        array_to_string(list_sort(list_distinct(list_append(string_split(p_name, ' '), 'CWE-1'))), ',') as cwe_ids,
        cast(case when p_partkey % 3 > 0 then p_size % 4 + 1 else 0 end as integer) as reference_count,
        cast((p_size % 3 + 1) * (p_size % 5) as integer) as cpe_match_count, '2020-01-02 03:04:05.678' as published_at,
        cast(null as varchar) as last_modified_at from m)"""


@query(
    "normalize_nvd",
    f"""with {NVD} select * exclude (p_partkey, score), {sql6('score')} as cvss_base_score, {sql6('score / 2')} as exploitability_score,
        {sql6('score / 4')} as impact_score, case when event_id is null then 'missing_event_id'
        when payload_sha256 is null then 'missing_payload_sha256' when cve_id = 'CVE-1-1' then 'invalid_cve_id'
        when score > 10 then 'invalid_cvss_score' end as reason from nvd""",
)
def normalize_nvd(spark, sf):
    silver = nvd_silver(spark, sf)
    return silver.select(
        "event_id", "payload_sha256", "cve_id", "cvss_version", "cvss_vector", "cvss_base_severity", "attack_vector",
        "attack_complexity", "privileges_required", "user_interaction", "scope", "description_en", "source_identifier",
        "vuln_status", F.array_join(F.array_sort("cwe_ids"), ",").alias("cwe_ids"), "reference_count", "cpe_match_count",
        F.date_format("published_at", "yyyy-MM-dd HH:mm:ss.SSS").alias("published_at"),
        text("last_modified_at").alias("last_modified_at"),
        *(r6(F.col(c)).alias(c) for c in ("cvss_base_score", "exploitability_score", "impact_score")),
        F.col(quality.REASON).alias("reason"),
    )


@query(
    "version_pick",
    f"with {NVD} select p_partkey, cvss_version, {sql6('score')} as score from nvd",
)
def version_pick(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", _nvd_payload().alias("payload"))
    picked = rows.select("p_partkey", normalize.pick_metric(F.col("payload.metrics")).alias("m"))
    return picked.select("p_partkey", "m.cvss_version", r6(F.col("m.cvss_base_score")).alias("score"))


@query(
    "reject_route",
    f"""with {NVD}, r as (select case when event_id is null then 'missing_event_id'
        when payload_sha256 is null then 'missing_payload_sha256' when cve_id = 'CVE-1-1' then 'invalid_cve_id'
        when score > 10 then 'invalid_cvss_score' end as reason, cve_id from nvd)
    select reason, cve_id, count(*) as n from r where reason is not null group by all""",
)
def reject_route(spark, sf):
    """Write the rejects by reason, then read them back."""
    from vulnlake.session import new_dir

    path = new_dir(spark, "rejected")
    quality.write_rejected(nvd_silver(spark, sf), path)
    return spark.read.parquet(path).groupBy("reason", "cve_id").agg(F.count("*").alias("n"))
