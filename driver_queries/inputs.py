"""The driver's tables in the roles of the vulnerability sources, for Spark and as SQL text.

lineitem   daily series per supplier (long), and the outcome catalog
events     daily series per user (dense), the message log
supplier   the dimension
documents, labels   labelled ranking
part       CVSS vectors and source documents, spelled from its columns
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.operators import latest
from vulnlake.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with its SQL equivalent where there is one."""

    def register(run):
        def with_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        with_defaults.__doc__ = run.__doc__
        QUERIES[name] = with_defaults
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Means of short decimals often end in an exact 5 at the seventh place; the shift settles those ties
# alike in both engines, whose sums differ in the last bit.
TIE_SHIFT = 1e-9


def r6(value: Column) -> Column:
    """Six places, without a negative zero."""
    return F.round(value + F.lit(TIE_SHIFT), 6) + F.lit(0.0)


def sql6(value: str) -> str:
    """The same in SQL."""
    return f"round(({value}) + {TIE_SHIFT}, 6) + 0.0"


def text(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


# ---- long daily series -------------------------------------------------------------------------
LINE_TIES = ["l_linenumber", "l_partkey", "l_extendedprice"]


def line_rows(spark, sf) -> DataFrame:
    """Every fetch of the long series: several rows per (id, day)."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("id"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_discount").alias("score"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_returnflag").alias("flag"),
        "l_orderkey",
        *LINE_TIES,
    )


def line_daily(spark, sf) -> DataFrame:
    return latest.latest(line_rows(spark, sf), ["id", "day"], "l_orderkey", LINE_TIES)


LINE_DAILY = """line_daily as (
    select l_suppkey as id, cast(l_shipdate as date) as day, l_discount as score,
           l_quantity as quantity, l_returnflag as flag, l_orderkey, l_linenumber
    from lineitem
    qualify row_number() over (partition by l_suppkey, cast(l_shipdate as date)
        order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_extendedprice desc) = 1)"""

# ---- dense daily series ------------------------------------------------------------------------


def event_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        F.col("ts").cast("date").alias("day"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("score"),
        F.col("ts"),
        "event_id",
        "event_type",
    )


def event_daily(spark, sf) -> DataFrame:
    return latest.latest(event_rows(spark, sf), ["id", "day"], "ts", ["event_id"])


EVENT_DAILY = """event_daily as (
    select user_id as id, cast(ts as date) as day, least(value / 500.0, cast(1.0 as double)) as score,
           ts, event_id, event_type
    from events
    qualify row_number() over (partition by user_id, cast(ts as date) order by ts desc, event_id desc) = 1)"""

# ---- dimension and outcomes --------------------------------------------------------------------


def dimension(spark, sf) -> DataFrame:
    """One row per supplier: publication date, base score and two categoricals."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.date_add(F.lit("1995-01-01").cast("date"), (F.col("s_suppkey") % 400).cast("int")).alias("published"),
        F.when(F.col("s_suppkey") % 7 != 0, F.round(F.abs("s_acctbal") / 1000.0, 1)).alias("base_score"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nation"),
    )


DIMENSION = """dimension as (
    select s_suppkey as id, date '1995-01-01' + cast(s_suppkey % 400 as integer) as published,
           case when s_suppkey % 7 <> 0 then round(abs(s_acctbal) / 1000.0, 1) end as base_score,
           'N' || cast(s_nationkey as varchar) as nation
    from supplier)"""


def outcome_rows(spark, sf) -> DataFrame:
    return (
        line_rows(spark, sf)
        .filter("flag = 'R' and quantity >= 49 and score >= 0.09")
        .select("id", F.col("day").alias("added"), "l_orderkey", *LINE_TIES)
    )


def outcomes(spark, sf) -> DataFrame:
    return latest.earliest_date(outcome_rows(spark, sf), "id", "added")


OUTCOMES = """outcomes as (
    select l_suppkey as id, min(cast(l_shipdate as date)) as added from lineitem
    where l_returnflag = 'R' and l_quantity >= 49 and l_discount >= 0.09 group by 1)"""

# ---- labelled ranking --------------------------------------------------------------------------


def ranked(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("n_chars").cast("double").alias("score"))
    return docs.join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", F.col("source").alias("day"), "score", F.col("toxic").alias("label"), "quality"
    )


RANKED = """ranked as (
    select d.doc_id, d.source as day, cast(d.n_chars as double) as score, l.toxic as label, l.quality
    from documents d join labels l on d.doc_id = l.doc_id)"""

# ---- CVSS vectors spelled from part --------------------------------------------------------------
# A metric's value is one letter of a word, picked by the row's numbers.
V3_PICKS = [("AV", "NALP", 1), ("AC", "LH", 2), ("PR", "NLH", 3), ("UI", "NR", 5), ("S", "UC", 7),
            ("C", "HLN", 11), ("I", "HLN", 13), ("A", "HLN", 17)]
V2_PICKS = [("AV", "LAN", 1), ("AC", "HML", 2), ("Au", "MSN", 3), ("C", "NPC", 5), ("I", "NPC", 7), ("A", "NPC", 11)]
V4_PICKS = [("AV", "NALP", 1), ("AC", "LH", 2), ("AT", "NP", 3), ("PR", "NLH", 5), ("UI", "NPA", 7),
            ("VC", "HLN", 11), ("VI", "HLN", 13), ("VA", "HLN", 17), ("SC", "HLN", 19), ("SI", "HLN", 23), ("SA", "HLN", 29)]


def _picks_sql(prefix: str, picks) -> str:
    parts = [
        f"'{m}:' || substr('{letters}', cast((p_partkey // {div} + p_size) % {len(letters)} as integer) + 1, 1)"
        for m, letters, div in picks
    ]
    return f"'{prefix}' || " + " || '/' || ".join(parts)


def _picks(prefix: str, picks) -> Column:
    parts = [
        F.concat(
            F.lit(f"{m}:"),
            F.substr(
                F.lit(letters),
                ((F.floor(F.col("p_partkey") / div) + F.col("p_size")) % len(letters)).cast("int") + 1,
                F.lit(1),
            ),
        )
        for m, letters, div in picks
    ]
    return F.concat(F.lit(prefix), F.concat_ws("/", *parts))


def vectors(spark, sf) -> DataFrame:
    """Every part with a v3.1, v3.0, v2, v4.0 or broken vector by its key.

    A part is few bytes and much work, so parts are dealt by key: a small file does not leave them to one task, and a vector is spelled once.
    """
    kind = F.col("p_partkey") % 10
    return table(spark, sf, "part").withColumn(
        "vector",
        F.when(kind < 4, _picks("CVSS:3.1/", V3_PICKS))
        .when(kind < 6, _picks("CVSS:3.0/", V3_PICKS))
        .when(kind < 8, _picks("", V2_PICKS))
        .when(kind < 9, _picks("CVSS:4.0/", V4_PICKS))
        .otherwise(F.concat(F.lit("CVSS:3.1/AV:"), F.col("p_name"))),
    ).repartition("p_partkey")


VECTORS = f"""vectors as (
    select *, case when p_partkey % 10 < 4 then {_picks_sql('CVSS:3.1/', V3_PICKS)}
        when p_partkey % 10 < 6 then {_picks_sql('CVSS:3.0/', V3_PICKS)}
        when p_partkey % 10 < 8 then {_picks_sql('', V2_PICKS)}
        when p_partkey % 10 < 9 then {_picks_sql('CVSS:4.0/', V4_PICKS)}
        else 'CVSS:3.1/AV:' || p_name end as vector
    from part)"""
