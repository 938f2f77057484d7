"""Selection of records, cohort filters, trailing windows, labels and the observation dataset."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries.inputs import (
    DIMENSION,
    EVENT_DAILY,
    LINE_DAILY,
    LINE_TIES,
    OUTCOMES,
    dimension,
    event_daily,
    line_daily,
    line_rows,
    outcome_rows,
    outcomes,
    query,
    r6,
    sql6,
    table,
    text,
)
from vulnlake.operators import cohort, labels, latest, series
from vulnlake.plans import gold as gold_plan
from vulnlake.session import new_dir
from vulnlake.sources import tables

# ---- one record per key --------------------------------------------------------------------------


@query(
    "latest_per_key",
    """select user_id, event_id, event_type, value from events
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def latest_per_key(spark, sf):
    events = table(spark, sf, "events")
    return latest.latest(events, ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "event_type", "value")


@query(
    "latest_per_key_date",
    f"with {LINE_DAILY} select id, cast(day as varchar) as day, score, l_orderkey, l_linenumber from line_daily",
)
def latest_per_key_date(spark, sf):
    return line_daily(spark, sf).select("id", text("day").alias("day"), "score", "l_orderkey", "l_linenumber")


@query(
    "earliest_per_key",
    """select l_suppkey as id, cast(cast(l_shipdate as date) as varchar) as added, l_orderkey, l_linenumber
    from lineitem where l_returnflag = 'R' and l_quantity >= 49 and l_discount >= 0.09
    qualify row_number() over (partition by l_suppkey order by cast(l_shipdate as date), l_orderkey,
        l_linenumber, l_partkey, l_extendedprice) = 1""",
)
def earliest_per_key(spark, sf):
    rows = latest.earliest(outcome_rows(spark, sf), ["id"], "added", ["l_orderkey", *LINE_TIES])
    return rows.select("id", text("added").alias("added"), "l_orderkey", "l_linenumber")


# ---- cohort --------------------------------------------------------------------------------------


@query(
    "spine",
    "select distinct l_suppkey as id, cast(cast(l_shipdate as date) as varchar) as day from lineitem",
)
def spine(spark, sf):
    return cohort.spine(line_rows(spark, sf), "id", "day").select("id", text("day").alias("day"))


SPINE = "spine as (select distinct l_suppkey as id, cast(l_shipdate as date) as day from lineitem)"


def _spine(spark, sf):
    return cohort.spine(line_rows(spark, sf), "id", "day")


def _published(spark, sf):
    return cohort.with_record(_spine(spark, sf), dimension(spark, sf), "id", ["published"])


@query(
    "spine_inner",
    f"""with {SPINE}, {DIMENSION} select s.id, cast(s.day as varchar) as day, cast(d.published as varchar) as published
    from spine s join dimension d on s.id = d.id""",
)
def spine_inner(spark, sf):
    return _published(spark, sf).select("id", text("day").alias("day"), text("published").alias("published"))


@query(
    "cohort_published",
    f"""with {SPINE}, {DIMENSION} select s.id, cast(s.day as varchar) as day
    from spine s join dimension d on s.id = d.id where d.published <= s.day""",
)
def cohort_published(spark, sf):
    rows = cohort.published_by(_published(spark, sf), "published", "day")
    return rows.select("id", text("day").alias("day"))


@query(
    "known_anti",
    f"""with {SPINE}, {OUTCOMES} select s.id, cast(s.day as varchar) as day from spine s
    where not exists (select 1 from outcomes o where o.id = s.id and o.added <= s.day)""",
)
def known_anti(spark, sf):
    rows = cohort.not_known_yet(_spine(spark, sf), outcomes(spark, sf), "id", "day", "added")
    return rows.select("id", text("day").alias("day"))


@query(
    "right_censor",
    f"""with {SPINE} select id, cast(day as varchar) as day from spine
    where day <= (select max(cast(l_shipdate as date)) - 90 from lineitem)""",
)
def right_censor(spark, sf):
    as_of = line_rows(spark, sf).agg(F.max("day")).scalar()
    return cohort.right_censor(_spine(spark, sf), "day", as_of, 90).select("id", text("day").alias("day"))


@query(
    "exclude_known",
    f"""with {LINE_DAILY}, {OUTCOMES}
    select l.id, cast(l.day as varchar) as day, cast(o.added - l.day as integer) as days_until
    from line_daily l left join outcomes o on l.id = o.id where o.added is null or o.added > l.day""",
)
def exclude_known(spark, sf):
    joined = line_daily(spark, sf).join(outcomes(spark, sf), "id", "left")
    rows = cohort.exclude_known(joined.withColumn("days_until", F.datediff("added", "day")), "days_until")
    return rows.select("id", text("day").alias("day"), "days_until")


@query(
    "as_of_date",
    """select cast(coalesce(max(cast(l_shipdate as date)) filter (l_returnflag = 'R' and l_quantity >= 49
        and l_discount >= 0.09), max(cast(l_shipdate as date))) as varchar) as label_as_of_date from lineitem""",
)
def as_of_date(spark, sf):
    found = cohort.as_of_date(
        outcome_rows(spark, sf).withColumn("fetched", F.col("added").cast("timestamp")),
        line_rows(spark, sf).withColumn("fetched", F.col("day").cast("timestamp")),
        "fetched",
    )
    return found.select(text("label_as_of_date").alias("label_as_of_date"))


@query(
    "sampled_dates",
    """select l_suppkey as id, cast(cast(l_shipdate as date) as varchar) as day, count(*) as n from lineitem
    where cast(l_shipdate as date) between date '1996-01-01' and date '1998-12-31'
      and day(l_shipdate) in (1, 15) group by 1, 2""",
)
def sampled_dates(spark, sf):
    rows = cohort.sampled_days(
        line_rows(spark, sf), "day", start="1996-01-01", end="1998-12-31",
        days_of_month=cohort.parse_days_of_month("1,15"),
    )
    return rows.groupBy("id", text("day").alias("day")).agg(F.count("*").alias("n"))


# ---- trailing windows ----------------------------------------------------------------------------


def _event_features(spark, sf):
    return series.trailing_features(
        event_daily(spark, sf), "id", "day", "score", prefix="s", lags=(1, 3, 7), windows=(3, 10),
        thresholds=(0.01, 0.05),
    )


def _pick(df, *patterns):
    names = [c for c in df.columns if any(p in c for p in patterns)]
    return df.select("id", text("day").alias("day"), *((r6(F.col(c)) if dict(df.dtypes)[c] == "double" else F.col(c)).alias(c) for c in names))


def _events_sql(select: str) -> str:
    return f"""with {EVENT_DAILY}, e as (select id, day, score, cast(day - date '1970-01-01' as integer) as dn from event_daily)
    select id, cast(day as varchar) as day, {select} from e
    window w3 as (partition by id order by dn range between 2 preceding and current row),
           w10 as (partition by id order by dn range between 9 preceding and current row),
           l1 as (partition by id order by dn range between 1 preceding and 1 preceding),
           l3 as (partition by id order by dn range between 3 preceding and 3 preceding),
           l7 as (partition by id order by dn range between 7 preceding and 7 preceding)"""


LAGS = ", ".join(f"{sql6(f'max(score) over l{n}')} as s_lag_{n}d" for n in (1, 3, 7))
ROLLING = ", ".join(
    f"{sql6(f'{fn}(score) over w{w}')} as s_{name}_{w}d"
    for w in (3, 10)
    for fn, name in (("avg", "mean"), ("max", "max"), ("min", "min"), ("stddev_samp", "stddev"))
)
COUNTS = """count(*) over w10 as s_days_observed_10d,
    cast(sum(case when score > 0.01 then 1 else 0 end) over w10 as bigint) as s_days_above_0_01_10d,
    cast(sum(case when score > 0.05 then 1 else 0 end) over w10 as bigint) as s_days_above_0_05_10d"""
DELTAS = ", ".join(f"{sql6(f'score - max(score) over l{n}')} as s_delta_{n}d" for n in (1, 3, 7))
SLOPES = ", ".join(
    f"{sql6(f'case when count(*) over w{w} < 2 then 0.0 else regr_slope(score, dn) over w{w} end')} as s_slope_{w}d"
    for w in (3, 10)
)


@query("lag_exact", _events_sql(sql6("score") + " as s_current, " + LAGS))
def lag_exact(spark, sf):
    return _pick(_event_features(spark, sf), "current", "_lag_")


@query("rolling_stats", _events_sql(ROLLING))
def rolling_stats(spark, sf):
    return _pick(_event_features(spark, sf), "_mean_", "_max_", "_min_", "_stddev_")


@query("rolling_counts", _events_sql(COUNTS))
def rolling_counts(spark, sf):
    return _pick(_event_features(spark, sf), "_days_")


@query("deltas", _events_sql(DELTAS))
def deltas(spark, sf):
    return _pick(_event_features(spark, sf), "_delta_")


@query("ols_slope", _events_sql(SLOPES))
def ols_slope(spark, sf):
    return _pick(_event_features(spark, sf), "_slope_")


@query("series_features", _events_sql(", ".join([sql6("score") + " as s_current", LAGS, ROLLING, COUNTS, DELTAS, SLOPES])))
def series_features(spark, sf):
    return _pick(_event_features(spark, sf), "s_")


@query(
    "series_features_spine",
    f"""with {EVENT_DAILY}, marks as (select distinct id, cast(day + 2 as date) as day from event_daily)
    select m.id, cast(m.day as varchar) as day,
        {sql6("max(e.score) filter (e.day = m.day)")} as s_current,
        {sql6("max(e.score) filter (e.day = m.day - 1)")} as s_lag_1d,
        {sql6("avg(e.score) filter (e.day > m.day - 3)")} as s_mean_3d,
        {sql6("avg(e.score)")} as s_mean_10d,
        count(e.day) as s_days_observed_10d,
        {sql6("""case when count(e.day) < 2 then 0.0
             else regr_slope(e.score, cast(e.day - date '2020-01-01' as integer)) end""")} as s_slope_10d
    from marks m left join event_daily e on e.id = m.id and e.day between m.day - 9 and m.day group by 1, m.day""",
)
def series_features_spine(spark, sf):
    """Features for days that need not be in the series."""
    daily = event_daily(spark, sf)
    marks = daily.select("id", F.date_add("day", 2).alias("day"))
    df = series.trailing_features(
        daily, "id", "day", "score", prefix="s", lags=(1,), windows=(3, 10), thresholds=(), spine=marks
    )
    return _pick(df, "s_current", "s_lag_1d", "s_mean", "s_days_observed", "s_slope_10d")


@query(
    "range_join",
    f"""with {LINE_DAILY}, s as (select distinct id, cast(day + 1 as date) as day from line_daily)
    select s.id, cast(s.day as varchar) as day, count(d.id) as n, cast(min(s.day - d.day) as integer) as nearest,
        round(max(d.score), 6) as top_score
    from s left join line_daily d on d.id = s.id and d.day <= s.day and d.day >= s.day - 30 group by 1, s.day""",
)
def range_join(spark, sf):
    daily = line_daily(spark, sf)
    marks = daily.select("id", F.date_add("day", 1).alias("day"))
    joined = series.range_join(marks, daily, "id", "day", 30, ["score"])
    return joined.groupBy("id", text("day").alias("day")).agg(
        F.count("days_back").alias("n"),
        F.min("days_back").cast("int").alias("nearest"),
        F.round(F.max("score"), 6).alias("top_score"),
    )


@query(
    "dim_features",
    f"""with {LINE_DAILY}, {DIMENSION} select l.id, cast(l.day as varchar) as day, d.base_score, d.nation,
        cast(d.base_score is not null as integer) as has_score
    from line_daily l left join dimension d on l.id = d.id""",
)
def dim_features(spark, sf):
    columns = ["base_score", "nation", F.col("base_score").isNotNull().cast("int").alias("has_score")]
    rows = series.dimension_features(line_daily(spark, sf), dimension(spark, sf), "id", columns)
    return rows.select("id", text("day").alias("day"), "base_score", "nation", "has_score")


@query(
    "age_days",
    f"""with {LINE_DAILY}, {DIMENSION} select l.id, cast(l.day as varchar) as day,
        cast(l.day - d.published as integer) as age, cast(year(l.day) as integer) as y,
        cast(month(l.day) as integer) as m, cast(l.day - date '1970-01-01' as integer) as day_number
    from line_daily l join dimension d on l.id = d.id""",
)
def age_days(spark, sf):
    from vulnlake.functions.times import age_days as age
    from vulnlake.functions.times import day_number

    rows = line_daily(spark, sf).join(dimension(spark, sf), "id")
    return rows.select(
        "id", text("day").alias("day"), age(F.col("day"), F.col("published")).alias("age"),
        F.year("day").alias("y"), F.month("day").alias("m"), day_number(F.col("day")).alias("day_number"),
    )


WITHIN = ", ".join(
    f"""cast(case when o.added is null then 0 when o.added <= l.day then null
        when o.added - l.day <= {h} then 1 else 0 end as integer) as kev_within_{h}_days"""
    for h in (7, 30, 90)
)


@query(
    "labels",
    f"""with {LINE_DAILY}, {OUTCOMES} select l.id, cast(l.day as varchar) as day,
        cast(o.added as varchar) as kev_date_added, cast(o.added - l.day as integer) as days_until_kev,
        cast(o.added is not null as integer) as ever_in_kev, {WITHIN},
        cast((select max(cast(l_shipdate as date)) from lineitem) as varchar) as label_as_of_date
    from line_daily l left join outcomes o on l.id = o.id""",
)
def label_rows(spark, sf):
    as_of = line_rows(spark, sf).agg(F.max("day")).scalar()
    df = labels.add_labels(line_daily(spark, sf), outcomes(spark, sf), "id", "day", "added", as_of)
    return df.select(
        "id", text("day").alias("day"), text("kev_date_added").alias("kev_date_added"), "days_until_kev",
        "ever_in_kev", *(f"kev_within_{h}_days" for h in (7, 30, 90)),
        text("label_as_of_date").alias("label_as_of_date"),
    )


# ---- the observation dataset -----------------------------------------------------------------------


GOLD_OPTIONS = {"score": "score", "published": "published", "added": "added", "keep": ("quantity",), "thresholds": (0.03, 0.07)}


def observations(spark, sf):
    """Gold over the driver's tables, with unrounded values."""
    return gold_plan.observations(
        line_daily(spark, sf),
        dimension(spark, sf),
        outcomes(spark, sf),
        key="id", day="day", as_of=line_rows(spark, sf).agg(F.max("day")).scalar(), **GOLD_OPTIONS,
    )


def _gold_sql() -> str:
    lags = (1, 7, 30)
    cols = ["score as epss_current"]
    cols += [f"max(score) over l{n} as epss_lag_{n}d" for n in lags]
    cols += [f"score - max(score) over l{n} as epss_delta_{n}d" for n in lags]
    for w in (7, 30):
        cols += [
            f"{fn}(score) over w{w} as epss_{name}_{w}d"
            for fn, name in (("avg", "mean"), ("max", "max"), ("min", "min"), ("stddev_samp", "stddev"))
        ]
        cols.append(
            f"case when count(*) over w{w} < 2 then 0.0 else regr_slope(score, dn) over w{w} end as epss_slope_{w}d"
        )
    cols += [
        "count(*) over w30 as epss_days_observed_30d",
        "cast(sum(case when score > 0.03 then 1 else 0 end) over w30 as bigint) as epss_days_above_0_03_30d",
        "cast(sum(case when score > 0.07 then 1 else 0 end) over w30 as bigint) as epss_days_above_0_07_30d",
    ]
    names = [c.rsplit(" as ", 1)[1] for c in cols]
    rounded = ", ".join(n if "days" in n else f"{sql6(n)} as {n}" for n in names)
    labels_sql = WITHIN.replace("l.day", "f.day")
    return f"""with {LINE_DAILY}, {DIMENSION}, {OUTCOMES},
    n as (select *, cast(day - date '1970-01-01' as integer) as dn from line_daily),
    f as (select id, day, quantity, {", ".join(cols)} from n window
        w7 as (partition by id order by dn range between 6 preceding and current row),
        w30 as (partition by id order by dn range between 29 preceding and current row),
        l1 as (partition by id order by dn range between 1 preceding and 1 preceding),
        l7 as (partition by id order by dn range between 7 preceding and 7 preceding),
        l30 as (partition by id order by dn range between 30 preceding and 30 preceding))
    select f.id, cast(f.day as varchar) as day, quantity, {rounded}, cast(published as varchar) as published,
        base_score, nation, cast(o.added as varchar) as kev_date_added,
        cast(o.added - f.day as integer) as days_until_kev, cast(o.added is not null as integer) as ever_in_kev,
        {labels_sql}, cast((select max(cast(l_shipdate as date)) from lineitem) as varchar) as label_as_of_date,
        cast(f.day - published as integer) as vulnerability_age_days,
        cast(year(f.day) as integer) as observation_year, cast(month(f.day) as integer) as observation_month
    from f join dimension d on f.id = d.id left join outcomes o on f.id = o.id
    where published <= f.day and (o.added is null or o.added > f.day)
      and f.day <= (select max(cast(l_shipdate as date)) - 90 from lineitem)"""


def _printed(df):
    rounded = [c for c, t in df.dtypes if t == "double" and c.startswith("epss_")]
    dates = [c for c, t in df.dtypes if t == "date"]
    return df.withColumns({**{c: r6(F.col(c)) for c in rounded}, **{c: text(c) for c in dates}})


@query("gold", _gold_sql())
def gold(spark, sf):
    return _printed(observations(spark, sf))


@query("gold_stored", _gold_sql())
def gold_stored(spark, sf):
    """The dataset through its table: written by year and month, read back with the columns in order."""
    df, root = observations(spark, sf), new_dir(spark, "gold")
    tables.write_observations(df, root)
    return _printed(tables.read_observations(spark, root).select(*df.columns))
