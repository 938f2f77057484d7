"""Metrics from stored states that merge over days, and tuning that evaluates few points exactly."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driver_queries.inputs import query, r6, sql6, table
from driver_queries.ranking_queries import _pr_sql
from vulnlake.operators import rank_state, ranking
from vulnlake.session import new_dir

WINDOWS = [
    ("early", date(1992, 1, 1), date(1993, 12, 31)), ("middle", date(1994, 1, 1), date(1996, 12, 31)),
    ("all", date(1992, 1, 1), date(1998, 12, 31)),
]
# A day of these queries is a month of the table.
MONTHLY = f"""m as (select cast(date_trunc('month', l_shipdate) as date) as day, l_extendedprice as score,
        cast(l_returnflag = 'R' as integer) as label from lineitem),
    win(name, first, last) as (values {", ".join(f"('{n}', date '{a}', date '{b}')" for n, a, b in WINDOWS)}),
    src as (select win.name as "window", m.* from m join win on m.day between win.first and win.last)"""


def _monthly(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.trunc("l_shipdate", "month").alias("day"), F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label")
    )


@query(
    "pr_auc_window",
    f"""with {MONTHLY}, {_pr_sql('src', '"window"')}
    select "window", {sql6('pr_auc')} as area_under_pr, {sql6('roc_auc')} as area_under_roc from area""",
)
def pr_auc_window(spark, sf):
    """Three windows from one stored state."""
    path = new_dir(spark, "thresholds")
    rank_state.save_thresholds(_monthly(spark, sf), "score", "label", "day", path)
    found = rank_state.window_metrics(rank_state.read_thresholds(spark, path), WINDOWS)
    return found.withColumns({c: r6(F.col(c)) for c in ("area_under_pr", "area_under_roc")})


ERROR = 0.02

SUMMARIES = f"""v as (select day, cast(score as double) as value, count(*) as n from m where score is not null group by all),
    o as (select *, sum(n) over (partition by day order by value) as upto, sum(n) over (partition by day) as total from v),
    p as (select day, value, greatest(1, cast(floor(total * {ERROR}::double) as bigint)) as s, upto, upto - n as below, total from o),
    summary as (select day, value, case when upto = total then total else upto // s * s end - below // s * s as weight, s - 1 as slack from p),
    g as (select win.name as "window", value, sum(weight) as weight from summary join win on day between first and last where weight > 0 group by all),
    e as (select name as "window", sum(slack) as most_error from (select distinct day, slack from summary) join win on day between first and last group by all),
    c as (select *, sum(weight) over (partition by "window" order by value) as upto, sum(weight) over (partition by "window") as total from g),
    q as (select c.*, i, greatest(1, (i * total + 99) // 100) as rank from c, range(101) r(i)),
    cuts as (select "window", cast(i as integer) as position, min(value) as cut, any_value(rank) as rank from q where upto >= rank group by "window", i)"""


@query(
    "percentile_sketch",
    f"""with {MONTHLY}, {SUMMARIES}, t as (select "window", score, count(*) as n from src group by all),
    x as (select "window", score, sum(n) over (partition by "window" order by score) as at_most, n from t)
    select "window", position, {sql6('cut')} as cut, cast(most_error as bigint) as most_error,
        at_most >= rank and at_most - n < rank + most_error as within
    from cuts join e using ("window") join x on cuts."window" = x."window" and cuts.cut = x.score""",
)
def percentile_sketch(spark, sf):
    """Cuts of three windows from stored summaries, and whether their exact ranks are within the bound."""
    path = new_dir(spark, "summaries")
    rows = _monthly(spark, sf)
    rank_state.save_summaries(rows, "score", "day", path, ERROR)
    cuts = rank_state.window_cuts(rank_state.read_summaries(spark, path), WINDOWS)
    spans = F.array(*(F.when(F.col("day").between(F.lit(a).cast("date"), F.lit(b).cast("date")), F.lit(n)) for n, a, b in WINDOWS))
    counts = rows.withColumn("of", F.explode(F.array_compact(spans))).groupBy("of", F.col("score").alias("threshold")).agg(
        F.lit(0).cast("bigint").alias("pos"), F.count("*").alias("n")
    )
    exact = ranking.running_totals(counts, ["of"])
    met = cuts.join(exact, (F.col("window") == F.col("of")) & (F.col("cut") == F.col("threshold")))
    rank = F.greatest(F.lit(1), F.expr("(position * total_n + 99) div 100"))
    below = F.col("total_n") - F.col("cnt")
    return met.select(
        "window", "position", r6(F.col("cut")).alias("cut"), "most_error",
        ((below + F.col("n") >= rank) & (below < rank + F.col("most_error"))).alias("within"),
    )


PREDICTED = """predicted as (select l_quantity / 5.0::double as cvss, l_extendedprice / 120000.0::double as p1,
        ((l_orderkey * 7919 + l_partkey) % 99991) / 99991.0::double * case when l_returnflag = 'R' then 1.0::double else 0.9::double end as p2,
        cast(l_returnflag = 'R' as integer) as label from lineitem)"""


@query(
    "best_weights_pruned",
    f"""with {PREDICTED}, grid as (select round(i / 20.0::double, 4) as w1, round(j / 20.0::double, 4) as w2, round((20 - i - j) / 20.0::double, 4) as w3
             from range(21) a(i), range(21) b(j) where i + j <= 20),
    points as (select w1, w2, w3, 10.0 * (w1 * least(cvss / 10.0, 1.0) + w2 * p1 + w3 * p2) as score, label from predicted, grid),
    {_pr_sql('points', 'w1, w2, w3', 'round(score, 10)')}
    select w1, w2, w3, {sql6('pr_auc')} as pr_auc, true as few from area order by round(area.pr_auc, 12) desc, w1, w2 limit 1""",
)
def best_weights_pruned(spark, sf):
    """Tuning over predictions that are nearly all distinct; few of the 231 points are evaluated exactly."""
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_quantity") / 5.0).alias("cvss"), (F.col("l_extendedprice") / 120000.0).alias("p1"),
        ((F.col("l_orderkey") * 7919 + F.col("l_partkey")) % 99991 / 99991.0
         * F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.9)).alias("p2"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )
    found = ranking.best_weights_pruned(rows, "cvss", "p1", "p2", "label")
    return found.select("w1", "w2", "w3", r6(F.col("pr_auc")).alias("pr_auc"), (F.col("exact_points") <= 60).alias("few"))
