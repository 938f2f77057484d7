"""Ranking metrics, splits, weights, quantiles and the models."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from driver_queries.inputs import (
    DIMENSION,
    LINE_DAILY,
    RANKED,
    dimension,
    line_daily,
    line_rows,
    query,
    r6,
    ranked,
    sql6,
    table,
    text,
    vectors,
)
from vulnlake.functions.risk import blended_score, clamp_unit
from vulnlake.operators import learning, ranking, splits
from vulnlake.plans import scoring, training
from vulnlake.session import cut_lineage, new_dir

K = 50


def _pr_sql(source: str, groups: str = "", threshold: str = "cast(score as double)") -> str:
    """CTE `area(groups, pr_auc)` over `source` with columns score, label; rows of one threshold tie."""
    by = f"{groups}, " if groups else ""
    part = f"partition by {groups} " if groups else ""
    return f"""t_ as (select {by}{threshold} as s, cast(sum(label) as double) as p, cast(count(*) as double) as n
        from {source} where label is not null and score is not null group by {by}s),
    c_ as (select {by}p, n, s, sum(p) over ({part}order by s desc) as tp, sum(n) over ({part}order by s desc) as cnt,
        sum(p) over ({part.strip()}) as tot, sum(n) over ({part.strip()}) as alln from t_),
    l_ as (select {by}p, n, tp, cnt, tot, alln, tp / cnt as pre,
        coalesce(lag(tp / cnt) over ({part}order by s desc), tp / cnt) as pre0 from c_),
    area as (select {by}case when max(tot) > 0 then sum(p / tot * (pre + pre0) / 2) end as pr_auc,
        sum((n - p) * (tp - p / 2)) / nullif(max(tot) * (max(alln) - max(tot)), 0) as roc_auc
        from l_ {"group by " + groups if groups else ""})"""


def _topk_sql(source: str, k: int, groups: str) -> str:
    """CTE `top_(groups, hits, positives_total)`, groups with positives only."""
    return f"""top_ as (select {groups}, sum(case when rn <= {k} and label = 1 then 1 else 0 end) as hits,
        count(*) filter (label = 1) as positives_total
        from (select *, row_number() over (partition by {groups} order by score desc nulls last, doc_id) as rn
              from {source} where label is not null)
        group by {groups} having count(*) filter (label = 1) > 0)"""


@query(
    "top_k",
    f"""with {RANKED}, r as (select *, 1 as g from ranked), {_topk_sql("r", K, "g")}
    select cast({K} as integer) as k, {sql6(f"hits / cast({K} as double)")} as precision_at_k,
        {sql6("hits / cast(positives_total as double)")} as recall_at_k, positives_total from top_""",
)
def top_k(spark, sf):
    top = ranking.top_k(ranked(spark, sf), "score", "label", K, "doc_id")
    return top.withColumns({c: r6(F.col(c)) for c in ("precision_at_k", "recall_at_k")})


@query(
    "top_k_by_date",
    f"""with {RANKED}, {_topk_sql("ranked", 5, "day")}
    select cast(5 as integer) as k, {sql6("avg(hits / 5.0::double)")} as mean_precision_at_k,
        {sql6("avg(hits / cast(positives_total as double))")} as mean_recall_at_k, count(*) as dates_scored from top_""",
)
def top_k_by_date(spark, sf):
    top = ranking.top_k_by_date(ranked(spark, sf), "score", "label", 5, "doc_id", "day")
    return top.withColumns({c: r6(F.col(c)) for c in ("mean_precision_at_k", "mean_recall_at_k")})


@query("pr_auc", f"with {RANKED}, {_pr_sql('ranked')} select {sql6('pr_auc')} as pr_auc from area")
def pr_auc(spark, sf):
    return ranking.pr_auc(ranked(spark, sf), "score", "label").select(r6(F.col("pr_auc")).alias("pr_auc"))


TINY = f"{RANKED}, tiny as (select * replace (score / 1e12::double as score) from ranked)"


@query("pr_auc_tiny", f"with {TINY}, {_pr_sql('tiny')} select {sql6('pr_auc')} as pr_auc, {sql6('roc_auc')} as roc_auc from area")
def pr_auc_tiny(spark, sf):
    """Scores far below any decimal rounding keep their order."""
    rows = ranked(spark, sf).withColumn("score", F.col("score") / F.lit(1e12))
    found = ranking.classification_metrics(rows, "score", "label")
    return found.select(r6(F.col("area_under_pr")).alias("pr_auc"), r6(F.col("area_under_roc")).alias("roc_auc"))


NULL_GROUP = f"{RANKED}, grouped as (select * replace (case when day not in ('src0', 'src1') then day end as day) from ranked)"


@query(
    "pr_auc_null_group",
    f"""with {NULL_GROUP}, {_pr_sql('grouped', 'day')}, {_topk_sql('grouped', 5, 'day')}
    select area.day as day, {sql6('pr_auc')} as pr_auc, {sql6('hits / 5.0::double')} as precision_at_k
    from area left join top_ on area.day is not distinct from top_.day""",
)
def pr_auc_null_group(spark, sf):
    """Rows without a group are a group."""
    rows = ranked(spark, sf).withColumn("day", F.when(~F.col("day").isin("src0", "src1"), F.col("day")))
    area = ranking.pr_auc(rows, "score", "label", ["day"])
    top = ranking.top_k_per_group(rows, "score", "label", 5, "doc_id", ["day"]).withColumnRenamed("day", "top_day")
    return area.join(top, F.col("day").eqNullSafe(F.col("top_day")), "left").select(
        "day", r6(F.col("pr_auc")).alias("pr_auc"), r6(F.col("precision_at_k")).alias("precision_at_k")
    )


LINE_SCORED = """line_scored as (select cast(l_shipdate as date) as day, l_extendedprice as score,
    cast(l_returnflag = 'R' as integer) as label from lineitem)"""


def _line_scored(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("day"), F.col("l_extendedprice").alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


@query(
    "pr_auc_continuous",
    f"""with {LINE_SCORED}, {_pr_sql('line_scored')}
    select {sql6('pr_auc')} as area_under_pr, {sql6('roc_auc')} as area_under_roc from area""",
)
def pr_auc_continuous(spark, sf):
    """Nearly every score distinct, over the largest table."""
    found = ranking.classification_metrics(_line_scored(spark, sf), "score", "label")
    return found.select(*(r6(F.col(c)).alias(c) for c in found.columns))


@query(
    "pr_auc_per_date",
    f"""with {LINE_SCORED}, {_pr_sql('line_scored', 'day')}
    select cast(day as varchar) as day, {sql6('pr_auc')} as pr_auc from area""",
)
def pr_auc_per_date(spark, sf):
    found = ranking.pr_auc(_line_scored(spark, sf), "score", "label", ["day"])
    return found.select(text("day").alias("day"), r6(F.col("pr_auc")).alias("pr_auc"))


MACRO = f"""{sql6("coalesce(avg(pr_auc), 0.0)")} as macro_pr_auc, count(pr_auc) as dates_scored,
    count(*) - count(pr_auc) as dates_without_positives"""


@query("pr_auc_by_date", f"with {RANKED}, {_pr_sql('ranked', 'day')} select {MACRO} from area")
def pr_auc_by_date(spark, sf):
    found = ranking.pr_auc_by_date(ranked(spark, sf), "score", "label", "day")
    return found.withColumn("macro_pr_auc", r6(F.col("macro_pr_auc")))


@query("roc_auc", f"with {RANKED}, {_pr_sql('ranked')} select {sql6('pr_auc')} as area_under_pr, {sql6('roc_auc')} as area_under_roc from area")
def roc_auc(spark, sf):
    found = ranking.classification_metrics(ranked(spark, sf), "score", "label")
    return found.select(*(r6(F.col(c)).alias(c) for c in found.columns))


@query(
    "baseline_rank",
    f"""with {RANKED}, {_pr_sql('ranked')}, r as (select *, 1 as g from ranked), {_topk_sql("r", K, "g")}
    select {sql6('pr_auc')} as pr_auc, cast({K} as integer) as k, {sql6(f"hits / cast({K} as double)")} as precision_at_k,
        {sql6("hits / cast(positives_total as double)")} as recall_at_k, positives_total from top_, area""",
)
def baseline_rank(spark, sf):
    found = ranking.baseline(ranked(spark, sf), "score", "label", K, "doc_id")
    return found.withColumns({c: r6(F.col(c)) for c in ("pr_auc", "precision_at_k", "recall_at_k")})


@query(
    "rank_compare",
    f"""with {RANKED}, long as (
        select 'score' as score_name, day, doc_id, label, score from ranked union all
        select 'other', day, doc_id, label, cast((doc_id * 7919) % 1000 as double) from ranked),
    pooled as (with {_pr_sql("long", "score_name")} select * from area),
    per_day as (with {_pr_sql("long", "score_name, day")} select * from area),
    top_pooled as (with {_topk_sql("long", K, "score_name")} select * from top_),
    top_day as (with {_topk_sql("long", 5, "score_name, day")} select * from top_)
    select p.score_name, {sql6("p.pr_auc")} as pr_auc, cast(5 as integer) as k,
        {sql6("(select sum(hits) / 5.0::double from (" + "with " + _topk_sql("long", 5, "score_name") + " select * from top_) x where x.score_name = p.score_name)")} as precision_at_k,
        {sql6("(select sum(hits) / sum(positives_total)::double from (" + "with " + _topk_sql("long", 5, "score_name") + " select * from top_) x where x.score_name = p.score_name)")} as recall_at_k,
        (select max(positives_total) from top_pooled t where t.score_name = p.score_name) as positives_total,
        {sql6("(select avg(pr_auc) from per_day d where d.score_name = p.score_name)")} as macro_pr_auc,
        (select count(pr_auc) from per_day d where d.score_name = p.score_name) as dates_scored,
        (select count(*) - count(pr_auc) from per_day d where d.score_name = p.score_name) as dates_without_positives,
        {sql6("(select avg(hits / 5.0::double) from top_day d where d.score_name = p.score_name)")} as mean_precision_at_k,
        {sql6("(select avg(hits / positives_total::double) from top_day d where d.score_name = p.score_name)")} as mean_recall_at_k
    from pooled p""",
)
def rank_compare(spark, sf):
    rows = ranked(spark, sf).withColumn("other", ((F.col("doc_id") * 7919) % 1000).cast("double"))
    found = ranking.compare_scores(rows, ["score", "other"], "label", 5, "doc_id", "day")
    return found.withColumns({c: r6(F.col(c)) for c, t in found.dtypes if t == "double"})


@query(
    "regression_metrics",
    f"""select l_returnflag as flag, {sql6("sqrt(avg((l_discount - l_tax) * (l_discount - l_tax)))")} as rmse,
        {sql6("avg(abs(l_discount - l_tax))")} as mae,
        {sql6("1.0 - avg((l_discount - l_tax) * (l_discount - l_tax)) / var_pop(l_tax)")} as r2
    from lineitem group by 1""",
)
def regression_metrics(spark, sf):
    rows = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    found = ranking.regression_metrics(rows, "l_discount", "l_tax", ["flag"])
    return found.select("flag", *(r6(F.col(c)).alias(c) for c in ("rmse", "mae", "r2")))


# ---- quantiles -------------------------------------------------------------------------------------
CUTS = """ordered as (select l_extendedprice as s, row_number() over (order by l_extendedprice) as rn,
        count(*) over () as n from lineitem),
    cuts as (select i as position, s as cut from range(101) r(i), ordered
             where rn = greatest((i * n + 99) // 100, 1))"""


@query("percentile_cuts")
def percentile_cuts(spark, sf):
    return ranking.percentile_cuts(table(spark, sf, "lineitem"), "l_extendedprice")


@query("percentile_cuts_exact", f"with {CUTS} select cast(position as integer) as position, {sql6('cut')} as cut from cuts")
def percentile_cuts_exact(spark, sf):
    found = ranking.exact_percentile_cuts(table(spark, sf, "lineitem"), "l_extendedprice")
    return found.withColumn("cut", r6(F.col("cut")))


@query(
    "percentile_of",
    f"""with {CUTS}, a as (select list(cut order by cut) as c from cuts),
    p as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
        round(100.0::double * len(list_filter(c, lambda x: x <= l_extendedprice)) / len(c), 2) as percentile from lineitem, a)
    select * from p""",
)
def percentile_scores(spark, sf):
    lines = table(spark, sf, "lineitem")
    cuts = ranking.exact_percentile_cuts(lines, "l_extendedprice")
    rows = lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return ranking.add_percentile(rows, "l_extendedprice", cuts)


FINE = CUTS.replace("range(101)", "range(1001)").replace("(i * n + 99) // 100", "(i * n + 999) // 1000")


@query(
    "percentile_of_fine",
    f"""with {FINE}, a as (select list(cut order by cut) as c from cuts), e as (select distinct l_extendedprice from lineitem)
    select l_extendedprice, round(100.0::double * len(list_filter(c, lambda x: x <= l_extendedprice)) / len(c), 2) as percentile from e, a""",
)
def percentile_scores_fine(spark, sf):
    """A thousand cut points."""
    lines = table(spark, sf, "lineitem")
    cuts = ranking.exact_percentile_cuts(lines, "l_extendedprice", 1001)
    return ranking.add_percentile(lines.select("l_extendedprice").distinct(), "l_extendedprice", cuts)


# ---- splits ----------------------------------------------------------------------------------------
BOUNDS = f"""{LINE_DAILY}, dates as (select day, row_number() over (order by day) as i, count(*) over () as n
        from (select distinct day from line_daily)),
    sizes as (select max(n) as n, greatest(1, cast(floor(max(n) * 0.6::double) as bigint)) as tr,
        greatest(1, cast(floor(max(n) * 0.2::double) as bigint)) as va from dates),
    bounds as (select max(day) filter (i = 1) as train_start, max(day) filter (i = tr) as train_end,
        max(day) filter (i = tr + 1) as val_start, max(day) filter (i = tr + va) as val_end,
        max(day) filter (i = tr + va + 1) as test_start, max(day) as test_end,
        cast(max(tr) as integer) as train_count, cast(max(va) as integer) as val_count,
        cast(max(s.n - tr - va) as integer) as test_count, cast(max(s.n) as integer) as total_count
        from dates, sizes s),
    assigned as (select id, day, flag, case when day <= train_end then 'train' when day <= val_end then 'val'
        else 'test' end as split from line_daily, bounds)"""
BOUND_DATES = ["train_start", "train_end", "val_start", "val_end", "test_start", "test_end"]


@query(
    "split_bounds",
    f"with {BOUNDS} select {', '.join(f'cast({c} as varchar) as {c}' for c in BOUND_DATES)}, train_count, val_count, test_count, total_count from bounds",
)
def split_bounds(spark, sf):
    found = splits.split_bounds(line_daily(spark, sf), "day")
    return found.withColumns({c: text(c) for c in BOUND_DATES})


def _assigned(spark, sf):
    daily = line_daily(spark, sf)
    # The dates alone decide the bounds; picking the latest record does not change them.
    bounds = splits.split_bounds(line_rows(spark, sf), "day")
    return splits.assign_splits(daily, bounds, "day")


@query("split_assign", f"with {BOUNDS} select id, cast(day as varchar) as day, split from assigned")
def split_assign(spark, sf):
    return _assigned(spark, sf).select("id", text("day").alias("day"), "split")


@query(
    "split_counts",
    f"with {BOUNDS} select split, count(*) as rows, count(*) filter (flag = 'R') as positives from assigned group by 1",
)
def split_counts(spark, sf):
    rows = _assigned(spark, sf).withColumn("label", (F.col("flag") == "R").cast("int"))
    return splits.split_counts(rows, "label")


@query(
    "class_weights",
    f"""with c as (select count(*)::double as n, count(*) filter (l_returnflag = 'R')::double as p from lineitem)
    select l_orderkey, l_linenumber, l_partkey, {sql6("case when l_returnflag = 'R' then n / (2 * p) else n / (2 * (n - p)) end")} as class_weight
    from lineitem, c""",
)
def class_weights(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    weighted = learning.balanced_weight(rows, "label")
    return weighted.select("l_orderkey", "l_linenumber", "l_partkey", r6(F.col("class_weight")).alias("class_weight"))


# ---- score arithmetic --------------------------------------------------------------------------------


@query(
    "blend_score",
    f"""with {LINE_DAILY}, {DIMENSION} select l.id, cast(l.day as varchar) as day,
        {sql6("10.0 * (0.2 * least(coalesce(base_score, 0.0) / 10.0, 1.0) + 0.3 * score + 0.5 * (quantity / 50.0))")} as adjusted_risk
    from line_daily l join dimension d on l.id = d.id""",
)
def blend_score(spark, sf):
    rows = line_daily(spark, sf).join(dimension(spark, sf), "id")
    blended = blended_score(F.col("base_score"), F.col("score"), F.col("quantity") / 50.0, 0.2, 0.3, 0.5)
    return rows.select("id", text("day").alias("day"), r6(blended).alias("adjusted_risk"))


@query(
    "clamp",
    f"""select l_orderkey, l_linenumber, l_partkey, {sql6("greatest(0.0, least(1.0, l_discount * 20 - 0.5))")} as clamped from lineitem""",
)
def clamp(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", r6(clamp_unit(F.col("l_discount") * 20 - 0.5)).alias("clamped")
    )


@query(
    "fill_zero",
    f"""with {LINE_DAILY}, {DIMENSION} select l.id, cast(l.day as varchar) as day, coalesce(base_score, 0.0) as base_score
    from line_daily l left join dimension d on l.id = d.id""",
)
def fill_zero(spark, sf):
    rows = line_daily(spark, sf).join(dimension(spark, sf), "id", "left")
    return learning.fill_zero(rows, ["base_score"]).select("id", text("day").alias("day"), "base_score")


TUNE = f"""{RANKED}, src as (select (cast(score as bigint) % 101) / 10.0::double as cvss, quality * 0.5 + (doc_id % 89) / 200.0::double as p1,
        (doc_id % 97) / 97.0::double as p2, label from ranked),
    grid as (select round(i / 20.0::double, 4) as w1, round(j / 20.0::double, 4) as w2, round((20 - i - j) / 20.0::double, 4) as w3
             from range(21) a(i), range(21) b(j) where i + j <= 20),
    points as (select w1, w2, w3, 10.0 * (w1 * least(cvss / 10.0, 1.0) + w2 * p1 + w3 * p2) as score, label from src, grid),
    {_pr_sql('points', 'w1, w2, w3', 'round(score, 9)')}"""


def _tune_rows(spark, sf):
    return ranked(spark, sf).select(
        ((F.col("score").cast("bigint") % 101) / 10.0).alias("cvss"),
        (F.col("quality") * 0.5 + (F.col("doc_id") % 89) / 200.0).alias("p1"),
        ((F.col("doc_id") % 97) / 97.0).alias("p2"),
        "label",
    )


@query("tune_weights", f"with {TUNE} select w1, w2, w3, {sql6('pr_auc')} as pr_auc from area")
def tune_weights(spark, sf):
    found = ranking.tune_weights(_tune_rows(spark, sf), "cvss", "p1", "p2", "label")
    return found.withColumn("pr_auc", r6(F.col("pr_auc")))


@query(
    "best_weights",
    f"with {TUNE} select w1, w2, w3, {sql6('pr_auc')} as pr_auc from area order by round(area.pr_auc, 12) desc, w1, w2 limit 1",
)
def best_weights(spark, sf):
    found = ranking.tune_weights(_tune_rows(spark, sf), "cvss", "p1", "p2", "label")
    return ranking.best_weights(found).withColumn("pr_auc", r6(F.col("pr_auc")))


# ---- features and models -----------------------------------------------------------------------------


@query(
    "one_hot",
    """with c as (select p_brand, row_number() over (order by count(*) desc, p_brand) - 1 as b from part group by 1),
    t as (select p_type, row_number() over (order by count(*) desc, p_type) - 1 as t from part group by 1)
    select p_partkey, cast(c.b as double) as brand_index, cast(t.t as double) as type_index,
        cast(c.b + 1 as bigint) as brand_slot, cast(t.t + 1 as bigint) as type_slot
    from part join c using (p_brand) join t using (p_type)""",
)
def one_hot(spark, sf):
    parts = table(spark, sf, "part")
    stages = learning.feature_stages(["p_brand", "p_type"], ["p_size"])
    model = Pipeline(stages=stages[:2]).fit(parts)
    slot = lambda c: F.array_position(vector_to_array(F.col(c)), 1.0)
    return model.transform(parts).select(
        "p_partkey",
        F.col("p_brand_idx").alias("brand_index"),
        F.col("p_type_idx").alias("type_index"),
        slot("p_brand_oh").alias("brand_slot"),
        slot("p_type_oh").alias("type_slot"),
    )


def observations_with_vectors(spark, sf):
    """Line rows with the decoded vector of their part: score, label and the model's features."""
    dimension_ = scoring.with_decoded(vectors(spark, sf).withColumnRenamed("vector", "cvss_vector"))
    columns = [*learning.CVSS_CATEGORICAL, *learning.CVSS_NUMERIC]
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("cve_id"),
        F.col("l_shipdate").cast("date").alias("observation_date"),
        (F.col("l_discount") * 10.0).alias("epss_current"),
        ((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 25)).cast("int").alias("kev_within_90_days"),
    )
    return lines.join(dimension_.select("p_partkey", *columns), "p_partkey")


@query("feature_vector")
def feature_vector(spark, sf):
    rows = learning.fill_zero(cut_lineage(observations_with_vectors(spark, sf), "training-input"), learning.CVSS_NUMERIC)
    model = Pipeline(stages=learning.feature_stages(learning.CVSS_CATEGORICAL, learning.CVSS_NUMERIC)).fit(rows)
    keys = [*learning.CVSS_CATEGORICAL, *learning.CVSS_NUMERIC]
    return learning.by_combination(model, rows, keys, vector_to_array("features"), "features").select("cve_id", "features")


@query("model_a")
def model_a(spark, sf):
    rows = cut_lineage(observations_with_vectors(spark, sf), "training-input")
    model = learning.train_exploit_model(rows)
    return learning.apply_exploit_model(model, rows).select("cve_id", "epss_current", "pred_epss")


@query("model_b")
def model_b(spark, sf):
    rows = cut_lineage(observations_with_vectors(spark, sf), "training-input")
    predicted = learning.apply_exploit_model(learning.train_exploit_model(rows), rows)
    model = learning.train_outcome_model(predicted)
    return learning.apply_outcome_model(model, predicted).select("cve_id", "kev_within_90_days", "pred_kev_prob")


@query("training")
def train(spark, sf):
    rows = cut_lineage(observations_with_vectors(spark, sf), "training-input")
    return training.run_training(rows)


@query("score_vectors")
def score_vectors(spark, sf):
    """Train, store, load, and score every vector of `part`."""
    folder = new_dir(spark, "models")
    rows = cut_lineage(observations_with_vectors(spark, sf), "training-input")
    training.run_training(rows, model_dir=folder)
    exploit_model, outcome_model = training.load_models(folder)
    table_ = scoring.with_decoded(vectors(spark, sf).withColumnRenamed("vector", "cvss_vector"))
    scored = scoring.score_vectors(
        table_, exploit_model, outcome_model, training.load_weights(spark, folder),
        cuts=spark.read.parquet(f"{folder}/score_percentiles"),
    )
    return scored.select(
        "p_partkey", "cvss_vector", "cvss_only_priority", "pred_epss", "pred_kev_prob", "adjusted_risk",
        "adjusted_risk_percentile", "priority_0_10",
    )
