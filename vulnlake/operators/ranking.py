"""Ranking quality of a score against a binary label, pooled or per group.

All curve metrics need, for every distinct score, the number of rows and positives at or above it.
Rows are first counted per distinct score (combined before the shuffle) and that table is written to the
shared folder in score order, range-partitioned: the input is scanned once, and since every (group,
score) occurs once, the ranges are even whatever the scores look like. Running sums then come from the
sums per range, of which a group has few, plus the running sums inside a range. No task sees a whole
group. Scores are compared as the doubles they are; only blended sums in `tune_weights` tie within a relative tolerance.
A null group is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.functions.risk import blended_score, percentile_of, percentile_table
from vulnlake.session import cut_lineage

CUT_COUNT = 101
# Blended scores tie if they agree in this many of the 53 bits of a double: sums of the same terms differ in the last ones.
TIE_BITS = 40


def _labelled(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rows that can be ranked: label and score present."""
    return df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())


def _tied(value: Column, bits: int = TIE_BITS) -> Column:
    """The double rounded to its highest `bits` bits: relative to its own size, so small values stay apart."""
    stretched = value * float((1 << (53 - bits)) + 1)
    return stretched - (stretched - value)


def _same_groups(left: DataFrame, right: DataFrame, groups: list[str], more: list[str] = []) -> DataFrame:  # noqa: B006
    """Inner join on group columns, where null equals null."""
    keys = [*groups, *more]
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in keys})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in groups] + [F.col(c) == F.col(f"_r_{c}") for c in more]
    return left.join(renamed, on).drop(*(f"_r_{c}" for c in keys))


def threshold_counts(df: DataFrame, score: str, label: str, groups: list[str] | None = None) -> DataFrame:
    """(groups, threshold, pos, n): rows and positives per distinct score."""
    return (
        _labelled(df, score, label)
        .groupBy(*(groups or []), F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count("*").alias("n"))
    )


def running_totals(counts: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """Add tp and cnt (positives and rows at or above the threshold), total_pos and total_n.

    Writes the counts once: the range a row belongs to must be the same for the sums and for the rows.
    """
    groups = list(groups or [])
    ranged = counts.repartitionByRange(*groups, F.desc("threshold")).withColumn("_range", F.spark_partition_id())
    stored = cut_lineage(ranged, "thresholds")

    whole = Window.partitionBy(*groups)
    higher = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(*groups, "_range")
        .agg(F.sum("pos").alias("_p"), F.sum("n").alias("_n"))
        .select(
            *groups,
            "_range",
            F.coalesce(F.sum("_p").over(higher), F.lit(0)).alias("_pos_above"),
            F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_n_above"),
            F.sum("_p").over(whole).alias("total_pos"),
            F.sum("_n").over(whole).alias("total_n"),
        )
    )
    inside = (
        Window.partitionBy(*groups, "_range")
        .orderBy(F.desc("threshold"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return _same_groups(stored, offsets, groups, ["_range"]).select(
        *groups,
        "threshold",
        "pos",
        "n",
        (F.sum("pos").over(inside) + F.col("_pos_above")).alias("tp"),
        (F.sum("n").over(inside) + F.col("_n_above")).alias("cnt"),
        "total_pos",
        "total_n",
    )


def _pr_area() -> Column:
    """Trapezoids of the precision-recall curve; the first point takes the first precision.

    Only thresholds that add positives add area, and the point before a threshold follows from its
    own sums, so no neighbouring row is needed.
    """
    tp, cnt, pos = (F.col(c).cast("double") for c in ("tp", "cnt", "pos"))
    before_n = cnt - F.col("n")
    precision = tp / cnt
    previous = F.when(before_n > 0, (tp - pos) / F.nullif(before_n, F.lit(0.0))).otherwise(precision)
    return F.sum(F.when(F.col("total_pos") > 0, pos / F.nullif("total_pos", F.lit(0)) * (precision + previous) / 2))


def _roc_area() -> Column:
    tp, pos = F.col("tp").cast("double"), F.col("pos").cast("double")
    negatives = (F.col("n") - F.col("pos")).cast("double")
    pairs = F.col("total_pos").cast("double") * (F.col("total_n") - F.col("total_pos"))
    return F.sum(negatives * (tp - pos / 2) / F.nullif(pairs, F.lit(0.0)))


def pr_auc(df: DataFrame, score: str, label: str, groups: list[str] | None = None) -> DataFrame:
    """(groups, pr_auc): exact area under the precision-recall curve; null without positives."""
    totals = running_totals(threshold_counts(df, score, label, groups), groups)
    return totals.groupBy(*(groups or [])).agg(_pr_area().alias("pr_auc"))


def classification_metrics(
    df: DataFrame, score: str, label: str, groups: list[str] | None = None
) -> DataFrame:
    """(groups, area_under_pr, area_under_roc) from one set of running totals."""
    return areas(threshold_counts(df, score, label, groups), groups)


def areas(counts: DataFrame, groups: list[str] | None = None) -> DataFrame:
    """(groups, area_under_pr, area_under_roc) from counts per threshold, wherever they come from."""
    totals = running_totals(counts, groups)
    return totals.groupBy(*(groups or [])).agg(
        _pr_area().alias("area_under_pr"), _roc_area().alias("area_under_roc")
    )


def pr_auc_by_date(
    df: DataFrame, score: str, label: str, day: str, groups: list[str] | None = None
) -> DataFrame:
    """(groups, macro_pr_auc, dates_scored, dates_without_positives): mean over dates with positives."""
    groups = list(groups or [])
    return _macro(pr_auc(df, score, label, [*groups, day]), groups)


def _macro(per_date: DataFrame, groups: list[str]) -> DataFrame:
    return per_date.groupBy(*groups).agg(
        F.coalesce(F.avg("pr_auc"), F.lit(0.0)).alias("macro_pr_auc"),
        F.count("pr_auc").alias("dates_scored"),
        F.count_if(F.col("pr_auc").isNull()).alias("dates_without_positives"),
    )


def _rates(k: int) -> list[Column]:
    hits, total = F.col("hits").cast("double"), F.col("positives_total")
    return [
        F.lit(k).alias("k"),
        (hits / k if k else F.lit(0.0)).alias("precision_at_k"),
        F.coalesce(hits / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("recall_at_k"),
        F.col("positives_total"),
    ]


def top_k(df: DataFrame, score: str, label: str, k: int, tie_break: str) -> DataFrame:
    """One row k, precision_at_k, recall_at_k, positives_total over the k highest scores.

    precision divides by k even when there are fewer rows.
    """
    rows = df.filter(F.col(label).isNotNull())
    best = rows.select(label, score, tie_break).orderBy(F.desc(score), F.asc(tie_break)).limit(k)
    positives = rows.agg(F.count_if(F.col(label) == 1)).scalar()
    return best.agg(
        F.count_if(F.col(label) == 1).alias("hits"), F.max(positives).alias("_seen")
    ).select("hits", positives.alias("positives_total")).select(*_rates(k))


def top_k_per_group(
    df: DataFrame, score: str, label: str, k: int, tie_break: str, groups: list[str]
) -> DataFrame:
    """(groups, k, precision_at_k, recall_at_k, positives_total), groups with positives only.

    The rank filter is pushed into the sort on both sides of the shuffle, so a group that holds most
    rows sends at most k rows per task. That holds for k up to spark.sql.optimizer.windowGroupLimitThreshold (set in
    `session`); beyond it results stay right, but a group is sorted as a whole.
    """
    rows = df.filter(F.col(label).isNotNull())
    order = Window.partitionBy(*groups).orderBy(F.desc(score), F.asc(tie_break))
    hits = (
        rows.select(*groups, label, score, tie_break)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= k)
        .groupBy(*groups)
        .agg(F.count_if(F.col(label) == 1).alias("hits"))
    )
    positives = (
        rows.groupBy(*groups)
        .agg(F.count_if(F.col(label) == 1).alias("positives_total"))
        .filter("positives_total > 0")
    )
    return _same_groups(positives, hits, groups).select(*groups, *_rates(k))


def top_k_by_date(
    df: DataFrame, score: str, label: str, k: int, tie_break: str, day: str, groups: list[str] | None = None
) -> DataFrame:
    """(groups, k, mean_precision_at_k, mean_recall_at_k, dates_scored)."""
    groups = list(groups or [])
    per_date = top_k_per_group(df, score, label, k, tie_break, [*groups, day])
    return per_date.groupBy(*groups).agg(
        F.lit(k).alias("k"),
        F.coalesce(F.avg("precision_at_k"), F.lit(0.0)).alias("mean_precision_at_k"),
        F.coalesce(F.avg("recall_at_k"), F.lit(0.0)).alias("mean_recall_at_k"),
        F.count("*").alias("dates_scored"),
    )


def baseline(df: DataFrame, score: str, label: str, k: int, tie_break: str) -> DataFrame:
    """One row: pr_auc and the top-k rates of a single score."""
    area = pr_auc(df, score, label).scalar()
    return top_k(df, score, label, k, tie_break).select(area.alias("pr_auc"), "*")


def score_counts(df: DataFrame, scores: list[str], label: str, day: str) -> DataFrame:
    """(score_name, day, threshold, pos, n), stored: one aggregate of the rows from which all curves follow, pooled and per date."""
    long = df.unpivot([label, day], list(scores), "score_name", "score")
    return cut_lineage(threshold_counts(long, "score", label, ["score_name", day]), "score-counts")


def areas_by_date(counts: DataFrame, day: str) -> DataFrame:
    """(score_name, day, pr_auc, positives) for every date with rows; the area is null without positives."""
    totals = running_totals(counts, ["score_name", day])
    return totals.groupBy("score_name", day).agg(_pr_area().alias("pr_auc"), F.sum("pos").alias("positives"))


def compare_scores(
    df: DataFrame, scores: list[str], label: str, k: int, tie_break: str, day: str, counts: DataFrame | None = None
) -> DataFrame:
    """One row per score: pooled and per-date metrics side by side. `counts` is the result of `score_counts`, if it is there already."""
    counts = score_counts(df, scores, label, day) if counts is None else counts
    long = df.filter(F.col(label).isNotNull()).unpivot(
        [label, day, tie_break], list(scores), "score_name", "score"
    )
    by = ["score_name"]
    summed = counts.groupBy("score_name", "threshold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    pooled = areas(summed, by).select("score_name", F.col("area_under_pr").alias("pr_auc"))
    top = top_k_per_group(long, "score", label, k, tie_break, by)
    dated = _macro(areas_by_date(counts, day), by)
    top_dated = top_k_by_date(long, "score", label, k, tie_break, day, by).drop("k")
    return pooled.join(top, by, "left").join(dated, by).join(top_dated.drop("dates_scored"), by, "left")


def regression_metrics(df: DataFrame, prediction: str, target: str, groups: list[str] | None = None) -> DataFrame:
    """(groups, rmse, mae, r2) in one aggregation."""
    rows = df.filter(F.col(target).isNotNull() & F.col(prediction).isNotNull())
    error = F.col(prediction) - F.col(target)
    return rows.groupBy(*(groups or [])).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.avg(error * error) / F.nullif(F.var_pop(target), F.lit(0.0))).alias("r2"),
    )


def _cut_rows(row: DataFrame) -> DataFrame:
    """An array of cut points as rows (position, cut), forced to be non-decreasing."""
    monotone = F.transform("cuts", lambda _, i: F.array_max(F.slice("cuts", 1, i + 1)))
    return row.select(F.posexplode(monotone).alias("position", "cut"))


def percentile_cuts(df: DataFrame, score: str, n: int = CUT_COUNT, accuracy: int = 10_000) -> DataFrame:
    """(position, cut): n quantiles of the score with relative rank error 1/accuracy."""
    points = [i / (n - 1) for i in range(n)]
    return _cut_rows(df.agg(F.percentile_approx(score, points, accuracy).alias("cuts")))


def exact_percentile_cuts(df: DataFrame, score: str, n: int = CUT_COUNT) -> DataFrame:
    """(position, cut): the element at rank ceil(p * rows) for each of n quantiles, at any size.

    Every distinct score knows how many rows lie at or below it, hence which quantiles it answers.
    """
    rows = df.filter(F.col(score).isNotNull())
    counts = rows.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.lit(0).cast("bigint").alias("pos"), F.count("*").alias("n")
    )
    totals = running_totals(counts)
    ranks = totals.select(
        "threshold", "total_n", (F.col("total_n") - F.col("cnt")).alias("_before"),
        (F.col("total_n") - F.col("cnt") + F.col("n")).alias("_upto"),
    )
    return quantile_positions(ranks, "_before", "_upto", "total_n", n).select("position", F.col("threshold").alias("cut"))


def quantile_positions(ranks: DataFrame, before: str, upto: str, total: str, n: int) -> DataFrame:
    """The rows once for every quantile that they answer, as `position`; a row holds the ranks after `before` up to `upto`.

    Quantile i has rank ceil(i * total / (n-1)), the first one rank 1; whole numbers throughout.
    """
    first = F.when(F.col(before) == 0, F.lit(0).cast("bigint")).otherwise(F.expr(f"(`{before}` * {n - 1}) div `{total}`") + 1)
    last = F.expr(f"(`{upto}` * {n - 1}) div `{total}`")
    return ranks.filter(first <= last).withColumn("position", F.explode(F.sequence(first.cast("int"), last.cast("int"))))


def add_percentile(df: DataFrame, score: str, cuts: DataFrame, name: str = "percentile") -> DataFrame:
    """Place a score among the cut points, which enter as one small array."""
    array = cuts.agg(F.array_sort(F.collect_list("cut")).alias("cuts"))
    both = array.select(F.struct("cuts", percentile_table(F.col("cuts")).alias("table"))).scalar()
    return (
        df.withColumn("_p", both)
        .withColumn(name, percentile_of(F.col(score), F.col("_p.cuts"), F.col("_p.table")))
        .drop("_p")
    )


def weight_grid(step: float = 0.05) -> list[tuple[float, float, float]]:
    """All (w1, w2, w3) with sum 1 on a grid, in ascending order of w1, then w2."""
    steps = round(1.0 / step)
    return [
        (round(i / steps, 4), round(j / steps, 4), round((steps - i - j) / steps, 4))
        for i in range(steps + 1)
        for j in range(steps + 1 - i)
    ]


def tune_weights(
    df: DataFrame, cvss: str, exploit: str, outcome: str, label: str, *, step: float = 0.05
) -> DataFrame:
    """(w1, w2, w3, pr_auc) for every grid point, all points together.

    Rows are counted per distinct (cvss, exploit, outcome) before the grid multiplies them: model
    outputs take few distinct values, so the grid works on those and not on the rows.
    """
    rows = df.filter(F.col(label).isNotNull())
    inputs = rows.groupBy(
        F.col(cvss).cast("double").alias("_cvss"),
        F.col(exploit).cast("double").alias("_exploit"),
        F.col(outcome).cast("double").alias("_outcome"),
    ).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count("*").alias("n"))
    points = weight_grid(step)
    grid = F.array(*(F.struct(*(F.lit(w).alias(f"w{i}") for i, w in enumerate(p, 1))) for p in points))
    blended = blended_score(
        F.col("_cvss"), F.col("_exploit"), F.col("_outcome"), F.col("_w.w1"), F.col("_w.w2"), F.col("_w.w3")
    )
    # The number of the grid point is the group; its weights come back at the end.
    counts = (
        inputs.select("*", F.posexplode(grid).alias("_point", "_w"))
        .select("_point", _tied(blended).alias("threshold"), "pos", "n")
        .filter(F.col("threshold").isNotNull())
        .groupBy("_point", "threshold")
        .agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    )
    areas = running_totals(counts, ["_point"]).groupBy("_point").agg(_pr_area().alias("pr_auc"))
    return areas.select(F.get(grid, F.col("_point")).alias("_w"), "pr_auc").select("_w.*", "pr_auc")


# Bins of the blended score, from 0 to 10, in which bounds of the area are taken, coarse ones first.
BIN_ROUNDS = (256, 8192)
SCORE_RANGE = 10.0
# Sums of the same terms may differ by so much.
AREA_SLACK = 1e-9
# Cells of every blended term, and bins of their scores, in which all points are bounded before the rows are.
CELLS, CELL_BINS = 100, 2048
# Blended scores of a cell lie between those of its corners, but for so much of their size.
CORNER_SLACK = 1e-9


def _area_bounds() -> list[Column]:
    """Bounds of the area from counts per bin whose inner order is unknown.

    In a bin with p positives and m others, after tp positives among n rows, no precision is above that of all positives coming first, (tp + p) /
    (n + p), and none below that of all coming last, tp / (n + m); so also the means of neighbouring ones.
    """
    tp, cnt, pos, n = (F.col(c).cast("double") for c in ("tp", "cnt", "pos", "n"))
    before, rows = tp - pos, cnt - n
    share = pos / F.nullif("total_pos", F.lit(0))
    upper = (before + pos) / F.nullif(rows + pos, F.lit(0.0))
    lower = before / F.nullif(rows + n - pos, F.lit(0.0))
    counted = F.col("pos") > 0
    return [
        F.sum(F.when(counted, share * F.coalesce(lower, F.lit(0.0)))).alias("lower"), F.sum(F.when(counted, share * upper)).alias("upper"),
    ]


def best_weights_pruned(
    df: DataFrame, cvss: str, exploit: str, outcome: str, label: str, *, step: float = 0.05, rounds: tuple[int, ...] = BIN_ROUNDS
) -> DataFrame:
    """(w1, w2, w3, pr_auc, exact_points): the row of `best_weights`, without the exact area of every grid point.

    First all points are bounded above from cells of the inputs, whose number does not grow with the rows (`_cell_bounds`), and the most promising one
    from below by its rows. Then each round bounds the areas of the points that are left by bins of the blended score: its counts are combined before the
    shuffle, so at most bins times points rows travel, however many distinct scores there are. Points whose upper bound
    is below the greatest lower bound go. What is left, `exact_points` of them, gets its exact area. Only bounds of points and of terms reach the driver.
    """
    rows = df.filter(F.col(label).isNotNull())
    inputs = rows.groupBy(
        F.col(cvss).cast("double").alias("_cvss"), F.col(exploit).cast("double").alias("_exploit"), F.col(outcome).cast("double").alias("_outcome"),
    ).agg(F.count_if(F.col(label) == 1).alias("pos"), F.count("*").alias("n"))
    inputs = cut_lineage(inputs, "tune-inputs")
    points = weight_grid(step)
    uppers = {b["_point"]: b["upper"] for b in _cell_bounds(inputs, points).collect()}
    left, floor = list(range(len(points))), 0.0
    if uppers:
        hopeful = max(uppers, key=lambda k: uppers[k])
        floor = max((b["lower"] for b in _bin_bounds(inputs, points, [hopeful], max(rounds, default=CELL_BINS))), default=0.0)
        left = sorted(k for k, upper in uppers.items() if upper >= floor - AREA_SLACK)
    for bins in rounds:
        if len(left) == 1:
            break
        bounds = _bin_bounds(inputs, points, left, bins)
        floor = max([floor, *(b["lower"] for b in bounds)])
        left = sorted(b["_point"] for b in bounds if b["upper"] >= floor - AREA_SLACK) or left
    counts = _blended(inputs, points, left).groupBy("_point", "threshold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    exact = running_totals(counts, ["_point"]).groupBy("_point").agg(_pr_area().alias("pr_auc"))
    weights = F.get(_grid(points), F.col("_point"))
    return best_weights(exact.select(weights.alias("_w"), "pr_auc").select("_w.*", "pr_auc")).withColumn("exact_points", F.lit(len(left)))


def _bin(score: Column, bins: int) -> Column:
    return F.floor(F.least(score, F.lit(SCORE_RANGE)) * (bins / SCORE_RANGE)).cast("double")


def _bin_bounds(inputs: DataFrame, points: list[tuple[float, float, float]], chosen: list[int], bins: int) -> list:
    """(_point, lower, upper) of the chosen points that have an area, from the inputs in so many bins of their blended score."""
    blended = _blended(inputs, points, chosen)
    counted = blended.groupBy("_point", _bin(F.col("threshold"), bins).alias("threshold")).agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    return running_totals(counted, ["_point"]).groupBy("_point").agg(*_area_bounds()).where("upper is not null").collect()


def _cell_bounds(inputs: DataFrame, points: list[tuple[float, float, float]], cells: int = CELLS, bins: int = CELL_BINS) -> DataFrame:
    """(_point, upper): a bound of the area of every point that has one, from counts per cell of the three blended terms.

    The points multiply cells, of which there are at most cells^3, and not rows. A cell's blended scores lie between those of the least and the
    greatest values in it. Let all positives score as high and all others as low as their cells allow. The k-th positive from above then scores no less than it does in
    truth, and no other that is above it so was not there. So its precision is at most tp / (tp + others above its bin), if it ties with none that comes
    later, else at most that of a later one: of these the greatest counts.
    """
    terms = [F.least(F.coalesce("_cvss", F.lit(0.0)) / F.lit(10.0), F.lit(1.0)), F.col("_exploit"), F.col("_outcome")]
    names = ["_1", "_2", "_3"]
    present = inputs.where("_exploit is not null and _outcome is not null").select(*(t.alias(n) for t, n in zip(terms, names)), "pos", "n")
    ends = present.agg(*(f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max))).first()
    cell = []
    for n in names:
        low, high = ends[f"min{n}"] or 0.0, ends[f"max{n}"] or 0.0
        cell.append(F.floor((F.col(n) - low) * (cells / (high - low))).alias(f"_cell{n}") if high > low else F.lit(0).alias(f"_cell{n}"))
    corners = [f(n).alias(f"{f.__name__}{n}") for n in names for f in (F.min, F.max)]
    counted = present.groupBy(*cell).agg(*corners, F.sum("pos").alias("pos"), F.sum(F.col("n") - F.col("pos")).alias("others"))
    spread = counted.withColumn("_w", F.explode(F.array(*(
        F.struct(F.lit(k).alias("k"), *(F.lit(w).alias(f"w{i}") for i, w in enumerate(p, 1))) for k, p in enumerate(points)
    ))))
    low, high = (
        F.lit(SCORE_RANGE) * sum((F.col(f"_w.w{i}") * F.col(f"{end}_{i}") for i in (2, 3)), F.col("_w.w1") * F.col(f"{end}_1")) for end in ("min", "max")
    )
    slack = (F.abs("low") + F.abs("high") + 1) * CORNER_SLACK
    ends_of = spread.select(F.col("_w.k").alias("_point"), low.alias("low"), high.alias("high"), "pos", "others").select("_point", F.inline(F.array(
        F.struct(_bin(F.col("high") + slack, bins).alias("threshold"), F.col("pos").alias("pos"), F.col("pos").alias("n")),
        F.struct(_bin(F.col("low") - slack, bins).alias("threshold"), F.lit(0).cast("bigint").alias("pos"), F.col("others").alias("n")),
    )))
    binned = ends_of.where("n > 0").groupBy("_point", "threshold").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    above = F.col("cnt") - F.col("tp") - (F.col("n") - F.col("pos"))
    later = Window.partitionBy("_point").orderBy("threshold").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = running_totals(binned, ["_point"]).where("pos > 0").withColumn("_most", F.max(F.col("tp") / (F.col("tp") + above)).over(later))
    return totals.groupBy("_point").agg(F.sum(F.col("pos") / F.col("total_pos") * F.col("_most")).alias("upper"))


def _grid(points: list[tuple[float, float, float]]) -> Column:
    return F.array(*(F.struct(*(F.lit(w).alias(f"w{i}") for i, w in enumerate(p, 1))) for p in points))


def _blended(inputs: DataFrame, points: list[tuple[float, float, float]], chosen: list[int]) -> DataFrame:
    """(_point, threshold, pos, n): the inputs' blended score under each chosen point."""
    grid = F.array(*(
        F.struct(F.lit(k).alias("k"), *(F.lit(w).alias(f"w{i}") for i, w in enumerate(points[k], 1))) for k in chosen
    ))
    score = blended_score(F.col("_cvss"), F.col("_exploit"), F.col("_outcome"), F.col("_w.w1"), F.col("_w.w2"), F.col("_w.w3"))
    spread = inputs.withColumn("_w", F.explode(grid))
    return spread.select(F.col("_w.k").alias("_point"), _tied(score).alias("threshold"), "pos", "n").filter(F.col("threshold").isNotNull())


def best_weights(tuned: DataFrame) -> DataFrame:
    """The grid point with the highest area; of equal ones the smallest w1, then w2."""
    return tuned.orderBy(F.desc_nulls_last("pr_auc"), "w1", "w2").limit(1)
