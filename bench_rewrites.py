"""Time a rewrite beside the plain form it replaces, on the driver's tables; prints one JSON line per pair.

window_vs_join    trailing statistics by range windows, and by a range self-join with a group-by
tune_one_job      all weights in one job, and one evaluator job per grid point
by_date_one_job   per-date metrics in one job, and a loop over the dates
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def timed(run):
    run()
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 2)


def main():
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    from driver_queries.inputs import line_daily, ranked
    from driver_queries.ranking_queries import _tune_rows
    from vulnlake.functions.risk import blended_score
    from vulnlake.operators import ranking, series
    from vulnlake.session import build_session, cut_lineage

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(
        "bench-rewrites", f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def report(name, mine, plain):
        print(json.dumps({"rewrite": name, "seconds": mine, "plain_seconds": plain}), flush=True)

    daily = cut_lineage(line_daily(spark, sf_dir).select("id", "day", "score"), "bench-daily")

    def by_window():
        noop(series.trailing_features(daily, "id", "day", "score", lags=(7,), windows=(7, 30), thresholds=()))

    def by_join():
        d = daily.select(F.col("id").alias("i"), F.col("day").alias("d"), F.col("score").alias("s"))
        back = F.datediff("day", "d")
        joined = daily.join(d, (F.col("id") == F.col("i")) & back.between(0, 30), "left").withColumn("back", back)
        x = -F.col("back").cast("double")
        aggs = [F.max(F.when(F.col("back") == 7, F.col("s"))).alias("lag")]
        for w in (7, 30):
            inside = F.col("back") < w
            value = F.when(inside, F.col("s"))
            aggs += [f(value).alias(f"{f.__name__}{w}") for f in (F.avg, F.max, F.min, F.stddev, F.sum)]
            aggs += [F.sum(F.when(inside, e)).alias(f"m{i}_{w}") for i, e in enumerate((F.lit(1), x, x * x, x * F.col("s")))]
        noop(joined.groupBy("id", "day").agg(*aggs))

    report("window_vs_join", timed(by_window), timed(by_join))

    def pr(df, score):
        wrapped = df.withColumn("v", array_to_vector(F.array(F.lit(0.0), F.col(score).cast("double"))))
        return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="v", metricName="areaUnderPR").evaluate(wrapped)

    rows = cut_lineage(_tune_rows(spark, sf_dir), "bench-tune")

    def tune_loop():
        for w in ranking.weight_grid():
            pr(rows.withColumn("s", blended_score(F.col("cvss"), F.col("p1"), F.col("p2"), *w)), "s")

    start = time.perf_counter()
    tune_loop()
    loop = round(time.perf_counter() - start, 2)
    report("tune_one_job", timed(lambda: ranking.tune_weights(rows, "cvss", "p1", "p2", "label").collect()), loop)

    labelled = cut_lineage(ranked(spark, sf_dir), "bench-ranked")

    def date_loop():
        days = [r[0] for r in labelled.filter("label = 1").select("day").distinct().collect()]
        for day in days:
            one = labelled.filter(F.col("day") == day)
            pr(one, "score")
            one.filter("label = 1").count()
            one.orderBy(F.desc("score")).limit(5).filter("label = 1").count()

    def date_job():
        ranking.pr_auc_by_date(labelled, "score", "label", "day").collect()
        ranking.top_k_by_date(labelled, "score", "label", 5, "doc_id", "day").collect()

    report("by_date_one_job", timed(date_job), timed(date_loop))
    spark.stop()


if __name__ == "__main__":
    main()
