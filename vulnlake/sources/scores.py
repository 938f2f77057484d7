"""Daily exploit-probability files: `#` comment line, header line, then `cve,epss,percentile`."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.functions.checks import blank, out_of_range
from vulnlake.functions.times import parse_date

FILE_GLOB = "*.csv.gz"


def _meta(line: Column, key: str) -> Column:
    """Value of `key` in `#key:value,key:value`; the value runs to the next comma."""
    return F.trim(F.regexp_extract(line, rf"(?:^#+|,)\s*{key}\s*:([^,]*)", 1))


def _named_date(name: Column) -> Column:
    return parse_date(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})[^/]*$", 1))


def read_score_files(
    spark: SparkSession,
    path: str,
    *,
    glob: str = FILE_GLOB,
    start: str | None = None,
    end: str | None = None,
    days_of_month: list[int] | None = None,
) -> DataFrame:
    """Rows (cve, epss, percentile as text) with model_version and score_date of their file.

    Lines stream through the text source, so a file of any size stays one scan; the comment line
    is joined back by file path. The date falls back to the one in the file name. A date range and days
    of the month select files by the date in their name, before any file is opened; files without one
    are selected by their stated date.
    """
    text = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    chosen = None
    if start is not None or end is not None or days_of_month:
        chosen = partial(_in_days, start=start, end=end, days_of_month=days_of_month)
        day = _named_date(F.col("_metadata.file_name"))
        text = text.filter(day.isNull() | chosen(day))
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.rtrim("value").alias("line"))
    is_comment = F.col("line").startswith("#")
    is_header = F.lower("line").startswith("cve,")
    comments = (
        lines.filter(is_comment)
        .groupBy("file")
        .agg(F.max("line").alias("comment"))
        .select(
            "file",
            _meta(F.col("comment"), "model_version").alias("model_version"),
            parse_date(_meta(F.col("comment"), "score_date")).alias("stated_date"),
        )
    )
    data = lines.filter(~is_comment & ~is_header & (F.col("line") != ""))
    fields = F.from_csv("line", "cve string, epss string, percentile string").alias("f")
    named = _named_date(F.col("file"))
    rows = (
        data.select("file", fields)
        .join(comments, "file", "left")
        .select(
            F.trim("f.cve").alias("cve"),
            F.trim("f.epss").alias("epss"),
            F.trim("f.percentile").alias("percentile"),
            F.coalesce("stated_date", named).alias("score_date"),
            F.coalesce("model_version", F.lit("")).alias("model_version"),
            "file",
        )
    )
    return rows if chosen is None else rows.filter(_named_date(F.col("file")).isNotNull() | chosen(F.col("score_date")))


def _in_days(day: Column, start: str | None, end: str | None, days_of_month: list[int] | None) -> Column:
    kept = F.lit(True)
    if start is not None:
        kept = kept & (day >= F.lit(start).cast("date"))
    if end is not None:
        kept = kept & (day <= F.lit(end).cast("date"))
    return kept & F.dayofmonth(day).isin(days_of_month) if days_of_month else kept


def typed_scores(rows: DataFrame) -> DataFrame:
    """Add numeric values and a status: invalid for incomplete, non-numeric, out-of-range or dateless rows."""
    score = F.col("epss").try_cast("double")
    rank = F.when(blank(F.col("percentile")), F.lit(0.0)).otherwise(F.col("percentile").try_cast("double"))
    bad = (
        blank(F.col("cve"))
        | blank(F.col("epss"))
        | score.isNull()
        | rank.isNull()
        | F.isnan(score)
        | F.isnan(rank)
        | out_of_range(score, 0.0, 1.0)
        | out_of_range(rank, 0.0, 1.0)
        | F.col("score_date").isNull()
    )
    return rows.withColumns(
        {
            "status": F.when(bad, "invalid").otherwise("published"),
            "epss_value": score,
            "percentile_value": rank,
        }
    )
