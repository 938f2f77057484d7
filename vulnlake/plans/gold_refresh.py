"""Gold kept up to date: only the months that new fetches, records, outcomes or a later as-of date touch are written again.

A row depends on the series of its key over the lookback before its day, on the key's record and outcome, and on whether its label
window is complete. So the touched months are those of changed days and of the lookback after them, those whose rows become
complete, and those of keys with another record or outcome. They are built from the stored series of these months and the lookback
before them, which reaches the scan as partition filters; the bucketed series itself is never shuffled. The as-of date is the same in all rows
and is kept beside the table.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.operators import counts, labels
from vulnlake.plans import gold
from vulnlake.session import cut_lineage, delete_dir, scratch
from vulnlake.sources import tables
from vulnlake.sources.series_store import MONTH, SeriesStore, month_of

LOOKBACK = 30
AS_OF = "label_as_of_date"
# `pending` months were about to be written when the state was stored; they are written again if that did not end well.
STATE = "as_of date, pending array<int>"


def months_between(first: date, last: date) -> set[int]:
    """Months from one day to the other, as numbers."""
    out, day = set(), first.replace(day=1)
    while day <= last:
        out.add(day.year * 100 + day.month)
        day = (day + timedelta(days=32)).replace(day=1)
    return out


def months_after(days: list[date], lookback: int) -> set[int]:
    """Months with a day whose lookback holds one of the days."""
    return set().union(*(months_between(d, d + timedelta(days=lookback)) for d in days)) if days else set()


def months_needed(months: set[int], lookback: int) -> set[int]:
    """The months and those that the lookback of their first days reaches into."""
    firsts = [date(m // 100, m % 100, 1) for m in months]
    return months.union(*(months_between(f - timedelta(days=lookback), f) for f in firsts)) if months else set()


def _facts(dimension: DataFrame, outcomes: DataFrame, key: str, added: str) -> DataFrame:
    """key, record, outcome: a hash of the key's record and its outcome date."""
    own = [F.col(f"`{c}`") for c in sorted(dimension.columns) if c != key]
    records = dimension.select(key, F.sha2(F.to_json(F.struct(*own), {"ignoreNullFields": "false"}), 256).alias("record"))
    return records.join(outcomes.select(key, F.col(added).alias("outcome")), key, "full")


def _changed_keys(before: DataFrame, now: DataFrame, key: str) -> DataFrame:
    old = before.toDF("old", "old_record", "old_outcome")
    same = F.col("record").eqNullSafe(F.col("old_record")) & F.col("outcome").eqNullSafe(F.col("old_outcome"))
    met = F.col(key).isNotNull() & F.col("old").isNotNull()
    return now.join(old, F.col(key) == F.col("old"), "full").where(~(met & same)).select(F.coalesce(key, "old").alias("changed"))


def _state(spark: SparkSession, gold_root: str) -> tuple[date | None, set[int]]:
    row = tables.read_or_empty(spark, f"{gold_root}/_state", schemas.struct(STATE)).first()
    return (row["as_of"], set(row["pending"] or [])) if row else (None, set())


def _store_state(spark: SparkSession, gold_root: str, as_of: date | None, pending: set[int]) -> None:
    frame = spark.createDataFrame([(as_of, sorted(pending))], schemas.struct(STATE))
    frame.coalesce(1).write.mode("overwrite").parquet(f"{gold_root}/_state")


def stored_facts(dimension: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both written once. A plan with a shuffle of its own would have the bucketed series follow its number of partitions, and hides how small it is."""
    return cut_lineage(dimension, "gold-dimension"), cut_lineage(outcomes, "gold-outcomes")


def stored_series(store: SeriesStore, months: set[int] | None = None) -> DataFrame:
    """The series without its month column; with `months` only those partitions."""
    return store.read(None if months is None else sorted(months)).drop(MONTH)


def refresh(
    store: SeriesStore, gold_root: str, rows: DataFrame, dimension: DataFrame, outcomes: DataFrame, as_of: date, *,
    published: str, added: str, score: str, lookback: int = LOOKBACK, horizons: tuple[int, ...] = labels.HORIZONS,
    censor_days: int | None = None, **options,
) -> dict[int, int]:
    """Merge new fetches into the store and bring Gold up to `as_of`; returns the rows of every month that was written.

    `dimension` and `outcomes` are complete, with one row per key, as `gold.observations` takes them; so are `options`. Without changes nothing is
    written. A refresh that fails leaves its months in the state, and the next one writes them.
    """
    spark, key, day = store.spark, store.key, store.day
    horizon = max(horizons) if censor_days is None else censor_days
    limit = as_of - timedelta(days=horizon)
    with scratch(spark, "gold"):
        staged, days = store.stage(rows)
        dimension, outcomes = stored_facts(dimension, outcomes)
        then, pending = _state(spark, gold_root)
        touched = pending | months_after(days, lookback)
        now = cut_lineage(_facts(dimension, outcomes, key, added), "gold-facts")
        facts_path = f"{gold_root}/_facts"
        if then is not None:
            old_limit = then - timedelta(days=horizon)
            first, last = sorted((old_limit, limit))
            if first < last:
                touched |= months_between(first + timedelta(days=1), last)
        before = tables.read_or_empty(spark, facts_path, now.schema)
        changed = _changed_keys(before, now, key)
        places = store.read().select(key, MONTH).unionByName(staged.select(key, MONTH))
        touched |= {r[0] for r in places.join(changed, F.col(key) == F.col("changed"), "left_semi").select(MONTH).distinct().collect()}
        last_month = max(limit, then - timedelta(days=horizon)) if then is not None else limit
        touched = {m for m in touched if m <= last_month.year * 100 + last_month.month}
        _store_state(spark, gold_root, then, touched)
        if days:
            store.apply(staged)
        written = _write_months(
            store, gold_root, touched, dimension, outcomes, as_of=as_of, published=published, added=added, score=score,
            lookback=lookback, horizons=horizons, censor_days=censor_days, **options,
        )
        now.write.mode("overwrite").parquet(facts_path)
    _store_state(spark, gold_root, as_of, set())
    return written


def _write_months(
    store: SeriesStore, gold_root: str, months: set[int], dimension: DataFrame, outcomes: DataFrame, *, as_of: date, lookback: int, **options
) -> dict[int, int]:
    if not months:
        return {}
    table = f"{gold_root}/{tables.OBSERVATIONS}"
    built = touched_rows(store, months, dimension, outcomes, as_of=as_of, lookback=lookback, **options)
    own = F.col(tables.YEAR) * 100 + F.col(tables.MONTH)
    seen, watch = counts.observed(built.drop(AS_OF), {str(m): F.count_if(own == m) for m in sorted(months)})
    (
        seen.hint("rebalance", tables.YEAR, tables.MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(tables.YEAR, tables.MONTH).parquet(table)
    )
    found = {m: counts.values(watch).get(str(m), 0) for m in months}
    for month, n in found.items():
        if not n:  # a month that has no rows any more is not overwritten
            delete_dir(store.spark, f"{table}/{tables.YEAR}={month // 100}/{tables.MONTH}={month % 100}")
    return found


def touched_rows(
    store: SeriesStore, months: set[int], dimension: DataFrame, outcomes: DataFrame, *, as_of: date, lookback: int = LOOKBACK, **options
) -> DataFrame:
    """The rows of Gold in the months, from the series of these months and the lookback before them."""
    daily = stored_series(store, months_needed(months, lookback))
    built = gold.observations(daily, dimension, outcomes, key=store.key, day=store.day, as_of=as_of, **options)
    return built.where(month_of(F.col(store.day)).isin(sorted(months)))


def read_gold(spark: SparkSession, gold_root: str) -> DataFrame:
    """The table as of the last refresh."""
    as_of, _ = _state(spark, gold_root)
    return tables.read_observations(spark, gold_root).withColumn(AS_OF, F.lit(as_of).cast("date"))
