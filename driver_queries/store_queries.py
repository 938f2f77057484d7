"""Gold from a bucketed store, at once and in two loads."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from driver_queries.inputs import LINE_TIES, dimension, line_rows, query
from driver_queries.series_queries import GOLD_OPTIONS, _gold_sql, _printed
from vulnlake.operators import latest
from vulnlake.plans import gold as gold_plan
from vulnlake.plans import gold_refresh
from vulnlake.session import new_dir
from vulnlake.sources.series_store import SeriesStore

# A bucket is one task of every reader, so more fetches have more of them.
BUCKETS, ROWS_PER_BUCKET = 8, 3_000_000


def _store(spark, sf):
    rows = line_rows(spark, sf)
    name = f"series_{uuid.uuid4().hex}"
    buckets = max(BUCKETS, rows.count() // ROWS_PER_BUCKET)
    return SeriesStore(spark, name, new_dir(spark, "series"), rows.schema, "id", "day", "l_orderkey", tuple(LINE_TIES), buckets).open()


def _outcomes(rows):
    known = rows.filter("flag = 'R' and quantity >= 49 and score >= 0.09")
    return latest.earliest_date(known.select("id", F.col("day").alias("added")), "id", "added")


@query("gold_bucketed", _gold_sql())
def gold_bucketed(spark, sf):
    """The dataset over the stored series, which is not shuffled again."""
    store, rows = _store(spark, sf), line_rows(spark, sf)
    store.merge(rows)
    done = gold_plan.observations(
        gold_refresh.stored_series(store), *gold_refresh.stored_facts(dimension(spark, sf), _outcomes(rows)), key="id", day="day",
        as_of=rows.agg(F.max("day")).scalar(), **GOLD_OPTIONS,
    )
    return _printed(done)


@query("gold_incremental", _gold_sql())
def gold_incremental(spark, sf):
    """Two loads: the second has the last months, late fetches of one month, and the outcomes that come with them."""
    store, rows = _store(spark, sf), line_rows(spark, sf)
    late = (F.col("day") >= F.lit("1998-06-01").cast("date")) | (
        F.col("day").between(F.lit("1995-03-01").cast("date"), F.lit("1995-03-31").cast("date")) & (F.col("l_orderkey") % 3 == 0)
    )
    root = new_dir(spark, "gold-refresh")
    first = rows.where(~late)
    for load, known in ((first, first), (rows.where(late), rows)):
        as_of: date = known.agg(F.max("day")).first()[0]
        gold_refresh.refresh(store, root, load, dimension(spark, sf), _outcomes(known), as_of, **GOLD_OPTIONS)
    columns = gold_refresh.touched_rows(store, {199501}, dimension(spark, sf), _outcomes(rows), as_of=as_of, **GOLD_OPTIONS).columns
    return _printed(gold_refresh.read_gold(spark, root).select(*columns))
