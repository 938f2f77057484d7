"""Cutting an ordered table into files by a number of rows and a number of bytes, and auditing offset intervals.

Totals before a row are the sums of the ranges before its own plus the sum inside its range, so no task sees all rows. A file ends
where either total crosses a multiple of its limit: files hold at most the limit of rows, and less than the limit of bytes
plus one row, and the cut of one file does not wait for the cut of the one before. A row as large as the limit has its own file at most.
With `bytes_if_needed` a multiple of the bytes ends a file only inside a run of `max_records` rows that fills the limit of bytes before its
last row. Without such runs files end where a writer that counts anew for every file ends them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.session import cut_lineage

# Rows of one range are numbered in the lower bits of `_at`.
RANGE_BITS = 33
# A row looks for its file among those that reach into its block of 2 to this power rows.
BLOCK_BITS = 10

AT = "_at"


def in_order(
    rows: DataFrame, order: Sequence[Column | str], name: str, then: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The rows and `_at`, which grows with `order` over the whole table, stored.

    `order` should tell any two rows apart, so that a hot value is split between ranges. `then` changes the rows, but not their
    number, after they are in order; finding the ranges reads the rows once more, but not what `then` adds.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(AT, F.monotonically_increasing_id())
    return cut_lineage(ranged if then is None else then(ranged), name)


def totals_before(placed: DataFrame, group: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """The groups, `_at` and, per measure, its total over the rows of the group before this one.

    Only these columns are read and shuffled, by range; the table of ranges has a row per range and group.
    """
    span = F.shiftright(AT, RANGE_BITS).alias("_range")
    narrow = placed.select(*group, AT, span, *(c.alias(m) for m, c in measures.items()))
    ranges = narrow.groupBy(*group, "_range").agg(*(F.sum(m).alias(f"_sum_{m}") for m in measures))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        *(F.col(g).alias(f"_{g}") for g in group), F.col("_range").alias("_in"),
        *(F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_base_{m}") for m in measures),
    )
    inside = Window.partitionBy(*group, "_range").orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    narrow = narrow.select(*group, AT, "_range", *(F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(m) for m in measures))
    same = F.col("_range") == F.col("_in")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return narrow.join(ranges, same).select(*group, AT, *((F.col(m) + F.col(f"_base_{m}")).alias(m) for m in measures))


def positions(placed: DataFrame, group: Sequence[str], name: str) -> DataFrame:
    """The rows of `in_order`, none left out, with their number (from 0) within the group, which must lead their order, as `name`.

    Rows of a group lie next to each other in a range and `_at` numbers them, so the first of them and the rows of earlier ranges are
    enough: no row is sorted or windowed again.
    """
    span = F.shiftright(AT, RANGE_BITS)
    earlier = Window.partitionBy(*group).orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    firsts = placed.groupBy(*group, span.alias("_in")).agg(F.min(AT).alias("_first"), F.count("*").alias("_rows")).select(
        *(F.col(g).alias(f"_{g}") for g in group), "_in", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = span == F.col("_in")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return placed.join(firsts, same).withColumn(name, F.col(AT) + F.col("_shift")).drop("_in", "_shift", *(f"_{g}" for g in group))


def file_bounds(
    placed: DataFrame, group: Sequence[str], size: Column, max_records: int, max_bytes: int, bytes_if_needed: bool = False
) -> DataFrame:
    """One row per file: the groups, file_number (from 0 within the group), first_at, last_at."""
    if max_records < 1 or max_bytes < 1:
        raise ValueError("limits of a file must be positive")
    before = totals_before(placed, group, {"bytes": size, "records": F.lit(1)})
    # what is before a row says in which file it is; sizes of the rows are not needed again
    files = before.groupBy(
        *group, F.expr(f"bytes div {max_bytes}").alias("_by_bytes"), F.expr(f"records div {max_records}").alias("_by_records")
    ).agg(F.min(AT).alias("first_at"), F.max(AT).alias("last_at"), F.min("bytes").alias("_from"), F.max("bytes").alias("_to"))
    if bytes_if_needed:
        run = Window.partitionBy(*group, "_by_records")
        full = F.max("_to").over(run) - F.min("_from").over(run) >= max_bytes
        files = files.withColumn("_by_bytes", F.when(full, F.col("_by_bytes"))).groupBy(*group, "_by_bytes", "_by_records").agg(
            F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
        )
    # files are numbered as rows are: by sums over ranges of files
    ordered = in_order(files.select(*group, "first_at", "last_at"), [*group, "first_at"], "files")
    return positions(ordered, group, "file_number").select(*group, "file_number", "first_at", "last_at")


def block_lists(placed: DataFrame, files: DataFrame, group: Sequence[str]) -> DataFrame:
    """The groups and `_block`, a block of rows, with the files that reach into it. A block has a bounded number of rows, and so of files."""
    ends = placed.groupBy(F.shiftright(AT, RANGE_BITS).alias("_in")).agg(F.max(AT).alias("_end"))
    spans = F.sequence(F.shiftright("first_at", RANGE_BITS), F.shiftright("last_at", RANGE_BITS))
    # a file that reaches over ranges takes blocks of rows that are there, not of the numbers between two ranges
    pieces = files.select("*", F.explode(spans).alias("_in")).join(ends, "_in")
    first, last = F.greatest("first_at", F.shiftleft("_in", RANGE_BITS)), F.least("last_at", "_end")
    blocks = F.sequence(F.shiftright(first, BLOCK_BITS), F.shiftright(last, BLOCK_BITS))
    return pieces.select(*group, F.explode(blocks).alias("_block"), F.struct("last_at", "file_number").alias("file")).groupBy(
        *(F.col(g).alias(f"_{g}") for g in group), "_block"
    ).agg(F.sort_array(F.collect_list("file")).alias("_files"))


def cut_files(
    placed: DataFrame, group: Sequence[str], size: Column, max_records: int, max_bytes: int, bytes_if_needed: bool = False
) -> DataFrame:
    """The rows of `in_order` and their file_number. Every block of rows gets the list of the files that reach into it, however many a range has."""
    lists = block_lists(placed, file_bounds(placed, group, size, max_records, max_bytes, bytes_if_needed), group)
    same = F.shiftright(AT, BLOCK_BITS) == F.col("_block")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    own = F.filter("_files", lambda f: f["last_at"] >= F.col(AT))[0]["file_number"]
    return placed.join(lists, same).withColumn("file_number", own).drop("_block", "_files", *(f"_{g}" for g in group))


def offset_intervals(rows: DataFrame, keys: Sequence[str], offset: str) -> DataFrame:
    """The keys, first_offset, last_offset and records of every stretch of neighbouring offsets under the keys.

    A stretch ends where an offset is missing. The keys should name a file or another bounded number of rows, as the rows of one key are
    looked at in order; stretches of different keys may touch.
    """
    ordered = Window.partitionBy(*keys).orderBy(offset)
    marked = rows.select(*keys, offset).distinct().withColumn("_run", F.col(offset) - F.row_number().over(ordered))
    return marked.groupBy(*keys, "_run").agg(
        F.min(offset).alias("first_offset"), F.max(offset).alias("last_offset"), F.count("*").alias("records")
    ).drop("_run")


def offset_audit(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, kind (`gap` or `overlap`), first_offset, last_offset: what no interval of the keys covers between their first and last offset,
    and what more than one covers.

    Edges of intervals are counted up and down, and a running count says how many cover the stretch to the next edge. Edges at the same
    offset are summed first, so the window of a key has at most two rows per interval, and none per record.
    """
    edges = intervals.select(*keys, F.col("first_offset").alias("edge"), F.lit(1).alias("step")).unionByName(
        intervals.select(*keys, (F.col("last_offset") + 1).alias("edge"), F.lit(-1).alias("step"))
    )
    # edges at which one interval ends and another begins change nothing
    summed = edges.groupBy(*keys, "edge").agg(F.sum("step").alias("step")).where("step <> 0")
    ordered = Window.partitionBy(*keys).orderBy("edge")
    counted = summed.withColumns({
        "covers": F.sum("step").over(ordered.rowsBetween(Window.unboundedPreceding, 0)), "until": F.lead("edge").over(ordered) - 1,
    })
    kind = F.when(F.col("covers") == 0, "gap").when(F.col("covers") > 1, "overlap").otherwise("once")
    staged = counted.where(F.col("until").isNotNull()).withColumn("kind", kind)
    # stretches that more than one interval covers may follow each other with different counts
    first = F.coalesce(F.col("kind") != F.lag("kind").over(ordered), F.lit(True)).cast("int")
    grouped = staged.withColumn("_first", first).withColumn("_run", F.sum("_first").over(ordered))
    return grouped.where("kind <> 'once'").groupBy(*keys, "_run", "kind").agg(
        F.min("edge").alias("first_offset"), F.max("until").alias("last_offset")
    ).select(*keys, "kind", "first_offset", "last_offset")
