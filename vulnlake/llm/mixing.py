"""Operator 13: a mix of sources with target weights by systematic sampling.

Every document of a source has the same expected number of copies. They are summed up along the source's documents in the
order of their sizes, one random offset is added, and a document is taken once for every whole number that its part of the
sum crosses. So a document's copies differ from their expectation by less than one, and because neighbours in this order
have nearly the same size, the words taken from a source differ from its target by at most about one largest document. All sums are
whole numbers, so reruns agree to the last row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.positions import in_order, numbered
from vulnlake.llm.tables import cut_lineage, pick

# Sources have these weights in turn.
WEIGHTS = (5, 2, 1)
# No source and no document is taken more often than this.
MOST = 3
SEED = "mix"

WORDS = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, num, den for a table of (source, source_size): the source is to be taken num / den times.

    Sources have their weights by code point, null last, and share the sum of all sizes. One that would be taken more than `most` times
    is held there, and what is left is shared by the others, until none is above. Every round of that is one aggregate over
    the stored table, and three numbers reach the driver. A source without words is taken 0 times.
    """
    placed = in_order(sources, [F.col("source").asc_nulls_last()], "mix-sources")
    choices = F.array(*(F.lit(int(w)) for w in weights))
    weight = F.element_at(choices, (F.col("position") % len(weights) + 1).cast("int"))
    weighed = cut_lineage(numbered(placed).select("source", "source_size", weight.cast("long").alias("weight")), "mix-weights")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    left, shares, held = total, None, None
    # a source is above if weight / shares * left > most * source_size; products are exact
    while True:
        above = F.lit(False)
        if shares is not None:
            above = F.col("weight").cast("decimal(38,0)") * F.lit(left) > F.col("source_size").cast("decimal(20,0)") * F.lit(most * shares)
        n, gone, rest = weighed.agg(
            F.count_if(above), F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == held:
            break
        left, shares, held = total - most * (gone or 0), rest or 1, n
    size = F.col("source_size").cast("decimal(38,0)")
    return weighed.select(
        "source", "source_size",
        F.when(above, size * most).otherwise(F.col("weight").cast("decimal(38,0)") * F.lit(left)).cast("decimal(38,0)").alias("num"),
        F.when(above, F.lit(1)).otherwise(F.lit(shares)).cast("decimal(38,0)").alias("den"),
    )


def mix(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    The size is the number of words, 0 for a null or empty text; documents without words also have their copies, which take no word.
    A null source is a source. Within a source documents are in the order of size and doc_id; repeated rows stand next to each other and share their
    copies by chance of the order, so that the set of rows is always the same. An empty table gives an empty one.
    Texts are read once and never shuffled; further columns are left out and can have any names.
    """
    slim = pick(docs, doc_id, source, text).toDF("doc_id", "source", "text")
    sized = cut_lineage(
        slim.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
                    F.monotonically_increasing_id().alias("row")),
        "mix-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = cut_lineage(targets(sources, weights, most), "mix-targets").withColumnRenamed("source", "of")
    order = [F.col(c).asc_nulls_last() for c in ("source", "size", "doc_id", "row")]
    placed = numbered(in_order(sized, order, "mix-order"), F.col("source"))
    joined = placed.join(shares, F.col("source").eqNullSafe(F.col("of")))
    # copies = num / (den * source_size); the offset is a whole number below the divisor
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("source", F.lit("")))), 1, 8), 16, 10)
    exact = joined.withColumn("divisor", (F.col("den") * F.col("source_size")).cast("decimal(38,0)"))
    exact = exact.withColumn("draw", F.expr("cast(0 as bigint)") + draw.cast("long"))
    exact = exact.withColumn("first", F.expr("(draw * divisor) div 4294967296").cast("decimal(20,0)"))
    crossed = F.expr(
        "((cast(position + 1 as decimal(20,0)) * num + first) div divisor) - ((cast(position as decimal(20,0)) * num + first) div divisor)"
    )
    copies = F.when(F.col("source_size") > 0, crossed).otherwise(F.lit(0)).cast("long")
    target = F.col("num").cast("double") / F.col("den").cast("double")
    mixed = exact.select("doc_id", "source", "size", "source_size", target.alias("target"), copies.alias("copies"))
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: one row (doc_id, source, copy from 0) for each time that a document is taken."""
    times = F.when(F.col("copies") > 0, F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return mixed.select("doc_id", "source", F.explode(times).alias("copy"))
