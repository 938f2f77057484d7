"""Operator 7: shards of nearly equal size by longest-processing-time scheduling of groups that stay together.

A heap serves one item at a time, so the number of items must not grow with the data. Groups larger than a fixed share of a
shard are items of their own; their number is bounded by that share. All smaller groups are dealt by a hash into a fixed
number of bundles whose expected sizes halve from level to level: many bundles carry the load, the finest
ones even out the rest. Bundles are items with the sum of their true sizes.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.llm.tables import cut_lineage, pick

SHARDS = 40
# Size of a row besides its text.
OVERHEAD = 16
# A group of at least 1 / PER_SHARD of a mean shard is an item of its own: at most SHARDS * PER_SHARD of them exist.
PER_SHARD = 64
# Bundles: LEVELS levels of SHARDS * BUNDLES_PER_SHARD each; every level takes half of what the levels before it left.
BUNDLES_PER_SHARD = 32
LEVELS = 10
# Mean number of rows that one task numbers within a shard.
CHUNK_ROWS = 1000


def longest_first(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item: largest first (equal ones in their order), each to the least loaded shard, ties to the lowest."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, shard = heap[0]
        out[i] = shard
        heapq.heapreplace(heap, (load + sizes[i], shard))
    return out


def assign(sized: DataFrame, shards: int) -> DataFrame:
    """The columns of `sized` and `shard`. `sized` has g, a hash that names the group, and size, which is never negative.

    Only sums per item reach the driver: at most shards * (PER_SHARD + LEVELS * BUNDLES_PER_SHARD) rows. The same bound
    holds for the two tables that are broadcast.
    """
    spark = sized.sparkSession
    per_level = shards * BUNDLES_PER_SHARD
    # the position of the lowest set bit halves from level to level
    mixed = F.xxhash64("g", F.lit("bundle"))
    level = F.least(F.lit(LEVELS - 1), F.length(F.regexp_extract(F.bin(mixed), "(0*)$", 1)))
    bundle = (level * per_level + F.pmod(F.xxhash64("g", F.lit("place")), F.lit(per_level))).cast("int")
    groups = cut_lineage(sized.groupBy("g").agg(F.sum("size").alias("load")), "shard-groups")
    total = groups.agg(F.coalesce(F.sum("load"), F.lit(0))).first()[0]
    large = F.col("load") * (shards * PER_SHARD) >= F.lit(total)
    items = (
        groups.select(F.when(large, F.col("g")).alias("own"), F.when(~large, bundle).alias("bundle"), "load")
        .groupBy("own", "bundle").agg(F.sum("load").alias("load"))
        .orderBy("own", "bundle").collect()
    )
    to = longest_first([int(r["load"]) for r in items], shards)
    owners = spark.createDataFrame([(r["own"], s) for r, s in zip(items, to) if r["own"] is not None], "g long, own_shard int")
    bundles = spark.createDataFrame([(r["bundle"], s) for r, s in zip(items, to) if r["own"] is None], "bundle int, bundle_shard int")
    placed = sized.withColumn("bundle", bundle).join(F.broadcast(owners), "g", "left").join(F.broadcast(bundles), "bundle", "left")
    return placed.withColumn("shard", F.coalesce("own_shard", "bundle_shard")).drop("bundle", "own_shard", "bundle_shard")


def number(rows: DataFrame, shards: int) -> DataFrame:
    """The columns of `rows` and `slot`, gapless from 0 in every shard; `rid` names a row.

    Rows are numbered in chunks of a shard, and the chunks' sizes are summed up: no task sees a whole shard.
    """
    total = rows.count()
    chunks = max(1, -(-total // (shards * CHUNK_ROWS)))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("rid"), F.lit(chunks)).cast("int"))
    sizes = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("shard", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("rid")) - 1
    return rows.withColumn("inside", inside).join(sizes, ["shard", "chunk"]).withColumn(
        "slot", (F.col("before") + F.col("inside")).cast("long")
    ).drop("chunk", "inside", "before")


def shard_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per document, equal texts in one shard.

    The law is `bytes`: sizes are as equal as the largest group allows. A null text has the size of an empty one and stays
    with it. Repeated rows keep slots of their own; a shard may stay empty if there are few groups.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    slim = pick(docs, doc_id, text).toDF("doc_id", "text").select(
        "doc_id",
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.xxhash64(body).alias("g"),
        F.monotonically_increasing_id().alias("rid"),
    )
    placed = cut_lineage(assign(cut_lineage(slim, "shard-rows"), shards), "shard-placed")
    return number(placed, shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
