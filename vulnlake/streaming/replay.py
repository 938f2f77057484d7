"""Events that have arrived before, however long ago: an index of event ids in hash buckets behind a Bloom filter.

The filter is a table of 64-bit words per bucket. All bits of an id lie in one word, so a batch looks up one word per id; ids that
their word denies are new for certain, and only the buckets of the others are read from the index. Every batch owns its part of both
tables, and a repeated batch replaces it and does not see it. Filters of batches merge by `or`.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vulnlake import schemas
from vulnlake.session import cut_lineage
from vulnlake.sources.tables import read_or_empty

INDEX = "event_id string, load string, batch bigint, bucket int"
FILTER = "bucket int, word bigint, bits bigint, load string, batch bigint"
OWN = "_own"


@dataclass(frozen=True)
class EventIndex:
    """The ids under `root`. With `bits` per bucket and `hashes` hashes, about one in a hundred new ids is looked up in vain while a bucket has
    fewer than a tenth as many ids as bits; beyond that more are, and the result stays the same."""

    spark: SparkSession
    root: str
    load: str
    buckets: int = 64
    bits: int = 1 << 24
    hashes: int = 7

    def _bucket(self, id_: str) -> Column:
        return F.pmod(F.xxhash64(F.col(id_), F.lit("bucket")), F.lit(self.buckets)).cast("int")

    def _words(self, ids: DataFrame) -> DataFrame:
        """event_id, bucket, word, bits: the word of the filter that must have these bits for an id to be known."""
        places = (F.pmod(F.xxhash64(F.col("event_id"), F.lit(k)), F.lit(64)).cast("int") for k in range(self.hashes))
        bits = reduce(lambda a, b: a.bitwiseOR(b), (F.call_function("shiftleft", F.lit(1).cast("bigint"), p) for p in places))
        word = F.pmod(F.xxhash64(F.col("event_id"), F.lit("word")), F.lit(max(1, self.bits // 64)))
        return ids.select("event_id", "bucket", word.alias("word"), bits.alias("bits"))

    def _others(self, batch: int) -> Column:
        return ~((F.col("load") == self.load) & (F.col("batch") == batch))

    def _table(self, name: str, ddl: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/{name}", schemas.struct(ddl), by_folder=True)

    def may_be_known(self, ids: DataFrame, batch: int) -> DataFrame:
        """Those of the ids (event_id, bucket) that no word of the other batches' filters denies."""
        stored = self._table("words", FILTER).where(self._others(batch)).groupBy("bucket", "word").agg(F.bit_or("bits").alias("there"))
        met = self._words(ids).join(stored, ["bucket", "word"])
        return met.where(F.col("there").bitwiseAND(F.col("bits")) == F.col("bits")).select("event_id", "bucket")

    def known(self, ids: DataFrame, batch: int) -> DataFrame:
        """Those of the ids that another batch has had. Only buckets with an id that may be known are read."""
        maybe = cut_lineage(self.may_be_known(ids, batch), "replay-maybe")
        buckets = sorted(r[0] for r in maybe.select("bucket").distinct().collect())
        if not buckets:
            return maybe.select("event_id")
        stored = self._table("ids", INDEX).where(F.col("bucket").isin(buckets) & self._others(batch)).select("event_id", "bucket")
        # an inner join, so that few ids are sent to the many that are stored
        return stored.join(maybe, ["event_id", "bucket"]).select("event_id").distinct()

    def ids(self, rows: DataFrame) -> DataFrame:
        """(event_id, bucket, times) of the rows that have an id, once each."""
        present = rows.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(F.count("*").alias("times"))
        return present.select("event_id", self._bucket("event_id").alias("bucket"), "times")

    def add(self, ids: DataFrame, batch: int) -> None:
        """Store the ids of a batch and their words."""
        part = f"load={self.load}/batch={batch}"
        own = self._words(ids).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        own.write.mode("overwrite").parquet(f"{self.root}/words/{part}")
        kept = ids.select("event_id", "bucket")
        kept.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/ids/{part}")

    def first_arrivals(self, rows: DataFrame, batch: int) -> DataFrame:
        """The rows whose event has not arrived in another batch, one per event; rows without an id stay apart from each other.

        The ids of this batch are stored. The rows are read for their ids alone, for the result, and once more for the ids that the batch
        itself repeats, if there are any. Only the rows of these are shuffled; the others meet the smaller of the new and the known ids.
        """
        ids = cut_lineage(self.ids(rows), "replay-ids")
        old = cut_lineage(self.known(ids, batch), "replay-known")
        new = ids.join(old, "event_id", "left_anti")
        self.add(new, batch)
        if 2 * old.count() > ids.count():
            own = self._table("ids", INDEX).where(~self._others(batch)).select("event_id", F.lit(True).alias(OWN))
            fresh = rows.join(own, "event_id", "left").where(F.col(OWN) | F.col("event_id").isNull()).select(*rows.columns)
        else:
            fresh = rows.join(old, "event_id", "left_anti")
        twice = cut_lineage(new.where("times > 1").select("event_id"), "replay-twice")
        if twice.isEmpty():
            return fresh.select(*rows.columns)
        first = F.row_number().over(Window.partitionBy("event_id").orderBy("event_id"))
        repeated = fresh.join(twice, "event_id", "left_semi").withColumn(OWN, first).where(F.col(OWN) == 1)
        return fresh.join(twice, "event_id", "left_anti").select(*rows.columns).unionByName(repeated.select(*rows.columns))
