"""Operator 3: document fingerprints by SimHash, with DataFrame functions only.

Terms are runs of five words. Every occurrence votes on 128 signed bits with the hash of its term, weighted by the length of its
first word: common words are short. Votes are sums inside a document, so they need no shuffle once a document's row is where it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vulnlake.llm.tables import cut_lineage, pick

TERM = 5
HEAVIEST = 15
BITS = 128
# Bits in which two fingerprints may differ to be found by the block tables.
RADIUS = 3
# Two counters share one 64-bit sum: bit j and bit j + 32 of a hash.
LANES = 0x0000000100000001
LOW = 0xFFFFFFFF


# ---- fingerprints ------------------------------------------------------------------------------
def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), "")


def terms(words: Column) -> Column:
    """array<struct<h, w>>: hash and weight of every run of TERM words; of the whole sequence if it is shorter.

    `words` must be a column and no expression: it is read for every term.
    """
    count = F.size(words)
    first = F.sequence(F.lit(1), F.greatest(F.lit(1), count - (TERM - 1)))
    every = F.transform(
        first,
        lambda i: F.struct(
            F.xxhash64(F.slice(words, i, TERM)).alias("h"),
            F.least(F.length(F.get(words, i - 1)), F.lit(HEAVIEST)).cast("long").alias("w"),
        ),
    )
    return F.when(count > 0, every)


def _sums() -> list[Column]:
    """For each of 32 places and both hashes the summed votes for a set bit, two counters in one number."""
    out = []
    for name in ("h", "h2"):
        for j in range(32):
            out.append(F.sum(F.shiftrightunsigned(F.col(name), j).bitwiseAND(F.lit(LANES)) * F.col("w")).alias(f"{name}_{j}"))
    return out


def _bits(name: str) -> Column:
    """The 64 bits whose votes weigh more than half of all."""
    value = F.lit(0).cast("long")
    for j in range(32):
        both = F.col(f"{name}_{j}")
        low = F.when(2 * both.bitwiseAND(F.lit(LOW)) > F.col("w"), F.lit(1 << j)).otherwise(F.lit(0)).cast("long")
        high = F.lit(-(1 << 63) if j == 31 else 1 << (j + 32))
        value = value.bitwiseOR(low).bitwiseOR(
            F.when(2 * F.shiftrightunsigned(both, 32) > F.col("w"), high).otherwise(F.lit(0)).cast("long")
        )
    return value


def fingerprints(texts: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, f1, f2: the two halves of the fingerprint of `text` for each key; zero without words.

    One row per key is expected. Where `texts` is already partitioned by some of the keys, nothing is shuffled.
    """
    split = texts.select(*keys, words(F.col(text)).alias("words"))
    votes = split.select(*keys, F.explode_outer(terms(F.col("words"))).alias("t")).select(
        *keys, F.col("t.h").alias("h"), F.xxhash64("t.h").alias("h2"), F.col("t.w").alias("w")
    )
    summed = votes.groupBy(*keys).agg(F.sum("w").alias("w"), *_sums())
    return summed.select(*keys, F.coalesce(_bits("h"), F.lit(0)).alias("f1"), F.coalesce(_bits("h2"), F.lit(0)).alias("f2"))


def distance(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def likeness(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Share of equal bits, 1 for equal fingerprints."""
    return 1 - distance(a1, a2, b1, b2) / F.lit(float(BITS))


def as_hex(f1: Column, f2: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(f1), 16, "0"), F.lpad(F.hex(f2), 16, "0")))


# ---- search ------------------------------------------------------------------------------------
def _blocks(f1: Column, f2: Column) -> list[Column]:
    """The RADIUS + 1 blocks of 32 bits."""
    return [F.shiftrightunsigned(f1, 32), f1.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(f2, 32), f2.bitwiseAND(F.lit(LOW))]


def _tables(prints: DataFrame) -> DataFrame:
    """Every fingerprint once per permuted table, keyed by the block that its permutation puts first."""
    blocks = _blocks(F.col("f1"), F.col("f2"))
    return prints.select("f1", "f2", F.posexplode(F.array(*blocks)).alias("t", "block"))


def near(queries: DataFrame, index: DataFrame) -> DataFrame:
    """q1, q2, f1, f2: all distinct fingerprints of `index` within RADIUS bits of each distinct one of `queries`.

    Both have f1 and f2. With RADIUS differing bits one of RADIUS + 1 blocks is equal; a pair comes from the first table in which it
    meets, so it comes once. Verification is part of the join: rows grow with the result only.
    """
    own = _tables(queries.select("f1", "f2").distinct()).select(F.col("f1").alias("q1"), F.col("f2").alias("q2"), "t", "block")
    other = _tables(index.select("f1", "f2").distinct())
    a, b = _blocks(F.col("q1"), F.col("q2")), _blocks(F.col("f1"), F.col("f2"))
    earlier = F.lit(False)
    for k in range(RADIUS):
        earlier = earlier | ((F.col("x.t") > k) & (a[k] == b[k]))
    return own.alias("x").join(
        other.alias("y"),
        (F.col("x.t") == F.col("y.t")) & (F.col("x.block") == F.col("y.block"))
        & (distance(F.col("q1"), F.col("q2"), F.col("f1"), F.col("f2")) <= RADIUS) & ~earlier,
    ).select("q1", "q2", "f1", "f2")


# ---- operator ----------------------------------------------------------------------------------
def _key(doc_id: str, mark: str) -> Column:
    """Id and text hash as one text without nulls, so that joins, windows and sums on it share one shuffle."""
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.col(mark).cast("string"))


def _order(docs: DataFrame) -> DataFrame:
    """k, doc_id, n_chars, times, next_k, prev_k, prev_chars: documents in ascending order of (doc_id, mark), in a ring.

    Slim rows are dealt into ranges; neighbours across ranges come from the first and last row of each.
    """
    slim = docs.groupBy("doc_id", "mark").agg(F.min("n_chars").alias("n_chars"), F.count("*").alias("times"))
    ranged = slim.repartitionByRange("doc_id", "mark").withColumn("part", F.spark_partition_id())
    ranged = cut_lineage(ranged, "simhash-order").withColumn("k", _key("doc_id", "mark"))
    row = F.struct("doc_id", "mark", "k", "n_chars")
    inside = Window.partitionBy("part").orderBy("doc_id", "mark")
    inner = ranged.withColumn("next", F.lead(row).over(inside)).withColumn("prev", F.lag(row).over(inside))
    ends = ranged.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    # one row per range of the slim table
    ring = Window.orderBy("part")
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "part",
        F.coalesce(F.lead("first").over(ring), F.first("first").over(whole)).alias("after"),
        F.coalesce(F.lag("last").over(ring), F.last("last").over(whole)).alias("before"),
    )
    linked = inner.join(ends, "part").withColumns({"next": F.coalesce("next", "after"), "prev": F.coalesce("prev", "before")})
    return cut_lineage(
        linked.select(
            "k", "doc_id", "n_chars", "times", F.col("next.k").alias("next_k"), F.col("prev.k").alias("prev_k"),
            F.col("prev.n_chars").alias("prev_chars"),
        ),
        "simhash-ring",
    )


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the halves f1, f2.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next document.
    Documents follow each other by doc_id and, among equal ids, by the hash of their text; null ids come first, and the
    last is followed by the first. A null text is empty. Repeated rows are one document in that order and come out
    as often as they went in. Whole texts are shuffled once; only the beginnings that their predecessors need travel besides.
    """
    own = pick(docs, doc_id, text).toDF("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    own = own.select("doc_id", F.xxhash64("text").alias("mark"), "text")
    ring = _order(own.select("doc_id", "mark", F.length("text").cast("long").alias("n_chars")))

    once = F.row_number().over(Window.partitionBy("k").orderBy("k"))
    distinct = own.select(_key("doc_id", "mark").alias("k"), "text").withColumn("once", once).where("once = 1").drop("once")
    sent = ring.select("k", "prev_k", F.floor(F.col("prev_chars") / 2).cast("int").alias("need"))
    heads = distinct.join(sent, "k").select(
        F.col("prev_k").alias("k"), F.substring(F.col("text"), F.lit(1), F.col("need")).alias("head")
    )
    n = F.length("text")
    kept = F.substring(F.col("text"), F.lit(1), n - F.floor(n / 2).cast("int"))
    edited = distinct.join(heads, "k").select("k", "text", F.concat(kept, F.col("head")).alias("edited"))
    kinds = F.array(
        F.struct(F.lit(0).alias("kind"), F.col("text").alias("body"), F.lit(None).cast("string").alias("sha")),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("body"), F.sha2("edited", 256).alias("sha")),
    )
    both = edited.select("k", F.explode(kinds).alias("x")).select("k", "x.kind", "x.sha", "x.body")
    prints = cut_lineage(fingerprints(both, ["k", "kind", "sha"], "body"), "simhash-prints")

    plain = prints.where("kind = 0").select("k", "f1", "f2")
    changed = prints.where("kind = 1").select("k", "sha", F.col("f1").alias("e1"), F.col("f2").alias("e2"))
    following = plain.toDF("next_k", "n1", "n2")
    joined = plain.join(changed, "k").join(ring, "k").join(following, "next_k")
    f1, f2 = F.col("f1"), F.col("f2")
    return joined.select(
        "doc_id", "n_chars", F.col("sha").alias("edited_sha256"),
        as_hex(f1, f2).alias("fingerprint"), as_hex(F.col("e1"), F.col("e2")).alias("edited_fingerprint"),
        likeness(f1, f2, F.col("e1"), F.col("e2")).alias("near_edited"),
        likeness(f1, f2, F.col("n1"), F.col("n2")).alias("near_next"),
        "f1", "f2", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy"),
    ).drop("copy")


def with_neighbours(prints: DataFrame, asked: Column) -> DataFrame:
    """`prints` and `n_near`: for rows that are `asked`, how many other rows have a fingerprint within RADIUS bits; else null."""
    prints = cut_lineage(prints, "simhash-rows")
    counts = prints.groupBy("f1", "f2").agg(F.count("*").alias("rows"))
    pairs = near(prints.where(asked), counts).join(counts, ["f1", "f2"])
    found = pairs.groupBy("q1", "q2").agg((F.sum("rows") - 1).alias("n_near"))
    joined = prints.join(found, (F.col("f1") == F.col("q1")) & (F.col("f2") == F.col("q2")), "left").drop("q1", "q2")
    return joined.withColumn("n_near", F.when(asked, F.col("n_near")))
