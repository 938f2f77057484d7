"""Operator 1: language identification by multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.arrays import as_bytes, slices
from vulnlake.llm.bpe import LETTER, class_table
from vulnlake.llm.tables import pick

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
SMOOTHING = 0.1
# About so many documents of each language are learned from, chosen by a hash of their id.
SAMPLE = 4000
UNKNOWN = "und"
# Characters of a text that are turned into n-grams at once, and n-grams that are scored at once.
SPAN = 1 << 17
GRAMS = 1 << 18
# Fixed value: an odd multiplier for hashing.
SPREAD = 0x9E3779B97F4A7C15


@dataclass
class Model:
    """Languages in order, and log-probabilities: one row per bucket, one column per language."""

    languages: list[str]
    prior: np.ndarray
    table: np.ndarray


# ---- features ----------------------------------------------------------------------------------
def _points(text: bytes) -> np.ndarray:
    """Code points in lower case between two blanks; everything but letters is a blank."""
    points = np.frombuffer(text.decode().lower().encode("utf-32-le"), np.uint32)
    out = np.full(len(points) + 2, 32, np.uint32)
    out[1:-1] = np.where(class_table()[points] == LETTER, points, 32)
    return out


def _grams(points: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram at every place that has one."""
    n = len(points) - order + 1
    value = np.full(max(n, 0), order, np.uint64)
    for k in range(order):
        value = value * np.uint64(0x100000001B3) + points[k : k + len(value)]
    return ((value * np.uint64(SPREAD)) >> np.uint64(64 - (BUCKETS.bit_length() - 1))).astype(np.int64)


def _features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, buckets) of all n-grams, long texts in parts: no n-gram is lost or counted twice."""
    for row, text in enumerate(texts):
        points = _points(text)
        for at in range(0, len(points), SPAN):
            yield row, np.concatenate([_grams(points[at : at + SPAN + order - 1], order) for order in ORDERS])


def has_letter(text: bytes) -> bool:
    return bool((class_table()[np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)] == LETTER).any())


# ---- training ----------------------------------------------------------------------------------
def held_out(doc_id: Column) -> Column:
    """Is the document kept from training? Rows without an id have no remainder: they are not held out, and not learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _counts(docs: DataFrame) -> DataFrame:
    """lang, bucket, n of a frame with lang and text; one partial row per task, language and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for row, buckets in _features(as_bytes(batch.column(1))):
                own = total.setdefault(langs[row], np.zeros(BUCKETS, np.int64))
                own += np.bincount(buckets, minlength=BUCKETS)
        for lang, own in total.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])], names=["lang", "bucket", "n"]
            )

    return docs.mapInArrow(run, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from rows that have an id, a text and a language and are not held out.

    Priors count all such rows; n-grams come from about `sample` whole documents per language, chosen by a hash of the
    id. What reaches the driver is bounded by languages times buckets.
    """
    rows = pick(docs, doc_id, text, lang).toDF("doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    )
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((BUCKETS, 0), np.float32))
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, int((1 << 30) * min(1.0, sample / sizes[k])))))
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share[F.col("lang")])
    found = _counts(chosen.select("lang", "text")).toPandas()
    counts = np.zeros((len(languages), BUCKETS))
    np.add.at(counts, (np.searchsorted(languages, found["lang"].to_numpy(str)), found["bucket"].to_numpy(np.int64)), found["n"].to_numpy())
    table = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    prior = np.log(np.array([sizes[k] for k in languages], float))
    return Model(languages, prior - np.log(np.exp(prior).sum()), np.ascontiguousarray(table.T, np.float32))


# ---- prediction --------------------------------------------------------------------------------
def score(texts: list[bytes], model: Model) -> np.ndarray:
    """Posterior probabilities: rows are texts, columns languages. The n-grams of a batch are one sparse matrix in
    coordinate form, multiplied with the table by gathering its rows and summing them by text."""
    total = np.tile(model.prior, (len(texts), 1))
    waiting: list[tuple[int, np.ndarray]] = []

    def flush():
        if waiting:
            sizes = np.array([len(b) for _, b in waiting])
            values = model.table[np.concatenate([b for _, b in waiting])].astype(np.float64)
            np.add.at(total, [row for row, _ in waiting], np.add.reduceat(values, np.cumsum(sizes) - sizes, axis=0))
            waiting.clear()

    size = 0
    for row, buckets in _features(texts):
        waiting.append((row, buckets))
        size += len(buckets)
        if size > GRAMS:
            flush()
            size = 0
    flush()
    total -= total.max(axis=1, keepdims=True)
    total = np.exp(total)
    return total / total.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, into: str = "language") -> DataFrame:
    """The columns `keep` of `docs` (all by default) and, under the name `into`, a struct of lang_pred and score.

    A null text, or one without a letter, is `und` with score 0; so is everything if no language was learned. Equal
    scores go to the first language in order. Long texts are scored whole; repeated rows are rows of their own; an empty
    table gives an empty one. Columns of `docs` can have any names but `into`.
    """
    columns = docs.columns if keep is None else keep
    packed = docs.select(
        F.struct(*(F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns))).alias("row"), F.col(f"`{text}`").alias("text")
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    result = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for i, j in slices([len(t) for t in texts]):
                out = [{"lang_pred": UNKNOWN, "score": 0.0} for _ in range(i, j)]
                known = [k for k in range(i, j) if model.languages and has_letter(texts[k])]
                if known:
                    found = score([texts[k] for k in known], model)
                    for k, best, p in zip(known, found.argmax(axis=1).tolist(), found.max(axis=1).tolist()):
                        out[k - i] = {"lang_pred": model.languages[best], "score": p}
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(out, result)], names=["row", "language"])

    row = packed.schema["row"].dataType.simpleString()
    done = packed.mapInArrow(run, f"row {row}, language struct<lang_pred:string,score:double>")
    return done.select(*(F.col(f"row.v{i}").alias(c) for i, c in enumerate(columns)), F.col("language").alias(into))
