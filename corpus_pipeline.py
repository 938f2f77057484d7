"""From raw documents to packed training sequences.

Stages: language identification, SimHash near-duplicates, repeated strings, secrets, packing. Every stage works on all that its
predecessor kept, is written as Parquet to the shared folder and read again; all but the last return the columns of
`documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnlake.llm import golay, langid, near_copies, packing, secret_scan, suffixes
from vulnlake.llm.tables import configure, cut_lineage, free_name, pick, table

# A document stays if its language is known with at least this probability.
LEAST_SCORE = 0.5
TOKENIZER = "byte_bpe_50k.json"
# A repeated passage has at least so many words. Its strings are found by windows shorter than 50 words are in any of the languages.
PASSAGE_WORDS = 50
PASSAGE_WINDOW = 256
PASSAGE_GRAM = 32


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with n_chars for the text as it is now."""
    return pick(docs.withColumn("n_chars", F.length("text").cast("long")), *columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, with a null or empty text, or of uncertain language go. `lang` stays as it was given.

    Where no language can be learned, none is uncertain: all documents with a letter stay. Long texts are judged whole, repeated rows
    alike; equal scores go to the first language in order; an empty table gives an empty one. Further columns stay.
    """
    configure(spark)
    model = langid.train(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    into = free_name(docs, "language")
    found = langid.predict(docs, model, into=into)
    kept = (F.col(f"{into}.lang_pred") != langid.UNKNOWN) & (F.col(f"{into}.score") >= LEAST_SCORE)
    return pick(found.where(kept), *docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one with the smallest id. Near-duplicates share five-word shingles with a
    likeness of 0.8 or more.

    Null and empty texts are copies of each other, as are repeated rows, of which one stays; long texts are read whole; an empty table
    gives an empty one. Further columns stay.
    """
    configure(spark)
    return golay.keep_one(docs, groups=near_copies.near_copies)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that occur more than once go, in all places; documents stay, with what is left of them.

    Strings are found byte by byte in windows of PASSAGE_WINDOW bytes; maximal runs of them with fewer words stay. Null texts stay null and empty ones
    empty; a document may lose all its text; repeated rows repeat each other; an empty table gives an empty one. Further columns stay.
    """
    configure(spark)
    into = free_name(docs, "repeats")
    done = suffixes.remove_repeats(docs, window=PASSAGE_WINDOW, gram=PASSAGE_GRAM, least_words=PASSAGE_WORDS, into=into)
    return _counted(done.withColumn("text", F.col(f"{into}.text")), docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; documents stay.

    Null texts stay null, empty ones empty, a null source counts as empty; long texts are read whole; repeated rows are masked
    alike; an empty table gives an empty one. Further columns stay.
    """
    configure(spark)
    return _counted(secret_scan.mask(docs, secret_scan.learn(docs)), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens.

    A null or empty text is its end token alone; long texts are cut; repeated rows are documents of their own; an empty table gives an
    empty one. Further columns end here.
    """
    configure(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), added=True)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", remove_repeated_strings),
    ("secret_scan", mask_secrets),
    ("best_fit_packing", pack_sequences),
]

# Hashes, suffix orders, the forest and the tokeniser have no counterpart in SQL; tests/llm compares the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the documents of `sf_dir`."""
    docs = table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
