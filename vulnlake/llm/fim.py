"""Operator 12: fill-in-middle transformation of whole texts, cut at line ends.

Both cut ranks come from a hash of the document's id. An indexable skip list over the lines of a text (`skip_list`) leads to the
code points and bytes before each cut, so that a text is sliced twice and never split into its lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vulnlake.llm.arrays import as_bytes
from vulnlake.llm.skip_list import SkipList
from vulnlake.llm.tables import pick

# Marks of the three parts. A text that holds one of them stays as it is, as it could not be told apart again.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
# Share of texts that are transformed, and of these the share in suffix-first order, in per cent.
RATE = 100
SUFFIX_FIRST = 50

SCHEMA = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers of a document, from the hex SHA-256 of `seed:doc_id` (a null id: empty)."""
    digits = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(text: bytes, doc_id: object, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    lines = SkipList(text)
    one, two, three, four = draws(doc_id, seed)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or any(m in text for m in marks) or three % 100 >= rate:
        return lines.units, "plain", None, None, text
    low, high = sorted((one % (lines.units + 1), two % (lines.units + 1)))
    (chars, start), (more, stop) = lines.reach(low), lines.reach(high)
    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
    p, s, m = marks
    if four % 100 < suffix_first:
        return lines.units, "spm", chars, more - chars, b"".join((s, suffix, p, prefix, m, middle))
    return lines.units, "psm", chars, more - chars, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """One row per document: doc_id, n, form (`plain`, `psm`, `spm`), prefix_chars, middle_chars, output.

    A null text is an empty one, and an empty text has no line and the form `plain`; so has a text that holds a mark. Long texts need
    memory for themselves and their output, and no more than a few bytes per 256 kB besides. Equal ids have equal draws, so repeated rows
    give repeated results; ties (both cuts at one place) give an empty middle. An empty table gives an empty one; further
    columns are left out and can have any names.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # texts and outputs leave one at a time: a batch of long ones would be held three times over
            names, texts = batch.column(1).to_pylist(), batch.column(2)
            held, size, first = [], 0, 0
            for i, name in enumerate(names):
                own = rearrange(as_bytes(texts.slice(i, 1))[0], name, seed, rate, suffix_first)
                held.append(own)
                size += len(own[-1])
                if size > 1 << 22 or i + 1 == len(names):
                    columns = [pa.array(x, t) for x, t in zip(zip(*held), _TYPES)]
                    columns[-1] = columns[-1].cast(pa.string())
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(held)), *columns], names=_NAMES)
                    held, size, first = [], 0, i + 1

    own = pick(docs, doc_id, text).toDF("doc_id", "text")
    own = own.select("doc_id", F.col("doc_id").cast("string").alias("name"), "text")
    return own.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")


_NAMES = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


def restore(output: Column, form: Column) -> Column:
    """The text that `output` was made of. A marked output holds every mark once, which tells its parts."""

    def after(mark: str, until: str | None = None) -> Column:
        start = F.instr(output, mark) + len(mark)
        length = F.length(output) if until is None else F.instr(output, until) - start
        return F.substring(output, start, length)

    psm = F.concat(after(PREFIX, SUFFIX), after(MIDDLE), after(SUFFIX, MIDDLE))
    spm = F.concat(after(PREFIX, MIDDLE), after(MIDDLE), after(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
