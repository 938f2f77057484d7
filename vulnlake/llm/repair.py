"""Operator 11: repair of the structure of conversations by Viterbi with survivor coalescence (`survivors`).

Rows of ordinary conversations are sorted in the task that holds them and streamed through the search, one conversation after the other.
A conversation of more than ROWS rows or BYTES bytes is never given to one search: it is sorted across ranges and cut into chunks. Each
chunk gives the cost and the order of the best edits from every state to every state; these small tables are chained
by the same rules, and each chunk is searched once more with the states it is entered and left in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from vulnlake.llm.positions import in_order
from vulnlake.llm.survivors import CUT, LOST, NEXT, OTHER, ROLES, SOUND, Survivors, advance_chunk, kind, transfer
from vulnlake.llm.tables import cut_lineage, pick

# A conversation beyond either is repaired in chunks.
ROWS = 1 << 14
BYTES = 1 << 26
# Rows of a chunk: 1 << CHUNK_BITS at most.
CHUNK_BITS = 12
# Rows that leave a task at once.
BATCH = 4096

BLANKS = " \t\n\x0b\f\r"
ENDS = ".!?"
# A null role or text.
NULL = " "

CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = ("", "blank", "duplicate", "truncated")
KIND = {CLEAN: SOUND, BLANK: LOST, DUPLICATE: LOST, TRUNCATED: CUT}
LEGAL = {"su", "ua", "au"}

EDITS = "turn bigint, place bigint, edit string, fault string, role string, text string"
DIGEST = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)


# ---- input -------------------------------------------------------------------------------------
def _named(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    named = pick(rows, conv_id, turn, role, text).toDF("conv_id", "turn", "role", "text")
    blank = F.lit(NULL)
    return named.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"))


def damage(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text and `copies` (0: dropped, 2: repeated) of every row, damaged by the CRC-32 of `conv_id:turn` modulo 20."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in ("conv_id", "turn")))
    code = F.crc32(key) % 20
    body = F.when(code == 1, F.lit("")).when(code == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    return _named(rows, conv_id, turn, role, text).select(
        "conv_id", "turn", F.when(code == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), body.alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"),
    )


def _flaw() -> Column:
    """Blank, truncated or clean, by the text alone."""
    ended = F.expr(f"trim(TRAILING '{BLANKS}' FROM text)")
    return F.when(ended == "", BLANK).when(~F.right(ended, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(CLEAN)


# ---- a conversation in one task ----------------------------------------------------------------
class Conversation:
    """Counters, search and results of one conversation whose rows come in order."""

    def __init__(self) -> None:
        self.seen: set[bytes] = set()
        self.search = Survivors()
        self.counts = [0] * len(FAULTS)
        self.illegal, self.cost = 0, 0
        self.last: str | None = None
        self.turns = Turns()

    def add(self, turn: int | None, role: str, text: str, flaw: int) -> list[tuple]:
        name = hashlib.blake2b(f"{role}\0{text}".encode(), digest_size=16, key=str(len(role)).encode()).digest()
        fault = flaw if flaw == BLANK or name not in self.seen else DUPLICATE
        self.seen.add(name)
        self.counts[fault] += 1
        self.turns.add(turn)
        if self.last is not None and self.last + role[:1] not in LEGAL:
            self.illegal += 1
        self.last = role[:1]
        return _spell(self.search.add((turn, role, text, fault), kind(role[:1], KIND[fault])))

    def end(self) -> list[tuple]:
        done, letters, state, self.cost = self.search.finish()
        return _spell(done) + _inserted(letters, state)


class Turns:
    """Gaps between the turns, which come in order."""

    def __init__(self) -> None:
        self.first: int | None = None
        self.last: int | None = None
        self.distinct = 0

    def add(self, turn: int | None) -> None:
        if turn is None or turn == self.last:
            return
        if self.first is None:
            self.first = turn
        self.last = turn
        self.distinct += 1

    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.distinct


def _inserted(letters: str, state: int) -> list[tuple]:
    """The inserted turns as edits (turn, edit, fault, role, text)."""
    out = []
    for _ in letters:
        state = NEXT[state]
        out.append((None, "I", CLEAN, ROLES[state], ""))
    return out


def _spell(settled: list[tuple[tuple, str, int, int]]) -> list[tuple]:
    """Edits (turn, edit, fault, role, text) of settled rows; kept and renamed ones with the role they end up with."""
    out = []
    for (turn, role, text, fault), letters, state, _ in settled:
        added = _inserted(letters[:-1], state)
        for _ in added:
            state = NEXT[state]
        edit = letters[-1]
        out += [*added, (turn, edit, fault, ROLES[NEXT[state]] if edit == "R" else role, text)]
    return out


class Digest:
    """Initials of the edits and the hash of the repaired conversation."""

    def __init__(self) -> None:
        self.audit, self.hash, self.any = bytearray(), hashlib.sha256(), False

    def add(self, edits: list[tuple]) -> None:
        for _, edit, _, role, text in edits:
            self.audit += edit.encode()
            if edit != "D":
                self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
                self.any = True

    def row(self) -> tuple[str, str]:
        return self.audit.decode(), self.hash.hexdigest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows as tuples, a part of a batch at a time; the first value says where another conversation starts."""
    before: object = _rows
    for batch in batches:
        for i in range(0, batch.num_rows, BATCH):
            for row in zip(*(c.to_pylist() for c in batch.slice(i, BATCH).columns)):
                yield row[0] != before, row
                before = row[0]


def _batch(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], names=names)


def _sorted(rows: DataFrame) -> DataFrame:
    """Whole conversations in one task each, rows by turn (null first), then role and text."""
    kept = rows.withColumn("flaw", _flaw()).select("conv_id", "turn", "role", "text", "flaw")
    return kept.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _types(frame: DataFrame, schema: str) -> tuple[StructType, list[str], list[pa.DataType]]:
    """Schema, names and Arrow types of a result that starts with the conversation's id."""
    of = frame.schema["conv_id"].dataType
    whole = StructType([StructField("conv_id", of), *_parse_datatype_string(schema).fields])
    return whole, whole.names, [to_arrow_type(f.dataType) for f in whole.fields]


def _small_edits(rows: DataFrame) -> DataFrame:
    schema, names, types = _types(rows, EDITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Conversation | None = None
        out: list[tuple] = []
        place, name = 0, None

        def give(edits: list[tuple]) -> None:
            nonlocal place
            for turn, edit, fault, role, text in edits:
                out.append((name, turn, place, edit, FAULTS[fault], role, text))
                place += 1

        for new, (conv, turn, role, text, flaw) in _rows(batches):
            if new:
                if own is not None:
                    give(own.end())
                own, place, name = Conversation(), 0, conv
            give(own.add(turn, role, text, flaw))
            if len(out) >= BATCH:
                yield _batch(names, types, out)
                out.clear()
        if own is not None:
            give(own.end())
        yield _batch(names, types, out)

    return _sorted(rows).mapInArrow(run, schema)


def _small_digests(rows: DataFrame) -> DataFrame:
    schema, names, types = _types(rows, DIGEST)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Conversation | None = None
        digest, out, name = Digest(), [], None

        def close() -> None:
            digest.add(own.end())
            out.append((name, own.turns.gaps(), *own.counts[1:], own.illegal, own.cost, *digest.row()))

        for new, (conv, turn, role, text, flaw) in _rows(batches):
            if new:
                if own is not None:
                    close()
                own, digest, name = Conversation(), Digest(), conv
                if len(out) >= BATCH:
                    yield _batch(names, types, out)
                    out.clear()
            digest.add(own.add(turn, role, text, flaw))
        if own is not None:
            close()
        yield _batch(names, types, out)

    return _sorted(rows).mapInArrow(run, schema)


# ---- a conversation in chunks ------------------------------------------------------------------
def _placed(rows: DataFrame) -> DataFrame:
    """Rows of large conversations in order, with their faults. `at` orders and names a row."""
    own = rows.withColumn("flaw", _flaw()).withColumn("row", F.monotonically_increasing_id())
    stored = cut_lineage(own.select("conv_id", "turn", "role", "text", "flaw", "row"), "repair-large")
    placed = in_order(stored, [F.col(c) for c in ("conv_id", "turn", "role", "text", "row")], "repair-order")
    # the first rows of their role and text, named by their place: a join without hot keys
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    first = placed.groupBy("conv_id", said.alias("said")).agg(F.min("at").alias("first")).select("first")
    marked = placed.join(first, F.col("at") == F.col("first"), "left")
    fault = F.when((F.col("flaw") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("flaw"))
    lost = fault.isin(BLANK, DUPLICATE)
    code = F.when(lost, LOST).when(fault == TRUNCATED, CUT).otherwise(SOUND)
    start = F.substring("role", 1, 1)
    initial = F.when(start == "s", 0).when(start == "u", 1).when(start == "a", 2).otherwise(OTHER)
    return cut_lineage(
        marked.select("conv_id", "at", F.shiftright("at", CHUNK_BITS).alias("chunk"), "turn", "role", "text", fault.alias("fault"),
                      (3 * initial + code).cast("int").alias("kind")),
        "repair-faults",
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """All rows of one chunk of one conversation."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:2] != held[-1][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _by_chunk(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id", "chunk").sortWithinPartitions("conv_id", "chunk", "at")


def _chunk_tables(placed: DataFrame) -> DataFrame:
    """Per chunk: the survivors' states and costs for each state it is entered in, illegal neighbours inside, outer initials."""
    schema, names, types = _types(placed, "chunk bigint, costs array<bigint>, first string, last string, illegal bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in _pieces(batches):
            kinds = [row[4] for row in rows]
            costs = [x for enter in range(4) for x in _packed(transfer(kinds, enter))]
            initials = [row[3] for row in rows]
            wrong = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            out.append((*rows[0][:2], costs, initials[0], initials[-1], wrong))
            if len(out) >= BATCH:
                yield _batch(names, types, out)
                out.clear()
        yield _batch(names, types, out)

    narrow = placed.select("conv_id", "chunk", "at", F.substring("role", 1, 1).alias("initial"), "kind")
    return _by_chunk(narrow).mapInArrow(run, schema)


def _packed(survivors: list[tuple[int, int]]) -> list[int]:
    return [len(survivors), *(x for pair in survivors for x in pair)]


def _unpacked(costs: list[int]) -> list[list[tuple[int, int]]]:
    out, i = [], 0
    for _ in range(4):
        own = costs[i + 1 : i + 1 + 2 * costs[i]]
        out.append(list(zip(own[::2], own[1::2])))
        i += 1 + 2 * costs[i]
    return out


def _chain(tables: DataFrame) -> DataFrame:
    """Per chunk the states it is entered and left in; a row with a null chunk has what follows the last one, from state `enter`.

    One row of some 30 numbers per chunk passes the task of its conversation, and the search settles as it goes.
    """
    schema, names, types = _types(tables, "chunk bigint, enter int, leave int, tail string, cost bigint, illegal bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search: Survivors | None = None
        out: list[tuple] = []
        name, wrong, last = None, 0, None

        def give(settled: list[tuple]) -> None:
            out.extend((name, chunk, before, after, None, None, None) for chunk, _, before, after in settled)

        def close() -> None:
            done, letters, state, cost = search.finish()
            give(done)
            out.append((name, None, state, None, letters, cost, wrong))

        for new, (conv, chunk, costs, first, ends, inside) in _rows(batches):
            if new:
                if search is not None:
                    close()
                search, name, wrong, last = Survivors(), conv, 0, None
            wrong += inside + (last is not None and last + first not in LEGAL)
            last = ends
            give(search.step(chunk, advance_chunk(search.alive, _unpacked(costs))))
            if len(out) >= BATCH:
                yield _batch(names, types, out)
                out.clear()
        if search is not None:
            close()
        yield _batch(names, types, out)

    return tables.repartition("conv_id").sortWithinPartitions("conv_id", "chunk").mapInArrow(run, schema)


def _chunk_letters(placed: DataFrame, chain: DataFrame) -> DataFrame:
    """(row, letters, state): the edits of every row and the state before them."""
    states = chain.where(F.col("chunk").isNotNull()).select(F.col("conv_id").alias("of"), F.col("chunk").alias("in"), "enter", "leave")
    narrow = placed.select("conv_id", "chunk", "at", "kind")
    joined = narrow.join(states, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("chunk") == F.col("in"))).drop("of", "in")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _pieces(batches):
            search = Survivors(rows[0][4])
            out = [x for row in rows for x in search.add(row[2], row[3])]
            out += search.finish(rows[0][5])[0]
            yield _batch(["row", "letters", "state"], [pa.int64(), pa.string(), pa.int32()], [x[:3] for x in out])

    return _by_chunk(joined).mapInArrow(run, "row bigint, letters string, state int")


def _large(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edits, ends) of large conversations; an end has the conversation's cost and its illegal neighbours."""
    placed = _placed(rows)
    chain = cut_lineage(_chain(_chunk_tables(placed)), "repair-chain")
    spelled = placed.join(_chunk_letters(placed, chain), F.col("at") == F.col("row"))
    schema, names, types = _types(placed, EDITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for _, (conv, at, turn, role, text, fault, letters, state) in _rows(batches):
            edits = _spell([((turn, role, text, fault), letters, state, None)])
            out += [(conv, t, 4 * at + k, e, FAULTS[f], r, x) for k, (t, e, f, r, x) in enumerate(edits)]
            if len(out) >= BATCH:
                yield _batch(names, types, out)
                out.clear()
        yield _batch(names, types, out)

    edits = spelled.select("conv_id", "at", "turn", "role", "text", "fault", "letters", "state").mapInArrow(run, schema)
    ends = chain.where(F.col("chunk").isNull())
    # inserted turns behind the last row: an assistant, or user and assistant
    turns = F.when(F.col("tail") == "I", F.array(F.lit("assistant"))).when(F.col("tail") == "II", F.array(F.lit("user"), F.lit("assistant")))
    behind = ends.select("conv_id", F.posexplode(turns).alias("k", "role")).select(
        "conv_id", F.lit(None).cast("long").alias("turn"), (F.lit(1 << 62) + F.col("k")).alias("place"), F.lit("I").alias("edit"),
        F.lit("").alias("fault"), "role", F.lit("").alias("text"),
    )
    return edits.unionByName(behind), ends.select(F.col("conv_id").alias("of"), "cost", "illegal")


def _large_digests(rows: DataFrame) -> DataFrame:
    """Digests of large conversations. A hash over a whole conversation is one sequence: its edits pass one task, a batch at a time."""
    edits, ends = _large(rows)
    schema, names, types = _types(edits, "gaps bigint, blank bigint, duplicate bigint, truncated bigint, audit string, repaired_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest: Digest | None = None
        turns, counts, name = Turns(), {}, None

        def row() -> pa.RecordBatch:
            return _batch(names, types, [(name, turns.gaps(), *(counts[x] for x in FAULTS[1:]), *digest.row())])

        for new, (conv, turn, edit, fault, role, text) in _rows(batches):
            if new:
                if digest is not None:
                    yield row()
                digest, turns, counts, name = Digest(), Turns(), dict.fromkeys(FAULTS, 0), conv
            turns.add(turn)
            counts[fault] += 1
            digest.add([(turn, edit, fault, role, text)])
        if digest is not None:
            yield row()

    ordered = edits.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    done = ordered.select("conv_id", "turn", "edit", "fault", "role", "text").mapInArrow(run, schema)
    return done.join(ends, F.col("conv_id").eqNullSafe(F.col("of"))).select("conv_id", *(x.split()[0] for x in DIGEST.split(", ")))


# ---- all conversations -------------------------------------------------------------------------
def _split(rows: DataFrame, most_rows: int, most_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(sizes, rows of ordinary conversations, rows of large ones or None), every row as often as `copies` says."""
    size = F.sum(F.col("copies").cast("long") * (F.octet_length("text") + F.octet_length("role")))
    sizes = cut_lineage(rows.groupBy("conv_id").agg(F.sum("copies").alias("rows"), size.alias("bytes")), "repair-sizes")
    large = sizes.where((F.col("rows") > most_rows) | (F.col("bytes") > most_bytes)).select(F.col("conv_id").alias("of"))
    whole = rows.where("copies > 0").withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copies", "copy")
    if large.isEmpty():
        return sizes, whole, None
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    return sizes, whole.join(large, same, "left_anti"), whole.join(large, same, "left_semi")


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    most_rows: int = ROWS, most_bytes: int = BYTES,
) -> DataFrame:
    """The edits of all conversations: conv_id, turn, place, edit, fault, role, text.

    `place` orders the edits of a conversation. The rows with the edits K (kept), R (renamed) and I (inserted, null turn, empty
    text) are the repaired conversation, D are the deleted rows. Rows of a conversation are taken by turn (null first),
    then role and text. A null role or text counts as one blank; null ids are one conversation; a repeated row is a duplicate; empty texts
    are blank. Equally cheap repairs are settled by their edits' initials. Long texts are held while their edit is open, at most the bytes of a conversation's limit; an empty table
    gives an empty one, and further columns are left out and can have any names.
    """
    _, small, large = _split(_named(rows, conv_id, turn, role, text).withColumn("copies", F.lit(1)), most_rows, most_bytes)
    done = _small_edits(small)
    return done if large is None else done.unionByName(_large(large)[0])


def audit(damaged: DataFrame, most_rows: int = ROWS, most_bytes: int = BYTES) -> DataFrame:
    """One row per conversation of the result of `damage`, also of one without rows left: its gaps, faults, cost, the initials of its edits and the
    SHA-256 of its repaired text. Nulls, ties, repeated rows and long texts are handled as in `repair`."""
    sizes, small, large = _split(damaged, most_rows, most_bytes)
    done = _small_digests(small)
    if large is not None:
        done = done.unionByName(_large_digests(large))
    zeros = [F.lit("").alias("audit"), F.sha2(F.lit("").cast("binary"), 256).alias("repaired_sha256")]
    names = [x.split()[0] for x in DIGEST.split(", ")]
    empty = sizes.where("rows = 0").select("conv_id", *(F.lit(0).cast("long").alias(x) for x in names[:-2]), *zeros)
    return done.unionByName(empty)
