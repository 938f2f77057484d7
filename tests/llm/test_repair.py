"""Operator 11 against plain versions of its rules, of the search and of its SQL."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from vulnlake.llm import queries, repair, survivors

from tests.check_oracle import compare, connect

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        code = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, wrong):
    """The least (cost, initials, repaired rows), by what the repaired roles end with ("" for none)."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def offer(into, end, initial, cost, audit, lines):
        if initial in tuple(follows[end]) and (initial not in into or (cost, audit) < into[initial][:2]):
            into[initial] = (cost, audit, lines)

    def with_inserts(states):
        for _ in range(2):
            more = dict(states)
            for end, (cost, audit, lines) in states.items():
                for role in ("user", "assistant"):
                    offer(more, end, role[0], cost + 5, audit + "I", (*lines, role + ":"))
            states = more
        return states

    now = {"": (0, "", ())}
    for (_, _, role, text), fault in zip(rows, wrong):
        after = {}
        for end, (cost, audit, lines) in with_inserts(now).items():
            if end not in after or (cost + 2, audit + "D") < after[end][:2]:
                after[end] = (cost + 2, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                torn = 5 if fault == "truncated" else 0
                offer(after, end, role[:1], cost + torn, audit + "K", (*lines, f"{role}:{text}"))
                for new in ("user", "assistant"):
                    offer(after, end, new[0], cost + torn + 1, audit + "R", (*lines, f"{new}:{text}"))
        now = after
    return min(v for end, v in with_inserts(now).items() if end in ("", "a"))


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = damaged([r for r in rows if r[0] == conv])
        wrong = faults(own)
        turns = [t for _, t, _, _ in own if t is not None]
        cost, audit, lines = cheapest(own, wrong) if own else (0, "", ())
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(wrong.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def got(frame):
    rows = frame.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "", " \t\n", "é.", "so?  ", None, "x\x0b", "a longer one, that ends"]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u2", "é"]
    return [
        (None if c == 0 else c, rng.choice([t, t, t, t + 2, None]), rng.choice(roles), rng.choice([*texts, f"{t}.", f"{t}!", f"{t}"]))
        for c in range(conversations) for t in range(rng.randrange(longest))
    ]


def exhaustive(kinds):
    """The least (cost, initials) over every way to edit."""
    ways = [(0, "", survivors.EMPTY)]

    def inserted(ways):
        out = ways
        for _ in range(2):
            ways = [(c + 5, a + "I", survivors.NEXT[s]) for c, a, s in ways]
            out = out + ways
        return out

    legal = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    for initial, fault in kinds:
        after = []
        for c, a, s in inserted(ways):
            after.append((c + 2, a + "D", s))
            if fault != survivors.LOST:
                torn = 5 * (fault == survivors.CUT)
                after.append((c + 1 + torn, a + "R", survivors.NEXT[s]))
                if (initial, s) in legal:
                    after.append((c + torn, a + "K", legal[initial, s]))
        ways = after
    return min((c, a) for c, a, s in inserted(ways) if s in (survivors.EMPTY, survivors.ASSISTANT))


def test_search_is_exact():
    every = list(itertools.product("suax", range(3)))
    rng = random.Random(1)
    cases = [c for n in range(4) for c in itertools.product(every, repeat=n)] + [tuple(rng.choices(every, k=4)) for _ in range(200)]
    for case in cases:
        search = survivors.Survivors()
        done = [x for i, (initial, fault) in enumerate(case) for x in search.add(i, survivors.kind(initial, fault))]
        rest, letters, _, cost = search.finish()
        done += rest
        assert [x[0] for x in done] == list(range(len(case)))
        assert (cost, "".join(x[1] for x in done) + letters) == exhaustive(case)


def test_settled_edits_leave_the_tree():
    """Only what the survivors do not share is held."""
    rng = random.Random(2)
    search, given = survivors.Survivors(), 0
    held = 0
    for i in range(20_000):
        given += len(search.add(i, survivors.kind(rng.choice("ua"), rng.choice([0, 0, 0, 1, 2]))))
        held = max(held, i + 1 - given)
    assert held < 200


def test_query_on_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op11_conversation_repair"](spark, SF)) == expected(rows)
    assert compare(queries.QUERIES["op11_conversation_repair"](spark, SF), connect(SF), queries.ORACLES["op11_conversation_repair"]) is None


@pytest.mark.parametrize("limits", [{}, {"most_rows": 2}, {"most_bytes": 30}])
def test_nulls_ties_and_repeats(spark, limits):
    rows = random_rows(3, 150, 14)
    rows += rows[::5]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as at", "2 as chunk", "3 as copies", "4 as `a.b`", "5 as flaw")
    assert got(repair.audit(repair.damage(frame), **limits)) == expected(rows)


def test_a_conversation_of_many_chunks(spark, monkeypatch):
    """One conversation in chunks of 16 rows, with long unsettled ties, gives what the plain search gives."""
    monkeypatch.setattr(repair, "CHUNK_BITS", 4)
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "tool", "x"]), f"{t % 50}." if t % 3 else "a") for t in range(1500)]
    rows += [(8, t, "tool", f"{t}.") for t in range(400)] + [(9, 1, "user", "the same.")] * 300
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = got(repair.audit(repair.damage(frame)))
    assert got(repair.audit(repair.damage(frame), most_rows=100)) == whole == expected(rows)


@pytest.mark.parametrize("limits", [{}, {"most_rows": 2}])
def test_edits_are_the_repaired_conversations(spark, limits):
    rows = random_rows(5, 60, 9)
    edits = repair.repair(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place"), **limits).collect()
    for conv in {r[0] for r in rows}:
        own = sorted(
            (tuple((" " if x is None else x) if i > 1 else x for i, x in enumerate(r)) for r in rows if r[0] == conv),
            key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]),
        )
        cost, audit, lines = cheapest(own, faults(own))
        mine = sorted((e for e in edits if e.conv_id == conv), key=lambda e: e.place)
        assert "".join(e.edit for e in mine) == audit
        assert tuple(f"{e.role}:{e.text}" for e in mine if e.edit != "D") == lines
        assert [(e.turn, e.fault) for e in mine if e.edit != "I"] == [(r[1], f) for r, f in zip(own, faults(own))]


def test_empty_table_and_long_texts(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.audit(repair.damage(none)).collect() == [] and repair.repair(none).collect() == []
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y" * 3_000_000), (2, 0, "user", "a.")]
    assert got(repair.audit(repair.damage(spark.createDataFrame(rows, SCHEMA)))) == expected(rows)
