"""Cheapest edits of a sequence of turns by Viterbi with survivor coalescence.

Four states say what the repaired conversation ends with: nothing, the system turn, a user turn, an assistant turn. Each state has at most one
survivor: the cheapest edits that lead there, of equally cheap ones those whose initials are least. Survivors are leaves of a tree of back
pointers. A node counts the nodes that refer to it and goes when none does; once the root has one child, all survivors share
it, and its edits are given out. So only the part that is not yet settled is held.

Ties compare the complete unsettled edits. From one root two survivors never have equal edits, nor is one the beginning of the other
(inserted turns go before a row's own edit, and the state follows from the edits). So their order, once known, decides all later
comparisons, and it is kept from row to row as the order of the list of survivors.
"""

from __future__ import annotations

from functools import cache

# States of the repaired conversation, and the state after one more turn of user or assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Kinds of rows: initial of the role (system, user, assistant, other) and what is wrong with it.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER = 3
SOUND, LOST, CUT = range(3)

RENAME, DELETE, INSERT, TORN = 1, 2, 5, 5
# Least cost that the first state needs besides the second one's, whatever follows: a survivor that is dearer than another by more
# than this can neither win nor tie.
BRIDGE = (
    (0, 0, INSERT, 0),
    (2 * INSERT + DELETE, 0, INSERT, 2 * INSERT),
    (INSERT + DELETE, INSERT, 0, INSERT),
    (DELETE, 0, INSERT, 0),
)


def kind(initial: str, fault: int) -> int:
    return 3 * INITIALS.get(initial, OTHER) + fault


def after_inserts(state: int, inserts: int) -> int:
    for _ in range(inserts):
        state = NEXT[state]
    return state


def _kept(state: int, initial: int) -> int | None:
    """The state after a row that keeps its role."""
    if initial == 0:
        return SYSTEM if state == EMPTY else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


@cache
def moves(state: int, row: int) -> dict[int, tuple[int, str]]:
    """Per state that a row leads to: the least (cost, letters), turns inserted before the row included."""
    initial, fault = divmod(row, 3)
    best: dict[int, tuple[int, str]] = {}

    def offer(to: int | None, cost: int, letters: str) -> None:
        if to is not None and (to not in best or (cost, letters) < best[to]):
            best[to] = (cost, letters)

    for inserts in range(3):
        here, paid, letters = after_inserts(state, inserts), INSERT * inserts, "I" * inserts
        offer(here, paid + DELETE, letters + "D")
        if fault != LOST:
            torn = TORN if fault == CUT else 0
            offer(_kept(here, initial), paid + torn, letters + "K")
            offer(NEXT[here], paid + torn + RENAME, letters + "R")
    return best


@cache
def advance(alive: tuple[tuple[int, int], ...], row: int) -> tuple[int, tuple, tuple]:
    """One row: (cost of all, survivors, (index of the survivor it comes from, letters) of each).

    `alive` lists (state, cost) in the order of the edits so far; costs are over the cheapest one.
    """
    found: dict[int, tuple[int, int, str]] = {}
    for i, (state, cost) in enumerate(alive):
        for to, (more, letters) in moves(state, row).items():
            new = (cost + more, i, letters)
            if to not in found or new < found[to]:
                found[to] = new
    return _survive(found)


def advance_chunk(alive: tuple[tuple[int, int], ...], table: list[list[tuple[int, int]]]) -> tuple[int, tuple, tuple]:
    """The same for a chunk of rows; `table` has, for every state it is entered in, the survivors of `transfer` with their costs."""
    found: dict[int, tuple] = {}
    for i, (state, cost) in enumerate(alive):
        for j, (to, more) in enumerate(table[state]):
            new = (cost + more, i, j)
            if to not in found or new < found[to]:
                found[to] = new
    return _survive(found)


def _survive(found: dict[int, tuple]) -> tuple[int, tuple, tuple]:
    """Survivors in the order of their edits, without those that are dearer than another by more than what parts their states."""
    kept = sorted(
        (i, last, state, cost) for state, (cost, i, last) in found.items()
        if all(cost <= other[0] + BRIDGE[rival][state] for rival, other in found.items())
    )
    least = min(cost for *_, cost in kept)
    return least, tuple((state, cost - least) for _, _, state, cost in kept), tuple((i, last) for i, last, _, _ in kept)


def endings(alive: tuple[tuple[int, int], ...], leave: int | None) -> tuple[int, int, str]:
    """(cost, index, letters) of the best survivor: the one in state `leave`, or, if None, one whose conversation may end."""
    if leave is not None:
        return next((cost, i, "") for i, (state, cost) in enumerate(alive) if state == leave)
    ends = {EMPTY: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
    return min((cost + INSERT * len(ends[state]), i, ends[state]) for i, (state, cost) in enumerate(alive))


class _Node:
    __slots__ = ("above", "below", "letters", "row", "state")

    def __init__(self, above: _Node | None, letters: str, row: object, state: int) -> None:
        self.above, self.below, self.letters, self.row, self.state = above, [], letters, row, state
        if above is not None:
            above.below.append(self)


class Survivors:
    """The survivors of one conversation, or of a part of it that is entered in state `enter`."""

    def __init__(self, enter: int = EMPTY) -> None:
        self.root = _Node(None, "", None, enter)
        self.leaves = [self.root]
        self.alive: tuple[tuple[int, int], ...] = ((enter, 0),)
        self.cost = 0

    def add(self, row: object, row_kind: int) -> list[tuple[object, str, int, int]]:
        """One more row; the edits that are settled now, as (row, letters, state before them, state after them)."""
        return self.step(row, advance(self.alive, row_kind))

    def step(self, row: object, advanced: tuple[int, tuple, tuple]) -> list[tuple]:
        least, self.alive, steps = advanced
        self.cost += least
        old = self.leaves
        self.leaves = [_Node(old[i], letters, row, state) for (i, letters), (state, _) in zip(steps, self.alive)]
        for leaf in old:
            self._drop(leaf)
        return self._settled()

    def finish(self, leave: int | None = None) -> tuple[list[tuple[object, str, int, int]], str, int, int]:
        """(the edits that were open, letters after the last row, the state before these, cost of all)."""
        cost, i, letters = endings(self.alive, leave)
        kept, others = self.leaves[i], self.leaves
        self.leaves = [kept]
        for leaf in others:
            if leaf is not kept:
                self._drop(leaf)
        done = self._settled()
        return done, letters, kept.state, self.cost + cost

    def _drop(self, node: _Node) -> None:
        """Free a node that nothing refers to, and those above that nothing refers to then."""
        while not node.below and node is not self.root and node not in self.leaves:
            above = node.above
            above.below.remove(node)
            node = above

    def _settled(self) -> list[tuple[object, str, int, int]]:
        out = []
        while len(self.root.below) == 1 and self.root not in self.leaves:
            child = self.root.below[0]
            out.append((child.row, child.letters, self.root.state, child.state))
            child.above = None
            self.root = child
        return out


def transfer(kinds: list[int], enter: int) -> list[tuple[int, int]]:
    """(state, cost) of the survivors after the rows, in the order of their edits, entered in state `enter`."""
    total, alive = 0, ((enter, 0),)
    for row in kinds:
        least, alive, _ = advance(alive, row)
        total += least
    return [(state, total + cost) for state, cost in alive]
