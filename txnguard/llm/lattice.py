"""Cheapest edits that give a conversation its form, by bidirectional Dijkstra over the edit lattice.

A node is (rows done, state). States follow the form ``(s?(ua)+)?`` of role initials. Searches from both
ends meet; all equal-cost crossings are finished, and of those the least audit is picked.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = (EMPTY, SYSTEM, USER, ASSISTANT)
#: Where a conversation may end.
DONE = (EMPTY, ASSISTANT)
_NEXT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_RENAMED = "ua"
_REROLE, _DELETE, _INSERT, _CUT = 2, 3, 2, 1

#: A row's symbol: its role's initial (x for all others), in upper case if the text is cut off; or this
#: one if the row has to go.
GONE = "D"
_SYMBOLS = "suaxSUAX" + GONE


def _row_edges(symbol: str) -> list[tuple[int, str, int, int]]:
    """(cost, letter, from state, to state) of the edits of a row."""
    edges = [(_DELETE, "D", s, s) for s in STATES]
    if symbol != GONE:
        extra = _CUT if symbol.isupper() else 0
        edges += [(extra, "K", a, b) for (a, c), b in _NEXT.items() if c == symbol.lower()]
        edges += [(_REROLE + extra, "R", a, b) for (a, c), b in _NEXT.items() if c in _RENAMED]
    return edges


def _by(end: int, edges: list[tuple[int, str, int, int]]) -> list[list[tuple[int, str, int]]]:
    """Per state at one end: (cost, letter, state at the other end)."""
    return [[(e[0], e[1], e[5 - end]) for e in edges if e[end] == s] for s in STATES]


_ROWS = {end: {c: _by(end, _row_edges(c)) for c in _SYMBOLS} for end in (2, 3)}
_INSERTS = {end: _by(end, [(_INSERT, "I", a, b) for (a, c), b in _NEXT.items() if c in _RENAMED]) for end in (2, 3)}


class _Search:
    """One of the two searches. Nodes are settled by cost, and of equal cost in the direction of travel,
    as rows that are kept cost nothing."""

    def __init__(self, signature: str, step: int, begin: list[tuple[int, int]]) -> None:
        self.signature, self.step = signature, step
        end = 2 if step > 0 else 3
        self.rows, self.inserts = _ROWS[end], _INSERTS[end]
        self.best = {node: (0, "") for node in begin}
        self.settled: set[tuple[int, int]] = set()
        self.heap = [(0, step * i, (i, state)) for i, state in begin]
        heapq.heapify(self.heap)

    def least(self) -> int | None:
        while self.heap and self.heap[0][2] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> list[tuple[int, int]]:
        """Settles the next node; gives those that became cheaper by it."""
        node = heapq.heappop(self.heap)[2]
        self.settled.add(node)
        (i, state), (cost, audit) = node, self.best[node]
        edges = [(c, x, (i, s)) for c, x, s in self.inserts[state]]
        at = i if self.step > 0 else i - 1
        if 0 <= at < len(self.signature):
            edges += [(c, x, (i + self.step, s)) for c, x, s in self.rows[self.signature[at]][state]]
        changed = []
        for more, letter, to in edges:
            found = (cost + more, audit + letter if self.step > 0 else letter + audit)
            if to not in self.best or found < self.best[to]:
                self.best[to] = found
                heapq.heappush(self.heap, (found[0], self.step * to[0], to))
                changed.append(to)
        return changed


def search(signature: str, start: int, goals: tuple[int, ...]) -> tuple[int, str] | None:
    """(cost, least audit) of the cheapest edits from a state to one of others; None if there are none.

    Of two audits of equal cost to one node none begins with the other, so the least parts make the
    least whole.
    """
    ahead = _Search(signature, 1, [(0, start)])
    back = _Search(signature, -1, [(len(signature), g) for g in goals])
    shortest = 0 if (0, start) in back.best else None
    while (a := ahead.least()) is not None and (b := back.least()) is not None:
        if shortest is not None and a + b > shortest:
            break
        side, other = (ahead, back) if a <= b else (back, ahead)
        for node in side.settle():
            if node in other.best:
                total = side.best[node][0] + other.best[node][0]
                shortest = total if shortest is None else min(shortest, total)
    if shortest is None:
        return None
    met = ahead.best.keys() & back.best.keys()
    whole = [(ahead.best[x][0] + back.best[x][0], ahead.best[x][1] + back.best[x][1]) for x in met]
    return min(whole)


@lru_cache(maxsize=50_000)
def repair_plan(signature: str) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    return search(signature, EMPTY, DONE)


def passages(signature: str) -> list[tuple[int, int, int, str]]:
    """(from state, to state, cost, audit) through a part of a long conversation."""
    found = [(a, b, search(signature, a, (b,))) for a in STATES for b in STATES]
    return [(a, b, *x) for a, b, x in found if x]


def joined(parts: list[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of a conversation by the passages through its parts, from the last to the first."""
    rest = {s: (0, "") for s in DONE}
    for part in reversed(parts):
        onward: dict[int, tuple[int, str]] = {}
        for a, b, cost, audit in part:
            if b in rest:
                found = (cost + rest[b][0], audit + rest[b][1])
                onward[a] = min(found, onward.get(a, found))
        rest = onward
    return rest[EMPTY]


def rows_left(audit: str, before: int = 0, total: int | None = None) -> tuple[list[int], list[str | None]]:
    """Per row of the repaired conversation: the number of its source row, -1 if inserted, and its new
    role, None if it keeps its own. ``before`` rows of ``total`` come ahead of those of this audit.

    The form leaves one role for each place: an odd number of rows begins with the system's.
    """
    kept = sum(x != "D" for x in audit)
    odd = (kept if total is None else total) % 2
    source, roles, row, place = [], [], 0, before
    for letter in audit:
        if letter != "D":
            source.append(-1 if letter == "I" else row)
            roles.append(None if letter == "K" else ("assistant", "user")[(place - odd) % 2 == 0])
            place += 1
        row += letter != "I"
    return source, roles


def pieces(audit: str, lengths: list[int]) -> list[tuple[str, int, int]]:
    """The audit cut by parts of so many rows: (piece, rows left ahead of it, rows left in all)."""
    total, at, before, out = sum(x != "D" for x in audit), 0, 0, []
    for k, length in enumerate(lengths):
        end, rows = at, 0
        while end < len(audit) and (rows < length or k == len(lengths) - 1):
            rows += audit[end] != "I"
            end += 1
        out.append((audit[at:end], before, total))
        before += sum(x != "D" for x in audit[at:end])
        at = end
    return out
