"""Cheapest edits of conversations by dynamic programming over a Re-Pair grammar of their turns.

A conversation is a string of letters, one a turn: its role (``s``, ``u``, ``a``, other) and its fault. The edits
must lead to the roles ``(s?(ua)+)?``, whose automaton has four states: nothing yet, and after s, u, a. What a
letter can do is a 4 x 4 matrix: from each state to each, the least cost and, among the cheapest, the least audit
(a string of edits' initials). Matrices multiply by adding costs and joining audits, and taking the least. Audits of
one stretch and one cost are never prefixes of each other (both have a letter for each turn; what one had more would
be paid inserts), so the least of joined audits is joined of least ones.

Re-Pair replaces the most frequent pair of neighbours in all strings by a new symbol, again and again. Each rule's
matrix is made once from those of its two symbols and serves all strings; audits are ropes that share their parts.
"""

from __future__ import annotations

import numpy as np

START, S, U, A = range(4)
KEEP, REROLE, DELETE, INSERT = "KRDI"  # their order decides between audits: D, I, K, R
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)  # faults
ROLES = "sua"  # any other role is number 3
LEAST_USE = 4  # a rule must be used so often to be worth its matrix


def letter(role: int, fault: int) -> str:
    return chr(65 + 4 * role + fault)


class Rope:
    """A string made of two; written out only when it is needed."""

    __slots__ = ("left", "right", "flat")

    def __init__(self, left: Rope | None = None, right: Rope | None = None, flat: str | None = None):
        self.left, self.right, self.flat = left, right, flat

    def text(self) -> str:
        if self.flat is None:
            parts, todo = [], [self]
            while todo:
                rope = todo.pop()
                if rope.flat is None:
                    todo += [rope.right, rope.left]
                else:
                    parts.append(rope.flat)
            self.flat, self.left, self.right = "".join(parts), None, None
        return self.flat


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def _better(new: Entry, old: Entry) -> bool:
    return old is None or new[0] < old[0] or (new[0] == old[0] and new[1].text() < old[1].text())


def times(x: Matrix, y: Matrix) -> Matrix:
    """First x, then y. ``x`` may be a single row."""
    out = []
    for row in x:
        line: list[Entry] = [None] * 4
        for to in range(4):
            for via, first in enumerate(row):
                then = y[via][to]
                if first is None or then is None:
                    continue
                cost = first[0] + then[0]
                if line[to] is None or cost <= line[to][0]:
                    new = (cost, Rope(first[1], then[1]))
                    if _better(new, line[to]):
                        line[to] = new
        out.append(line)
    return out


def _matrix(steps: list[tuple[int, int, int, str]]) -> Matrix:
    out: Matrix = [[None] * 4 for _ in range(4)]
    for p, q, cost, audit in steps:
        new = (cost, Rope(flat=audit))
        if _better(new, out[p][q]):
            out[p][q] = new
    return out


NOTHING = _matrix([(p, p, 0, "") for p in range(4)])
_insert = _matrix([(p, U, INSERT_COST, INSERT) for p in (START, S, A)] + [(U, A, INSERT_COST, INSERT)])
_two = times(_insert, _insert)
# up to two inserts: a third would come back to a state that one insert reaches
INSERTS = _matrix([(p, q, m[p][q][0], m[p][q][1].text()) for m in (NOTHING, _insert, _two) for p in range(4) for q in range(4) if m[p][q]])


def letter_matrix(which: str) -> Matrix:
    """Inserts, then what becomes of the turn."""
    role, fault = divmod(ord(which) - 65, 4)
    steps = [(p, p, DELETE_COST, DELETE) for p in range(4)]
    if fault in (FINE, TRUNCATED):
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        user, assistant = [(p, U) for p in (START, S, A)], [(U, A)]
        kept = ([(START, S)], user, assistant, [])[role]
        steps += [(p, q, extra, KEEP) for p, q in kept]
        steps += [(p, q, extra + REROLE_COST, REROLE) for p, q in user + assistant]
    return times(INSERTS, _matrix(steps))


def finished(row: list[Entry]) -> tuple[int, str]:
    """Cost and audit of the cheapest way from a row of states to an end, inserts behind the last turn included."""
    ends = times([row], INSERTS)[0]
    best = min((e[0], e[1].text()) for e in (ends[START], ends[A]) if e is not None)
    return best


def re_pair(strings: list[list[int]], symbols: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Rules (left, right) for the symbols from ``symbols`` on, and the strings written with them."""
    gap = -1
    s = np.array([x for string in strings for x in (*string, gap)], np.int64)
    rules: list[tuple[int, int]] = []
    while len(s) > 1:
        size = symbols + len(rules)
        keys = np.where((s[:-1] != gap) & (s[1:] != gap), s[:-1] * size + s[1:], gap)
        found, counts = np.unique(keys[keys != gap], return_counts=True)
        if not len(found) or counts.max() < LEAST_USE:
            break
        best = int(found[counts.argmax()])  # of pairs as frequent, the smallest
        at = np.flatnonzero(keys == best)
        if best // size == best % size:
            # of neighbours that overlap every second one
            run = at - np.arange(len(at))
            begins = np.concatenate([[True], run[1:] != run[:-1]])
            at = at[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]
        rules.append((best // size, best % size))
        s[at] = size
        s = np.delete(s, at + 1)
    ends = np.flatnonzero(s == gap)
    return rules, [x.tolist() for x in np.split(s, ends + 1)[:-1]] if len(ends) else []


class Evaluated:
    """The matrices of a set of strings, through one grammar."""

    def __init__(self, strings: list[str]):
        self.strings = sorted(set(strings))
        letters = sorted(set("".join(self.strings)))
        number = {c: k for k, c in enumerate(letters)}
        rules, written = re_pair([[number[c] for c in x] for x in self.strings], len(letters))
        self.matrices = [letter_matrix(c) for c in letters]
        for left, right in rules:
            self.matrices.append(times(self.matrices[left], self.matrices[right]))
        self.written = {x: [k for k in w if k >= 0] for x, w in zip(self.strings, written)}

    def whole(self, string: str) -> tuple[int, str]:
        """Least cost and audit of a whole conversation."""
        row = [NOTHING[START]]
        for k in self.written[string]:
            row = times(row, self.matrices[k])
        return finished(row[0])

    def part(self, string: str) -> Matrix:
        """The matrix of a part of a conversation; products of neighbours keep the ropes short."""
        parts = [self.matrices[k] for k in self.written[string]] or [NOTHING]
        return product(parts)


def product(parts: list[Matrix]) -> Matrix:
    while len(parts) > 1:
        halves = [times(x, y) for x, y in zip(parts[::2], parts[1::2])]
        parts = halves + parts[len(parts) - len(parts) % 2 :]
    return parts[0]


def packed(matrix: Matrix) -> tuple[list[int | None], list[str | None]]:
    flat = [e for row in matrix for e in row]
    return [e and e[0] for e in flat], [e and e[1].text() for e in flat]


def unpacked(costs: list[int | None], audits: list[str | None]) -> Matrix:
    flat = [None if c is None else (int(c), Rope(flat=a)) for c, a in zip(costs, audits)]
    return [flat[k : k + 4] for k in range(0, 16, 4)]
