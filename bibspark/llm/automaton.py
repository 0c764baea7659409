"""Rule expressions as deterministic byte automata: subset construction, products, minimisation.

Expressions have literals, classes such as ``[A-Z0-9_]``, groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``
and escapes (``\\xHH``, or a backslash before a sign that stands for itself). They are ASCII and match bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_ENDLESS = -1


def _parse(pattern: str) -> tuple:
    """The expression as nested tuples: ``("set", bytes)``, ``("cat", ...)``, ``("alt", ...)``, ``("rep", node, low, high)``."""
    at = 0

    def peek() -> str:
        return pattern[at : at + 1]

    def take(n: int = 1) -> str:
        nonlocal at
        at += n
        return pattern[at - n : at]

    def sign() -> int:
        c = take()
        if c == "\\":
            c = take()
            if c == "x":
                return int(take(2), 16)
            if c.isalnum():
                raise ValueError(f"unknown escape \\{c} in {pattern!r}")
        if not c or ord(c) > 127:
            raise ValueError(f"not an ASCII expression: {pattern!r}")
        return ord(c)

    def members() -> tuple:
        if peek() == "^":
            raise ValueError(f"negated class in {pattern!r}")
        out = set()
        while peek() != "]":
            low = high = sign()
            if peek() == "-" and pattern[at + 1 : at + 2] != "]":
                take()
                high = sign()
            out |= set(range(low, high + 1))
        take()
        return ("set", frozenset(out))

    def bounds() -> tuple[int, int]:
        stop = pattern.index("}", at)
        low, comma, high = take(stop - at).partition(",")
        take()
        return int(low), int(high) if high else _ENDLESS if comma else int(low)

    def item() -> tuple:
        c = peek()
        if c == "(":
            take()
            if peek() == "?":
                if take(2) != "?:":
                    raise ValueError(f"unknown group in {pattern!r}")
            node = either()
            if take() != ")":
                raise ValueError(f"open group in {pattern!r}")
        elif c == "[":
            take()
            node = members()
        elif c and c in "*+?{":
            raise ValueError(f"nothing to repeat in {pattern!r}")
        else:
            node = ("set", frozenset([sign()]))
        while peek() and peek() in "*+?{":
            c = take()
            low, high = {"*": (0, _ENDLESS), "+": (1, _ENDLESS), "?": (0, 1)}.get(c) or bounds()
            node = ("rep", node, low, high)
        return node

    def run() -> tuple:
        parts = []
        while peek() and peek() not in "|)":
            parts.append(item())
        return ("cat", *parts)

    def either() -> tuple:
        ways = [run()]
        while peek() == "|":
            take()
            ways.append(run())
        return ("alt", *ways)

    node = either()
    if at < len(pattern):
        raise ValueError(f"unbalanced group in {pattern!r}")
    return node


def _reverse(node: tuple) -> tuple:
    kind, *rest = node
    if kind == "set":
        return node
    if kind == "rep":
        return (kind, _reverse(rest[0]), *rest[1:])
    parts = [_reverse(x) for x in rest]
    return (kind, *(reversed(parts) if kind == "cat" else parts))


class _Threads:
    """The nondeterministic automaton of an expression; sets hold the places that read a byte, and the end."""

    END = 0

    def __init__(self, node: tuple):
        self.reads: dict[int, tuple[frozenset, frozenset]] = {}
        self.marks = 0
        self.first = self._add(node, frozenset([self.END]))

    def _add(self, node: tuple, then: frozenset) -> frozenset:
        """Places where ``node`` starts, if the places ``then`` follow it."""
        kind, *rest = node
        if kind == "set":
            place = len(self.reads) + 1
            self.reads[place] = (rest[0], then)
            return frozenset([place])
        if kind == "cat":
            for part in reversed(rest):
                then = self._add(part, then)
            return then
        if kind == "alt":
            return frozenset().union(*(self._add(part, then) for part in rest))
        inner, low, high = rest
        if high == _ENDLESS:
            self.marks += 1
            mark = -self.marks  # stands for the places after a turn, until they are known
            again = self._add(inner, frozenset([mark]))
            whole = (again | then) - {mark}
            for place, (own, following) in self.reads.items():
                if mark in following:
                    self.reads[place] = (own, following - {mark} | whole)
            again = again - {mark} | whole if mark in again else again
            return whole if low == 0 else again if low == 1 else self._add(("cat", *[inner] * (low - 1)), again)
        for _ in range(high - low):
            then = self._add(inner, then) | then if high else then
        return self._add(("cat", *[inner] * low), then)

    def move(self, places: frozenset, byte: int) -> frozenset:
        return frozenset().union(*(self.reads[p][1] for p in places if p and byte in self.reads[p][0]))

    def classes(self) -> tuple[np.ndarray, list[int]]:
        """The class of each byte, and a byte of each class: bytes of one class are in the same sets."""
        sets = [own for own, _ in self.reads.values()]
        kinds: dict[tuple, int] = {}
        of = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)])
        return of, [int(np.flatnonzero(of == k)[0]) for k in range(len(kinds))]


def _explore(first, following, byte_classes: tuple[np.ndarray, list[int]]) -> tuple[np.ndarray, list]:
    """The table (state by byte) of all states reachable from ``first``, and the states."""
    of, samples = byte_classes
    known, states, rows = {first: 0}, [first], []
    for state in states:  # grows meanwhile
        row = []
        for byte in samples:
            new = following(state, byte)
            if new not in known:
                known[new] = len(states)
                states.append(new)
            row.append(known[new])
        rows.append(row)
    return np.array(rows, np.int32)[:, of], states


def minimise(table: np.ndarray, output: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input can tell apart by their outputs; the first state stays the first."""
    part = np.unique(output, return_inverse=True)[1]
    columns = np.unique(table, axis=1)
    while True:
        signs = np.column_stack((part, part[columns]))
        _, first, finer = np.unique(signs, axis=0, return_index=True, return_inverse=True)
        if len(first) == part.max() + 1:
            break
        part = finer
    order = np.argsort(first, kind="stable")  # by the first state of each part
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    keep = first[order]
    return rank[finer][table[keep]].astype(np.int32), output[keep]


def whole_match(pattern: str, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """``(table, accepts)`` of the strings that match as a whole; state 1 or higher, 0 being the dead one.

    ``backwards`` reads them from their ends.
    """
    node = _parse(pattern)
    threads = _Threads(_reverse(node) if backwards else node)
    table, states = _explore(threads.first, threads.move, threads.classes())
    accepts = np.array([threads.END in s for s in states])
    # the dead state becomes number 0 and the first one number 1
    dead = len(states)
    table = np.vstack((np.where(np.array([not s for s in states])[table], dead, table), np.full(256, dead)))
    swap = np.concatenate((np.arange(1, dead + 1), [0]))
    back = np.argsort(swap)
    return swap[table[back]].astype(np.int32), np.concatenate((accepts, [False]))[back]


def search(pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """``(table, accepts)`` that finds leftmost-longest matches one after another in one pass.

    A state is the list of threads by start. A match of the earliest thread ends all later ones; where it cannot go
    on, the search starts anew with that byte. So a match ends at each byte that leaves the accepting states. That needs
    rules whose match can be told at once: a match goes on matching or ends, an earlier start is decided before a later
    one matches, and no single byte matches. Any other rule raises an error.
    """
    threads = _Threads(_parse(pattern))
    end = threads.END
    if end in threads.first or any(end in then for p in threads.first for then in [threads.reads[p][1]]):
        raise ValueError(f"matches of {pattern!r} may have less than two bytes")

    def following(groups: tuple, byte: int) -> tuple:
        moved = [threads.move(g, byte) for g in groups]
        if groups and end in groups[0]:
            if moved[0]:
                if end not in moved[0]:
                    raise ValueError(f"a match of {pattern!r} is left and may match again")
                return (moved[0],)
            moved = []
        out, seen = [], frozenset()
        for group in [*moved, threads.move(threads.first, byte)]:
            group = group - seen
            if end in group:
                if out:
                    raise ValueError(f"a later match of {pattern!r} ends before an earlier one is decided")
                return (group,)
            if group:
                out.append(group)
                seen |= group
        return tuple(out)

    table, states = _explore((), following, threads.classes())
    return minimise(table, np.array([bool(s) and end in s[0] for s in states]))


@dataclass(frozen=True)
class Scanner:
    """One automaton for many rules. ``table[state, class]``; ``masks[state]``: bits of the rules whose match holds.

    States from ``quiet`` on have a mask; state 0 is the first one.
    """

    classes: bytes
    table: np.ndarray
    masks: np.ndarray
    quiet: int

    @staticmethod
    def of(patterns: list[str]) -> Scanner:
        """The product of the searches of all rules, reachable states only, minimised."""
        each = [search(p) for p in patterns]
        if len(each) > 62:
            raise ValueError("at most 62 rules a scanner")
        columns, of = np.unique(np.vstack([t for t, _ in each]), axis=1, return_inverse=True)
        samples = [int(np.flatnonzero(of == k)[0]) for k in range(columns.shape[1])]
        short = [t[:, samples] for t, _ in each]
        known, states, rows = {(0,) * len(each): 0}, [(0,) * len(each)], []
        for state in states:  # grows meanwhile
            new = list(zip(*(t[s].tolist() for t, s in zip(short, state))))
            for s in new:
                if s not in known:
                    known[s] = len(states)
                    states.append(s)
            rows.append([known[s] for s in new])
        masks = np.array([sum(int(a[s]) << k for k, (s, (_, a)) in enumerate(zip(state, each))) for state in states], np.int64)
        table, masks = minimise(np.array(rows, np.int32), masks)
        order = np.argsort(masks != 0, kind="stable")
        back = np.argsort(order)
        return Scanner(bytes(of.astype(np.uint8).tolist()), back[table[order]].astype(np.int32), masks[order], int((masks == 0).sum()))
