"""N-grams of a bounded list as numbers: found and counted in whole Arrow batches, without making a string for each.

Tokens hold no blanks: a blank separates the words of an n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENS = 2_000_000  # tokens that are looked at together


def slices(lists: pa.ListArray) -> Iterator[tuple[int, int]]:
    """``(low, high)``: runs of rows with about ``TOKENS`` tokens; a longer row is a run by itself."""
    ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + TOKENS, side="right")))
        yield low, high
        low = high


def flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All tokens, the row of each, and how many of its row stand from it on."""
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    return lists.flatten(), row, np.cumsum(sizes)[row] - np.arange(len(row))


def counted(code: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct codes, the rows that hold each, and how often each occurs; ``row`` ascends."""
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(code)), bool), code[1:] != code[:-1])))
    fresh = np.concatenate((np.ones(min(1, len(code)), bool), (code[1:] != code[:-1]) | (row[1:] != row[:-1])))
    if not len(code):
        return code, code, code
    return code[first], np.add.reduceat(fresh.astype(np.int64), first), np.diff(np.append(first, len(code)))


class Grams:
    """A list of n-grams as a tree: a node of order k is a node of order k - 1 and a word."""

    def __init__(self, terms: list[str]):
        parts = [t.split(" ") for t in terms]
        self.terms, self.words = terms, sorted({w for p in parts for w in p})
        number = {w: i for i, w in enumerate(self.words)}
        self.width = max(1, len(self.words))
        node = np.array([number[p[0]] for p in parts], np.int64)
        self.codes, self.term = [np.arange(len(self.words))], []
        size, order = np.array([len(p) for p in parts], np.int64), 1
        while True:
            term = np.full(len(self.codes[-1]), -1, np.int64)
            term[node[size == order]] = np.flatnonzero(size == order)
            self.term.append(term)
            longer = np.flatnonzero(size > order)
            if not len(longer):
                break
            code = node[longer] * self.width + [number[parts[i][order]] for i in longer]
            self.codes.append(np.unique(code))
            node[longer] = np.searchsorted(self.codes[-1], code)
            order += 1

    def find(self, tokens: pa.Array, left: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The number of each token's word, and by order the node that begins at each token; -1 for none."""
        words = pc.index_in(tokens, value_set=pa.array(self.words, tokens.type)).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        nodes = [words]
        for order, codes in enumerate(self.codes[1:], 2):
            at = np.flatnonzero((nodes[-1] >= 0) & (left >= order))
            at = at[words[at + order - 1] >= 0]
            code = nodes[-1][at] * self.width + words[at + order - 1]
            place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            node = np.full(len(words), -1, np.int64)
            node[at] = np.where(codes[place] == code, place, -1)
            nodes.append(node)
        return words, nodes
