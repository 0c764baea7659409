"""Byte-pair merges of many pre-tokens at once on ragged arrays (rank-synchronous merging).

All sequences lie one after another in one array. In each round every sequence finds its own lowest-ranked
adjacent pair and replaces all its occurrences, from left to right; a sequence without a known pair is done.
A merged symbol only forms pairs of higher rank than its own, so this gives the same symbols as merging one
pair after the other.
"""

from __future__ import annotations

import json

import numpy as np

from .arrays import ragged_ranges

_NONE = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The printable character that a byte-level vocabulary writes for each byte.

    Printable bytes stand for themselves, the others for the characters from 256 on, in order.
    """
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    moved = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(moved)) for b in range(256)]


class Merges:
    """The vocabulary and merge ranks of a tokenizer file of byte-level pairs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, vocab = whole["model"], whole["model"]["vocab"]
        self.special = [t["content"] for t in whole["added_tokens"]]
        suffix = model["end_of_word_suffix"] or ""
        chars = byte_characters()
        self.first = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int64)
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        codes = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.made = codes[order], order.astype(np.int32), made

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left << 32 | right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], _NONE)

    def run(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The final symbols of all pieces, one after another, and how many each piece has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sym = self.first[data]
        ends = np.cumsum(sizes)
        sym[ends[sizes > 0] - 1] = self.last[data[ends[sizes > 0] - 1]]
        counts, done = np.zeros(len(pieces), np.int64), {}
        live = np.flatnonzero(sizes)  # pieces still in work
        seg = np.repeat(np.arange(len(live)), sizes[live])
        rank = np.full(len(sym), _NONE, np.int32)  # of the pair that starts here
        if len(sym) > 1:
            inner = np.flatnonzero(seg[1:] == seg[:-1])
            rank[inner] = self._rank(sym[inner], sym[inner + 1])
        while len(live):
            heads = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
            low = np.minimum.reduceat(rank, heads)
            over = low == _NONE
            if over.any():
                lens = np.diff(np.append(heads, len(seg)))
                counts[live[over]] = lens[over]
                gone = over[seg]
                done[len(done)] = (live[over], lens[over], sym[gone])
                live, low = live[~over], low[~over]
                sym, rank = sym[~gone], rank[~gone]
                seg = np.repeat(np.arange(len(live)), lens[~over])
                if not len(live):
                    break
            hit = np.flatnonzero(rank == low[seg])
            # in a run of overlapping occurrences every second one counts
            fresh = np.concatenate(([True], hit[1:] != hit[:-1] + 1))
            run = np.cumsum(fresh) - 1
            parity = (np.arange(len(hit)) - np.flatnonzero(fresh)[run]) & 1
            hit = hit[parity == 0]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            place = np.cumsum(keep) - 1
            sym, seg, rank = sym[keep], seg[keep], rank[keep]
            hit = place[hit]
            # pairs that touch a new symbol get their rank anew
            near = np.zeros(len(sym), bool)
            near[hit] = True
            near[hit[hit > 0] - 1] = True
            touched = np.flatnonzero(near)
            rank[touched] = _NONE
            touched = touched[touched + 1 < len(sym)]
            touched = touched[seg[touched] == seg[touched + 1]]
            rank[touched] = self._rank(sym[touched], sym[touched + 1])
        begin = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        for pieces_done, lens, symbols in done.values():
            out[ragged_ranges(begin[pieces_done], lens)] = symbols
        return out, counts
