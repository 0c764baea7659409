"""Licence scans: one Aho-Corasick automaton for tags and notices, a shunting-yard parser for expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from .arrays import ALNUM, LOWER, Words, chunks

#: Phrases whose labels every scan gives; fixed values.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notice phrases with labels of the method.
NOTICES = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "boost software license": "bsl",
    "all rights reserved": "all-rights-reserved",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "public domain": "public-domain",
}
#: The words of an identifier tag; an expression follows it.
TAG = "spdx license identifier"
#: Licence families by the beginning of an identifier, longest beginning first.
FAMILIES = {
    "agpl": "agpl", "apache": "apache", "bsd": "bsd", "bsl": "bsl", "cc-by-nc-nd": "cc-by-nc-nd", "cc-by-nc-sa": "cc-by-nc-sa",
    "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc-by": "cc-by", "cc0": "public-domain",
    "epl": "epl", "gpl": "gpl", "isc": "isc", "lgpl": "lgpl", "mit": "mit", "mpl": "mpl", "unlicense": "public-domain", "wtfpl": "wtfpl", "zlib": "zlib",
}
_RANK = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[()]|[a-z0-9][a-z0-9.+:-]*")


def family(identifier: str) -> str:
    """The label of a licence identifier; an unknown identifier is its own label."""
    best = max((k for k in FAMILIES if identifier == k or identifier.startswith((k + "-", k + "+"))), key=len, default=None)
    return FAMILIES[best] if best else identifier.replace(",", "")


@dataclass(frozen=True)
class Choice:
    """What an expression asks for: alternatives, each a set of labels that hold together."""

    ways: frozenset[frozenset[str]]

    @property
    def labels(self) -> set[str]:
        return set().union(*self.ways)


#: Alternatives that are kept apart; beyond that an "and" of many "or" is kept as one set of all labels.
MOST_WAYS = 64


def tokens(low: bytes, start: int = 0, stop: int | None = None) -> Iterator[str]:
    """The tokens of a lower-cased text between two places, one after another as they are asked for."""
    return (m.group().decode() for m in _TOKEN.finditer(low, start, len(low) if stop is None else stop))


def parse_expression(found: Iterable[str]) -> tuple[Choice | None, bool]:
    """Evaluate the tokens of a licence expression by the shunting-yard method: ``with`` binds before ``and`` before ``or``.

    Returns the value and whether the expression was well formed. The expression ends where an operand follows
    an operand. An exception after ``with`` belongs to its licence and adds no label.
    """
    values: list[Choice] = []
    waiting: list[str] = []
    sound, operand_next = True, True

    def reduce() -> None:
        nonlocal sound
        op = waiting.pop()
        if op == "(" or len(values) < 2:
            sound = False
            return
        right, left = values.pop(), values.pop()
        if op == "with":
            values.append(left)
        elif op == "or":
            values.append(Choice(left.ways | right.ways))
        elif len(left.ways) * len(right.ways) <= MOST_WAYS:
            values.append(Choice(frozenset(a | b for a in left.ways for b in right.ways)))
        else:
            values.append(Choice(frozenset([frozenset(left.labels | right.labels)])))

    depth = 0
    for token in found:
        if token == "(":
            if not operand_next:
                break
            waiting.append(token)
            depth += 1
        elif token == ")":
            if operand_next or not depth:
                break
            while waiting and waiting[-1] != "(":
                reduce()
            waiting.pop()
            depth -= 1
        elif token in _RANK:
            if operand_next:
                break
            while waiting and waiting[-1] != "(" and _RANK[waiting[-1]] >= _RANK[token]:
                reduce()
            waiting.append(token)
            operand_next = True
        else:
            if not operand_next:
                break
            values.append(Choice(frozenset([frozenset([family(token.rstrip(".:-"))])])))
            operand_next = False
    sound &= not operand_next and not depth
    while waiting:
        if waiting[-1] == "(":
            waiting.pop()
        else:
            reduce()
    return (values[-1] if values else None), sound and len(values) == 1


def automaton() -> ahocorasick.Automaton:
    """All phrases, each between single spaces, so that only whole words match."""
    made = ahocorasick.Automaton()
    for phrase, label in [*((p, None) for p in (TAG,)), *BASE.items(), *NOTICES.items()]:
        made.add_word(f" {phrase} ", (phrase, label))
    made.make_automaton()
    return made


_TO_SPACES = bytes(int(LOWER[b]) if ALNUM[LOWER[b]] else 0x20 for b in range(256))


def scan_text(low: bytes, machine: ahocorasick.Automaton) -> tuple[list[int], set[str], set[str], float]:
    """Starts of the base phrases, base labels, all labels and the confidence, for one lower-cased text."""
    flat = b" " + b" ".join(low.translate(_TO_SPACES).split()) + b" "
    places, base, labels, score, spaces, ends, line = [], set(), set(), 0.0, None, None, 0
    # one character a byte: the phrases are ASCII, so no character of the text is needed
    for stop, (phrase, label) in machine.iter(flat.decode("latin-1")):
        if spaces is None:
            spaces = np.flatnonzero(np.frombuffer(flat, np.uint8) == 0x20)
        first = int(np.searchsorted(spaces, stop - len(phrase) - 1))
        if phrase in BASE:
            places.append(first)
            base.add(label)
            labels.add(label)
            score = max(score, 0.8)
        elif phrase == TAG:
            if ends is None:
                letters = np.append(ALNUM[np.frombuffer(low, np.uint8)], False)
                ends = np.flatnonzero(letters[:-1] & ~letters[1:]) + 1
            at = int(ends[first + 2])
            if line < at:  # the end of the line, looked for once a line
                line = low.find(b"\n", at)
                line = len(low) if line < 0 else line
            choice, sound = parse_expression(tokens(low, at, line))
            if choice:
                labels |= choice.labels
                score = max(score, 1.0 if sound else 0.6)
        else:
            labels.add(label)
            score = max(score, 0.4 if label == "public-domain" else 0.7)
    return places, base, labels, score


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Base phrases are found wherever their words stand one after another; notice phrases and identifier tags with
    their expressions (to the end of the line) add labels. ``score`` is the strongest evidence: 1 a sound tagged
    expression, 0.8 a base phrase, less for notices and broken expressions, 0 without any. A null text is empty;
    repeated rows give repeated rows; extra columns are ignored; an empty table gives no rows.
    """
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            for part in chunks(batch):
                words, out = Words(part.column("text"), ALNUM, lower=True), []
                low = words.data.tobytes()
                for n, begin, end in zip(words.counts.tolist(), words.text_start.tolist(), words.text_start[1:].tolist()):
                    places, base, labels, score = scan_text(low[begin:end], machine)
                    out.append((n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score))
                yield pa.record_batch([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))], ["doc_id", *names])

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(scan, f"doc_id {kind}, {COLUMNS}")
