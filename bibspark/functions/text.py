"""Text folding and small string helpers, all as JVM-side column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# ASCII characters that count as blank when a value is stripped.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"

_NON_ASCII = r"[^\x00-\x7F]"


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decompositions whose ASCII part is not empty.

    Folding works character by character (combining marks are not ASCII, so
    their reordering cannot show). Returns two aligned strings for the
    one-to-one cases and a dictionary for the one-to-many cases.
    """
    source, target, longer = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(char)
            target.append(plain)
        elif plain:
            longer[char] = plain
    return "".join(source), "".join(target), longer


@lru_cache(maxsize=1)
def _longer_class() -> str:
    """Regex class of the characters that fold to more than one character."""
    codes = sorted(ord(c) for c in _fold_tables()[2])
    runs: list[list[int]] = []
    for code in codes:
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"


def strip_blanks(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def ascii_fold(col: Column) -> Column:
    """NFKD decomposition, non-ASCII dropped, blanks at both ends removed.

    ASCII values skip the work. The few characters that expand (ligatures,
    fractions, units) take a per-character lookup, in their rows only.
    """
    source, target, longer = _fold_tables()
    expansions = F.create_map(*[F.lit(x) for pair in longer.items() for x in pair])
    expanded = F.when(
        col.rlike(_longer_class()),
        F.array_join(
            F.transform(
                F.split(col, ""),
                lambda c: F.when(c.rlike(_longer_class()), F.element_at(expansions, c)).otherwise(c),
            ),
            "",
        ),
    ).otherwise(col)
    folded = F.regexp_replace(F.translate(expanded, source, target), _NON_ASCII, "")
    return strip_blanks(F.when(col.rlike(_NON_ASCII), folded).otherwise(col))


def snippet(col: Column, n: int = 100) -> Column:
    return F.substring(col, 1, n)
