"""Secret scan with one deterministic automaton for all rules.

The rules' expressions are compiled by subset construction, multiplied into one automaton and minimised
(``automaton``). Each text is read once, byte by byte: the state tells which rules' matches hold, and a match ends where
its bit goes. Its start is found by the rule's reversed automaton, which reads from there back to the end of the
rule's match before at most, so all of it stays linear in the text. A match counts if it is one of the rule's
``whole`` expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .automaton import Scanner, whole_match


def either_case(letters: str) -> str:
    """The expression with each lower-case letter in both cases; only for literals."""
    return re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", letters)


@dataclass(frozen=True)
class Rule:
    """``search`` gives leftmost non-overlapping matches; those that are not matches of ``whole`` are dropped."""

    kind: str
    search: str
    whole: str


def _assign(length: str) -> str:
    return either_case("(password|passwd|secret|token|api_?key)") + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""" + length


#: The kinds in their order; the first three are the base, new ones go to the end. A run of ``[A-Z0-9]`` or
#: ``[0-9a-f]`` ends where its longest match ends, so these two have their length in the search.
RULES = [
    Rule("assign", _assign("+"), _assign("{8,}")),
    Rule("access", "AKIA[A-Z0-9]{12,}", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}", "[0-9a-f]{32,}"),
    Rule("code_host", "gh[opsu]_[A-Za-z0-9]+", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("private_key", "-----BEGIN( [A-Z]+)* PRIVATE KEY-----", "-----BEGIN( [A-Z]+)* PRIVATE KEY-----"),
    Rule("url_password", "://[A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%!$&*+-]+@", "://[A-Za-z0-9._~%+-]+:[A-Za-z0-9._~%!$&*+-]{3,}@"),
]
BASE = 3
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def span_finder(rules: list[Rule] = RULES) -> Callable[[], Callable[[bytes], list[tuple[int, int, int]]]]:
    """Compile the rules; the result makes, in a task, the function from bytes to ``(start, rule, end)``, sorted."""
    scanner = Scanner.of([r.search for r in rules])
    exact = [(whole_match(r.search, backwards=True), whole_match(r.whole)) for r in rules]

    def in_task() -> Callable[[bytes], list[tuple[int, int, int]]]:
        width, quiet = scanner.table.shape[1], scanner.quiet * scanner.table.shape[1]
        table = (scanner.table * width).ravel().tolist()
        masks = scanner.masks.tolist()
        checks = [tuple((t.ravel().tolist(), a.tolist()) for t, a in pair) for pair in exact]

        def ends(data: bytes) -> list[tuple[int, int]]:
            """``(place, rules)``: the bits of the rules with a match that ends before the place."""
            state, held, found = 0, 0, []
            for place, kind in enumerate(data.translate(scanner.classes)):
                state = table[state + kind]
                if held or state >= quiet:
                    now = masks[state // width]
                    if held & ~now:
                        found.append((place, held & ~now))
                    held = now
            if held:
                found.append((len(data), held))
            return found

        def spans(data: bytes) -> list[tuple[int, int, int]]:
            found, floor = [], [0] * len(rules)
            for end, bits in ends(data):
                for k, ((back, begins), (forth, accepts)) in enumerate(checks):
                    if not bits >> k & 1:
                        continue
                    state, start = 1, end
                    for place in range(end - 1, floor[k] - 1, -1):
                        state = back[state << 8 | data[place]]
                        if begins[state]:
                            start = place
                        elif not state:
                            break
                    floor[k], state = end, 1
                    for byte in data[start:end]:
                        state = forth[state << 8 | byte]
                    if accepts[state]:
                        found.append((start, k, end))
            return sorted(found)

        return spans

    return in_task


def _code_points(data: bytes, places: np.ndarray) -> np.ndarray:
    """Code points before each byte place."""
    if data.isascii():
        return places
    starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate(([0], np.cumsum(starts)))[places]


def secret_spans(text: str | Column = "text", rules: list[Rule] = RULES) -> Column:
    """Column of all spans of a text column: ``kind, start, end`` in code points, end exclusive, by start, then rule.

    A null or empty text has none.
    """
    finder, kinds = span_finder(rules), np.array([r.kind for r in rules], object)

    @F.arrow_udf(SPANS)
    def find(texts: pa.Array) -> pa.Array:
        spans, counts, columns = finder(), [0], ([], [], [])
        for data in (x.as_py() for x in texts.cast(pa.large_binary())):
            own = spans(data) if data else []
            if own:
                at = np.array(own, np.int64)
                for column, values in zip(columns, (kinds[at[:, 1]], _code_points(data, at[:, 0]), _code_points(data, at[:, 2]))):
                    column.extend(values)
            counts.append(counts[-1] + len(own))
        flat = pa.StructArray.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SPANS.value_type)], fields=list(_SPANS.value_type))
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), flat)

    return find(F.col(text) if isinstance(text, str) else text)


def redacted(text: str | Column = "text", mark: str = "[secret]", rules: list[Rule] = RULES) -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``; null stays null."""
    finder, sign = span_finder(rules), mark.encode()

    @F.arrow_udf("string")
    def cover(texts: pa.Array) -> pa.Array:
        spans, out = finder(), []
        for data in (x.as_py() for x in texts.cast(pa.large_binary())):
            parts, at = [], 0
            for start, _, end in spans(data) if data else []:
                if start >= at:
                    parts += [data[at:start], sign]
                at = max(at, end)
            out.append(data if data is None else b"".join([*parts, data[at:]]).decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return cover(F.col(text) if isinstance(text, str) else text)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` of all rules, ``base_sha256`` is the digest of those of the three base rules. Null
    and empty texts have no spans (the digest of an empty list, an empty string); repeated rows give repeated rows;
    extra columns are ignored; an empty table gives no rows.
    """
    # the spans go through a filter that keeps every row: else each use of the column would scan the text again
    found = docs.select("doc_id", secret_spans("text").alias("found")).where("found IS NOT NULL")
    base = [r.kind for r in RULES[:BASE]]
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(_listed(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"),
    )
