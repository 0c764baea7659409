"""Substring dedup by recompression.

A text is a sequence of word names. First every run of one word becomes one symbol, then rounds replace pairs:
each symbol is on the left or right side by a bit of its name, and a left symbol followed by a right one becomes
a new symbol named by the two. Names are fingerprints, so they are global without an exchange: equal symbols
have equal names in every document. What a round does at a place depends on the neighbours only, so each symbol
also keeps the span of words that its parse depended on. Wherever that span occurs, the symbol occurs; equal
substrings have the same interior symbols.

A symbol whose span fits into a window and occurs once rules out every window around it. The windows that are
left (all their symbols are shared, or they contain none) are verified by their own word sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import PLAIN, Words, chunks, covered, mix, ragged_ranges, window_hashes, window_starts
from .shared import Stages

WINDOW = 35
#: Pair rounds, and the most words of a symbol that may still grow.
ROUNDS, LARGEST = 6, 14


def symbols(names: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS, largest: int = LARGEST):
    """High-level symbols of the texts: ``(name, left, right)``, the span of words each parse depended on.

    A span that depended on the beginning or end of a text begins before it or ends after it.
    """
    counts = np.diff(bounds)
    text = np.repeat(np.arange(len(counts)), counts)
    low, high = bounds[:-1][text] - 1, bounds[1:][text] + 1
    # runs of one word
    head = np.ones(len(names), bool)
    head[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    start = np.flatnonzero(head)
    end = np.append(start[1:], len(names))
    sym = mix(names[start] + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) if len(start) else names[:0]
    text, size = text[start], end - start
    left, right = np.maximum(start - 1, low[start]), np.minimum(end + 1, high[start])
    low, high = low[start], high[start]
    for k in range(rounds):
        if len(sym) < 2:
            break
        side = (mix(sym + np.uint64(k + 1)) & np.uint64(1)).astype(bool)
        same = text[1:] == text[:-1]
        pair = np.zeros(len(sym), bool)
        pair[:-1] = ~side[:-1] & side[1:] & same & (size[:-1] + size[1:] <= largest)
        second = np.zeros(len(sym), bool)
        second[1:] = pair[:-1]
        # a left symbol looked at its right neighbour, a right symbol at its left one
        follows, leads = np.append(same, False), np.concatenate(([False], same))
        right_l, right_r = np.append(left[1:], 0), np.append(right[1:], 0)
        left_l, left_r = np.concatenate(([0], left[:-1])), np.concatenate(([0], right[:-1]))
        near_l = np.where(side, np.where(leads, left_l, low), np.where(follows, right_l, left))
        near_r = np.where(side, np.where(leads, left_r, right), np.where(follows, right_r, high))
        new_left, new_right = np.minimum(left, near_l), np.maximum(right, near_r)
        at = np.flatnonzero(pair)
        sym = sym.copy()
        sym[at] = mix(sym[at] * np.uint64(0xD1342543DE82EF95) + sym[at + 1] + np.uint64(k + 1))
        size = size.copy()
        size[at] += size[at + 1]
        keep = ~second
        sym, size, text, left, right, low, high = (x[keep] for x in (sym, size, text, new_left, new_right, low, high))
    return sym, left, right


def _inner_symbols(names: np.ndarray, bounds: np.ndarray, window: int):
    """Symbols whose spans lie in their text and fit into a window: ``(name, left, right, text)``."""
    sym, left, right = symbols(names, bounds)
    # a span begins at the word before its text's first one at the earliest
    text = np.clip(np.searchsorted(bounds, np.minimum(left + 1, max(len(names) - 1, 0)), side="right") - 1, 0, len(bounds) - 2)
    inside = (left >= bounds[text]) & (right <= bounds[text + 1]) & (right - left <= window)
    return sym[inside], left[inside], right[inside], text[inside]


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``anchor, key, n``: the fitting symbols of each text, with the number of occurrences in a run of texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"))
                sym, _, _, text = _inner_symbols(words.hashes(), words.bounds, window)
                keys = part.column("key").to_numpy()[text]
                order = np.lexsort((sym, keys))
                sym, keys = sym[order], keys[order]
                head = np.ones(len(sym), bool)
                head[1:] = (sym[1:] != sym[:-1]) | (keys[1:] != keys[:-1])
                at = np.flatnonzero(head)
                n = np.diff(np.append(at, len(sym)))
                yield pa.record_batch([pa.array(sym[at].view(np.int64)), pa.array(keys[at]), pa.array(n, pa.int64())], ["anchor", "key", "n"])

    return docs.select("text", "key").mapInArrow(cut, "anchor long, key long, n long")


def _result(raw: bytes, removed: np.ndarray | None, as_text: bool) -> tuple[int, int, str]:
    """Words, removed words, and the kept words joined by one space: their SHA-256, or themselves."""
    words = raw.split()  # the separators of PLAIN are the white space of bytes
    kept = words if removed is None else [w for w, gone in zip(words, removed.tolist()) if not gone]
    if as_text:
        return len(words), len(words) - len(kept), (raw if removed is None else b" ".join(kept)).decode()
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _candidates(docs: DataFrame, extra: list[str], window: int, as_text: bool) -> DataFrame:
    """Scan texts with their shared anchors (``shared``).

    A text without candidate windows, or standing twice in a batch, is finished; of the latter one more row
    (``counts_only``) keeps the windows for the others. The rest keep their text and their candidate windows; one
    that occurs twice in its text is listed twice.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield scan_part(part)

    def scan_part(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column("text").fill_null("")
        words = Words(texts)
        names = words.hashes()
        sym, left, right, text = _inner_symbols(names, words.bounds, window)
        shared = part.column("shared")
        sizes = pa.compute.list_value_length(shared).fill_null(0).to_numpy(zero_copy_only=False)
        known = shared.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        # a symbol of a text is looked up among that text's shared ones
        salt = lambda rows: mix(rows.astype(np.uint64) + np.uint64(1))
        alone = ~np.isin(sym ^ salt(text), known ^ salt(np.repeat(np.arange(len(sizes)), sizes)))
        edge = np.zeros(len(names) + 1, np.int64)
        np.add.at(edge, np.maximum(right[alone] - window, 0), 1)
        np.subtract.at(edge, left[alone] + 1, 1)
        starts = window_starts(words.bounds, window)
        starts = starts[np.cumsum(edge)[starts] == 0]
        hashed = window_hashes(names, starts, window)
        owner = np.searchsorted(words.bounds, starts, side="right") - 1
        order = np.lexsort((hashed, owner))
        hashed, owner = hashed[order], owner[order]
        # the third and later equal windows of a text add nothing
        third = np.zeros(len(hashed), bool)
        third[2:] = (hashed[2:] == hashed[:-2]) & (owner[2:] == owner[:-2])
        hashed, owner = hashed[~third].view(np.int64), owner[~third]
        edges = np.searchsorted(owner, np.arange(len(sizes) + 1))
        raw = [words_raw.as_py().encode() for words_raw in texts]
        rows, copied, before = [], {}, None
        for i, own in enumerate(raw):
            if own and own == before:
                copied.setdefault(i - 1, None)
                copied[i] = i - 1
            before = own
        at, lists, keep, results, counts_only = [], [], [], [], []

        def add(i, windows, text, result, only):
            at.append(i)
            lists.append(windows)
            keep.append(text)
            results.append(result)
            counts_only.append(only)

        nothing = hashed[:0]
        for i, own in enumerate(raw):
            n, windows = int(words.counts[i]), hashed[edges[i] : edges[i + 1]]
            if i in copied and n >= window:
                if copied[i] is None:
                    add(i, np.repeat(windows, 2), None, (n, n, ""), True)
                add(i, nothing, None, _result(own, np.ones(n, bool), as_text), False)
            elif len(windows):
                add(i, windows, own.decode(), (n, 0, ""), False)
            else:
                add(i, nothing, None, _result(own, None, as_text), False)
        take = pa.array(at, pa.int64())
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
        flat = np.concatenate(lists) if lists else nothing
        n_words, n_removed, kept = zip(*results) if results else ((), (), ())
        return pa.record_batch(
            [*(part.column(c).take(take) for c in extra), part.column("key").take(take), pa.array(keep, pa.string()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int64())), pa.array(counts_only, pa.bool_()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            [*extra, "key", "text", "windows", "counts_only", "n_words", "n_removed", "kept"],
        )

    own = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in extra)
    return docs.mapInArrow(scan, f"{own}, key long, text string, windows array<long>, counts_only boolean, n_words long, n_removed long, kept string")


def _remove(rows: DataFrame, extra: list[str], window: int, as_text: bool) -> DataFrame:
    """Finish the texts whose repeated windows (``repeated``) are known."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"))
                names, out = words.hashes(), []
                sizes = pa.compute.list_value_length(part.column("repeated")).fill_null(0).to_numpy(zero_copy_only=False)
                flat, ends = part.column("repeated").flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.cumsum(sizes)
                for i, (n, size) in enumerate(zip(words.counts.tolist(), sizes.tolist())):
                    own, starts = names[words.bounds[i] : words.bounds[i + 1]], np.arange(max(n - window + 1, 0))
                    hit = starts[np.isin(window_hashes(own, starts, window), flat[ends[i] - size : ends[i]])]
                    out.append(_result(part.column("text")[i].as_py().encode(), covered(hit, window, n) if len(hit) else None, as_text))
                n_words, n_removed, kept = zip(*out)
                yield pa.record_batch([*(part.column(c) for c in extra), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], [*extra, "n_words", "n_removed", "kept"])

    own = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in extra)
    return rows.mapInArrow(cut, f"{own}, n_words long, n_removed long, kept string")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, as_text: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``window`` words whose sequence also starts anywhere else.

    ``docs`` has ``text`` and any other columns, which are kept. Adds ``n_words, n_removed, kept``: the SHA-256 of
    the kept words joined by one space or, ``as_text``, the new text (unchanged if nothing goes). Windows are
    judged on the input. Null and empty texts have no words; a row that stands twice repeats itself; an empty
    table gives no rows.
    """
    extra = [c for c in docs.columns if c != "text"]
    docs = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("key", F.xxhash64("text"))
    clash = [c for c in extra if c in ("key", "n_words", "n_removed", "kept", "windows", "shared", "repeated", "counts_only")]
    if clash:
        raise ValueError(f"rename these columns first: {clash}")
    stages = Stages(docs.sparkSession)
    anchors = stages.keep(_anchors(docs, window), "anchors")
    often = anchors.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    shared = stages.keep(anchors.join(often, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("shared")), "shared")
    stages.drop("anchors")
    scanned = stages.keep(_candidates(docs.join(shared, "key", "left"), extra, window, as_text), "scanned")
    stages.drop("shared")
    places = scanned.select(F.explode("windows").alias("window"), "key", "counts_only")
    often = places.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    repeated = places.where(~F.col("counts_only")).select("window", "key").distinct().join(often, "window").groupBy("key").agg(F.collect_set("window").alias("repeated"))
    open_rows = scanned.where(F.col("text").isNotNull()).select(*extra, "key", "text").join(repeated, "key", "left")
    finished = scanned.where(F.col("text").isNull() & ~F.col("counts_only")).select(*extra, "n_words", "n_removed", "kept")
    return finished.unionByName(_remove(open_rows, extra, window, as_text))
