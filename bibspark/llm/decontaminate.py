"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

The windows of the benchmark are named by fingerprints and broadcast in blocks of a fixed size; every whole
training text is scanned once for each block, hits are verified word by word, and the hit words or the whole
documents are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from .arrays import ALNUM, LOWER, Words, chunks, covered, window_hashes, window_starts

WINDOW = 10
#: Windows in one broadcast: 8 bytes of fingerprint and some 100 bytes of words each, so 25 MB at most.
BROADCAST_WINDOWS = 1 << 18
_FILTER_BITS = 22


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``h, n_words, words, item_id``: distinct windows of the items (``item_id, text``).

    An item with fewer words than ``window`` is one window; an item without words, or with null text, has none.
    A null ``item_id`` is left out of lists of items, but its windows count.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"), ALNUM, lower=True)
                named, ids, out = words.hashes(), part.column("item_id").to_pylist(), []
                for row, count in enumerate(words.counts):
                    if count:
                        n, first = min(int(count), window), int(words.bounds[row])
                        starts = np.arange(first, first + int(count) - n + 1)
                        hashed = window_hashes(named, starts, n).view(np.int64)
                        out += [(int(h), n, words.joined(s, s + n), ids[row]) for h, s in zip(hashed, starts)]
                cols = list(zip(*out)) or [[], [], [], []]
                yield pa.record_batch(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.string())],
                    ["h", "n_words", "words", "item_id"],
                )

    items = items.select(F.col("text").cast("string").alias("text"), F.col("item_id").cast("string").alias("item_id"))
    return items.mapInArrow(cut, "h long, n_words int, words binary, item_id string").distinct()


class _Known:
    """One block of benchmark windows: a bit filter, sorted fingerprints, and words and items by fingerprint."""

    def __init__(self, rows: list):
        self.exact: dict[int, list[tuple[int, bytes, set]]] = {}
        for row in rows:
            same = self.exact.setdefault(row.h, [])
            for n, words, ids in same:
                if n == row.n_words and words == bytes(row.words):
                    ids.add(row.item_id)
                    break
            else:
                same.append((row.n_words, bytes(row.words), {row.item_id}))
        self.lengths = sorted({row.n_words for row in rows})
        self.hashes = np.sort(np.array(list(self.exact), np.int64).view(np.uint64))
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.hashes >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, words: Words, named: np.ndarray) -> Iterator[tuple[int, int, set]]:
        """``(first word, number of words, items)`` of each verified occurrence."""
        for n in self.lengths:
            starts = window_starts(words.bounds, n)
            hashed = window_hashes(named, starts, n)
            maybe = np.flatnonzero(self.filter[hashed >> np.uint64(64 - _FILTER_BITS)])
            at = np.minimum(np.searchsorted(self.hashes, hashed[maybe]), len(self.hashes) - 1)
            for i in maybe[self.hashes[at] == hashed[maybe]]:
                start = int(starts[i])
                text = words.joined(start, start + n)
                for size, known, ids in self.exact[int(hashed[i].astype(np.int64))]:
                    if size == n and known == text:
                        yield start, n, ids


_SPAN = "start int, n int, items array<string>"


def find_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BROADCAST_WINDOWS) -> DataFrame:
    """Add ``_n_words long`` and ``_hits array<struct<start, n, items>>`` to ``docs`` (any columns, with ``text``).

    ``start`` counts words from 0. Rows keep their order and number; null and empty texts have no words and no
    hits; an empty benchmark hits nothing. A benchmark of more than ``block`` windows is broadcast in several
    blocks, and each scans the documents in turn, so a broadcast never grows with the benchmark.
    """
    spark = docs.sparkSession
    windows = benchmark_windows(items, window)
    blocks = max(1, -(-windows.select("h").distinct().count() // block))
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    out = docs.withColumns({"_n_words": F.lit(0).cast("long"), "_hits": F.array().cast(f"array<struct<{_SPAN.replace(' int', ':int').replace(' array', ':array')}>>")})
    schema = ", ".join([*schema, "_n_words long", "_hits array<struct<start:int,n:int,items:array<string>>>"])
    for k in range(blocks):
        rows = windows.where(F.pmod("h", F.lit(blocks)) == k).collect()  # at most about `block` windows
        known = spark.sparkContext.broadcast(rows)
        out = out.mapInArrow(_scanner(known), schema)
    return out


def _scanner(known):
    hit_type = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32()), ("items", pa.list_(pa.string()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Known(known.value)
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"), ALNUM, lower=True)
                found: dict[int, list] = {}
                if table.exact:
                    for start, n, ids in table.hits(words, words.hashes()):
                        row = int(np.searchsorted(words.bounds, start, side="right")) - 1
                        found.setdefault(row, []).append({"start": start - int(words.bounds[row]), "n": n, "items": sorted(i for i in ids if i is not None)})
                before = part.column("_hits")
                cols = {name: part.column(name) for name in part.schema.names}
                cols["_n_words"] = pa.array(words.counts, pa.int64())
                if found:
                    merged = before.to_pylist()
                    for row, hits in found.items():
                        merged[row] = merged[row] + hits
                    cols["_hits"] = pa.array(merged, hit_type)
                else:
                    cols["_hits"] = before.cast(hit_type)
                yield pa.record_batch(list(cols.values()), list(cols))

    return scan


def contamination_report(docs: DataFrame, items: DataFrame, window: int = WINDOW, block: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    ``n_hit`` counts the words inside any occurrence of a benchmark window, ``items_sha256`` is the digest of the
    ids of the hit items, sorted as strings and joined by commas. Null texts have no words. Extra columns of the
    inputs are ignored; repeated rows give repeated rows; empty tables give no rows, or no hits.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n_words = batch.column("_n_words").to_numpy()
            n_hit, n_items, names = [0] * len(n_words), [0] * len(n_words), [nothing] * len(n_words)
            some = np.flatnonzero(pa.compute.list_value_length(batch.column("_hits")).to_numpy(zero_copy_only=False))
            for row in some:
                hits = batch.column("_hits")[int(row)].as_py()
                edge = np.zeros(int(n_words[row]) + 1, np.int64)
                for h in hits:
                    edge[h["start"]] += 1
                    edge[h["start"] + h["n"]] -= 1
                ids = sorted({i for h in hits for i in h["items"]})
                n_hit[row], n_items[row] = int((np.cumsum(edge[:-1]) > 0).sum()), len(ids)
                names[row] = hashlib.sha256(",".join(ids).encode()).hexdigest()
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(n_items, pa.int64()), pa.array(names)],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
            )

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = find_hits(docs, items, window, block).drop("text")
    report = found.mapInArrow(digest, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string")
    return report.withColumn("contaminated", F.col("n_hit") > 0)


def remove_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, drop_share: float = 0.5) -> DataFrame:
    """The documents without the words that occur in benchmark windows.

    A document with more than ``drop_share`` of its words hit goes as a whole. From the others each run of hit
    words goes, with the text between its words; all else stays as it is. Null and clean texts are unchanged.
    """
    columns = docs.columns
    found = find_hits(docs, items, window)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column("_hits")).to_numpy(zero_copy_only=False)
            keep, texts = np.ones(len(sizes), bool), {}
            for row in map(int, np.flatnonzero(sizes)):
                words = Words(batch.column("text").slice(row, 1), ALNUM, lower=True)
                hits = batch.column("_hits")[row].as_py()
                hit = np.zeros(len(words), bool)
                for h in hits:
                    hit[h["start"] : h["start"] + h["n"]] = True
                keep[row] = hit.sum() <= drop_share * len(words)
                raw = batch.column("text")[row].as_py().encode()
                edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
                pieces, at = [], 0
                for first, stop in zip(edges[::2], edges[1::2]):
                    pieces.append(raw[at : words.start[first]])
                    at = words.end[stop - 1]
                texts[row] = b"".join([*pieces, raw[at:]]).decode()
            if texts:
                old = batch.column("text").to_pylist()
                for row, text in texts.items():
                    old[row] = text
                cols = [pa.array(old, pa.string()) if c == "text" else batch.column(c) for c in columns]
            else:
                cols = [batch.column(c) for c in columns]
            yield pa.record_batch(cols, columns).filter(pa.array(keep))

    return found.mapInArrow(cut, schema)
