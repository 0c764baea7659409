"""Token counts by rank-synchronous array merging of batched pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .arrays import RELEASE, chunks
from .merges import Merges

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024
#: Pre-tokens whose counts a Python worker keeps; beyond that it starts anew.
CACHE = 400_000
_loaded: dict[str, tuple[Merges, dict[str, int]]] = {}


def _load(path: str) -> tuple[Merges, dict[str, int]]:
    if path not in _loaded:
        _loaded[path] = (Merges(path), {})
        RELEASE.append(_loaded.clear)
    return _loaded[path]


def count_tokens(texts: list[str], path: str) -> list[int]:
    """Tokens of each text under the byte-level vocabulary at ``path``; a special string is one token."""
    merges, cache = _load(path)
    split = regex.compile(public_tokenizers.PATTERN)
    special = regex.compile("|".join(map(regex.escape, merges.special)) or r"(?!)")
    counts, pieces = [0] * len(texts), []
    for i, text in enumerate(texts):
        own = []
        for k, part in enumerate(special.split(text)):
            counts[i] += k > 0
            own += split.findall(part)
        pieces.append(own)
    fresh = list(set().union(*pieces) - cache.keys())
    known = cache
    if fresh:
        _, found = merges.run([p.encode() for p in fresh])
        if len(cache) + len(fresh) > CACHE:
            known = {p: cache[p] for own in pieces for p in own if p in cache}
            cache.clear()
        new = dict(zip(fresh, found.tolist()))
        known.update(new)
        if known is not cache and len(known) <= CACHE:
            cache.update(known)
    return [n + sum(map(known.__getitem__, own)) for n, own in zip(counts, pieces)]


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_tokens, over_limit``.

    Whole texts are counted without begin, end or padding tokens. A null text counts as empty: 0 bytes and 0
    tokens. Repeated rows give repeated rows, extra columns are ignored, an empty table gives no rows.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                texts = part.column("text").fill_null("")
                yield pa.record_batch(
                    [part.column("doc_id"), pa.compute.binary_length(texts).cast(pa.int64()), pa.array(count_tokens(texts.to_pylist(), path), pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
