"""Cross-tokenizer alignment: groups and links of the tokens of two tokenizers over one text.

Both encode the same bytes, so a token is a byte range. The list of end offsets of one tokenizer is intersected with
the other's by galloping: the shorter list drives exponential and then binary searches into the longer one, each
from the place that a neighbour has found. Common ends cut the tokens into groups; the difference of the ranks of two
neighbours is the range of tokens that a token overlaps. All texts of a chunk are one such intersection, as their
bytes stand one after another and texts end at a common end.

A's ids come from a faster library where the file's ids are merge ranks, as they are in the byte-level file: its ids are
the same for every text (the tests go over all code points).

How many documents hold a pair of linked tokens is counted over the corpus. A document's pairs are kept with it;
pairs that are held by more than a stated share of all kept ones, a bounded number, are sent to every task, and
the others are joined.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import chunks, ragged_ranges
from .shared import Stages

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A pair is sent to every task if it makes more than this share of all (document, pair) rows: 250,000 pairs at most.
COMMON_SHARE = 1 / 250_000


def ranks(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """How many elements of the sorted ``long`` are smaller than each element of the sorted ``short``, by galloping.

    In rounds of halved strides, an element starts from the rank of its left neighbour of the round before, goes on
    in doubled steps until it has passed its place, and is placed by halving the last step.
    """
    found = np.zeros(len(short), np.int64)
    stride = 1 << max(len(short) - 1, 0).bit_length()
    at, low = np.arange(min(1, len(short))), np.zeros(min(1, len(short)), np.int64)
    while len(at) or stride > 1:
        values, step, going = short[at], np.ones(len(at), np.int64), np.arange(len(at))
        while len(going):
            probe = low[going] + step[going] - 1
            going = going[(probe < len(long)) & (long[np.minimum(probe, len(long) - 1)] < values[going])]
            low[going] += step[going]
            step[going] *= 2
        high = np.minimum(low + step - 1, len(long))
        going = np.flatnonzero(low < high)
        while len(going):
            middle = (low[going] + high[going]) // 2
            less = long[middle] < values[going]
            low[going[less]] = middle[less] + 1
            high[going[~less]] = middle[~less]
            going = going[low[going] < high[going]]
        found[at] = low
        stride //= 2
        if not stride:
            break
        at = np.arange(stride, len(short), 2 * stride)
        low = found[at - stride]
    return found


@dataclass(frozen=True)
class Aligned:
    """Tokens of some texts: ids, and for each text the number of its first one (and the number of all at the end).

    ``ends_a, ends_b``: numbers of the last tokens of each group. ``link_a, link_b``: tokens whose byte ranges overlap.
    """

    a: np.ndarray
    b: np.ndarray
    bounds_a: np.ndarray
    bounds_b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Last tokens of the groups and links ``(ends_a, ends_b, link_a, link_b)`` of two lists of end offsets."""
    if len(ends_a) > len(ends_b):
        b, a, y, x = align_ends(ends_b, ends_a)
        return a, b, x, y
    last = ranks(ends_a, ends_b)  # the token that holds the last byte of each driving token
    common = ends_b[last] == ends_a if len(last) else np.zeros(0, bool)
    first = np.concatenate(([0], last[:-1] + common[:-1])) if len(last) else last
    sizes = last - first + 1
    return np.flatnonzero(common), last[common], np.repeat(np.arange(len(last)), sizes), ragged_ranges(first, sizes)


def _byte_level() -> dict[str, int]:
    """The sign that stands for each byte: itself if it can be printed, else one of the signs from 256 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printed)]
    return {chr(b): b for b in printed} | {chr(256 + k): b for k, b in enumerate(others)}


#: Runs of white space from which on a text goes to the slower library: the faster one cannot look so far ahead.
LONG_BLANK = re.compile(r"\s{5000}")


def _fast_library(path: str, tokens: dict[str, int], signs: dict[str, int]):
    """A faster library with the vocabulary of a byte-level file; None if its ids are not the ranks of its merges.

    It has the same ids for all texts then: words are cut by the same classes of signs and merged by the same ranks.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        merges = json.load(file)["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    if any(tokens.get("".join(p)) != 256 + k for k, p in enumerate(pairs)) or any(tokens.get(s, 256) > 255 for s in signs):
        return None
    ranks = {bytes(signs[c] for c in token): i for token, i in tokens.items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Pair:
    """Two tokenizers and the bytes of their tokens. A encodes a space and the text, B the text, with a space of its own."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.library_a, self.library_b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.library_a.encode_special_tokens = True
        signs, known = _byte_level(), self.library_a.get_vocab(with_added_tokens=True)
        self.fast_a = _fast_library(path_a, known, signs)
        self.bytes_a = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.bytes_a[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        piece = self.library_b.id_to_piece
        self.bytes_b = [
            bytes([int(piece(i)[3:5], 16)]) if self.library_b.is_byte(i) else piece(i).replace("▁", " ").encode() for i in range(self.library_b.get_piece_size())
        ]
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in t]) for t in (self.bytes_a, self.bytes_b))
        # decimal ids with the sign behind them: in a group, before the other side, in a group, before the next group
        self.signs = [f"{i}{c}".encode() for size, ends in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for i in range(size) for c in ends]

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of each text by A and B; none where a text is null or empty or does not come back from its tokens."""
        a: list[list[int]] = [[] for _ in texts]
        b: list[list[int]] = [[] for _ in texts]
        some = [k for k, t in enumerate(texts) if t]
        by_b = self.library_b.encode([texts[k] for k in some], num_threads=1) if some else []
        for k, y in zip(some, by_b):
            whole, x = b" " + texts[k].encode(), self.encode_a(" " + texts[k])
            if b"".join(map(self.bytes_a.__getitem__, x)) == whole == b"".join(map(self.bytes_b.__getitem__, y)):
                a[k], b[k] = x, y
        return a, b

    def encode_a(self, text: str) -> list[int]:
        if self.fast_a is None or LONG_BLANK.search(text):
            return self.library_a.encode(text, add_special_tokens=False).ids
        return self.fast_a.encode_ordinary(text)

    def align(self, texts: list[str | None]) -> Aligned:
        sides = []
        for ids in self.encode(texts):
            sides.append((np.concatenate([np.zeros(0, np.int64), *ids]).astype(np.int64), np.concatenate(([0], np.cumsum([len(x) for x in ids])))))
        (a, bounds_a), (b, bounds_b) = sides
        return Aligned(a, b, bounds_a, bounds_b, *align_ends(np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])))

    def digests(self, x: Aligned) -> list[str]:
        """SHA-256 of each text's groups as ``a,a|b;a|b,b``; an empty string for a text without tokens."""
        groups = np.arange(len(x.ends_a))
        in_a, in_b = np.diff(x.ends_a, prepend=-1), np.diff(x.ends_b, prepend=-1)
        line = np.zeros(len(x.a) + len(x.b), np.int64)
        # a group's tokens of A come behind all tokens of B of the groups before it, those of B behind its own of A
        last_a, last_b = np.zeros(len(x.a), np.int64), np.zeros(len(x.b), np.int64)
        last_a[x.ends_a] = last_b[x.ends_b] = 1
        line[np.arange(len(x.a)) + np.repeat(x.ends_b + 1 - in_b, in_a)] = 2 * x.a + last_a
        line[np.arange(len(x.b)) + np.repeat(x.ends_a[groups] + 1, in_b)] = 2 * (x.b + len(self.bytes_a)) + last_b
        out = []
        for low, high in zip((x.bounds_a + x.bounds_b)[:-1], (x.bounds_a + x.bounds_b)[1:]):
            own = b"".join(map(self.signs.__getitem__, line[low:high].tolist()))
            out.append(hashlib.sha256(own[:-1]).hexdigest() if own else "")
        return out


@lru_cache(maxsize=1)
def _pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or public_tokenizers.path(FILE_A), path_b or public_tokenizers.path(FILE_B)


def _per_chunk(paths: tuple[str, str], rows: Callable[[Pair, pa.RecordBatch, Aligned], pa.RecordBatch]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*paths)
        for batch in batches:
            for part in chunks(batch):
                yield rows(pair, part, pair.align(part.column("text").to_pylist()))

    return run


def _inputs(docs: DataFrame) -> tuple[DataFrame, str]:
    return docs.select("doc_id", F.col("text").cast("string").alias("text")), docs.schema["doc_id"].dataType.simpleString()


def token_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per group of a text: ``doc_id, place`` (number in its text), ``a_ids, b_ids, bytes``.

    Texts without tokens (see ``alignment_report``) have no rows.
    """

    def rows(pair: Pair, part: pa.RecordBatch, x: Aligned) -> pa.RecordBatch:
        lists = lambda ids, ends: pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends + 1)), pa.int32()), pa.array(ids, pa.int32()))
        row = np.searchsorted(x.bounds_a, x.ends_a, side="right") - 1
        first = np.searchsorted(row, row)
        size = np.diff(np.cumsum(pair.sizes_a[x.a])[x.ends_a], prepend=0)
        columns = [part.column("doc_id").take(pa.array(row)), pa.array(np.arange(len(row)) - first, pa.int64()), lists(x.a, x.ends_a), lists(x.b, x.ends_b), pa.array(size, pa.int64())]
        return pa.record_batch(columns, ["doc_id", "place", "a_ids", "b_ids", "bytes"])

    docs, kind = _inputs(docs)
    return docs.mapInArrow(_per_chunk(_paths(path_a, path_b), rows), f"doc_id {kind}, place long, a_ids array<int>, b_ids array<int>, bytes long")


def _texts_with_pairs(docs: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """A row per document with its counts, digest and distinct pairs (``a * wide + b``) and how often each is linked."""

    def rows(pair: Pair, part: pa.RecordBatch, x: Aligned) -> pa.RecordBatch:
        wide = len(pair.bytes_b)
        every = wide * len(pair.bytes_a)
        row = np.searchsorted(x.bounds_a, x.link_a, side="right") - 1
        keys, times = np.unique(row * every + x.a[x.link_a] * wide + x.b[x.link_b], return_counts=True)
        bounds = pa.array(np.searchsorted(keys, np.arange(part.num_rows + 1) * every), pa.int32())
        count = lambda of, at: np.diff(np.searchsorted(of, at))
        columns = [
            part.column("doc_id"), np.diff(x.bounds_a), np.diff(x.bounds_b), count(x.ends_a, x.bounds_a), count(row, np.arange(part.num_rows + 1)),
            pair.digests(x), pa.ListArray.from_arrays(bounds, pa.array(keys % every)), pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32())),
        ]
        return pa.record_batch([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    docs, kind = _inputs(docs)
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"
    return docs.mapInArrow(_per_chunk(paths, rows), schema).withColumn("row", F.monotonically_increasing_id())


def _count_pairs(texts: DataFrame, wide: int) -> DataFrame:
    """``pair, n_docs, best``: how many documents hold a pair, and whether it is its A id's highest, ties included."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, n = np.unique(batch.column("pairs").flatten().to_numpy(zero_copy_only=False), return_counts=True)
            yield pa.record_batch([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    counts = texts.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n_docs"))
    return counts.withColumn("a_id", F.expr(f"pair div {wide}"))


def pair_counts(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``a_id, b_id, n_docs, best``: the linked pairs of the corpus with the number of documents that hold each."""
    stages, paths = Stages(docs.sparkSession), _paths(path_a, path_b)
    wide = len(_pair(*paths).bytes_b)
    counts = _with_best(stages.keep(_count_pairs(_texts_with_pairs(docs, paths), wide), "counts"))
    return counts.select(F.col("a_id").cast("int"), (F.col("pair") % wide).cast("int").alias("b_id"), "n_docs", "best")


def _with_best(counts: DataFrame) -> DataFrame:
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))  # a row per id of A at most
    return counts.join(F.broadcast(most), "a_id").select("a_id", "pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Special strings in texts are plain text. Null and empty texts, and texts whose tokens do not give back a space and
    the text, have no tokens: all zero, and an empty ``groups_sha256``. Repeated rows, also those with a null id, count
    and return as often as they stand; extra columns are ignored; an empty table gives no rows.
    """
    spark, stages, paths = docs.sparkSession, Stages(docs.sparkSession), _paths(path_a, path_b)
    wide = len(_pair(*paths).bytes_b)
    texts = stages.keep(_texts_with_pairs(docs, paths), "texts")
    counted = stages.keep(_count_pairs(texts, wide), "counted")
    counts = stages.keep(_with_best(counted), "counts")
    stages.drop("counted")
    total = counts.agg(F.sum("n_docs")).first()[0] or 0
    often = F.col("n_docs") > COMMON_SHARE * total
    common = counts.where(often).select("pair", "n_docs", "best").toPandas().sort_values("pair")
    table = spark.sparkContext.broadcast((common.pair.to_numpy(np.int64), common.n_docs.to_numpy(np.int64), common.best.to_numpy(bool)))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n_docs, best = table.value
        for batch in batches:
            lists = batch.column("pairs")
            own, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("pairs", "times"))
            edges = np.concatenate(([0], np.cumsum(pa.compute.list_value_length(lists).to_numpy())))
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            hit = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            weights = [np.where(hit, times * x[at], 0) if len(pairs) else np.zeros(len(own), np.int64) for x in (best, n_docs)]
            sums = [np.diff(np.concatenate(([0], np.cumsum(w)))[edges]) for w in weights]
            bounds = pa.array(np.concatenate(([0], np.cumsum(~hit)))[edges], pa.int32())
            rare = [pa.ListArray.from_arrays(bounds, pa.array(x[~hit], t)) for x, t in ((own, pa.int64()), (times, pa.int32()))]
            yield pa.record_batch([batch.column("row"), *(pa.array(s, pa.int64()) for s in sums), *rare], ["row", "best", "total", "pairs", "times"])

    looked_up = texts.select("row", "pairs", "times").mapInArrow(look_up, "row long, best long, total long, pairs array<long>, times array<int>")
    found = stages.keep(looked_up, "found")
    uses = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("u")).select("row", F.col("u.pairs").alias("pair"), F.col("u.times").alias("n"))
    rare = uses.join(counts.where(~often).select("pair", "n_docs", F.col("best").alias("top")), "pair")
    rare = rare.select("row", F.when(F.col("top"), F.col("n")).otherwise(0).cast("long").alias("best"), (F.col("n") * F.col("n_docs")).alias("total"))
    sums = found.select("row", "best", "total").union(rare).groupBy("row").agg(F.sum("best").alias("n_best"), F.sum("total").alias("count_sum"))
    return texts.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
