"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the powers of two in n, none longer than a
sequence. Pieces of one length form a bucket, and each piece is a sequence of its own: no sequence crosses
documents, and as every length is a power of two, none is padded.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from .arrays import RELEASE, chunks, ragged_ranges
from .merges import Merges
from .shared import Stages

VOCABULARY = "word_bpe_49k.json"
END = 2
LENGTH = 4096
#: Words whose ids a Python worker keeps; beyond that it starts anew.
CACHE = 500_000
#: The pre-token pattern of the vocabulary's file; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_loaded: dict[str, _Encoder] = {}


class _Encoder:
    """Ids of white-space separated words, kept by word.

    The vocabulary drops white space and no merge crosses it, so the ids of a text are those of its words.
    Words of Latin letters go through the array merges; words with other letters, or with a special string,
    through the tokenizer library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.merges, self.split = Tokenizer.from_file(path), Merges(path), regex.compile(PATTERN)
        self.index: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.index, self.flat = {"": 0}, np.zeros(0, np.int32)
        self.begin, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        pieces: list[bytes] = []
        of: list[int] = []
        odd: list[int] = []
        for i, word in enumerate(words):
            if max(word) >= "ɐ" or "<|" in word:
                odd.append(i)
                continue
            low = word.lower() if word.isascii() else unicodedata.normalize("NFC", word).lower()
            if low.isalpha():
                pieces.append(low.encode())
                of.append(i)
            elif low[:-1].isalpha() and low[-1] in ".,":
                pieces += (low[:-1].encode(), low[-1].encode())
                of += (i, i)
            else:
                parts = self.split.findall(low)
                pieces += [p.encode() for p in parts]
                of += [i] * len(parts)
        flat, counts = self.merges.run(pieces)
        size = np.zeros(len(words), np.int64)
        np.add.at(size, np.array(of, np.int64), counts)
        by_library = [self.library.encode(words[i], add_special_tokens=False).ids for i in odd]
        begin = np.cumsum(size) - size
        for i, ids in zip(odd, by_library):
            begin[i], size[i] = len(flat), len(ids)
            flat = np.append(flat, ids) if len(odd) < 50 else flat
        if len(odd) >= 50:
            lens = np.array([len(x) for x in by_library], np.int64)
            begin[odd] = len(flat) + np.cumsum(lens) - lens
            flat = np.concatenate([flat, *[np.array(x, np.int64) for x in by_library]])
        base = len(self.flat)
        self.index.update(zip(words, range(len(self.begin), len(self.begin) + len(words))))
        self.begin = np.concatenate((self.begin, begin + base))
        self.size = np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, flat.astype(np.int32)))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        seen = set().union(*cut)
        fresh = seen.difference(self.index)
        if fresh:
            if len(self.index) + len(fresh) > CACHE:
                self.clear()
                fresh = seen - {""}
            self.learn(list(fresh))
        find, out = self.index.__getitem__, []
        for words in cut:
            at = np.fromiter(map(find, words), np.int64, len(words))
            out.append(self.flat[ragged_ranges(self.begin[at], self.size[at])])
        return out


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """Ids of each text without special tokens added."""
    if path not in _loaded:
        _loaded[path] = _Encoder(path)
        RELEASE.append(_loaded.clear)
    return _loaded[path].encode(texts)


def power_lengths(n: int, longest: int = LENGTH) -> list[int]:
    """The pieces of ``n`` tokens: as many of ``longest`` as fit, then the powers of two of the rest, falling."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(longest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(docs: DataFrame, path: str | None = None, end: int = END, longest: int = LENGTH) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids array<int>, ids_crc32, doc_tokens``.

    A null or empty text is the end id alone. ``longest`` must be a power of two.
    """
    path = path or public_tokenizers.path(VOCABULARY)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                ids = encode(part.column("text").fill_null("").to_pylist(), path)
                row, start, length, crc, flat = [], [], [], [], []
                for i, own in enumerate(ids):
                    own = np.append(own, end).astype("<u4")
                    at = 0
                    for n in power_lengths(len(own), longest):
                        row.append(i)
                        start.append(at)
                        length.append(n)
                        crc.append(zlib.crc32(own[at : at + n].tobytes()))
                        at += n
                    flat.append(own)
                flat = np.concatenate(flat).astype(np.int32)
                bounds = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                row = pa.array(row, pa.int64())
                totals = np.array([len(x) + 1 for x in ids], np.int64)
                yield pa.record_batch(
                    [part.column("doc_id").take(row), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)), pa.array(crc, pa.int64()), pa.array(totals).take(row)],
                    ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens"],
                )

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, path: str | None = None, end: int = END, longest: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset`` (0: each piece is a sequence).

    Sequences are numbered bucket by bucket, shortest first: a piece's number is its row in a written file plus
    the rows of its bucket in files before, plus all shorter buckets. The numbers are those of the written table,
    so they don't change when a task is run again. Repeated rows give pieces of their own; an empty table none.
    ``with_ids`` keeps the token ids.
    """
    stages = Stages(docs.sparkSession)
    cut = pieces(docs, path, end, longest)
    kept = stages.keep((cut if with_ids else cut.drop("ids")).sortWithinPartitions("length"), "pieces")
    rows = kept.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # one row per file and length: files are sorted by length, so a bucket is one run of rows in each
    runs = rows.groupBy("length", "_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.orderBy("length", "_file").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_n", "_first")
    placed = rows.join(runs, ["length", "_file"])
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_base") + F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
