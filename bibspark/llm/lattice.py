"""Subword lattice likelihood.

The pieces of an existing vocabulary span a lattice over the bytes of each word; every path is a segmentation.
A word's probability is the sum over all paths of the product of the pieces' probabilities, found by a forward
recursion in log space, and a text's log probability is the sum over its words and its end.

The pieces and their scores are taken from the file. Log probabilities are used as they are; a file with merge ranks
gives each piece the weight of its rank by Zipf's law. From there the weights are fitted to the training texts: words are
counted over the whole corpus, the lattice of each distinct word shares its count among the pieces of its segmentations,
and the expected counts are normalised: a few rounds at most, fewer if the likelihood of the training words hardly grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .arrays import CHUNK_BYTES, PLAIN, Words, chunks, ragged_ranges, span_hashes
from .shared import Stages, crc_of_id, split_by

VOCABULARY = "piece_bpe_32k.model"
#: Bytes of words in one lattice.
CELLS = 1 << 16
#: Rounds of fitting at most, and the relative growth of the log likelihood from which another round follows.
ROUNDS, TOLERANCE = 2, 1e-3
#: Words with at least this share of all tokens are looked up in a broadcast table of 24 bytes a row; as shares
#: add up to one, it has a million rows at most.
COMMON_SHARE = 1e-6
_BEGIN = "\u2581".encode()
_FILTER_BITS = 20


class Lattice:
    """The pieces of a vocabulary by the fingerprints of their bytes, with natural log probabilities."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        self.pieces, self.logs = pieces, logs
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        hashes = span_hashes(np.frombuffer(b"".join(pieces), np.uint8).astype(np.uint64) + np.uint64(1), ends - sizes, ends)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[hashes >> np.uint64(64 - _FILTER_BITS)] = True
        self.longest = int(sizes.max())

    def arcs(self, words: list[bytes]):
        """Log probability (and piece) of each span ``[begin, begin + n)``: arrays word x begin x (n - 1)."""
        width = max(map(len, words))
        data = np.zeros((len(words), width), np.uint64)
        for row, word in zip(data, words):
            row[: len(word)] = np.frombuffer(word, np.uint8)
        flat = (data + np.uint64(1)).ravel()
        left = np.array([len(w) for w in words])[:, None] - np.arange(width)[None, :]
        most = min(self.longest, width)
        logs, piece = np.full((len(words), width, most), -np.inf), np.full((len(words), width, most), -1, np.int32)
        for n in range(1, most + 1):
            row, begin = np.nonzero(left >= n)
            hashed = span_hashes(flat, row * width + begin, row * width + begin + n)
            maybe = np.flatnonzero(self.filter[hashed >> np.uint64(64 - _FILTER_BITS)])
            at = np.minimum(np.searchsorted(self.hashes, hashed[maybe]), len(self.hashes) - 1)
            hit = self.hashes[at] == hashed[maybe]
            row, begin, found = row[maybe[hit]], begin[maybe[hit]], self.order[at[hit]]
            logs[row, begin, n - 1], piece[row, begin, n - 1] = self.logs[found], found
        return logs, piece

    def forward(self, logs: np.ndarray) -> np.ndarray:
        """Log probability of all segmentations of the first ``j`` bytes, for each word and ``j``."""
        rows, width, most = logs.shape
        alpha = np.full((rows, width + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, width + 1):
            n = np.arange(1, min(j, most) + 1)
            alpha[:, j] = _log_sum(alpha[:, j - n] + logs[:, j - n, n - 1])
        return alpha

    def backward(self, logs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log probability of all segmentations from byte ``j`` to the end of each word."""
        rows, width, most = logs.shape
        beta = np.full((rows, width + 1), -np.inf)
        beta[np.arange(rows), sizes] = 0
        for j in range(width - 1, -1, -1):
            n = np.arange(1, min(width - j, most) + 1)
            inner = _log_sum(beta[:, j + n] + logs[:, j, n - 1])
            beta[:, j] = np.where(j < sizes, inner, beta[:, j])
        return beta

    def log_probabilities(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability over all its segmentations."""
        out = np.zeros(len(words))
        for part in _by_length(words):
            own = [words[i] for i in part]
            out[part] = self.forward(self.arcs(own)[0])[np.arange(len(own)), [len(w) for w in own]]
        return out

    def expected_counts(self, words: list[bytes], counts: np.ndarray) -> tuple[np.ndarray, float]:
        """How often each piece is expected in the words, each as often as counted, and the words' log likelihood."""
        out, likelihood = np.zeros(len(self.pieces)), 0.0
        for part in _by_length(words):
            own = [words[i] for i in part]
            sizes = np.array([len(w) for w in own])
            logs, piece = self.arcs(own)
            alpha, beta = self.forward(logs), self.backward(logs, sizes)
            total = beta[:, 0]
            likelihood += float(total @ counts[part])
            for n in range(1, logs.shape[2] + 1):
                row, begin = np.nonzero(piece[:, :, n - 1] >= 0)
                share = np.exp(alpha[row, begin] + logs[row, begin, n - 1] + beta[row, begin + n] - total[row])
                out += np.bincount(piece[row, begin, n - 1], share * counts[part][row], len(out))
        return out, likelihood


def _log_sum(x: np.ndarray) -> np.ndarray:
    most = np.maximum(x.max(axis=1), -1e300)
    with np.errstate(divide="ignore"):
        return most + np.log(np.exp(x - most[:, None]).sum(axis=1))


def _by_length(words: list[bytes]) -> Iterator[np.ndarray]:
    """Groups of words of like length, each of about ``CELLS`` bytes."""
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        n = max(1, CELLS // int(sizes[order[at]]))
        while n > 1 and n * int(sizes[order[min(at + n, len(order)) - 1]]) > 2 * CELLS:
            n //= 2
        yield order[at : at + n]
        at += n


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """The ordinary pieces of a sentencepiece file that can stand in one word, one piece for each byte, and their logs.

    Bytes that are no pieces of the file are as likely as its last piece.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = np.array([model.get_score(i) for i in ids])
    if len(set(scores.tolist())) == len(scores) and np.all(scores == np.round(scores)):
        scores = -np.log(scores.max() - scores + 2)  # merge ranks
    logs = {p: s for p, s in zip((model.id_to_piece(i).encode() for i in ids), scores.tolist()) if _BEGIN not in p[1:]}
    for b in range(256):
        logs.setdefault(bytes([b]), float(scores.min()))
    pieces = sorted(logs)
    out = np.array([logs[p] for p in pieces])
    return pieces, out - np.log(np.exp(out).sum())


def _ragged_binary(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """``data[start:end]`` of each span as an Arrow binary array."""
    sizes = end - start
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[ragged_ranges(start, sizes)].tobytes())])


def _word_counts(docs: DataFrame) -> DataFrame:
    """``h, word, c``: every word of the corpus with its count in training texts (0 for words of held-out ones)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, limit=4 * CHUNK_BYTES):
                words = Words(part.column("text"), PLAIN, lower=True)
                train = ~part.column("held_out").to_numpy(zero_copy_only=False)
                hashed, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
                counts = np.bincount(inverse, train[words.rows()], len(hashed)).astype(np.int64)
                spans = _ragged_binary(words.data, words.start[first], words.end[first])
                yield pa.record_batch([pa.array(hashed.view(np.int64)), spans, pa.array(counts)], ["h", "word", "c"])

    rows = docs.select("text", "held_out").mapInArrow(count, "h long, word binary, c long")
    return rows.groupBy("h", "word").agg(F.sum("c").alias("c"))


def _estimate(words: DataFrame, pieces: list[bytes], logs: np.ndarray) -> tuple[np.ndarray, float]:
    """One round of expectation: new log probabilities, one added to each expected count, and the old ones' log likelihood."""
    shared = words.sparkSession.sparkContext.broadcast((pieces, logs))

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, total, likelihood = Lattice(*shared.value), np.zeros(len(pieces)), 0.0
        for batch in batches:
            own = [_BEGIN + w for w in batch.column("word").to_pylist()]
            if own:
                counts, more = lattice.expected_counts(own, batch.column("c").to_numpy())
                total, likelihood = total + counts, likelihood + more
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(some, -1), pa.int64()), pa.array(np.append(total[some], likelihood))], ["piece", "n"])

    rows = words.where("c > 0").select("word", "c").mapInArrow(expect, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
    found = rows.toPandas()  # one row a piece of the vocabulary
    known = found.piece.to_numpy(np.int64) >= 0
    counts = np.ones(len(pieces))
    counts[found.piece.to_numpy(np.int64)[known]] += found.n.to_numpy(float)[known]
    return np.log(counts / counts.sum()), float(found.n.to_numpy(float)[~known].sum())


def fitted(words: DataFrame, pieces: list[bytes], logs: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The log probabilities after at most so many rounds over counted words (``word, c``)."""
    before = None
    for _ in range(rounds):
        following, likelihood = _estimate(words, pieces, logs)
        if likelihood == 0 or before is not None and likelihood - before < TOLERANCE * abs(before):
            break  # nothing to learn from, or the last round has changed little
        logs, before = following, likelihood
    return logs


def lattice_scores(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS, held: int = 2, divisor: int = 7) -> DataFrame:
    """One row per document: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are the words, ASCII letters lower-cased, and one end. ``base_score`` is an add-one unigram score over
    training tokens; ``score`` sums the log10 lattice probability of each word, times the share of words among
    tokens, and the log10 share of ends. Null texts are empty: one token, the end. Repeated rows count and return
    as often as they stand; extra columns are ignored; without training rows nothing is known and the pieces keep
    the file's weights; an empty table gives no rows.
    """
    stages = Stages(docs.sparkSession)
    pieces, logs = vocabulary(path or public_tokenizers.path(VOCABULARY))
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), split_by(crc_of_id(), divisor, held).alias("held_out"))
    counted = stages.keep(_word_counts(docs), "counted")
    logs = fitted(counted, pieces, logs, rounds)
    shared = docs.sparkSession.sparkContext.broadcast((pieces, logs))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for batch in batches:
            values = lattice.log_probabilities([_BEGIN + w for w in batch.column("word").to_pylist()])
            yield pa.record_batch([batch.column("h"), batch.column("c"), pa.array(values / np.log(10.0))], ["h", "c", "log_p"])

    words = stages.keep(counted.mapInArrow(score, "h long, c long, log_p double"), "words")
    stages.drop("counted")
    totals = words.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = docs.where(~F.col("held_out")).count()
    n_train, distinct = (totals.n or 0) + ends, totals.v + (ends > 0)
    end_share = (ends + 1) / (n_train + 2)
    common = words.where(F.col("c") >= max(1, COMMON_SHARE * n_train)).toPandas().sort_values("h")
    table = docs.sparkSession.sparkContext.broadcast((common.h.to_numpy(np.int64), common.c.to_numpy(np.int64), common.log_p.to_numpy(float)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, values = table.value
        logged = np.log10(counts + 1.0)
        for batch in batches:
            for part in chunks(batch):
                words = Words(part.column("text"), PLAIN, lower=True)
                hashed, rows = words.hashes().view(np.int64), words.rows()
                at = np.minimum(np.searchsorted(known, hashed), max(len(known) - 1, 0))
                hit = known[at] == hashed if len(known) else np.zeros(len(hashed), bool)
                at = at[hit]
                total = lambda x: np.bincount(rows[hit], x, part.num_rows)
                rare, owner = hashed[~hit], rows[~hit]
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.record_batch(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(words.counts + 1, pa.int64()), pa.array(total(None), pa.int64()),
                        pa.array(total(logged[at]) if len(known) else np.zeros(part.num_rows)), pa.array(total(values[at]) if len(known) else np.zeros(part.num_rows)),
                        pa.ListArray.from_arrays(pa.array(bounds), pa.array(rare)),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_common", "base", "value", "rare"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    scanned = docs.mapInArrow(scan, f"doc_id {kind}, held_out boolean, n_tokens long, n_common long, base double, value double, rare array<long>")
    scanned = stages.keep(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    uses = scanned.select("row", F.explode("rare").alias("h"))
    rare = uses.join(words.where(F.col("c") < max(1, COMMON_SHARE * n_train)), "h")
    rare = rare.groupBy("row").agg(F.count_if(F.col("c") > 0).alias("known"), F.sum(F.log10(F.col("c") + 1.0)).alias("more_base"), F.sum("log_p").alias("more"))
    n = F.col("n_tokens")
    floor = float(np.log10(n_train + distinct + 1))
    return scanned.drop("rare").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_common") + F.coalesce("known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(int(n_train)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + float(np.log10(ends + 1)) - n * floor).alias("base_score"),
        (F.col("value") + F.coalesce("more", F.lit(0.0)) + (n - 1) * float(np.log10(1 - end_share)) + float(np.log10(end_share))).alias("score"),
    )
