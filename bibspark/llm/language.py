"""Language identification by blended-spectrum string kernels.

Two texts are compared by the byte n-grams (several lengths) that both contain; presence counts, not frequency.
Nyström landmarks turn the kernel into features, one-versus-rest kernel ridge regression is fitted on them, and
texts are scored in batches by two matrix products: presence with landmarks, features with weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from .arrays import LOWER, chunks
from .shared import crc_of_id, split_by

#: Labelled texts of each language that the fit reads, and those that become landmarks.
SAMPLE_PER_LANGUAGE, LANDMARKS_PER_LANGUAGE = 400, 60
#: n-gram lengths in bytes (at most four), slots that n-grams are hashed to, and the ridge.
LONGEST, SLOT_BITS, RIDGE = 4, 16, 1e-3
#: Texts whose presence rows are held at once.
ROWS = 256
_LETTER = regex.compile(r"\p{L}")


def slot_of(code: np.ndarray, n: int) -> np.ndarray:
    """Slot of an n-gram of up to four bytes, by a multiplicative hash of its code."""
    spread = (code ^ np.uint32(0x9E3779B9 * n & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    return (spread ^ (spread >> np.uint32(15))) * np.uint32(0xC2B2AE35) >> np.uint32(32 - SLOT_BITS)


def presence(texts: list[bytes]) -> np.ndarray:
    """A row per text: 1 in the slots of the n-grams it contains, of every length up to ``LONGEST``."""
    out = np.zeros((len(texts), 1 << SLOT_BITS), np.float32)
    for row, text in zip(out, texts):
        data = LOWER[np.frombuffer(text, np.uint8)].astype(np.uint32)
        code = data
        for n in range(1, min(LONGEST, len(data)) + 1):
            if n > 1:
                code = (code[:-1] << np.uint32(8)) | data[n - 1 :]
            row[slot_of(code, n)] = 1
    return out


@dataclass
class Model:
    """Landmark rows over their own slots, the Nyström map folded with the ridge weights, and the languages."""

    languages: list[str]
    slots: np.ndarray  # the slots that some landmark has
    landmarks: np.ndarray  # landmark x slot, each row of length 1
    weights: np.ndarray  # landmark x language
    bias: np.ndarray

    def kernel(self, texts: list[bytes]) -> np.ndarray:
        """Normalised presence kernel of each text with each landmark."""
        rows = presence(texts)[:, self.slots]
        rows /= np.maximum(np.sqrt(rows.sum(axis=1, keepdims=True)), 1)
        return rows @ self.landmarks.T

    def score(self, texts: list[bytes]) -> np.ndarray:
        return self.kernel(texts) @ self.weights + self.bias


def fit(texts: list[bytes], languages: list[str], per_language: int = LANDMARKS_PER_LANGUAGE) -> Model | None:
    """Fit on labelled texts; None without any."""
    names = sorted(set(languages))
    if not names:
        return None
    label = np.array([names.index(x) for x in languages])
    chosen = np.concatenate([np.flatnonzero(label == k)[:per_language] for k in range(len(names))])
    marks = presence([texts[i] for i in chosen])
    slots = np.flatnonzero(marks.any(axis=0))
    marks = marks[:, slots]
    marks /= np.maximum(np.sqrt(marks.sum(axis=1, keepdims=True)), 1)
    model = Model(names, slots, marks, np.zeros((len(chosen), len(names)), np.float32), np.zeros(len(names), np.float32))
    kernel = np.concatenate([model.kernel(texts[i : i + ROWS]) for i in range(0, len(texts), ROWS)]).astype(np.float64)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    used = values > 1e-6 * max(values[-1], 1e-12)
    nystrom = vectors[:, used] / np.sqrt(values[used])
    features = kernel @ nystrom
    centre = features.mean(axis=0)
    targets = np.where(label[:, None] == np.arange(len(names)), 1.0, 0.0)
    share = targets.mean(axis=0)
    gram = (features - centre).T @ (features - centre) + RIDGE * len(texts) * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, (features - centre).T @ (targets - share))
    model.weights = (nystrom @ solved).astype(np.float32)
    model.bias = (share - centre @ solved).astype(np.float32)
    return model


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, held: int = 2, divisor: int = 4) -> DataFrame:
    """At most ``per_language`` labelled training texts of each language, by a hash of the id and the text.

    Rows with null text or label, and held-out rows (``crc32(id) mod divisor = held``), are left out. The rank
    is limited in each task before rows are exchanged, so a language with most of the rows is harmless.
    """
    train = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~split_by(crc_of_id(), divisor, held))
    train = train.select("lang", "text", F.xxhash64(F.col("doc_id").cast("string")).alias("_at"), F.xxhash64("text").alias("_text"))
    order = Window.partitionBy("lang").orderBy("_at", "_text")
    return train.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= per_language).select("lang", "text", "_k")


def train_model(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, landmarks: int = LANDMARKS_PER_LANGUAGE) -> Model | None:
    """Fit on the bounded sample of ``docs`` (``doc_id, text, lang``)."""
    rows = sorted(labelled_sample(docs, per_language).collect(), key=lambda r: (r.lang, r["_k"]))
    return fit([r.text.encode() for r in rows], [r.lang for r in rows], landmarks)


def predict_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``; only the text decides.

    ``und`` with score 0 if the text is null or has no letter, or if nothing was learned. ``score`` is the ridge
    value of the language cut to 0..1. Ties go to the first language by name. Repeated rows give repeated rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in chunks(batch):
                for at in range(0, part.num_rows, ROWS):
                    some = part.slice(at, ROWS)
                    texts = [t if t and _LETTER.search(t) else None for t in some.column("text").to_pylist()]
                    names, scores = ["und"] * len(texts), [0.0] * len(texts)
                    rows = [i for i, t in enumerate(texts) if t is not None]
                    if known and rows:
                        values = known.score([texts[i].encode() for i in rows])
                        for i, own in zip(rows, values):
                            best = int(np.argmax(own))
                            names[i], scores[i] = known.languages[best], float(min(max(own[best], 0.0), 1.0))
                    yield pa.record_batch([some.column("doc_id"), some.column("held_out"), pa.array(names), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"), split_by(crc_of_id(), 4, 2).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """Learn from the labelled rows of ``docs`` that are not held out, and predict all."""
    return predict_language(docs, train_model(docs))
