"""Quality of documents from a conditional random field over their lines.

Every line has features of its own characters and words and of the lines before and after it. The field is trained on
labelled documents, whose lines all carry the document's label, and gives each line a probability of being good by
forward-backward. A document's quality is the mean of these weighted by length, put on the scale of a probability by a
logistic curve fitted on the same documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwatch.llm import crf
from fleetwatch.llm.support import pieces, utf8

#: Bounds of the training sample: labelled documents, and lines of one of them.
SAMPLE_DOCS = 3000
SAMPLE_LINES = 2000

_CLASS = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 sentence mark, 6 symbol, 7 not ASCII
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _c.isspace() else 5 if _c in ".,;:?'-" else 6
_CLASS[128:] = 7
N_OWN = 15
N_FEATURES = 3 * N_OWN + 3


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(lines x N_FEATURES, length of each line in bytes plus one); a null or empty text is one empty line."""
    raw = utf8(text)
    lines = raw.split(b"\n")
    n = len(lines)
    size = np.fromiter(map(len, lines), np.int64, n)
    kinds = _CLASS[np.frombuffer(raw + b"\n", np.uint8)]
    line = np.repeat(np.arange(n), size + 1)
    count = np.bincount(line * 8 + kinds, minlength=8 * n).reshape(n, 8).astype(float)
    count[:, 4] -= 1  # the line's own end
    words = [x.split() for x in lines]
    n_words = np.fromiter(map(len, words), float, n)
    n_kinds = np.fromiter((len(set(w)) for w in words), float, n)
    doubled = np.fromiter((sum(map(eq, w, w[1:])) for w in words), float, n)
    often = Counter(lines)
    copies = np.fromiter((often[x] for x in lines), float, n)
    closed = np.fromiter((x[-1:] in (b".", b"!", b"?") for x in lines), float, n)
    chars, letters, at_least = np.maximum(size, 1), np.maximum(count[:, 1] + count[:, 2] + count[:, 7], 1), np.maximum(n_words, 1)
    own = np.empty((n, N_OWN))
    own[:, 0] = np.log1p(size)
    own[:, 1] = np.log1p(n_words)
    own[:, 2] = np.minimum(size / at_least, 30) / 10
    own[:, 3] = count[:, 2] / letters
    own[:, 4] = count[:, 3] / chars
    own[:, 5] = count[:, 4] / chars
    own[:, 6] = count[:, 5] / chars
    own[:, 7] = count[:, 6] / chars
    own[:, 8] = count[:, 7] / chars
    own[:, 9] = np.sqrt(count[:, 6] / at_least)
    own[:, 10] = 1 - n_kinds / at_least
    own[:, 11] = doubled / at_least
    own[:, 12] = np.log(copies)
    own[:, 13] = closed
    own[:, 14] = n_words <= 1
    x = np.zeros((n, N_FEATURES))
    x[:, :N_OWN] = own
    x[1:, N_OWN : 2 * N_OWN] = own[:-1]
    x[:-1, 2 * N_OWN : 3 * N_OWN] = own[1:]
    x[0, -3], x[-1, -2], x[:, -1] = 1, 1, 1
    return x, size + 1


@dataclass
class QualityModel:
    field: crf.Model
    slope: float
    shift: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of good quality for each text."""
        if not texts:
            return np.zeros(0)
        x, size, lengths = _stack(map(line_features, texts))
        return self._squash(_document(self.field, x, size, lengths))

    def _squash(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (mean - 0.5) + self.shift, -30, 30)))


def _stack(found) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = list(found)
    return np.concatenate([f for f, _ in found]), np.concatenate([s for _, s in found]), np.array([len(s) for _, s in found])


def _document(field: crf.Model, x: np.ndarray, size: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good."""
    good = crf.marginals(field, field.scores(x), lengths)[0][:, 1]
    starts = np.cumsum(lengths) - lengths
    return np.add.reduceat(good * size, starts) / np.add.reduceat(size, starts)


def train_quality(found: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> QualityModel:
    """Fit field and curve to documents given as line_features and labels 0 or 1; without documents all scores are 0.5."""
    if not found:
        return QualityModel(crf.train(np.zeros((0, N_FEATURES)), np.zeros(0, int), np.zeros(0, int)), 0.0, 0.0)
    x, size, lengths = _stack(found)
    field = crf.train(x, np.repeat(labels, lengths), lengths)
    mean = _document(field, x, size, lengths) - 0.5
    slope, shift = 4.0, 0.0
    for _ in range(50):  # Newton's method with a weak pull to the start, so that separable labels stay finite
        p = 1 / (1 + np.exp(-(slope * mean + shift)))
        weight = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((labels - p) * mean).sum() - 0.05 * (slope - 4), (labels - p).sum() - 0.05 * shift])
        curve = np.array([[(weight * mean**2).sum() + 0.05, (weight * mean).sum()], [(weight * mean).sum(), weight.sum() + 0.05]])
        move = np.linalg.solve(curve, grad)
        slope, shift = slope + float(np.clip(move[0], -5, 5)), shift + float(np.clip(move[1], -5, 5))
    return QualityModel(field, slope, shift)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> QualityModel:
    """Train on at most sample_docs labelled documents outside the held-out fold, the first in the order of a hash of
    their key; documents of more than sample_lines lines are not trained on. Null keys and labels other than 0 and 1
    are left out; a key labelled twice counts with its lowest label."""
    marked = labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key")))
    marked = marked.groupBy("key").agg(F.min("y").alias("y")).orderBy(F.xxhash64("key"), "key").limit(sample_docs)
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("body"))
    chosen = texts.join(F.broadcast(marked), "key")  # sample_docs rows; of rows that share a key, one text is taken
    chosen = chosen.groupBy("key").agg(F.min("body").alias("body"), F.min("y").alias("y"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [(k, y, *line_features(t)) for k, t, y in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            rows = [r for r in rows if len(r[3]) <= sample_lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32())]
                + [pa.array([r[i].astype(np.float32 if i == 2 else np.int64).tobytes() for r in rows], pa.binary()) for i in (2, 3)],
                names=["key", "y", "x", "size"],
            )

    rows = sorted(chosen.mapInArrow(describe, "key long, y int, x binary, size binary").toLocalIterator(), key=lambda r: r["key"])
    found = [(np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES).astype(float), np.frombuffer(r["size"], np.int64)) for r in rows]
    return train_quality(found, np.array([r["y"] for r in rows], int))


def score_documents(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, score and predicted (1 from 0.5 on) of every row; repeated rows score alike, null texts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            score = shared.value.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))], names=["key", "held_out", "score", "predicted"])

    narrow = docs.select(F.col(key).cast("long").alias("key"), held_out(F.col(key).cast("long")).alias("held_out"), F.col(text).cast("string").alias("body"))
    return narrow.mapInArrow(run, "key long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """docs without the rows that score below the threshold; all columns, whatever their names, stay as they are."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 256):
            if batch.num_rows:
                yield batch.filter(pa.array(shared.value.score(batch.column(at).to_pylist()) >= threshold))

    return docs.mapInArrow(run, docs.schema)
