"""Quality classifier: votes of the nearest labelled texts in a latent space.

Features of a text are hashed counts over its whole: words and marks, shapes of
neighbouring tokens, and how often tokens recur. Document frequencies come from
all documents. A truncated SVD of the weighted features of a bounded sample of
labelled texts gives the latent axes; every document's cosine with every sample
vector is computed, in blocks, and the nearest vote by their similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import append_columns, pieces
from shelfmark.llm.tokens import WORDS_AND_MARKS, Words, byte_view, mix

#: Buckets of words and marks, of shape pairs, and of recurrence.
WORD_BUCKETS, SHAPE_BUCKETS, RECUR_BUCKETS = 512, 448, 64
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS + RECUR_BUCKETS
#: Labelled texts that the model holds: the bound on what is collected and sent to every task.
SAMPLE = 6_000
RANK = 48
NEIGHBOURS = 40
#: Power of the cosine with which a neighbour votes.
SHARPNESS = 4
#: Texts whose cosines with the sample are held at once.
BLOCK = 512
#: Words of a text whose shapes are worked out at once.
PART = 1 << 18
SCORE = "score double, predicted int"
THRESHOLD = 0.3


def _ranges(owner: np.ndarray, feature: np.ndarray, docs: int) -> np.ndarray:
    return np.bincount(owner * BUCKETS + feature, minlength=docs * BUCKETS).reshape(docs, BUCKETS)


def counts(column: pa.Array) -> np.ndarray:
    """Feature counts of each text; a null or empty text has none."""
    words = Words(column, WORDS_AND_MARKS)
    if not len(words.hash):
        return np.zeros((words.docs, BUCKETS), np.int64)
    raw, _ = byte_view(column)
    out = _recurring(words)
    for first in range(0, len(words.hash), PART):
        # each part with the word after it, for the pair over the seam
        out += _shapes(raw, words, first, min(first + PART, len(words.hash)))
    return out


def _shapes(raw: np.ndarray, words: Words, begin: int, end: int) -> np.ndarray:
    """Counts of the words `begin` to `end`, and of the pairs that begin with them."""
    part = slice(begin, end + 1)
    starts, ends, doc, token = words.starts[part], words.ends[part], words.doc[part], words.hash[part]
    first, second = raw[starts], raw[np.minimum(starts + 1, len(raw) - 1)]
    mark = WORDS_AND_MARKS[first] == 2

    def upper(byte):
        return (byte >= 65) & (byte <= 90)

    case = np.where(upper(first), np.where(upper(second) & (ends - starts > 1), 2, 1), 0)
    size = np.minimum(ends - starts, 12) // 3
    shape = np.where(mark, token % np.uint64(4093), (16 + 8 * case + size).astype(np.uint64))
    pair_doc, pair = doc[1:], mix(shape[1:] * np.uint64(8191) + shape[:-1])
    inside = pair_doc == doc[:-1]
    own = slice(0, end - begin)
    return _ranges(doc[own], (token[own] % np.uint64(WORD_BUCKETS)).astype(np.int64), words.docs) + _ranges(
        pair_doc[inside], WORD_BUCKETS + (pair[inside] % np.uint64(SHAPE_BUCKETS)).astype(np.int64), words.docs
    )


def _recurring(words: Words) -> np.ndarray:
    """Counts of the tokens of each text by how often they recur in it."""
    order = np.lexsort((words.hash, words.doc))
    doc, token = words.doc[order], words.hash[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (token[1:] != token[:-1])
    starts = np.flatnonzero(new)
    times = np.diff(np.append(starts, len(doc)))
    share = times * 32 // words.counts[doc[starts]]
    recur = np.minimum(np.log2(times).astype(np.int64), 7) * 8 + np.minimum(share, 7)
    return np.bincount(
        doc[starts] * BUCKETS + WORD_BUCKETS + SHAPE_BUCKETS + recur, weights=times, minlength=words.docs * BUCKETS
    ).reshape(words.docs, BUCKETS).astype(np.int64)


def document_frequency(docs: DataFrame, text_col: str = "text") -> tuple[int, np.ndarray]:
    """(texts with features, texts in which each bucket occurs), over all documents."""

    def run(batches):
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for piece in _small(batch, "text"):
                have = counts(piece.column(0)) > 0
                total[:BUCKETS] += have.sum(axis=0)
                total[BUCKETS] += have.any(axis=1).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(BUCKETS + 1), pa.int32()), pa.array(total)], names=["bucket", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "bucket int, n long")
    out = np.zeros(BUCKETS + 1, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return int(out[BUCKETS]), out[:BUCKETS]


def _small(batch, column):
    """Pieces of at most `BLOCK` rows."""
    for piece in pieces(batch, column):
        for first in range(0, piece.num_rows, BLOCK):
            yield piece.slice(first, BLOCK)


@dataclass
class Model:
    """Weights of the buckets, latent axes, unit vectors of the sample, their labels and the share of label 1."""

    idf: np.ndarray
    axes: np.ndarray
    sample: np.ndarray
    labels: np.ndarray
    prior: float

    def weighted(self, found: np.ndarray) -> np.ndarray:
        return (np.log1p(found) * self.idf).astype(np.float32)

    def latent(self, found: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space; zero for a text without features."""
        at = self.weighted(found) @ self.axes
        return at / np.maximum(1e-12, np.linalg.norm(at, axis=1, keepdims=True))

    def scores(self, found: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; the prior for a text without features."""
        if not len(self.sample):
            return np.full(len(found), self.prior)
        cosines = self.latent(found) @ self.sample.T
        k = min(NEIGHBOURS, len(self.sample))
        edge = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
        votes = np.where(cosines >= edge, np.maximum(cosines, 0), 0).astype(np.float64) ** SHARPNESS
        total = votes.sum(axis=1)
        return np.where(total > 0, votes @ self.labels / np.maximum(total, 1e-300), self.prior).clip(0, 1)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> Model:
    """Model from `labels` (doc_id, label): document frequencies over all of `docs`, axes and voters from `sample` of them.

    The sample is the labelled ids of least hash, so it does not depend on
    partitions; labels of repeated ids are averaged, null ids and labels are
    left out. Without labels every text scores 0.5.
    """
    n, df = document_frequency(docs, text_col)
    idf = np.log((n + 1) / (df + 1)) + 0.1
    chosen = (
        labels.where("doc_id IS NOT NULL AND label IS NOT NULL")
        .groupBy("doc_id").agg(F.avg("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )

    def run(batches):
        for batch in batches:
            for piece in _small(batch, "text"):
                found = np.minimum(counts(piece.column(1)), 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([row.tobytes() for row in found], pa.binary())], names=["label", "found"]
                )

    texts = docs.select("doc_id", F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")  # `sample` rows
    once = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # repeated documents vote once
    rows = once.orderBy("doc_id").select("label", "text").mapInArrow(run, "label double, found binary").collect()
    if not rows:
        return Model(idf, np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0), 0.5)
    found = np.array([np.frombuffer(row.found, np.uint16) for row in rows])
    y = np.array([row.label for row in rows])
    model = Model(idf, np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0), np.float32), y, float(y.mean()))
    x = model.weighted(found).astype(np.float64)
    x /= np.maximum(1e-12, np.linalg.norm(x, axis=1, keepdims=True))
    values, vectors = np.linalg.eigh(x.T @ x)  # BUCKETS squared, whatever the sample
    model.axes = vectors[:, np.argsort(values)[::-1][:RANK]].astype(np.float32)
    model.sample = model.latent(found).astype(np.float32)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", keep=None) -> DataFrame:
    """`docs` with `SCORE`; every row stays a row.

    Null, empty and wordless texts get the share of label 1 among the learned
    labels. A very long text is scored whole, its shapes worked out in parts.
    """

    def make(piece):
        parts = [model.scores(counts(piece.column("__text").slice(i, BLOCK))) for i in range(0, piece.num_rows, BLOCK)]
        scores = np.round(np.concatenate(parts) if parts else np.zeros(0), 9)
        return [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]

    return append_columns(docs, text_col, SCORE, make, keep)
