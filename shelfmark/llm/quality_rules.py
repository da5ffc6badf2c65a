"""Quality rules: counted features of a text, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over `BUCKETS` hash buckets of one- and
two-token grams: one fitted on trusted texts, one on all texts. A text's score
is its mean log ratio per gram, and a text stays when the score reaches a fixed
threshold; nothing is drawn at random.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import append_columns, bounded_broadcast, pieces
from shelfmark.llm.tokens import WORDS_AND_MARKS, Words, word_numbers

BUCKETS = 1 << 16
#: Mean log ratio per gram below which a text goes.
THRESHOLD = -0.1
#: Grams added to a bucket on both sides.
SMOOTHING = 10.0
#: Above so many trusted ids the texts are joined by a shuffle and not by a broadcast.
BROADCAST_IDS = 500_000

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
FEATURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


def base_features(texts: list[str | None]) -> np.ndarray:
    """A row of (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) for each text; a null text has none of them.

    Words are numbered, so that what a text of any length needs besides itself
    is a few numbers per word.
    """
    out = np.zeros((len(texts), 5), np.int64)
    known: dict[bytes, int] = {}
    numbered = []
    for row, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        numbers, lines = word_numbers(raw, known), [line for line in raw.split(b"\n") if line.strip()]
        numbered.append(numbers)
        blanks = len(raw) - len(raw.translate(None, SPACE))
        more = len(raw) - len(text or "")  # bytes beyond one per code point
        out[row, 0], out[row, 1] = len(numbers), len(raw) - blanks - more
        out[row, 2], out[row, 3] = len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines))
    out[:, 4] = _repeated(numbered)
    return out


def _repeated(texts: list[np.ndarray]) -> np.ndarray:
    """Words of each text that stand in a three-word window which the text has twice or more."""
    sizes = np.array([len(t) for t in texts], np.int64)
    numbers = np.concatenate([*texts, np.zeros(0, np.int32)]).astype(np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    if len(numbers) < 3:
        return np.zeros(len(texts), np.int64)
    at = np.flatnonzero(owner[2:] == owner[:-2])
    base = int(numbers.max()) + 1
    window = numbers[:-1] * base + numbers[1:]
    if base**3 >= 1 << 63:  # pairs by their places, so that three numbers fit in one
        window = np.unique(window, return_inverse=True)[1]
    window = window[at] * base + numbers[at + 2]
    order = np.argsort(window, kind="stable")  # equal windows of one text stand together, as texts do in `at`
    window, at = window[order], at[order]
    own = owner[at]
    again = (window[1:] == window[:-1]) & (own[1:] == own[:-1])
    some = np.zeros(len(at), bool)
    some[1:] = again
    some[:-1] |= again
    twice = at[some]
    covered = np.zeros(len(numbers), bool)
    for i in range(3):
        covered[twice + i] = True
    return np.bincount(owner, weights=covered, minlength=len(texts)).astype(np.int64)


def _buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    words = Words(column, WORDS_AND_MARKS)
    owners, hashes = zip(words.grams(1), words.grams(2))
    mask = np.uint64(BUCKETS - 1)
    return np.concatenate(owners), (np.concatenate(hashes) & mask).astype(np.int64), words.docs


def _count(texts: DataFrame) -> np.ndarray:
    """Grams of all texts by bucket; tasks add up their own before anything is shuffled."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for piece in pieces(batch, "text"):
                total += np.bincount(_buckets(piece.column(0))[1], minlength=BUCKETS)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    rows = texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(BUCKETS)  # at most BUCKETS rows come back, whatever the corpus
    for row in rows:
        counts[row.bucket] = row.n
    return counts


def fit(docs: DataFrame, trusted: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> np.ndarray:
    """Log ratio of each bucket: texts whose id is in `trusted` against all texts.

    Both multinomials are smoothed alike: `SMOOTHING` grams are added to the
    trusted count of a bucket and to the count expected there if trusted texts
    were like all others, so a bucket speaks only as far as it was seen. With no
    trusted text the ratios are 0 and every text stays.
    """
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = bounded_broadcast(trusted.select(F.col(id_col).alias("id")).distinct(), BROADCAST_IDS)
    everything = _count(texts.select("text"))
    target = _count(texts.join(ids, "id", "left_semi").select("text"))
    if not target.sum():
        return np.zeros(BUCKETS)
    expected = everything * (target.sum() / everything.sum())
    return np.log((target + SMOOTHING) / (expected + SMOOTHING))


def scores(column: pa.Array, ratios: np.ndarray) -> np.ndarray:
    """Mean ratio per gram of each text; 0 for a text without grams."""
    owner, bucket, docs = _buckets(column)
    total = np.bincount(owner, weights=ratios[bucket], minlength=docs)
    return total / np.maximum(1, np.bincount(owner, minlength=docs))


def judge(docs: DataFrame, ratios: np.ndarray, text_col: str = "text", keep=None, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with the columns of `FEATURES`; every row stays a row, repeated ids too.

    A null or empty text has no words and fails the base rule. A very long text
    is judged whole; its task holds about twenty bytes for each byte of it.
    """

    def make(piece):
        texts = piece.column("__text")
        base = base_features(texts.to_pylist())
        failed = (base[:, 0] < 50) | (100 * base[:, 4] > 50 * base[:, 0])
        score = scores(texts, ratios)
        return [*(pa.array(c) for c in base.T.copy()), failed, score, ~failed & (score >= threshold)]

    return append_columns(docs, text_col, FEATURES, make, keep)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the texts that the labels call good: quality 1."""
    return labels.where("quality = 1").select("doc_id")
