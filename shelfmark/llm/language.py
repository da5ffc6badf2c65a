"""Language ID with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A
letter trigram binds them: the first turned by two places, the second by one,
the third as it is, multiplied. A text bundles (adds) the vectors of all its
trigrams; a language bundles those of all its learning texts. A text gets the
language whose profile has the greatest cosine with its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import append_columns, pieces
from shelfmark.llm.tokens import mix

DIMENSIONS = 1024
#: Texts bundled at once, and cells of their counts.
ROWS, COUNTS = 1024, 1 << 21
#: Trigrams up to which a table tells which ones occur (about a hundred letters); beyond it they are sorted.
TABLE = 1 << 20
#: Characters whose trigrams are taken at once, two or more.
PART = 1 << 18
UNKNOWN = "und"
PREDICTION = "lang_pred string, score double"

_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def letter_vectors(symbols: np.ndarray) -> np.ndarray:
    """One row of +1 and -1 for each symbol; 0 is the gap between words."""
    words = DIMENSIONS // 64
    seeds = symbols.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
    bits = np.unpackbits(mix(mix(seeds + np.uint64(0x9E3779B97F4A7C15))).view(np.uint8), axis=1)
    return 2 * bits.astype(np.int8) - 1


def _parts(texts: list[str]):
    """(parts, owners): the texts in small letters, a long one in several parts of equal trigrams together.

    A part ends in a gap between words, where each text ends, and the next one
    begins with the letter before that gap: every trigram begins in one of them.
    """
    parts, owners, size = [], [], 0
    for owner, text in enumerate(texts):
        text, at = text.lower(), 0
        while True:
            end = gap = at + PART
            while gap < len(text) and (text[gap].isalpha() or not text[gap - 1].isalpha()):
                gap += 1
            end = min(gap, len(text))
            if parts and size + end - at > PART:
                yield parts, owners
                parts, owners, size = [], [], 0
            parts.append(text[at:end])
            owners.append(owner)
            size += end - at
            if end == len(text):
                break
            at = end - 1
    if parts:
        yield parts, owners


def _trigrams(lower: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, owner, code, number of symbols) of all trigrams; runs of non-letters are one gap, and each text ends in one but begins with none."""
    points = np.frombuffer("\n".join([*lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lower)), [len(t) + 1 for t in lower])
    points = np.where(letter_table()[points], points, 0)
    real = points != 0
    real[1:] |= points[:-1] != 0
    points, owner = points[real], owner[real]
    symbols, at = _compact(points)
    n = len(symbols)
    same = owner[:-2] == owner[2:]
    code = ((at[:-2] * n + at[1:-1]) * n + at[2:])[same]
    return symbols, owner[:-2][same], code, n


def _compact(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct code points and where each point is among them."""
    present = np.zeros(0x110000, bool)
    present[points] = True
    symbols = np.flatnonzero(present)
    place = np.zeros(0x110000, np.int64)
    place[symbols] = np.arange(len(symbols))
    return symbols, place[points]


def bundles(texts: list[str], groups: np.ndarray | None = None) -> np.ndarray:
    """The bundle of each text, or of each group of texts if `groups` numbers them; whole numbers."""
    rows = len(texts) if groups is None else int(groups.max(initial=-1)) + 1
    out = np.zeros((rows, DIMENSIONS), np.float32)
    for parts, owners in _parts(texts):
        _bundle(parts, np.array(owners) if groups is None else groups[owners], out)
    return out


def _bundle(parts: list[str], groups: np.ndarray, out: np.ndarray) -> None:
    """Add the trigrams of each part to its group's bundle."""
    symbols, owner, code, n = _trigrams(parts)
    rows = len(out)
    if not len(code):
        return
    if n**3 <= TABLE:
        seen = np.flatnonzero(np.bincount(code, minlength=n**3))
        place = np.zeros(n**3, np.int64)
        place[seen] = np.arange(len(seen))
        at = place[code]
    else:
        seen, at = np.unique(code, return_inverse=True)
    vectors = letter_vectors(symbols)
    turned = [np.roll(vectors, turn, axis=1) for turn in (2, 1, 0)]
    owner = groups[owner]
    step = max(1, COUNTS // max(rows, DIMENSIONS))  # trigrams at once: 8 MB of vectors, and of counts
    for first in range(0, len(seen), step):
        some = seen[first : first + step]
        bound = (
            turned[0][some // (n * n)] * turned[1][some // n % n] * turned[2][some % n]
        ).astype(np.float32)
        inside = (at >= first) & (at < first + step)
        cells = owner[inside] * len(some) + at[inside] - first
        counts = np.bincount(cells, minlength=rows * len(some)).reshape(rows, len(some)).astype(np.float32)
        out += counts @ bound


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages by name and their profiles, from every text with a language.

    Tasks add up their own texts; whole numbers are added, so no order changes
    the sums. One number per language and dimension comes back to the driver.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")
    )

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                names, groups = np.unique(np.array(piece.column(1).to_pylist(), object).astype(str), return_inverse=True)
                for name, bundle in zip(names, bundles(piece.column(0).to_pylist(), groups)):
                    sums[name] = sums.get(name, 0) + bundle.astype(np.float64)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * DIMENSIONS, pa.string()), pa.array(range(DIMENSIONS), pa.int32()), pa.array(total)],
                names=["lang", "dim", "value"],
            )

    sums = rows.mapInArrow(run, "lang string, dim int, value double").groupBy("lang", "dim").agg(F.sum("value").alias("value"))
    found: dict[str, np.ndarray] = {}
    for row in sums.collect():
        found.setdefault(row.lang, np.zeros(DIMENSIONS))[row.dim] = row.value
    names = sorted(name for name in found if found[name].any())
    return names, np.array([found[name] for name in names]).reshape(len(names), DIMENSIONS)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", keep=None) -> DataFrame:
    """`docs` with `PREDICTION`; every row stays a row.

    `und` with score 0 where the text is null or has no letter, or nothing was
    learned; else the language of the greatest cosine, the first by name among
    equals. The score is that cosine, 0 if it is negative. A very long text is
    taken whole, its trigrams part by part.
    """
    names, profiles = model
    unit = profiles / np.maximum(1e-300, np.linalg.norm(profiles, axis=1, keepdims=True))

    def make(piece):
        texts = piece.column("__text").to_pylist()
        known = np.array([bool(names) and has_letter(t) for t in texts], bool)
        langs, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        for first in range(0, len(texts), ROWS):
            some = texts[first : first + ROWS]
            own = bundles([t or "" for t in some]).astype(np.float64)
            cosines = own @ unit.T / np.maximum(1e-300, np.linalg.norm(own, axis=1, keepdims=True))
            if names:
                best = cosines.argmax(axis=1)
                at = slice(first, first + len(some))
                langs[at] = np.where(known[at], np.array(names, object)[best], UNKNOWN)
                scores[at] = np.where(known[at], cosines.max(axis=1).clip(0, 1), 0)
        return [pa.array(langs.tolist(), pa.string()), pa.array(scores)]

    return append_columns(docs, text_col, PREDICTION, make, keep)


def fold(key: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo `folds`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds
