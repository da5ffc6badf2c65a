"""Spelling variants: words one edit apart, found by pivotal grams.

A word's bigrams with their places are put in a global order, rare ones first.
Its prefix are the first three, with all others of the third one's rank: one
edit spoils two bigrams at most. Of the prefix, dynamic programming chooses two
that do not overlap and are rarest together, the pivots: one edit leaves one of
them as it is. So of two words one edit apart, the one whose prefix ends
earlier in the order has a pivot that stands in the other's prefix, at a place
that differs by no more than the lengths do; and since there is only one edit,
the words are equal before that pivot or behind it. The index is keyed by the
pivot together with that equal side; what meets there is verified.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import pieces
from shelfmark.session import materialize

GRAM, EDITS = 2, 1
MIN_LETTERS, MIN_COUNT = 6, 5
#: A word of so many times another's count may be its form.
FORM_RATIO = 5
#: One occurrence's crc32 in so many is divisible by it, and loses a letter.
SPOILED = 199
#: Words that a task counts before it hands its counts on.
HELD = 200_000
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def runs_of(text: str) -> list[str]:
    """Letter runs that can be words; shorter ones never become longer."""
    return _RUN.findall(text.encode("utf-8", "surrogatepass").translate(_FOLD).decode("utf-8", "surrogatepass"))


def spoiled(word: str, before: int) -> str:
    """`word`, or without one letter if its crc32, carried on from `before`, is divisible by `SPOILED`."""
    h = zlib.crc32(word.encode("utf-8"), before)
    if h % SPOILED:
        return word
    cut = h % len(word)
    return word[:cut] + word[cut + 1 :]


def count_words(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word, n) of all words of at least `MIN_LETTERS` letters and `MIN_COUNT` occurrences.

    Null and empty texts have none; a null id spoils no word; repeated rows
    count each. Tasks add up their own counts, in parts of `HELD` words, before
    the shuffle, so a frequent word is as many rows as there are parts.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text IS NOT NULL")

    def run(batches):
        total: dict[str, int] = {}

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for piece in pieces(batch, "text"):
                for key, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    own: dict[str, int] = {}
                    for word in runs_of(text):
                        own[word] = own.get(word, 0) + 1
                    before = None if key is None else zlib.crc32(f"{key}:".encode())
                    for word, n in own.items():
                        word = word if before is None else spoiled(word, before)
                        total[word] = total.get(word, 0) + n
                    if len(total) > HELD:
                        yield flush()
                        total = {}
        yield flush()

    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.col("n") >= MIN_COUNT) & (F.char_length("word") >= MIN_LETTERS))


def gram_order(words: DataFrame) -> dict[str, int]:
    """Rank of every bigram of `words`, rare ones first; at most the square of the 90 letters, whatever the corpus."""
    places = F.sequence(F.lit(1), F.char_length("word") - (GRAM - 1))
    grams = words.select(F.explode(F.transform(places, lambda i: F.substring(F.col("word"), i, F.lit(GRAM)))).alias("gram"))
    counts = grams.groupBy("gram").count().collect()
    return {r.gram: i for i, r in enumerate(sorted(counts, key=lambda r: (r["count"], r.gram)))}


def prefix_and_pivots(word: str, order: dict[str, int]) -> tuple[list[int], list[int], int]:
    """(places of the prefix, places of the pivots, rank at which the prefix ends)."""
    ranks = [order[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    end = sorted(ranks)[GRAM * EDITS]
    prefix = [i for i, r in enumerate(ranks) if r <= end]
    # least sum of ranks over EDITS + 1 places that do not overlap: best[j] with the first places seen so far
    best: list[list[tuple[int, tuple[int, ...]] | None]] = [[(0, ())] + [None] * (EDITS + 1)]
    for i, at in enumerate(prefix):
        free = next(k for k in range(i, -1, -1) if k == 0 or prefix[k - 1] + GRAM <= at)
        row = list(best[-1])
        for j in range(1, EDITS + 2):
            part = best[free][j - 1]
            if part is not None and (row[j] is None or part[0] + ranks[at] < row[j][0]):
                row[j] = (part[0] + ranks[at], (*part[1], at))
        best.append(row)
    return prefix, list(best[-1][EDITS + 1][1]), end


def index(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """(word, n, prefix, pivots, end) of every word; places from 0."""

    def run(batches):
        for batch in batches:
            made = [prefix_and_pivots(w, order) for w in batch.column(0).to_pylist()]
            prefix, pivots, end = zip(*made) if made else ((), (), ())
            columns = [pa.array(prefix, pa.list_(pa.int32())), pa.array(pivots, pa.list_(pa.int32())), pa.array(end, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["word", "n", "prefix", "pivots", "end"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, prefix array<int>, pivots array<int>, end int")


def near_pairs(indexed: DataFrame) -> DataFrame:
    """(a, na, b, nb) once for each two words that differ by exactly one edit, a < b.

    A key is a gram with all that stands before it (`<`) or behind it (`>`).
    The join compares within a key only; its condition holds the position limit
    (equal sides put the gram as far apart as the lengths differ, at most one),
    the order of the prefixes and the verification, so only near words come out.
    """
    length = F.char_length("word")

    def keyed(places: str, name: str) -> DataFrame:
        keys = F.flatten(F.transform(places, lambda i: F.array(
            F.concat(F.lit("<"), F.substring(F.col("word"), F.lit(1), i + GRAM)),
            F.concat(F.lit(">"), F.substring(F.col("word"), i + 1, length)),
        )))
        rows = indexed.select(F.explode(F.array_distinct(keys)).alias("key"), "word", "n", "end", length.alias("size"))
        return rows.select("key", *(F.col(c).alias(f"{c}_{name}") for c in ("word", "n", "end", "size")))

    pivots, prefixes = keyed("pivots", "s"), keyed("prefix", "r")
    met = pivots.join(prefixes, "key").where(
        "end_s <= end_r AND abs(size_s - size_r) <= 1 AND word_s != word_r AND levenshtein(word_s, word_r, 1) = 1"
    )
    first = F.col("word_s") < F.col("word_r")
    pair = met.select(
        F.when(first, F.col("word_s")).otherwise(F.col("word_r")).alias("a"), F.when(first, F.col("n_s")).otherwise(F.col("n_r")).alias("na"),
        F.when(first, F.col("word_r")).otherwise(F.col("word_s")).alias("b"), F.when(first, F.col("n_r")).otherwise(F.col("n_s")).alias("nb"),
    )
    return pair.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last by doubling steps; each form is at least `FORM_RATIO` times as frequent."""
    current = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = current.join(step, "root", "left")
        moved = materialize(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        current = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return current


def group(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of all texts.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z as a-z, with the
    spoiling that `spoiled` says. The form is the near word of largest count,
    among equals the smallest by code points, if it is `FORM_RATIO` times as
    frequent. No documents give no words; columns besides id and text are not
    looked at; a text is read whole, however long.
    """
    words = materialize(count_words(docs, text_col, id_col), "variant-words")
    indexed = materialize(index(words, gram_order(words)), "variant-index")
    pairs = materialize(near_pairs(indexed), "variant-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m"))
    )
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("top"))
    told = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("top.m") >= FORM_RATIO * F.col("n"), F.col("top")).alias("top"),
    )
    told = materialize(told.select("word", "n", "n_near", F.col("top.other").alias("form"), (-F.col("top.m")).alias("form_n")), "variant-forms")
    rooted = roots(told.where("form IS NOT NULL"))
    return told.join(rooted, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
