"""Tokens, stop words and n-grams inside one row: array in, array out, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.stop_words import ENGLISH

BLANKS = " \t\n\x0b\f\r"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`.

    A plain column reference may be inlined by the optimizer into a lambda and
    recomputed for every array element; a lambda variable cannot be.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    """Lower-case words split at single ASCII blanks.

    Empty tokens at the start and between blanks stay, trailing ones go; empty
    text has one empty token, blank text none, NULL stays NULL.
    """
    lowered = F.lower(text)
    body = F.rtrim(lowered, F.lit(BLANKS))
    blank = (body == "") & (lowered != "")
    return F.when(blank, F.array().cast("array<string>")).otherwise(F.split(body, r"\s", -1))


def without_stop_words(words: Column, stop_words: Iterable[str] = ENGLISH) -> Column:
    """Drop listed words; `words` are lower-case, so is the list after this."""
    listed = [word.lower() for word in stop_words]
    return F.filter(words, lambda word: ~word.isin(listed))


def ngrams(words: Column, n: int) -> Column:
    """Space-joined windows of `n` neighbouring words; none when there are fewer."""
    if n == 1:
        return words

    def windows(bound: Column) -> Column:
        last = F.size(bound) - n
        joined = F.transform(
            F.sequence(F.lit(0), last),
            lambda start: F.concat_ws(" ", *[F.get(bound, start + k) for k in range(n)]),
        )
        return F.when(last >= 0, joined).when(last < 0, F.array().cast("array<string>"))

    return bind(words, windows)


def counted(terms: Column) -> Column:
    """Distinct terms of one row with their number of occurrences.

    Sorting the row's own array and measuring runs keeps the count local, so a
    term count per row never needs a shuffle.
    """

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)),
        )
        return bind(
            starts,
            lambda bound: F.transform(
                bound,
                lambda start, k: F.struct(
                    F.get(ordered, start).alias("term"),
                    (F.coalesce(F.get(bound, k + 1), F.size(ordered)) - start)
                    .cast("bigint")
                    .alias("tf"),
                ),
            ),
        )

    return bind(F.sort_array(terms), runs)


def catalogue_terms(text: Column, n: int) -> Column:
    """The text feature of a column: tokens, minus stop words, as n-grams."""
    return ngrams(without_stop_words(tokens(text)), n)
