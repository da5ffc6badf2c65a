"""Terms counted in Arrow: as the plain count has it, with heavy terms, long rows, gaps and limits; and without spilling tables."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.operators import grams, terms
from shelfmark.operators.topk import top_terms

ROWS = [None, [], ["a"], ["a", "b"], ["a", "b", "c", "a", "b", "c"], ["", "", ""], ["ä", "b", "c"], ["a", "b", "c"], ["x"] * 50]


def windows(words, n):
    return [" ".join(words[i : i + n]) for i in range(len(words or []) - n + 1)] if words else []


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(enumerate(ROWS * 3)), "id int, words array<string>").repartition(3)


def counts(n):
    return {(i, t): k for i, words in enumerate(ROWS * 3) for t, k in Counter(windows(words, n)).items()}


@pytest.mark.parametrize("n", [1, 2, 3, 5])
@pytest.mark.parametrize("words", [1, 4, 1 << 18])
def test_counts_of_windows(frame, n, words, monkeypatch):
    monkeypatch.setattr(grams, "PART_WORDS", words)
    wanted = counts(n)
    assert {(r["id"], r["term"]): r["tf"] for r in terms.term_counts(frame, "id", "words", n=n).collect()} == wanted
    stats = {r["term"]: (r["cf"], r["df"]) for r in terms.term_stats(frame, "words", n).collect()}
    assert stats == {t: (sum(k for (_, u), k in wanted.items() if u == t), sum(u == t for _, u in wanted)) for _, t in wanted}
    assert {r["term"]: r["df"] for r in terms.doc_freq(frame, "words", n).collect()} == {t: d for t, (_, d) in stats.items()}
    assert {r["term"]: (r["cf"], r["df"]) for r in top_terms(frame, "words", 1000, n).collect()} == stats


def test_windows_equal_those_of_the_row(frame):
    plain = frame.select("id", F.explode(text.counted(text.ngrams(F.col("words"), 2))).alias("p")).select("id", "p.term", "p.tf")
    assert sorted(plain.collect()) == sorted(terms.term_counts(frame, "id", "words", n=2).collect())


def test_tfidf_of_windows_equals_that_of_terms(frame):
    made = frame.select("id", text.ngrams(F.col("words"), 2).alias("terms"))
    for limits in ({}, {"min_df": 4}, {"min_df": 0.3, "min_doc_freq": 7}, {"min_tf": 2}, {"vocabulary_size": 2}):
        assert sorted(terms.tfidf(made, "id", "terms", **limits).collect()) == sorted(terms.tfidf(frame, "id", "words", n=2, **limits).collect())


def test_a_missing_word_is_left_out_of_a_window_and_counts_as_a_term(spark):
    df = spark.createDataFrame([(1, ["a", None, "b", None])], "id int, words array<string>")
    assert {(r["term"], r["tf"]) for r in terms.term_counts(df, "id", "words").collect()} == {("a", 1), ("b", 1), (None, 2)}
    assert {r["term"] for r in terms.term_counts(df, "id", "words", n=3).collect()} == {"a b", "b"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_are_dealt_once(frame):
    """No table of sums before the shuffle, and no second reading of the rows for a join."""
    assert plan(terms.tfidf(frame, "id", "words", n=5)).count("REPARTITION_BY_COL") == 1
    assert "Join" not in plan(terms.tfidf(frame, "id", "words", n=5))
    before_exchange = plan(terms.doc_freq(frame, "words", 5)).split("REPARTITION_BY_COL")[1]
    assert "Aggregate" not in before_exchange


@pytest.mark.parametrize("size", [1, 3, 5, 100])
def test_vocabulary_with_and_without_terms_that_occur_once(spark, size):
    df = spark.createDataFrame([(["a", "a", "b", "b", "b", "c", "d", "e"],)], "words array<string>")
    found = terms.vocabulary(terms.term_stats(df, "words"), size).collect()
    assert len(found) == min(size, 5) and [r["term"] for r in sorted(found, key=lambda r: r["rank"])][:2] == ["b", "a"][:size]
