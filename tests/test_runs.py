"""N-grams dealt as runs of words: as the plain count has them, whatever the words, keys and sizes."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfmark.operators import grams, runs, terms

ROWS = [
    (1, ["a", "b", "c", "d", "e", "f", "g", "a", "b", "c", "d", "e"]), (1, ["a", "b", "c", "d", "e", "f"]), (None, ["c", "d", "e", "f", "g"]),
    (2, []), (3, None), (4, ["x"] * 40), (5, ["x"] * 40), (6, ["", "", "", "", "", ""]), (7, ["ä b", "c", "d", None, "e", "f", "g"]),
    (8, ["ä", "b", "c", "d", "e", "f", "g"]), (10, [None, "a", "b c", "d", "e", "f"]), (11, ["a b", "c", "d", "e", "f"]),
]


def windows(words, n):
    """The terms of one row, in order; a missing word is left out."""
    return [" ".join(w for w in words[i : i + n] if w is not None) for i in range(len(words or []) - n + 1)]


def wanted(rows, n):
    counts = [(key, Counter(windows(words, n))) for key, words in rows]
    containing = Counter(term for _, count in counts for term in count)
    return sorted(((key, term, tf, containing[term]) for key, count in counts for term, tf in count.items()), key=repr)


@pytest.mark.parametrize("n", [2, 5])
@pytest.mark.parametrize("buckets", [1, 7])
@pytest.mark.parametrize("words", [20, 1 << 20])
def test_terms_and_the_rows_that_hold_them(spark, monkeypatch, n, buckets, words):
    monkeypatch.setattr(runs, "DEAL_WORDS", words)
    for parts, rows in ((1, ROWS), (3, ROWS * 2), (3, [r for r in ROWS if not any(w is None or " " in w for w in r[1] or [])])):
        df = spark.createDataFrame(rows, "id int, words array<string>").repartition(parts)
        assert sorted(map(tuple, runs.gram_rows(df, "id", "words", n, buckets).collect()), key=repr) == wanted(rows, n)


@pytest.mark.parametrize("kind", ["string", "bigint", "decimal(20,2)", "date"])
def test_keys_of_other_types(spark, kind):
    df = spark.createDataFrame([(r[1],) for r in ROWS], "words array<string>").selectExpr(f"CAST(IF(size(words) > 6, NULL, {2 if kind != 'date' else repr('2020-01-02')}) AS {kind}) AS `a key`", "words")
    found, plain = runs.gram_rows(df, "a key", "words", 3), terms.with_doc_freq(terms.term_counts(df, "a key", "words", n=3))
    assert found.dtypes == plain.dtypes and sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_no_rows(spark):
    df = spark.createDataFrame([], "id int, words array<string>")
    assert runs.gram_rows(df, "id", "words", 5).count() == 0


def test_terms_are_not_dealt_as_texts(spark):
    df = spark.createDataFrame(ROWS, "id int, words array<string>")
    plan = terms.tfidf(df, "id", "words", n=5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(term" not in plan and "hashpartitioning(bucket" in plan


def test_a_window_needs_less_than_three_words(spark):
    """Packed words of a text without repeats, against five words in every window."""
    rng = np.random.default_rng(3)
    names = np.array([f"word{i:05d}" for i in range(50_000)])
    words = pa.array([names[rng.integers(0, len(names), 400)].tolist() for _ in range(200)])
    schema = runs._schema(pa.int32())
    made = runs._packed(pa.array(range(200), pa.int32()), words, 5, 16, schema).to_pylist()
    read = [pa.ipc.read_record_batch(runs._CODEC.decompress(r["packed"], r["size"]), schema) for r in made]
    travelling = sum(len(b.column("words")[0].as_py().split(" ")) for b in read)
    assert len(made) == 16 and sum(len(b.column("tf")[0]) for b in read) == 200 * 396 and travelling < 3.2 * 200 * 396
    sizes = [len(b.column("tf")[0]) for b in read]
    assert max(sizes) < 1.2 * np.mean(sizes)
