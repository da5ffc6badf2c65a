from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import NGram, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from shelfmark.functions import text
from shelfmark.functions.commands import returns_rows
from shelfmark.functions.stop_words import ENGLISH

CASES = ["", "a b  ", "  a", "   ", "The  Quick brown fox\tjumps over THE lazy dog, again!", "short one",
         "\x0bx\x0cy\r\nz", "one two three four five", "ÄÖ ß\u00a0x"]


def both(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    ml = Tokenizer(inputCol="t", outputCol="tok").transform(df)
    ml = StopWordsRemover(inputCol="tok", outputCol="kept").transform(ml)
    ml = NGram(n=5, inputCol="kept", outputCol="grams").transform(ml)
    tokens = text.tokens(F.col("t"))
    return ml.select(
        "tok", "kept", "grams",
        tokens.alias("a"),
        text.without_stop_words(tokens).alias("b"),
        text.catalogue_terms(F.col("t"), 5).alias("c"),
    ).collect()


def test_same_as_ml_stages(spark):
    for r in both(spark, CASES):
        assert (r["tok"], r["kept"], r["grams"]) == (r["a"], r["b"], r["c"])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="aThe \t\n,é", max_size=40), min_size=1, max_size=60))
def test_same_as_ml_stages_on_any_text(spark, texts):
    for r in both(spark, texts):
        assert (r["tok"], r["kept"], r["grams"]) == (r["a"], r["b"], r["c"])


def test_stop_list_is_the_default_list(spark):
    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    r = df.select(text.tokens(F.col("t")).alias("a"), text.catalogue_terms(F.col("t"), 5).alias("b"))
    assert tuple(r.first()) == (None, None)


@pytest.mark.parametrize("words", [[], ["a"], ["b", "a", "b", "a", "b"], ["x"] * 1000 + ["y"]])
def test_counted(spark, words):
    df = spark.createDataFrame([(words,)], "w array<string>")
    found = df.select(text.counted(F.col("w"))).first()[0]
    assert {r["term"]: r["tf"] for r in found} == Counter(words)
    assert len(found) == len(set(words))


def test_routing(spark):
    commands = ["SELECT * FROM eclasses", "select count(*) from x", "select discount from x", "UPDATE x", None]
    df = spark.createDataFrame([(c,) for c in commands], "c string")
    assert [r[0] for r in df.select(returns_rows(F.col("c"))).collect()] == [True, False, False, False, None]
