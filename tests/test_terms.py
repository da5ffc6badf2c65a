from pyspark.ml.feature import IDF, CountVectorizer
import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import terms
from shelfmark.operators.skew import salted_lookup


def corpus(seed=7, rows=300):
    """One term sits in every row, one row holds a third of all terms."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows_ = [["hot"] + draw.choices(words, k=draw.randint(0, 20)) for _ in range(rows)]
    rows_[5] += draw.choices(words, k=1500)
    rows_[6] = []
    return rows_


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id int, terms array<string>").repartition(6)


def truth(rows):
    tf = {(i, t): n for i, r in enumerate(rows) for t, n in Counter(r).items()}
    cf, df = Counter(), Counter()
    for (_, t), n in tf.items():
        cf[t] += n
        df[t] += 1
    return tf, cf, df


def test_counts_and_stats(frame, rows):
    tf, cf, df = truth(rows)
    assert {(r[0], r[1]): r[2] for r in terms.term_counts(frame, "id", "terms").collect()} == tf
    found = terms.term_stats(frame, "terms").collect()
    assert {r["term"]: r["cf"] for r in found} == cf and {r["term"]: r["df"] for r in found} == df
    assert {r["term"]: r["df"] for r in terms.doc_freq(frame, "terms").collect()} == df


@pytest.mark.parametrize("size", [1, 2, 50, 137, 400, 401, 5000])
def test_vocabulary_cut_inside_ties(frame, rows, size):
    _, cf, _ = truth(rows)
    order = sorted(cf, key=lambda t: (-cf[t], hashlib.md5(t.encode()).hexdigest(), t))
    found = terms.vocabulary(terms.term_stats(frame, "terms"), size).collect()
    assert {r["rank"]: r["term"] for r in found} == dict(enumerate(order[:size]))


def test_vocabulary_when_every_term_is_tied(spark):
    df = spark.createDataFrame([([f"t{i}" for i in range(3000)],)], "terms array<string>")
    found = [r["term"] for r in terms.vocabulary(terms.term_stats(df, "terms"), 100).collect()]
    order = sorted((f"t{i}" for i in range(3000)), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    assert sorted(found) == sorted(order[:100])


@pytest.mark.parametrize("size,limit", [(None, None), (5000, 1 << 20), (100, 1 << 20), (100, 0)])
def test_tfidf(frame, rows, size, limit):
    tf, cf, df = truth(rows)
    order = sorted(cf, key=lambda t: (-cf[t], hashlib.md5(t.encode()).hexdigest(), t))
    kept = set(order if size is None else order[:size])
    wanted = {
        (i, t): (n, df[t], n * math.log((len(rows) + 1) / (df[t] + 1)))
        for (i, t), n in tf.items()
        if t in kept
    }
    bound = {} if limit is None else {"broadcast_bytes": limit}
    found = {(r[0], r[1]): tuple(r[2:]) for r in terms.tfidf(frame, "id", "terms", size, **bound).collect()}
    assert found.keys() == wanted.keys()
    for key, (n, d, weight) in wanted.items():
        assert found[key][:2] == (n, d) and found[key][2] == pytest.approx(weight, abs=1e-9)


def test_salted_lookup_spreads_a_hot_key_and_loses_nothing(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k")
    )
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = salted_lookup(rows, facts, "k", "n", "row", partitions=8)
    assert joined.count() == 30_000
    assert joined.where("k = 'hot' AND n <> 10000 OR k <> 'hot' AND n <> 1").count() == 0
    assert joined.select("row").distinct().count() == 30_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(sizes) < 10_000


def test_limits_equal_those_of_the_stages(spark):
    rows = [(1, ["a", "a", "b", "c"]), (2, ["a", "b", "b", "b"]), (3, ["c", "d"]), (4, [])]
    df = spark.createDataFrame(rows, "id int, terms array<string>")
    for min_df, min_tf, min_doc_freq in ((1, 1, 0), (2, 1, 0), (0.5, 2, 3), (1, 0.5, 2), (0.5, 1, 0)):
        counter = CountVectorizer(inputCol="terms", outputCol="counts", minDF=min_df, minTF=min_tf).fit(df)
        weigher = IDF(inputCol="counts", outputCol="weights", minDocFreq=min_doc_freq)
        counts = counter.transform(df)
        weights = weigher.fit(counter.setMinTF(1).transform(df)).transform(counts)
        wanted = {
            (r["id"], counter.vocabulary[i]): (r["counts"][int(i)], round(float(r["weights"][int(i)]), 9))
            for r in weights.collect() for i in r["counts"].indices.tolist()
        }
        found = terms.tfidf(df, "id", "terms", min_df=min_df, min_tf=min_tf, min_doc_freq=min_doc_freq).collect()
        assert {(r["id"], r["term"]): (r["tf"], round(r["tfidf"], 9)) for r in found} == wanted
