"""Vectors whose buckets add up the weights of their terms."""

import hashlib
import math
from collections import defaultdict

import pytest
from pyspark.ml.regression import LinearRegression

from shelfmark.plans.weighted import weighted_vectors
from shelfmark.schema import CATALOGUE, FLAGS


@pytest.mark.parametrize("buckets", [3, 64])
def test_buckets_add_up_the_weights_of_their_terms(spark, buckets):
    texts = ["pap qaq rar sas tat uau", "pap qaq rar sas tat uau pap qaq rar sas tat", None, "", "pap qaq rar sas tat"]
    rows = [(i, text, ["xax yay", "yay", None, "xax", "xax"][i], *[i % 2 == 0] * len(FLAGS), i * 10) for i, text in enumerate(texts)]
    rows.append(rows[4])  # a repeated row is a row of its own
    found = weighted_vectors(spark.createDataFrame(rows, CATALOGUE), buckets={"description": buckets, "category": buckets})
    got = sorted((r["id"], {int(i): round(float(r["features"][int(i)]), 9) for i in r["features"].indices}) for r in found.collect())

    def terms(text, n):
        words = (text or "").split() or [""]  # an empty text is one empty token
        return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]

    wanted = []
    for i, text, category, *rest in rows:
        slots = defaultdict(float, {0: float(i), 1: float(len(text or ""))})
        for start, column, n, own in ((2, 1, 5, text), (2 + buckets, 2, 1, category)):
            for term in terms(own, n):
                df = sum(term in terms(row[column], n) for row in rows)
                slots[start + int(hashlib.md5(term.encode()).hexdigest()[:8], 16) % buckets] += math.log((len(rows) + 1) / (df + 1))
        for k in range(len(FLAGS)):
            slots[2 + 2 * buckets + k] = float(rest[k])
        wanted.append((i, {s: round(v, 9) for s, v in slots.items() if v}))
    assert got == sorted(wanted, key=lambda x: x[0])
    assert {r["features"].size for r in found.collect()} == {2 + 2 * buckets + len(FLAGS)}
    model = LinearRegression(labelCol="eclassnumber", regParam=0.1).fit(found)
    assert model.numFeatures == 2 + 2 * buckets + len(FLAGS)
    assert weighted_vectors(found.sparkSession.createDataFrame(rows, CATALOGUE), drop_id=True).first()["features"].size == (1 << 17) + (1 << 12) + 11
