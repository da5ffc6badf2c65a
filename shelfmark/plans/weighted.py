"""Feature vectors of fixed width in which every term keeps a weight of its own.

An IDF per bucket tells terms apart no more once a bucket holds many. Here each
term is weighted by its own document frequency, and only then the weights of a
row are summed by bucket. N-grams travel as their MD5, of which the bucket is
made as well. Nothing of the vocabulary reaches the driver.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.text import catalogue_terms
from shelfmark.operators.terms import idf, term_counts, tfidf, with_doc_freq
from shelfmark.plans.features import (
    ASSEMBLED, BUCKETS, CATEGORY, DESCRIPTION, TextFeature, bucket_of, bucket_of_digest, with_description_length, without_gaps,
)
from shelfmark.session import materialize, scratch_path

ROW = "_row"


def bucket_weights(df: DataFrame, feature: TextFeature, buckets: int, key: str = "id") -> DataFrame:
    """(key, bucket, value): the sum of tf * idf of a row's terms by bucket; `key` tells rows apart."""
    words = df.select(key, catalogue_terms(F.col(feature.column), 1).alias("words"))
    if feature.n == 1:
        weighted = tfidf(words, key, "words").select(key, F.expr(bucket_of("term", buckets)).alias("bucket"), "tfidf")
    else:
        counts = term_counts(words, key, "words", n=feature.n)
        found = with_doc_freq(counts.select(key, F.unhex(F.md5("term")).alias("term"), F.col("tf").cast("int").alias("tf")))
        weight = F.col("tf") * idf(df.agg(F.count(F.lit(1))).scalar(), F.col("df"))
        weighted = found.select(key, F.expr(bucket_of_digest("term", buckets)).alias("bucket"), weight.alias("tfidf"))
    # dealt by row at once: the sums by bucket, and what gathers a row, need no other shuffle
    named = weighted.withColumn("bucket", F.col("bucket").cast("int")).repartition(key)
    return named.groupBy(key, "bucket").agg(F.sum("tfidf").alias("value"))


def _parts(drop_id: bool, buckets: dict[str, int]) -> tuple[dict[str, int], int]:
    """The first slot of every input of the vector, in order, and the width of all."""
    starts, at = {}, 0
    for name in ASSEMBLED:
        if not (drop_id and name == "id"):
            starts[name] = at
            at += {DESCRIPTION.weights: buckets["description"], CATEGORY.weights: buckets["category"]}.get(name, 1)
    return starts, at


def _gathered(slots: DataFrame, name: str) -> DataFrame:
    """(row, pairs): the (slot, value) pairs of each row; no shuffle if the slots were dealt by row."""
    return slots.groupBy(ROW).agg(F.collect_list(F.struct("slot", "value")).alias(name))


def weighted_vectors(df: DataFrame, drop_id: bool = False, buckets: dict[str, int] | None = None) -> DataFrame:
    """(id, eclassnumber, features) of every row, as `features.feature_vectors` has it.

    A vector is stored as its four parts; the table of these is read back under
    the vector type, so no row goes through Python.
    """
    widths = BUCKETS | (buckets or {})
    starts, width = _parts(drop_id, widths)
    # written once: the keys of rows must be the same for every reader
    rows = materialize(with_description_length(without_gaps(df)).withColumn(ROW, F.monotonically_increasing_id()), "weighted-rows")
    scalars = F.array(*[
        F.struct(F.lit(at).alias("slot"), F.col(name).cast("double").alias("value"))
        for name, at in starts.items() if name not in (DESCRIPTION.weights, CATEGORY.weights)
    ])
    gathered, pairs = rows.select(ROW, "id", "eclassnumber", scalars.alias("scalars")), [F.col("scalars")]
    for feature in (DESCRIPTION, CATEGORY):
        found = bucket_weights(rows, feature, widths[feature.column], ROW)
        slots = found.select(ROW, (F.col("bucket") + starts[feature.weights]).alias("slot"), "value")
        gathered = gathered.join(_gathered(slots, feature.weights).hint("merge"), ROW, "left")
        pairs.append(F.coalesce(F.col(f"`{feature.weights}`"), F.array().cast("array<struct<slot:int,value:double>>")))
    kept = F.sort_array(F.filter(F.concat(*pairs), lambda pair: pair["value"] != 0))
    whole = gathered.select("id", "eclassnumber", kept.alias("pairs"))
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(width).alias("size"),
        F.coalesce(F.col("pairs.slot"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("pairs.value"), F.array().cast("array<double>")).alias("values"),
    )
    whole = whole.select("id", "eclassnumber", vector.alias("features"))
    path = scratch_path(df.sparkSession, "weighted-vectors")
    whole.write.parquet(path)
    schema = T.StructType([*whole.select("id", "eclassnumber").schema.fields, T.StructField("features", VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)
