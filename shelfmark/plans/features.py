"""Catalogue rows to ML vectors: two text features, ten flags, id and text length."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import (
    CountVectorizer,
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    SQLTransformer,
    StopWordsRemover,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.stop_words import ENGLISH
from shelfmark.operators import grams
from shelfmark.operators.terms import term_stats, vocabulary
from shelfmark.schema import FLAGS
from shelfmark.session import materialize


@dataclass(frozen=True)
class TextFeature:
    """A text column, the length of its n-grams, and the names of what is made from it."""

    column: str
    n: int
    tokens: str
    kept: str
    terms: str
    counts: str
    weights: str


DESCRIPTION = TextFeature(
    "description", 5, "token_text", "token_stop", "ngram", "count_vec", "tf-idf"
)
CATEGORY = TextFeature(
    "category", 1, "token_category", "category_stop", "category_stop", "count_vec_cat", "tf-idf-cat"
)

# Buckets of each text column: the width of its part of the vector, whatever the number of terms.
BUCKETS = {"description": 1 << 17, "category": 1 << 12}

# The scalar slots of the feature vector, and the whole vector in order.
SCALARS = ["id", "description_length", *FLAGS]
ASSEMBLED = ["id", "description_length", DESCRIPTION.weights, CATEGORY.weights, *FLAGS]


def with_description_length(df: DataFrame) -> DataFrame:
    return df.withColumn("description_length", F.length("description"))


def without_gaps(df: DataFrame) -> DataFrame:
    """Empty text for a missing one and false for a missing flag; ML stages reject NULL."""
    texts = {feature.column: "" for feature in (DESCRIPTION, CATEGORY)}
    return df.fillna(texts).fillna(False, subset=FLAGS)


def feature_columns(df: DataFrame) -> DataFrame:
    """The scalar part of the feature vector, as the assembler sees it."""
    columns = with_description_length(without_gaps(df))
    return columns.select(*[F.col(name).cast("double").alias(name) for name in SCALARS])


def term_stages(feature: TextFeature) -> list[Transformer]:
    """Column to terms: words, minus stop words, as n-grams."""
    stages: list[Transformer] = [
        Tokenizer(inputCol=feature.column, outputCol=feature.tokens),
        StopWordsRemover(inputCol=feature.tokens, outputCol=feature.kept, stopWords=ENGLISH),
    ]
    if feature.n > 1:
        stages.append(NGram(n=feature.n, inputCol=feature.kept, outputCol=feature.terms))
    return stages


def bucket_of(term: str, buckets: int) -> str:
    """SQL for the bucket of a term: the first 32 bits of its MD5, modulo `buckets`."""
    return f"CAST(conv(substring(md5({term}), 1, 8), 16, 10) AS BIGINT) % {buckets}"


def bucket_of_digest(digest: str, buckets: int) -> str:
    """SQL for the same bucket from the term's MD5 as 16 bytes."""
    return f"CAST(conv(hex(substring({digest}, 1, 4)), 16, 10) AS BIGINT) % {buckets}"


def bucket_terms(df: DataFrame, feature: TextFeature, buckets: int) -> DataFrame:
    """(bucket, term, df): which terms a bucket slot stands for; a table, since it grows with the texts."""
    stats = term_stats(PipelineModel(term_stages(feature)[:2]).transform(without_gaps(df)), feature.kept, feature.n)
    return stats.select(F.expr(bucket_of("term", buckets)).alias("bucket"), "term", "df")


def _counter(entries: DataFrame, terms: str, feature: TextFeature, size: int) -> CountVectorizerModel:
    """A counter of exactly the given entries.

    A bounded frame of one-term rows: the counter keeps them all, and the list
    reaches the JVM without a call per term. One partition of at most `size`
    rows, so that equal counts take the same slots in every run.
    """
    rows = entries.select(F.array("entry").alias(terms)).coalesce(1)
    return CountVectorizer(inputCol=terms, outputCol=feature.counts, vocabSize=size).fit(rows)


def _scaler(counter: CountVectorizerModel, containing: dict, rows: int, feature: TextFeature) -> Transformer:
    weights = [math.log((rows + 1) / (containing.get(entry, 0) + 1)) for entry in counter.vocabulary]
    return ElementwiseProduct(
        scalingVec=Vectors.dense(weights), inputCol=feature.counts, outputCol=feature.weights
    )


class Features(PipelineModel):
    """The fitted stages, and the rows they were learned from: these carry their counts and need not be counted again."""

    def __init__(self, stages: list[Transformer], learned: DataFrame | None = None, counted: DataFrame | None = None):
        super().__init__(stages)
        self.learned, self.counted = learned, counted

    def knows(self, df: DataFrame) -> bool:
        """Whether `df` is the frame it was learned from, under the same names, and its rows with their counts were kept."""
        return self.counted is not None and df.schema == self.learned.schema and df.sameSemantics(self.learned)


def _bucket_column(feature: TextFeature) -> str:
    return f"{feature.terms}_bucket"


def _bucket_stages(df: DataFrame, feature: TextFeature, buckets: int) -> list[Transformer]:
    """Column to buckets of terms, and those to their counts."""
    column = _bucket_column(feature)
    statement = f"transform({feature.terms}, t -> CAST({bucket_of('t', buckets)} AS STRING)) AS {column}"
    names = df.sparkSession.range(buckets).select(F.col("id").cast("string").alias("entry"))
    counter = _counter(names, column, feature, buckets)
    return [*term_stages(feature), SQLTransformer(statement=f"SELECT *, {statement} FROM __THIS__"), counter]


#: A vector as it is stored, in Arrow: neither lists nor their entries are missing where they are read.
_INDICES = pa.list_(pa.field("element", pa.int32(), nullable=False))
_VALUES = pa.list_(pa.field("element", pa.float64(), nullable=False))
_STORED = [
    pa.field("type", pa.int8(), nullable=False), pa.field("size", pa.int32()), pa.field("indices", _INDICES), pa.field("values", _VALUES),
]


def _count_vectors(words: pa.Array, n: int, slot_of: np.ndarray) -> pa.StructArray:
    """How often each slot occurs in a row, from the words whose windows of `n` are its terms."""
    rows, size = len(words), len(slot_of)
    found = grams._lengths(words) if n == 1 else np.maximum(grams._lengths(words) - n + 1, 0)
    slots = slot_of[_starts(words, n) % size]
    keys, counts = np.unique(np.repeat(np.arange(rows) * size, found) + slots, return_counts=True)
    ends = pa.array(np.searchsorted(keys, np.arange(rows + 1) * size).astype(np.int32))
    lists = [
        pa.ListArray.from_arrays(ends, pa.array((keys % size).astype(np.int32)), type=_INDICES),
        pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.float64)), type=_VALUES),
    ]
    sparse, width = pa.array(np.zeros(rows, np.int8)), pa.array(np.full(rows, size, np.int32))
    return pa.StructArray.from_arrays([sparse, width, *lists], fields=_STORED)


def _starts(words: pa.Array, n: int) -> np.ndarray:
    """The first four bytes of the MD5 of each term of each row, in order: what `bucket_of` is made from."""
    terms = grams._grams(words, n)[1].cast(pa.large_binary())
    _, offsets, data = terms.buffers()
    bounds = np.frombuffer(offsets, np.int64)[terms.offset : terms.offset + len(terms) + 1].tolist() if len(terms) else []
    text = memoryview(data) if data is not None else b""
    digests = b"".join([md5(text[a:b], usedforsecurity=False).digest() for a, b in zip(bounds, bounds[1:])])
    return np.frombuffer(digests, ">u4")[::4]


def _counted_rows(df: DataFrame, features: dict[TextFeature, list[Transformer]]) -> DataFrame:
    """The rows without their texts, and the counts of both as the stages give them: written once, with one pass over the texts.

    Words are those of the stages; their windows are joined and hashed in Arrow, since one by one they cost the most of the job.
    """
    made = PipelineModel([stage for stages in features.values() for stage in stages[:2]]).transform(with_description_length(df))
    kept = [name for name in ("id", "eclassnumber", "description_length", *FLAGS) if name in made.columns]
    worded = made.select(*kept, *[F.col(feature.kept).alias(feature.counts) for feature in features])
    orders = [(feature.n, np.argsort(np.array(stages[-1].vocabulary, int))) for feature, stages in features.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, size in grams._parts(batch.column(len(kept))):
                part = batch.slice(first, size)
                vectors = [_count_vectors(part.column(len(kept) + i), n, order) for i, (n, order) in enumerate(orders)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(kept)], *vectors], names=part.schema.names)

    vectors = [T.StructField(feature.counts, VectorUDT()) for feature in features]
    schema = T.StructType([*worded.select(*kept).schema.fields, *vectors])
    return materialize(worded.mapInArrow(run, schema), "counted")


def _containing(counted: DataFrame, counter: CountVectorizerModel) -> dict[str, int]:
    """The number of rows that hold each entry of the counter."""
    slots = counted.select(F.explode(F.unwrap_udt(counter.getOutputCol()).getField("indices")).alias("slot"))
    found = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("df")).toPandas()
    vocabulary = counter.vocabulary
    return {vocabulary[slot]: n for slot, n in zip(found["slot"], found["df"])}


def _fit_buckets(df: DataFrame, whole: DataFrame, sizes: dict[str, int]) -> tuple[list[Transformer], DataFrame]:
    """TF-IDF over buckets of terms, and the rows with their counts: no term is left out, and the driver holds as many numbers as there are buckets."""
    features = {feature: _bucket_stages(df, feature, sizes[feature.column]) for feature in (DESCRIPTION, CATEGORY)}
    counted = _counted_rows(whole, features)
    rows = counted.count()
    stages: list[Transformer] = []
    for feature, own in features.items():
        stages += [*own, _scaler(own[-1], _containing(counted, own[-1]), rows, feature)]
    return stages, counted


def _fit_top(df: DataFrame, feature: TextFeature, rows: int, size: int) -> list[Transformer]:
    """TF-IDF over the `size` most frequent terms, which alone reach the driver."""
    stages = term_stages(feature)
    stats = term_stats(PipelineModel(stages[:2]).transform(df), feature.kept, feature.n)
    kept = materialize(vocabulary(stats, size), "vocabulary").select(F.col("term").alias("entry"), "df")
    containing = dict(kept.toPandas().itertuples(index=False, name=None))
    if not containing:
        raise ValueError(f"no terms in column {feature.column!r}")
    counter = _counter(kept, feature.terms, feature, size)
    return [*stages, counter, _scaler(counter, containing, rows, feature)]


def fit_features(
    df: DataFrame,
    vocabulary_size: int | None = None,
    drop_id: bool = False,
    buckets: dict[str, int] | None = None,
) -> PipelineModel:
    """Learn both text features from `df`; the result adds `features` to any catalogue frame.

    Every term counts in one of the `buckets` of its column (`BUCKETS` by
    default). With `vocabulary_size` the most frequent terms have slots of their
    own instead, and the others none.
    """
    whole = without_gaps(df)
    inputs = [name for name in ASSEMBLED if not (drop_id and name == "id")]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features")
    if vocabulary_size is None:
        stages, counted = _fit_buckets(df, whole, BUCKETS | (buckets or {}))
        return Features([*stages, assembler], df, counted)
    rows = whole.count()
    stages = [stage for feature in (DESCRIPTION, CATEGORY) for stage in _fit_top(whole, feature, rows, vocabulary_size)]
    return Features([*stages, assembler])


def feature_vectors(df: DataFrame, model: PipelineModel) -> DataFrame:
    """(id, eclassnumber, features); the intermediate columns are pruned away.

    The frame that the model was learned from is not counted again: its counts
    are read back, weighted and assembled by the same stages.

    The assembler describes every slot in the column's metadata, which would
    travel with each task of every later job; it is dropped here.
    """
    bare = F.col("features").alias("features", metadata={})
    if isinstance(model, Features) and model.knows(df):
        weighting = [stage for stage in model.stages if isinstance(stage, (ElementwiseProduct, VectorAssembler))]
        return PipelineModel(weighting).transform(model.counted).select("id", "eclassnumber", bare)
    prepared = with_description_length(without_gaps(df))
    return model.transform(prepared).select("id", "eclassnumber", bare)


def vector_slots(vectors: DataFrame, column: str = "features") -> DataFrame:
    """(id, slot, value) for every non-zero slot, whichever way the vector is stored."""
    plain = F.unwrap_udt(column)
    stored, values = plain.getField("indices"), plain.getField("values")
    slots = F.coalesce(stored, F.sequence(F.lit(0), F.size(values) - 1))
    pairs = F.arrays_zip(slots.alias("slot"), values.alias("value"))
    return vectors.select("id", F.inline(pairs)).toDF("id", "slot", "value").where("value != 0")


def slot_names(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(slot, part, term): what each slot of a vector holds; scalars have no term.

    The term of a bucket is its number; `bucket_terms` says what is in it. Terms keep no promised order among slots, so read vectors through this.
    """
    vocabularies = {
        stage.getOutputCol(): stage.vocabulary
        for stage in model.stages
        if isinstance(stage, CountVectorizerModel)
    }
    by_weights = {feature.weights: feature for feature in (DESCRIPTION, CATEGORY)}
    names: list[tuple[str, str | None]] = []
    for column in model.stages[-1].getInputCols():
        feature = by_weights.get(column)
        if feature is None:
            names.append((column, None))
        else:
            names += [(feature.column, term) for term in vocabularies[feature.counts]]
    frame = pd.DataFrame(names, columns=["part", "term"])
    frame.insert(0, "slot", range(len(frame)))
    return spark.createDataFrame(frame, "slot int, part string, term string")
