"""Raw documents to token ids: five stages, each over all that its predecessor kept.

Null, empty, very long and repeated rows are treated as each operator's
docstring says; an empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import bpe, decontaminate, neardup, pseudonyms, quality_rules
from shelfmark.llm.batches import prepare, read
from shelfmark.llm.queries import PSEUDONYM_KEY, VOCABULARY
from shelfmark.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents alone; columns that came along are dropped."""
    prepare(docs.sparkSession)
    return docs.select(*COLUMNS)


def _counted(docs: DataFrame) -> DataFrame:
    """`n_chars` of the texts as they are now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are."""
    docs = _documents(docs)
    ratios = quality_rules.fit(docs, quality_rules.trusted_ids(read(spark, sf_dir, "labels")))
    return quality_rules.judge(docs, ratios).where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the least id."""
    return neardup.keep_one(_documents(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: spans are cut out, and documents that are mostly such spans go."""
    return _counted(decontaminate.clean(_documents(docs), read(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data."""
    return _counted(pseudonyms.pseudonymise(_documents(docs), PSEUDONYM_KEY))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with digests of the ids and of the text decoded from them."""
    return bpe.encode_and_decode(_documents(docs), VOCABULARY, keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("encoding and decoding", encoding),
]

#: Hashing, signatures and merges are beyond SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
