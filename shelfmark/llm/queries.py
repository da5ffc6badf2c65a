"""The registered queries: each operator with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    bpe, chat, decontaminate, language, neardup, neighbours, notices, periods, pseudonyms, quality_rules, token_files, url_rules, variants,
)
from shelfmark.llm.batches import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: A parameter of the operators; never copied from where it is installed.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")

LISTED = [
    url_rules.Rule("net", "/", "block"),
    url_rules.Rule("example.net", "/en/", "allow"),
    url_rules.Rule("example.com", "/de/", "block"),
    url_rules.Rule("org", "/fr/", "allow"),
]


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page; a labelled page is bad if it is toxic or of low quality."""
    pages = read(spark, sf_dir, "pages")
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.expr("coalesce(toxic = 1, false) OR coalesce(quality = 0, false)").alias("block")
    )
    rules = url_rules.mine(url_rules.labelled_baskets(pages, labels))
    return url_rules.judge(pages, rules, LISTED)


@query
def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as wavelet files and read back."""
    return token_files.write_and_read(read(spark, sf_dir, "documents"), VOCABULARY)


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and log-likelihood ratio of every document."""
    docs = read(spark, sf_dir, "documents")
    ratios = quality_rules.fit(docs, quality_rules.trusted_ids(read(spark, sf_dir, "labels")))
    return quality_rules.judge(docs, ratios, keep=["doc_id"])


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that quotes control strings, formatted and read back."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoting = spark.sql(
        "SELECT -1L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    return chat.format_and_read(rows.unionByName(quoting))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of benchmark items in every document."""
    found = decontaminate.scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return decontaminate.digests(found)


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(read(spark, sf_dir, "documents"), VOCABULARY, keep=["doc_id"])


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled documents outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    model = neighbours.fit(docs, labels.where(language.fold(F.col("doc_id"), 5) != 0))
    held_out = (language.fold(F.col("doc_id"), 5) == 0).alias("held_out")
    return neighbours.score(docs.select("doc_id", held_out, "text"), model, keep=["doc_id", "held_out"])


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    held_out = language.fold(F.col("doc_id"), 3) == 1
    model = language.learn(docs.where(~held_out))
    return language.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near duplicates of every document."""
    return neardup.classes(read(spark, sf_dir, "documents"))


#: Whoever runs this on real data sets a key of their own.
PSEUDONYM_KEY = "shelfmark"


@query
def op10_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeated word blocks in every document; a tenth of the documents repeat one of their own."""
    docs = read(spark, sf_dir, "documents")
    shown = docs.select("doc_id", periods.repeated(F.col("doc_id"), F.col("text")).alias("text"))
    return periods.digests(periods.find_runs(shown, keep=["doc_id"]))


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document, found in spite of a few edits."""
    return notices.digests(notices.scan(read(spark, sf_dir, "documents"), keep=["doc_id"]))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with the more frequent word that each is a variant of."""
    return variants.group(read(spark, sf_dir, "documents"))
