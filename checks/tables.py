"""The catalogue as a view over `documents`, in Spark and in SQL.

Whole texts are used; commas, quotes and line breaks become blanks except in
the variants that are about them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from checks.names import COLUMNS, FLAGS, PRODUCER_COLUMNS
from shelfmark.sources.files import spread

# Every flag and the label, in SQL that both engines read alike.
_COMPUTED = """
  concat(lang, ' ', source) AS category,
  n_chars % 2 = 0 AS product_description,
  text LIKE '% the %' AS link,
  text LIKE '%ein%' AS gln_of_supplier,
  n_chars > 1500 AS taric,
  text LIKE '%os %' AS details,
  doc_id % 3 = 0 AS product_article,
  text LIKE '%!%' AS number_of_supplier,
  n_chars % 5 = 0 AS gln_of_manufacturer,
  text LIKE '%on%' AS gtin,
  source IN ('src1', 'src2', 'src3') AS brand,
  CAST((CASE lang WHEN 'de' THEN 1 WHEN 'en' THEN 2 WHEN 'es' THEN 3 ELSE 4 END) * 1000000
     + CAST(regexp_extract(source, '([0-9]+)', 1) AS INT) * 10000 + n_chars % 100 AS INT)
     AS eclassnumber
"""

# What a description loses: line breaks, quotes and commas; dirty lines keep commas.
CLEAN, DIRTY, RAW = '\r\n",', '\r\n"', ""

_ORDER = ", ".join(COLUMNS)


def _sql_translate(dropped: str) -> str:
    if not dropped:
        return "text"
    listed = " || ".join({"\r": "chr(13)", "\n": "chr(10)"}.get(c, f"'{c}'") for c in dropped)
    return f"translate(text, {listed}, '{' ' * len(dropped)}')"


def _view(dropped: str) -> str:
    return f"""SELECT {_ORDER} FROM (
  SELECT CAST(doc_id AS INT) AS id, {_sql_translate(dropped)} AS description, {_COMPUTED}
  FROM documents)"""


# Some values missing: decided by the row itself, on every nullable kind of column.
_GAPPED = ", ".join(
    [
        "CASE WHEN eclassnumber % 7 = 0 THEN NULL ELSE id END AS id",
        "CASE WHEN eclassnumber % 5 = 0 THEN NULL ELSE description END AS description",
        "CASE WHEN eclassnumber % 11 = 0 THEN NULL ELSE category END AS category",
    ]
    + [
        f"CASE WHEN eclassnumber % {i + 2} = 0 THEN NULL ELSE {name} END AS {name}"
        for i, name in enumerate(FLAGS)
    ]
    + ["CASE WHEN eclassnumber % 13 = 0 THEN NULL ELSE eclassnumber END AS eclassnumber"]
)


def catalogue_sql(dropped: str = CLEAN) -> str:
    """The catalogue view as SQL over `documents`."""
    return _view(dropped)


def gapped_sql() -> str:
    return f"SELECT {_GAPPED} FROM ({_view(CLEAN)})"


def producer_sql(source: str) -> str:
    """`source` under the producer's column names."""
    renamed = ", ".join(f"{c} AS {p}" for c, p in zip(COLUMNS, PRODUCER_COLUMNS, strict=True))
    return f"SELECT {renamed} FROM ({source})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _over_documents(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(
        sql.replace("FROM documents", "FROM {documents}"),
        documents=spread(table(spark, sf_dir, "documents")),
    )


def catalogue(spark: SparkSession, sf_dir: str, dropped: str = CLEAN) -> DataFrame:
    return _over_documents(spark, sf_dir, _view(dropped))


def gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _over_documents(spark, sf_dir, gapped_sql())
