"""Catalogue row <-> one-line record, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schema import CATALOGUE_DDL, COLUMNS, PRODUCER_COLUMNS

# What a trim removes from both ends of a record: every character up to U+0020.
TRIMMED = "".join(map(chr, range(0x21)))

# Quoting that survives commas, quotes, line breaks and outer blanks.
SAFE_CSV = {
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# The caption before each field of a rendered row. The article
# caption follows its neighbour without a separator; readers rely on the text.
CAPTIONS = [
    "id: ",
    ", description: ",
    ", category: ",
    ", Manufacturer prodcut desxription: ",
    ", Link: ",
    ", GLN Of Supplier: ",
    ", TARIC: ",
    ", Details: ",
    "Name/number of Manufacturer: ",
    ", Name/number of Supplier: ",
    ", URI/GLN of Manufacturer: ",
    ", GTIN: ",
    ", Brand: ",
    ", Eclassnumber: ",
]


def to_consumer_names(df: DataFrame) -> DataFrame:
    """Producer names to consumer names, by position."""
    return df.select(*PRODUCER_COLUMNS).toDF(*COLUMNS)


def to_producer_names(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS).toDF(*PRODUCER_COLUMNS)


def decode_nulls(df: DataFrame) -> DataFrame:
    """Missing numbers become 0 and missing flags false; strings stay NULL."""

    def decoded(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.IntegralType):
            column = F.coalesce(column, F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, T.BooleanType):
            column = F.coalesce(column, F.lit(False))
        return column.alias(field.name)

    return df.select(*[decoded(field) for field in df.schema.fields])


def _text_or_null_word(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("null"))


def line_of(columns: list[str] = COLUMNS) -> Column:
    """Comma-joined record without quoting; a missing value becomes the word `null`."""
    return F.concat_ws(",", *[_text_or_null_word(name) for name in columns])


def safe_line_of(columns: list[str] = COLUMNS) -> Column:
    """Quoted CSV record that parses back to the same row, save that empty text becomes NULL."""
    return F.to_csv(F.struct(*columns), SAFE_CSV)


def rendered_row(columns: list[str] = COLUMNS) -> Column:
    """One captioned line per row, for reading by eye."""
    parts = []
    for caption, name in zip(CAPTIONS, columns, strict=True):
        parts += [F.lit(caption), _text_or_null_word(name)]
    return F.concat(*parts)


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(TRIMMED))


def encode_lines(df: DataFrame, columns: list[str] = COLUMNS) -> DataFrame:
    return df.select(line_of(columns).alias("value"))


def encode_csv_safe(df: DataFrame, columns: list[str] = COLUMNS) -> DataFrame:
    return df.select(safe_line_of(columns).alias("value"))


def parse_lines(
    df: DataFrame,
    ddl: str = CATALOGUE_DDL,
    keep: tuple[str, ...] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Parse `value` (string or binary) into typed columns, carrying `keep` along.

    Permissive: a bad field is NULL, a short record is padded with NULLs and
    surplus fields are ignored.
    """
    parsed = F.from_csv(F.col("value").cast("string"), ddl, options or {}).alias("data")
    return df.select(parsed, *keep).select("data.*", *keep)
