"""Records whose description holds commas, read from both ends.

The id at the left and the ten flags and the label at the right are typed and
hold no comma. Of what remains, the last field is the category and the rest the
description. A comma in the category cannot be told from one in the description:
what stands before it is read as description.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.schema import CATALOGUE, FLAGS, LABEL

_FIELDS = len(CATALOGUE.fields)
_INTEGER = r"^[+-]?[0-9]{1,10}$"
_MISSING = ("", "null")


def _integer(text: Column) -> Column:
    return F.when(text.rlike(_INTEGER), text.try_cast("int"))


def _fits_integer(text: Column) -> Column:
    return text.isin(*_MISSING) | _integer(text).isNotNull()


def _flag(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low == "true", True).when(low == "false", False)


def _text(value: Column) -> Column:
    return F.when(value != "", value)


def _read(fields: Column) -> Column:
    """The typed row of a record's fields, and why it fits no reading (else NULL)."""
    n = F.size(fields)
    flags = F.slice(fields, n - len(FLAGS), len(FLAGS))
    row = F.struct(
        _integer(F.get(fields, F.lit(0))).alias("id"),
        _text(F.array_join(F.slice(fields, 2, n - _FIELDS + 1), ",")).alias("description"),
        _text(F.get(fields, n - len(FLAGS) - 2)).alias("category"),
        *(_flag(F.get(fields, n - len(FLAGS) - 1 + i)).alias(name) for i, name in enumerate(FLAGS)),
        _integer(F.get(fields, n - 1)).alias(LABEL),
    )
    reason = (
        F.when(n < _FIELDS, "fields")
        .when(~_fits_integer(F.get(fields, F.lit(0))), "id")
        .when(~F.forall(flags, lambda f: F.lower(f).isin("true", "false", *_MISSING)), "flags")
        .when(~_fits_integer(F.get(fields, n - 1)), "label")
    )
    return F.when(reason.isNull(), F.struct(row.alias("row"), F.lit(None).cast("string").alias("reason"))).otherwise(
        F.struct(F.lit(None).cast(CATALOGUE).alias("row"), reason.alias("reason"))
    )


def read_lines(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(row, reason, value, keep...): each record read from both ends; one of row and reason is NULL.

    Quotes are ordinary characters. Empty text reads as NULL, and so do an empty
    or `null` number or flag; the word `null` in a text stays a word, as
    `parse_lines` has it. A NULL record fits no reading.
    """
    value = F.col("value").cast("string")
    # bound once: split would otherwise be worked out anew for every field
    read = F.transform(F.array(F.split(F.coalesce(value, F.lit("")), ",", -1)), _read)[0]
    return df.select(read.alias("_read"), value.alias("value"), *keep).select("_read.row", "_read.reason", "value", *keep)


def parse_lines_repaired(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns of the records that can be read, with `keep`."""
    return read_lines(df, keep).where("reason IS NULL").select("row.*", *keep)


def quarantined(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(value, reason, keep...) of the records that cannot: too few fields, or an id, flag or label of another type."""
    return read_lines(df, keep).where("reason IS NOT NULL").select("value", "reason", *keep)
