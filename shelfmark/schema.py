"""The one catalogue schema: consumer names and types, and the producer's names."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten yes/no attributes of a catalogue row, in record order.
FLAGS = [
    "product_description",
    "link",
    "gln_of_supplier",
    "taric",
    "details",
    "product_article",
    "number_of_supplier",
    "gln_of_manufacturer",
    "gtin",
    "brand",
]

LABEL = "eclassnumber"

CATALOGUE = T.StructType(
    [T.StructField("id", T.IntegerType())]
    + [T.StructField(name, T.StringType()) for name in ("description", "category")]
    + [T.StructField(name, T.BooleanType()) for name in FLAGS]
    + [T.StructField(LABEL, T.IntegerType())]
)

COLUMNS = CATALOGUE.fieldNames()

# A catalogue row as it is ingested: with the time of its record.
STAMPED = T.StructType([*CATALOGUE.fields, T.StructField("timestamp", T.TimestampType())])

CATALOGUE_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CATALOGUE.fields)

# The four columns that the database names differently.
PRODUCER_NAME = {
    "product_description": "manufacturer_product_description",
    "product_article": "name_numberofmanufacturer_product_article",
    "number_of_supplier": "name_number_of_supplier",
    "gln_of_manufacturer": "uri_glnofmanufacturer",
}

PRODUCER_COLUMNS = [PRODUCER_NAME.get(name, name) for name in COLUMNS]
