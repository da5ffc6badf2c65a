"""Names and captions that results must carry, written out apart from the library."""

from __future__ import annotations

# Consumer name and producer name of each column, in record order.
NAMES = [
    ("id", "id"),
    ("description", "description"),
    ("category", "category"),
    ("product_description", "manufacturer_product_description"),
    ("link", "link"),
    ("gln_of_supplier", "gln_of_supplier"),
    ("taric", "taric"),
    ("details", "details"),
    ("product_article", "name_numberofmanufacturer_product_article"),
    ("number_of_supplier", "name_number_of_supplier"),
    ("gln_of_manufacturer", "uri_glnofmanufacturer"),
    ("gtin", "gtin"),
    ("brand", "brand"),
    ("eclassnumber", "eclassnumber"),
]

COLUMNS = [consumer for consumer, _ in NAMES]
PRODUCER_COLUMNS = [producer for _, producer in NAMES]
FLAGS = COLUMNS[3:13]

# What stands before each field of a rendered row, typing errors included.
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
