from pathlib import Path

import pytest
from pyspark.sql import types as T

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


@pytest.fixture(autouse=True)
def own_peak():
    """A child starts with the peak memory of the process that starts it: each test starts from what is in use."""
    peak = Path("/proc/self/clear_refs")
    if peak.exists():
        peak.write_text("5")


@pytest.fixture
def tables(spark, tmp_path):
    """Writes the given rows as tables and gives their folder; tables not given are empty."""

    def write(extra: dict[str, str] | None = None, **rows):
        for name, schema in SCHEMAS.items():
            fields = T.StructType.fromDDL(schema)
            given = [(*row, *([None] * (len(fields) - len(row)))) for row in rows.get(name, [])]
            frame = spark.createDataFrame(given, fields)
            for column, value in (extra or {}).items():
                if column.lower() not in {c.lower() for c in frame.columns}:
                    frame = frame.selectExpr("*", f"{value} AS `{column}`")
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
