import pytest
from pyspark.sql import functions as F

from shelfmark.functions import codec
from shelfmark.schema import CATALOGUE, COLUMNS, FLAGS, PRODUCER_COLUMNS
from shelfmark.sinks import publish
from shelfmark.sources import files

SHORT_DDL = "id int, description string, category string, b boolean, n int"

EDGE_LINES = [
    ("1,hello world,cat,true,7", (1, "hello world", "cat", True, 7)),
    ("2,a,b,cat,true,7", (2, "a", "b", None, None)),
    ("3,null,null,false,0", (3, "null", "null", False, 0)),
    ("4,,cat,false,1", (4, None, "cat", False, 1)),
    ('5,say "hi" there,c,true,1', (5, 'say "hi" there', "c", True, 1)),
    ('6,"quoted, comma",c,true,1', (6, "quoted, comma", "c", True, 1)),
    ("99999999999,x,y,true,1", (None, "x", "y", True, 1)),
    ("7,short", (7, "short", None, None, None)),
    ("", (None, None, None, None, None)),
    ("8,x,y,TRUE,1", (8, "x", "y", True, 1)),
    ("9,x,y,t,1", (9, "x", "y", None, 1)),
    ("10, lead ,y ,true, 5", (10, " lead ", "y ", True, None)),
    ("11,x,y,true,1,extra", (11, "x", "y", True, 1)),
    ('12,"unterminated,y,true,1', (12, "unterminated,y,true,1", None, None, None)),
    ("13,x,y,true,1.5", (13, "x", "y", True, None)),
]


def row(id_=1, description="d", category="c", flag=True, label=7):
    return (id_, description, category, *[flag] * len(FLAGS), label)


@pytest.mark.parametrize("line,wanted", EDGE_LINES)
def test_edge_lines(spark, line, wanted):
    df = spark.createDataFrame([(line,)], "value string")
    assert tuple(codec.parse_lines(df, SHORT_DDL).first()) == wanted


def test_parse_carries_timestamp_and_reads_binary(spark):
    df = spark.sql("SELECT CAST('1,a,b,true,2' AS BINARY) AS value, timestamp'2020-01-01' AS timestamp")
    parsed = codec.parse_lines(df, SHORT_DDL, keep=("timestamp",))
    assert parsed.columns == ["id", "description", "category", "b", "n", "timestamp"]
    assert parsed.first()["id"] == 1


def test_null_rules(spark):
    df = spark.createDataFrame([(None,) * len(COLUMNS)], CATALOGUE)
    line = codec.encode_lines(codec.decode_nulls(df)).first()[0]
    assert line == "0,null,null," + ",".join(["false"] * len(FLAGS)) + ",0"
    back = codec.parse_lines(codec.encode_lines(codec.decode_nulls(df))).first()
    assert (back["description"], back["id"], back["brand"]) == ("null", 0, False)


def test_empty_text_reads_back_as_null(spark):
    df = spark.createDataFrame([row(description="")], CATALOGUE)
    assert codec.parse_lines(codec.encode_lines(df)).first()["description"] is None


def test_safe_csv_round_trip(spark):
    texts = ["a,b", 'say "hi"', '"', "line\nbreak", "cr\r\nlf", " outer ", None, "back\\slash", "\\", "null", "ü,ß"]
    df = spark.createDataFrame([row(i, t) for i, t in enumerate(texts)], CATALOGUE)
    back = codec.parse_lines(codec.encode_csv_safe(df), options=codec.SAFE_CSV)
    assert {r["id"]: r for r in back.collect()} == {r["id"]: r for r in df.collect()}


def test_safe_csv_reads_empty_text_as_null_too(spark):
    df = spark.createDataFrame([row(description="")], CATALOGUE)
    back = codec.parse_lines(codec.encode_csv_safe(df), options=codec.SAFE_CSV)
    assert back.first()["description"] is None


def test_trim_is_every_character_up_to_blank(spark):
    df = spark.createDataFrame([("\x00\t \x1f a\u00a0b \r\n",), ("\u00a0x",), ("  ",)], "value string")
    found = [r[0] for r in df.select(codec.trimmed(F.col("value"))).collect()]
    assert found == ["a\u00a0b", "\u00a0x", ""]


def test_rendered_row(spark):
    df = spark.createDataFrame([row(5, None, "c", False, 9)], CATALOGUE)
    line = df.select(codec.rendered_row()).first()[0]
    assert line.startswith("id: 5, description: null, category: c, Manufacturer")
    assert "Details: falseName/number of Manufacturer: false, Name" in line
    assert line.endswith("Brand: false, Eclassnumber: 9")


def test_names_map_by_position(spark):
    df = spark.createDataFrame([row()], CATALOGUE)
    renamed = codec.to_producer_names(df)
    assert renamed.columns == PRODUCER_COLUMNS
    assert codec.to_consumer_names(renamed.select(*reversed(PRODUCER_COLUMNS))).schema == CATALOGUE


def test_dump_replaces_and_line_breaks_split_records(spark, tmp_path):
    path = str(tmp_path / "dump")
    publish.text_dump(spark.createDataFrame([("old",)], "value string"), path)
    publish.text_dump(spark.createDataFrame([("a\nb\r\nc\rd",)], "value string"), path)
    assert sorted(r[0] for r in files.text_lines(spark, path).collect()) == ["a", "b", "c", "d"]


def test_quoted_records_keep_values(spark):
    df = spark.createDataFrame([row(1, " a,\nb ")], CATALOGUE)
    record = publish.snapshot_records(df, quoted=True)
    assert record.columns == ["key", "value"] and record.first()["key"] is None
    assert codec.parse_lines(record, options=codec.SAFE_CSV).first() == df.first()
