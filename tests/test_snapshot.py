import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from shelfmark.functions.codec import to_producer_names
from shelfmark.operators import snapshot
from shelfmark.schema import CATALOGUE, FLAGS, PRODUCER_COLUMNS


@pytest.fixture(scope="module")
def base(spark):
    rows = [
        (1, "one", "a", *[True, False] * 5, 10),
        (2, "two", None, *[False, True] * 5, 20),
        (3, None, "c", *[None] * 10, None),
    ]
    return spark.createDataFrame(rows, CATALOGUE)


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_update_reads_old_values(base):
    found = by_id(snapshot.update(base, {"taric": "details", "details": "taric", "eclassnumber": "eclassnumber + 1"}, "id < 3"))
    assert (found[1]["taric"], found[1]["details"], found[1]["eclassnumber"]) == (True, False, 11)
    assert found[3] == by_id(base)[3]


def test_update_without_where_and_with_columns(base):
    found = by_id(snapshot.update(base, {"category": F.lit("z")}))
    assert {r["category"] for r in found.values()} == {"z"}


def test_null_outcome_neither_updates_nor_deletes(base):
    assert by_id(snapshot.update(base, {"brand": "false"}, "category = 'a'"))[2]["brand"] is True
    assert set(by_id(snapshot.delete(base, "category = 'a'"))) == {2, 3}
    assert snapshot.delete(base).count() == 0


def test_insert(spark, base):
    new = spark.createDataFrame([(4, "four")], "id bigint, description string")
    found = snapshot.insert(base, new)
    assert found.schema.fieldNames() == base.columns and found.schema["id"].dataType == CATALOGUE["id"].dataType
    assert by_id(found)[4]["brand"] is None and found.count() == 4
    with pytest.raises(ValueError, match="colour"):
        snapshot.insert(base, new.withColumn("colour", F.lit(1)))


def test_select_needs_every_column(base):
    producer = to_producer_names(base)
    assert snapshot.select_rows(producer, "SELECT * FROM eclasses WHERE id = 1").columns == PRODUCER_COLUMNS
    with pytest.raises(ValueError, match="description"):
        snapshot.select_rows(producer, "SELECT id FROM eclasses")


def test_count_is_an_ordinary_query(base):
    assert snapshot.query(base, "SELECT count(*) AS n FROM eclasses").first()["n"] == 3


def test_a_failed_command_surfaces_before_anything_is_published(base):
    with pytest.raises(AnalysisException):
        snapshot.query(base, "SELECT nothing FROM eclasses")
    with pytest.raises(AnalysisException):
        snapshot.update(base, {"brand": "no_such_column"})


def test_latest_rows(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "a"), (1, 2, 1, "b"), (1, 2, 2, None), (2, None, 1, "c")], "k int, ts int, e int, v string"
    )
    found = {r["k"]: (r["ts"], r["e"], r["v"]) for r in snapshot.latest_rows(df, "k", "ts", "e").collect()}
    assert found == {1: (2, 2, None), 2: (None, 1, "c")}


def test_latest_snapshot_forgets_deleted_rows(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "snapshot_id int, id int")
    assert [tuple(r) for r in snapshot.latest_snapshot(df).collect()] == [(2, 1)]
    assert len(FLAGS) == 10
