import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F

from shelfmark.operators import changes
from shelfmark.operators.commands import Prompt, execute, kind_of
from shelfmark.schema import CATALOGUE


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


def test_kinds(spark):
    kinds = {
        "select count(*) from eclasses": "query", "WITH a AS (SELECT 1) SELECT * FROM a": "query", "VALUES (1)": "query",
        "insert into eclasses values (1)": "insert", "update eclasses set id = 1": "update", "DELETE FROM eclasses": "delete",
        "DROP TABLE eclasses": "other", "TRUNCATE TABLE eclasses": "other", "SET a=1": "other", "CREATE TABLE t AS SELECT 1": "other",
    }
    assert {text: kind_of(spark, text) for text in kinds} == kinds


def test_inserts(base):
    found = by_id(execute(base, "INSERT INTO eclasses (category, id) VALUES ('x', 7), (NULL, 8)").snapshot)
    assert set(found) == {1, 2, 3, 7, 8} and found[7]["category"] == "x" and found[7]["brand"] is None
    found = by_id(execute(base, "INSERT INTO eclasses BY NAME SELECT id + 10 AS ID, description FROM eclasses").snapshot)
    assert found[11]["description"] == "one" and execute(base, "INSERT INTO eclasses TABLE eclasses").snapshot.count() == 6
    assert execute(base, "INSERT INTO eclasses (id) SELECT 1").snapshot.schema == CATALOGUE


def test_updates_and_deletes(base):
    text = "UPDATE eclasses e SET e.taric = details, details = e.taric, EclassNumber = (SELECT max(eclassnumber) FROM eclasses) WHERE id < 3"
    found = by_id(execute(base, text).snapshot)
    assert (found[1]["taric"], found[1]["details"], found[1]["eclassnumber"]) == (True, False, 20)
    assert found[3] == by_id(base)[3]
    assert set(by_id(execute(base, "DELETE FROM eclasses WHERE eclasses.category = 'a'").snapshot)) == {2, 3}
    assert execute(base, "DELETE FROM eclasses").snapshot.count() == 0
    assert {r["brand"] for r in execute(base, "UPDATE eclasses SET brand = true").snapshot.collect()} == {True}


def test_a_query_leaves_the_snapshot(base):
    outcome = execute(base, "SELECT count(*) AS n FROM eclasses")
    assert outcome.kind == "query" and outcome.rows.first()["n"] == 3 and outcome.snapshot is base


@pytest.mark.parametrize(
    "text,error",
    [
        ("UPDATE eclasses SET", ParseException), ("", ParseException), ("UPDATE other SET id = 1", ValueError), ("DROP TABLE eclasses", ValueError),
        ("UPDATE eclasses SET colour = 1", ValueError), ("UPDATE eclasses SET id = 1, ID = 2", ValueError), ("UPDATE eclasses SET id = colour", AnalysisException),
        ("DELETE FROM eclasses WHERE colour = 1", AnalysisException), ("DELETE FROM a.eclasses", ValueError),
        ("INSERT INTO eclasses (id, category) VALUES (1)", ValueError), ("INSERT INTO eclasses VALUES (1)", ValueError),
        ("INSERT OVERWRITE eclasses SELECT 1", ValueError), ("INSERT INTO eclasses (id, id) VALUES (1, 2)", ValueError),
        ("SELECT nothing FROM eclasses", AnalysisException), ("UPDATE e.eclasses SET id = 1", ValueError), ("UPDATE eclasses e SET x.id = 1", ValueError),
    ],
)
def test_a_failed_command_gives_no_next_snapshot(base, text, error):
    sent = []
    prompt = Prompt(base, lambda before, after: sent.append(after))
    with pytest.raises(error):
        prompt.run(text)
    assert prompt.current is base and not sent
    assert not base.sparkSession.catalog.tableExists("eclasses")


def test_a_command_that_fails_on_the_data_leaves_the_snapshot(base):
    prompt = Prompt(base)
    with pytest.raises(Exception, match="(?i)cast|zero|overflow"):
        prompt.run("UPDATE eclasses SET eclassnumber = eclassnumber / (id - 2)")
    assert prompt.current is base
    prompt.run("UPDATE eclasses SET eclassnumber = 1")
    with pytest.raises(ValueError):
        prompt.run_all(["DELETE FROM eclasses WHERE id = 1", "DROP TABLE eclasses", "DELETE FROM eclasses"])
    assert set(by_id(prompt.current)) == {2, 3}


def test_changes_are_published_after_each_command(base):
    sent = []
    prompt = Prompt(base, lambda before, after: sent.append(sorted((r["change"], r["id"]) for r in changes.snapshot_changes(before, after).collect())))
    prompt.run_all(["DELETE FROM eclasses WHERE id = 1", "UPDATE eclasses SET category = 'z' WHERE id = 2"])
    prompt.run("SELECT 1")
    assert sent == [[("delete", 1)], [("update_after", 2), ("update_before", 2)]]


def test_changes_count_copies_and_tell_null_from_empty(spark):
    ddl = "id int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (1, "x", None), (2, "", "y"), (None, "n", "n"), (3, "1:a", "b"), (4, "k", "k")], ddl)
    new = spark.createDataFrame([(1, "x", None), (2, None, "y"), (None, "n", "m"), (3, "1", "a:b"), (4, "k", "k"), (5, "c", "c"), (5, "c", "c")], ddl)
    found = changes.snapshot_changes(old, new)
    listed = sorted((r["change"], r["id"] or 0, r["a"] or "-", r["b"] or "-", r["copies"]) for r in found.collect())
    assert listed == [
        ("delete", 0, "n", "n", 1), ("delete", 1, "x", "-", 1), ("insert", 0, "n", "m", 1), ("insert", 5, "c", "c", 2),
        ("update_after", 2, "-", "y", 1), ("update_after", 3, "1", "a:b", 1), ("update_before", 2, "-", "y", 1), ("update_before", 3, "1:a", "b", 1),
    ]

    def bag(df):
        return sorted(map(str, df.collect()))

    assert bag(changes.apply_changes(old, found)) == bag(new)
    assert bag(changes.apply_changes(new, changes.inverse(found))) == bag(old)
    assert not changes.snapshot_changes(old, old).count() and bag(changes.apply_changes(old, changes.snapshot_changes(old, old))) == bag(old)
    empty = old.where(F.lit(False))
    assert bag(changes.apply_changes(empty, changes.snapshot_changes(empty, new))) == bag(new)
    with pytest.raises(Exception, match="not there"):
        changes.apply_changes(new, found).collect()
    with pytest.raises(ValueError):
        changes.snapshot_changes(old, new.drop("b"))


def test_digests_are_worked_out_once(spark):
    """The passes after the first read the written digests: no pass works out a row's MD5 again."""
    old = spark.range(40).select(F.col("id").cast("int"), F.concat(F.lit("t"), "id").alias("text"))
    new = old.where("id % 4 != 1").withColumn("text", F.when(F.col("id") % 4 == 2, F.upper("text")).otherwise(F.col("text")))
    found = changes.snapshot_changes(old, new)
    assert "md5(" not in found._jdf.queryExecution().optimizedPlan().toString()
    again = changes.apply_changes(old, found)
    assert "md5(" not in again._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(again.collect()) == sorted(new.collect())
