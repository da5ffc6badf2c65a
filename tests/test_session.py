from types import SimpleNamespace

import pytest

from shelfmark import session


def fake(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: configured or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_the_clusters_folder_is_used():
    assert session.shared_folder(fake("spark://h:7077", "s3a://b/c/")) == "s3a://b/c"


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))


def test_paths_are_never_handed_out_twice(spark):
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_materialized_table_keeps_schema_and_prunes(spark):
    df = spark.range(10).selectExpr("id", "CAST(id % 2 AS INT) AS part")
    table = session.materialize(df, "t", ("part",))
    assert sorted(map(tuple, table.collect())) == sorted(map(tuple, df.collect()))
    assert "PartitionFilters: [isnotnull(part" in table.where("part = 1")._jdf.queryExecution().toString()
