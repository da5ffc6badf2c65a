import os

import pytest

from shelfmark.functions.codec import encode_lines
from shelfmark.schema import CATALOGUE, FLAGS
from shelfmark.sinks.publish import publish, records
from shelfmark.sources import files, jdbc, kafka
from shelfmark.streaming.ingest import batch_writer, ingest_available, start_ingest


def drop_file(folder, name, ids):
    folder.mkdir(exist_ok=True)
    lines = [f"{i},text {i},cat," + ",".join(["true"] * len(FLAGS)) + f",{i * 10}" for i in ids]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_restart_goes_on_after_the_last_batch(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    drop_file(source, "a.txt", [1, 2])
    drop_file(source, "b.txt", [3])

    def run():
        ingest_available(files.text_stream(spark, str(source), files_per_batch=1), out, mark)
        return sorted(name for name in os.listdir(out) if name.startswith("batch_"))

    assert run() == ["batch_0", "batch_1"]
    assert run() == ["batch_0", "batch_1"]
    drop_file(source, "c.txt", [4, 5])
    assert run() == ["batch_0", "batch_1", "batch_2"]
    assert sorted(r["id"] for r in files.read_batch(spark, out).collect()) == [1, 2, 3, 4, 5]
    assert sorted(r["id"] for r in files.read_batch(spark, out, 2).collect()) == [4, 5]
    stored = spark.read.parquet(f"{out}/batch_0")
    assert stored.columns[-1] == "timestamp" and stored.where("timestamp IS NULL").count() == 0
    assert files.read_batch(spark, out, 0).schema == CATALOGUE


def test_replayed_batch_replaces_its_folder(spark, tmp_path):
    write = batch_writer(str(tmp_path))
    df = spark.range(5)
    write(df, 3)
    write(df, 3)
    assert spark.read.parquet(str(tmp_path / "batch_3")).count() == 5


def test_timed_query_runs_until_stopped(spark, tmp_path):
    drop_file(tmp_path / "in", "a.txt", [1])
    query = start_ingest(
        files.text_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "mark"), "1 second"
    )
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert files.read_batch(spark, str(tmp_path / "out"), 0).count() == 1


def test_declared_schema_prunes_and_fills(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(2).selectExpr("CAST(id AS INT) AS id", "'x' AS extra").write.parquet(path)
    df = files.parquet_table(spark, path)
    assert df.schema == CATALOGUE and df.first()["category"] is None


def test_spread_leaves_a_wide_scan_alone(spark):
    assert files.spread(spark.range(10).repartition(9)).rdd.getNumPartitions() == 9
    assert files.spread(spark.range(10).coalesce(1), 3).rdd.getNumPartitions() == 3


def test_jdbc_options_cut_the_key_range():
    options = jdbc.range_options("jdbc:x", "eclasses", 0, 100, 4, properties={"user": "u", "fetchsize": "7"})
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    assert (options["lowerBound"], options["upperBound"]) == ("0", "100")
    assert (options["user"], options["fetchsize"], options["dbtable"]) == ("u", "7", "eclasses")


def test_topic_options():
    options = kafka.subscribe_options("h:9092", "t", max_offsets_per_trigger=10, min_partitions=4)
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t"
    assert (options["maxOffsetsPerTrigger"], options["minPartitions"]) == ("10", "4")


def test_topic_write_needs_the_connector(spark):
    df = spark.createDataFrame([(1, "d", "c", *[True] * 10, 1)], CATALOGUE)
    with pytest.raises(Exception, match="kafka"):
        publish(records(encode_lines(df)), "localhost:1", "t")
