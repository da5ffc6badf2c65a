import os

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.repair import parse_lines_repaired, quarantined
from shelfmark.schema import FLAGS, STAMPED
from shelfmark.sources import files
from shelfmark.streaming.compact import BatchTable
from shelfmark.streaming.ingest import batch_writer
from shelfmark.streaming.manifest import Manifests
from shelfmark.streaming.merge import MergedTable

DDL = "id int, name string, deleted boolean, timestamp timestamp"


def frame(spark, *rows):
    return spark.createDataFrame([(i, name, gone, None) for i, name, gone, _ in rows], DDL).drop("timestamp").join(
        spark.createDataFrame([(i, name, t) for i, name, _, t in rows], "id int, name string, t long").withColumnRenamed("t", "seconds"),
        ["id", "name"],
    ).select("id", "name", "deleted", F.timestamp_seconds("seconds").alias("timestamp"))


def listed(df):
    return sorted((r["id"], r["name"]) for r in df.collect())


def test_merge_keeps_the_newest_and_a_replay_changes_nothing(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path), deleted="deleted", buckets=4)
    assert table.rows() is None
    table.merge(frame(spark, (1, "a", False, 10), (1, "b", False, 20), (2, "c", False, 10), (3, "d", None, 10)), 0)
    assert listed(table.rows()) == [(1, "b"), (2, "c"), (3, "d")]
    later = frame(spark, (1, "old", False, 15), (2, "x", True, 30), (4, "e", False, 5), (3, "tie", False, 10))
    table.merge(later, 1)
    state = table.manifests.latest()
    assert listed(table.rows()) == [(1, "b"), (3, "tie"), (4, "e")]
    table.merge(later, 1)
    table.merge(frame(spark, (9, "older batch", False, 99)), 0)
    assert table.manifests.latest() == state and listed(table.rows()) == [(1, "b"), (3, "tie"), (4, "e")]
    # a deletion holds against older rows, and a newer one brings the key back
    table.merge(frame(spark, (2, "late", False, 20)), 2)
    assert listed(table.rows()) == [(1, "b"), (3, "tie"), (4, "e")]
    table.merge(frame(spark, (2, "again", False, 40)), 3)
    assert listed(table.rows()) == [(1, "b"), (2, "again"), (3, "tie"), (4, "e")]
    assert listed(table.rows(0)) == [(1, "b"), (2, "c"), (3, "d")]
    table.vacuum(keep=1)
    assert listed(table.rows()) == [(1, "b"), (2, "again"), (3, "tie"), (4, "e")]


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path), deleted="deleted", buckets=8)
    table.merge(frame(spark, *[(i, "a", False, 1) for i in range(100)]), 0)
    table.merge(frame(spark, (5, "b", False, 2)), 1)
    versions = table.manifests.latest()[1]["versions"]
    assert sorted(versions.values()) == [0] * 7 + [1]
    assert [n for n in os.listdir(tmp_path / "data/batch=1") if n.startswith("_bucket")] == [f"_bucket={next(b for b, v in versions.items() if v == 1)}"]
    assert table.rows().count() == 100 and table.vacuum(keep=1) == []


def test_a_batch_that_died_before_its_manifest_is_written_again(spark, tmp_path, monkeypatch):
    table = MergedTable(spark, str(tmp_path), deleted="deleted", buckets=2)
    table.merge(frame(spark, (1, "a", False, 1)), 0)
    with monkeypatch.context() as m:
        m.setattr(Manifests, "commit", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError):
            table.merge(frame(spark, (1, "b", False, 2), (2, "c", False, 2)), 1)
    assert listed(table.rows()) == [(1, "a")]
    table.merge(frame(spark, (1, "b", False, 2), (2, "c", False, 2)), 1)
    assert listed(table.rows()) == [(1, "b"), (2, "c")]


def test_rows_without_key_are_all_kept_and_empty_batches_pass(spark, tmp_path):
    table = MergedTable(spark, str(tmp_path), newest=("seconds",), buckets=4)
    rows = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (None, "b", 2), (1, "c", None)], "id int, name string, seconds int")
    table.merge(rows.where(F.lit(False)), 0)
    assert table.rows() is None or table.rows().count() == 0
    table.merge(rows, 1)
    table.merge(rows.where("id IS NULL").limit(1), 2)
    assert table.rows().count() == 5
    with pytest.raises(ValueError, match="columns"):
        table.merge(rows.drop("seconds").withColumn("seconds", F.lit("x")), 3)
    with pytest.raises(ValueError, match="buckets"):
        MergedTable(spark, str(tmp_path), newest=("seconds",), buckets=5).merge(rows, 3)


def test_manifests_are_committed_once(spark, tmp_path):
    log = Manifests(spark, str(tmp_path))
    assert log.latest() is None and log.numbers() == []
    log.commit(3, {"a": [1]})
    log.commit(3, {"a": [1]})
    with pytest.raises(RuntimeError):
        log.commit(3, {"a": [2]})
    log.commit(12, {"a": "ü"})
    assert log.latest() == (12, {"a": "ü"}) and log.numbers() == [3, 12] and log.get(4) is None


def stamped(spark, ids, day):
    row = spark.createDataFrame([(i,) for i in ids], "id int")
    others = {f.name: F.lit(None).cast(f.dataType) for f in STAMPED.fields[1:-1]}
    return row.withColumns(others).withColumn("timestamp", F.lit(f"2024-05-0{day} 10:00:00").cast("timestamp"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_rows_are_the_same_before_during_and_after_compaction(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "out")
    write, table = batch_writer(root), BatchTable(spark, root)
    assert table.compact() == 0
    for batch in range(4):
        write(stamped(spark, [2 * batch, 2 * batch + 1], 1 + batch // 2), batch)
    assert ids(table.rows()) == list(range(8)) and ids(table.rows("2024-05-01")) == [0, 1, 2, 3]
    seen = []
    commit = Manifests.commit
    monkeypatch.setattr(Manifests, "commit", lambda self, *a: (seen.append(ids(table.rows())), commit(self, *a)))
    early = table.rows()
    assert table.compact(through=2) == 3 and seen == [list(range(8))]  # part written, not yet committed
    assert ids(table.rows()) == list(range(8)) == ids(early) and ids(table.rows("2024-05-02")) == [4, 5, 6, 7]
    write(stamped(spark, [8], 2), 4)
    assert table.compact() == 2 and table.compact() == 0 and ids(table.rows()) == list(range(9))
    assert table.merge_parts() == 2 and ids(table.rows("2024-05-02")) == [4, 5, 6, 7, 8]
    assert sorted(table.vacuum()) == ["batch_0", "batch_1", "batch_2", "batch_3", "batch_4", "days_0_2", "days_3_4"]
    assert ids(table.rows()) == list(range(9)) and table.rows().columns == STAMPED.names
    write(stamped(spark, [9], 3), 5)
    (tmp_path / "out/batch_6").mkdir()  # begun and not finished
    assert ids(table.rows()) == list(range(10))


def test_read_batch_can_keep_the_record_time(spark, tmp_path):
    batch_writer(str(tmp_path))(stamped(spark, [1], 1), 0)
    assert files.read_batch(spark, str(tmp_path), 0, STAMPED).where("timestamp IS NOT NULL").count() == 1


def test_records_are_read_from_both_ends(spark):
    flags = ",".join(["true", "FALSE", "null", "", "true", "false", "true", "false", "true", "false"])
    lines = {
        f"1,a,b,{flags},7": (1, "a", "b", 7), f"2,x, y,,z,cat,{flags},-8": (2, "x, y,,z", "cat", -8), f"3,,,{flags},": (3, None, None, None),
        f"null,null,c,{flags},null": (None, "null", "c", None), f"4,a,{flags},9": "fields", "": "fields", None: "fields",
        f"x,a,b,{flags},7": "id", f"99999999999,a,b,{flags},7": "id", f"5,a,b,{flags},1.5": "label", f"6,a,b,yes{flags},7": "flags",
        f"7,a,b,{flags},7,extra": "flags", f'8,"q, r",cat,{flags},7': (8, '"q, r"', "cat", 7),
    }
    df = spark.createDataFrame([(line, k) for k, line in enumerate(lines)], "value string, k int")
    wanted = list(lines.values())
    good = {r["k"]: r for r in parse_lines_repaired(df, ("k",)).collect()}
    bad = {r["k"]: r["reason"] for r in quarantined(df, ("k",)).collect()}
    assert bad == {k: w for k, w in enumerate(wanted) if isinstance(w, str)}
    assert {k: (r["id"], r["description"], r["category"], r["eclassnumber"]) for k, r in good.items()} == {
        k: w for k, w in enumerate(wanted) if isinstance(w, tuple)
    }
    assert [good[0][name] for name in FLAGS] == [True, False, None, None, True, False, True, False, True, False]
    binary = df.select(F.col("value").cast("binary").alias("value"))
    assert parse_lines_repaired(binary).count() == len(good)


def test_a_batch_writes_its_own_rows_and_parts_are_merged_by_weight(spark, tmp_path, monkeypatch):
    """Rows written grow with the logarithm of the batches, not with their number; every state reads right."""
    monkeypatch.setattr("shelfmark.streaming.merge.FAN_IN", 2)
    table = MergedTable(spark, str(tmp_path), newest=("seconds",), deleted="gone", buckets=1)
    schema = "id int, name string, seconds int, gone boolean"
    truth, states = {}, []
    for batch in range(8):
        rows = [(i, f"{batch}", batch if i else -batch, i == batch) for i in range(batch, batch + 3)] + [(0, "late", -batch, False)]
        table.merge(spark.createDataFrame(rows, schema), batch)
        for i, name, at, gone in rows:
            if i not in truth or (at, batch, gone) >= truth[i][1]:
                truth[i] = ((i, name), (at, batch, gone))
        states.append(sorted(row for row, (_, _, gone) in truth.values() if not gone))
        assert [r[0] for r in listed(table.rows())] == [r[0] for r in states[-1]]
    state = table.manifests.latest()[1]
    assert table._parts(state, "0") == [[7, 8]]
    sizes = [spark.read.parquet(str(tmp_path / f"data/batch={b}")).count() for b in range(8)]
    assert sizes[2] <= 4 and sizes[4] <= 4 and sizes[6] <= 4  # their own rows alone
    assert len(table._parts(table.manifests.get(6), "0")) == 3
    for batch, wanted in enumerate(states):
        assert [r[0] for r in listed(table.rows(batch))] == [r[0] for r in wanted]
    assert sorted(table.vacuum(keep=1)) == list(range(7)) and [r[0] for r in listed(table.rows())] == [r[0] for r in states[-1]]
