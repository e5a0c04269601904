"""Versions of a table: replays, broken-off batches, late actions, compaction by size, and files no version needs."""

import pytest
from pyspark.sql import functions as F

from docquery.session import new_folder
from docquery.sources import versions

LOG = "seq long, action string, _index string, _id string, doc struct<n:int>"


@pytest.fixture
def path(spark):
    return new_folder(spark, "versions")


def _log(spark, *actions):
    return spark.createDataFrame([(seq, action, "t", key, None if n is None else (n,)) for seq, action, key, n in actions], LOG)


def _table(spark, n=4):
    return spark.range(n).select(F.lit("t").alias("_index"), F.col("id").cast("string").alias("_id"), F.struct(F.col("id").cast("int").alias("n")).alias("_source"))


def _state(version):
    return sorted((r["_id"], r["_source"]["n"]) for r in version.table().collect())


def _paths(version):
    return {r["file"]: r["rows"] for r in version.files().filter("kind = 'data'").collect()}


def test_a_batch_is_applied_once_and_only_changed_rows_are_written(spark, path):
    versions.create_versions(_table(spark).coalesce(1), path)
    log = _log(spark, (1, "delete", "0", None), (2, "index", "1", 10), (3, "create", "9", 90), (4, "create", "2", 5))
    one = versions.apply_batch(spark, path, log, "a")
    again = versions.apply_batch(spark, path, log, "a")
    assert again.number == one.number == 1
    assert _state(one) == [("1", 10), ("2", 2), ("3", 3), ("9", 90)]
    assert sum(_paths(one).values()) == 4 + 2 and {f.split("/")[1] for f in _paths(one)} == {"version=0", "version=1"}
    assert _state(versions.open_version(spark, path, 0)) == [(str(k), k) for k in range(4)]
    with pytest.raises(ValueError):
        versions.open_version(spark, path, 7)


def test_a_deleted_document_may_come_back(spark, path):
    versions.create_versions(_table(spark, 1), path)
    versions.apply_batch(spark, path, _log(spark, (1, "delete", "0", None)), "a")
    assert _state(versions.open_version(spark, path)) == []
    versions.apply_batch(spark, path, _log(spark, (2, "create", "0", 7)), "b")
    assert _state(versions.open_version(spark, path)) == [("0", 7)]
    assert _state(versions.compact(spark, path)) == [("0", 7)]


def test_a_batch_that_broke_off_is_written_again(spark, path, monkeypatch):
    versions.create_versions(_table(spark, 2), path)
    log = _log(spark, (1, "index", "0", 5))
    whole = versions.segments

    def breaks(session, folder):
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "segments", breaks)
    with pytest.raises(RuntimeError):
        versions.apply_batch(spark, path, log, "a")
    assert _state(versions.open_version(spark, path)) == [("0", 0), ("1", 1)]
    monkeypatch.setattr(versions, "segments", whole)
    # Another log may take the number; nothing of the remains is read.
    assert _state(versions.apply_batch(spark, path, _log(spark, (1, "index", "1", 6)), "b")) == [("0", 0), ("1", 6)]


def test_late_actions_are_set_aside(spark, path):
    versions.create_versions(_table(spark, 2), path)
    versions.apply_batch(spark, path, _log(spark, (5, "index", "0", 50)), "a")
    two = versions.apply_batch(spark, path, _log(spark, (4, "index", "0", 40), (5, "index", "1", 41), (None, "delete", "1", None), (6, "index", "1", 60)), "b")
    assert _state(two) == [("0", 50), ("1", 60)]
    # A batch of late actions alone leaves the mark where it was.
    three = versions.apply_batch(spark, path, _log(spark, (2, "delete", "0", None)), "c")
    assert _state(three) == [("0", 50), ("1", 60)]
    assert _state(versions.apply_batch(spark, path, _log(spark, (6, "delete", "1", None), (7, "delete", "1", None)), "d")) == [("0", 50)]
    late = versions.late_actions(spark, path).select("version", "seq").collect()
    assert sorted(map(tuple, late), key=str) == sorted([(2, 4), (2, 5), (2, None), (3, 2), (4, 6)], key=str)


def test_one_pass_tells_changed_rows_and_dead_keys(spark, path, monkeypatch):
    """The log is folded once, for the rows and for the keys; a document without an id stays as it is."""
    table = spark.createDataFrame([("t", 1.0, (1,)), ("t", None, (7,)), ("t", 2.0, (2,))], "_index string, _id double, _source struct<n:int>")
    versions.create_versions(table, path)
    folds = []
    whole = versions.materialize

    def counted(df, name):
        folds.append((name, df._jdf.queryExecution().optimizedPlan().toString().count("Window [")))
        return whole(df, name)

    monkeypatch.setattr(versions, "materialize", counted)
    log = spark.createDataFrame([(1, "index", "t", None, (8,)), (2, "delete", "t", 1.0, None), (3, "update", "t", 2.0, (5,))], LOG.replace("_id string", "_id double"))
    one = versions.apply_batch(spark, path, log, "a")
    assert sorted(map(str, [(r["_id"], r["_source"]["n"]) for r in one.table().collect()])) == ["(2.0, 5)", "(None, 7)", "(None, 8)"]
    assert folds == [("log", 0), ("changed", 1)]
    two = versions.apply_batch(spark, path, log.select((F.col("seq") + 9).alias("seq"), "action", "_index", "_id", "doc"), "b")
    assert sorted(str(r["_source"]["n"]) for r in two.table().collect()) == ["5", "7", "8", "8"]


def test_empty_tables_and_logs(spark, path):
    versions.create_versions(_table(spark, 0), path)
    versions.apply_batch(spark, path, _log(spark), "none")
    assert _state(versions.apply_batch(spark, path, _log(spark, (1, "index", "0", 5)), "a")) == [("0", 5)]


def test_new_fields_write_the_table_anew(spark, path):
    versions.create_versions(_table(spark, 2), path)
    log = spark.createDataFrame([(1, "index", "t", "0", (1, "x"))], LOG.replace("n:int", "n:int,word:string"))
    after = versions.apply_batch(spark, path, log, "a")
    assert sorted((r["_id"], r["_source"]["n"], r["_source"]["word"]) for r in after.table().collect()) == [("0", 1, "x"), ("1", 1, None)]
    assert {f.split("/")[1] for f in _paths(after)} == {"version=1"}
    assert "word" not in versions.open_version(spark, path, 0).table().schema["_source"].dataType.names


def test_compaction_leaves_large_clean_files_alone(spark, path):
    big = _table(spark, 40_000).repartitionByRange(2, F.col("_id")).sortWithinPartitions("_id")
    start = versions.create_versions(big, path)
    sizes = {r["file"]: r["bytes"] for r in start.files().filter("kind = 'data'").collect()}
    assert len(sizes) == 2
    target = int(min(sizes.values()) * 1.5)
    assert versions.compact(spark, path, target).number == 0  # nothing to do
    for n in range(2):
        # Ids below "2" lie in the first file only.
        versions.apply_batch(spark, path, _log(spark, (2 * n, "index", "1", n), (2 * n + 1, "create", f"new{n}", n)), f"b{n}")
    before = versions.open_version(spark, path)
    done = versions.compact(spark, path, target)
    kept = set(_paths(done)) & set(sizes)
    assert len(kept) == 1 and len(_paths(before)) > len(_paths(done))
    assert done.dead_rows() is None and _state(done) == _state(before) and len(_state(done)) == 40_002
    unused = {r["file"] for r in versions.unused_files(spark, path, done.number).collect()}
    assert set(sizes) - kept <= unused and not unused & set(_paths(done)) and any(f.startswith("dead/") for f in unused)
    # The next batch goes on from the compacted files.
    assert len(_state(versions.apply_batch(spark, path, _log(spark, (9, "delete", "new0", None)), "last"))) == 40_001


def test_a_micro_batch_that_runs_again_counts_once(spark, path):
    versions.create_versions(_table(spark, 1), path)
    inbox = new_folder(spark, "inbox")
    _log(spark, (1, "index", "0", 5)).coalesce(1).write.parquet(inbox)
    for _ in range(2):  # a lost checkpoint gives the same micro-batch again
        stream = spark.readStream.schema(LOG).parquet(inbox)
        versions.follow(stream, path, "log", new_folder(spark, "checkpoint")).awaitTermination()
    now = versions.open_version(spark, path)
    assert now.number == 1 and _state(now) == [("0", 5)]
