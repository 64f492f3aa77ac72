"""Commit files, table sets that change in one step, and logs with several writers."""

import hashlib
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.sources import commits, raw, snapshots, tables


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    folder = str(tmp_path / "log")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: commits.commit(
            spark, folder, lambda number, before: {"n": number, "sum": before.get("sum", 0) + i}), range(24)))
    assert sorted(got) == list(range(1, 25)) == commits.numbers(spark, folder)
    assert commits.newest(spark, folder) == {"n": 24, "sum": sum(range(24))}    # nobody's content was lost
    assert spark.read.json(folder).count() == 24                                # no half or hidden file is seen


def test_rename_refuses_a_taken_name(spark, tmp_path):
    (tmp_path / "a").write_text("a")
    (tmp_path / "b").write_text("b")
    paths = [commits.file_system(spark, str(tmp_path / n))[1] for n in ("a", "b", "c")]
    assert not commits._rename_to_new(spark, paths[0], paths[1])
    assert (tmp_path / "b").read_text() == "b"
    assert commits._rename_to_new(spark, paths[0], paths[2]) and (tmp_path / "c").read_text() == "a"


def _features(spark, x):
    def table(schema):
        return spark.createDataFrame([tuple(x if f.name in ("userId", "productId") else None for f in schema.fields)], schema)
    return {name: table(schema) for name, schema in schemas.FEATURE_TABLES.items()}


def _keys(stored):
    return {name: df.first()[0] for name, df in stored.items()}


def test_a_set_that_dies_half_way_leaves_the_old_one(spark, tmp_path):
    root = str(tmp_path / "root")
    tables.write_features(_features(spark, "old"), root)
    broken = _features(spark, "new")
    broken["cooccurrence"] = broken["cooccurrence"].withColumn("cooc_score", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        tables.write_features(broken, root)
    assert set(_keys(tables.read_features(spark, root)).values()) == {"old"}
    reader = tables.read_features(spark, root)
    tables.write_features(_features(spark, "new"), root)
    assert set(_keys(tables.read_features(spark, root)).values()) == {"new"}
    assert set(_keys(reader).values()) == {"old"}                               # who began before reads on


def test_only_replaced_folders_are_removed(spark, tmp_path):
    root = str(tmp_path / "root")
    for x in ("a", "b", "c"):
        tables.write_table(spark.createDataFrame([(x,)], "x string"), root, "t")
    tables.write_table(spark.range(3), root, "other")
    running = tables.write_folder(spark.range(5), root, "t")
    assert tables.remove_replaced(spark, root, keep=1) == 2
    assert tables.read_table(spark, root, "t").first()[0] == "c" and tables.read_table(spark, root, "other").count() == 3
    assert spark.read.parquet(running).count() == 5
    assert tables.remove_replaced(spark, root, keep=1) == 0


def test_two_writers_of_versions_and_runs(spark, tmp_path):
    root = str(tmp_path / "root")
    tables.write_features(_features(spark, "u"), root)
    with ThreadPoolExecutor(4) as pool:
        ids = list(pool.map(lambda i: tables.register_version(spark, root, f"v{i}", "at once"), range(6)))
        runs = list(pool.map(lambda i: tables.log_run(spark, root, "m", {"i": i}, {"rmse": i / 3}), range(6)))
    assert sorted(ids) == list(range(1, 7))
    listed = tables.list_versions(spark, root).collect()
    assert [r["version_id"] for r in listed] == [6, 5, 4, 3, 2, 1]
    assert {r["version_tag"] for r in listed} == {f"v{i}" for i in range(6)} and listed[0]["n_users"] == 1
    logged = {r["run_id"]: r for r in tables.read_table(spark, root, "runs").collect()}
    assert set(logged) == set(runs)
    assert all(logged[run]["metrics"]["rmse"] == i / 3 and logged[run]["params"]["i"] == str(i) for i, run in enumerate(runs))


def test_audit_sees_what_was_written(spark, tmp_path):
    root, df = str(tmp_path / "root"), spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, cast(id AS string)) AS s")
    for name, part in (("full", df), ("empty", df.where("id < 0"))):
        rows, seen = tables.watched(part.repartition(5))
        path = tables.write_table(rows, root, name)
        tables.append_audit(spark, root, "test", name, path, seen)
    audit = {r["file"]: r for r in tables.read_table(spark, root, "audit").collect()}
    for name, part in (("full", df), ("empty", df.where("id < 0"))):
        want = raw.table_checksum(part).first()
        assert (audit[name]["rows"], audit[name]["md5"]) == (want["rows"], hashlib.md5(want["checksum"].encode()).hexdigest())
        assert audit[name]["size_bytes"] > 0


def test_a_snapshot_that_dies_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "s")
    snapshots.append_snapshot(spark.createDataFrame([("a",)], "x string"), path, "20260101_000000")
    for stamp in ("20260101_000000", "20260102_000000"):
        with pytest.raises(Exception, match="lost"):
            snapshots.append_snapshot(spark.range(1).select(F.raise_error(F.lit("lost")).cast("string").alias("x")), path, stamp)
    assert [r[0] for r in snapshots.load_latest(spark, path).collect()] == ["a"]
