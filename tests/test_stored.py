import json
import os

import pytest
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.operators import ingest, store
from ratelake.plans import batch, tables as T
from ratelake.session import shared_folder
from ratelake.sources import raw, snapshots, tables, views
from ratelake.streaming import incremental

FOLDER = "/root/testdata/sf0.001"


def test_latest_file_name_rules(spark, tmp_path):
    for name in ("products_20260707_025959.csv", "products_20260708_000000.csv", "products_old.csv",
                 "api_products_20260709_232613.csv", "products_20260709.csv", "products_99999999_9999999.csv"):
        (tmp_path / name).write_text("productId,title\n1,%s\n" % name)
    folder = str(tmp_path)
    assert snapshots.latest_file(spark, folder, "products").endswith("/products_20260708_000000.csv")
    assert snapshots.latest_file(spark, folder, "api_products").endswith("api_products_20260709_232613.csv")
    got = snapshots.load_latest_csv(spark, folder, "products", schemas.PRODUCTS)
    assert got.first()["title"] == "products_20260708_000000.csv"
    with pytest.raises(FileNotFoundError):
        snapshots.load_latest_csv(spark, folder, "ratings", schemas.RATINGS)
    assert snapshots.load_latest_csv(spark, folder, "ratings", schemas.RATINGS, required=False) is None


def test_snapshots_are_kept(spark, tmp_path, rows):
    path = str(tmp_path / "snap")
    snapshots.append_snapshot(spark.createDataFrame([("a",)], "x string"), path, "20260101_000000")
    snapshots.append_snapshot(spark.createDataFrame([("b",)], "x string"), path, "20260102_000000")
    assert rows(snapshots.load_latest(spark, path)) == [("b",)]
    assert spark.read.parquet(path).count() == 2


def test_file_checksums(spark, tmp_path):
    (tmp_path / "f.txt").write_text("abc")
    row = raw.file_checksums(spark, str(tmp_path)).first()
    assert (row["file"], row["size_bytes"], row["md5"]) == ("f.txt", 3, "900150983cd24fb0d6963f7d28e17f72")


def test_table_checksum_ignores_order(spark):
    df = spark.range(100)
    assert raw.table_checksum(df.repartition(7)).first() == raw.table_checksum(df.orderBy("id")).first()
    assert raw.table_checksum(df).first() != raw.table_checksum(df.union(spark.range(1))).first()


def test_incremental_runs_take_new_files_only(spark, tmp_path):
    folder, out, check, bad = (str(tmp_path / n) for n in ("in", "out", "check", "bad"))
    (tmp_path / "in").mkdir()

    def line(u):
        return json.dumps({"user_id": u, "parent_asin": "p", "rating": 4, "timestamp": 1588687728923})

    (tmp_path / "in" / "1.json").write_text(line("u1") + "\n{broken\n")
    incremental.ingest_new_ratings(spark, folder, out, check, bad)
    (tmp_path / "in" / "2.json").write_text(line("u2"))
    incremental.ingest_new_ratings(spark, folder, out, check, bad, max_files=1)
    incremental.ingest_new_ratings(spark, folder, out, check, bad)
    got = spark.read.parquet(out)
    assert sorted(r["userId"] for r in got.collect()) == ["u1", "u2"]
    assert got.first()["timestamp"] == 1588687728
    assert [r[0] for r in spark.read.parquet(bad).collect()] == ["{broken"]


def test_shared_folder_is_the_named_one(spark):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir") or "").rstrip("/")


def test_batch_from_files_to_features(spark, tmp_path):
    root = str(tmp_path / "root")
    ratings, products = views.ratings(spark, FOLDER), views.products(spark, FOLDER)
    ratings.selectExpr("to_json(struct(userId as user_id, productId as parent_asin, rating, "
                       "timestamp * 1000 as timestamp)) as value").write.text(str(tmp_path / "r"))
    products.selectExpr("to_json(struct(productId as parent_asin, title, cast(price as string) as price, "
                        "brand as store, array(category) as categories, array(description) as description)) "
                        "as value").write.text(str(tmp_path / "p"))
    got = batch.ingest_all(spark, root, str(tmp_path / "r"), str(tmp_path / "p"), sample_users=100)
    assert got["ratings"].select("userId").distinct().count() == 100
    assert sorted(r["source"] for r in tables.read_table(spark, root, "audit").collect()) == [
        "products_source", "ratings_source"]

    results = batch.validate(got["ratings"], got["products"], root)
    assert results.count() == 12 + 18
    cleaned, catalog = batch.prepare_all(got["ratings"], got["products"], root, enrich=True)
    stored = batch.build_features(cleaned, catalog, root, top_n=50, buckets=3)
    assert stored["interaction_features"].count() == cleaned.count()
    assert stored["user_features"].columns == schemas.USER_FEATURES.names
    assert stored["item_features"].columns == schemas.ITEM_FEATURES.names + list(schemas.ITEM_ENRICHED_COLUMNS)
    assert stored["cooccurrence"].count() <= 150

    assert tables.read_registry(spark, root, "user_features").count() == 7
    assert tables.read_registry(spark, root, "nope").count() == 0
    assert tables.register_version(spark, root, "v1") == 1
    assert tables.register_version(spark, root, "v2", "again") == 2
    assert [r["version_tag"] for r in tables.list_versions(spark, root).collect()] == ["v2", "v1"]
    assert tables.list_versions(spark, str(tmp_path / "empty")).count() == 0

    found = batch.train_content(catalog, cleaned, root, top_k=5)
    assert found["metrics"]["coverage_pct"] == 100.0
    fitted = batch.train_factors(cleaned, root, {"rank": (2, 4), "maxIter": (2,)}, folds=2)
    assert {"rmse", "mae", "precision_at_k", "recall_at_k", "ndcg_at_k", "cv_best_rmse"} <= set(fitted["metrics"])
    assert sorted(r["model"] for r in tables.read_table(spark, root, "runs").collect()) == ["content", "factors"]


def test_cleaned_tables_from_csv(spark, tmp_path, rows):
    spark.createDataFrame([("u", "p", 1.0, 5)], schemas.RATINGS).coalesce(1).write.option("header", True) \
        .csv(str(tmp_path / "cleaned_ratings.csv"))
    spark.createDataFrame([("p", "t", 1.0, "b", "c", "d")], schemas.PRODUCTS).write.option("header", True) \
        .csv(str(tmp_path / "cleaned_products.csv"))
    ratings, products = tables.load_cleaned(spark, str(tmp_path), "csv")
    assert rows(ratings) == [("u", "p", 1.0, 5)] and products.count() == 1
    with pytest.raises(FileNotFoundError):
        tables.load_cleaned(spark, str(tmp_path / "none"))


def test_training_set_from_buckets_shuffles_by_item_only(spark, tmp_path, rows):
    """Users and interactions in buckets meet without a shuffle, in a catalog that never saw them too."""
    folder, root, plain = FOLDER, str(tmp_path / "buckets"), str(tmp_path / "plain")
    built = {name: getattr(T, name)(spark, folder) for name in ("user_features", "item_features", "interaction_features")}
    # Unknown users and rows without one are no match, but stay.
    odd = built["interaction_features"].limit(2).withColumn("userId", F.lit(None).cast("string"))
    built["interaction_features"] = built["interaction_features"].unionByName(odd)
    folders = tables.write_features(built, root, buckets=4)
    tables.write_features(built, plain)
    assert spark.catalog.tableExists(tables._table_name(folders["user_features"])) is False

    def training(where):
        users, items, interactions = (tables.read_table(spark, where, f"{n}_features") for n in ("user", "item", "interaction"))
        return store.training_set(interactions, users, items)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [training(where)._jdf.queryExecution().executedPlan().toString() for where in (root, plain)]
        found = rows(training(root))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(userId" in plans[1] and "hashpartitioning(userId" not in plans[0]
    assert "hashpartitioning(productId" in plans[0]
    assert found == rows(training(plain)) and len(found) == built["interaction_features"].count()
    # A new set replaces the old one, in other buckets.
    tables.write_features({"user_features": built["user_features"].limit(3)}, root, buckets=2)
    assert tables.read_table(spark, root, "user_features").count() == 3


def test_top_users_counted_before_cleaning(spark, rows):
    df = spark.createDataFrame([("a", "p", 1.0, 1)] * 3 + [("b", "p", 1.0, 1), ("b", "q", 1.0, 1), ("c", "p", 1.0, 1)],
                               schemas.RATINGS)
    assert rows(ingest.top_users(df, 2)) == [("a", 3), ("b", 2)]
    assert ingest.keep_top_users(df, 1).count() == 3


def test_no_input_is_lost(spark, tmp_path):
    """Good and quarantined lines make up the files; date-time texts are time stamps."""
    root = str(tmp_path / "root")
    for name, lines in {
        "r": ['{"user_id": "A", "parent_asin": "p", "rating": 5.0, "timestamp": 1588687728123}', "{broken",
              '{"user_id": "B", "parent_asin": "p", "rating": "many", "timestamp": 1588687728123}',
              '{"user_id": "C", "parent_asin": "q", "rating": 4.0, "timestamp": "2020-05-05T13:42:08Z"}'],
        "p": ['{"parent_asin": "p", "title": "t"}', "[broken"],
        "pages": ['{"status": "ok", "data": [{"productId": "p"}], "pagination": {"page": 1}}', "<html>"],
    }.items():
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(str(tmp_path / name))
    got = batch.ingest_all(spark, root, *(str(tmp_path / n) for n in ("r", "p", "pages")))
    bad = sorted((r["source"], r["line"][:7]) for r in tables.read_table(spark, root, "quarantine").collect())
    assert [b[0] for b in bad] == ["api_products", "products", "ratings", "ratings"]
    assert {(r["userId"], r["timestamp"]) for r in got["ratings"].collect()} == {("A", 1588687728), ("C", 1588686128)}


def test_an_absent_key_field_is_an_error(spark, tmp_path):
    for name, line in (("r", '{"user": "A", "parent_asin": "p", "rating": 5.0}'), ("p", '{"parent_asin": "p"}')):
        spark.createDataFrame([(line,)], "value string").write.text(str(tmp_path / name))
    with pytest.raises(ValueError, match="user_id"):
        batch.ingest_all(spark, str(tmp_path / "root"), str(tmp_path / "r"), str(tmp_path / "p"))


LINES = ['{"user_id": "u", "parent_asin": "p", "rating": 4, "timestamp": 1600000000000}', "null", "[]", "{}", "", "  \t", "7", '"text"', "true",
         '[{"user_id": "a", "parent_asin": "b", "rating": 5}, {"user_id": "c", "parent_asin": "d", "rating": 5}]', "{broken",
         ' {"user_id": "v", "parent_asin": "q", "rating": 9, "timestamp": 1}', '{"user_id": "w", "rating": 3}', '{"user_id": {"a": 1}, "rating": "x"}']


def test_every_line_lands_once(spark, tmp_path):
    """Good, dropped and quarantined lines make up the file; blank lines are none of them."""
    (tmp_path / "r.jsonl").write_text("\n".join(LINES) + "\n")
    (tmp_path / "p.jsonl").write_text('{"parent_asin": "p", "title": "t"}\nnull\n')
    root = str(tmp_path / "root")
    for _ in range(2):                                  # a rerun with the same stamp changes nothing
        made = batch.ingest_all(spark, root, str(tmp_path / "r.jsonl"), str(tmp_path / "p.jsonl"), ingest_ts="20260101_000000")
        assert [tuple(r)[:3] for r in made["ratings"].collect()] == [("u", "p", 4.0)]
        assert made["products"].count() == 1
        bad = tables.read_table(spark, root, "quarantine").collect()
        mine = sorted(r["line"] for r in bad if r["source"] == "ratings")
        assert mine == sorted(t for t in LINES if t.strip() and (not t.strip().startswith("{") or t == "{broken" or "[{" in t or '"x"' in t))
        assert [r["line"] for r in bad if r["source"] == "products"] == ["null"]
        assert {r["file"].rsplit("/", 1)[-1] for r in bad} == {"r.jsonl", "p.jsonl"}
    good, dropped = 1, 3                                # no keys, an odd rating, no item
    assert good + dropped + len(mine) == sum(bool(t.strip()) for t in LINES)


def test_absent_keys_and_empty_files(spark, tmp_path):
    import pytest
    (tmp_path / "r.jsonl").write_text(LINES[0] + "\n")
    (tmp_path / "p.jsonl").write_text('{"asin": "p", "title": "t"}\n{"asin": "q"}\n')
    (tmp_path / "none.jsonl").write_text("")
    with pytest.raises(ValueError, match="parent_asin"):
        batch.ingest_all(spark, str(tmp_path / "a"), str(tmp_path / "r.jsonl"), str(tmp_path / "p.jsonl"))
    made = batch.ingest_all(spark, str(tmp_path / "b"), str(tmp_path / "none.jsonl"), str(tmp_path / "none.jsonl"))
    assert made["ratings"].count() == 0 and made["products"].count() == 0
    assert made["products"].columns == batch.ingest_all(
        spark, str(tmp_path / "c"), str(tmp_path / "r.jsonl"), str(tmp_path / "none.jsonl"))["products"].columns


def test_a_stamp_written_twice(spark, tmp_path):
    path = str(tmp_path / "s")
    for stamp, x in (("20260101_000000", "a"), ("20260102_000000", "b"), ("20260102_000000", "c")):
        snapshots.append_snapshot(spark.createDataFrame([(x,)], "x string"), path, stamp)
    assert [r[0] for r in snapshots.load_latest(spark, path).collect()] == ["c"]
    assert spark.read.parquet(path).count() == 2


def _rating(u, p, stamp, rating=4):
    return json.dumps({"user_id": u, "parent_asin": p, "rating": rating, "timestamp": stamp})


def test_stream_with_repeats_late_files_and_restarts(spark, tmp_path, rows, monkeypatch):
    """A file delivered twice, a late one and a batch that dies give the rows of the batch path."""
    folder, out, check, bad = (str(tmp_path / n) for n in ("in", "out", "check", "bad"))
    (tmp_path / "in").mkdir()

    def deliver(name, lines, old=False):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")
        if old:
            os.utime(tmp_path / "in" / name, (1_500_000_000, 1_500_000_000))

    def run():
        incremental.ingest_new_ratings(spark, folder, out, check, bad, max_files=1, repeats_within="7 days")

    first = [_rating("u1", "p1", 1588687728923), _rating("u2", "p1", 1588687728000), "{broken"]
    deliver("1.json", first)
    run()
    deliver("1 again.json", first)
    deliver("late.json", [_rating("u0", "p0", 1100000000000), _rating("u1", "p1", 1588687728923)], old=True)
    run()
    # The sides of a batch are written one after the other; dying between them leaves nothing doubled.
    deliver("3.json", [_rating("u3", "p3", 1599999999000), "null"])
    whole, calls = incremental.write_side, []

    def dies(df, path, number):
        calls.append(path)
        if path == bad:
            raise RuntimeError("lost")
        whole(df, path, number)

    monkeypatch.setattr(incremental, "write_side", dies)
    with pytest.raises(Exception, match="lost"):
        run()
    assert out in calls
    monkeypatch.setattr(incremental, "write_side", whole)
    run()
    run()
    got = rows(incremental.read_ingested(spark, out))
    assert got == [("u0", "p0", 4.0, 1100000000), ("u1", "p1", 4.0, 1588687728), ("u2", "p1", 4.0, 1588687728), ("u3", "p3", 4.0, 1599999999)]
    batch_path = ingest.parse_ratings(raw.read_rating_lines(spark, folder)[0]).distinct()
    assert rows(batch_path) == got
    assert sorted(r["line"] for r in spark.read.parquet(bad).collect()) == ["null", "{broken"]


@pytest.mark.parametrize("before", [{}, {"spark.sql.streaming.stateStore.providerClass": incremental.STATE["spark.sql.streaming.stateStore.providerClass"]}])
def test_digests_of_lines_are_state_on_disk(spark, tmp_path, rows, monkeypatch, before):
    """In a session with Spark's default store too, which is left as it was; a stream begun with another goes on."""
    name = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    was = spark.conf.get(name)
    spark.conf.set(name, heap)
    try:
        def run(n, check, lines):
            (tmp_path / "in").mkdir(exist_ok=True)
            (tmp_path / "in" / f"{n}.json").write_text("\n".join(lines) + "\n")
            incremental.ingest_new_ratings(spark, str(tmp_path / "in"), str(tmp_path / f"out {check}"), str(tmp_path / check),
                                           repeats_within="7 days")
            return rows(incremental.read_ingested(spark, str(tmp_path / f"out {check}")), "userId")

        line = [_rating("u1", "p1", 1588687728923)]
        state = incremental.STATE
        monkeypatch.setattr(incremental, "STATE", before)
        assert run(1, "old", line) == [("u1",)]
        monkeypatch.setattr(incremental, "STATE", state)
        assert run(2, "old", line + [_rating("u2", "p1", 1588687728923)]) == [("u1",), ("u2",)]
        assert run(3, "new", line) == [("u1",), ("u2",)]
        assert spark.conf.get(name) == heap
        left = [f for _, _, files in os.walk(tmp_path / "new" / "ratings" / "state") for f in files]
        assert any(f.endswith(".zip") for f in left) and not any(f.endswith(".delta") for f in left)
    finally:
        spark.conf.set(name, was)


def test_stream_judges_the_unit_by_file(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "ms.json").write_text("\n".join([_rating("a", "p", 1588687728923), _rating("b", "p", 86400000)]))
    (tmp_path / "in" / "s.json").write_text("\n".join([_rating("c", "p", 1588687728), _rating("d", "p", "2020-05-05T13:42:08Z")]))
    incremental.ingest_new_ratings(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert rows(incremental.read_ingested(spark, str(tmp_path / "out")), "userId", "timestamp") == [
        ("a", 1588687728), ("b", 86400), ("c", 1588687728), ("d", 1588686128)]
