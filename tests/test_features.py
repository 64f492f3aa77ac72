import hashlib
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from ratelake import schemas
from ratelake.operators import explore, features, store

R = "userId string, productId string, rating double, timestamp bigint"
P = "productId string, title string, price double, brand string, category string, description string"


@pytest.fixture
def tables(spark):
    ratings = spark.createDataFrame([
        ("u1", "a", 5.0, 86400 * 10), ("u1", "b", 3.0, 86400 * 11), ("u2", "a", 4.0, 86400 * 12 + 43200),
        ("u3", "z", 1.0, 5)], R)
    products = spark.createDataFrame([
        ("a", "A", 10.0, "x", "C1", ""), ("b", "B", 30.0, None, None, ""), ("q", "Q", 99.0, "x", "C1", "")], P)
    return ratings, products


def test_user_features(tables, rows):
    got = {r[0]: r[1:] for r in rows(features.user_features(*tables))}
    assert got["u1"] == (2, 4.0, 1.4142, 2, 1.5, 1)
    assert got["u2"] == (1, 4.0, 0.0, 1, 0.0, 1)
    assert got["u3"][5] == 0 and got["u3"][2] == 0.0


def test_item_features(tables, rows):
    df = features.item_features(*tables)
    assert df.columns == schemas.ITEM_FEATURES.names
    got = {r["productId"]: r for r in df.collect()}
    # z is not in the catalog: its price is the median of 10 and 30.
    assert (got["z"]["price"], got["z"]["category"], got["z"]["brand"]) == (20.0, "Unknown", "Unknown")
    assert [got[k]["category_encoded"] for k in "abz"] == [0, 1, 1]
    assert [got[k]["brand_encoded"] for k in "abz"] == [1, 0, 0]
    assert [got[k]["price_normalized"] for k in "abz"] == [0.0, 1.0, 0.5]


def test_constant_price_and_enriched_columns(spark, tables):
    ratings, products = tables
    same = products.selectExpr("productId", "title", "7.0D as price", "brand", "category", "description",
                               "cast(null as bigint) as rating_count", "1.23456D as avg_rating")
    got = {r["productId"]: r for r in features.item_features(ratings, same).collect()}
    assert {r["price_normalized"] for r in got.values()} == {0.0}
    assert (got["a"]["api_rating_count"], got["a"]["api_avg_rating"], got["z"]["api_avg_rating"]) == (0, 1.2346, 0.0)
    # One of the two enrichment columns alone counts as none.
    assert "api_rating_count" not in features.item_features(ratings, same.drop("avg_rating")).columns


def test_interaction_features(tables, rows):
    ratings, products = tables
    got = rows(features.interaction_features(ratings, features.item_features(ratings, products)))
    assert got[0] == ("u1", "a", 5.0, 864000, 1.0, 10, 0.5)
    assert got[3] == ("u3", "z", 1.0, 5, 0.0, 0, 0.0)


@pytest.mark.parametrize("top_n,keep", [(3, 3), (70, 4), (130, 2)])
def test_cooccurrence_against_brute_force(spark, rows, top_n, keep):
    import random
    random.seed(top_n)
    # u0 holds a third of all rows, with every pair repeated.
    data = [("u0", f"i{i % 140:03d}") for i in range(500)] + [
        (f"u{random.randint(1, 60)}", f"i{random.randint(0, 139):03d}") for _ in range(1000)]
    df = spark.createDataFrame([(u, i, 3.0, 1) for u, i in data] + [(None, "i000", 1.0, 1)], R).repartition(4)
    counts = Counter(i for _, i in data) + Counter({"i000": 1})
    top = set(sorted(counts, key=lambda i: (-counts[i], i))[:top_n])
    baskets = {}
    for u, i in data:
        if i in top:
            baskets.setdefault(u, set()).add(i)
    shared = Counter(p for b in baskets.values() for p in permutations(b, 2))
    want = []
    for a in top:
        others = sorted(((-n, b) for (x, b), n in shared.items() if x == a))[:keep]
        want += [(a, b, float(-n)) for n, b in others]
    assert rows(features.cooccurrence(df, top_n, keep)) == sorted(want)


def test_cooccurrence_without_shared_users(spark):
    df = spark.createDataFrame([("u1", "a", 1.0, 1), ("u2", "b", 1.0, 1)], R)
    assert features.cooccurrence(df).count() == 0


def test_lookup_rules(spark, rows):
    users = spark.createDataFrame([(f"u{i}",) for i in range(5)], "userId string")
    assert store.user_features_of(users, []).count() == 0
    assert store.user_features_of(users, ["u1", "nobody"], limit=1).count() == 1
    assert store.user_features_of(users, ["u1", "u2"], limit=1).count() == 2
    assert store.user_features_of(users, limit=0).count() == 5
    assert store.user_features_of(users, limit=3).count() == 3
    many = [f"u{i}" for i in range(3, 2000)]
    assert rows(store.user_features_of(users, many)) == [("u3",), ("u4",)]


def test_inference_for_unknown_user(spark, tables):
    ratings, products = tables
    users, items = features.user_features(ratings, products), features.item_features(ratings, products)
    assert store.inference_features(users, items, "nobody").count() == 0
    assert store.inference_features(users, items, "u1", ["a", "none"]).count() == 1
    assert store.inference_features(users, items, "u1").count() == 3


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.25, 0.5, 0.999])
def test_exact_sample(spark, fraction):
    df = spark.range(1000).repartition(4)
    first = store.exact_sample(df, fraction, ["id"], cells=16).collect()
    assert len(first) == len(set(first)) == round(fraction * 1000)
    assert sorted(first) == sorted(store.exact_sample(df.repartition(7), fraction, ["id"], cells=16).collect())
    assert fraction in (0.0, 0.001) or sorted(first) != sorted(store.exact_sample(df, fraction, ["id"], 43).collect())


def hash_order(rows, seed=42):
    return sorted(rows, key=lambda r: (int(hashlib.md5(f"{r[0]}|{seed}".encode()).hexdigest()[:15], 16), r[0]))


def test_exact_sample_hashes_each_row_once(spark):
    """The hashes are worked out in one scan that keeps little more than the sample; later steps read them."""
    df = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    found = store.exact_sample(df, 0.25, ["k"])
    assert "md5" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in hash_order(df.collect())[:5000])


@pytest.mark.parametrize("fraction", [0.0, 0.1, 0.5, 0.9, 0.9999])
def test_exact_sample_of_repeated_keys(spark, fraction):
    """A key that holds most rows moves the cut far from its share, or is cut itself."""
    rows = [("hot",)] * 6000 + [(str(i),) for i in range(3000)] + [("",), ("",)]
    df = spark.createDataFrame(rows, "k string")
    got = store.exact_sample(df, fraction, ["k"]).collect()
    assert Counter(r[0] for r in got) == Counter(r[0] for r in hash_order(rows)[:round(fraction * len(rows))])


def test_exact_sample_of_nothing(spark):
    none = spark.createDataFrame([], "k string, v double")
    assert store.exact_sample(none, 0.25, ["k"]).collect() == []
    one = spark.createDataFrame([(None, 1.0)], "k string, v double")
    assert store.exact_sample(one, 0.25, ["k"]).collect() == [] and store.exact_sample(one, 0.75, ["k"]).count() == 1


def test_describe_rejects_unknown_table():
    with pytest.raises(ValueError):
        store.describe_table({}, "nope")


def test_head_share_with_ties(spark):
    df = spark.createDataFrame([("u", f"p{i}") for i in range(20) for _ in range(3 if i < 5 else 1)],
                               "userId string, productId string")
    got = explore.head_share(df, 0.2).first().asDict()
    assert got == {"head_items": 4, "head_ratings": 12, "pct_of_ratings": 40.0}


def test_histogram_of_one_value(spark, rows):
    df = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert rows(explore.histogram(df, "x", 4)) == [(2, 3.0, 2)]
