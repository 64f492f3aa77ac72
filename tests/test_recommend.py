import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratelake.functions import kernels
from ratelake.operators import content, factors, ranking
from ratelake.session import stage

R = "userId string, productId string, rating double, timestamp bigint"
PRED = "userId string, productId string, rating double, prediction double"


def test_ranking_measures(spark):
    df = spark.createDataFrame([
        ("a", "1", 5.0, 4.0), ("a", "2", 1.0, 4.0), ("a", "3", 4.0, 3.0), ("b", "1", 2.0, 5.0)], PRED)
    # Equal predictions: the smaller id comes first.  User b has nothing relevant.
    assert ranking.precision_at_k(df, 2).first()[0] == round((1 / 2 + 0 / 2) / 2, 4)
    assert ranking.recall_at_k(df, 2).first()[0] == 0.5
    dcg = 31 + 1 / math.log2(3)
    idcg = 31 + 15 / math.log2(3)
    assert ranking.ndcg_at_k(df, 2).first()[0] == round((dcg / idcg + 1) / 2, 4)
    none = spark.createDataFrame([("a", "1", 0.0, 4.0)], PRED)
    assert ranking.recall_at_k(none).first()[0] == 0.0 and ranking.ndcg_at_k(none).first()[0] == 0.0


@pytest.fixture
def log(spark):
    rng = np.random.default_rng(3)
    data = {(f"u{rng.integers(40):02d}", f"p{rng.integers(60):02d}"): float(rng.integers(1, 6)) for _ in range(900)}
    ratings = spark.createDataFrame([(u, p, r, 1) for (u, p), r in data.items()] + [
        ("all", f"p{i:02d}", 3.0, 1) for i in range(60)], R)
    products = spark.createDataFrame([(f"p{i:02d}", f"title {i}", None if i % 2 else "C", 1.0, "b")
                                      for i in range(59)],
                                     "productId string, title string, category string, price double, brand string")
    return ratings, products


def brute_recommend(ratings, offsets, users, k, limit, dot=None):
    rows = ratings.collect()
    count = {}
    for r in rows:
        count[r["productId"]] = count.get(r["productId"], 0) + 1
    chosen = sorted(count, key=lambda p: (-count[p], p))[:limit]
    mu = offsets.mean.first()[0]
    bu = {r[0]: r[1] for r in offsets.users.collect()}
    bi = {r[0]: r[1] for r in offsets.items.collect()}
    out = []
    for u in users:
        seen = {r["productId"] for r in rows if r["userId"] == u}
        scored = []
        for p in chosen:
            if p not in seen:
                x = mu + bu.get(u, 0) + bi.get(p, 0) + (dot(u, p) if dot else 0)
                scored.append((-np.rint(min(max(x, 1), 5) * 1000) / 1000, p))
        out += [(u, i + 1, p, -s) for i, (s, p) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_recommend_by_offsets(spark, log, rows):
    ratings, products = log
    offsets = factors.fit_offsets(ratings)
    users = spark.createDataFrame([("u00",), ("u01",), ("new",), ("all",), ("u00",)], "userId string")
    got = factors.recommend(users, ratings, products, offsets, top_k=4, candidate_limit=30)
    assert rows(got, "userId", "rank", "productId", "predicted_rating") == brute_recommend(
        ratings, offsets, ["u00", "u01", "new", "all"], 4, 30)
    assert got.where("userId = 'all'").count() == 0
    assert got.where("title is null or category is null").count() == 0


def test_factors(spark, log, rows, tmp_path):
    from ratelake.sources import models
    ratings, products = log
    model = factors.fit_factors(ratings, rank=4, max_iter=3, keep=stage)
    pairs = ratings.select("userId", "productId", "rating")
    error = ranking.errors(factors.predict_factors(pairs, model)).first()["rmse"]
    base = ratings.select(F.stddev_pop("rating")).first()[0]
    assert error < base
    unknown = spark.createDataFrame([("new", "none")], "userId string, productId string")
    mean = model.offsets.mean.first()[0]
    assert abs(factors.predict_factors(unknown, model).first()["prediction"] - mean) < 1e-9

    user_f = {r[0]: np.array(r[1], dtype=float) for r in model.factors()[0].collect()}
    item_f = {r[0]: np.array(r[1], dtype=float) for r in model.factors()[1].collect()}
    users = ratings.select("userId").distinct()
    got = factors.recommend(users, ratings, products, model.offsets, model.factors(), 5, 40)
    names = sorted(r[0] for r in users.collect())
    assert rows(got, "userId", "rank", "productId", "predicted_rating") == brute_recommend(
        ratings, model.offsets, names, 5, 40, lambda u, p: float(user_f[u] @ item_f[p]))

    with pytest.raises(FileNotFoundError):
        models.load_factors(spark, str(tmp_path))
    models.save_factors(model, str(tmp_path))
    again = models.load_factors(spark, str(tmp_path))
    assert rows(factors.predict_factors(pairs, again)) == rows(factors.predict_factors(pairs, model))


def test_random_unrated(spark, log):
    ratings, _ = log
    users = spark.createDataFrame([("u00",), ("all",)], "userId string")
    got = factors.random_unrated(ratings, users, 10, 1)
    assert got.count() == 10 and got.where("userId = 'all'").count() == 0
    assert got.join(ratings, ["userId", "productId"], "left_semi").count() == 0
    other = factors.random_unrated(ratings, users, 10, 2)
    assert sorted(got.collect()) != sorted(other.collect())


def test_holdout_is_a_partition(log):
    ratings, _ = log
    train, test = factors.holdout_split(ratings)
    assert train.count() + test.count() == ratings.count() and 0 < test.count() < train.count()


# -- texts ------------------------------------------------------------------

def brute_tfidf(texts, stop, max_features, min_df):
    import re
    docs = {}
    for pid, text in texts:
        words = [w for w in re.findall(r"\w\w+", text.lower()) if w not in stop]
        docs[pid] = words + [a + " " + b for a, b in zip(words, words[1:])]
    df, total = {}, {}
    for grams in docs.values():
        for t in set(grams):
            df[t] = df.get(t, 0) + 1
        for t in grams:
            total[t] = total.get(t, 0) + 1
    kept = sorted((t for t in df if df[t] >= min_df), key=lambda t: (-total[t], t))[:max_features]
    place = {t: i for i, t in enumerate(sorted(kept))}
    out = {}
    for pid, grams in docs.items():
        v = np.zeros(len(place))
        for t in grams:
            if t in place:
                v[place[t]] += math.log((len(docs) + 1) / (df[t] + 1)) + 1
        if v.any():
            out[pid] = v / np.linalg.norm(v)
    return out


@pytest.fixture
def texts():
    rng = np.random.default_rng(5)
    words = "red blue large small old new ring gear bolt plate the and of Größe naïve x".split()
    texts = [(f"p{i:03d}", " ".join(rng.choice(words, rng.integers(1, 12)))) for i in range(150)]
    # A third of the items share one text; some hold only stop words.
    return texts + [(f"q{i:03d}", "red ring large") for i in range(80)] + [("s1", "the and of"), ("s2", "")]


@pytest.mark.parametrize("max_features", [5000, 20])
def test_tfidf_against_brute_force(spark, texts, max_features):
    df = spark.createDataFrame(texts, "productId string, profile string").repartition(5)
    want = brute_tfidf(texts, ("the", "and", "of"), max_features, 2)
    got = content.tfidf_vectors(df, ("the", "and", "of"), max_features).collect()
    assert {r["productId"] for r in got} == set(want)
    for r in got:
        v = np.zeros(len(want[r["productId"]]))
        v[r["terms"]] = r["weights"]
        assert np.allclose(v, want[r["productId"]])


@pytest.mark.parametrize("blocks", [{}, {"span": 20, "span_rows": 7}, {"span": 1}])
def test_similar_items_against_brute_force(spark, texts, rows, blocks):
    df = spark.createDataFrame(texts, "productId string, profile string")
    vectors = stage(content.tfidf_vectors(df), "vectors")
    data = {r["productId"]: dict(zip(r["terms"], r["weights"])) for r in vectors.collect()}
    want = []
    for a, x in data.items():
        near = []
        for b, y in data.items():
            s = np.rint(sum(w * y[t] for t, w in x.items() if t in y) * 1e6) / 1e6
            if a != b and s > 0.01:
                near.append((-s, b))
        want += [(a, b, -s, i + 1) for i, (s, b) in enumerate(sorted(near)[:7])]
    assert rows(content.similar_items(vectors, top_k=7, **blocks)) == sorted(want)


def themed(n, themes, seed=3):
    """Sparse unit vectors of items that share the terms of their theme and a few terms with all."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        theme = int(rng.integers(themes))
        terms = np.unique(np.concatenate([10 + theme * 30 + rng.choice(30, 8, replace=False), rng.choice(10, 2)]))
        weights = np.where(terms < 10, 0.3, rng.uniform(1, 3, len(terms)))
        out.append((f"p{i:06d}", [int(t) for t in terms], [float(w) for w in weights / np.sqrt((weights ** 2).sum())]))
    return out


def work_of(spark, n, span):
    """Pairs scored, pairs of a row and a span searched, and the rows found."""
    vectors = stage(spark.createDataFrame(themed(n, n // 40), content.VECTOR), "vectors")
    found, _ = content.neighbour_search(vectors, 5, span=span)
    return found.agg({"scored": "sum"}).first()[0], content.similar_items(vectors, 5, span=span)


def test_few_pairs_are_scored(spark):
    """Most pairs are never scored, and the scored ones grow with the items, not with their square."""
    small, _ = work_of(spark, 1000, 100)
    large, found = work_of(spark, 4000, 100)
    assert small < 0.1 * 1000 ** 2 and large < 0.03 * 4000 ** 2
    assert large / small < 4 ** 1.5, (small, large)
    data = {i: dict(zip(t, w)) for i, t, w in themed(4000, 100)}
    got = {}
    for r in found.collect():
        got.setdefault(r.productId, []).append((r.rank, r.other_productId, r.similarity))
    for item in list(data)[::400]:
        near = sorted((-float(np.rint(sum(w * y[t] for t, w in data[item].items() if t in y) * 1e6) / 1e6), b)
                      for b, y in data.items() if b != item)
        assert sorted(got[item]) == [(k + 1, b, -s) for k, (s, b) in enumerate(near[:5])]


def test_spans_out_of_reach_are_not_searched(spark):
    rows = themed(3000, 60)
    vectors = stage(spark.createDataFrame(rows, content.VECTOR), "vectors")
    made, kept = {}, content.stage
    try:
        content.stage = lambda df, name: made.setdefault(name, kept(df, name))
        content.similar_items(vectors, 5, span=100).count()
    finally:
        content.stage = kept
    spans = made["items"].select("span").distinct().count()
    assert spans >= 30 and made["copies"].count() < 0.25 * 3000 * spans


def test_a_row_in_reach_of_all_spans_is_given_once_and_in_batches():
    n, spans, k = 4000, 60, 5
    rng = np.random.default_rng(6)

    def lists(values, length):
        return pa.ListArray.from_arrays(pa.array(np.arange(len(values) // length + 1, dtype=np.int32) * length), pa.array(values))

    terms = np.sort(np.argsort(rng.random((n, 20)), axis=1)[:, :k], axis=1).astype(np.int32)
    own, floors = rng.integers(0, spans, n), np.where(np.arange(n) % 100, 0.1, 9.0)
    rows = pa.table({"is_zone": [False] * n, "span": own, "productId": [str(i) for i in range(n)], "terms": lists(terms.ravel(), k),
                     "weights": lists(np.full(n * k, 0.4), k), "floor": floors})
    zones = pa.table({"is_zone": [True] * spans, "span": np.arange(spans), "productId": pa.array([None] * spans, pa.string()),
                      "terms": lists(np.tile(np.arange(20, dtype=np.int32), spans), 20),
                      "weights": lists(np.ones(20 * spans), 20), "floor": np.zeros(spans)})
    found = list(kernels.spans_in_reach()(iter(pa.concat_tables([rows, zones]).to_batches(max_chunksize=500))))
    assert len(found) > 5 and max(batch.nbytes for batch in found) < pa.concat_tables([rows, zones]).nbytes
    got = {r["productId"]: r for batch in found for r in batch.to_pylist()}
    assert sum(batch.num_rows for batch in found) == len(got) == n - n // 100
    for i in range(1, n, 37):
        if i % 100:
            r = got[str(i)]
            assert sorted(r["spans"]) == [z for z in range(spans) if z != own[i]]
            assert r["terms"] == terms[i].tolist() and r["floor"] == floors[i]


def test_equal_vectors_are_one_item_of_a_span(spark):
    """Copies are not searched one by one, ids of vectors that tie mix in the result, and little more than the best is scored."""
    root = 0.5 ** 0.5
    kinds = [([0], [1.0])] + [([0, t], [root, root]) for t in range(1, 40)]
    rows = [(f"i{n:04d}", *kinds[n * 7 % 40]) for n in range(1200)]
    vectors = stage(spark.createDataFrame(rows, content.VECTOR), "vectors")
    made, kept = {}, content.stage
    try:
        content.stage = lambda df, name: made.setdefault(name, kept(df, name))
        found = content.similar_items(vectors, 35).collect()
        scored = content.neighbour_search(vectors, 2)[0].agg({"scored": "sum"}).first()[0]
    finally:
        content.stage = kept
    assert made["items"].count() == 40 and scored <= 40 * 40
    data = {i: dict(zip(t, w)) for i, t, w in rows}
    for item in ("i0000", "i0001", "i0040", "i1199"):
        near = sorted((-float(np.rint(sum(w * y[t] for t, w in data[item].items() if t in y) * 1e6) / 1e6), b)
                      for b, y in data.items() if b != item)
        got = sorted((r.rank, r.other_productId, r.similarity) for r in found if r.productId == item)
        assert got == [(k + 1, b, -s) for k, (s, b) in enumerate(near[:35])]


def test_similar_items_of_nothing(spark):
    none = spark.createDataFrame([], content.VECTOR)
    assert content.similar_items(none).count() == 0
    one = spark.createDataFrame([("a", [3], [1.0])], content.VECTOR)
    assert content.similar_items(one).count() == 0


def test_similar_to_unknown_item(spark, texts):
    df = spark.createDataFrame(texts, "productId string, profile string")
    near = content.similar_items(content.tfidf_vectors(df), top_k=5)
    products = spark.createDataFrame([("q000", None, None, 1.0)],
                                     "productId string, title string, category string, price double")
    assert content.similar_to(near, products, "none").count() == 0
    top = content.similar_to(near, products, "q001").collect()
    assert [r["rank"] for r in sorted(top)] == [1, 2, 3, 4, 5]
    first = [r for r in top if r["productId"] == "q000"][0]
    assert (first["title"], first["similarity_score"]) == ("Unknown", 1.0)


def test_default_stop_words_are_part_of_the_spark_list(spark):
    from pyspark.ml.feature import StopWordsRemover
    from ratelake.functions.text import ENGLISH_STOP_WORDS
    spark_words = set(StopWordsRemover.loadDefaultStopWords("english"))
    assert set(ENGLISH_STOP_WORDS) == {w for w in spark_words if "'" not in w}


def test_offsets_of_a_fold_know_nothing_of_its_held_out_rows(spark):
    """Users whose only rating is held out are scored by what the other folds hold, so no error hides."""
    rows = [(f"u{i}", f"p{i}", 1.0 + 4.0 * (i % 2), 0) for i in range(30)]
    ratings = spark.createDataFrame(rows, "userId string, productId string, rating double, timestamp long")
    fold = {r["userId"]: r["f"] for r in ratings.select("userId", factors.fold_of(3).alias("f")).collect()}
    value = {u: r for u, _, r, _ in rows}
    want = []
    for f in range(3):
        train = [value[u] for u in value if fold[u] != f]
        held = [value[u] for u in value if fold[u] == f]
        mean = sum(train) / len(train)
        want.append((sum((v - mean) ** 2 for v in held) / len(held)) ** 0.5)
    best, scores = factors.search_factors(ratings, {"rank": (2,), "maxIter": (2,), "regParam": (0.1,)})
    assert scores.first()["cv_rmse"] == pytest.approx(sum(want) / 3)
    assert best == {"rank": 2.0, "maxIter": 2.0, "regParam": 0.1}
