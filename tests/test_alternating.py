"""The alternating solver against numpy."""

import hashlib
import itertools
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratelake import session
from ratelake.functions import solving
from ratelake.operators import alternating, factors, ranking
from ratelake.plans import tables as T
from ratelake.plans.queries import QUERIES
from ratelake.session import stage

FOLDER = "/root/testdata/sf0.001"
RESIDUAL = "user string, item string, residual double"


def plain_start(item, rank, seed=42):
    return np.array([int(hashlib.md5(f"{item}|{k}|{seed}".encode()).hexdigest()[:15], 16) / 16 ** 15 - 0.5
                     for k in range(rank)]) / np.sqrt(rank)


def plain_solve(rows, rank, reg, rounds, name=str):
    """Vectors by user and by item after each round; ``name`` gives the text an item's start is drawn from."""
    by_user, by_item = {}, {}
    for u, i, e in rows:
        by_user.setdefault(u, []).append((i, e))
        by_item.setdefault(i, []).append((u, e))
    items = {i: plain_start(name(i), rank) for i in by_item}

    def solve(groups, vectors):
        out = {}
        for key, seen in groups.items():
            m = np.array([vectors[k] for k, _ in seen])
            e = np.array([v for _, v in seen])
            out[key] = np.linalg.solve(m.T @ m + reg * len(seen) * np.eye(rank), m.T @ e)
        return out

    for _ in range(rounds):
        users = solve(by_user, items)
        items = solve(by_item, users)
        yield users, items


def plain_fit(ratings, rank, reg, rounds, name=str):
    """Offsets and vectors of ``{(user, item): rating}``, one model after each round."""
    mean = sum(ratings.values()) / len(ratings)

    def means(values):
        groups = {}
        for key, v in values:
            groups.setdefault(key, []).append(v)
        return {k: np.rint((sum(v) / len(v) - mean) * 1e9) / 1e9 for k, v in groups.items()}

    bi = means((i, r) for (_, i), r in ratings.items())
    bu = means((u, r - bi[i]) for (u, i), r in ratings.items())
    rows = [(u, i, r - mean - bu[u] - bi[i]) for (u, i), r in ratings.items()]
    for users, items in plain_solve(rows, rank, reg, rounds, name):
        zero = np.zeros(rank)
        yield lambda u, i, users=users, items=items: min(max(
            mean + bu.get(u, 0) + bi.get(i, 0) + users.get(u, zero) @ items.get(i, zero), 1), 5)


def vectors(df):
    return {r["key"]: np.array(r["vector"]) for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    # One user and one item hold a third of all rows; pairs repeat.
    rows = [(f"u{rng.integers(30)}", f"i{rng.integers(50)}", float(rng.normal())) for _ in range(600)]
    rows += [("hot", f"i{rng.integers(50)}", float(rng.normal())) for _ in range(150)]
    return rows + [(f"w{n}", "heat", float(rng.normal())) for n in range(300)]


@pytest.mark.parametrize("block_rows", [None, 100, 8])
def test_same_as_numpy(spark, data, block_rows):
    """Whole blocks, keys spread over blocks, and blocks of one row give the same factors."""
    fits = [(1, 0.5), (3, 0.1), (5, 0.02)]
    odd = [(None, "i1", 1.0), ("u1", None, 1.0), ("u1", "i1", None)]
    found = alternating.alternate(spark.createDataFrame(data + odd, RESIDUAL), fits, [2, 4], block_rows=block_rows)
    assert sorted(found) == [2, 4]
    start = 0
    for rank, reg in fits:
        plain = list(plain_solve(data, rank, reg, 4))
        for number in (2, 4):
            for got, want in zip(found[number], plain[number - 1]):
                got = vectors(got)
                assert set(got) == set(want)
                for key, vector in want.items():
                    assert got[key][start:start + rank] == pytest.approx(vector, abs=1e-8)
        start += rank


def test_blocks_are_bounded(spark, data):
    pairs = alternating.pair_sums(spark.createDataFrame(data, RESIDUAL)).cache()
    dealt = alternating.dealt(pairs, "item", "user", pairs.count(), 160).cache()
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert max(sizes) < 3 * 160 and sum(sizes) == pairs.count()
    blocks = dealt.groupBy("own").agg(F.count_distinct("block").alias("n"), F.max("split").alias("split"))
    assert {r["own"] for r in blocks.where("split").collect()} >= {"heat"}
    assert blocks.where("not split").agg(F.max("n")).first()[0] == 1
    pairs.unpersist()
    dealt.unpersist()


def test_loss_falls_each_round(spark, data):
    table = spark.createDataFrame(data, RESIDUAL)
    found = alternating.alternate(table, [(3, 0.1)], range(1, 6), block_rows=200)
    losses = [alternating.objective(table, *found[n], 0.1).first()["loss"] for n in range(1, 6)]
    assert all(a > b for a, b in zip(losses, losses[1:]))
    users, items = map(vectors, found[5])
    want = sum((e - users[u] @ items[i]) ** 2 + 0.1 * (users[u] @ users[u] + items[i] @ items[i]) for u, i, e in data)
    assert losses[-1] == pytest.approx(want)


def test_empty_and_wrong_input(spark):
    none = spark.createDataFrame([], RESIDUAL)
    users, items = alternating.alternate(none, [(2, 0.1)], [1])[1]
    assert users.count() == items.count() == 0
    with pytest.raises(ValueError):
        alternating.alternate(none, [(2, 0.0)], [1])
    with pytest.raises(ValueError):
        factors.search_factors(none, {"depth": (1,)})


def cleaned(spark):
    return {(r["userId"], r["productId"]): r["rating"] for r in T.cleaned_ratings(spark, FOLDER).collect()}


def test_registered_predictions(spark):
    ratings = cleaned(spark)
    *_, predict = plain_fit(ratings, 20, 0.1, 15)
    got = QUERIES["factor_predictions"](spark, FOLDER).collect()
    assert len(got) == len(ratings)
    for r in got:
        assert r["prediction"] == pytest.approx(predict(r["userId"], r["productId"]), abs=0.0005001)


def test_registered_recommendations(spark):
    ratings = cleaned(spark)
    *_, predict = plain_fit(ratings, 20, 0.1, 15)
    count = {}
    for _, i in ratings:
        count[i] = count.get(i, 0) + 1
    chosen = sorted(count, key=lambda i: (-count[i], i))[:500]
    got = {(r["userId"], r["rank"]): r["predicted_rating"] for r in
           QUERIES["recommendations_by_factors"](spark, FOLDER).collect()}
    want = {}
    for u in {u for u, _ in ratings}:
        best = sorted((-predict(u, i) for i in chosen if (u, i) not in ratings))[:10]
        want |= {(u, n + 1): -s for n, s in enumerate(best)}
    assert set(got) == set(want)
    for key, value in want.items():
        assert got[key] == pytest.approx(value, abs=0.0005001)


def test_registered_holdout(spark):
    train, test = factors.holdout_split(T.cleaned_ratings(spark, FOLDER))
    *_, predict = plain_fit({(r["userId"], r["productId"]): r["rating"] for r in train.collect()}, 20, 0.1, 15)
    scored = spark.createDataFrame([(r["userId"], r["productId"], r["rating"], float(predict(r["userId"], r["productId"])))
                                    for r in test.collect()],
                                   "userId string, productId string, rating double, prediction double")
    want = {}
    for measure in (ranking.errors, ranking.precision_at_k, ranking.recall_at_k, ranking.ndcg_at_k):
        want |= measure(scored).first().asDict()
    assert QUERIES["factor_holdout_measures"](spark, FOLDER).first().asDict() == pytest.approx(want, abs=1e-4)


def test_grid_search(spark):
    """All folds and settings in one run give what each would give alone."""
    table = T.cleaned_ratings(spark, FOLDER).withColumn("fold", factors.fold_of(3))
    rows = [(r["fold"], r["userId"], r["productId"], r["rating"]) for r in table.collect()]
    grid = {"rank": (2, 5), "maxIter": (1, 3), "regParam": (0.02, 0.1)}
    want = {}
    for rank, reg in itertools.product(grid["rank"], grid["regParam"]):
        errors = {1: [], 3: []}
        for fold in range(3):
            train = {(u, i): r for f, u, i, r in rows if f != fold}
            models = list(plain_fit(train, rank, reg, 3, lambda i, fold=fold: f"{fold}:{i}"))
            for number, found in errors.items():
                predict = models[number - 1]
                found.append(np.sqrt(np.mean([(r - predict(u, i)) ** 2 for f, u, i, r in rows if f == fold])))
        for number, found in errors.items():
            want[rank, number, reg] = np.mean(found)
    best, scores = factors.search_factors(T.cleaned_ratings(spark, FOLDER), grid, keep=stage)
    got = {(r["params"]["rank"], r["params"]["maxIter"], r["params"]["regParam"]): r["cv_rmse"] for r in scores.collect()}
    assert got == pytest.approx(want)
    assert (best["rank"], best["maxIter"], best["regParam"]) == min(want, key=want.get)


def test_superseded_rounds_leave_no_files(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    found = alternating.alternate(spark.createDataFrame(data, RESIDUAL), [(2, 0.1)], [4])[4]
    assert len(os.listdir(tmp_path / "ratelake")) == 2
    session.drop_staged(spark.range(3))  # no staged table: nothing happens
    assert all(table.count() for table in found)


def test_keys_with_few_ratings_are_solved_together(monkeypatch):
    rng, rank, reg = np.random.default_rng(3), 8, 0.1
    pairs = sorted({(int(k), int(o)) for k, o in zip(rng.integers(0, 2000, 6000), rng.integers(0, 500, 6000))})
    own, other = zip(*pairs)
    weight, total = rng.integers(1, 4, len(pairs)).astype(float), rng.normal(size=len(pairs))
    block = solving.pack()(pa.table({
        "block": [0] * len(pairs), "own": [f"{k:05d}" for k in own], "other": [f"{o:05d}" for o in other],
        "split": [False] * len(pairs), "weight": weight, "total": total}))
    names = sorted({f"{o:05d}" for o in other})
    vectors = rng.normal(size=(len(names), rank))
    sent = pa.table({"key": names, "vector": [list(v) for v in vectors]})
    calls, solve = [], np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda a, b: calls.append(len(a)) or solve(a, b))
    found = solving.block_step([(rank, reg)])(block, sent)
    # One call for each number of ratings, and one for the keys with as many as the rank.
    assert len(calls) <= rank and len(found) == len(set(own))
    got = dict(zip(found["key"].to_pylist(), found["vector"].to_pylist()))
    at = {name: i for i, name in enumerate(names)}
    for key in list(sorted(set(own)))[::50]:
        rows = [i for i, k in enumerate(own) if k == key]
        seen = vectors[[at[f"{other[i]:05d}"] for i in rows]]
        gram = seen.T @ (seen * weight[rows][:, None]) + reg * weight[rows].sum() * np.eye(rank)
        np.testing.assert_allclose(got[f"{key:05d}"], solve(gram, total[rows] @ seen), rtol=1e-8, atol=1e-10)


def test_vectors_travel_packed_by_block(spark, data, monkeypatch):
    """A half round sends one row for each pair of blocks; vectors of spread keys come from blocks of their own."""
    monkeypatch.setattr(alternating, "CUT_KEYS", 3)
    fits = [(2, 0.1), (3, 0.5)]
    pairs = stage(alternating.pair_sums(spark.createDataFrame(data, RESIDUAL)))
    n = pairs.count()
    users, items = alternating.Side(pairs, "user", "item", n, 60, fits), alternating.Side(pairs, "item", "user", n, 60, fits)
    users.route(items)
    items.route(users)
    assert users.n_hot > 3 and items.n_hot > 3
    start = stage(items.starts(42))
    for packed, side, other in ((start, items, users), (users.solve(start)[0], users, items)):
        blocks = {r["block"] for r in packed.collect()}
        assert max(blocks) > side.n_blocks  # more than one block of spread keys
        sent = packed.mapInArrow(solving.messages(5), "target long, at binary, vectors binary").collect()
        assert len(sent) <= len(blocks) * other.n_blocks < n
        # Each block gets a vector for each of its keys, once.
        places = {}
        for r in sent:
            places.setdefault(r["target"], []).extend(np.frombuffer(r["at"], np.int32).tolist())
            assert len(r["vectors"]) == len(r["at"]) // 4 * 5 * 8
        wanted = {r["block"]: r["n_other"] for r in other.packed.select("block", "n_other").collect()}
        assert {b: sorted(at) for b, at in places.items()} == {b: list(range(k)) for b, k in wanted.items()}
    found = alternating.alternate(spark.createDataFrame(data, RESIDUAL), fits, [3], block_rows=60)[3]
    for (rank, reg), first in zip(fits, (0, 2)):
        *_, plain = plain_solve(data, rank, reg, 3)
        for got, want in zip(map(vectors, found), plain):
            assert set(got) == set(want)
            for key, vector in want.items():
                assert got[key][first:first + rank] == pytest.approx(vector, abs=1e-8)


def test_messages_are_cut_by_cells(monkeypatch):
    monkeypatch.setattr(solving, "_SOLVE_CELLS", 12)
    matrix, rng = np.arange(40.0).reshape(10, 4), np.random.default_rng(5)
    takes = [rng.integers(0, 10, k).astype(np.int32) for k in (1, 2, 7, 1, 1, 1)]
    packed = pa.table({"block": [0], "vectors": [matrix.tobytes()], "targets": [[10, 11, 12, 13, 14, 15]],
                       "sizes": [[len(t) for t in takes]], "take": [np.concatenate(takes).tobytes()],
                       "at": [np.arange(13, dtype=np.int32).tobytes()]}, schema=solving.PACKED)
    sent = list(solving.messages(4)(packed.to_batches()))
    assert len(sent) > 2
    rows = [r for batch in sent for r in batch.to_pylist()]
    assert [r["target"] for r in rows] == [10, 11, 12, 13, 14, 15]
    first = 0
    for r, take in zip(rows, takes):
        assert np.frombuffer(r["at"], np.int32).tolist() == list(range(first, first + len(take)))
        assert np.array_equal(np.frombuffer(r["vectors"]).reshape(-1, 4), matrix[take])
        first += len(take)
