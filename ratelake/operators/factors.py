"""Rating prediction: global mean, user and item offsets, and latent factors.

An estimate is ``mean + user offset + item offset + user factors . item factors``,
clipped to the rating scale; whatever is unknown of a user or item drops out.
"""

import itertools
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ratelake.functions import kernels, scalar as S
from ratelake.operators import alternating
from ratelake.session import bounded

# Candidates of ``recommend`` go to every task, sample users travel in the plan; beyond these bounds both refuse.
MOST_CANDIDATES = 20_000
MOST_SAMPLE_USERS = 1_000

# The parameter grid that is searched by default.
DEFAULT_GRID = {"rank": (20, 50, 100), "maxIter": (15, 20), "regParam": (0.02, 0.1)}
# What a grid does not name.
SETTING = {"rank": 20, "maxIter": 15, "regParam": 0.1}


def holdout_split(ratings: DataFrame, share: float = 0.2, seed: int = 42) -> tuple:
    """Train and test rows by a seeded hash of the pair, the same on every run."""
    test = S.holdout_bucket(["userId", "productId"], seed) < int(share * 10000)
    return ratings.where(~test), ratings.where(test)


@dataclass
class Offsets:
    """Global mean (one row), ``userId, user_offset`` and ``productId, item_offset``."""

    mean: DataFrame
    users: DataFrame
    items: DataFrame


def fit_offsets(ratings: DataFrame) -> Offsets:
    """Item offset: mean of ``rating - mean``.  User offset: mean of what is left after that."""
    mean = ratings.select(F.avg("rating").alias("mean"))
    items = ratings.groupBy("productId").agg(F.avg("rating").alias("m")).select(
        "productId", S.half_even(F.col("m") - mean.scalar(), 9).alias("item_offset"))
    users = (ratings.join(items, "productId").groupBy("userId")
             .agg(F.avg(F.col("rating") - F.col("item_offset")).alias("m"))
             .select("userId", S.half_even(F.col("m") - mean.scalar(), 9).alias("user_offset")))
    return Offsets(mean, users, items)


def clip_estimate(c):
    return S.clip(c, S.RATING_MIN, S.RATING_MAX)


def predict_base(pairs: DataFrame, offsets: Offsets) -> DataFrame:
    """``base``: mean and what offsets are known, not clipped."""
    known = pairs.join(offsets.users, "userId", "left").join(offsets.items, "productId", "left")
    return known.select(*pairs.columns, (offsets.mean.scalar() + F.coalesce("user_offset", F.lit(0.0))
                                         + F.coalesce("item_offset", F.lit(0.0))).alias("base"))


def predict_offsets(pairs: DataFrame, offsets: Offsets, digits: int = 6) -> DataFrame:
    """``prediction`` from mean and offsets only."""
    known = pairs.join(offsets.users, "userId", "left").join(offsets.items, "productId", "left")
    estimate = (offsets.mean.scalar() + F.coalesce("user_offset", F.lit(0.0))
                + F.coalesce("item_offset", F.lit(0.0)))
    return known.select(*pairs.columns, S.half_even(clip_estimate(estimate), digits).alias("prediction"))


# -- latent factors ---------------------------------------------------------

@dataclass
class FactorModel:
    """Offsets, and factors of the residuals: ``userId, user_factors`` and ``productId, item_factors``."""

    offsets: Offsets
    users: DataFrame
    items: DataFrame

    def factors(self) -> tuple:
        return self.users, self.items


def residuals(ratings: DataFrame, offsets: Offsets) -> DataFrame:
    """``user, item, residual``: what the offsets leave of each rating."""
    return (ratings.join(offsets.users, "userId").join(offsets.items, "productId").select(
        F.col("userId").alias("user"), F.col("productId").alias("item"),
        (F.col("rating") - offsets.mean.scalar() - F.col("user_offset") - F.col("item_offset")).alias("residual")))


def _kept(offsets: Offsets, keep) -> Offsets:
    return Offsets(keep(offsets.mean, "mean"), keep(offsets.users, "user_offsets"), keep(offsets.items, "item_offsets"))


def fit_factors(ratings: DataFrame, rank: int = 20, max_iter: int = 15, reg: float = 0.1,
                seed: int = 42, keep=lambda df, name: df) -> FactorModel:
    """Offsets by grouping, then alternating least squares on the residuals.

    ``keep`` stages the offsets, which the scoring reads again.
    """
    offsets = _kept(fit_offsets(ratings), keep)
    users, items = alternating.alternate(residuals(ratings, offsets), [(rank, reg)], [max_iter], seed)[max_iter]
    return FactorModel(offsets, users.select(F.col("key").alias("userId"), F.col("vector").alias("user_factors")),
                       items.select(F.col("key").alias("productId"), F.col("vector").alias("item_factors")))


def fold_of(folds: int, seed: int = 42):
    """The fold of a rating, from a hash of its user and item: the same on every run."""
    return F.pmod(F.xxhash64("userId", "productId", F.lit(seed)), F.lit(folds))


def search_factors(ratings: DataFrame, grid: dict | None = None, folds: int = 3, seed: int = 42,
                   keep=lambda df, name: df) -> tuple:
    """Grid search by cross-validated RMSE: best settings, and all results as rows.

    Each fold has offsets and factors of its own, fitted on the other folds only.  Held-out rows with
    a user or item that those do not hold are scored by what offsets there are.

    All folds and settings share the rounds of one solver run: keys carry their fold, vectors hold the fits of all ranks
    and regularisations, and settings that differ in rounds only are the same fit seen after each of them.
    """
    grid = grid or DEFAULT_GRID
    if set(grid) - set(SETTING):
        raise ValueError(f"a grid has the settings {', '.join(SETTING)}")
    settings = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    full = [{**SETTING, **setting} for setting in settings]
    fits = sorted({(s["rank"], s["regParam"]) for s in full})
    rounds = sorted({s["maxIter"] for s in full})
    dealt = keep(ratings.withColumn("_fold", fold_of(folds, seed)), "folds")

    def keyed(fold, name):
        return F.concat(F.lit(f"{fold}:"), F.col(name))

    tables, tests = [], []
    for fold in range(folds):
        train = dealt.where(F.col("_fold") != fold).drop("_fold")
        test = dealt.where(F.col("_fold") == fold).drop("_fold")
        if not train.take(1) or not test.take(1):
            continue
        offsets = _kept(fit_offsets(train), keep)
        tables.append(residuals(train, offsets).select(
            keyed(fold, "user").alias("user"), keyed(fold, "item").alias("item"), "residual"))
        tests.append(predict_base(test, offsets).select(F.lit(fold).alias("fold"), keyed(fold, "userId").alias("user"),
                                                        keyed(fold, "productId").alias("item"), "rating", "base"))
    spark = ratings.sparkSession
    schema = "params map<string,double>, cv_rmse double"
    if not tables:
        return {}, spark.createDataFrame([], schema)
    found = alternating.alternate(reduce(DataFrame.unionByName, tables), fits, rounds, seed)
    tests = keep(reduce(DataFrame.unionByName, tests), "held_out")
    errors = {number: _errors(tests, *found[number], fits) for number in rounds}
    rows = [({k: float(v) for k, v in setting.items()}, errors[s["maxIter"]][fits.index((s["rank"], s["regParam"]))])
            for setting, s in zip(settings, full)]
    return min(rows, key=lambda r: r[1])[0], spark.createDataFrame(rows, schema)


def _errors(tests: DataFrame, users: DataFrame, items: DataFrame, fits: list) -> list:
    """The RMSE of each fit, averaged over the folds, from one pass over the held-out rows."""
    scored = (tests.join(users.select(F.col("key").alias("user"), F.col("vector").alias("u")), "user", "left")
              .join(items.select(F.col("key").alias("item"), F.col("vector").alias("v")), "item", "left"))
    columns, start = [], 1
    for n, (rank, _) in enumerate(fits):
        miss = F.col("rating") - clip_estimate(
            F.col("base") + dot(F.slice("u", start, rank), F.slice("v", start, rank)))
        columns.append(F.sqrt(F.avg(miss * miss)).alias(f"e{n}"))
        start += rank
    by_fold = scored.groupBy("fold").agg(*columns).orderBy("fold").collect()
    return [sum(row[f"e{n}"] for row in by_fold) / len(by_fold) for n in range(len(fits))]


def dot(a, b):
    """Inner product of two arrays of equal length; 0 when either is missing."""
    return F.coalesce(F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0),
                                  lambda s, x: s + x), F.lit(0.0))


def predict_factors(pairs: DataFrame, model: FactorModel) -> DataFrame:
    return predict_with(pairs, model.offsets, *model.factors())


def predict_with(pairs: DataFrame, offsets: Offsets, users: DataFrame, items: DataFrame) -> DataFrame:
    """``prediction`` from offsets, ``userId, user_factors`` and ``productId, item_factors``."""
    # Everything known of a key is joined first, so that the pairs move once per key.
    users, items = offsets.users.join(users, "userId", "full"), offsets.items.join(items, "productId", "full")
    known = pairs.join(users, "userId", "left").join(items, "productId", "left")
    estimate = (offsets.mean.scalar() + F.coalesce("user_offset", F.lit(0.0))
                + F.coalesce("item_offset", F.lit(0.0)) + dot(F.col("user_factors"), F.col("item_factors")))
    return known.select(*pairs.columns, clip_estimate(estimate).alias("prediction"))


# -- top-K for many users ---------------------------------------------------

def candidate_items(ratings: DataFrame, limit: int = 500) -> DataFrame:
    return (ratings.where(F.col("productId").isNotNull()).groupBy("productId")
            .agg(F.count(F.lit(1)).alias("n_ratings"))
            .orderBy(F.desc("n_ratings"), "productId").limit(limit).select("productId"))


def recommend(users: DataFrame, ratings: DataFrame, products: DataFrame, offsets: Offsets,
              factors: tuple | None = None, top_k: int = 10, candidate_limit: int = 500) -> DataFrame:
    """Top ``top_k`` unrated popular items for every user in ``users``, in one job.

    The candidates (at most ``candidate_limit`` rows) go to the tasks as arrays;
    a task multiplies blocks of users with them and keeps the best of each row.
    So no user x item table exists: only users and their rated candidates are
    shuffled, and only ``top_k`` rows per user come out.
    """
    if candidate_limit > MOST_CANDIDATES:
        raise ValueError(f"candidate_limit is at most {MOST_CANDIDATES}")
    # Bounded by candidate_limit, a parameter of the operator; numbered in id order for ties.
    chosen = bounded(candidate_items(ratings, candidate_limit).select(
        "productId", (F.row_number().over(Window.orderBy("productId")) - 1).alias("position")), candidate_limit)
    scored = chosen.join(offsets.items, "productId", "left")
    table = users.select("userId").distinct().join(offsets.users, "userId", "left")
    if factors is not None:
        scored = scored.join(factors[1], "productId", "left")
        table = table.join(factors[0], "userId", "left")
    else:
        scored = scored.withColumn("item_factors", F.lit(None).cast("array<double>"))
        table = table.withColumn("user_factors", F.lit(None).cast("array<double>"))
    candidates = scored.select("productId", F.coalesce("item_offset", F.lit(0.0)), "item_factors",
                               "position").orderBy("position").collect()
    seen = (ratings.select("userId", "productId").join(chosen, "productId")
            .groupBy("userId").agg(F.collect_set("position").alias("seen")))
    # A user row is small but costs a scan of all candidates: split by cores, not by bytes.
    parts = 4 * users.sparkSession.sparkContext.defaultParallelism
    table = (table.join(seen, "userId", "left").repartition(parts, "userId")
             .select("userId", (offsets.mean.scalar() + F.coalesce("user_offset", F.lit(0.0))).alias("base"),
                     "user_factors", F.coalesce("seen", F.array().cast("array<int>")).alias("seen")))
    score = kernels.top_candidates([c[0] for c in candidates], [c[1] for c in candidates],
                                   [c[2] for c in candidates], top_k, S.RATING_MIN, S.RATING_MAX)
    ranked = table.mapInArrow(score, "userId string, rank int, productId string, predicted_rating double")
    return with_metadata(ranked, products, "price", "brand")


def with_metadata(ranked: DataFrame, products: DataFrame, *extra) -> DataFrame:
    """Add title (50 characters), category (40) and further columns after the top-K cut."""
    meta = products.select("productId", "title", "category", *extra)
    return ranked.join(meta, "productId", "left").withColumns({
        "title": S.display("title", 50), "category": S.display("category", 40)})


def unrated(ratings: DataFrame, users: DataFrame, candidates: DataFrame) -> DataFrame:
    """Pairs of ``userId, productId`` in ``candidates`` (pairs) that the user has not rated."""
    rated = ratings.join(users.select("userId"), "userId", "left_semi").select("userId", "productId")
    return candidates.join(rated, ["userId", "productId"], "left_anti")


def random_unrated(ratings: DataFrame, users: DataFrame, n: int = 200, seed: int = 42) -> DataFrame:
    """``n`` unrated items for each of a few ``users``, in the order of a seeded hash.

    ``users`` is a short list (the sample, at most ``MOST_SAMPLE_USERS``; more is an error), so it travels with
    the item scan as one array; each user keeps a running top ``n`` inside the tasks.  The MD5 order can be repeated in SQL.
    """
    names = [r[0] for r in users.where(F.col("userId").isNotNull()).select("userId").distinct()
             .limit(MOST_SAMPLE_USERS + 1).collect()]
    if len(names) > MOST_SAMPLE_USERS:
        raise ValueError(f"a sample has at most {MOST_SAMPLE_USERS} users")
    wanted = F.array(*map(F.lit, sorted(names))).cast("array<string>")
    pairs = (ratings.where(F.col("productId").isNotNull()).select("productId").distinct()
             .select(F.explode(wanted).alias("userId"), "productId"))
    left = unrated(ratings, users, pairs)
    order = Window.partitionBy("userId").orderBy(S.hash_place(["userId", "productId"], seed), "productId")
    return left.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).drop("_n")


def sample_recommendations(ratings: DataFrame, products: DataFrame, offsets: Offsets, factors: tuple, n_users: int = 3,
                           n_candidates: int = 200, top_k: int = 10, seed: int = 42) -> DataFrame:
    """Top ``top_k`` of random unrated items for the most active users; ``factors`` as for ``recommend``."""
    users = (ratings.where(F.col("userId").isNotNull()).groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "userId").limit(n_users).select("userId"))
    scored = predict_with(random_unrated(ratings, users, n_candidates, seed), offsets, *factors)
    order = Window.partitionBy("userId").orderBy(F.desc("prediction"), "productId")
    ranked = (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
              .withColumn("predicted_rating", S.half_even("prediction", 3)).drop("prediction"))
    return with_metadata(ranked, products)
