"""The numbers behind exploratory plots and tables."""

from pyspark.sql import DataFrame, Window, functions as F

from ratelake.functions import scalar as S
from ratelake.operators.quantiles import exact_quantiles
from ratelake.session import bounded


def _count():
    return F.count(F.lit(1))


def calendar(ratings: DataFrame) -> DataFrame:
    """Add UTC ``date``, ``year`` and ``month`` of the rating time."""
    dated = ratings.withColumn("date", S.calendar_date("timestamp"))
    return dated.withColumns({"year": F.year("date"), "month": F.month("date")})


def ratings_per_year(ratings: DataFrame) -> DataFrame:
    return calendar(ratings).where(F.col("year").isNotNull()).groupBy("year").agg(_count().alias("n"))


def ratings_per_month(ratings: DataFrame) -> DataFrame:
    counts = calendar(ratings).where(F.col("year").isNotNull()).groupBy("year", "month") \
        .agg(_count().alias("n"))
    return counts.withColumn("period", S.month_start("year", "month"))


def peak_month(ratings: DataFrame) -> DataFrame:
    """The first of the months with most ratings."""
    return ratings_per_month(ratings).orderBy(F.desc("n"), "period").limit(1).select("period", "n")


def key_counts(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.where(F.col(key).isNotNull()).groupBy(key).agg(_count().alias("n"))


def counts_of_counts(ratings: DataFrame, key: str) -> DataFrame:
    """``n, keys``: how many keys have ``n`` rows.

    With N ratings there are at most ``sqrt(2 N)`` distinct counts, so this is a
    small table at any scale; the statistics below all read it.
    """
    return key_counts(ratings, key).groupBy("n").agg(_count().alias("keys"))


def _median_of_counts(ratings: DataFrame, key: str):
    return exact_quantiles(key_counts(ratings, key), "n", {"m": 0.5}).scalar()


def user_activity(ratings: DataFrame, few: int = 5) -> DataFrame:
    """Users, median, mean and largest ratings per user, and users with fewer than ``few``."""
    counts = counts_of_counts(ratings, "userId")
    users, rows = F.sum("keys"), F.sum(F.col("n") * F.col("keys"))
    low = F.coalesce(F.sum(F.when(F.col("n") < few, F.col("keys"))), F.lit(0))
    return counts.agg(
        users.alias("n_users"), S.half_even(F.try_divide(rows, users), 1).alias("mean_ratings"),
        F.max("n").alias("max_ratings"), low.alias("users_below"),
        S.half_even(F.try_divide(low * F.lit(100.0), users), 1).alias("pct_below"),
    ).withColumn("median_ratings", _median_of_counts(ratings, "userId"))


def item_popularity(ratings: DataFrame) -> DataFrame:
    counts = counts_of_counts(ratings, "productId")
    return counts.agg(
        F.sum("keys").alias("n_items"),
        F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("keys"))), F.lit(0)).alias("items_with_one"),
    ).withColumn("median_ratings", _median_of_counts(ratings, "productId"))


def head_share(ratings: DataFrame, share: float = 0.1) -> DataFrame:
    """Ratings held by the top ``int(share * items)`` items, in %.

    Items with equal counts weigh the same, so counts of counts are enough and
    no item is ranked one by one.
    """
    counts = counts_of_counts(ratings, "productId")
    # A table of distinct counts (at most sqrt(2 N) rows), so one ordered pass is cheap.
    above = F.coalesce(F.sum("keys").over(
        Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ordered = counts.select("n", "keys", above.alias("above"), F.sum("keys").over(
        Window.partitionBy()).alias("items"))
    head = F.floor(F.col("items") * F.lit(share))
    taken = F.greatest(F.least(head - F.col("above"), F.col("keys")), F.lit(0))
    total = F.sum(F.col("n") * F.col("keys"))
    held = F.sum(F.col("n") * taken)
    return ordered.agg(
        F.max(head).alias("head_items"), held.alias("head_ratings"),
        S.half_even(F.try_divide(held * F.lit(100.0), total), 1).alias("pct_of_ratings"))


def popularity_curve(ratings: DataFrame, top: int = 500) -> DataFrame:
    """``rank, n`` of the most rated items; at most ``top`` rows are ranked."""
    best = key_counts(ratings, "productId").orderBy(F.desc("n"), "productId").limit(top)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "productId"))
    return best.select((rank - 1).alias("rank"), "productId", "n")


def most_active_users(ratings: DataFrame, top: int = 20) -> DataFrame:
    return key_counts(ratings, "userId").orderBy(F.desc("n"), "userId").limit(top)


def histogram(df: DataFrame, column: str, bins: int, weight: str | None = None) -> DataFrame:
    """``bin, bin_start, n`` of equal-width bins from minimum to maximum; empty bins are absent."""
    span = df.select(F.struct(F.min(column).cast("double").alias("lo"),
                              F.max(column).cast("double").alias("hi")).alias("s")).scalar()
    value = F.col(column).cast("double")
    n = _count() if weight is None else F.sum(weight)
    binned = (df.where(value.isNotNull()).withColumn("_s", span)
              .withColumn("bin", S.bin_index(value, F.col("_s.lo"), F.col("_s.hi"), bins)))
    start = F.when(F.col("_s.lo") == F.col("_s.hi"), F.col("_s.lo") - 0.5 + F.col("bin") / bins) \
        .otherwise(F.col("_s.lo") + F.col("bin") * (F.col("_s.hi") - F.col("_s.lo")) / bins)
    return (binned.withColumn("bin_start", S.half_even(start, 4))
            .groupBy("bin", "bin_start").agg(n.alias("n")))


def activity_histogram(ratings: DataFrame, bins: int = 50) -> DataFrame:
    return histogram(counts_of_counts(ratings, "userId"), "n", bins, weight="keys")


def popularity_histogram(ratings: DataFrame, bins: int = 60) -> DataFrame:
    return histogram(counts_of_counts(ratings, "productId"), "n", bins, weight="keys")


def below_p95(products: DataFrame) -> DataFrame:
    mark = exact_quantiles(products, "price", {"q": 0.95}).scalar()
    return products.where(F.col("price") < mark)


def price_histogram(products: DataFrame, bins: int = 40) -> DataFrame:
    return histogram(below_p95(products), "price", bins)


def with_product(ratings: DataFrame, products: DataFrame) -> DataFrame:
    return ratings.join(products.select("productId", "price", "category", "brand"), "productId", "left")


def _rating_sums(ratings: DataFrame) -> DataFrame:
    """Ratings summed per item, so that the join to the catalog moves one row per item."""
    return ratings.where(F.col("productId").isNotNull()).groupBy("productId").agg(
        F.sum("rating").alias("s"), F.count("rating").alias("c"))


def rating_by_price(ratings: DataFrame, products: DataFrame) -> DataFrame:
    """Mean rating per price bucket; rows without a bucket are left out."""
    table = with_product(_rating_sums(ratings), products).select(
        S.price_bucket_index("price").alias("bucket_order"), S.price_bucket("price").alias("price_bucket"),
        "s", "c")
    return (table.where(F.col("price_bucket").isNotNull()).groupBy("bucket_order", "price_bucket")
            .agg(S.half_even(F.try_divide(F.sum("s"), F.sum("c")), 4).alias("avg_rating"),
                 F.sum("c").alias("n")))


def category_ratings(ratings: DataFrame, products: DataFrame) -> DataFrame:
    table = with_product(_rating_sums(ratings), products).where(F.col("category").isNotNull())
    return table.groupBy("category").agg(
        S.half_even(F.try_divide(F.sum("s"), F.sum("c")), 4).alias("avg_rating"), F.sum("c").alias("n"))


def best_categories(ratings: DataFrame, products: DataFrame, min_ratings: int = 100,
                    top: int = 10) -> DataFrame:
    return (category_ratings(ratings, products).where(F.col("n") >= min_ratings)
            .orderBy(F.desc("avg_rating"), "category").limit(top))


def top_keys(ratings: DataFrame, key: str, n: int, position: str) -> DataFrame:
    """The ``n`` most frequent keys with their position from 0; only those rows are ranked."""
    best = key_counts(ratings, key).orderBy(F.desc("n"), key).limit(n)
    return best.select(key, (F.row_number().over(Window.orderBy(F.desc("n"), key)) - 1).alias(position))


def head_matrix(ratings: DataFrame, n: int = 200) -> DataFrame:
    """Cells ``u_idx, i_idx, rating`` among the top users and items, in long form."""
    users = bounded(top_keys(ratings, "userId", n, "u_idx"), n)
    items = bounded(top_keys(ratings, "productId", n, "i_idx"), n)
    return (ratings.join(users, "userId").join(items, "productId")
            .groupBy("u_idx", "i_idx").agg(F.max("rating").alias("rating")))


def head_rows(ratings: DataFrame, n: int = 200) -> DataFrame:
    """Ratings whose user and item are both among the top ``n``."""
    users = bounded(top_keys(ratings, "userId", n, "p").select("userId"), n)
    items = bounded(top_keys(ratings, "productId", n, "p").select("productId"), n)
    return ratings.join(users, "userId", "left_semi").join(items, "productId", "left_semi") \
        .select(*ratings.columns)


def head_sparsity(ratings: DataFrame, n: int = 200) -> DataFrame:
    """Share of empty cells of the ``n`` x ``n`` matrix, in %."""
    return head_matrix(ratings, n).agg(F.count(F.when(F.col("rating") != 0, 1)).alias("n_cells")).select(
        "n_cells", S.half_even((1 - F.col("n_cells") / F.lit(float(n * n))) * 100, 4).alias("sparsity_pct"))


def user_item_pivot(ratings: DataFrame, top: int = 10, binary: bool = False) -> DataFrame:
    """One row per user, one column ``item_<position>`` per top item: mean rating, 0 when unrated."""
    items = bounded(top_keys(ratings, "productId", top, "position"), top)
    table = ratings.where(F.col("userId").isNotNull()).join(items, "productId") \
        .groupBy("userId").pivot("position", list(range(top))).agg(F.avg("rating"))
    cells = [F.coalesce(F.col(str(i)), F.lit(0.0)) for i in range(top)]
    if binary:
        cells = [(c > 0).cast("int") for c in cells]
    else:
        cells = [S.half_even(c, 4) for c in cells]
    return table.select("userId", *[c.alias(f"item_{i}") for i, c in enumerate(cells)])
