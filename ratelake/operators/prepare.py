"""Cleaning of ratings and products."""

from pyspark.sql import DataFrame, functions as F

from ratelake.functions import scalar as S
from ratelake.operators.quantiles import exact_quantiles, leading_cells
from ratelake.session import stage

PREPARED_FILL = {"brand": "Unknown", "category": "Unknown", "title": "Untitled", "description": ""}
CATALOG_FILL = {"title": "Unknown Title", "price": 0.0, "brand": "Unknown", "category": "Unknown",
                "description": ""}


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    return df.distinct()


def keep_highest_rating(ratings: DataFrame) -> DataFrame:
    """One row per (user, item): highest rating, then latest time.

    Two hash aggregations on fixed-width buffers, which combine in the map
    tasks, so a pair that fills a third of the log is no hot spot.  Exact
    duplicates vanish in the first one.
    """
    latest = ratings.groupBy("userId", "productId", "rating").agg(F.max("timestamp").alias("timestamp"))
    # Ratings are unique within a pair here; a null rating loses to any other.
    best = F.coalesce(F.col("rating"), F.lit(float("-inf")))
    kept = latest.groupBy("userId", "productId").agg(
        F.max("rating").alias("rating"), F.max_by("timestamp", best).alias("timestamp"))
    return kept.select("userId", "productId", "rating", "timestamp")


def in_time_window(ratings: DataFrame) -> DataFrame:
    return ratings.where(S.in_window("timestamp"))


def clean_ratings(ratings: DataFrame) -> DataFrame:
    """De-duplicate first, then cut to the accepted time window."""
    return in_time_window(keep_highest_rating(ratings))


def impute_prices(products: DataFrame) -> DataFrame:
    """Missing prices from the category median, then from the median of the filled column.

    One count by category and leading digits serves both: the filled column is the known prices and
    each category's median as often as a price is missing there.  The two columns are written first, so that
    what makes ``products`` runs twice however many counts there are.
    """
    priced = products.withColumn("price", S.to_number("price"))
    known = stage(priced.select("category", "price"), "prices")
    cells = stage(leading_cells(known.withColumn("category", F.struct("category")), "price", ["category"]), "price_cells")
    cells = cells.withColumn("category", F.col("category.category"))
    missing = known.where(F.col("price").isNull()).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    medians = stage(exact_quantiles(known, "price", {"category_median": 0.5}, ["category"],
                                    cells=cells.where(F.col("category").isNotNull())).join(missing, "category", "left"), "medians")
    gaps = medians.where(F.col("n").isNotNull()).select(F.col("category_median").alias("price"), "n")
    gap_cells = leading_cells(gaps, "price", weight="n")
    every = cells.drop("category").unionByName(gap_cells).groupBy("_cell").agg(
        F.sum("_n").alias("_n"), F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    filled = known.select("price", F.lit(1).cast("long").alias("n")).unionByName(gaps)
    overall = exact_quantiles(filled, "price", {"m": 0.5}, weight="n", cells=every).scalar()
    return (priced.join(medians.drop("n"), "category", "left")
            .withColumn("price", F.coalesce("price", "category_median", overall))
            .select(*products.columns))


def fill_prepared(products: DataFrame) -> DataFrame:
    return products.na.fill({c: v for c, v in PREPARED_FILL.items() if c in products.columns})


def fill_catalog(products: DataFrame) -> DataFrame:
    return products.withColumn("price", S.to_number("price")).na.fill(CATALOG_FILL)


def clean_products(products: DataFrame) -> DataFrame:
    """Prices are imputed before categories are filled, since a missing category has no median."""
    return fill_prepared(impute_prices(products))


def item_rating_stats(ratings: DataFrame) -> DataFrame:
    """Rating count and mean (2 dp) per product, as the catalog service publishes them."""
    return (ratings.where(F.col("productId").isNotNull()).groupBy("productId")
            .agg(F.count("rating").alias("rating_count"),
                 S.half_even(F.avg("rating"), 2).alias("avg_rating")))


def enrich_products(products: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Add ``rating_count`` and ``avg_rating``; products without ratings, or no stats at all, give 0."""
    base = products.drop("rating_count", "avg_rating")
    if stats is None:
        return base.withColumns({"rating_count": F.lit(0).cast("bigint"), "avg_rating": F.lit(0.0)})
    stats = stats.select("productId", "rating_count", "avg_rating")
    return base.join(stats, "productId", "left").withColumns({
        "rating_count": F.coalesce("rating_count", F.lit(0)).cast("bigint"),
        "avg_rating": S.half_even(F.coalesce("avg_rating", F.lit(0.0)), 2)})


def enrichment_coverage(enriched: DataFrame) -> DataFrame:
    """Products with ratings (count and %), and the mean rating over those."""
    rated = F.col("rating_count") > 0
    n_rated, n = F.count(F.when(rated, 1)), F.count(F.lit(1))
    return enriched.agg(
        n.alias("n_products"), n_rated.alias("n_rated"),
        S.half_even(F.try_divide(n_rated * 100.0, n), 1).alias("pct_rated"),
        S.half_even(F.avg(F.when(F.col("avg_rating") > 0, F.col("avg_rating"))), 2)
        .alias("avg_rating_rated"))
