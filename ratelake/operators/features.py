"""User, item, interaction and co-occurrence features."""

from pyspark.sql import DataFrame, Window, functions as F

from ratelake import schemas
from ratelake.functions import scalar as S
from ratelake.operators.quantiles import dense_index, exact_quantiles
from ratelake.session import bounded


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    doubles = [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: S.half_even(c, digits) for c in doubles})


def category_diversity(ratings: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct non-null categories per user.

    Pairs of user and category are made distinct before they are counted, so a
    user with very many ratings sends few rows.
    """
    pairs = (ratings.where(F.col("userId").isNotNull()).select("userId", "productId")
             .join(products.select("productId", "category"), "productId", "left")
             .select("userId", "category").distinct())
    return pairs.groupBy("userId").agg(F.count("category").alias("user_category_diversity"))


def user_features(ratings: DataFrame, products: DataFrame) -> DataFrame:
    """One row per user.  ``products`` holds a product once.

    Ratings are merged by (user, item), then by (user, category), then by user: one scan, each step smaller than the
    last, and a very active user is combined in the map tasks.
    """
    newest = ratings.select(F.max("timestamp")).scalar()
    items = ratings.where(F.col("userId").isNotNull()).groupBy("userId", "productId").agg(
        F.count("rating").alias("n"), F.sum("rating").alias("s"), F.sum(F.col("rating") * F.col("rating")).alias("q"),
        F.max("timestamp").alias("last"))
    merged = [F.sum(c).alias(c) for c in ("n", "s", "q")] + [F.max("last").alias("last")]
    table = (items.join(products.select("productId", "category"), "productId", "left")
             .groupBy("userId", "category").agg(*merged, F.count("productId").alias("items"))
             .groupBy("userId").agg(*merged, F.sum("items").alias("user_unique_items"),
                                    F.count("category").alias("user_category_diversity")))
    spread = F.greatest(F.col("q") - F.col("s") * F.col("s") / F.col("n"), F.lit(0.0)) / (F.col("n") - 1)
    return round_doubles(table.select(
        "userId", F.col("n").alias("user_rating_count"), F.try_divide("s", "n").alias("user_avg_rating"),
        F.when(F.col("n") > 1, F.sqrt(spread)).otherwise(F.lit(0.0)).alias("user_rating_std"), "user_unique_items",
        S.half_even((newest - F.col("last")) / S.SECONDS_PER_DAY, 1).alias("user_recency_days"),
        "user_category_diversity")).select(*schemas.USER_FEATURES.names)


def item_stats(ratings: DataFrame) -> DataFrame:
    return (ratings.where(F.col("productId").isNotNull()).groupBy("productId").agg(
        F.count("rating").alias("item_rating_count"),
        F.avg("rating").alias("item_avg_rating"),
        F.coalesce(F.stddev_samp("rating"), F.lit(0.0)).alias("item_rating_std"),
        F.count_distinct("userId").alias("item_unique_users")))


def item_base(ratings: DataFrame, products: DataFrame) -> DataFrame:
    """Item statistics with catalog columns; the two enrichment columns come as one optional group."""
    enriched = {"rating_count", "avg_rating"} <= set(products.columns)
    extra = ["rating_count", "avg_rating"] if enriched else []
    table = item_stats(ratings).join(
        products.select("productId", "price", "category", "brand", *extra), "productId", "left")
    table = table.withColumns({
        "category": F.coalesce("category", F.lit("Unknown")),
        "brand": F.coalesce("brand", F.lit("Unknown")),
        "price": S.to_number("price")})
    if enriched:
        table = table.withColumns({
            "api_rating_count": F.coalesce("rating_count", F.lit(0)).cast("int"),
            "api_avg_rating": S.half_even(F.coalesce("avg_rating", F.lit(0.0)), 4),
        }).drop("rating_count", "avg_rating")
    return table


def label_encoding(df: DataFrame, column: str) -> DataFrame:
    """``column, <column>_encoded``: position in the sorted distinct values, nulls as Unknown."""
    values = df.select(F.coalesce(F.col(column), F.lit("Unknown")).alias(column)).distinct()
    name = f"{column}_encoded"
    return dense_index(values, column, name) \
        .withColumn(name, F.col(name).cast("int"))


def scale_min_max(df: DataFrame, column: str, out: str, fitted_on: DataFrame | None = None) -> DataFrame:
    """``(x - min) / (max - min)``, 4 dp; a constant column gives 0."""
    fit = df if fitted_on is None else fitted_on
    span = fit.select(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("s")).scalar()
    low, width = span["lo"], span["hi"] - span["lo"]
    return df.withColumn(out, F.when(width == 0, F.when(F.col(column).isNotNull(), F.lit(0.0)))
                         .otherwise(S.half_even((F.col(column) - low) / width, 4)))


def encode_items(base: DataFrame) -> DataFrame:
    """Label codes, price fill and price scale over an ``item_base`` table.

    ``base`` is read several times: stage it first when it is costly.
    """
    median = exact_quantiles(base, "price", {"m": 0.5}).scalar()
    # The median lies between minimum and maximum, so the unfilled column gives the same range.
    table = scale_min_max(base.withColumn("price", F.coalesce("price", median)),
                          "price", "price_normalized", fitted_on=base)
    for column in ("category", "brand"):
        table = table.join(label_encoding(base, column), column)
    columns = schemas.ITEM_FEATURES.names + [
        c for c in schemas.ITEM_ENRICHED_COLUMNS if c in base.columns]
    return round_doubles(table).select(*columns)


def item_features(ratings: DataFrame, products: DataFrame) -> DataFrame:
    return encode_items(item_base(ratings, products))


def interaction_features(ratings: DataFrame, items: DataFrame) -> DataFrame:
    table = ratings.select("userId", "productId", "rating", "timestamp") \
        .join(items.select("productId", "item_avg_rating"), "productId", "left")
    return table.select(
        "userId", "productId", "rating", "timestamp",
        S.scale_rating("rating").alias("rating_normalized"),
        S.day_number("timestamp").alias("days_since_epoch"),
        S.half_even(F.col("rating") - F.col("item_avg_rating"), 4).alias("user_item_rating_diff"))


def popular_items(ratings: DataFrame, n: int) -> DataFrame:
    """The ``n`` items with most rows; ties go to the smaller id."""
    return (ratings.where(F.col("productId").isNotNull())
            .groupBy("productId").agg(F.count(F.lit(1)).alias("n_ratings"))
            .orderBy(F.desc("n_ratings"), "productId").limit(n))


def in_popular(ratings: DataFrame, n: int) -> DataFrame:
    return ratings.join(popular_items(ratings, n).select("productId"), "productId", "left_semi") \
        .select(*ratings.columns)


def shared_users(ratings: DataFrame, top_n: int = 500) -> tuple:
    """``a, b, n_users`` over positions of the ``top_n`` most rated items, and the list of their ids.

    A user's popular items become a bit set, 64 items to a number; that
    aggregation combines in the map tasks and drops repeated pairs by itself.
    Each item of a user then adds whole 64-item words to 64 counters, so no
    pairs of items are ever produced, and only counters are shuffled.
    """
    # At most top_n ids, in id order so that positions break ties like ids.
    ids = popular_items(ratings, top_n).agg(F.sort_array(F.collect_list("productId")).alias("ids"))
    positions = bounded(ids.select(F.posexplode("ids").alias("position", "productId")), top_n)
    words = [f"w{i}" for i in range((top_n + 63) // 64)]
    baskets = (ratings.where("userId is not null and rating > 0").select("userId", "productId")
               .join(positions, "productId")
               .selectExpr("userId", "div(position, 64) as word", "shiftleft(1L, position % 64) as bit")
               .groupBy("userId").agg(*[
                   F.expr(f"coalesce(bit_or(case when word = {i} then bit end), 0L) as {w}")
                   for i, w in enumerate(words)]))
    items = ", ".join(
        f"transform(filter(sequence(0, 63), k -> {w} <> 0 and getbit({w}, k) = 1), k -> k + {64 * i})"
        for i, w in enumerate(words))
    held = ", ".join(f"struct({i} as word, {w} as bits)" for i, w in enumerate(words))
    spread = (baskets.where(" + ".join(f"bit_count({w})" for w in words) + " > 1")
              .selectExpr(f"flatten(array({items})) as items",
                          f"filter(array({held}), x -> x.bits <> 0) as held")
              .selectExpr("explode(items) as a", "held").selectExpr("a", "inline(held)"))
    counters = spread.groupBy("a", "word").agg(
        *[F.expr(f"sum(shiftright(bits, {k}) & 1L) as c{k}") for k in range(64)])
    lanes = ", ".join(f"c{k}" for k in range(64))
    counts = (counters.selectExpr("a", "word", f"posexplode(array({lanes})) as (k, n_users)")
              .selectExpr("a", "word * 64 + k as b", "n_users").where("n_users > 0 and a <> b"))
    return counts, ids


def cooccurrence(ratings: DataFrame, top_n: int = 500, keep: int = 3) -> DataFrame:
    """The ``keep`` items that share most users with each item; ties go to the smaller id."""
    counts, ids = shared_users(ratings, top_n)
    best = Window.partitionBy("a").orderBy(F.desc("n_users"), "b")
    top = (counts.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= keep)
           .withColumn("ids", ids.scalar()))
    return top.select(F.element_at("ids", F.col("a") + 1).alias("productId"),
                      F.element_at("ids", (F.col("b") + 1).cast("int")).alias("co_productId"),
                      S.half_even(F.col("n_users").cast("double"), 2).alias("cooc_score"))
