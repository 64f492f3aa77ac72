"""Reads from the feature tables and the catalog."""

from pyspark.sql import functions as F

from ratelake.operators import catalog, explore, store
from ratelake.plans import tables as T
from ratelake.plans.registry import query
from ratelake.plans.sql import rnd
from ratelake.session import scratch_path
from ratelake.sources import tables as stored

_TRAIN = """SELECT INTER."userId", INTER."productId", rating, rating_normalized, days_since_epoch,
    user_item_rating_diff, user_rating_count, user_avg_rating, user_rating_std, user_unique_items,
    user_recency_days, user_category_diversity, item_rating_count, item_avg_rating, item_rating_std,
    item_unique_users, price_normalized, category_encoded, brand_encoded
    FROM INTER LEFT JOIN UF ON INTER."userId" = UF."userId"
    LEFT JOIN "IF" ON INTER."productId" = "IF"."productId" """


@query("training_set", _TRAIN, "INTER", "UF", "IF")
def _(spark, d):
    return store.training_set(T.interaction_features(spark, d), T.user_features(spark, d),
                              T.item_features(spark, d))


@query("training_set_from_buckets", _TRAIN, "INTER", "UF", "IF")
def _(spark, d):
    root = scratch_path(spark, "features")
    stored.write_features({"user_features": T.user_features(spark, d), "item_features": T.item_features(spark, d),
                           "interaction_features": T.interaction_features(spark, d)}, root, buckets=8)
    users, items, interactions = (stored.read_table(spark, root, f"{name}_features")
                                  for name in ("user", "item", "interaction"))
    return store.training_set(interactions, users, items)


_PLACE = """('0x' || substr(md5("userId" || '|' || "productId" || '|42'), 1, 15))::BIGINT"""


@query("training_sample", f"""SELECT {", ".join(f'"{c}"' for c in store.TRAINING_COLUMNS)}
    FROM (SELECT * FROM INTER QUALIFY row_number() OVER (ORDER BY {_PLACE}, "userId", "productId")
          <= round_even((SELECT count(*) FROM INTER) * 0.25::DOUBLE, 0))
    LEFT JOIN UF USING ("userId") LEFT JOIN (SELECT * EXCLUDE (price, category, brand) FROM "IF") USING ("productId")""",
       "INTER", "UF", "IF")
def _(spark, d):
    return store.training_set(T.interaction_features(spark, d), T.user_features(spark, d),
                              T.item_features(spark, d), fraction=0.25)


@query("training_sample_size", 'SELECT cast(round_even(count(*) * 0.25::DOUBLE, 0) AS bigint) AS n FROM INTER', "INTER")
def _(spark, d):
    return store.exact_sample(T.interaction_features(spark, d), 0.25, ["userId", "productId"]) \
        .agg(F.count(F.lit(1)).alias("n"))


@query("user_features_by_id", """SELECT * FROM UF WHERE "userId" IN ('1', '7', '42', 'nobody')""", "UF")
def _(spark, d):
    return store.user_features_of(T.user_features(spark, d), ["1", "7", "42", "nobody"])


@query("user_features_by_table", """SELECT * FROM UF WHERE "userId" IN (
    SELECT cast(c_custkey AS varchar) FROM customer WHERE c_acctbal > 0)""", "UF")
def _(spark, d):
    from ratelake.sources.views import table
    ids = table(spark, d, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("userId"))
    return store.user_features_of(T.user_features(spark, d), ids)


@query("inference_features_popular", """SELECT UF.*, i.* FROM UF, (SELECT * FROM "IF"
    ORDER BY item_rating_count DESC, "productId" LIMIT 100) i WHERE "userId" = '7'""", "UF", "IF")
def _(spark, d):
    return store.inference_features(T.user_features(spark, d), T.item_features(spark, d), "7")


@query("inference_features_listed", """SELECT UF.*, "IF".* FROM UF, "IF" WHERE "userId" = '42'
    AND "productId" IN ('1', '2', '3', 'none')""", "UF", "IF")
def _(spark, d):
    return store.inference_features(T.user_features(spark, d), T.item_features(spark, d), "42",
                                    ["1", "2", "3", "none"])


@query("cooccurring_items_of_one", """SELECT "co_productId", cooc_score FROM COOC WHERE "productId" = (
    SELECT min("productId") FROM COOC) ORDER BY cooc_score DESC, "co_productId" LIMIT 5""", "COOC")
def _(spark, d):
    table = T.cooccurrence(spark, d)
    first = table.agg(F.min("productId")).first()[0]
    return store.cooccurring_items(table, first or "")


@query("score_threshold", "SELECT * FROM COOC WHERE cooc_score > 1", "COOC")
def _(spark, d):
    return T.cooccurrence(spark, d).where(F.col("cooc_score") > 1)


@query("users_with_many_ratings", """SELECT "userId", count(*) AS n FROM CR GROUP BY 1 HAVING count(*) >= 15""", "CR")
def _(spark, d):
    return explore.key_counts(T.cleaned_ratings(spark, d), "userId").where("n >= 15")


def _rows(source):
    return f"""SELECT "productId", title, {rnd('coalesce(price, 0.0)', 2)} AS price, coalesce(brand, 'Unknown') AS brand,
        coalesce(category, 'Unknown') AS category, left(coalesce(description, ''), 200) AS description,
        cast(coalesce(rating_count, 0) AS int) AS rating_count, coalesce(avg_rating, 0.0) AS avg_rating
        FROM ({source})"""


@query("product_rows", _rows("SELECT * FROM EP"), "EP")
def _(spark, d):
    return catalog.product_rows(T.enriched_products(spark, d))


@query("product_rows_as_json", f"""SELECT "productId", to_json(t)::VARCHAR AS json FROM ({_rows('SELECT * FROM EP')}) t""", "EP")
def _(spark, d):
    return catalog.product_json(T.enriched_products(spark, d))


@query("product_by_id", _rows("""SELECT * FROM EP WHERE "productId" = '17'"""), "EP")
def _(spark, d):
    return catalog.product_by_id(T.enriched_products(spark, d), "17")


@query("category_match", """SELECT "productId", category FROM P
    WHERE coalesce(regexp_matches(category, '(?i)^s.*(l|d)$'), false)""", "P")
def _(spark, d):
    from ratelake.sources import views
    return catalog.category_matches(views.products(spark, d).select("productId", "category"), "^s.*(l|d)$")


@query("price_bounds", """SELECT "productId", price FROM EP WHERE price >= 920 AND price <= 960""", "EP")
def _(spark, d):
    return catalog.price_between(T.enriched_products(spark, d).select("productId", "price"), 920, 960)


_FOUND = """SELECT * FROM EP WHERE regexp_matches(category, '(?i)large') AND price >= 905"""


@query("product_page", _rows(f'{_FOUND} ORDER BY "productId" LIMIT 20 OFFSET 20'), "EP")
def _(spark, d):
    return catalog.product_page(T.enriched_products(spark, d), 2, 20, "large", min_price=905)


@query("deep_page", _rows('SELECT * FROM EP ORDER BY "productId" LIMIT 20 OFFSET 160'), "EP")
def _(spark, d):
    return catalog.indexed_page(catalog.page_index(T.enriched_products(spark, d), cell_rows=50), 9, 20)


@query("deep_page_of_a_search", _rows(f'{_FOUND} ORDER BY "productId" LIMIT 3 OFFSET 6'), "EP")
def _(spark, d):
    return catalog.indexed_page(catalog.page_index(T.enriched_products(spark, d), cell_rows=50), 3, 3, "large", min_price=905)


@query("product_page_info", f"""SELECT count(*) AS total, 2 AS page, 20 AS "limit",
    cast(ceil(count(*) / 20.0::DOUBLE) AS bigint) AS pages FROM ({_FOUND})""", "EP")
def _(spark, d):
    return catalog.page_info(T.enriched_products(spark, d), 2, 20, "large", min_price=905)


@query("category_page", _rows("""SELECT * FROM EP WHERE regexp_matches(category, '(?i)economy|promo')
    ORDER BY "productId" LIMIT 20"""), "EP")
def _(spark, d):
    return catalog.category_page(T.enriched_products(spark, d), "economy|promo")


@query("popular_products", _rows("""SELECT * FROM EP ORDER BY rating_count DESC, "productId" LIMIT 20"""), "EP")
def _(spark, d):
    return catalog.popular_products(T.enriched_products(spark, d))


@query("catalog_stats", f"""SELECT count(*) AS total_products, count(DISTINCT category) AS total_categories,
    count(DISTINCT brand) AS total_brands, {rnd('avg(price)', 2)} AS avg_price,
    {rnd('median(price)', 2)} AS median_price, count(*) FILTER (rating_count > 0) AS products_with_ratings,
    {rnd('avg(avg_rating)', 2)} AS avg_rating_overall,
    (SELECT category FROM EP GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_category,
    (SELECT brand FROM EP GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top_brand FROM EP""", "EP")
def _(spark, d):
    products = T.enriched_products(spark, d)
    return catalog.catalog_stats(products)
