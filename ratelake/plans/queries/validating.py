"""Profiles, checks and expectations."""

from pyspark.sql import functions as F

from ratelake.operators import quality
from ratelake.plans import tables as T
from ratelake.plans.registry import query
from ratelake.plans.sql import TS_MAX, TS_MIN, rnd
from ratelake.sources import views

_PRODUCT_COLUMNS = ("productId", "title", "price", "brand", "category", "description")
_RATING_COLUMNS = ("userId", "productId", "rating", "timestamp")


def _null_sql(table, columns):
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS null_count,
        {rnd(f'(count(*) - count("{c}")) * 100.0::DOUBLE / count(*)', 2)} AS null_pct FROM {table}"""
        for c in columns)


@query("null_profile_products", _null_sql("P", _PRODUCT_COLUMNS), "P")
def _(spark, d):
    return quality.null_profile(views.products(spark, d))


@query("null_profile_ratings", _null_sql("R", _RATING_COLUMNS), "R")
def _(spark, d):
    return quality.null_profile(views.ratings(spark, d))


@query("nulls_left", """SELECT cast(sum(n) AS bigint) AS nulls_left FROM (
    SELECT count(*) * 6 - count(title) - count(price) - count(brand) - count(category) - count(description)
    - count("productId") AS n FROM CP)""", "CP")
def _(spark, d):
    return quality.total_nulls(T.cleaned_products(spark, d))


@query("duplicate_rows", """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM R))
    AS n_duplicates FROM R""", "R")
def _(spark, d):
    return quality.duplicate_count(views.ratings(spark, d))


@query("duplicate_pairs", """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT "userId", "productId" FROM R))
    AS n_duplicates FROM R""", "R")
def _(spark, d):
    return quality.duplicate_count(views.ratings(spark, d), ["userId", "productId"])


@query("duplicates_with_nulls", """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT brand, category FROM P))
    AS n_duplicates FROM P""", "P")
def _(spark, d):
    return quality.duplicate_count(views.products(spark, d), ["brand", "category"])


@query("rating_out_of_range", """SELECT count(*) FILTER (l_quantity IS NULL OR l_quantity NOT BETWEEN 1 AND 5)
    AS n_out_of_range FROM lineitem""")
def _(spark, d):
    return quality.rating_range_profile(
        views.table(spark, d, "lineitem").select(F.col("l_quantity").alias("rating")))


@query("rating_distribution", f"""SELECT rating, count(*) AS n,
    {rnd('count(*) * 100.0::DOUBLE / (SELECT count(*) FROM R)', 1)} AS pct FROM R GROUP BY 1""", "R")
def _(spark, d):
    return quality.distribution(views.ratings(spark, d), "rating")


@query("timestamp_profile", f"""SELECT count(*) FILTER ("timestamp" IS NULL) AS n_null,
    count(*) FILTER ("timestamp" NOT BETWEEN {TS_MIN} AND {TS_MAX}) AS n_out_of_window,
    DATE '1970-01-01' + cast(min("timestamp") // 86400 AS int) AS min_date,
    DATE '1970-01-01' + cast(max("timestamp") // 86400 AS int) AS max_date FROM R""", "R")
def _(spark, d):
    return quality.timestamp_profile(views.ratings(spark, d))


_PRICE_SQL = f"""SELECT count(*) AS n_rows, count(*) - count(price) AS n_null,
    count(*) FILTER (price < 0) AS n_negative, count(*) FILTER (price = 0) AS n_zero,
    count(*) FILTER (price > 3 * (SELECT quantile_cont(price, 0.95) FROM P)) AS n_outliers,
    {rnd('(SELECT median(price) FROM P)', 2)} AS p50,
    {rnd('(SELECT quantile_cont(price, 0.95) FROM P)', 2)} AS p95 FROM P"""


@query("price_profile", _PRICE_SQL, "P")
def _(spark, d):
    products = views.products(spark, d)
    return quality.price_profile(products)


@query("amount_profile", _PRICE_SQL.replace("FROM P", "FROM v").replace(
    "SELECT count(*) AS n_rows",
    "WITH v AS (SELECT value AS price FROM events) SELECT count(*) AS n_rows", 1))
def _(spark, d):
    return quality.price_profile(views.table(spark, d, "events").select(F.col("value").alias("price")))


@query("sparsity_profile", f"""SELECT count(DISTINCT "userId") AS n_users, count(DISTINCT "productId") AS n_items,
    count(*) AS n_ratings, {rnd('(1 - count(*) / (count(DISTINCT "userId")::DOUBLE * count(DISTINCT "productId"))) * 100', 4)}
    AS sparsity_pct, {rnd('count(*)::DOUBLE / count(DISTINCT "userId")', 1)} AS ratings_per_user,
    {rnd('count(*)::DOUBLE / count(DISTINCT "productId")', 1)} AS ratings_per_item FROM R""", "R")
def _(spark, d):
    return quality.sparsity_profile(views.ratings(spark, d))


@query("key_profile", """SELECT cast(count(*) AS bigint) AS n_rows,
    (SELECT count(*) FROM (SELECT DISTINCT * FROM R)) AS n_distinct_rows,
    (SELECT count(*) FROM (SELECT DISTINCT "userId", "productId" FROM R)) AS n_pairs,
    count(DISTINCT "userId") AS n_users, count(DISTINCT "productId") AS n_items,
    count("userId") AS n_user_rows, count("productId") AS n_item_rows FROM R""", "R")
def _(spark, d):
    return quality.key_profile(views.ratings(spark, d))


@query("category_profile", f"""SELECT count(*) AS n_rows, count(DISTINCT category) AS n_categories,
    count(*) FILTER (category IS NULL OR category = '') AS n_empty,
    {rnd("count(*) FILTER (category IS NULL OR category = '') * 100.0::DOUBLE / count(*)", 1)} AS pct_empty
    FROM P""", "P")
def _(spark, d):
    return quality.category_profile(views.products(spark, d))


@query("top_categories", """SELECT category, count(*) AS n FROM P WHERE category IS NOT NULL GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 5""", "P")
def _(spark, d):
    return quality.top_values(views.products(spark, d), "category", 5)


@query("schema_checks", """SELECT 'ratings' AS dataset, 'schema' AS "check", true AS passed,
    'absent=[]; extra=[]; n_rows=' || count(*) AS detail FROM R UNION ALL
    SELECT 'products', 'schema', false, 'absent=[''price'']; extra=[''size'']; n_rows=' || count(*) FROM P""", "R", "P")
def _(spark, d):
    from ratelake import schemas
    odd = views.products(spark, d).drop("price").withColumn("size", F.lit(1))
    return quality.schema_check(views.ratings(spark, d), schemas.RATINGS.names, "ratings").unionByName(
        quality.schema_check(odd, schemas.PRODUCTS.names, "products"))


_CHECKS_SQL = f"""SELECT 'ratings' AS dataset, 'schema' AS "check", true AS passed UNION ALL
    SELECT 'ratings', 'missing_values', greatest(count(*) - count("userId"), count(*) - count("productId"),
      count(*) - count(rating), count(*) - count("timestamp")) * 100.0 / count(*) < 30 FROM R UNION ALL
    SELECT 'ratings', 'duplicate_rows', count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM R)) FROM R UNION ALL
    SELECT 'ratings', 'duplicate_userId+productId',
      count(*) = (SELECT count(*) FROM (SELECT DISTINCT "userId", "productId" FROM R)) FROM R UNION ALL
    SELECT 'ratings', 'rating_range', count(*) FILTER (rating NOT BETWEEN 1 AND 5) = 0 FROM R UNION ALL
    SELECT 'ratings', 'timestamp_validity',
      count(*) FILTER ("timestamp" NOT BETWEEN {TS_MIN} AND {TS_MAX}) = 0 FROM R UNION ALL
    SELECT 'ratings', 'sparsity',
      (1 - count(*) / (count(DISTINCT "userId")::DOUBLE * count(DISTINCT "productId"))) * 100 > 90 FROM R UNION ALL
    SELECT 'products', 'schema', true UNION ALL
    SELECT 'products', 'missing_values', (count(*) - least(count(title), count(price), count(brand),
      count(category), count(description))) * 100.0 / count(*) < 30 FROM P UNION ALL
    SELECT 'products', 'duplicate_productId', count(*) = count(DISTINCT "productId") FROM P UNION ALL
    SELECT 'products', 'price_range', count(*) FILTER (price < 0) = 0 FROM P UNION ALL
    SELECT 'products', 'category_coverage',
      count(*) FILTER (category IS NULL OR category = '') < count(*) * 0.5 FROM P"""


def _checks(spark, d):
    products = views.products(spark, d)
    return quality.check_all(views.ratings(spark, d), products)


@query("validation_checks", _CHECKS_SQL, "R", "P")
def _(spark, d):
    return _checks(spark, d).drop("detail")


@query("validation_details")
def _(spark, d):
    return quality.summary_rows(_checks(spark, d))


@query("range_details", """SELECT 'rating_range' AS "check", 'n_out_of_range=' || count(*) FILTER (rating NOT BETWEEN 1 AND 5)
    || '; rows_by_floor=' || concat_ws(',', count(*) FILTER (floor(rating) = 1), count(*) FILTER (floor(rating) = 2),
      count(*) FILTER (floor(rating) = 3), count(*) FILTER (floor(rating) = 4), count(*) FILTER (floor(rating) = 5)) AS detail
    FROM R UNION ALL
    SELECT 'price_range', printf('n_null=%d; null_pct=%.1f; n_negative=%d; n_zero=%d; n_outliers=%d; p50=%.2f; p95=%.2f',
      count(*) - count(price), (count(*) - count(price)) * 100.0::DOUBLE / count(*), count(*) FILTER (price < 0),
      count(*) FILTER (price = 0), count(*) FILTER (price > 3 * (SELECT quantile_cont(price, 0.95) FROM P)),
      quantile_cont(price, 0.5), quantile_cont(price, 0.95)) FROM P""", "R", "P")
def _(spark, d):
    return _checks(spark, d).where(F.col("check").isin("rating_range", "price_range")).select("check", "detail")


@query("checks_passed", f"""SELECT dataset, count(*) FILTER (passed) AS n_passed, count(*) AS n_checks
    FROM ({_CHECKS_SQL}) GROUP BY 1""", "R", "P")
def _(spark, d):
    return quality.passed_of_total(_checks(spark, d))


_EXISTS = "UNION ALL SELECT '{0}', 'exists:{1}', true"


@query("rating_expectations", """SELECT 'ratings' AS dataset, 'not_null:userId' AS expectation,
      count(*) = count("userId") AS passed FROM R
    UNION ALL SELECT 'ratings', 'not_null:productId', count(*) = count("productId") FROM R
    UNION ALL SELECT 'ratings', 'not_null:rating', count(*) = count(rating) FROM R
    UNION ALL SELECT 'ratings', 'between:rating:1..5', count(*) FILTER (rating NOT BETWEEN 1 AND 5) = 0 FROM R
    UNION ALL SELECT 'ratings', 'rows_between:10000..10000000', count(*) BETWEEN 10000 AND 10000000 FROM R
    UNION ALL SELECT 'ratings', 'matches:userId',
      count(*) FILTER (NOT regexp_matches("userId", '^[A-Z0-9]+$')) = 0 FROM R """
       + " ".join(_EXISTS.format("ratings", c) for c in _RATING_COLUMNS), "R")
def _(spark, d):
    return quality.expect(views.ratings(spark, d), quality.RATING_EXPECTATIONS, "ratings")


@query("product_expectations", """SELECT 'products' AS dataset, 'not_null:productId' AS expectation,
      count(*) = count("productId") AS passed FROM P
    UNION ALL SELECT 'products', 'unique:productId', count("productId") = count(DISTINCT "productId") FROM P
    UNION ALL SELECT 'products', 'not_null:title', count(*) = count(title) FROM P
    UNION ALL SELECT 'products', 'between:price:0..10000',
      count(*) FILTER (price BETWEEN 0 AND 10000) >= 0.9 * count(price) FROM P
    UNION ALL SELECT 'products', 'rows_between:1000..5000000', count(*) BETWEEN 1000 AND 5000000 FROM P """
       + " ".join(_EXISTS.format("products", c) for c in ("productId", "title", "price")), "P")
def _(spark, d):
    return quality.expect(views.products(spark, d), quality.PRODUCT_EXPECTATIONS, "products")


@query("failing_expectations", """SELECT 'parts' AS dataset, 'brand pattern' AS expectation,
      count(*) FILTER (NOT regexp_matches(brand, '^Brand#1')) = 0 AS passed FROM P
    UNION ALL SELECT 'parts', 'brand unique', count(brand) = count(DISTINCT brand) FROM P
    UNION ALL SELECT 'parts', 'price mostly in range',
      count(*) FILTER (price BETWEEN 900 AND 950) >= 0.4 * count(price) FROM P
    UNION ALL SELECT 'parts', 'category present', count(*) = count(category) FROM P
    UNION ALL SELECT 'parts', 'colour exists', false""", "P")
def _(spark, d):
    e = quality.Expectation
    return quality.expect(views.products(spark, d), [
        e("brand pattern", "matches", "brand", pattern="^Brand#1"), e("brand unique", "unique", "brand"),
        e("price mostly in range", "between", "price", 900.0, 950.0, mostly=0.4),
        e("category present", "not_null", "category"), e("colour exists", "exists", "colour")], "parts")
