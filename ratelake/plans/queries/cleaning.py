"""Field mapping, parsing, filters and cleaning."""

from pyspark.sql import functions as F

from ratelake.functions import scalar as S
from ratelake.operators import ingest, prepare
from ratelake.operators.quantiles import exact_quantiles
from ratelake.plans import tables as T
from ratelake.plans.registry import query
from ratelake.plans.sql import TS_MAX, TS_MIN, rnd
from ratelake.sources import views

_KEYS = '"userId", "productId", rating, "timestamp"'


@query("field_map_select", f"SELECT {_KEYS} FROM R", "R")
def _(spark, d):
    raw = views.ratings(spark, d).select(
        F.col("userId").alias("user_id"), F.col("productId").alias("parent_asin"), "rating", "timestamp",
        F.lit(True).alias("verified"))
    return ingest.select_fields(raw, {"user_id": "userId", "parent_asin": "productId", "rating": "rating",
                                      "timestamp": "timestamp", "absent": "absent"})


@query("category_path_join", """SELECT cast(p_partkey AS varchar) AS "productId",
    replace(p_name, ' ', ' > ') || ' > ' || p_type AS category FROM part""")
def _(spark, d):
    part = views.table(spark, d, "part")
    listed = F.array_append(F.split("p_name", " "), F.col("p_type"))
    return part.select(F.col("p_partkey").cast("string").alias("productId"),
                       S.category_path(listed).alias("category"))


@query("description_text_join", r"""SELECT doc_id, left(replace(text, chr(10), ' '), 300) AS description
    FROM documents""")
def _(spark, d):
    docs = views.table(spark, d, "documents")
    return docs.select("doc_id", S.description_text(F.split("text", "\n")).alias("description"))


_PRICE_TEXT = """CASE p_partkey % 6 WHEN 0 THEN '$1,' || cast(p_retailprice AS varchar)
    WHEN 1 THEN 'from ' || cast(p_retailprice AS varchar) WHEN 2 THEN '1.2.3' WHEN 3 THEN '-5'
    WHEN 4 THEN '' ELSE cast(p_retailprice AS varchar) END"""


def price_text():
    text, k = F.col("p_retailprice").cast("string"), F.col("p_partkey") % 6
    return (F.when(k == 0, F.concat(F.lit("$1,"), text)).when(k == 1, F.concat(F.lit("from "), text))
            .when(k == 2, "1.2.3").when(k == 3, "-5").when(k == 4, "").otherwise(text))


@query("price_text_parse", f"""SELECT p_partkey,
    try_cast(regexp_replace({_PRICE_TEXT}, '[^0-9.]', '', 'g') AS double) AS price FROM part""")
def _(spark, d):
    return views.table(spark, d, "part").select("p_partkey", S.parse_price(price_text()).alias("price"))


@query("epoch_normalise", f"""SELECT "userId", "productId", rating,
    CASE WHEN (SELECT max("timestamp" * 1000) FROM R) > 1e12 THEN "timestamp" * 1000 // 1000
    ELSE "timestamp" * 1000 END AS "timestamp" FROM R""", "R")
def _(spark, d):
    raw = views.ratings(spark, d).withColumn("timestamp", (F.col("timestamp") * 1000).cast("string"))
    return ingest.normalise_epoch(raw)


@query("epoch_normalise_by_row", """SELECT "productId", "userId", rating, CASE WHEN ms > 1e11 THEN ms // 1000
    ELSE ms END AS "timestamp" FROM (SELECT *, CASE WHEN cast("productId" AS bigint) % 2 = 0
    THEN "timestamp" * 10000 ELSE "timestamp" END AS ms FROM R)""", "R")
def _(spark, d):
    even = F.col("productId").cast("bigint") % 2 == 0
    mixed = F.when(even, F.col("timestamp") * 10000).otherwise(F.col("timestamp"))
    return ingest.normalise_epoch(views.ratings(spark, d).withColumn("timestamp", mixed), per_row=True)


@query("numeric_coercion", """SELECT p_partkey, try_cast(CASE p_partkey % 3 WHEN 0 THEN p_name
    WHEN 1 THEN cast(p_retailprice AS varchar) END AS double) AS number FROM part""")
def _(spark, d):
    k = F.col("p_partkey") % 3
    text = F.when(k == 0, F.col("p_name")).when(k == 1, F.col("p_retailprice").cast("string"))
    return views.table(spark, d, "part").select("p_partkey", S.to_number(text).alias("number"))


@query("fill_for_preparation", """SELECT "productId", coalesce(title, 'Untitled') AS title, price,
    coalesce(brand, 'Unknown') AS brand, coalesce(category, 'Unknown') AS category,
    coalesce(description, '') AS description FROM P""", "P")
def _(spark, d):
    return prepare.fill_prepared(views.products(spark, d))


@query("fill_for_catalog", """SELECT "productId", coalesce(title, 'Unknown Title') AS title,
    coalesce(price, 0.0) AS price, coalesce(brand, 'Unknown') AS brand,
    coalesce(category, 'Unknown') AS category, coalesce(description, '') AS description FROM P""", "P")
def _(spark, d):
    return prepare.fill_catalog(views.products(spark, d))


@query("rating_range_filter", """SELECT l_orderkey, l_linenumber, l_quantity AS rating FROM lineitem
    WHERE l_quantity BETWEEN 1 AND 5""")
def _(spark, d):
    lines = views.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber",
                                                     F.col("l_quantity").alias("rating"))
    return ingest.rating_in_range(lines)


@query("required_keys_filter", """SELECT "productId", category FROM P WHERE category IS NOT NULL""", "P")
def _(spark, d):
    return ingest.require_keys(views.products(spark, d).select("productId", "category"),
                               "productId", "category")


@query("time_window_filter", f"""SELECT {_KEYS} FROM R WHERE "timestamp" BETWEEN {TS_MIN} AND {TS_MAX}""", "R")
def _(spark, d):
    return prepare.in_time_window(views.ratings(spark, d))


@query("exact_row_distinct", f"SELECT DISTINCT {_KEYS} FROM R", "R")
def _(spark, d):
    return prepare.drop_exact_duplicates(views.ratings(spark, d))


@query("highest_rating_per_pair", f"SELECT {_KEYS} FROM HIGHEST", "HIGHEST")
def _(spark, d):
    return prepare.keep_highest_rating(views.ratings(spark, d))


@query("clean_ratings", f"SELECT {_KEYS} FROM CR", "CR")
def _(spark, d):
    return prepare.clean_ratings(views.ratings(spark, d))


@query("price_imputation", """SELECT "productId", price, category FROM IMPUTED""", "IMPUTED")
def _(spark, d):
    products = views.products(spark, d).select("productId", "price", "category")
    return prepare.impute_prices(products)


def _quantiles(top, digits):
    """Interpolation is rounded: engines differ in its last bit."""
    return "SELECT " + ", ".join(f"{rnd(f'quantile_cont(x, {p})', digits)} AS {name}" for p, name in (
        (0.05, "q05"), (0.5, "q50"), (top, "q_top"))) + " FROM ("


def _rounded(found, digits):
    return found.select(*[S.half_even(c, digits).alias(c) for c in found.columns])


@query("quantiles_of_narrow_range", _quantiles(0.999, 12) + """
    SELECT 1 + l_orderkey * 1e-9 + l_linenumber * 1e-12 AS x FROM lineitem)""")
def _(spark, d):
    x = F.lit(1) + F.col("l_orderkey") * F.lit(1e-9) + F.col("l_linenumber") * F.lit(1e-12)
    return _rounded(exact_quantiles(views.table(spark, d, "lineitem"), x, {"q05": 0.05, "q50": 0.5, "q_top": 0.999}), 12)


@query("quantiles_with_infinity", _quantiles(0.985, 6) + """
    SELECT CASE WHEN l_orderkey % 100 = 0 THEN 'Infinity'::DOUBLE WHEN l_orderkey % 100 = 1 THEN '-Infinity'::DOUBLE
    ELSE l_extendedprice END AS x FROM lineitem)""")
def _(spark, d):
    kind = F.col("l_orderkey") % 100
    x = F.when(kind == 0, float("inf")).when(kind == 1, float("-inf")).otherwise(F.col("l_extendedprice"))
    return _rounded(exact_quantiles(views.table(spark, d, "lineitem"), x, {"q05": 0.05, "q50": 0.5, "q_top": 0.985}), 6)


@query("quantiles_by_part", """SELECT l_partkey AS part, median(l_extendedprice) AS m FROM lineitem GROUP BY 1""")
def _(spark, d):
    return exact_quantiles(views.table(spark, d, "lineitem").withColumnRenamed("l_partkey", "part"), "l_extendedprice",
                           {"m": 0.5}, ["part"])


@query("clean_products", """SELECT "productId", title, price, brand, category, description FROM CP""", "CP")
def _(spark, d):
    return prepare.clean_products(views.products(spark, d))


@query("first_row_per_product", """SELECT "productId", title, price, brand FROM (
    SELECT *, row_number() OVER (PARTITION BY "productId" ORDER BY
      (title IS NULL)::int + (price IS NULL)::int + (brand IS NULL)::int,
      title NULLS LAST, price NULLS LAST, brand NULLS LAST) AS n
    FROM (SELECT "productId", title, price, brand FROM P UNION ALL
          SELECT p_brand, p_name, p_retailprice, NULL FROM part)) WHERE n = 1""", "P")
def _(spark, d):
    columns = ["productId", "title", "price", "brand"]
    part = views.table(spark, d, "part").select(
        F.col("p_brand").alias("productId"), F.col("p_name").alias("title"),
        F.col("p_retailprice").alias("price"), F.lit(None).cast("string").alias("brand"))
    return ingest.first_per_product(views.products(spark, d).select(*columns).unionByName(part))


@query("item_rating_stats", 'SELECT "productId", rating_count, avg_rating FROM STATS', "STATS")
def _(spark, d):
    return prepare.item_rating_stats(views.ratings(spark, d))


@query("enriched_products", """SELECT "productId", title, price, brand, category, description, rating_count,
    avg_rating FROM EP""", "EP")
def _(spark, d):
    return prepare.enrich_products(T.cleaned_products(spark, d),
                                   prepare.item_rating_stats(views.ratings(spark, d)))


@query("enrichment_without_stats", """SELECT "productId", 0::BIGINT AS rating_count, 0.0::DOUBLE AS avg_rating
    FROM P""", "P")
def _(spark, d):
    return prepare.enrich_products(views.products(spark, d).select("productId"))


@query("enrichment_coverage", f"""SELECT count(*) AS n_products, count(*) FILTER (rating_count > 1) AS n_rated,
    {rnd('count(*) FILTER (rating_count > 1) * 100.0::DOUBLE / count(*)', 1)} AS pct_rated,
    {rnd('avg(avg_rating) FILTER (avg_rating > 0)', 2)} AS avg_rating_rated FROM (
      SELECT P."productId", CASE WHEN c > 6 THEN c ELSE 0 END AS rating_count,
      CASE WHEN c > 6 THEN a ELSE 0 END AS avg_rating
      FROM P LEFT JOIN (SELECT "productId", count(rating) AS c, {rnd('avg(rating)', 2)} AS a FROM CR GROUP BY 1) s
      ON P."productId" = s."productId")""", "P", "CR")
def _(spark, d):
    stats = prepare.item_rating_stats(T.cleaned_ratings(spark, d)).where("rating_count > 6")
    return prepare.enrichment_coverage(prepare.enrich_products(
        views.products(spark, d).select("productId"), stats))


@query("stage_totals", """SELECT count(*) AS n_ratings, count(DISTINCT "userId") AS n_users,
    count(DISTINCT "productId") AS n_items FROM CR""", "CR")
def _(spark, d):
    return ingest.stage_totals(T.cleaned_ratings(spark, d))


@query("most_active_user_rows", f"""SELECT {_KEYS} FROM R WHERE "userId" IN (
    SELECT "userId" FROM R GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 100)""", "R")
def _(spark, d):
    return ingest.keep_top_users(views.ratings(spark, d), 100)


@query("top_users_by_activity", """SELECT "userId", count(*) AS n_ratings FROM R GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 10000""", "R")
def _(spark, d):
    return ingest.top_users(views.ratings(spark, d), 10_000)
