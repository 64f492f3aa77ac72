"""Exploration."""

from pyspark.sql import functions as F

from ratelake.functions import scalar as S
from ratelake.operators import explore, quality, store
from ratelake.plans import tables as T
from ratelake.plans.registry import query
from ratelake.plans.sql import rnd
from ratelake.sources import views

_DATED = """SELECT *, DATE '1970-01-01' + cast("timestamp" // 86400 AS int) AS "date" FROM CR"""


@query("calendar_parts", f"""SELECT "userId", "productId", rating, "timestamp", "date",
    cast(year("date") AS int) AS "year", cast(month("date") AS int) AS "month" FROM ({_DATED})""", "CR")
def _(spark, d):
    return explore.calendar(T.cleaned_ratings(spark, d))


@query("event_calendar_parts", """SELECT event_id, cast(ts AS date) AS "date", cast(year(ts) AS int) AS "year",
    cast(month(ts) AS int) AS "month" FROM events""")
def _(spark, d):
    events = views.table(spark, d, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"))
    return explore.calendar(events).drop("timestamp")


@query("ratings_per_year", f'SELECT cast(year("date") AS int) AS "year", count(*) AS n FROM ({_DATED}) GROUP BY 1', "CR")
def _(spark, d):
    return explore.ratings_per_year(T.cleaned_ratings(spark, d))


_MONTHS = f"""SELECT cast(year("date") AS int) AS "year", cast(month("date") AS int) AS "month", count(*) AS n,
    cast(date_trunc('month', "date") AS date) AS period FROM ({_DATED}) GROUP BY 1, 2, 4"""


@query("ratings_per_month", _MONTHS, "CR")
def _(spark, d):
    return explore.ratings_per_month(T.cleaned_ratings(spark, d))


@query("peak_month", f"SELECT period, n FROM ({_MONTHS}) ORDER BY n DESC, period LIMIT 1", "CR")
def _(spark, d):
    return explore.peak_month(T.cleaned_ratings(spark, d))


@query("user_activity", f"""SELECT cast(count(*) AS bigint) AS n_users, {rnd('avg(n)', 1)} AS mean_ratings,
    max(n) AS max_ratings, count(*) FILTER (n < 5) AS users_below,
    {rnd('count(*) FILTER (n < 5) * 100.0::DOUBLE / count(*)', 1)} AS pct_below, median(n) AS median_ratings
    FROM (SELECT count(*) AS n FROM CR GROUP BY "userId")""", "CR")
def _(spark, d):
    return explore.user_activity(T.cleaned_ratings(spark, d))


@query("item_popularity", """SELECT count(*) AS n_items, count(*) FILTER (n = 1) AS items_with_one,
    median(n) AS median_ratings FROM (SELECT count(*) AS n FROM CR GROUP BY "productId")""", "CR")
def _(spark, d):
    return explore.item_popularity(T.cleaned_ratings(spark, d))


@query("head_share", f"""SELECT cast(floor(count(*) * 0.1) AS bigint) AS head_items,
    cast(sum(n) FILTER (rk <= floor(items * 0.1)) AS bigint) AS head_ratings,
    {rnd('sum(n) FILTER (rk <= floor(items * 0.1)) * 100.0::DOUBLE / sum(n)', 1)} AS pct_of_ratings FROM (
    SELECT n, row_number() OVER (ORDER BY n DESC, "productId") AS rk, count(*) OVER () AS items
    FROM (SELECT "productId", count(*) AS n FROM CR GROUP BY 1))""", "CR")
def _(spark, d):
    return explore.head_share(T.cleaned_ratings(spark, d))


@query("popularity_curve", """SELECT cast(row_number() OVER (ORDER BY n DESC, "productId") - 1 AS int) AS rank,
    "productId", n
    FROM (SELECT "productId", count(*) AS n FROM CR GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 500)""", "CR")
def _(spark, d):
    return explore.popularity_curve(T.cleaned_ratings(spark, d))


@query("most_active_users", """SELECT "userId", count(*) AS n FROM CR GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""", "CR")
def _(spark, d):
    return explore.most_active_users(T.cleaned_ratings(spark, d))


def _histogram_sql(source, bins):
    return f"""SELECT cast(least(floor((x - lo) * {bins}.0::DOUBLE / (hi - lo)), {bins - 1}) AS int) AS bin,
        {rnd(f'lo + least(floor((x - lo) * {bins}.0::DOUBLE / (hi - lo)), {bins - 1}) * (hi - lo) / {bins}.0::DOUBLE', 4)}
        AS bin_start, count(*) AS n FROM ({source}) v,
        (SELECT min(x) AS lo, max(x) AS hi FROM ({source})) GROUP BY 1, 2"""


@query("user_activity_histogram", _histogram_sql(
    'SELECT count(*)::DOUBLE AS x FROM CR GROUP BY "userId"', 50), "CR")
def _(spark, d):
    return explore.activity_histogram(T.cleaned_ratings(spark, d))


@query("item_popularity_histogram", _histogram_sql(
    'SELECT count(*)::DOUBLE AS x FROM CR GROUP BY "productId"', 60), "CR")
def _(spark, d):
    return explore.popularity_histogram(T.cleaned_ratings(spark, d))


@query("price_histogram", _histogram_sql(
    "SELECT price AS x FROM CP WHERE price < (SELECT quantile_cont(price, 0.95) FROM CP)", 40), "CP")
def _(spark, d):
    products = T.product_facts(spark, d)
    return explore.price_histogram(products)


@query("event_value_histogram", _histogram_sql("SELECT value AS x FROM events", 40))
def _(spark, d):
    return explore.histogram(views.table(spark, d, "events"), "value", 40)


@query("prices_below_p95", """SELECT "productId", price FROM CP
    WHERE price < (SELECT quantile_cont(price, 0.95) FROM CP)""", "CP")
def _(spark, d):
    return explore.below_p95(T.product_facts(spark, d).select("productId", "price"))


@query("top_product_categories", """SELECT category, count(*) AS n FROM CP GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
       "CP")
def _(spark, d):
    return quality.top_values(T.product_facts(spark, d), "category", 15)


@query("ratings_with_product", """SELECT "userId", CR."productId", rating, price, category, brand FROM CR
    LEFT JOIN CP ON CR."productId" = CP."productId" """, "CR", "CP")
def _(spark, d):
    return explore.with_product(T.cleaned_ratings(spark, d), T.product_facts(spark, d)).drop("timestamp")


_SPREAD = "(p_partkey * 7 % 271)::DOUBLE"
_BUCKET = """CASE WHEN x > 0 AND x <= 10 THEN '<$10' WHEN x > 10 AND x <= 25 THEN '$10-25'
    WHEN x > 25 AND x <= 50 THEN '$25-50' WHEN x > 50 AND x <= 100 THEN '$50-100'
    WHEN x > 100 THEN '$100-200' END"""


def _spread_prices(spark, d):
    """Part keys spread over 0..270 as prices, so that every bucket and edge occurs."""
    part = views.table(spark, d, "part")
    return part.select(F.col("p_partkey").cast("string").alias("productId"),
                       (F.col("p_partkey") * 7 % 271).cast("double").alias("price"),
                       F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))


@query("price_buckets", f"""SELECT cast(p_partkey AS varchar) AS "productId",
    least(greatest(x, 0.0), 200.0) AS clipped, {_BUCKET} AS price_bucket
    FROM (SELECT p_partkey, {_SPREAD} AS x FROM part)""")
def _(spark, d):
    return _spread_prices(spark, d).select("productId", S.clip("price", 0, 200).alias("clipped"),
                                           S.price_bucket("price").alias("price_bucket"))


@query("rating_by_price_bucket", f"""SELECT CASE price_bucket WHEN '<$10' THEN 0 WHEN '$10-25' THEN 1
    WHEN '$25-50' THEN 2 WHEN '$50-100' THEN 3 ELSE 4 END AS bucket_order, price_bucket,
    {rnd('avg(rating)', 4)} AS avg_rating, count(rating) AS n FROM (SELECT rating, {_BUCKET} AS price_bucket
    FROM CR JOIN (SELECT cast(p_partkey AS varchar) AS k, {_SPREAD} AS x FROM part) ON k = "productId")
    WHERE price_bucket IS NOT NULL GROUP BY 1, 2""", "CR")
def _(spark, d):
    return explore.rating_by_price(T.cleaned_ratings(spark, d), _spread_prices(spark, d))


_CATEGORY = f"""SELECT category, {rnd('avg(rating)', 4)} AS avg_rating, count(rating) AS n FROM CR
    JOIN CP ON CR."productId" = CP."productId" GROUP BY 1"""


@query("category_ratings", _CATEGORY, "CR", "CP")
def _(spark, d):
    return explore.category_ratings(T.cleaned_ratings(spark, d), T.product_facts(spark, d))


@query("best_rated_categories", f"SELECT * FROM ({_CATEGORY}) WHERE n >= 100 ORDER BY avg_rating DESC, category LIMIT 10",
       "CR", "CP")
def _(spark, d):
    return explore.best_categories(T.cleaned_ratings(spark, d), T.product_facts(spark, d))


def _top_sql(key, name, n=200):
    return f"""(SELECT "{key}" AS k, cast(row_number() OVER (ORDER BY count(*) DESC, "{key}") - 1 AS int) AS {name}
        FROM CR GROUP BY 1 QUALIFY {name} < {n})"""


@query("top_user_positions", f"""SELECT k AS "userId", u_idx FROM {_top_sql('userId', 'u_idx')}""", "CR")
def _(spark, d):
    return explore.top_keys(T.cleaned_ratings(spark, d), "userId", 200, "u_idx")


@query("head_rows", f"""SELECT "userId", "productId", rating, "timestamp" FROM CR
    JOIN {_top_sql('userId', 'u_idx')} u ON u.k = "userId"
    JOIN {_top_sql('productId', 'i_idx')} i ON i.k = "productId" """, "CR")
def _(spark, d):
    return explore.head_rows(T.cleaned_ratings(spark, d))


@query("head_matrix", f"""SELECT u_idx, i_idx, rating FROM CR JOIN {_top_sql('userId', 'u_idx')} u ON u.k = "userId"
    JOIN {_top_sql('productId', 'i_idx')} i ON i.k = "productId" """, "CR")
def _(spark, d):
    return explore.head_matrix(T.cleaned_ratings(spark, d))


@query("head_sparsity", f"""SELECT count(*) AS n_cells, {rnd('(1 - count(*) / 40000.0::DOUBLE) * 100', 4)}
    AS sparsity_pct FROM CR JOIN {_top_sql('userId', 'u_idx')} u ON u.k = "userId"
    JOIN {_top_sql('productId', 'i_idx')} i ON i.k = "productId" """, "CR")
def _(spark, d):
    return explore.head_sparsity(T.cleaned_ratings(spark, d))


def _pivot_sql(cell):
    cells = ", ".join(f"{cell.format(i=i)} AS item_{i}" for i in range(10))
    return f"""SELECT "userId", {cells} FROM CR JOIN {_top_sql('productId', 'p', 10)} t ON t.k = "productId"
        GROUP BY 1"""


@query("user_item_pivot", _pivot_sql("coalesce(" + rnd("avg(CASE WHEN p = {i} THEN rating END)", 4) + ", 0.0)"), "CR")
def _(spark, d):
    return explore.user_item_pivot(T.cleaned_ratings(spark, d))


@query("user_item_pivot_binary", _pivot_sql("cast(count(CASE WHEN p = {i} THEN 1 END) > 0 AS int)"), "CR")
def _(spark, d):
    return explore.user_item_pivot(T.cleaned_ratings(spark, d), binary=True)


def _describe_sql(table, columns):
    return "\nUNION ALL ".join(f"""SELECT '{c}' AS "column", count("{c}") AS "count",
        {rnd(f'avg("{c}")', 4)} AS "mean", {rnd(f'stddev_samp("{c}")', 4)} AS std,
        {rnd(f'min("{c}")::DOUBLE', 4)} AS "min", {rnd(f'quantile_cont("{c}"::DOUBLE, 0.25)', 4)} AS p25,
        {rnd(f'quantile_cont("{c}"::DOUBLE, 0.5)', 4)} AS p50, {rnd(f'quantile_cont("{c}"::DOUBLE, 0.75)', 4)} AS p75,
        {rnd(f'max("{c}")::DOUBLE', 4)} AS "max" FROM {table}""" for c in columns)


@query("describe_ratings", _describe_sql("R", ["rating", "timestamp"]), "R")
def _(spark, d):
    return store.describe(views.ratings(spark, d))


@query("describe_user_features", _describe_sql("UF", [
    "user_rating_count", "user_avg_rating", "user_rating_std", "user_unique_items", "user_recency_days",
    "user_category_diversity"]), "UF")
def _(spark, d):
    return store.describe_table({"user_features": T.user_features(spark, d)}, "user_features")


@query("describe_interactions", _describe_sql("INTER", [
    "rating", "timestamp", "rating_normalized", "days_since_epoch", "user_item_rating_diff"]), "INTER")
def _(spark, d):
    return store.describe_table({"interaction_features": T.interaction_features(spark, d)}, "interaction_features")
