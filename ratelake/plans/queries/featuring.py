"""Feature tables and their parts."""

from ratelake.functions import scalar as S
from ratelake.operators import features, store
from ratelake.plans import tables as T
from ratelake.plans.registry import query
from ratelake.plans.sql import rnd
from ratelake.sources import tables as stored, views


@query("user_features", "SELECT * FROM UF", "UF")
def user_features(spark, d):
    return features.user_features(T.cleaned_ratings(spark, d), T.product_facts(spark, d))


@query("user_category_diversity", 'SELECT "userId", user_category_diversity FROM DIVERSITY', "DIVERSITY")
def _(spark, d):
    return features.category_diversity(T.cleaned_ratings(spark, d), T.product_facts(spark, d))


@query("item_features", 'SELECT * FROM "IF"', "IF")
def _(spark, d):
    base = T.once(spark, d, "item_base", lambda: features.item_base(
        T.cleaned_ratings(spark, d), T.product_facts(spark, d)))
    return features.encode_items(base)


@query("item_features_enriched", """SELECT i.*, cast(coalesce(rating_count, 0) AS int) AS api_rating_count,
    coalesce(avg_rating, 0.0) AS api_avg_rating FROM "IF" i LEFT JOIN EP ON i."productId" = EP."productId" """,
       "IF", "EP")
def _(spark, d):
    base = T.once(spark, d, "item_base_enriched", lambda: features.item_base(
        T.cleaned_ratings(spark, d), T.enriched_products(spark, d)))
    return features.encode_items(base)


@query("item_catalog_join", f"""SELECT "productId", item_rating_count, {rnd('item_avg_rating', 4)}
    AS item_avg_rating, {rnd('item_rating_std', 4)} AS item_rating_std, item_unique_users, {rnd('price', 4)} AS price,
    category, brand FROM IB""", "IB")
def _(spark, d):
    return features.round_doubles(features.item_base(
        T.cleaned_ratings(spark, d), T.product_facts(spark, d)))


@query("interaction_features", "SELECT * FROM INTER", "INTER")
def _(spark, d):
    return features.interaction_features(T.cleaned_ratings(spark, d), T.item_features(spark, d))


@query("cooccurrence_top3", "SELECT * FROM COOC", "COOC")
def _(spark, d):
    return features.cooccurrence(T.cleaned_ratings(spark, d))


@query("cooccurrence_wide", """SELECT "productId", "co_productId", cooc_score FROM (
    SELECT a."productId", b."productId" AS "co_productId", cast(count(*) AS double) AS cooc_score
    FROM (SELECT DISTINCT "userId", "productId" FROM R) a JOIN (SELECT DISTINCT "userId", "productId" FROM R) b
    ON a."userId" = b."userId" AND a."productId" <> b."productId"
    WHERE a."productId" IN (SELECT "productId" FROM R GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 700)
    AND b."productId" IN (SELECT "productId" FROM R GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 700)
    GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY "productId" ORDER BY cooc_score DESC, "co_productId") <= 10""", "R")
def _(spark, d):
    return features.cooccurrence(views.ratings(spark, d), top_n=700, keep=10)


@query("category_encoding", "SELECT v AS category, code AS category_encoded FROM CATCODE", "CATCODE")
def _(spark, d):
    return features.label_encoding(T.item_features(spark, d), "category")


@query("title_encoding", """SELECT title, cast(row_number() OVER (ORDER BY title) - 1 AS int) AS title_encoded
    FROM (SELECT DISTINCT title FROM P)""", "P")
def _(spark, d):
    return features.label_encoding(views.products(spark, d), "title")


@query("item_id_positions", """SELECT "productId", row_number() OVER (ORDER BY "productId") - 1 AS position
    FROM (SELECT DISTINCT "productId" FROM R)""", "R")
def _(spark, d):
    from ratelake.operators.quantiles import dense_index
    return dense_index(views.ratings(spark, d).select("productId").distinct(), "productId", "position")


@query("price_scaling", f"""SELECT "productId", {rnd('(price - lo) / nullif(hi - lo, 0)', 4)} AS price_normalized
    FROM CP, (SELECT min(price) AS lo, max(price) AS hi FROM CP)""", "CP")
def _(spark, d):
    return features.scale_min_max(T.product_facts(spark, d), "price", "price_normalized") \
        .select("productId", "price_normalized")


@query("rating_scaling", f"""SELECT "userId", "productId", "timestamp", {rnd('(rating - 1) / 4', 4)}
    AS rating_normalized, "timestamp" // 86400 AS days_since_epoch FROM R""", "R")
def _(spark, d):
    return views.ratings(spark, d).select(
        "userId", "productId", "timestamp", S.scale_rating("rating").alias("rating_normalized"),
        S.day_number("timestamp").alias("days_since_epoch"))


@query("ratings_with_category", """SELECT "userId", CR."productId", category FROM CR LEFT JOIN CP
    ON CR."productId" = CP."productId" """, "CR", "CP")
def _(spark, d):
    return T.cleaned_ratings(spark, d).select("userId", "productId").join(
        T.product_facts(spark, d).select("productId", "category"), "productId", "left")


@query("popular_items_500", """SELECT "productId", count(*) AS n_ratings FROM CR GROUP BY 1
    ORDER BY 2 DESC, 1 LIMIT 500""", "CR")
def _(spark, d):
    return features.popular_items(T.cleaned_ratings(spark, d), 500)


@query("popular_item_rows", """SELECT "userId", "productId", rating, "timestamp" FROM CR WHERE "productId" IN
    (SELECT "productId" FROM TOPITEMS)""", "CR", "TOPITEMS")
def _(spark, d):
    return features.in_popular(T.cleaned_ratings(spark, d), 500)


@query("distinct_item_keys", 'SELECT DISTINCT "productId" FROM CR', "CR")
def _(spark, d):
    return T.cleaned_ratings(spark, d).select("productId").distinct()


def _feature_tables(spark, d):
    return {"user_features": T.user_features(spark, d), "item_features": T.item_features(spark, d),
            "interaction_features": T.interaction_features(spark, d), "cooccurrence": T.cooccurrence(spark, d)}


@query("feature_table_counts", """SELECT 'user_features' AS table_name, (SELECT count(*) FROM UF) AS n_rows
    UNION ALL SELECT 'item_features', (SELECT count(*) FROM "IF")
    UNION ALL SELECT 'interaction_features', (SELECT count(*) FROM INTER)
    UNION ALL SELECT 'cooccurrence', (SELECT count(*) FROM COOC)""", "UF", "IF", "INTER", "COOC")
def _(spark, d):
    return store.table_counts(_feature_tables(spark, d))


@query("feature_registry_totals", """SELECT 'user_features' AS feature_set, 6 AS n_features,
    (SELECT count(*) FROM UF) AS n_records, 'cleaned_ratings,cleaned_products' AS source, 'ratings' AS dataset,
    '2026-01-01' AS created_at
    UNION ALL SELECT 'item_features', 10, (SELECT count(*) FROM "IF"), 'cleaned_ratings,cleaned_products', 'ratings', '2026-01-01'
    UNION ALL SELECT 'interaction_features', 5, (SELECT count(*) FROM INTER), 'cleaned_ratings,item_features', 'ratings',
      '2026-01-01'
    UNION ALL SELECT 'cooccurrence', 1, (SELECT count(*) FROM COOC), 'cleaned_ratings', 'ratings', '2026-01-01'""",
       "UF", "IF", "INTER", "COOC")
def _(spark, d):
    return stored.registry_totals(_feature_tables(spark, d), created_at="2026-01-01")


def _registry_sql():
    from ratelake import schemas
    rows = ", ".join("('{}', '{}', '{}', '{}', {})".format(
        name, f.name, f.dataType.simpleString(), stored.DESCRIPTIONS[f.name].replace("'", "''"),
        f"'{stored.ENCODERS[f.name][1]}'" if f.name in stored.ENCODERS else "NULL")
        for name, schema in schemas.FEATURE_TABLES.items() for f in schema.fields)
    return f"""SELECT feature_set, "column", type, description, encoder,
        CASE "column" WHEN 'category_encoded' THEN (SELECT count(*) FROM CATCODE)
        WHEN 'brand_encoded' THEN (SELECT count(*) FROM BRANDCODE) END AS n_classes
        FROM (VALUES {rows}) t(feature_set, "column", type, description, encoder)"""


@query("feature_registry", _registry_sql(), "CATCODE", "BRANDCODE")
def _(spark, d):
    return stored.feature_registry(_feature_tables(spark, d))


@query("encoder_sample_classes", """SELECT 'category' AS encoder, v AS "class", code FROM CATCODE WHERE code < 5
    UNION ALL SELECT 'brand', v, code FROM BRANDCODE WHERE code < 5""", "CATCODE", "BRANDCODE")
def _(spark, d):
    return stored.sample_classes(T.item_features(spark, d))


@query("version_registration", """SELECT 1::BIGINT AS version_id, 'v1.0' AS version_tag,
    'user_features,item_features,interaction_features,cooccurrence' AS feature_set,
    (SELECT count(*) FROM UF) AS n_users, (SELECT count(*) FROM "IF") AS n_items,
    (SELECT count(*) FROM INTER) AS n_interactions, 'ratings' AS dataset, '2026-01-01' AS created_at,
    'first' AS notes""", "UF", "IF", "INTER")
def _(spark, d):
    from ratelake import schemas
    empty = spark.createDataFrame([], schemas.VERSIONS)
    return stored.version_row(_feature_tables(spark, d), empty, "v1.0", "first", created_at="2026-01-01")
