"""Stored tables, models and logs: each query writes through the library and returns what it reads back."""

from pyspark.sql import functions as F

from ratelake.functions import scalar as S
from ratelake.operators import factors, ranking, store
from ratelake.plans import batch, tables as T
from ratelake.plans.queries.recommending import _model, _neighbours, _offsets, _predictions
from ratelake.plans.queries.validating import _CHECKS_SQL
from ratelake.plans.registry import ORACLES, query
from ratelake.plans.sql import rnd
from ratelake.session import scratch_path, stage
from ratelake.sources import models, raw, tables as stored, views


@query("file_checksums", """SELECT sum(length(p_name || '|' || p_brand) + 1)::BIGINT AS size_bytes,
    md5(string_agg(p_name || '|' || p_brand || chr(10), '' ORDER BY p_partkey)) AS md5 FROM part GROUP BY p_partkey % 16""")
def _(spark, d):
    path = scratch_path(spark, "files")
    (views.table(spark, d, "part").withColumn("folder", F.col("p_partkey") % 16)
     .repartition("folder").sortWithinPartitions("folder", "p_partkey")
     .select("folder", F.concat_ws("|", "p_name", "p_brand").alias("value"))
     .write.partitionBy("folder").text(path))
    return raw.file_checksums(spark, f"{path}/folder=*").drop("file")


def _stored_features(spark, d):
    root = scratch_path(spark, "features")
    stored.write_features({"user_features": T.user_features(spark, d), "item_features": T.item_features(spark, d),
                           "interaction_features": T.interaction_features(spark, d),
                           "cooccurrence": T.cooccurrence(spark, d)}, root)
    return root


@query("stored_interaction_features", "SELECT * FROM INTER", "INTER")
def _(spark, d):
    return stored.read_features(spark, _stored_features(spark, d))["interaction_features"]


@query("stored_item_features", 'SELECT * FROM "IF"', "IF")
def _(spark, d):
    return stored.read_features(spark, _stored_features(spark, d))["item_features"]


@query("stored_registry_of_one_set", f"""SELECT * FROM ({ORACLES['feature_registry']})
    WHERE feature_set = 'item_features'""")
def _(spark, d):
    root = _stored_features(spark, d)
    stored.write_registry(stored.read_features(spark, root), root)
    return stored.read_registry(spark, root, "item_features")


@query("version_list", """SELECT version_id, version_tag, (SELECT count(*) FROM UF) AS n_users,
    (SELECT count(*) FROM "IF") AS n_items, (SELECT count(*) FROM INTER) AS n_interactions, notes
    FROM (VALUES (1::BIGINT, 'v1', 'one'), (2, 'v2', 'two'), (3, 'v3', '')) t(version_id, version_tag, notes)""",
       "UF", "IF", "INTER")
def _(spark, d):
    root = _stored_features(spark, d)
    for tag, notes in (("v1", "one"), ("v2", "two"), ("v3", "")):
        stored.register_version(spark, root, tag, notes)
    return stored.list_versions(spark, root).select(
        "version_id", "version_tag", "n_users", "n_items", "n_interactions", "notes")


@query("stored_neighbours", 'SELECT "productId", "other_productId", similarity, rank FROM NEIGHBOURS', "NEIGHBOURS")
def _(spark, d):
    root = scratch_path(spark, "models")
    models.save_neighbours(_neighbours(spark, d), root)
    return models.load_neighbours(spark, root)


@query("stored_factors_score_the_same", 'SELECT "userId", "productId", true AS same FROM CR', "CR")
def _(spark, d):
    root, model, pairs = scratch_path(spark, "models"), _model(spark, d), T.cleaned_ratings(spark, d)
    models.save_factors(model, root)
    again = factors.predict_factors(pairs, models.load_factors(spark, root)).withColumnRenamed("prediction", "again")
    return factors.predict_factors(pairs, model).join(again.select("userId", "productId", "again"), ["userId", "productId"]) \
        .select("userId", "productId", F.col("prediction").eqNullSafe(F.col("again")).alias("same"))


@query("run_log", f"""SELECT 'offsets' AS model, '42' AS seed,
    {rnd('sqrt(avg((rating - prediction) * (rating - prediction)))', 4)} AS rmse,
    {rnd('avg(abs(rating - prediction))', 4)} AS mae FROM PRED""", "PRED")
def _(spark, d):
    root = scratch_path(spark, "runs")
    measures = ranking.errors(_predictions(spark, d)).first().asDict()
    stored.log_run(spark, root, "offsets", {"seed": 42}, measures)
    return stored.read_table(spark, root, "runs").select(
        "model", F.col("params")["seed"].alias("seed"), F.col("metrics")["rmse"].alias("rmse"),
        F.col("metrics")["mae"].alias("mae"))


@query("stored_check_results", f"""SELECT dataset, "check", passed FROM ({_CHECKS_SQL})
    UNION ALL SELECT dataset, expectation, passed FROM ({ORACLES['rating_expectations']})
    UNION ALL SELECT dataset, expectation, passed FROM ({ORACLES['product_expectations']})""", "R", "P")
def _(spark, d):
    root = scratch_path(spark, "checks")
    return batch.validate(views.ratings(spark, d), views.products(spark, d), root).drop("detail")


@query("first_user_features", 'SELECT * FROM UF ORDER BY "userId" LIMIT 100', "UF")
def _(spark, d):
    return store.user_features_of(T.user_features(spark, d), limit=100)


# -- a mixed raw file: every line ends as a rating, a dropped record or a quarantined line --------------

# One expression for both engines; the last two forms differ in the time stamp only.
_MIXED = """CASE l_orderkey % 7
    WHEN 0 THEN '{"user_id": "' || cast(o_custkey AS varchar(20)) || '", broken'
    WHEN 1 THEN '{"user_id": "' || cast(o_custkey AS varchar(20)) || '", "parent_asin": "1", "rating": "five", "timestamp": 1}'
    WHEN 2 THEN '{"user_id": "' || cast(o_custkey AS varchar(20)) || '", "rating": 3, "timestamp": 1}'
    ELSE '{"user_id": "' || cast(o_custkey AS varchar(20)) || '", "parent_asin": "' || cast(l_partkey AS varchar(20))
      || '", "rating": ' || cast(cast(l_quantity AS int) % 7 AS varchar(20)) || ', "timestamp": '
      || CASE WHEN l_orderkey % 7 = 3 THEN '"' || cast(cast(l_shipdate AS date) AS varchar(20)) || 'T13:42:08Z"'
         ELSE cast(DAYS * 86400000 AS varchar(20)) END || '}' END"""
_DAYS = "cast(datediff('day', DATE '1970-01-01', cast(l_shipdate AS date)) AS bigint)"
_LINES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
_MIXED_PRODUCTS = """CASE WHEN p_partkey % 5 = 0 THEN '{broken ' || p_name
    ELSE '{"parent_asin": "' || cast(p_partkey AS varchar(20)) || '", "title": "' || p_name || '"}' END"""


def _mixed_ingest(spark, d):
    lines = views.table(spark, d, "lineitem").join(
        views.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    days = "cast(unix_date(cast(l_shipdate AS date)) AS bigint)"
    root = scratch_path(spark, "mixed")
    lines.selectExpr(_MIXED.replace("DAYS", days) + " AS value").write.text(f"{root}/lines")
    views.table(spark, d, "part").selectExpr(_MIXED_PRODUCTS + " AS value").write.text(f"{root}/products")
    return root, batch.ingest_all(spark, root, f"{root}/lines", f"{root}/products", ingest_ts="20260101_000000")


@query("mixed_lines_ingest", f"""SELECT cast(o_custkey AS varchar) AS "userId", cast(l_partkey AS varchar) AS "productId",
    cast(cast(l_quantity AS int) % 7 AS double) AS rating,
    {_DAYS} * 86400 + CASE WHEN l_orderkey % 7 = 3 THEN 13 * 3600 + 42 * 60 + 8 ELSE 0 END AS "timestamp"
    {_LINES} WHERE l_orderkey % 7 > 2 AND cast(l_quantity AS int) % 7 BETWEEN 1 AND 5""")
def _(spark, d):
    return _mixed_ingest(spark, d)[1]["ratings"]


@query("mixed_lines_quarantine", f"""SELECT 'ratings' AS source, {_MIXED.replace("DAYS", _DAYS)} AS line
    {_LINES} WHERE l_orderkey % 7 < 2
    UNION ALL SELECT 'products', '{{broken ' || p_name FROM part WHERE p_partkey % 5 = 0""")
def _(spark, d):
    return stored.read_table(spark, _mixed_ingest(spark, d)[0], "quarantine").select("source", "line")


@query("mixed_products_ingest", """SELECT cast(p_partkey AS varchar) AS "productId", p_name AS title
    FROM part WHERE p_partkey % 5 <> 0""")
def _(spark, d):
    return _mixed_ingest(spark, d)[1]["products"].select("productId", "title")


# -- given vectors as factors, so that SQL can repeat the scores ------------------------------------------


def _vectors_as_factors(spark, d):
    vectors = views.table(spark, d, "embeddings")
    key = F.col("vec_id").cast("string")
    return (stage(vectors.select(key.alias("userId"), F.col("embedding").alias("user_factors")), "user_factors"),
            stage(vectors.select(key.alias("productId"), F.col("embedding").alias("item_factors")), "item_factors"))


_DOT = "coalesce(list_dot_product(a.v, b.v), 0.0)"
_VECTORS = "(SELECT cast(vec_id AS varchar) AS id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
_SCORE = f"least(greatest((SELECT mu FROM MU) + coalesce(user_offset, 0) + coalesce(item_offset, 0) + {_DOT}, 1.0), 5.0)"


@query("vector_predictions", f"""SELECT CR."userId", CR."productId", rating, "timestamp", {rnd(_SCORE, 6)} AS prediction
    FROM CR LEFT JOIN ITEMOFF i ON CR."productId" = i."productId" LEFT JOIN USEROFF u ON CR."userId" = u."userId"
    LEFT JOIN {_VECTORS} a ON a.id = CR."userId" LEFT JOIN {_VECTORS} b ON b.id = CR."productId" """,
       "CR", "MU", "ITEMOFF", "USEROFF")
def _(spark, d):
    return factors.predict_with(T.cleaned_ratings(spark, d), _offsets(spark, d), *_vectors_as_factors(spark, d)) \
        .withColumn("prediction", S.half_even("prediction", 6))


_META = """left(coalesce(title, 'Unknown'), 50) AS title, left(coalesce(category, 'Unknown'), 40) AS category"""


@query("recommendations_by_vectors", f"""SELECT s."userId", rank, s."productId", predicted_rating, {_META}, price, brand FROM (
      SELECT *, cast(row_number() OVER (PARTITION BY "userId" ORDER BY predicted_rating DESC, "productId") AS int) AS rank
      FROM (SELECT u."userId", t."productId", {rnd(_SCORE, 3)} AS predicted_rating
        FROM USEROFF u CROSS JOIN TOPITEMS t JOIN ITEMOFF i ON t."productId" = i."productId"
        LEFT JOIN {_VECTORS} a ON a.id = u."userId" LEFT JOIN {_VECTORS} b ON b.id = t."productId"
        ANTI JOIN CR ON CR."userId" = u."userId" AND CR."productId" = t."productId")) s
    LEFT JOIN CP ON s."productId" = CP."productId" WHERE rank <= 10""", "CR", "CP", "MU", "ITEMOFF", "USEROFF", "TOPITEMS")
def _(spark, d):
    ratings = T.cleaned_ratings(spark, d)
    return factors.recommend(ratings, ratings, T.product_facts(spark, d), _offsets(spark, d),
                             _vectors_as_factors(spark, d))


_UNRATED = """SELECT u."userId", i."productId" FROM (
      SELECT "userId" FROM CR GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3) u, (SELECT DISTINCT "productId" FROM CR) i
    WHERE NOT EXISTS (SELECT 1 FROM CR WHERE CR."userId" = u."userId" AND CR."productId" = i."productId")
    QUALIFY row_number() OVER (PARTITION BY u."userId" ORDER BY
      ('0x' || substr(md5(u."userId" || '|' || i."productId" || '|42'), 1, 15))::BIGINT, i."productId") <= 200"""


@query("random_unrated_items", _UNRATED, "CR")
def _(spark, d):
    ratings = T.cleaned_ratings(spark, d)
    return factors.random_unrated(ratings, ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
                                  .orderBy(F.desc("n"), "userId").limit(3))


@query("sample_recommendations", f"""SELECT s.*, {_META} FROM (
      SELECT n."userId", n."productId", {rnd(_SCORE, 3)} AS predicted_rating, cast(row_number() OVER (
        PARTITION BY n."userId" ORDER BY {rnd(_SCORE, 9)} DESC, n."productId") AS int) AS rank
      FROM ({_UNRATED}) n LEFT JOIN ITEMOFF i ON n."productId" = i."productId"
      LEFT JOIN USEROFF u ON n."userId" = u."userId"
      LEFT JOIN {_VECTORS} a ON a.id = n."userId" LEFT JOIN {_VECTORS} b ON b.id = n."productId" QUALIFY rank <= 10) s
    LEFT JOIN CP ON s."productId" = CP."productId" """, "CR", "CP", "MU", "ITEMOFF", "USEROFF")
def _(spark, d):
    return factors.sample_recommendations(T.cleaned_ratings(spark, d), T.product_facts(spark, d),
                                          _offsets(spark, d), _vectors_as_factors(spark, d))
