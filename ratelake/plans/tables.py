"""The working tables of one data folder, staged once per session.

The cleaned tables and the feature tables are files between batch steps: every
later step reads them instead of working them out again.
"""

from pyspark.sql import DataFrame, SparkSession

from ratelake.operators import features, prepare
from ratelake.session import stage
from ratelake.sources import views

_staged: dict = {}


def once(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _staged:
        _staged[key] = stage(build(), name)
    return _staged[key]


def cleaned_ratings(spark, folder) -> DataFrame:
    return once(spark, folder, "cleaned_ratings",
                 lambda: prepare.clean_ratings(views.ratings(spark, folder)))


def cleaned_products(spark, folder) -> DataFrame:
    return once(spark, folder, "cleaned_products",
                 lambda: prepare.clean_products(views.products(spark, folder)))


def product_facts(spark, folder) -> DataFrame:
    """Cleaned products without their descriptions, which are most of the table: for steps that read no text."""
    return once(spark, folder, "product_facts",
                 lambda: prepare.clean_products(views.products(spark, folder).drop("description")))


def enriched_products(spark, folder) -> DataFrame:
    """Cleaned products with the rating statistics a catalog service adds, in one job: the texts move and are written once."""
    return once(spark, folder, "enriched_products", lambda: prepare.enrich_products(
        prepare.clean_products(views.products(spark, folder)), prepare.item_rating_stats(views.ratings(spark, folder))))


def user_features(spark, folder) -> DataFrame:
    return once(spark, folder, "user_features", lambda: features.user_features(
        cleaned_ratings(spark, folder), product_facts(spark, folder)))


def item_features(spark, folder) -> DataFrame:
    base = once(spark, folder, "item_base", lambda: features.item_base(
        cleaned_ratings(spark, folder), product_facts(spark, folder)))
    return once(spark, folder, "item_features", lambda: features.encode_items(base))


def interaction_features(spark, folder) -> DataFrame:
    return once(spark, folder, "interaction_features", lambda: features.interaction_features(
        cleaned_ratings(spark, folder), item_features(spark, folder)))


def cooccurrence(spark, folder) -> DataFrame:
    return once(spark, folder, "cooccurrence", lambda: features.cooccurrence(
        cleaned_ratings(spark, folder)))
