"""Schemas of every table the library reads or writes."""

from pyspark.sql import types as T


def _schema(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_STR, _DBL, _LONG, _INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()

# Raw sources.  List-or-text fields are read as text and parsed afterwards, so
# that a record holding a plain string is not thrown away by the JSON reader.
RAW_RATINGS = _schema(
    ("user_id", _STR), ("parent_asin", _STR), ("rating", _DBL), ("timestamp", _STR),
    ("_corrupt_record", _STR),
)
RAW_PRODUCTS = _schema(
    ("parent_asin", _STR), ("title", _STR), ("price", _STR), ("store", _STR),
    ("categories", _STR), ("description", _STR), ("_corrupt_record", _STR),
)
CATALOG_ROW = _schema(
    ("productId", _STR), ("title", _STR), ("price", _DBL), ("brand", _STR),
    ("category", _STR), ("description", _STR), ("rating_count", _INT), ("avg_rating", _DBL),
)
CATALOG_PAGE = T.StructType([
    T.StructField("status", _STR), T.StructField("dataset", _STR), T.StructField("timestamp", _STR),
    T.StructField("data", T.ArrayType(CATALOG_ROW)),
    T.StructField("pagination", _schema(
        ("total", _LONG), ("page", _LONG), ("limit", _LONG), ("pages", _LONG))),
])

# Raw field -> column, in output order.
RATING_FIELDS = {
    "user_id": "userId", "parent_asin": "productId", "rating": "rating", "timestamp": "timestamp",
}
PRODUCT_FIELDS = {
    "parent_asin": "productId", "title": "title", "price": "price", "store": "brand",
    "categories": "category", "description": "description",
}

RATINGS = _schema(("userId", _STR), ("productId", _STR), ("rating", _DBL), ("timestamp", _LONG))
PRODUCTS = _schema(
    ("productId", _STR), ("title", _STR), ("price", _DBL), ("brand", _STR),
    ("category", _STR), ("description", _STR),
)

USER_FEATURES = _schema(
    ("userId", _STR), ("user_rating_count", _LONG), ("user_avg_rating", _DBL),
    ("user_rating_std", _DBL), ("user_unique_items", _LONG), ("user_recency_days", _DBL),
    ("user_category_diversity", _LONG),
)
ITEM_FEATURES = _schema(
    ("productId", _STR), ("item_rating_count", _LONG), ("item_avg_rating", _DBL),
    ("item_rating_std", _DBL), ("item_unique_users", _LONG), ("price", _DBL),
    ("category", _STR), ("brand", _STR), ("category_encoded", _INT), ("brand_encoded", _INT),
    ("price_normalized", _DBL),
)
ITEM_ENRICHED_COLUMNS = ("api_rating_count", "api_avg_rating")
INTERACTION_FEATURES = _schema(
    ("userId", _STR), ("productId", _STR), ("rating", _DBL), ("timestamp", _LONG),
    ("rating_normalized", _DBL), ("days_since_epoch", _LONG), ("user_item_rating_diff", _DBL),
)
COOCCURRENCE = _schema(("productId", _STR), ("co_productId", _STR), ("cooc_score", _DBL))

FEATURE_TABLES = {
    "user_features": USER_FEATURES,
    "item_features": ITEM_FEATURES,
    "interaction_features": INTERACTION_FEATURES,
    "cooccurrence": COOCCURRENCE,
}

VERSIONS = _schema(
    ("version_id", _LONG), ("version_tag", _STR), ("feature_set", _STR), ("n_users", _LONG),
    ("n_items", _LONG), ("n_interactions", _LONG), ("dataset", _STR), ("created_at", _STR),
    ("notes", _STR),
)
AUDIT = _schema(
    ("ingested_at", _STR), ("source", _STR), ("file", _STR), ("rows", _LONG),
    ("size_bytes", _LONG), ("md5", _STR), ("status", _STR), ("dataset", _STR),
)
RUNS = T.StructType([
    T.StructField("run_id", _STR), T.StructField("model", _STR),
    T.StructField("params", T.MapType(_STR, _STR)),
    T.StructField("metrics", T.MapType(_STR, _DBL)), T.StructField("created_at", _STR),
])
