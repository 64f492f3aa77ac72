"""Reads from the feature tables."""

import math

from pyspark.sql import DataFrame, Window, functions as F

from ratelake import schemas
from ratelake.functions import scalar as S
from ratelake.operators.quantiles import exact_quantiles
from ratelake.session import stage

TRAINING_COLUMNS = (
    "userId", "productId", "rating", "rating_normalized", "days_since_epoch", "user_item_rating_diff",
    "user_rating_count", "user_avg_rating", "user_rating_std", "user_unique_items",
    "user_recency_days", "user_category_diversity", "item_rating_count", "item_avg_rating",
    "item_rating_std", "item_unique_users", "price_normalized", "category_encoded", "brand_encoded",
)


def features_by_id(table: DataFrame, key: str, ids=None, limit: int | None = None) -> DataFrame:
    """Rows of the given ids; no list means all rows, or the first ``limit`` in key order if one is set.

    An empty list gives no rows.  Long lists of ids should be a table with the key column.
    """
    if isinstance(ids, DataFrame):
        return table.join(ids.select(key), key, "left_semi").select(*table.columns)
    if ids is not None:
        return table.where(F.col(key).isin(list(ids)))
    return table.orderBy(key).limit(limit) if limit else table


def user_features_of(users: DataFrame, user_ids=None, limit=None) -> DataFrame:
    return features_by_id(users, "userId", user_ids, limit)


def item_features_of(items: DataFrame, product_ids=None, limit=None) -> DataFrame:
    return features_by_id(items, "productId", product_ids, limit)


def training_set(interactions: DataFrame, users: DataFrame, items: DataFrame,
                 fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """Interactions with user and item features, sampled to an exact share.

    The sample is drawn from the interactions, before the joins.
    """
    if fraction < 1.0:
        interactions = exact_sample(interactions, fraction, ["userId", "productId"], seed)
    table = interactions.join(users, "userId", "left").join(
        items.drop("price", "category", "brand"), "productId", "left")
    return table.select(*TRAINING_COLUMNS)


def exact_sample(df: DataFrame, fraction: float, keys, seed: int = 42, cells: int = 1 << 18) -> DataFrame:
    """``round(fraction * n)`` rows in the order of a seeded MD5 of ``keys``, which SQL can repeat.

    The hashes of different keys lie evenly, so the cut is near its share of them: one scan hashes the rows and writes those up
    to a little beyond, and only the few near the cut are ranked.  Where keys repeat so often that the counts tell
    otherwise, hash cells are counted first.  ``keys`` must identify a row.
    """
    n = df.count()
    # Half to even, as Python rounds the sample size.
    want = round(float(fraction) * n)
    marked = df.withColumn("_h", S.hash_place(keys, seed))
    slack = 8 * math.sqrt(want * max(n - want, 0) / max(n, 1)) + 64
    low, high = (int(min(max(end / max(n, 1), 0.0), 1.0) * 16 ** 15) for end in (want - slack, want + slack))
    near = stage(marked.where(F.col("_h") < high), "near_sample")
    below, upto = near.agg(F.count_if(F.col("_h") < low), F.count(F.lit(1))).first()
    if not (below <= want <= upto and upto - below <= 4 * slack):
        return _sample_by_cells(marked, want, keys, cells).select(*df.columns)
    rank = F.row_number().over(Window.orderBy("_h", *keys))
    part = near.where(F.col("_h") >= low).withColumn("_n", rank).where(F.col("_n") <= want - below).drop("_n")
    return near.where(F.col("_h") < low).unionByName(part).select(*df.columns)


def _sample_by_cells(marked: DataFrame, want: int, keys, cells: int) -> DataFrame:
    """The ``want`` first rows by ``_h``, whatever lies how close.

    Hash cells that lie wholly below the cut are kept by a filter; only the one cell holding the cut is ranked.
    """
    marked = marked.withColumn("_cell", F.expr(f"_h div {16 ** 15 // cells}"))
    sizes = marked.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0))
    cut = (sizes.select("_cell", upto.alias("upto"), "n").where(F.col("upto") > want)
           .agg(F.min("_cell").alias("cell"), F.min(F.col("upto") - F.col("n")).alias("before"))
           .select(F.struct("cell", "before").alias("v")).scalar())
    whole = marked.where(F.coalesce(F.col("_cell") < cut["cell"], F.lit(True)))
    rank = F.row_number().over(Window.orderBy("_h", *keys))
    part = (marked.where(F.col("_cell") == cut["cell"]).withColumn("_n", rank)
            .where(F.col("_n") <= want - cut["before"]).drop("_n"))
    return whole.unionByName(part)


def inference_features(users: DataFrame, items: DataFrame, user_id: str, candidates=None,
                       top_n: int = 100) -> DataFrame:
    """One user's features beside those of each candidate; an unknown user gives no rows."""
    if candidates is None:
        chosen = items.orderBy(F.desc("item_rating_count"), "productId").limit(top_n)
    else:
        chosen = item_features_of(items, candidates)
    # One row at most, so it is a subquery value beside each candidate rather than a join.
    user = users.where(F.col("userId") == user_id).agg(F.first(F.struct(*users.columns))).scalar()
    return chosen.withColumn("_user", user).where(F.col("_user").isNotNull()).select("_user.*", *items.columns)


def cooccurring_items(cooccurrence: DataFrame, product_id: str, top_n: int = 5) -> DataFrame:
    return (cooccurrence.where(F.col("productId") == product_id)
            .orderBy(F.desc("cooc_score"), "co_productId").limit(top_n)
            .select("co_productId", "cooc_score"))


def describe(df: DataFrame) -> DataFrame:
    """count, mean, std, min, quartiles and max of each numeric column, 4 dp.

    Columns are turned into rows first, so one scan serves all moments and one
    the quartiles, and values combine to counts in the map tasks.
    """
    numeric = [f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte")]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                      for c in numeric])
    long = df.select(F.inline(cells)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    quartiles = exact_quantiles(long, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["column"])
    table = moments.join(quartiles, "column")
    return table.select("column", "count", *[
        S.half_even(c, 4).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def describe_table(tables: dict, name: str) -> DataFrame:
    if name not in schemas.FEATURE_TABLES:
        raise ValueError(f"table must be one of {sorted(schemas.FEATURE_TABLES)}")
    return describe(tables[name])


def table_counts(tables: dict) -> DataFrame:
    """``table_name, n_rows`` of every table, as one union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
