"""Catalog queries: filters, pages, popularity and totals."""

from typing import NamedTuple

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ratelake.functions import scalar as S
from ratelake.operators.quantiles import exact_quantiles
from ratelake.session import scratch_path, stage

MAX_PAGE = 100
PRODUCT_ROW = ("productId", "title", "price", "brand", "category", "description",
               "rating_count", "avg_rating")


def page_bounds(page=1, limit=20) -> tuple:
    return max(1, int(page)), min(MAX_PAGE, max(1, int(limit)))


def category_matches(products: DataFrame, pattern: str) -> DataFrame:
    """Regular expression, any case; products without a category never match."""
    return products.where(F.coalesce(F.col("category").rlike(f"(?i){pattern}"), F.lit(False)))


def price_between(products: DataFrame, low=None, high=None) -> DataFrame:
    if low is not None:
        products = products.where(F.col("price") >= float(low))
    if high is not None:
        products = products.where(F.col("price") <= float(high))
    return products


def product_rows(products: DataFrame) -> DataFrame:
    """The eight published fields: price 2 dp, description 200 characters."""
    return products.select(*PRODUCT_ROW).withColumns({
        "price": S.half_even(F.coalesce("price", F.lit(0.0)), 2),
        "brand": F.coalesce("brand", F.lit("Unknown")),
        "category": F.coalesce("category", F.lit("Unknown")),
        "description": F.substring(F.coalesce("description", F.lit("")), 1, 200),
        "rating_count": F.coalesce("rating_count", F.lit(0)).cast("int"),
        "avg_rating": F.coalesce("avg_rating", F.lit(0.0))})


def product_json(products: DataFrame) -> DataFrame:
    rows = product_rows(products)
    return rows.select("productId", F.to_json(F.struct(*rows.columns)).alias("json"))


def product_by_id(products: DataFrame, product_id: str) -> DataFrame:
    return product_rows(products.where(F.col("productId") == product_id))


def search(products: DataFrame, category=None, min_price=None, max_price=None) -> DataFrame:
    found = category_matches(products, category) if category else products
    return price_between(found, min_price, max_price)


def product_page(products: DataFrame, page=1, limit=20, category=None, min_price=None,
                 max_price=None) -> DataFrame:
    page, limit = page_bounds(page, limit)
    found = search(products, category, min_price, max_price)
    return product_rows(found.orderBy("productId").offset((page - 1) * limit).limit(limit))


class PageIndex(NamedTuple):
    """Products in cells of key order: ``rows`` with the folder column ``_cell``, and ``cells`` with ``_cell, n``."""

    rows: DataFrame
    cells: DataFrame


def page_index(products: DataFrame, cell_rows: int = 100_000, max_cells: int = 10_000) -> PageIndex:
    """Write ``products`` once, in key order, cut into cells of about ``cell_rows`` rows, and count the cells."""
    spark = products.sparkSession
    n = min(max_cells, max(1, -(-products.count() // cell_rows)))
    path = scratch_path(spark, "pages")
    (products.repartitionByRange(n, "productId").sortWithinPartitions("productId")
     .withColumn("_cell", F.spark_partition_id()).write.partitionBy("_cell").parquet(path))
    schema = T.StructType([*products.schema.fields, T.StructField("_cell", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path)
    return PageIndex(rows, stage(rows.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")), "cells"))


def indexed_page(index: PageIndex, page=1, limit=20, category=None, min_price=None, max_price=None) -> DataFrame:
    """``product_page`` for any page number: the cells before the page are counted, only its own are sorted.

    Without a filter the counts are those of the index; with one, a scan counts the hits of each cell.
    """
    page, limit = page_bounds(page, limit)
    first = (page - 1) * limit
    found = search(index.rows, category, min_price, max_price)
    filtered = category or min_price is not None or max_price is not None
    counts = found.groupBy("_cell").agg(F.count(F.lit(1)).alias("n")) if filtered else index.cells
    # A row per cell, so this window is bounded by ``max_cells``.
    earlier = F.sum("n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    held = (counts.withColumn("before", earlier).where((F.col("before") < first + limit) & (F.col("before") + F.col("n") > first))
            .agg(F.min("_cell").alias("lo"), F.max("_cell").alias("hi"), F.min("before").alias("before")).first())
    if held["lo"] is None:
        return product_rows(found.limit(0))
    near = found.where(F.col("_cell").between(held["lo"], held["hi"]))
    return product_rows(near.orderBy("productId").offset(first - held["before"]).limit(limit))


def page_info(products: DataFrame, page=1, limit=20, category=None, min_price=None,
              max_price=None) -> DataFrame:
    """Total, page, limit and number of pages of a search."""
    page, limit = page_bounds(page, limit)
    total = F.count(F.lit(1))
    return search(products, category, min_price, max_price).agg(
        total.alias("total"), F.lit(page).alias("page"), F.lit(limit).alias("limit"),
        F.ceil(total / limit).cast("bigint").alias("pages"))


def category_page(products: DataFrame, pattern: str, limit=20) -> DataFrame:
    _, limit = page_bounds(1, limit)
    return product_rows(category_matches(products, pattern).orderBy("productId").limit(limit))


def popular_products(products: DataFrame, limit=20) -> DataFrame:
    _, limit = page_bounds(1, limit)
    return product_rows(products.orderBy(F.desc("rating_count"), "productId").limit(limit))


def catalog_stats(products: DataFrame) -> DataFrame:
    """Totals, price and rating means, and the most common category and brand (ties by name)."""
    median = exact_quantiles(products, "price", {"m": 0.5}).scalar()
    # One pass over the table; all figures but the median follow from its (category, brand) groups.
    groups = products.groupBy("category", "brand").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").alias("price_sum"), F.count("price").alias("price_n"),
        F.count(F.when(F.col("rating_count") > 0, 1)).alias("rated"),
        F.sum("avg_rating").alias("rating_sum"), F.count("avg_rating").alias("rating_n"))

    def names(c):
        return groups.where(F.col(c).isNotNull()).groupBy(c).agg(F.sum("n").alias("n"))

    common = {c: names(c).orderBy(F.desc("n"), c).limit(1).select(c).scalar() for c in ("category", "brand")}
    distinct = {c: names(c).agg(F.count(F.lit(1)).alias("n")).scalar() for c in ("category", "brand")}
    totals = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_products"),
        S.half_even(F.try_divide(F.sum("price_sum"), F.sum("price_n")), 2).alias("avg_price"),
        F.coalesce(F.sum("rated"), F.lit(0)).alias("products_with_ratings"),
        S.half_even(F.try_divide(F.sum("rating_sum"), F.sum("rating_n")), 2).alias("avg_rating_overall"))
    return totals.select(
        "total_products", distinct["category"].alias("total_categories"),
        distinct["brand"].alias("total_brands"), "avg_price",
        S.half_even(median, 2).alias("median_price"), "products_with_ratings", "avg_rating_overall",
        F.coalesce(common["category"], F.lit("N/A")).alias("top_category"),
        F.coalesce(common["brand"], F.lit("N/A")).alias("top_brand"))
