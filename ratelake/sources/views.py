"""The ratings and product tables as views over an order-line star schema."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelake.functions.scalar import SECONDS_PER_DAY


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """A customer's line of a part is a rating of 1 to 5 at the ship date."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").cast("string").alias("userId"),
        F.col("l_partkey").cast("string").alias("productId"),
        ((F.col("l_quantity").cast("int") - 1) % 5 + 1).cast("double").alias("rating"),
        (F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * SECONDS_PER_DAY).alias("timestamp"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Parts, described by documents; some categories and prices are missing.

    Both are joined by the product's own key, so that a later join by it finds the texts where they are.
    """
    part = table(spark, folder, "part").withColumn("productId", F.col("p_partkey").cast("string"))
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    no_price = (F.col("p_partkey") % 3 == 0) | (F.col("p_type") == "SMALL")
    return part.join(docs, part["productId"] == docs["doc_id"], "left").select(
        "productId",
        F.col("p_name").alias("title"),
        F.when(~no_price, F.col("p_retailprice")).alias("price"),
        F.col("p_brand").alias("brand"),
        F.when(F.col("p_partkey") % 11 != 0, F.col("p_type")).alias("category"),
        F.col("text").alias("description"))
