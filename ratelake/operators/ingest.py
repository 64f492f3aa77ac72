"""Raw records to ratings and product tables."""

from pyspark.sql import DataFrame, Window, functions as F

from ratelake import schemas
from ratelake.functions import scalar as S


def select_fields(df: DataFrame, fields: dict) -> DataFrame:
    """Keep the mapped fields that are present, under their new names."""
    return df.select(*[F.col(raw).alias(name) for raw, name in fields.items() if raw in df.columns])


def missing_fields(df: DataFrame, fields: dict) -> list:
    return [raw for raw in fields if raw not in df.columns]


def require_filled(df: DataFrame, *columns) -> None:
    """Raise when there are rows, but a key column has no value in any of them: the field is absent or renamed."""
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns]).first()
    absent = [c for c in columns if row["_rows"] and not row[c]]
    if absent:
        raise ValueError(f"no record has a value for {absent}")


def rating_in_range(ratings: DataFrame, lo=S.RATING_MIN, hi=S.RATING_MAX) -> DataFrame:
    return ratings.where(F.col("rating").between(lo, hi))


def require_keys(df: DataFrame, *keys) -> DataFrame:
    return df.dropna(subset=list(keys))


def normalise_epoch(ratings: DataFrame, per_row: bool = False, by: str | None = None) -> DataFrame:
    """Timestamps as whole epoch seconds.

    Date-time texts are read as such, in seconds.  The unit of numbers is read off the table's largest stamp, so one scan of that column
    comes first, or off the largest one with the same value of the column ``by``; ``per_row`` decides row by row and needs no extra scan.
    """
    dated = S.date_time_seconds("timestamp")
    stamped = ratings.withColumn("_dated", dated).withColumn("timestamp", S.whole_seconds("timestamp"))
    if by:
        # One row per value of ``by`` after partial sums, so rows of one large file need not meet.
        largest = stamped.groupBy(by).agg(F.max("timestamp").alias("_largest"))
        joined = stamped.join(largest, by).withColumn("timestamp", F.coalesce("_dated", S.epoch_seconds("timestamp", F.col("_largest"))))
        return joined.select(*ratings.columns)
    largest = None if per_row else stamped.select(F.max("timestamp")).scalar()
    return stamped.withColumn("timestamp", F.coalesce("_dated", S.epoch_seconds("timestamp", largest))).drop("_dated")


def top_users(ratings: DataFrame, n: int) -> DataFrame:
    """The ``n`` users with most rows; ties go to the smaller id."""
    return (ratings.where(F.col("userId").isNotNull())
            .groupBy("userId").agg(F.count(F.lit(1)).alias("n_ratings"))
            .orderBy(F.desc("n_ratings"), "userId").limit(n))


def keep_top_users(ratings: DataFrame, n: int) -> DataFrame:
    return ratings.join(top_users(ratings, n).select("userId"), "userId", "left_semi") \
        .select(*ratings.columns)


def select_ratings(raw: DataFrame) -> DataFrame:
    """Field map, rating range and required keys."""
    return require_keys(rating_in_range(select_fields(raw, schemas.RATING_FIELDS)), "userId", "productId")


def parse_ratings(raw: DataFrame, per_row_epoch: bool = False) -> DataFrame:
    return normalise_epoch(select_ratings(raw), per_row_epoch)


def parse_ratings_by_file(raw: DataFrame) -> DataFrame:
    """``parse_ratings`` of records with their ``file``; each file has a unit of its own."""
    fields = [F.col(name).alias(new) for name, new in schemas.RATING_FIELDS.items()]
    rows = require_keys(rating_in_range(raw.select(*fields, "file")), "userId", "productId")
    return normalise_epoch(rows, by="file").drop("file")


def first_per_product(products: DataFrame) -> DataFrame:
    """One row per product: the one with fewest nulls, then the smallest in column order.

    ``row_number() = 1`` is cut down inside every map task before the shuffle,
    so many copies of one product do not meet in one task.
    """
    rest = [c for c in products.columns if c != "productId"]
    n_null = sum((F.col(c).isNull().cast("int") for c in rest), F.lit(0))
    w = Window.partitionBy("productId").orderBy(n_null, *[F.col(c).asc_nulls_last() for c in rest])
    return (require_keys(products, "productId")
            .withColumn("_n", F.row_number().over(w)).where(F.col("_n") == 1).drop("_n"))


def parse_products(raw: DataFrame) -> DataFrame:
    """Field map, category path, description text, price number, one row per product."""
    table = select_fields(raw, schemas.PRODUCT_FIELDS)
    changes = {}
    if "category" in table.columns:
        changes["category"] = S.empty_to_null(S.category_path(S.text_list("category")))
    if "description" in table.columns:
        changes["description"] = S.empty_to_null(
            S.description_text(S.text_list("description"), F.col("description")))
    if "price" in table.columns:
        changes["price"] = S.parse_price("price")
    return first_per_product(table.withColumns(changes))


def explode_pages(pages: DataFrame) -> DataFrame:
    """Catalog rows of landed API pages."""
    return pages.select(F.explode("data").alias("row")).select("row.*")


def page_coverage(pages: DataFrame) -> DataFrame:
    """One row: pages seen, pages announced, and whether none is missing."""
    seen = pages.select("pagination.*").agg(
        F.count_distinct("page").alias("pages_seen"), F.max("pages").alias("pages_announced"),
        F.max(F.ceil(F.col("total") / F.col("limit"))).alias("pages_needed"))
    return seen.withColumn("complete", (F.col("pages_seen") == F.col("pages_announced"))
                           & (F.col("pages_announced") == F.col("pages_needed")))


def stage_totals(ratings: DataFrame) -> DataFrame:
    """Rows, users and items, in one scan.  The keys combine in the map tasks."""
    keys = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).alias("key")) for c in ("userId", "productId")])
    counted = ratings.select(F.inline(keys)).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))

    def distinct(kind):
        return F.count_if((F.col("kind") == kind) & F.col("key").isNotNull())

    return counted.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "userId", F.col("n"))), F.lit(0)).alias("n_ratings"),
        distinct("userId").alias("n_users"), distinct("productId").alias("n_items"))
