"""Stored tables: cleaned data, features, registry, versions, audit and run log.

``root`` is a folder all executors can reach.  A table is written as Parquet to a folder of its own,
``root/<name>/<unique>``, that never changes.  The newest commit file in ``root/_tables`` says which folder each
name stands for, so a set of tables changes in one step and a job that dies leaves the old set as it was.
Logs (audit, runs, versions) are one commit file per row, so writers at the same time lose nothing.
"""

import hashlib
import re
import uuid
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ratelake import schemas
from ratelake.sources import commits
from ratelake.sources.raw import checksum_columns

FEATURE_SETS = tuple(schemas.FEATURE_TABLES)
# The key that training sets join the two large tables on.
BUCKET_KEYS = {"user_features": "userId", "interaction_features": "userId"}
LOGS = {"audit": schemas.AUDIT, "runs": schemas.RUNS, "feature_versions": schemas.VERSIONS}


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def write_folder(df: DataFrame, root: str, name: str, key: str | None = None, buckets: int | None = None) -> str:
    """Write a new folder for ``name``; readers see it once it is published.

    With ``key`` and ``buckets`` the rows are hashed by the key into that many files, and the folder's name says so: tables with
    the same key and number of buckets join on the key without a shuffle.  Rows without a key share a bucket.
    """
    path = f"{root}/{name}/{uuid.uuid4().hex}"
    if not buckets:
        df.write.parquet(path)
        return path
    path = f"{path}-{buckets}-{key}"
    # Spark writes buckets to tables only; this one is dropped again, and its files stay.
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path) \
        .saveAsTable(_table_name(path))
    df.sparkSession.sql(f"DROP TABLE {_table_name(path)}")
    return path


BUCKETED = re.compile(r"/([0-9a-f]{32})-([0-9]+)-(\w+)$")


def _table_name(path: str) -> str:
    return f"ratelake_{BUCKETED.search(path).group(1)}"


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """A folder of ``write_folder``; one in buckets is made known to the session's catalog, so that any session sees its buckets."""
    plain = spark.read.parquet(path)
    found = BUCKETED.search(path)
    if not found:
        return plain
    _, buckets, key = found.groups()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(path)} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_table_name(path))


def publish(spark: SparkSession, root: str, folders: dict) -> None:
    """Let the names stand for these folders, all of them in one step; other names stay."""
    new = {name: path[len(root) + 1:] for name, path in folders.items()}
    commits.commit(spark, f"{root}/_tables", lambda _, before: {**before, **new})


def write_tables(tables: dict, root: str) -> dict:
    """Write all tables, then publish them together."""
    folders = {name: write_folder(df, root, name) for name, df in tables.items()}
    publish(next(iter(tables.values())).sparkSession, root, folders)
    return folders


def write_table(df: DataFrame, root: str, name: str) -> str:
    return write_tables({name: df}, root)[name]


def remove_replaced(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete folders that were published once and stand in none of the last ``keep`` commits.

    Folders never published may belong to a running job and stay.  Returns how many were deleted.
    """
    taken = commits.numbers(spark, f"{root}/_tables")
    seen = [set(commits.read(spark, f"{root}/_tables", n).values()) for n in taken]
    old = set().union(*seen) - set().union(*seen[-max(keep, 1):])
    deleted = 0
    for folder in sorted(old):
        fs, path = commits.file_system(spark, f"{root}/{folder}")
        deleted += bool(fs.delete(path, True))
    return deleted


def append_row(spark: SparkSession, root: str, log: str, make) -> int:
    """Add the row ``make(number)``, a dict, to a log and return its number."""
    return commits.commit(spark, f"{root}/{log}", lambda number, _: make(number))


def read_log(spark: SparkSession, root: str, log: str) -> DataFrame:
    """The rows of a log, none before the first."""
    if not commits.numbers(spark, f"{root}/{log}"):
        return spark.createDataFrame([], LOGS[log])
    return spark.read.schema(LOGS[log]).json(f"{root}/{log}")


def read_table(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    """A published table, a log, or a plain Parquet folder; an absent one is an error unless ``schema`` allows an empty result."""
    if name in LOGS:
        return read_log(spark, root, name)
    folder = commits.newest(spark, f"{root}/_tables").get(name, name)
    try:
        return read_folder(spark, f"{root}/{folder}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if schema is None:
            raise FileNotFoundError(f"no table {name} in {root}")
        return spark.createDataFrame([], schema)


def load_cleaned(spark: SparkSession, root: str, fmt: str = "parquet") -> tuple:
    """Cleaned ratings and products, from Parquet or from CSV files."""
    out = []
    for name, schema in (("cleaned_ratings", schemas.RATINGS), ("cleaned_products", schemas.PRODUCTS)):
        if fmt == "csv":
            out.append(spark.read.schema(schema).option("header", True).csv(f"{root}/{name}.csv"))
        else:
            out.append(read_table(spark, root, name))
    return tuple(out)


# -- feature tables ---------------------------------------------------------

def feature_columns(name: str, df: DataFrame) -> DataFrame:
    """A feature table in fixed column order; enrichment columns only if present."""
    return df.select(*schemas.FEATURE_TABLES[name].names, *[
        c for c in schemas.ITEM_ENRICHED_COLUMNS if name == "item_features" and c in df.columns])


def write_feature_folder(df: DataFrame, root: str, name: str, buckets: int | None = None) -> str:
    """A feature table's folder; with ``buckets``, tables of users and of interactions lie in that many by user."""
    key = BUCKET_KEYS.get(name)
    return write_folder(feature_columns(name, df), root, name, key, buckets if key else None)


def write_features(tables: dict, root: str, buckets: int | None = None) -> dict:
    """Replace the feature tables, all in one step."""
    folders = {name: write_feature_folder(df, root, name, buckets) for name, df in tables.items()}
    publish(next(iter(tables.values())).sparkSession, root, folders)
    return folders


def read_features(spark: SparkSession, root: str) -> dict:
    return {name: read_table(spark, root, name) for name in FEATURE_SETS}


# -- feature registry -------------------------------------------------------

DESCRIPTIONS = {
    "userId": "User id", "productId": "Item id",
    "user_rating_count": "Ratings given by the user", "user_avg_rating": "Mean rating given",
    "user_rating_std": "Spread of the ratings given", "user_unique_items": "Distinct items rated",
    "user_recency_days": "Days since the last rating", "user_category_diversity": "Distinct categories rated",
    "item_rating_count": "Ratings received", "item_avg_rating": "Mean rating received",
    "item_rating_std": "Spread of the ratings received", "item_unique_users": "How many users rated it",
    "price": "Price, missing ones filled", "category": "Category name", "brand": "Brand name",
    "category_encoded": "Position of the category in name order",
    "brand_encoded": "Position of the brand in name order",
    "price_normalized": "Price scaled to 0..1", "api_rating_count": "Ratings by the catalog service",
    "api_avg_rating": "Mean rating by the catalog service", "rating": "Rating of 1 to 5",
    "timestamp": "Epoch seconds", "rating_normalized": "Rating scaled to 0..1",
    "days_since_epoch": "Whole days since 1970", "user_item_rating_diff": "Rating minus the item's mean",
    "co_productId": "Item rated by the same users", "cooc_score": "Users who rated both",
}
ENCODERS = {"category_encoded": ("category", "label"), "brand_encoded": ("brand", "label"),
            "price_normalized": ("price", "min-max")}


def feature_registry(tables: dict) -> DataFrame:
    """``feature_set, column, type, description, encoder, n_classes``: read off the tables."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, f.name, f.dataType.simpleString(), DESCRIPTIONS.get(f.name),
             ENCODERS.get(f.name, (None, None))[1])
            for name, df in tables.items() for f in df.schema.fields]
    registry = spark.createDataFrame(
        rows, "feature_set string, column string, type string, description string, encoder string")
    if "item_features" not in tables:
        return registry.withColumn("n_classes", F.lit(None).cast("bigint"))
    # Codes run from 0 without gaps.
    codes = [c for c, (_, kind) in ENCODERS.items() if kind == "label"]
    last = tables["item_features"].agg(*[F.max(c).cast("bigint").alias(c) for c in codes]) \
        .select(F.struct(*codes).alias("v")).scalar()
    n_classes = F.lit(None).cast("bigint")
    for c in codes:
        n_classes = F.when(F.col("column") == c, last[c] + 1).otherwise(n_classes)
    return registry.withColumn("n_classes", n_classes)


# The stored tables that each feature set is made from.
SOURCES = {"user_features": "cleaned_ratings,cleaned_products", "item_features": "cleaned_ratings,cleaned_products",
           "interaction_features": "cleaned_ratings,item_features", "cooccurrence": "cleaned_ratings"}


def registry_totals(tables: dict, dataset: str = "ratings", created_at: str | None = None) -> DataFrame:
    """``feature_set, n_features, n_records, source, dataset, created_at``; key columns are no features."""
    out, created_at = None, created_at or _now()
    for name, df in tables.items():
        n_features = len([c for c in df.columns if c not in ("userId", "productId", "co_productId")])
        part = df.agg(F.count(F.lit(1)).alias("n_records")).select(
            F.lit(name).alias("feature_set"), F.lit(n_features).alias("n_features"), "n_records",
            F.lit(SOURCES.get(name)).alias("source"), F.lit(dataset).alias("dataset"), F.lit(created_at).alias("created_at"))
        out = part if out is None else out.unionByName(part)
    return out


def sample_classes(items: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` classes of each label encoder."""
    parts = [items.select(F.lit(c).alias("encoder"), F.col(c).alias("class"),
                          F.col(f"{c}_encoded").cast("int").alias("code"))
             .where(F.col("code") < n).distinct() for c in ("category", "brand")]
    return parts[0].unionByName(parts[1])


def write_registry(tables: dict, root: str) -> None:
    write_tables({"feature_registry": feature_registry(tables), "feature_totals": registry_totals(tables)}, root)


def read_registry(spark: SparkSession, root: str, feature_set: str | None = None) -> DataFrame:
    """The registry, or one feature set of it; an unknown set gives no rows."""
    registry = read_table(spark, root, "feature_registry")
    return registry if feature_set is None else registry.where(F.col("feature_set") == feature_set)


# -- versions ---------------------------------------------------------------

def version_row(tables: dict, versions: DataFrame, tag: str, notes: str = "", dataset: str = "ratings",
                created_at: str | None = None) -> DataFrame:
    """The next row of the version table: one more than the greatest id, and three row counts."""
    def count(name):
        return tables[name].agg(F.count(F.lit(1))).scalar()

    next_id = versions.select(F.coalesce(F.max("version_id"), F.lit(0)) + 1).scalar()
    return versions.sparkSession.range(1).select(
        next_id.cast("bigint").alias("version_id"), F.lit(tag).alias("version_tag"),
        F.lit(",".join(FEATURE_SETS)).alias("feature_set"), count("user_features").alias("n_users"),
        count("item_features").alias("n_items"), count("interaction_features").alias("n_interactions"),
        F.lit(dataset).alias("dataset"), F.lit(created_at or _now()).alias("created_at"),
        F.lit(notes).alias("notes"))


def register_version(spark: SparkSession, root: str, tag: str, notes: str = "",
                     dataset: str = "ratings") -> int:
    """Append a version row and return its id, the number of its commit: two writers at once get two ids."""
    row = version_row(read_features(spark, root), read_log(spark, root, "feature_versions"), tag, notes, dataset).first()
    return append_row(spark, root, "feature_versions", lambda number: {**row.asDict(), "version_id": number})


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, root, "feature_versions").orderBy(F.desc("version_id"))


# -- audit and run log ------------------------------------------------------

def watched(df: DataFrame) -> tuple:
    """``df`` that counts and sums up its rows while it is written, and what it has seen by then."""
    seen = Observation()
    return df.observe(seen, *checksum_columns(df)), seen


def append_audit(spark: SparkSession, root: str, source: str, file: str, path: str, seen: Observation,
                 dataset: str = "ratings") -> None:
    """One audit row for a table written as ``watched``: rows, bytes and an order-free checksum; nothing is read back."""
    facts = seen.get
    fs, folder = commits.file_system(spark, path)
    row = {"ingested_at": _now(), "source": source, "file": file, "rows": facts["rows"],
           "size_bytes": fs.getContentSummary(folder).getLength(),
           "md5": hashlib.md5(facts["checksum"].encode()).hexdigest(), "status": "SUCCESS", "dataset": dataset}
    append_row(spark, root, "audit", lambda _: row)


def log_run(spark: SparkSession, root: str, model: str, params: dict, metrics: dict) -> str:
    run_id = uuid.uuid4().hex
    row = {"run_id": run_id, "model": model, "params": {k: str(v) for k, v in params.items()},
           "metrics": {k: float(v) for k, v in metrics.items()}, "created_at": _now()}
    append_row(spark, root, "runs", lambda _: row)
    return run_id
