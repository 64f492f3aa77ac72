"""Immutable snapshots: CSV files named by time, and Parquet tables partitioned by time."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ratelake.sources.commits import file_system

STAMP = "[0-9]{8}_[0-9]{6}"


def latest_file(spark: SparkSession, folder: str, prefix: str, suffix: str = "csv") -> str | None:
    """Path of the greatest ``prefix_YYYYMMDD_HHMMSS`` file, or None.

    Only names are read; one path comes back.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "false")
             .option("pathGlobFilter", f"{prefix}_*.{suffix}").load(folder).select("path"))
    named = files.where(F.element_at(F.split("path", "/"), -1).rlike(f"^{prefix}_{STAMP}\\.{suffix}$"))
    return named.agg(F.max("path")).first()[0]


def load_latest_csv(spark: SparkSession, folder: str, prefix: str, schema: T.StructType,
                    required: bool = True) -> DataFrame | None:
    path = latest_file(spark, folder, prefix)
    if path is None:
        if required:
            raise FileNotFoundError(f"no {prefix}_YYYYMMDD_HHMMSS.csv in {folder}")
        return None
    return spark.read.schema(schema).option("header", True).csv(path)


def append_snapshot(df: DataFrame, path: str, ingest_ts: str) -> str:
    """Add a snapshot and return its folder; others are never touched.

    It is written under a hidden name and takes its place last, so a job that dies leaves what was there.  One with the
    same stamp is replaced, so a rerun doubles nothing.
    """
    hidden = f"{path}/_writing-{uuid.uuid4().hex}"
    df.write.parquet(hidden)
    fs, source = file_system(df.sparkSession, hidden)
    _, target = file_system(df.sparkSession, f"{path}/ingest_ts={ingest_ts}")
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{hidden} was written but could not be renamed to {target}")
    return f"{path}/ingest_ts={ingest_ts}"


def load_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot.  The partition value is a subquery, so older folders are not read."""
    table = spark.read.option("basePath", path).parquet(path)
    table = table.withColumn("ingest_ts", F.col("ingest_ts").cast("string"))
    newest = table.select(F.max("ingest_ts")).scalar()
    return table.where(F.col("ingest_ts") == newest).drop("ingest_ts")
