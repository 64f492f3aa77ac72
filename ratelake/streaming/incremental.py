"""Recurring ingest: each run takes the files that are new since the last one."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelake import schemas
from ratelake.operators import ingest
from ratelake.session import settings
from ratelake.sources import raw

# Digests of lines are state on disk, also in sessions with Spark's defaults, which keep all of it in executor heaps; the
# memory of the store is bounded for an executor, not for each of its partitions, and rows are not counted by extra reads.
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
         "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


def ingest_new_ratings(spark: SparkSession, folder: str, out: str, checkpoint: str, quarantine: str | None = None,
                       max_files: int | None = None, repeats_within: str | None = None,
                       file_age: str = "36500d") -> None:
    """Parse new rating lines into the Parquet table ``out`` and stop when none are left.

    Each line is parsed once and lands on one side: a rating of ``out`` or a line of ``quarantine``, both in folders
    by batch.  A batch that died is written again to the same folders, so a restart doubles nothing.  The unit of
    time stamps is judged by the largest one that is kept of each file, as the batch path judges it by the table's.

    With ``repeats_within`` (as ``7 days``) a line that arrived before in that time is dropped, as when a file is
    delivered twice.  Digests of lines are kept as state, for that time only.  What counts is when a line arrives, so a
    late file with old ratings or old file times loses nothing.  Without it all lines stay, and repeats of a rating are
    left to the cleaning step.

    Spark passes over files whose time is more than ``file_age`` before the newest one seen, a week if nothing is said, and
    keeps the names of younger ones in the driver.  The default here loses no file; a shorter age bounds the names.
    """
    stream = spark.readStream.option("maxFileAge", file_age)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    lines = raw.text_lines(stream, folder)
    if repeats_within:
        lines = (lines.withColumn("arrived", F.current_timestamp()).withColumn("digest", F.unhex(F.sha2("value", 256)))
                 .withWatermark("arrived", repeats_within).dropDuplicatesWithinWatermark(["digest"])
                 .drop("arrived", "digest"))
    writer = (raw.parse(lines, schemas.RAW_RATINGS).writeStream
              .foreachBatch(lambda batch, number: land_batch(batch, number, out, checkpoint, quarantine))
              .option("checkpointLocation", f"{checkpoint}/ratings").trigger(availableNow=True))
    # A stream takes the settings it is started with; one with a checkpoint goes on with the kind of state it has there.
    with settings(spark, STATE):
        running = writer.start()
    running.awaitTermination()


def land_batch(batch: DataFrame, number: int, out: str, checkpoint: str, quarantine: str | None) -> None:
    """Write one batch: first as parsed, so that parsing and state run once, then its two sides."""
    landed = f"{checkpoint}/landed/batch={number}"
    batch.write.mode("overwrite").parquet(landed)
    parsed = batch.sparkSession.read.schema(batch.schema).parquet(landed)
    write_side(ingest.parse_ratings_by_file(parsed.where(F.col("line").isNull()).select("record.*", "file")), out, number)
    if quarantine:
        write_side(parsed.where(F.col("line").isNotNull()).select("line", "file"), quarantine, number)


def write_side(df: DataFrame, path: str, number: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch={number}")


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """The ratings of all batches."""
    return spark.read.schema(schemas.RATINGS).parquet(out).select(*schemas.RATINGS.names)


def _drain(df: DataFrame, out: str, checkpoint: str):
    return (df.writeStream.format("parquet").outputMode("append").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ingest_new_files(spark: SparkSession, folder: str, schema, transform, out: str, checkpoint: str,
                     glob: str | None = None) -> None:
    """The same for Parquet files and any stateless ``transform``."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    _drain(transform(reader.parquet(folder)), out, checkpoint).awaitTermination()
