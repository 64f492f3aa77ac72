"""Session settings and staged tables."""

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings the library relies on; cluster sizing is left to the submitter.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A batch run has more generated classes than the default of 100 keeps.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # State of streams on disk, not in executor heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app="ratelake", master=None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster
    session without it is an error, since executors share no local disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="ratelake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/ratelake/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several later steps read the same costly result.  The table
    outlives lost executors, keeps column pruning, and gives the optimizer a
    true size to decide broadcasts by.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def drop_staged(df: DataFrame) -> None:
    """Remove the files of a table that ``stage`` returned and nothing reads any more; other tables stay as they are."""
    path = getattr(df, "_staged_at", None)
    if path:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict):
    """Settings of the session that hold inside only."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


#: The shuffle files of a query go when it ends, not when the driver lets go of its plan: for many rounds in a row.
BRIEF_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


# A table of at most this many short rows may be sent to every executor.
BROADCAST_ROWS = 100_000


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint for a table of at most ``max_rows`` rows; without it beyond the bound.

    Then the optimizer chooses the join by the sizes it measures.
    """
    return F.broadcast(df) if max_rows <= BROADCAST_ROWS else df
