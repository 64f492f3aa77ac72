"""What the operators share: table access and the size of the batches that Python tasks get."""

from pyspark.sql import DataFrame, SparkSession

#: Rows that a Python task gets at once; bounds its memory when texts are long.
BATCH_ROWS = 1000

#: Words of all contracts: runs of bytes that are none of these (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """Let the Python tasks of this session get ``BATCH_ROWS`` rows at a time; returns ``df``."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def fresh(name: str, taken) -> str:
    """A column name made of ``name`` that none of the taken ones equals, capitals apart or not."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def quoted(df: DataFrame) -> list[str]:
    """All columns of ``df`` by name, whatever letters the names hold."""
    return ["`" + c.replace("`", "``") + "`" for c in df.columns]
