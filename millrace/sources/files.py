"""Change logs in files, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.model import MAX_TS, Options


def read_log(spark: SparkSession, path: str, start_ts: int | None = None, end_ts: int = MAX_TS, options: Options = Options()) -> DataFrame:
    """The log at ``path`` (Parquet), from ``start_ts`` less the rewind up to ``end_ts``.

    Rows that are not committed (commit_ts 0) and marks are always read: a later commit may need them.
    """
    log = spark.read.parquet(path)
    if start_ts is not None:
        log = log.where((F.col("commit_ts") == 0) | (F.col("commit_ts") > start_ts - options.rewind))
    return log if end_ts == MAX_TS else log.where(F.col("commit_ts") <= end_ts)


def stream_log(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """The log at ``path`` as a stream; ``files_per_trigger`` holds back how much a batch admits."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_changes(changelog: DataFrame, path: str, mode: str = "append") -> None:
    changelog.write.mode(mode).parquet(path)
