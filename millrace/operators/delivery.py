"""What a reader is given: offsets, late rows, checkpoints and quality marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.scalar import clamped_minus
from millrace.model import MAX_TS, Options
from millrace.operators.sweep import running_max_by


def from_start(changelog: DataFrame, start_ts: int, options: Options = Options()) -> DataFrame:
    """Changes after the start, set back by the rewind; the filter reaches the scan."""
    return changelog.where(F.col("commit_ts") > start_ts - options.rewind)


def until_end(changelog: DataFrame, end_ts: int = MAX_TS) -> DataFrame:
    return changelog if end_ts == MAX_TS else changelog.where(F.col("commit_ts") <= end_ts)


def checkpoints(changelog: DataFrame, per: str = "region_id") -> DataFrame:
    """Each change with the greatest commit timestamp delivered in its region up to it."""
    return running_max_by(changelog, per, ["emit_seq", "commit_ts", "start_ts"], F.col("commit_ts"), "checkpoint_ts")


def resolved_violations(changelog: DataFrame) -> DataFrame:
    """Marks changes at or below the frontier as of their place; nothing is dropped."""
    low = F.when(F.col("log_type") == "COMMITTED", F.col("commit_ts") <= F.col("frontier_ts")).otherwise(F.col("commit_ts") < F.col("frontier_ts"))
    return changelog.withColumn("violates_resolved", low)


def oversize(log: DataFrame, options: Options = Options()) -> DataFrame:
    """Bytes of a row's key and values (numbers as they are printed), and whether they are over the limit; nothing is dropped."""
    own = lambda name: F.coalesce(F.octet_length(F.col(name) if log.schema[name].dataType.typeName() == "binary" else F.col(name).cast("string")), F.lit(0))
    size = own("key") + own("new_value") + own("old_value")
    return log.withColumn("row_bytes", size.cast("long")).withColumn("oversize", F.col("row_bytes") > options.max_row_bytes)


#: Columns that say where an entry's table comes from; a copy is without them.
ORIGIN = ["db_name", "table_name", "table_info"]


def copied(log: DataFrame) -> DataFrame:
    """The entries themselves, without what is known of their table."""
    return log.drop(*ORIGIN)


def lag(resolved: DataFrame, now: int) -> DataFrame:
    return resolved.withColumn("lag", clamped_minus(F.lit(now), F.col("resolved_ts")))


def expired(resolved: DataFrame, now: int, least_lag: int, most: int = 64) -> DataFrame:
    """The regions that lag longest, ``most`` of them at most (a top-k report)."""
    return lag(resolved, now).where(F.col("lag") >= least_lag).orderBy(F.desc("lag"), "region_id").limit(most)
