"""Column functions on log rows."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.model import DELETE, OPERATE_CODES, PUT


def present(value: Column) -> Column:
    """Neither null nor empty bytes; other types are present unless null."""
    return value.isNotNull() & (F.coalesce(F.length(value.cast("string")), F.lit(0)) > 0)


def operate_type(op_type: Column, old_value: Column) -> Column:
    """Update for a put over an old value, Insert for another put, Delete, else Unknown."""
    return F.when((op_type == PUT) & present(old_value), "Update").when(op_type == PUT, "Insert").when(op_type == DELETE, "Delete").otherwise("Unknown")


def operate_code(name: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in OPERATE_CODES.items() for x in pair])[name]


def operate_name(code: Column) -> Column:
    """The type of a code; an unknown code fails the query."""
    names = F.create_map(*[F.lit(x) for name, c in OPERATE_CODES.items() for x in (c, name)])
    return F.coalesce(F.try_element_at(names, code.cast("int")), F.raise_error(F.concat(F.lit("no operation type has code "), code.cast("string"))).cast("string"))


def clamped_minus(a: Column, b: Column) -> Column:
    """a - b as 64-bit numbers, held at the bounds instead of an overflow."""
    wide = a.cast("decimal(38,0)") - b.cast("decimal(38,0)")
    low, high = F.lit(-(1 << 63)).cast("decimal(38,0)"), F.lit((1 << 63) - 1).cast("decimal(38,0)")
    return F.greatest(low, F.least(high, wide)).cast("long")


def time_since(at: Column, now: Column) -> Column:
    """Milliseconds from one timestamp to another, held at the bounds."""
    micros = lambda x: F.unix_micros(x.cast("timestamp"))
    return F.floor(clamped_minus(micros(now), micros(at)) / F.lit(1000))


def with_ids(rows: DataFrame, name: str = "id", slots: int = 256) -> DataFrame:
    """Adds different numbers from 1 on without a gap, the same at each run.

    Rows are numbered within hash slots of all their columns and slots are counted on, so no task sees all rows.
    """
    slot_of = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(slots)).cast("int")
    dealt = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), slot_of.alias("slot"))
    before = Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)  # a row a slot
    start = dealt.groupBy("slot").agg(F.count("*").alias("n")).select("slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("slot").orderBy("row")))
    return numbered.join(F.broadcast(start), "slot").select("row.*", (F.col("start") + F.col("nth")).cast("long").alias(name))


def slot(region_id: Column, n: int) -> Column:
    return F.pmod(region_id, F.lit(n))


def size_in_kb(size: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(size / 1024)).cast("long")


def retry_delay_bounds(failures: Column) -> tuple[Column, Column]:
    """Least and greatest milliseconds to wait after so many failures in a row."""
    later = F.when(failures == 3, 2000).when(failures == 4, 4000).otherwise(8000).cast("long")
    low = F.when(failures <= 1, 0).when(failures == 2, 500).otherwise(later).cast("long")
    return low, F.when(failures == 2, 999).otherwise(low).cast("long")


def retry_delay(failures: int, rng: random.Random | None = None) -> float:
    """Seconds that a source waits before its next try."""
    if failures <= 1:
        return 0.0
    if failures == 2:
        return (500 + (rng or random).randrange(500)) / 1000
    return float(2 << min(failures - 3, 2))


def is_retryable(error: BaseException) -> bool:
    """All failures but invalid arguments and faults of the process itself are tried again; causes count too."""
    seen: set[int] = set()
    cause: BaseException | None = error
    while cause is not None and id(cause) not in seen:
        seen.add(id(cause))
        if isinstance(cause, ValueError | TypeError | MemoryError | SystemError) or not isinstance(cause, Exception):
            return False
        cause = cause.__cause__ or cause.__context__
    return True
