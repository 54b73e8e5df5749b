"""Counters and detectors over logs and resolved timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from millrace.functions.scalar import clamped_minus


def store_stats(changelog: DataFrame, stores: DataFrame, resolved: DataFrame) -> DataFrame:
    """Regions, greatest resolved and commit timestamps by table and store.

    ``stores`` has table_id, store_id and region_id; regions without changes count.
    """
    top = changelog.groupBy("region_id").agg(F.max("commit_ts").alias("commit_ts"))
    last = resolved.groupBy("region_id").agg(F.max("resolved_ts").alias("resolved_ts"))
    joined = stores.join(top, "region_id", "left").join(last, "region_id", "left")
    return joined.groupBy("table_id", "store_id").agg(
        F.countDistinct("region_id").alias("region_count"), F.max("resolved_ts").alias("resolved_ts"), F.max("commit_ts").alias("commit_ts")
    )


def flow_units(messages: DataFrame) -> DataFrame:
    """Units by message of (message_id, kind, entries): entries (1 at least), 1 for any other event; 1 at least in all."""
    units = F.when(F.col("kind") == "entries", F.greatest(F.lit(1), F.col("entries"))).otherwise(1)
    return messages.groupBy("message_id").agg(F.greatest(F.lit(1), F.sum(units)).cast("long").alias("units"))


def penalty_streaks(resolved: DataFrame) -> DataFrame:
    """How often in a row each region's timestamp failed to rise, by tick; a rise sets it to zero."""
    by_region = Window.partitionBy("region_id").orderBy("tick")
    rows = resolved.withColumns({"_rise": _rises(by_region), "_n": F.row_number().over(by_region)})
    last = F.max(F.when(F.col("_rise"), F.col("_n"))).over(by_region.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("penalty", (F.col("_n") - last).cast("long")).drop("_rise", "_n")


def _rises(by_region: WindowSpec) -> Column:
    """Whether a timestamp is above all that its region had before; the first one is."""
    top = F.max("resolved_ts").over(by_region.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(top.isNull() | (F.col("resolved_ts") > top), F.lit(False))


def penalties(messages: DataFrame) -> DataFrame:
    """Each message of (region_id, seq, resolved_ts, event_time) with its region's ``penalty`` after it.

    A timestamp above all before sets the penalty to zero and the region's event time to its own. Any other counts if its event
    time is later than the region's, which it then becomes; older and equal ones change nothing.
    """
    by_region = Window.partitionBy("region_id").orderBy("seq")
    upto = by_region.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # All windows share one order, so rows are sorted once: runs are told by their numbers, which only grow.
    rows = messages.withColumn("_rise", _rises(by_region))
    rows = rows.withColumn("_run", F.sum(F.col("_rise").cast("long")).over(upto))
    last = F.max(F.struct("_run", "event_time")).over(by_region.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_last", last)
    counts = (F.col("_last._run") == F.col("_run")) & (F.col("event_time") > F.col("_last.event_time"))
    rows = rows.withColumn("_counts", F.sum(F.coalesce(counts.cast("long"), F.lit(0))).over(upto))
    start = F.max(F.when(F.col("_rise"), F.col("_counts"))).over(upto)
    return rows.withColumn("penalty", F.col("_counts") - start).drop("_rise", "_run", "_last", "_counts")


def lock_sweep(regions: DataFrame, now: int, least_lag: int = 20_000, penalty: int = 10, reconnect: int = 2_400_000, most: int = 64) -> DataFrame:
    """What a sweep does about the ``most`` regions that lag longest (a top-k report), by ``action``.

    ``regions`` has region_id, resolved_ts, event_time and penalty; times are milliseconds. ``reconnect`` if neither timestamp nor
    event has moved for so long, ``resolve`` the locks from so many penalties on, else ``wait``.
    """
    late = lambda name: clamped_minus(F.lit(now), F.col(name))
    top = regions.where(late("resolved_ts") >= least_lag).orderBy("resolved_ts", "region_id").limit(most)
    action = F.when((late("resolved_ts") > reconnect) & (late("event_time") > reconnect), "reconnect").when(F.col("penalty") >= penalty, "resolve").otherwise("wait")
    return top.withColumn("action", action)


def stuck(advances: DataFrame, least_gap: int) -> DataFrame:
    """The rises of the frontier that came after a gap of more than ``least_gap`` ticks."""
    return advances.where(F.col("ticks_since") > least_gap)
