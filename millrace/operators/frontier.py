"""Resolved timestamps: monotone per region, the frontier over all, and the interval map behind it."""

from __future__ import annotations

from bisect import bisect_left

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.model import MAX_TS
from millrace.operators.sweep import LEVELS, block_of, blocks_met, cuts_of, prefix_max, running_max, stabbed


def accept_resolved(messages: DataFrame, regions: DataFrame) -> DataFrame:
    """(region_id, resolved_ts) after one message: initialised regions that it doesn't set back are advanced.

    ``messages`` has region_id and resolved_ts, ``regions`` region_id, initialized, stopped and last_ts.
    """
    fits = F.col("initialized") & ~F.col("stopped") & (F.col("resolved_ts") >= F.col("last_ts"))
    both = regions.join(messages, "region_id", "left").withColumn("accepted", F.coalesce(fits, F.lit(False)))
    return both.select("region_id", F.when(F.col("accepted"), F.col("resolved_ts")).otherwise(F.col("last_ts")).alias("resolved_ts"), "accepted")


def fan_out(messages: DataFrame) -> DataFrame:
    """Messages of (tick, resolved_ts, regions), each for many regions, as a row a region; regions named twice count once."""
    return messages.select("tick", F.explode(F.array_distinct("regions")).alias("region_id"), "resolved_ts")


def resolved_progress(resolved: DataFrame) -> DataFrame:
    """Each message with the greatest timestamp that its region had before and has now, by tick."""
    by_region = Window.partitionBy("region_id").orderBy("tick")
    now = F.max("resolved_ts").over(by_region)
    before = F.max("resolved_ts").over(by_region.rowsBetween(Window.unboundedPreceding, -1))
    return resolved.withColumns({"effective_ts": now, "regressed": F.coalesce(F.col("resolved_ts") < before, F.lit(False))})


def region_frontier(resolved: DataFrame) -> DataFrame:
    """(tick, frontier): the least of the regions' greatest timestamps, at each tick from that on at which all regions are known.

    A region that is silent in a tick keeps what it had: what a message makes of it holds from its tick to the next message's. The least of
    what holds at a tick is a stabbing query over these intervals, so no region meets a tick at which it said nothing, and those of
    regions that spoke at the same ticks are one.
    """
    by_region = Window.partitionBy("region_id").orderBy("tick")
    until = F.coalesce(F.lead("tick").over(by_region) - 1, F.lit((1 << LEVELS) - 1))
    top = F.max("resolved_ts").over(by_region.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # Of several messages in a tick the last one's interval is left, with the greatest of all.
    held = resolved.select(F.col("tick").alias("low"), until.alias("high"), top.alias("value"))
    known = resolved.groupBy("region_id").agg(F.min("tick").alias("first")).agg(F.max("first")).scalar()
    return stabbed(resolved.select("tick").where(F.col("tick") >= known), "tick", held, F.min).withColumnRenamed("value", "frontier")


def rises(frontier: DataFrame) -> DataFrame:
    """(tick, resolved_ts): the ticks at which the frontier rises. It never falls, so these are the first ticks of its values."""
    return frontier.where(F.col("frontier") > 0).groupBy(F.col("frontier").alias("resolved_ts")).agg(F.min("tick").alias("tick")).select("tick", "resolved_ts")


def advances(frontier: DataFrame) -> DataFrame:
    """The rises of the frontier, with the ticks since the one before (null for the first)."""
    found = prefix_max(rises(frontier), "tick", F.col("tick"), "_last")
    return found.select("tick", "resolved_ts", (F.col("tick") - F.col("_last")).alias("ticks_since"))


def segments(forwards: DataFrame) -> DataFrame:
    """(start_key, ts): the interval map after all ``forwards`` (seq, start_key, end_key, ts), by assignment in order.

    The least seq is the initial span. A boundary goes when a later forward covers it strictly inside, and
    neighbours of equal value stay apart. Where nothing has been assigned the value is MAX_TS. Only the last
    forward of each (start_key, end_key) can matter. Each goes to the blocks of keys that it meets, where they are applied in
    order: a block's map has as many entries as boundaries lie in it, however long the log.
    """
    last = forwards.groupBy("start_key", "end_key").agg(F.max_by("ts", "seq").alias("ts"), F.max("seq").alias("seq"))
    cuts = cuts_of(forwards.select("start_key"))
    lows, highs = ["", *cuts], [*cuts, None]
    # Where a range ends is a boundary too, which may be the first key of the next block.
    blocks = F.array_union(blocks_met(F.col("start_key"), F.col("end_key"), cuts), F.array(block_of(F.col("end_key"), cuts)))

    def apply(group: pd.DataFrame) -> pd.DataFrame:
        block = int(group["block"].iloc[0])
        low, high = lows[block], highs[block]
        starts, values, real = [low], [MAX_TS], False
        for start, end, ts in group.sort_values("seq")[["start_key", "end_key", "ts"]].itertuples(index=False):
            if end > low:
                # The block's first key is a boundary if the last that met it began there, not if it covers it.
                real = start == low if start <= low else real
                assign(starts, values, max(start, low), "" if high is not None and end >= high else end, ts)
            elif end == low:
                real = True
        begin = 0 if real else 1
        return pd.DataFrame({"start_key": pd.Series(starts[begin:], dtype=object), "ts": pd.Series(values[begin:], dtype="int64")})

    return last.withColumn("block", F.explode(blocks)).groupBy("block").applyInPandas(apply, "start_key string, ts long")


def assign(starts: list[str], values: list[int], start: str, end: str, ts: int) -> None:
    """Set the value of [start, end) in an interval map of sorted starts; boundaries strictly inside go, an empty end is open."""
    i, j = bisect_left(starts, start), bisect_left(starts, end) if end else len(starts)
    new_starts, new_values = [start], [ts]
    if end and (j == len(starts) or starts[j] != end):
        new_starts.append(end)
        new_values.append(values[j - 1])
    starts[i:j], values[i:j] = new_starts, new_values


def frontier_of(found: DataFrame) -> DataFrame:
    return found.agg(F.min("ts").alias("frontier"))


def printed(found: DataFrame) -> DataFrame:
    """The map as one line, in key order; a bounded map only (it goes to one row)."""
    text = F.concat(F.lit("["), F.col("start_key"), F.lit(" @ "), F.when(F.col("ts") == MAX_TS, "Max").otherwise(F.col("ts").cast("string")), F.lit("] "))
    items = F.array_sort(F.collect_list(F.struct("start_key", text.alias("text"))))
    return found.agg(F.array_join(F.transform(items, lambda x: x["text"]), "").alias("segments"))


def slowest(found: DataFrame) -> DataFrame:
    """(start_key, end_key, ts) of the least advanced segment, the first of equal ones."""
    least = found.agg(F.min(F.struct("ts", "start_key")).alias("s"))
    after = found.where(F.col("start_key") > least.select("s.start_key").scalar()).agg(F.min("start_key")).scalar()
    return least.where("s is not null").select("s.start_key", after.alias("end_key"), "s.ts")


def with_frontier(changelog: DataFrame, frontier: DataFrame, at: str = "emit_seq") -> DataFrame:
    """Each change with the frontier as of its place in the log; -1 before the first.

    ``frontier`` has from_seq (from which place on it holds) and resolved_ts, a row an advance. Both sides are swept in blocks of
    places; repeated changes stay.
    """
    found = running_max(changelog, at, frontier, "from_seq", F.col("resolved_ts"), "frontier_ts")
    return found.withColumn("frontier_ts", F.coalesce("frontier_ts", F.lit(-1)))


def is_late(commit_ts: Column, frontier_ts: Column) -> Column:
    """Row changes at or below the frontier come too late."""
    return commit_ts <= frontier_ts
