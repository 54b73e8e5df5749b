"""Order without a nested loop or a task that gets all rows: running maxima, ranges of keys, stabbing queries.

Places and ticks are whole numbers: their order is cut into blocks by division, a window sweeps marks and points within each, and
what lies before a block comes from an exclusive scan over the blocks' totals, a scalar subquery. Keys are text: their order is
cut at keys sampled from the data, ranges go to every block that they meet, and so bring along what holds at its beginning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalar import present

#: Blocks of an order of keys, and states a block over which the points of hot keys are dealt.
BLOCKS, SALTS = 256, 16
#: Places a block, or a part of one if its points are dealt. An order's totals are one value a block that has any.
WIDTH = 1 << 16
#: Dyadic levels of a tick, which is below 2 ** LEVELS.
LEVELS = 40


def _at_or_below(sorted_values: Column, key: Column) -> Column:
    """How many of the sorted values are at or below ``key``, by binary search over up to 2 ** 20 of them; a null key has none."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(21))])

    def further(found: Column, step: Column) -> Column:
        at = found + step
        return F.when(at > F.size(sorted_values), found).when(F.element_at(sorted_values, at) <= key, at).otherwise(found)

    return F.aggregate(steps, F.lit(0), further)


def _totals(marks: DataFrame) -> Column:
    """Two arrays over the blocks that have marks, in order: the blocks, and the greatest value up to each, as a scalar subquery."""
    each = marks.groupBy("block").agg(F.max("value").alias("value"))
    # One row a block: what one array can hold, one task can order.
    upto = each.select("block", F.max("value").over(Window.orderBy("block")).alias("upto"))
    all_ = upto.agg(F.array_sort(F.collect_list(F.struct("block", "upto"))).alias("t"))
    return all_.select(F.struct(F.transform("t", lambda x: x["block"]).alias("blocks"), F.transform("t", lambda x: x["upto"]).alias("upto"))).scalar()


def _carried(dealt: DataFrame, totals: Column, name: str, asking: Column) -> DataFrame:
    """``dealt`` (block, ...) with the greatest value of the blocks before its own as ``name``, for the rows that are ``asking``.

    One row a block or a part of one should ask: Spark copies the totals, which grow with the order, into each row that does.
    """
    # A subquery can't stand within a lambda, so it is a column first.
    held = dealt.withColumn("_asking", asking).withColumn("_totals", F.when(F.col("_asking"), totals))
    held = held.withColumn("_n", F.when(F.col("_asking"), _at_or_below(F.col("_totals.blocks"), F.col("block") - 1)))
    return held.withColumn(name, F.when(F.col("_n") > 0, F.try_element_at("_totals.upto", F.col("_n")))).drop("_asking", "_totals", "_n")


def running_max(points: DataFrame, at: str, marks: DataFrame, mark_at: str, value: Column, name: str, width: int = WIDTH * SALTS, salts: int = SALTS) -> DataFrame:
    """``points`` with ``name``: the greatest ``value`` of the marks at or before their place; null before the first.

    Repeated points stay. Marks go to each of ``salts`` parts of a block, over which its points are dealt by hash, so a place
    that holds many points, or many after few marks, is no single task.
    """
    block = lambda c: F.floor(F.col(c) / width)
    marks = marks.select(block(mark_at).alias("block"), F.col(mark_at).alias("key"), value.alias("value"))
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    own = points.select(block(at).alias("block"), F.pmod(F.xxhash64(row), F.lit(salts)).cast("int").alias("salt"), F.lit(1).alias("kind"), F.col(at).alias("key"), row.alias("row"))
    kept, held = own.schema["row"].dataType, marks.schema["value"].dataType
    known = marks.select("block", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), "key", F.lit(None).cast(kept).alias("row"), "value")
    order = Window.partitionBy("block", "salt").orderBy("key", "kind")
    first = F.row_number().over(order) == 1
    found = _carried(known.unionByName(own.withColumn("value", F.lit(None).cast(held))), _totals(marks), "_carry", first)
    # Equal places are peers, so whichever of them was first gives all of them what lies before the block.
    upto = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = found.withColumn("value", F.max(F.greatest("value", "_carry")).over(upto)).where("row is not null")
    return swept.select("row.*", F.col("value").alias(name))


def prefix_max(rows: DataFrame, at: str, value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """``rows`` with ``name``: the greatest ``value`` of the rows before their place; null for the first."""
    own = rows.select(F.floor(F.col(at) / width).alias("block"), F.col(at).alias("key"), value.alias("value"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    order = Window.partitionBy("block").orderBy("key")
    before = own.withColumn("value", F.max("value").over(order.rangeBetween(Window.unboundedPreceding, -1)))
    found = _carried(before, _totals(own), "_carry", F.row_number().over(order) == 1)
    # No row before the first asks, so what it found holds for the whole block.
    return found.select("row.*", F.greatest("value", F.max("_carry").over(Window.partitionBy("block"))).alias(name))


def running_max_by(rows: DataFrame, by: str, order: list[str], value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """``rows`` with ``name``: the greatest ``value`` of their group's rows up to them, by ``order``, which begins with a whole number.

    A group is no single task: a window sweeps each of its blocks of ``width`` places, and what lies before a block comes from a scan
    over the group's blocks, a row each.
    """
    place = F.floor(F.col(order[0]) / width)
    own = rows.withColumns({"_block": place, "_value": value})
    so_far = own.withColumn("_value", F.max("_value").over(Window.partitionBy(by, "_block").orderBy(*order)))
    totals = own.groupBy(by, "_block").agg(F.max("_value").alias("_total"))
    before = totals.select(by, "_block", F.max("_total").over(Window.partitionBy(by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    found = so_far.join(before, [by, "_block"], "left")
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], F.greatest("_value", "_carry").alias(name))


def cuts_of(keys: DataFrame, blocks: int = BLOCKS) -> list[str]:
    """``blocks`` - 1 different keys at most, sorted: a uniform sample of the first column, those of the least hashes. Runs a job."""
    keys = keys.toDF("key").where(present(F.col("key"))).distinct()
    return sorted(r.key for r in keys.orderBy(F.xxhash64("key"), "key").limit(blocks - 1).collect())


def block_of(key: Column, cuts: list[str]) -> Column:
    """The number of a key's block: how many of the cuts are at or below it; 0 for null."""
    return _at_or_below(F.array(*map(F.lit, cuts)), key) if cuts else F.lit(0)


def blocks_met(start: Column, end: Column, cuts: list[str]) -> Column:
    """The numbers of the blocks that a half-open range meets; null and empty bounds are open. An empty range meets that of its start."""
    low = block_of(F.coalesce(start, F.lit("")), cuts)
    last = block_of(end, cuts)
    # A range that ends where a block begins doesn't meet it.
    at_cut = F.coalesce(F.array_contains(F.array(*map(F.lit, cuts)), end), F.lit(False)) if cuts else F.lit(False)
    high = F.when(present(end), last - at_cut.cast("int")).otherwise(len(cuts))
    return F.sequence(low, F.greatest(low, high))


def _nodes(low: Column, high: Column) -> Column:
    """The dyadic nodes (level, node) that make up the whole numbers from ``low`` to ``high``: two a level at most."""

    def of(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        first, end = F.floor((low + size - 1) / size), F.floor((high + 1) / size)
        node = lambda i: F.struct(level.alias("level"), i.cast("long").alias("node"))
        inside = first < end
        return F.array(F.when(inside & (first % 2 == 1), node(first)), F.when(inside & (end % 2 == 1), node(end - 1)))

    found = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), of))
    return F.filter(found, lambda n: n.isNotNull())


def stabbed(points: DataFrame, at: str, intervals: DataFrame, fold=F.max) -> DataFrame:
    """(``at``, value): for each different number of ``points``, ``fold`` over the intervals (low, high, value) that hold it.

    Numbers and bounds (both inclusive) are 0 to 2 ** LEVELS. An interval is the sum of a few dyadic nodes, and a number lies in one node a
    level, so intervals meet points by equality, however many overlap. Equal intervals are folded before they are cut, nodes before they
    are shuffled.
    """
    each = intervals.where("low <= high").groupBy("low", "high").agg(fold("value").alias("value"))
    nodes = each.select("value", F.explode(_nodes(F.col("low"), F.col("high"))).alias("n"))
    nodes = nodes.groupBy("n.level", "n.node").agg(fold("value").alias("value"))
    above = F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda x: F.struct(x.alias("level"), F.call_function("shiftright", F.col(at).cast("long"), x).alias("node")))
    asked = points.select(at).distinct().select(at, F.explode(above).alias("n")).select(at, "n.level", "n.node")
    return asked.join(nodes, ["level", "node"]).groupBy(at).agg(fold("value").alias("value"))
