"""Half-open key ranges: comparison, intersection, containment, division and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.scalar import present
from millrace.model import REGION_ERRORS, ClientError
from millrace.operators.sweep import SALTS, block_of, blocks_met, cuts_of


def compare_starts(a: Column, b: Column) -> Column:
    """-1, 0 or 1; a null start is before all others."""
    return F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), -1).when(b.isNull(), 1).otherwise(_sign(a, b))


def compare_ends(a: Column, b: Column) -> Column:
    """-1, 0 or 1; a null end is after all others."""
    return F.when(a.isNull() & b.isNull(), 0).when(a.isNull(), 1).when(b.isNull(), -1).otherwise(_sign(a, b))


def _sign(a: Column, b: Column) -> Column:
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def closed(start: Column, end: Column, top: Column) -> tuple[Column, Column]:
    """A range with its open bounds filled in: the empty key below, ``top`` above."""
    return F.when(present(start), start).otherwise(F.lit("").cast("string")), F.when(present(end), end).otherwise(top)


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Whether two ranges have a key in common; null or empty ends are open."""
    return (~present(b_end) | a_start.isNull() | (a_start < b_end)) & (~present(a_end) | b_start.isNull() | (b_start < a_end))


def intersection(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> tuple[Column, Column]:
    """The common part of two ranges that overlap."""
    ends = F.when(~present(a_end), b_end).when(~present(b_end), a_end).otherwise(F.least(a_end, b_end))
    return F.greatest(a_start, b_start), ends


def locate(points: DataFrame, key: str, regions: DataFrame) -> DataFrame:
    """The points with the region_id of the region that holds their ``key``; points in no region go. Regions don't overlap.

    Regions go to the blocks of keys that they meet and are swept there with the points, which are dealt by hash over parts of
    their block: one shuffle of the points, however many fall into one region.
    """
    cuts = cuts_of(regions.select("start_key"))
    row = F.struct(*[F.col(f"`{c}`") for c in points.columns])
    region = F.struct("region_id", "end_key")
    part = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    known = regions.select("start_key", region.alias("region"), F.explode(blocks_met(F.col("start_key"), F.col("end_key"), cuts)).alias("block")).withColumn("salt", part)
    known = known.select("block", "salt", F.coalesce("start_key", F.lit("")).alias("key"), F.lit(0).alias("kind"), "region", F.lit(None).cast(points.select(row.alias("r")).schema["r"].dataType).alias("row"))
    asked = points.select(block_of(F.col(key), cuts).alias("block"), F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int").alias("salt"), F.col(key).alias("key"), F.lit(1).alias("kind"), F.lit(None).cast(known.schema["region"].dataType).alias("region"), row.alias("row"))
    order = Window.partitionBy("block", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = known.unionByName(asked).withColumn("region", F.last("region", ignorenulls=True).over(order)).where("row is not null and region is not null and key is not null")
    return swept.where(~present(F.col("region.end_key")) | (F.col("key") < F.col("region.end_key"))).select("row.*", "region.region_id")


def divide(spans: DataFrame, regions: DataFrame, checkpoint_ts: int = 0) -> DataFrame:
    """(span_id, region_id, start_key, end_key, resolved_ts): each span cut along the regions that it meets.

    ``spans`` has span_id, start_key, end_key and may overlap; regions don't. Both go to the blocks of keys that they meet. There a
    sweep numbers the regions and tells each span the first and the last of those it meets, which are then joined by number. A
    pair that meets in several blocks counts in that in which its common part begins.
    """
    cuts = cuts_of(regions.select("start_key"))
    met = lambda rows, name: rows.select(F.col(name).alias("id"), "start_key", "end_key", F.explode(blocks_met(F.col("start_key"), F.col("end_key"), cuts)).alias("block"))
    r, s = met(regions, "region_id"), met(spans, "span_id")
    r = r.select("*", F.row_number().over(Window.partitionBy("block").orderBy(F.col("start_key").asc_nulls_first())).alias("number"))
    open_ = ~present(F.col("end_key"))
    known = r.select("block", F.lit(False).alias("far"), F.col("start_key").alias("key"), F.lit(1).alias("kind"), "number", F.lit(None).cast("struct<id:bigint,start_key:string,end_key:string>").alias("span"))
    span, none = F.struct("id", "start_key", "end_key").alias("span"), F.lit(None).cast("int").alias("number")
    # Regions that start where a span ends lie behind it; one that starts where it starts is met.
    first = s.select("block", F.lit(False).alias("far"), F.col("start_key").alias("key"), F.lit(2).alias("kind"), none, span)
    last = s.select("block", open_.alias("far"), F.when(~open_, F.col("end_key")).alias("key"), F.lit(0).alias("kind"), none, span)
    order = Window.partitionBy("block").orderBy("far", F.col("key").asc_nulls_first(), "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = known.unionByName(first).unionByName(last).withColumn("number", F.max("number").over(order)).where("span is not null")
    ends = swept.groupBy("block", "span").agg(F.max(F.when(F.col("kind") == 2, F.col("number"))).alias("low"), F.max(F.when(F.col("kind") == 0, F.col("number"))).alias("high"))
    each = ends.where("high is not null").select("block", "span", F.explode(F.sequence(F.coalesce("low", F.lit(1)), F.greatest("high", F.coalesce("low", F.lit(1))))).alias("number"))
    both = each.alias("s").join(r.alias("r"), ["block", "number"])
    a, b, c, d = F.col("span.start_key"), F.col("span.end_key"), F.col("r.start_key"), F.col("r.end_key")
    start, end = intersection(a, b, c, d)
    here = both.where(overlaps(a, b, c, d)).where(F.col("block") == block_of(F.coalesce(F.greatest(a, c), F.lit("")), cuts))
    return here.select(F.col("span.id").alias("span_id"), F.col("r.id").alias("region_id"), start.alias("start_key"), end.alias("end_key"), F.lit(checkpoint_ts).cast("long").alias("resolved_ts"))


def contained(spans: DataFrame, parents: DataFrame) -> DataFrame:
    """The spans that lie within one parent as a whole; empty and reversed spans fail the query.

    Of the parents that start at or before a span, which may overlap, the one that reaches furthest decides. Parents go to every
    block of keys that they meet and are swept there with the spans' starts.
    """
    ok = F.when(~present(F.col("end_key")) | F.col("start_key").isNull() | (F.col("start_key") < F.col("end_key")), F.lit(True)).otherwise(F.raise_error(F.lit("a span must start before its end")).cast("boolean"))
    cuts = cuts_of(parents.select("start_key"))
    reach = F.struct((~present(F.col("end_key"))).alias("open"), F.col("end_key").alias("end"))
    row = F.struct(*[F.col(f"`{c}`") for c in spans.columns])
    kept = spans.select(row.alias("r")).schema["r"].dataType
    key = F.coalesce("start_key", F.lit("")).alias("key")
    part = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    known = parents.select("start_key", reach.alias("reach"), F.explode(blocks_met(F.col("start_key"), F.col("end_key"), cuts)).alias("block")).select("block", part, key, F.lit(0).alias("kind"), "reach", F.lit(None).cast(kept).alias("row"))
    asked = spans.where(ok).select(block_of(key, cuts).alias("block"), F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int").alias("salt"), key, F.lit(1).alias("kind"), F.lit(None).cast(known.schema["reach"].dataType).alias("reach"), row.alias("row"))
    order = Window.partitionBy("block", "salt").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = known.unionByName(asked).withColumn("reach", F.max("reach").over(order)).where("row is not null and reach is not null").select("row.*", "reach")
    return swept.where(F.col("reach.open") | (present(F.col("end_key")) & (F.col("end_key") <= F.col("reach.end")))).drop("reach")


def handle_splits(spark: SparkSession, n: int) -> DataFrame:
    """(split, low, high): the 64-bit handles dealt into ``n`` ranges, high exclusive; outer bounds are null (open)."""
    if n <= 0:
        raise ClientError("the number of splits must be positive")
    low, high = -(1 << 63), (1 << 63) - 1
    delta = (high - (low + 1)) // n
    at = lambda i: (F.lit(low).cast("decimal(38,0)") + F.lit(delta).cast("decimal(38,0)") * i).cast("long")
    rows = spark.range(n).select(F.col("id").alias("split"))
    return rows.select("split", F.when(F.col("split") > 0, at(F.col("split"))).alias("low"), F.when(F.col("split") < n - 1, at(F.col("split") + 1)).alias("high"))


def redivided(old: DataFrame, current: DataFrame) -> DataFrame:
    """Regions whose epoch (conf_ver, version) is not that of ``current``: their ranges must be divided anew."""
    now = current.select("region_id", F.col("conf_ver").alias("new_conf_ver"), F.col("version").alias("new_version"))
    return old.join(now, "region_id").where((F.col("conf_ver") != F.col("new_conf_ver")) | (F.col("version") != F.col("new_version")))


def sorted_regions(regions: DataFrame) -> DataFrame:
    return regions.orderBy("region_id")


def recovered(errors: DataFrame, current: DataFrame) -> DataFrame:
    """What becomes of regions in error: (error_id, action, region_id, start_key, end_key, restart_ts).

    ``errors`` has error_id (the region), error, conf_ver, version, start_key, end_key and resolved_ts, ``current`` has region_id,
    conf_ver, version, start_key, end_key and resolved_ts. A lost leader of a region whose epoch still is the same
    is looked up again (``relocate``). A changed epoch means that the region was split or merged: its range is divided along
    the current regions (``redivide``), which all start from the least of the known timestamps.
    Other errors fail the query.
    """
    names = F.create_map(*[F.lit(x) for pair in REGION_ERRORS.items() for x in pair])
    known = F.coalesce(F.try_element_at(names, F.col("error")), F.lit("fail"))
    failed = F.raise_error(F.concat(F.lit("region "), F.col("error_id").cast("string"), F.lit(": "), F.col("error"))).cast("string")
    now = current.select(F.col("region_id").alias("error_id"), F.col("conf_ver").alias("_conf_ver"), F.col("version").alias("_version"))
    same = F.coalesce((F.col("conf_ver") == F.col("_conf_ver")) & (F.col("version") == F.col("_version")), F.lit(False))
    action = F.when(known == "fail", failed).when((known == "relocate") & same, "relocate").otherwise("redivide")
    rows = errors.join(now, "error_id", "left").withColumn("action", action)
    stay = rows.where("action = 'relocate'").select("error_id", "action", F.col("error_id").alias("region_id"), "start_key", "end_key", F.col("resolved_ts").alias("restart_ts"))
    parts = divide(rows.where("action = 'redivide'").withColumnRenamed("error_id", "span_id"), current).drop("resolved_ts").withColumnRenamed("span_id", "error_id")
    parts = parts.join(current.select("region_id", "resolved_ts"), "region_id")
    least = restart_ts(errors.select("error_id", "resolved_ts"), parts.select("error_id", "region_id", "resolved_ts"))
    found = parts.drop("resolved_ts").join(least, ["error_id", "region_id"]).withColumn("action", F.lit("redivide"))
    return stay.unionByName(found.select(*stay.columns))


def restart_ts(errors: DataFrame, divided: DataFrame) -> DataFrame:
    """For each region in error, the regions that its range now has, all from the least of the known timestamps.

    ``errors`` has error_id and resolved_ts, ``divided`` has error_id, region_id and resolved_ts; null where a region has sent none, which
    is restarted with the others.
    """
    known = F.when(F.col("resolved_ts").isNotNull(), F.col("region_id"))
    first = divided.groupBy("error_id").agg(F.min_by("resolved_ts", known).alias("first_ts"))
    start = errors.join(first, "error_id").select("error_id", F.least("resolved_ts", "first_ts").alias("restart_ts"))
    return divided.drop("resolved_ts").join(start, "error_id")
