"""One query an operator, over the log that ``sources.derived`` makes of ``events``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import codecs, scalar
from millrace.operators import delivery, diagnostics, frontier, matcher, ranges
from millrace.sources import derived, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.change_log(spark, sf_dir)


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matcher.changes(log(spark, sf_dir), derived.key_regions(spark, sf_dir))


CHANGE = ["emit_seq", "region_id", "key", "start_ts", "commit_ts", "new_value", "old_value", "operate_type"]


@query
def op_classify(spark, sf_dir):
    name = scalar.operate_type(F.col("op_type"), F.col("old_value"))
    rows = log(spark, sf_dir).where("log_type in ('PREWRITE', 'COMMITTED')").withColumn("operate_type", name)
    return rows.select("seq", "region_id", "operate_type", scalar.operate_code(F.col("operate_type")).alias("operate_code"), scalar.operate_name(scalar.operate_code(F.col("operate_type"))).alias("operate_name"))


@query
def key_range_filter(spark, sf_dir):
    return matcher.in_range(log(spark, sf_dir), derived.key_regions(spark, sf_dir)).select("seq", "region_id", "log_type", "key")


@query
def region_assign(spark, sf_dir):
    keys = log(spark, sf_dir).where("log_type = 'COMMIT'").select("seq", "key")
    return ranges.locate(keys, "key", derived.key_regions(spark, sf_dir)).select("seq", "key", "region_id")


def _cases(spark, sf_dir, *cases):
    rows = matcher.in_range(log(spark, sf_dir), derived.key_regions(spark, sf_dir))
    return matcher.matched(rows).where(F.col("case").isin(*cases)).select("case", "emit_seq", "region_id", "key", "start_ts", "commit_ts", "new_value")


@query
def prewrite_commit_match(spark, sf_dir):
    return _cases(spark, sf_dir, "A", "D")


@query
def early_commit_match(spark, sf_dir):
    return _cases(spark, sf_dir, "C", "E")


@query
def cached_commit_release(spark, sf_dir):
    return _cases(spark, sf_dir, "B")


@query
def rollback_anti(spark, sf_dir):
    rows = matcher.in_range(log(spark, sf_dir), derived.key_regions(spark, sf_dir))
    pairs = matcher.candidates(rows)
    return matcher.not_rolled_back(pairs, rows).where(F.col("case") == "D").groupBy("region_id").agg(F.count("*").alias("pairs"), F.max("commit_seq").alias("last_seq"))


@query
def committed_passthrough(spark, sf_dir):
    rows = matcher.in_range(log(spark, sf_dir), derived.key_regions(spark, sf_dir))
    return rows.where("log_type = 'COMMITTED'").select(F.col("seq").alias("emit_seq"), "region_id", "key", "commit_ts", "new_value", "old_value")


@query
def fake_prewrite_dedup(spark, sf_dir):
    return matcher.first_prewrites(log(spark, sf_dir)).select("seq", "region_id", "key", "start_ts", "new_value", "old_value")


@query
def changelog_ordered(spark, sf_dir):
    return matcher.ordered(changelog(spark, sf_dir).select(*CHANGE))


@query
def update_split(spark, sf_dir):
    return matcher.split_updates(changelog(spark, sf_dir)).select("emit_seq", "region_id", "key", "commit_ts", "operate_type", "split_kind", "new_value", "old_value")


def resolved(spark, sf_dir):
    return derived.resolved_log(spark, sf_dir)


def front(spark, sf_dir):
    """The frontier over all regions at each tick, from the messages that can hold it."""
    return frontier.region_frontier(derived.lowest_log(spark, sf_dir))


@query
def resolved_max_merge(spark, sf_dir):
    return frontier.resolved_progress(resolved(spark, sf_dir)).select("region_id", "tick", "effective_ts")


@query
def resolved_regressions(spark, sf_dir):
    return frontier.resolved_progress(resolved(spark, sf_dir)).where("regressed").select("region_id", "tick", "resolved_ts", "effective_ts")


@query
def resolved_accept(spark, sf_dir):
    rows = resolved(spark, sf_dir)
    last = rows.where("tick = 3").select("region_id", F.col("resolved_ts").alias("last_ts"), (F.col("region_id") % 5 != 0).alias("initialized"), (F.col("region_id") % 7 == 0).alias("stopped"))
    return frontier.accept_resolved(rows.where("tick = 4").select("region_id", "resolved_ts"), last)


@query
def region_frontier(spark, sf_dir):
    return front(spark, sf_dir)


@query
def frontier_advances(spark, sf_dir):
    return frontier.advances(front(spark, sf_dir))


def forwards(spark, sf_dir):
    """Every region's progress as assignments to its range, after an initial span over all keys.

    Only the last of a range can matter, and a region's range is always the same. So they are reduced by region before they get their
    keys: Spark takes the messages for as small as the table they are made of, and would broadcast them all.
    """
    seq = F.col("tick") * 100_000 + F.col("region_id")
    last = resolved(spark, sf_dir).groupBy("region_id").agg(F.max_by("resolved_ts", seq).alias("ts"), F.max(seq).alias("seq"))
    steps = last.join(derived.key_regions(spark, sf_dir), "region_id").select("seq", "start_key", "end_key", "ts")
    whole = spark.range(1).select(F.lit(0).cast("long").alias("seq"), F.lit("").alias("start_key"), F.lit("~").alias("end_key"), F.lit(0).cast("long").alias("ts"))
    return steps.unionByName(whole)


@query
def frontier_segments(spark, sf_dir):
    return frontier.segments(forwards(spark, sf_dir))


@query
def slowest_range(spark, sf_dir):
    return frontier.slowest(frontier.segments(forwards(spark, sf_dir)).where("start_key <> ''"))


def as_of_frontier(spark, sf_dir):
    series = frontier.rises(front(spark, sf_dir)).select((F.col("tick") * 8000 + 7000).alias("from_seq"), "resolved_ts")
    return frontier.with_frontier(changelog(spark, sf_dir).select(*CHANGE), series)


@query
def late_filter_asof(spark, sf_dir):
    rows = as_of_frontier(spark, sf_dir)
    return rows.where(~frontier.is_late(F.col("commit_ts"), F.col("frontier_ts"))).select("emit_seq", "region_id", "key", "commit_ts", "frontier_ts")


@query
def commit_ts_violations(spark, sf_dir):
    rows = matcher.in_range(log(spark, sf_dir), derived.key_regions(spark, sf_dir)).where("log_type in ('COMMIT', 'COMMITTED')")
    series = frontier.rises(front(spark, sf_dir)).select((F.col("tick") * 8000 + 7000).alias("from_seq"), "resolved_ts")
    rows = frontier.with_frontier(rows.select("seq", "region_id", "log_type", "commit_ts"), series, at="seq")
    return delivery.resolved_violations(rows)


@query
def end_ts_stop(spark, sf_dir):
    return delivery.until_end(changelog(spark, sf_dir), 50_000).select("emit_seq", "region_id", "key", "commit_ts")


@query
def start_rewind(spark, sf_dir):
    options = delivery.Options(rewind=20_000)
    return delivery.from_start(changelog(spark, sf_dir), 60_000, options).select("emit_seq", "region_id", "key", "commit_ts")


@query
def checkpoint_progress(spark, sf_dir):
    return delivery.checkpoints(changelog(spark, sf_dir)).select("emit_seq", "region_id", "key", "commit_ts", "checkpoint_ts")


def spans(spark, sf_dir):
    """A span over each three regions' keys, from the middle of the first to the middle of the last."""
    r, key = F.col("region_id"), lambda x: F.lpad(x.cast("string"), 8, "0")
    return derived.key_regions(spark, sf_dir).select(r.alias("span_id"), key((r - 1) * 20 + 10).alias("start_key"), key((r + 1) * 20 + 10).alias("end_key"))


@query
def range_intersect(spark, sf_dir):
    a, b = spans(spark, sf_dir).alias("a"), derived.key_regions(spark, sf_dir).alias("b")
    columns = [F.col(x) for x in ("a.start_key", "a.end_key", "b.start_key", "b.end_key")]
    start, end = ranges.intersection(*columns)
    return a.join(b, F.col("span_id") == F.col("region_id")).select("span_id", start.alias("start_key"), end.alias("end_key"))


@query
def range_compare(spark, sf_dir):
    a, b = spans(spark, sf_dir), derived.key_regions(spark, sf_dir).select("region_id", F.col("start_key").alias("s"), F.col("end_key").alias("e"))
    rows = a.join(b, F.col("span_id") == F.col("region_id"))
    start = F.when(F.col("span_id") % 3 != 0, F.col("start_key"))
    end = F.when(F.col("span_id") % 4 != 0, F.col("end_key"))
    return rows.select("span_id", ranges.compare_starts(start, F.col("s")).alias("starts"), ranges.compare_ends(end, F.col("e")).alias("ends"))


@query
def range_contains(spark, sf_dir):
    regions = derived.key_regions(spark, sf_dir)
    r, key = F.col("region_id"), lambda x: F.lpad(x.cast("string"), 8, "0")
    parts = regions.select(r.alias("span_id"), key((r - 1) * 20 + r % 3).alias("start_key"), key((r - 1) * 20 + 19 + r % 3).alias("end_key"))
    return ranges.contained(parts, regions)


@query
def region_division(spark, sf_dir):
    return ranges.divide(spans(spark, sf_dir), derived.key_regions(spark, sf_dir), 42)


def epochs(spark, sf_dir):
    r = F.col("region_id")
    old = derived.key_regions(spark, sf_dir).select("region_id", F.lit(1).cast("long").alias("conf_ver"), (r % 3).alias("version"))
    now = derived.key_regions(spark, sf_dir).select("region_id", F.when(r % 5 == 0, 2).otherwise(1).cast("long").alias("conf_ver"), (r % 3 + F.when(r % 4 == 0, 1).otherwise(0)).alias("version"))
    return old, now


@query
def epoch_redivide(spark, sf_dir):
    return ranges.redivided(*epochs(spark, sf_dir))


@query
def restart_min_ts(spark, sf_dir):
    last = resolved(spark, sf_dir).where("tick <= 2").groupBy("region_id").agg(F.max_by("resolved_ts", "tick").alias("resolved_ts"))
    errors = last.select(F.col("region_id").alias("error_id"), "resolved_ts")
    divided = ranges.divide(spans(spark, sf_dir), derived.key_regions(spark, sf_dir)).select(F.col("span_id").alias("error_id"), "region_id")
    return ranges.restart_ts(errors, divided.join(last, "region_id", "left"))


@query
def handle_space_splits(spark, sf_dir):
    return ranges.handle_splits(spark, 1000)


def requested(spark, sf_dir):
    """The log with request numbers that grow by region, and now and then an old one."""
    seq = F.col("seq")
    return log(spark, sf_dir).withColumn("request_id", F.floor(seq / 5000) + 1 - F.when(seq % 29 == 0, 1).otherwise(0)).where("log_type <> 'INITIALIZED'")


@query
def stale_request_drop(spark, sf_dir):
    return matcher.fresh_requests(requested(spark, sf_dir)).select("seq", "region_id", "request_id")


@query
def unknown_region_drop(spark, sf_dir):
    known = derived.key_regions(spark, sf_dir).where("region_id % 3 <> 0")
    return matcher.of_known_regions(log(spark, sf_dir), known).select("seq", "region_id", "log_type")


@query
def stopped_region_drop(spark, sf_dir):
    stopped = derived.key_regions(spark, sf_dir).where("region_id % 3 = 0")
    return matcher.without_stopped(log(spark, sf_dir), stopped).select("seq", "region_id", "log_type")


@query
def table_store_stats(spark, sf_dir):
    stores = derived.key_regions(spark, sf_dir).select(F.lit(7).cast("long").alias("table_id"), (F.col("region_id") % 3).alias("store_id"), "region_id")
    return diagnostics.store_stats(changelog(spark, sf_dir), stores, resolved(spark, sf_dir))


@query
def flow_units(spark, sf_dir):
    rows = log(spark, sf_dir).groupBy(F.floor(F.col("seq") / 640).alias("message_id"), "region_id").agg(
        F.first(F.lit("entries")).alias("kind"), F.sum(F.when(F.col("log_type") == "COMMIT", 1).otherwise(0)).alias("entries")
    )
    return diagnostics.flow_units(rows.select("message_id", "kind", "entries"))


@query
def message_counts(spark, sf_dir):
    rows = delivery.oversize(log(spark, sf_dir), delivery.Options(max_row_bytes=20))
    return rows.groupBy("log_type", scalar.size_in_kb(F.col("row_bytes")).alias("kb")).agg(F.count("*").alias("entries"), F.sum(F.when(F.length("key") > 0, 1).otherwise(0)).alias("with_key"))


@query
def penalty_streak(spark, sf_dir):
    return diagnostics.penalty_streaks(resolved(spark, sf_dir)).select("region_id", "tick", "resolved_ts", "penalty")


@query
def lag_topk(spark, sf_dir):
    last = resolved(spark, sf_dir).groupBy("region_id").agg(F.max_by("resolved_ts", "tick").alias("resolved_ts"))
    return delivery.expired(last, 200_000, 20_000)


@query
def stuck_gaps(spark, sf_dir):
    return diagnostics.stuck(frontier.advances(front(spark, sf_dir)), 1)


@query
def backoff_schedule(spark, sf_dir):
    low, high = scalar.retry_delay_bounds(F.col("failures"))
    return spark.range(1, 11).select(F.col("id").alias("failures")).select("failures", low.alias("least_ms"), high.alias("most_ms"))


@query
def slot_bucket(spark, sf_dir):
    return log(spark, sf_dir).groupBy(scalar.slot(F.col("region_id"), 4).alias("slot")).agg(F.count("*").alias("entries"), F.countDistinct("region_id").alias("regions"))


@query
def clamped_difference(spark, sf_dir):
    ts = F.when(F.col("start_ts") % 3 == 0, F.lit(-(1 << 63)).cast("long") + F.col("start_ts")).otherwise(F.col("start_ts"))
    return log(spark, sf_dir).select("seq", "region_id", "log_type", scalar.clamped_minus(ts, F.col("start_ts") * 2).alias("difference"))


@query
def prewrite_echo(spark, sf_dir):
    found = matcher.changes(log(spark, sf_dir), derived.key_regions(spark, sf_dir), include_prewrite_echo=True)
    return found.where("commit_ts = 0").select("emit_seq", "region_id", "key", "start_ts", "new_value")


@query
def entry_copy(spark, sf_dir):
    named = log(spark, sf_dir).withColumns({"db_name": F.lit("db"), "table_name": F.lit("events"), "table_info": F.lit("{}")})
    return delivery.copied(named).drop("new_value", "old_value")


@query
def table_key_range(spark, sf_dir):
    start, end = codecs.table_range(F.col("region_id"))
    return derived.key_regions(spark, sf_dir).select("region_id", F.hex(start).alias("start_key"), F.hex(end).alias("end_key"))


@query
def table_columns(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return tables.described(spark, schema).select("position", "name")


@query
def key_columns_by_place(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    names = [f.name for f in tables.key_columns(schema, {"l_linenumber", "l_orderkey"})]
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


@query
def id_allocation(spark, sf_dir):
    ids = scalar.with_ids(log(spark, sf_dir).select("seq", "region_id"))
    return ids.agg(F.count("*").alias("entries"), F.countDistinct("id").alias("ids"), F.min("id").alias("least"), F.max("id").alias("greatest"))


@query
def resolved_fan_out(spark, sf_dir):
    messages = derived.messages(spark, sf_dir).groupBy("tick", F.lit(5000 * 7).cast("long").alias("resolved_ts")).agg(F.collect_list("region_id").alias("regions"))
    return frontier.fan_out(messages)


@query
def penalty_by_event_time(spark, sf_dir):
    rows = resolved(spark, sf_dir).withColumns({"seq": F.col("tick"), "event_time": F.col("tick") * 10 - F.when(F.col("tick") % 3 == 0, 25).otherwise(0)})
    return diagnostics.penalties(rows).select("region_id", "seq", "resolved_ts", "event_time", "penalty")


@query
def lock_sweep(spark, sf_dir):
    last = resolved(spark, sf_dir).groupBy("region_id").agg(F.max("resolved_ts").alias("resolved_ts"))
    rows = last.withColumns({"event_time": F.col("region_id") * 1000, "penalty": F.col("region_id") % 20})
    return diagnostics.lock_sweep(rows, 2_500_000, reconnect=2_400_000)


@query
def sorted_regions(spark, sf_dir):
    return ranges.sorted_regions(derived.key_regions(spark, sf_dir))


@query
def region_recovery(spark, sf_dir):
    old, now = epochs(spark, sf_dir)
    last = resolved(spark, sf_dir).groupBy("region_id").agg(F.min("resolved_ts").alias("resolved_ts"))
    spans_, bounds = spans(spark, sf_dir).withColumnRenamed("span_id", "region_id"), derived.key_regions(spark, sf_dir)
    kind = F.when(F.col("region_id") % 2 == 0, "NotLeader").otherwise("EpochNotMatch")
    errors = old.join(spans_, "region_id").join(last, "region_id").withColumn("error", kind).withColumnRenamed("region_id", "error_id")
    return ranges.recovered(errors, now.join(bounds, "region_id").join(last, "region_id"))


@query
def time_since_event(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", scalar.time_since(F.col("ts"), F.to_timestamp_ntz(F.lit("2030-01-01 00:00:00"))).cast("long").alias("ms"))


@query
def packed_datetime_decode(spark, sf_dir):
    packed = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", codecs.pack_datetime(F.col("ts")).alias("packed"))
    return packed.select("event_id", codecs.packed_datetime(F.col("packed")).cast("string").alias("at"))


@query
def pk_string_decode(spark, sf_dir):
    raw = F.concat(F.encode("key", "UTF-8"), F.unhex(F.lit("0000")))
    return log(spark, sf_dir).where("log_type = 'COMMIT'").select("seq", codecs.key_text(raw).alias("pk"))


@query
def memcomparable_hex(spark, sf_dir):
    keys = derived.transactions(spark, sf_dir).select("key", F.concat(F.col("key"), F.substring("op", 1, 1)).alias("longer")).distinct()
    back = codecs.from_memcomparable(codecs.memcomparable(F.col("longer")))
    return keys.select("key", codecs.memcomparable_hex(F.col("key")).alias("encoded"), codecs.memcomparable_hex(F.col("longer")).alias("longer_encoded"), back.cast("string").alias("longer"))


@query
def composite_key_decode(spark, sf_dir):
    """Keys of text of any length, a date and numbers: their order-preserving bytes, and what is read back from them."""
    at = F.expr("make_timestamp_ntz(2000, 1, 1, 0, 0, c_custkey % 60)")
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("segment"), F.col("c_name").alias("name"), (F.lit(3) - F.col("c_custkey")).alias("number"), at.alias("at"))
    schema = T.StructType().add("segment", "string").add("number", "long").add("at", "timestamp_ntz").add("name", "string")
    keys = rows.select("c_custkey", codecs.encode_key({f.name: f.dataType for f in schema.fields}).alias("raw"))
    back = codecs.decode_key(keys, "raw", schema)
    return back.select("c_custkey", F.hex("raw").alias("encoded"), "segment", "number", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), "name")


@query
def snapshot_latest(spark, sf_dir):
    return matcher.snapshot(changelog(spark, sf_dir))


@query
def snapshot_asof(spark, sf_dir):
    return matcher.snapshot(changelog(spark, sf_dir), 40_000)


@query
def change_counts(spark, sf_dir):
    window = F.floor(F.col("commit_ts") / 10_000)
    return changelog(spark, sf_dir).groupBy(window.alias("window"), "operate_type").agg(F.count("*").alias("n"), F.round(F.sum("new_value"), 3).alias("total"))
