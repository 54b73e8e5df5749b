"""From log rows to row changes: two-phase entries joined, rolled back, and released on initialisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scalar import operate_type, present
from millrace.model import COMMIT, COMMITTED, INITIALIZED, MARKS, PREWRITE, ROLLBACK
from millrace.operators.sweep import running_max_by

KEYS = ["region_id", "start_ts", "key"]


def in_range(log: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows whose key lies in their region's range; marks without a key pass. Null bounds are open, as is an empty end."""
    bounds = regions.select("region_id", F.col("start_key").alias("_from"), F.col("end_key").alias("_to"))
    after = F.col("_from").isNull() | (F.col("key") >= F.col("_from"))
    before = ~present(F.col("_to")) | (F.col("key") < F.col("_to"))
    return log.join(bounds, "region_id").where(F.col("log_type").isin(INITIALIZED, *MARKS) | (after & before)).drop("_from", "_to")


def fresh_requests(log: DataFrame) -> DataFrame:
    """Drop rows of a request older than the newest that their region has had up to then."""
    newest = running_max_by(log, "region_id", ["seq"], F.col("request_id"), "_newest")
    return newest.where(F.col("request_id") >= F.col("_newest")).drop("_newest")


def of_known_regions(log: DataFrame, regions: DataFrame) -> DataFrame:
    return log.join(regions.select("region_id"), "region_id", "left_semi")


def without_stopped(log: DataFrame, stopped: DataFrame) -> DataFrame:
    return log.join(stopped.select("region_id"), "region_id", "left_anti")


def first_prewrites(log: DataFrame) -> DataFrame:
    """One prewrite a key and transaction: the last that has a value, else the first that hasn't."""
    fake = ~present(F.col("new_value"))
    order = Window.partitionBy(*KEYS).orderBy(fake, F.when(fake, F.col("seq")).otherwise(-F.col("seq")))
    rows = log.where(F.col("log_type") == PREWRITE)
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def candidates(log: DataFrame) -> DataFrame:
    """Pairs of a commit and a prewrite of its transaction and key, with the case that tells when they are emitted.

    A: both before initialisation, in order, with a value. B: both before it, otherwise. C: commit before,
    prewrite after it. D: both in order, after it. E: the commit came first, after it.
    """
    start = log.where(F.col("log_type") == INITIALIZED).groupBy("region_id").agg(F.min("seq").alias("init_seq"))
    commits = log.where(F.col("log_type") == COMMIT).select(*KEYS, "op_type", "commit_ts", F.col("seq").alias("commit_seq"))
    prewrites = log.where(F.col("log_type") == PREWRITE).select(
        *KEYS, "new_value", "old_value", F.col("seq").alias("prewrite_seq"), (~present(F.col("new_value"))).alias("fake")
    )
    c, p, i = F.col("commit_seq"), F.col("prewrite_seq"), F.col("init_seq")
    case = (
        F.when((c < i) & (p < c) & ~F.col("fake"), "A")
        .when((c < i) & (p < i), "B")
        .when((c < i) & (p > i), "C")
        .when((c > i) & (p < c), "D")
        .when((c > i) & (p > c), "E")
    )
    at = F.when(F.col("case").isin("A", "D"), c).when(F.col("case") == "B", i).otherwise(p)
    return commits.join(prewrites, KEYS).join(start, "region_id").withColumn("case", case).withColumn("emit_seq", at)


def not_rolled_back(pairs: DataFrame, log: DataFrame) -> DataFrame:
    """Drop the pairs in order (case D) that a rollback killed: between the two, or both before initialisation."""
    rollbacks = log.where(F.col("log_type") == ROLLBACK).select(*KEYS, F.col("seq").alias("rollback_seq"))
    a, b = pairs.alias("a"), rollbacks.alias("b")
    r, i, p, c = F.col("b.rollback_seq"), F.col("a.init_seq"), F.col("a.prewrite_seq"), F.col("a.commit_seq")
    same = (F.col("a.region_id") == F.col("b.region_id")) & (F.col("a.start_ts") == F.col("b.start_ts")) & (F.col("a.key") == F.col("b.key"))
    killed = ((r > i) & (r > p) & (r < c)) | ((p < i) & (r < i))
    return a.join(b, same & (F.col("a.case") == "D") & killed, "left_anti").select("a.*")


def matched(log: DataFrame) -> DataFrame:
    """One change a commit, however often it was sent: of its pairs, the one that is emitted first.

    Of several prewrites that wait for it, the last one with a value has taken the place of those before; one
    without a value takes no place that is taken, so of these the first counts.
    """
    return _events(log.where(F.col("log_type") != COMMITTED))


def _events(log: DataFrame) -> DataFrame:
    """Matched commits, as pairs with their case, and rows that came committed (case K), from one shuffle by transaction and key.

    What each commit meets is told by windows over the entries of its transaction and key: the last prewrite with a value before
    it, what is there at initialisation, the first prewrite after either, and what the rollbacks since have left. A rollback after
    initialisation ends a span of entries; one before it takes all prewrites before it.
    """
    start = log.where(F.col("log_type") == INITIALIZED).groupBy("region_id").agg(F.min("seq").alias("init_seq"))
    kind, seq, i = F.col("log_type"), F.col("seq"), F.col("init_seq")
    rows = log.where(kind.isin(PREWRITE, COMMIT, ROLLBACK, COMMITTED)).join(start, "region_id", "left")
    entry = Window.partitionBy(*KEYS)
    before, behind = entry.orderBy("seq").rangeBetween(Window.unboundedPreceding, -1), entry.orderBy("seq").rangeBetween(1, Window.unboundedFollowing)
    blank = ~present(F.col("new_value"))
    one = F.struct(seq.alias("prewrite_seq"), "new_value", "old_value", blank.alias("fake"))
    any_, real, fake = F.when(kind == PREWRITE, one), F.when((kind == PREWRITE) & ~blank, one), F.when((kind == PREWRITE) & blank, one)
    rows = rows.withColumns({
        "_last": F.max(real).over(before),
        "_at_init": F.coalesce(F.max(F.when(seq < i, real)).over(entry), F.min(F.when(seq < i, fake)).over(entry)),
        "_after_init": F.min(F.when(seq > i, any_)).over(entry),
        "_next": F.min(any_).over(behind),
        "_early": F.coalesce(F.max((kind == ROLLBACK) & (seq < i)).over(entry), F.lit(False)),
        "_span": F.count(F.when((kind == ROLLBACK) & (seq > i), 1)).over(before),
    })
    alive = ~((seq < i) & F.col("_early"))
    span = Window.partitionBy(*KEYS, "_span").orderBy("seq").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_held", F.coalesce(F.max(F.when(alive, real)).over(span), F.min(F.when(alive, fake)).over(span)))
    cases = {"A": (seq < i, "_last"), "B": (seq < i, "_at_init"), "C": (seq < i, "_after_init"), "D": (seq > i, "_held"), "E": (seq > i, "_next")}
    case = F.when(kind == COMMITTED, "K")
    for name, (when, column) in cases.items():
        case = case.when((kind == COMMIT) & when & F.col(column).isNotNull(), name)
    rows = rows.withColumn("case", case).where("case is not null")
    own = F.struct(F.lit(None).cast("long").alias("prewrite_seq"), "new_value", "old_value", blank.alias("fake"))
    pick = F.when(F.col("case") == "K", own)
    for name, (_, column) in cases.items():
        pick = pick.when(F.col("case") == name, F.col(column))
    rows = rows.withColumn("_pick", pick)
    at = F.when(F.col("case") == "B", i).when(F.col("case").isin("C", "E"), F.col("_pick.prewrite_seq")).otherwise(seq)
    pairs = rows.select(*KEYS, "op_type", "commit_ts", seq.alias("commit_seq"), "init_seq", "case", at.alias("emit_seq"), "_pick.*")
    latest = F.when(F.col("fake"), F.col("prewrite_seq")).otherwise(-F.col("prewrite_seq"))
    first = Window.partitionBy(*KEYS, "commit_ts", F.col("case") == "K").orderBy("emit_seq", "fake", latest, "commit_seq")
    return pairs.withColumn("_nth", F.row_number().over(first)).where("_nth = 1 or case = 'K'").drop("_nth")


_CHANGE = ["emit_seq", "region_id", "key", "start_ts", "commit_ts", "op_type", "new_value", "old_value"]


def changes(log: DataFrame, regions: DataFrame, include_prewrite_echo: bool = False) -> DataFrame:
    """The changelog: matched commits and rows that came committed, typed by operation.

    A delete's prewrite has no value, so before initialisation it waits for it as a fake one does.
    Each commit is emitted once. With ``include_prewrite_echo`` a commit that came before its prewrite (cases C and E) is
    preceded by that prewrite, as an event of its own whose commit_ts is 0.
    """
    found = _events(in_range(log, regions))
    if include_prewrite_echo:
        both = F.array(F.lit(0).cast("long"), F.col("commit_ts"))
        found = found.withColumn("commit_ts", F.explode(F.when(F.col("case").isin("C", "E"), both).otherwise(F.array("commit_ts"))))
    return found.select(*_CHANGE).withColumn("operate_type", operate_type(F.col("op_type"), F.col("old_value")))


def split_updates(changelog: DataFrame) -> DataFrame:
    """Each update as a delete (no new value) and an insert (no old value); both keep their operation type."""
    none = lambda name: F.lit(None).cast(changelog.schema[name].dataType)
    halves = F.array(
        F.struct(F.lit("delete").alias("kind"), none("new_value").alias("n"), F.col("old_value").alias("o")),
        F.struct(F.lit("insert").alias("kind"), F.col("new_value").alias("n"), none("old_value").alias("o")),
    )
    whole = F.array(F.struct(F.lit("whole").alias("kind"), F.col("new_value").alias("n"), F.col("old_value").alias("o")))
    rows = changelog.withColumn("_half", F.explode(F.when(F.col("operate_type") == "Update", halves).otherwise(whole)))
    return rows.withColumns({"split_kind": F.col("_half.kind"), "new_value": F.col("_half.n"), "old_value": F.col("_half.o")}).drop("_half")


def ordered(changelog: DataFrame) -> DataFrame:
    """Changes in the order of delivery, ties by region, key and transaction."""
    return changelog.orderBy("commit_ts", "region_id", "key", "start_ts")


def snapshot(changelog: DataFrame, as_of: int | Column | None = None) -> DataFrame:
    """The last value of each key up to a commit timestamp, without deleted keys."""
    rows = changelog if as_of is None else changelog.where(F.col("commit_ts") <= as_of)
    last = rows.groupBy("key").agg(F.max_by(F.struct("operate_type", "new_value", "commit_ts"), F.struct("commit_ts", "start_ts")).alias("s"))
    return last.where(F.col("s.operate_type") != "Delete").select("key", "s.new_value", "s.commit_ts")
