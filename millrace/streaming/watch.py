"""Watching a feed while it runs: sweeps by processing-time timers, and the regions and counts that its state and progress tell."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from millrace.model import LOG_TYPES, MARKS, MAX_TS, RESOLVED, STOPPED

LOCK, RECONNECT, STUCK = "resolve lock", "reconnect", "stuck"


class RegionWatch(StatefulProcessor):
    """Looks at each region every ``every_ms``, whether or not it says something.

    A resolved timestamp that isn't higher than before adds a penalty (one a micro-batch), a higher one clears them. A region that lags
    ``lag_ms`` or more behind the clock and has ``penalties`` is reported for its locks, and its penalties are cleared; one that lags
    and has been silent for more than ``reconnect_ms`` is to be reconnected. A region that is left is watched no longer.
    ``shift`` is how many low bits of a timestamp aren't milliseconds.
    """

    SCHEMA = T.StructType().add("report", "string").add("region_id", "long").add("resolved_ts", "long").add("lag_ms", "long").add("silent_ms", "long").add("penalty", "long").add("at_ms", "long")

    def __init__(self, every_ms: int = 5_000, lag_ms: int = 20_000, penalties: int = 10, reconnect_ms: int = 2_400_000, shift: int = 0) -> None:
        self.every, self.lag, self.penalties, self.reconnect, self.shift = every_ms, lag_ms, penalties, reconnect_ms, shift

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", T.StructType().add("resolved_ts", "long").add("event_ms", "long").add("penalty", "long").add("timer_ms", "long"))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        for r in sorted(rows, key=lambda r: r.seq):
            held = tuple(self.seen.get()) if self.seen.exists() else None
            if r.log_type == STOPPED:
                if held:
                    self.handle.deleteTimer(held[3])
                    self.seen.clear()
            elif held is None:
                self.handle.registerTimer(now + self.every)
                self.seen.update((r.commit_ts, now, 0, now + self.every))
            elif r.commit_ts > held[0]:
                self.seen.update((r.commit_ts, now, 0, held[3]))
            elif now > held[1]:
                self.seen.update((held[0], now, held[2] + 1, held[3]))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if not self.seen.exists():
            return
        now = timerValues.getCurrentProcessingTimeInMs()
        resolved, event, penalty, _ = self.seen.get()
        lag, silent = now - (resolved >> self.shift), now - event
        report = None
        if lag > self.reconnect and silent > self.reconnect:
            report = RECONNECT
        elif lag >= self.lag and penalty >= self.penalties:
            report = LOCK
        if report:
            yield Row(report=report, region_id=key[0], resolved_ts=resolved, lag_ms=lag, silent_ms=silent, penalty=penalty, at_ms=now)
        self.handle.registerTimer(now + self.every)
        self.seen.update((resolved, event, 0 if report == LOCK else penalty, now + self.every))

    def close(self) -> None:
        pass


class FrontierWatch(StatefulProcessor):
    """Reports that the frontier stands still, every ``every_ms`` while its last rise is ``limit_ms`` or more ago.

    Nothing is reported until the frontier has risen above ``start_ts`` once: the first scan may take its time.
    """

    SCHEMA = T.StructType().add("report", "string").add("resolved_ts", "long").add("waited_ms", "long").add("at_ms", "long")

    def __init__(self, limit_ms: int = 60_000, every_ms: int = 30_000, start_ts: int = 0) -> None:
        self.limit, self.every, self.start_ts = limit_ms, every_ms, start_ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType().add("resolved_ts", "long").add("rose_ms", "long"))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now, top = timerValues.getCurrentProcessingTimeInMs(), max(r.resolved_ts for r in rows)
        if top > (self.last.get()[0] if self.last.exists() else self.start_ts):
            if not self.last.exists():
                self.handle.registerTimer(now + self.every)
            self.last.update((top, now))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentProcessingTimeInMs()
        resolved, rose = self.last.get()
        if now - rose >= self.limit:
            yield Row(report=STUCK, resolved_ts=resolved, waited_ms=now - rose, at_ms=now)
        self.handle.registerTimer(now + self.every)

    def close(self) -> None:
        pass


def stream_region_watch(log: DataFrame, watch: RegionWatch | None = None) -> DataFrame:
    """Reports on the regions of a streamed log (seq, region_id, log_type, commit_ts), of its resolved and stop marks."""
    marks = log.where(F.col("log_type").isin(RESOLVED, STOPPED)).select("seq", "region_id", "log_type", "commit_ts")
    return marks.groupBy("region_id").transformWithState(watch or RegionWatch(), RegionWatch.SCHEMA, outputMode="Append", timeMode="ProcessingTime")


def stream_frontier_watch(rises: DataFrame, watch: FrontierWatch | None = None) -> DataFrame:
    """Reports while a streamed frontier (resolved_ts) stands still."""
    rows = rises.select("resolved_ts", F.lit(0).alias("all"))
    return rows.groupBy("all").transformWithState(watch or FrontierWatch(), FrontierWatch.SCHEMA, outputMode="Append", timeMode="ProcessingTime")


def _operator(spark: SparkSession, checkpoint: str, variables: set[str]) -> int:
    """The number of the stateful operator of a query that holds these state variables."""
    for r in spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorProperties").distinct().collect():
        held = json.loads(r.operatorProperties or "{}").get("stateVariables", [])
        if variables <= {v.get("stateName") for v in held}:
            return r.operatorId
    raise ValueError(f"no operator at {checkpoint} holds {sorted(variables)}")


def live_regions(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(region_id, start_key, end_key, initialized, resolved_ts) of the regions that a range frontier follows.

    Read from the state of the query with that ``checkpoint``, as of its last micro-batch or ``batch``; the query may run on or be stopped.
    """
    reader = spark.read.format("statestore").option("operatorId", _operator(spark, checkpoint, {"regions", "map"})).option("stateVarName", "regions")
    rows = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    region = F.col("user_map_value")
    # A region that meets several buckets is in the state of each, with the same values.
    return rows.select(F.col("user_map_key.region_id").alias("region_id"), region["start"].alias("start_key"), region["end"].alias("end_key"), region["open"].alias("initialized"), region["resolved"].alias("resolved_ts")).distinct()


def live_segments(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(start_key, ts) of the interval map that a range frontier holds: what is slowest while the query runs, with ``frontier.slowest``."""
    reader = spark.read.format("statestore").option("operatorId", _operator(spark, checkpoint, {"regions", "map"})).option("stateVarName", "map")
    rows = (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)
    return rows.select(F.explode(F.arrays_zip("value.starts", "value.values")).alias("s")).select(F.col("s.starts").alias("start_key"), F.col("s.values").alias("ts")).where(F.col("ts") < MAX_TS)


def observed(log: DataFrame, name: str = "feed") -> DataFrame:
    """``log`` with the entries of each type counted in every micro-batch, as metrics of the query's progress."""
    kinds = [F.count(F.when(F.col("log_type") == k, 1)).alias(k.lower()) for k in (*LOG_TYPES, *MARKS)]
    return log.observe(name, F.count(F.lit(1)).alias("entries"), F.max("commit_ts").alias("last_commit_ts"), *kinds)


class Counts(StreamingQueryListener):
    """Hands the counts of ``observed`` to ``report(query_id, batch, counts)`` after every micro-batch."""

    def __init__(self, report: Callable[[str, int, dict], None], name: str = "feed") -> None:
        self.report, self.name = report, name

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        found = event.progress.observedMetrics.get(self.name)
        if found is not None and found.entries:
            self.report(str(event.progress.id), event.progress.batchId, found.asDict())

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
