"""The frontier as a stateful stream, and a listener that tells when it stands still."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

_FRONTIER = T.StructType().add("tick", "long").add("resolved_ts", "long")


class Frontier(StatefulProcessor):
    """The least of all regions' greatest timestamps, emitted whenever it rises.

    A watermark can't stand in for it: it follows the slowest region, not the latest event. Its input is reduced
    to one row a region and tick, so a single key is enough.
    """

    def __init__(self, regions: int) -> None:
        self.expected = regions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.regions = handle.getMapState("regions", T.StructType().add("region_id", "long"), T.StructType().add("ts", "long"))
        self.last = handle.getValueState("last", T.StructType().add("ts", "long"))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = {r[0]: v[0] for r, v in self.regions.iterator()}
        last = self.last.get()[0] if self.last.exists() else 0
        changed: set[int] = set()
        by_tick: dict[int, list[Row]] = {}
        for r in rows:
            by_tick.setdefault(r.tick, []).append(r)
        for tick in sorted(by_tick):
            for r in by_tick[tick]:
                if r.resolved_ts > known.get(r.region_id, -1):
                    known[r.region_id] = r.resolved_ts
                    changed.add(r.region_id)
            low = min(known.values())
            if len(known) >= self.expected and low > last:
                last = low
                yield Row(tick=tick, resolved_ts=low)
        for region in changed:
            self.regions.updateValue((region,), (known[region],))
        self.last.update((last,))

    def close(self) -> None:
        pass


def stream_frontier(resolved: DataFrame, regions: int) -> DataFrame:
    """(tick, resolved_ts) of the rises of the frontier over ``regions`` regions of a streamed (tick, region_id, resolved_ts)."""
    rows = resolved.select("tick", "region_id", "resolved_ts").withColumn("all", F.lit(0))
    return rows.groupBy("all").transformWithState(Frontier(regions), _FRONTIER, outputMode="Append", timeMode="None")


class LateFilter(StatefulProcessor):
    """Passes the changes above the frontier as of their place; its key is a bucket of regions, each of which sees every rise."""

    def __init__(self, names: list[str]) -> None:
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.frontier = handle.getValueState("frontier", T.StructType().add("ts", "long"))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        now = self.frontier.get()[0] if self.frontier.exists() else -1
        for r in sorted(rows, key=lambda r: (r.at, r.rise is None)):
            if r.rise is not None:
                now = max(now, r.rise)
            elif r.change["commit_ts"] > now:
                yield Row(**{n: r.change[n] for n in self.names}, frontier_ts=now)
        self.frontier.update((now,))

    def close(self) -> None:
        pass


def stream_late_filter(changes: DataFrame, rises: DataFrame, buckets: int = 64) -> DataFrame:
    """The streamed ``changes`` that are above the frontier as of their emit_seq, with it as ``frontier_ts``.

    ``rises`` is a stream of (from_seq, resolved_ts). Changes are dealt by region over ``buckets`` keys; the rises, a few
    rows, go to each of them. A rise counts for the changes of its micro-batch and later ones. No column of the changes may be named
    frontier_ts.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in changes.columns])
    one = changes.select(F.pmod(F.hash("region_id"), F.lit(buckets)).alias("bucket"), F.col("emit_seq").alias("at"), F.lit(None).cast("long").alias("rise"), row.alias("change"))
    many = rises.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), F.col("from_seq").alias("at"), F.col("resolved_ts").alias("rise"), F.lit(None).cast(one.schema["change"].dataType).alias("change"))
    schema = T.StructType([*changes.schema.fields]).add("frontier_ts", "long")
    return one.unionByName(many).groupBy("bucket").transformWithState(LateFilter(changes.columns), schema, outputMode="Append", timeMode="None")


class StandstillListener(StreamingQueryListener):
    """Calls ``report(query_name, seconds)`` when a query has put out nothing for longer than ``limit`` seconds."""

    def __init__(self, report: Callable[[str, float], None], limit: float = 60.0, clock: Callable[[], float] = time.monotonic) -> None:
        self.report, self.limit, self.clock = report, limit, clock
        self.since: dict[str, float] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.since[str(event.id)] = self.clock()

    def observe(self, query: str, name: str, rows_out: int) -> None:
        now = self.clock()
        if rows_out:
            self.since[query] = now
        waited = now - self.since.setdefault(query, now)
        if waited > self.limit:
            self.report(name, waited)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        self.observe(str(progress.id), progress.name or str(progress.id), max(progress.sink.numOutputRows, 0))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        self.observe(str(event.id), str(event.id), 0)

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.since.pop(str(event.id), None)
