"""Timers under a controlled clock, and the state and counts of running queries against models."""

import random
import time

from pyspark.sql import Row

from millrace.model import INITIALIZED, JOINED, RESOLVED, STOPPED
from millrace.operators import frontier
from millrace.streaming import feed, watch
from test_feed import Files, cut, history, row, run, sparse_marks


class Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None


class Clock:
    """A handle and a clock for one key of a processor: ``pass_to`` fires the timers that are due."""

    def __init__(self, processor, key):
        self.processor, self.key, self.now, self.timers = processor, key, 0, set()
        processor.init(self)

    def getValueState(self, name, schema):  # noqa: N802
        return Value()

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)

    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return self.now

    def rows(self, *rows):
        return list(self.processor.handleInputRows((self.key,), iter(rows), self))

    def pass_to(self, now):
        found = []
        while due := [t for t in self.timers if t <= now]:
            self.now = min(due)
            self.timers.remove(self.now)
            found += self.processor.handleExpiredTimer((self.key,), self, None)
        self.now = now
        return found


def mark(seq, ts, kind=RESOLVED):
    return Row(seq=seq, region_id=1, log_type=kind, commit_ts=ts)


def test_penalties_and_reconnect_under_a_clock():
    clock = Clock(watch.RegionWatch(every_ms=5_000, lag_ms=20_000, penalties=3, reconnect_ms=100_000), 1)
    clock.now = 1_000
    clock.rows(mark(1, 1_000))
    assert clock.timers == {6_000}
    for at in (7_000, 12_000, 17_000):  # the same timestamp again and again: three penalties
        assert clock.pass_to(at) == []
        clock.rows(mark(at, 900), mark(at + 1, 1_000))
    assert clock.pass_to(20_000) == []  # no lag of 20 seconds yet
    first = clock.pass_to(26_000)
    assert [(r.report, r.region_id, r.lag_ms, r.penalty, r.at_ms) for r in first] == [(watch.LOCK, 1, 20_000, 3, 21_000)]
    assert clock.pass_to(60_000) == []  # penalties were cleared
    clock.rows(mark(100, 50_000))
    assert clock.processor.seen.get()[:3] == (50_000, 60_000, 0)
    assert {r.report for r in clock.pass_to(155_000)} == set()
    late = clock.pass_to(165_500)  # silent for more than 100 seconds since 60,000, and behind as long
    assert [(r.report, r.silent_ms > 100_000) for r in late] == [(watch.RECONNECT, True)]
    clock.rows(mark(200, 0, STOPPED))
    assert clock.timers == set() and not clock.processor.seen.exists()
    assert clock.pass_to(10**9) == []


def test_stuck_frontier_under_a_clock():
    clock = Clock(watch.FrontierWatch(limit_ms=60_000, every_ms=30_000, start_ts=5), 0)
    clock.rows(Row(resolved_ts=5))
    assert clock.timers == set()  # the first scan isn't over
    clock.rows(Row(resolved_ts=6), Row(resolved_ts=9))
    assert clock.pass_to(59_000) == []
    clock.rows(Row(resolved_ts=9))  # no rise
    assert [(r.report, r.resolved_ts, r.waited_ms) for r in clock.pass_to(90_000)] == [(watch.STUCK, 9, 60_000), (watch.STUCK, 9, 90_000)]
    clock.rows(Row(resolved_ts=10))
    assert clock.pass_to(149_000) == []
    assert [r.at_ms for r in clock.pass_to(150_000)] == [150_000]


def test_timers_of_a_running_query(spark, tmp_path):
    """Real timers: the query reports of regions and the frontier with no input after the first micro-batch."""
    files, found = Files(f"{tmp_path}/in"), []
    files.add([row(1, 1, RESOLVED, commit=1), row(2, 2, RESOLVED, commit=1), row(3, 2, STOPPED)])
    regions = watch.stream_region_watch(files.read(spark), watch.RegionWatch(every_ms=200, lag_ms=0, penalties=0))
    rises = files.read(spark).where("log_type = 'RESOLVED'").selectExpr("commit_ts as resolved_ts")
    still = watch.stream_frontier_watch(rises, watch.FrontierWatch(limit_ms=300, every_ms=200))
    queries = [
        q.writeStream.foreachBatch(lambda b, n: found.extend(b.collect())).option("checkpointLocation", f"{tmp_path}/ck{i}").trigger(processingTime="200 milliseconds").start()
        for i, q in enumerate((regions, still))
    ]
    ends = time.monotonic() + 90
    while {r.report for r in found} != {watch.LOCK, watch.STUCK} and time.monotonic() < ends:
        time.sleep(0.2)
    for q in queries:
        q.stop()
    assert {(r.report, getattr(r, "region_id", None)) for r in found if r.report == watch.LOCK} == {(watch.LOCK, 1)}
    assert any(r.report == watch.STUCK and r.resolved_ts == 1 and r.waited_ms >= 300 for r in found)


def test_registry_equals_a_model_after_each_batch(spark, tmp_path):
    marks, seen = sparse_marks(5, 120), []
    parts = cut(marks, random.Random(5), 3)
    files = Files(f"{tmp_path}/in")
    counts = watch.Counts(lambda query, batch, found: seen.append(found))
    spark.streams.addListener(counts)
    known, values = {}, dict.fromkeys(["", *(f"{i:02}" for i in range(40))], 5)
    try:
        for part in parts:
            files.add(part)
            run(feed.stream_range_frontier(watch.observed(files.read(spark)), ["12", "27"], 5), f"{tmp_path}/ck")
            for _, r, kind, _, s, _, ts, _, _, e in part:
                if kind == JOINED:
                    known[r] = [s, e, False, ts]
                elif kind == STOPPED:
                    known.pop(r)
                elif kind == INITIALIZED:
                    known[r][2] = True
                elif known[r][2] and ts >= known[r][3]:
                    known[r][3] = ts
                    values.update({k: ts for k in values if s <= k and (not e or k < e)})
            assert sorted(map(list, watch.live_regions(spark, f"{tmp_path}/ck").collect())) == sorted([r, *v] for r, v in known.items())
            segments = watch.live_segments(spark, f"{tmp_path}/ck")
            assert frontier.frontier_of(segments).first()[0] == min(values.values())
            slow = frontier.slowest(segments).first()
            assert slow.ts == min(values.values()) and slow.start_key == min(k for k, v in values.items() if v == slow.ts)
        ends = time.monotonic() + 30
        while len(seen) < len(parts) and time.monotonic() < ends:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    assert [(c["entries"], c["resolved"], c["joined"], c["stopped"]) for c in seen] == [(len(p), *(sum(m[2] == k for m in p) for k in (RESOLVED, JOINED, STOPPED))) for p in parts]


def test_counts_of_a_whole_history(spark, tmp_path):
    log, _ = history(8, False, 40)
    files, seen = Files(f"{tmp_path}/in"), []
    files.add(log)
    counts = watch.Counts(lambda query, batch, found: seen.append(found))
    spark.streams.addListener(counts)
    try:
        run(feed.stream_range_changes(watch.observed(files.read(spark)), []), f"{tmp_path}/ck")
        ends = time.monotonic() + 30
        while not seen and time.monotonic() < ends:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counts)
    assert seen[0]["entries"] == len(log) and seen[0]["last_commit_ts"] == max(r[6] for r in log)
    assert [seen[0][k.lower()] for k in ("PREWRITE", "COMMIT", "COMMITTED")] == [sum(r[2] == k for r in log) for k in ("PREWRITE", "COMMIT", "COMMITTED")]
