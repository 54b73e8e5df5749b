"""The streaming chain against sequential models: sparse resolved timestamps, splits and merges, ordered release, restarts."""

import os
import random
from bisect import bisect_right

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from millrace.model import COMMIT, COMMITTED, INITIALIZED, JOINED, PREWRITE, RESOLVED, ROLLBACK, STOPPED
from millrace.operators.frontier import assign
from millrace.operators.sweep import cuts_of
from millrace.streaming import feed
from millrace.streaming.sinks import deliver_until

ROW = ["seq", "region_id", "log_type", "op_type", "key", "start_ts", "commit_ts", "new_value", "old_value", "end_key"]
SCHEMA = feed.feed_schema(T.StringType())
ARROW = pa.schema([(n, pa.int64() if n in ("seq", "region_id", "start_ts", "commit_ts") else pa.string()) for n in ROW])


def row(seq, region, kind, key="", start=0, commit=0, new=None, old=None, end=None, op="PUT"):
    return (seq, region, kind, op, key, start, commit, new, old, end)


class Files:
    """A folder that grows by a file a micro-batch."""

    def __init__(self, path):
        self.path, self.n = path, 0
        os.makedirs(path)

    def add(self, rows):
        name = f"{self.path}/{self.n:04}.parquet"
        pq.write_table(pa.Table.from_pylist([dict(zip(ROW, r, strict=True)) for r in rows], ARROW), name)
        os.utime(name, (1_000_000 + self.n, 1_000_000 + self.n))
        self.n += 1

    def read(self, spark):
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(self.path)


def run(rows, checkpoint):
    """All micro-batches that are ready: lists of rows in the order in which they came."""
    found = []
    query = rows.writeStream.foreachBatch(lambda batch, n: found.append(batch.collect())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return found


def cut(rows, rng, parts):
    at = sorted(rng.sample(range(1, len(rows)), parts - 1))
    return [rows[a:b] for a, b in zip([0, *at], [*at, len(rows)], strict=True)]


KEYS = [f"{i:02}" for i in range(40)]


class Regions:
    """A changing division of the keys, and the marks that say so."""

    def __init__(self, rng, bounds):
        self.rng, self.next, self.live = rng, 1, {}
        for start, end in zip(["", *bounds], [*bounds, ""], strict=True):
            self.live[self.next] = [start, end, False, 0]
            self.next += 1

    def of(self, key):
        return next(r for r, (s, e, *_) in self.live.items() if s <= key and (not e or key < e))

    def joined(self, region, ts):
        start, end, *_ = self.live[region]
        return (region, JOINED, start, end, ts)

    def split(self):
        """STOPPED of a region and JOINED of its parts, from the timestamp it had."""
        wide = [r for r, (s, e, *_) in self.live.items() if len([k for k in KEYS if s < k and (not e or k < e)]) > 1]
        parent = self.rng.choice(wide)
        start, end, _, ts = self.live.pop(parent)
        at = self.rng.choice([k for k in KEYS if start < k and (not end or k < end)])
        out = [(parent, STOPPED, start, end, 0)]
        for s, e in ((start, at), (at, end)):
            self.live[self.next] = [s, e, False, ts]
            out.append(self.joined(self.next, ts))
            self.next += 1
        return out

    def merge(self):
        order = sorted(self.live, key=lambda r: self.live[r][0])
        if len(order) < 2:
            return []
        i = self.rng.randrange(len(order) - 1)
        a, b = (self.live.pop(r) for r in order[i : i + 2])
        self.live[self.next] = [a[0], b[1], False, min(a[3], b[3])]
        self.next += 1
        return [(order[i], STOPPED, a[0], a[1], 0), (order[i + 1], STOPPED, b[0], b[1], 0), self.joined(self.next - 1, min(a[3], b[3]))]


def sparse_marks(seed, n=400):
    rng = random.Random(seed)
    regions = Regions(rng, ["10", "20", "30"])
    marks = [regions.joined(r, 5) for r in regions.live]
    clock = 5
    for _ in range(n):
        what, clock = rng.random(), clock + rng.randrange(4)
        region = rng.choice(list(regions.live))
        s, e, opened, last = regions.live[region]
        if what < 0.03:
            marks += regions.split()
        elif what < 0.06:
            marks += regions.merge()
        elif what < 0.3:
            marks.append((region, INITIALIZED, s, e, 0))
            regions.live[region][2] = True
        else:
            ts = clock - rng.randrange(12)
            marks.append((region, RESOLVED, s, e, ts))
            if opened and ts >= last:
                regions.live[region][3] = ts
    return [row(10 * i, r, kind, key=s, commit=ts, end=e) for i, (r, kind, s, e, ts) in enumerate(marks)]


def model_frontier(marks, start_ts):
    """(rises, accepted): the value of every key, set by each accepted mark in turn; the frontier is the least."""
    values, known, last, rises, accepted = dict.fromkeys(["", *KEYS], start_ts), {}, start_ts, [], []
    for seq, r, kind, _, s, _, ts, _, _, e in marks:
        if kind == JOINED:
            known[r] = [False, ts]
        elif kind == STOPPED:
            known.pop(r)
        elif kind == INITIALIZED:
            known[r][0] = True
        elif known[r][0] and ts >= known[r][1]:
            known[r][1] = ts
            accepted.append((seq, r, ts))
            for k in values:
                if s <= k and (not e or k < e):
                    values[k] = ts
            if min(values.values()) > last:
                last = min(values.values())
                rises.append((seq, last))
    return rises, accepted


@pytest.mark.parametrize(("seed", "splits"), [(1, ["05", "20", "33"]), (2, []), (3, ["10", "11", "12", "39"])])
def test_frontier_of_sparse_marks_with_splits(spark, tmp_path, seed, splits):
    marks, rng = sparse_marks(seed), random.Random(seed)
    rises, accepted = model_frontier(marks, 5)
    assert len(rises) > 5
    files, parts, got = Files(f"{tmp_path}/in"), cut(marks, rng, 4), []
    for part in (parts[:2], parts[2:]):  # the query is started again in between
        for rows in part:
            files.add(rows)
        got += run(feed.stream_range_frontier(files.read(spark), splits, 5), f"{tmp_path}/ck")
    assert [tuple(r) for batch in got for r in sorted(batch)] == rises
    told = [r for b in run(feed.stream_region_marks(files.read(spark), splits, 5), f"{tmp_path}/ck2") for r in b if r.kind == feed.RESOLVED_ROW]
    assert sorted((r.seq, r.region_id, r.ts) for r in told) == accepted


def test_accepted_of_one_message(spark, tmp_path):
    """Regions 1 and 2 are initialised at 9 and 11, region 3 isn't: of a message at 10 for all, only region 1 is advanced."""
    files = Files(f"{tmp_path}/in")
    ranges = {1: ("a", "b", 9), 2: ("b", "c", 11), 3: ("c", "d", 8)}
    files.add([row(i, r, JOINED, key=s, end=e, commit=ts) for i, (r, (s, e, ts)) in enumerate(ranges.items())])
    files.add([row(10 + r, r, INITIALIZED, key=ranges[r][0], end=ranges[r][1]) for r in (1, 2)])
    files.add([row(20, r, RESOLVED, key=s, end=e, commit=10) for r, (s, e, _) in ranges.items()])
    got = [r for b in run(feed.stream_region_marks(files.read(spark), ["b"]), f"{tmp_path}/ck") for r in b if r.kind == feed.RESOLVED_ROW]
    assert [(r.region_id, r.start_key, r.end_key, r.ts) for r in got] == [(1, "a", "b", 10)]


def history(seed, splitting, n=120):
    """A log of transactions and resolved marks; with ``splitting`` regions are split and merged in the middle of transactions.

    The transactions, their order and the resolved timestamps are the same either way: new regions are initialised at once.
    Returns the log and the changes it holds.
    """
    rng, own = random.Random(seed), random.Random(seed + 1)
    regions = Regions(own, ["10", "20", "30"])
    log, open_, done, seq, clock = [], [], [], 0, 100

    def put(region, kind, **kw):
        nonlocal seq
        seq += 1
        log.append(row(seq, region, kind, **kw))

    def marks(found):
        for region, kind, s, e, ts in found:
            put(region, kind, key=s, end=e, commit=ts)
            if kind == JOINED:
                put(region, INITIALIZED, key=s, end=e)
                regions.live[region][2] = True

    marks([regions.joined(r, 5) for r in list(regions.live)])
    for _ in range(n):
        what, clock = rng.random(), clock + 3
        if splitting and own.random() < 0.1:
            marks(regions.split() if own.random() < 0.6 else regions.merge())
        if what < 0.45:
            key, start = rng.choice(KEYS), clock
            open_.append((key, start))
            put(regions.of(key), PREWRITE, key=key, start=start, new=f"v{start}", old="o" if rng.random() < 0.5 else None)
        elif what < 0.7 and open_:
            key, start = open_.pop(rng.randrange(len(open_)))
            put(regions.of(key), COMMIT, key=key, start=start, commit=clock)
            done.append((clock, key, start, f"v{start}"))
            if rng.random() < 0.3:  # sent again
                put(regions.of(key), COMMIT, key=key, start=start, commit=clock)
        elif what < 0.75 and open_:
            key, start = open_.pop(rng.randrange(len(open_)))
            put(regions.of(key), ROLLBACK, key=key, start=start)
        elif what < 0.82:
            key = rng.choice(KEYS)
            put(regions.of(key), COMMITTED, key=key, start=clock - 1, commit=clock, new="c")
            done.append((clock, key, clock - 1, "c"))
        else:
            low = min([start for _, start in open_], default=clock) - 1
            share = own.random() if splitting else 1  # a silent region holds the frontier back
            for region in [r for r in regions.live if own.random() <= max(share, 0.5)]:
                s, e, _, last = regions.live[region]
                if low >= last:
                    regions.live[region][3] = low
                    put(region, RESOLVED, key=s, end=e, commit=low)
    for region, (s, e, *_) in regions.live.items():
        put(region, RESOLVED, key=s, end=e, commit=clock + 10)
    return log, sorted(done)


@pytest.mark.parametrize("seed", [1, 2])
def test_split_log_gives_the_changes_of_an_unsplit_one(spark, tmp_path, seed):
    found = []
    for splitting in (False, True):
        log, done = history(seed, splitting)
        files = Files(f"{tmp_path}/in{splitting}")
        for part in cut(log, random.Random(seed), 3):
            files.add(part)
        got = run(feed.stream_range_changes(files.read(spark), ["07", "25"], salts=2), f"{tmp_path}/ck{splitting}")
        found.append(sorted((r.commit_ts, r.key, r.start_ts, r.new_value) for b in got for r in b))
        assert found[-1] == done
    assert sum(r[2] == STOPPED for r in log) > 3
    assert found[0] == found[1]


@pytest.mark.parametrize("seed", [3, 4])
def test_whole_chain_with_restarts(spark, tmp_path, seed):
    log, done = history(seed, True)
    files, parts, got = Files(f"{tmp_path}/in"), cut(log, random.Random(seed), 6), []
    for part in (parts[:1], parts[1:4], parts[4:]):
        for rows in part:
            files.add(rows)
        got += run(feed.stream_feed(files.read(spark), ["15", "31"], buckets=3), f"{tmp_path}/ck")
    marks = [r for r in log if r[2] in feed.REGION_MARKS]
    rises = model_frontier(marks, 0)[0]
    delivered, before = [], 0
    ends = [part[-1][0] for part in parts]
    seqs = [s for s, _ in rises]
    for batch, end in zip([b for b in got if b], sorted({e for e in ends if bisect_right(seqs, e) > bisect_right(seqs, max([x for x in ends if x < e], default=0))}), strict=True):
        now = rises[bisect_right(seqs, end) - 1][1]
        rows = [(r.commit_ts, r.key, r.start_ts, r.new_value) for r in batch if r.kind == feed.CHANGE]
        assert all(before < r[0] <= now for r in rows), "out of order"
        assert [r.frontier_ts for r in batch if r.kind == feed.RESOLVED_ROW] == [now]
        delivered, before = delivered + sorted(rows), now
    assert delivered == done


def test_late_changes_are_dropped(spark, tmp_path):
    files = Files(f"{tmp_path}/in")
    marks = [row(1, 1, JOINED, key="", end="", commit=0), row(2, 1, INITIALIZED, key="", end="")]
    files.add([*marks, row(3, 1, COMMITTED, key="k", start=1, commit=10, new="a"), row(4, 1, RESOLVED, key="", end="", commit=20)])
    files.add([row(5, 1, COMMITTED, key="k", start=2, commit=15, new="late"), row(6, 1, COMMITTED, key="k", start=3, commit=21, new="b"), row(7, 2, COMMITTED, key="k", start=4, commit=22, new="unknown region")])
    files.add([row(8, 1, RESOLVED, key="", end="", commit=30)])
    got = run(feed.stream_feed(files.read(spark), ["m"], buckets=2), f"{tmp_path}/ck")
    assert [r.new_value for b in got for r in b if r.kind == feed.CHANGE] == ["a", "b"]


def test_query_stops_behind_its_end(spark, tmp_path):
    """The query goes on until the frontier is past the end, and then no change behind the end has been delivered."""
    log, done = history(6, False)
    end = done[len(done) // 2][0]
    files = Files(f"{tmp_path}/in")
    for part in cut(log, random.Random(6), 5):
        files.add(part)
    seen = []
    query = deliver_until(feed.stream_feed(files.read(spark), [], buckets=2), [lambda batch, n: seen.extend(batch.collect())], f"{tmp_path}/ck", end_ts=end)
    assert query.wait(120) > end and not query.query.isActive
    assert [(r.commit_ts, r.key, r.start_ts, r.new_value) for r in seen] == [d for d in done if d[0] <= end]


def test_splits_of_regions(spark):
    regions = spark.createDataFrame([(i, f"{i:03}" if i else None, f"{i + 1:03}") for i in range(100)], "region_id long, start_key string, end_key string")
    splits = cuts_of(regions.select("start_key"), 4)
    assert splits == sorted(set(splits)) and 1 <= len(splits) <= 3
    rows = spark.createDataFrame([row(1, 1, COMMITTED, key=k) for k in ("", "000", splits[0], "999")] + [row(2, 1, JOINED, key="", end=splits[0]), row(3, 1, JOINED, key="000", end="")], SCHEMA)
    found = sorted((r.seq, r.key, r.bucket) for r in feed.by_range(rows, splits).collect())
    assert [b for s, _, b in found if s == 1] == [0, 0, 1, len(splits)]
    assert [b for s, _, b in found if s == 2] == [0]
    assert [b for s, _, b in found if s == 3] == list(range(len(splits) + 1))


def test_interval_map_equals_plain_keys():
    rng = random.Random(9)
    starts, values, plain = [""], [0], dict.fromkeys(["", *KEYS], 0)
    for n in range(1, 300):
        a, b = sorted(rng.sample(["", *KEYS, "zz"], 2))
        end = "" if b == "zz" else b
        assign(starts, values, a, end, n)
        plain.update({k: n for k in plain if k >= a and (not end or k < end)})
        assert starts == sorted(set(starts))
        assert all(values[bisect_right(starts, k) - 1] == v for k, v in plain.items())
