"""The matcher and its stream against hand-made logs and a sequential model."""

import os
import random
import shutil
import time
from pathlib import Path

import pytest

from millrace.model import log_schema
from millrace.operators import matcher
from millrace.sources import derived
from millrace.streaming.frontier import stream_late_filter
from millrace.streaming.matcher import stream_changes
from millrace.streaming.sinks import deliver

COLUMNS = ["seq", "region_id", "log_type", "op_type", "key", "start_ts", "commit_ts", "new_value", "old_value"]
SCHEMA = log_schema("string", "string")


def entry(seq, kind, start_ts, commit_ts, key, new=None, old=None, op="PUT", region=1):
    return (seq, region, kind, op, key, start_ts, commit_ts, new, old)


def run(spark, rows):
    log = spark.createDataFrame(rows, SCHEMA)
    regions = spark.createDataFrame([(1, "", ""), (2, None, None)], "region_id long, start_key string, end_key string")
    found = matcher.changes(log, regions).collect()
    return sorted((r.emit_seq, r.start_ts, r.commit_ts, r.key, r.new_value, r.old_value) for r in found)


def test_rollback_stops_a_match(spark):
    rows = [entry(0, "INITIALIZED", 0, 0, ""), entry(1, "PREWRITE", 1, 0, "k1", "v2"), entry(2, "PREWRITE", 2, 0, "k1", "v2", "v3"), entry(3, "ROLLBACK", 1, 0, "k1")]
    rows += [entry(4, "COMMIT", 1, 2, "k1"), entry(5, "COMMIT", 2, 3, "k1")]
    assert run(spark, rows) == [(5, 2, 3, "k1", "v2", "v3")]


def test_before_initialisation(spark):
    rows = [entry(1, "PREWRITE", 1, 0, "k1", "", "v4"), entry(2, "COMMIT", 1, 2, "k1"), entry(3, "PREWRITE", 1, 0, "k1", "v3", "v4")]
    rows += [entry(4, "PREWRITE", 2, 0, "k2", "v3", "v4"), entry(5, "COMMIT", 2, 3, "k2"), entry(6, "INITIALIZED", 0, 0, "")]
    assert run(spark, rows) == [(5, 2, 3, "k2", "v3", "v4"), (6, 1, 2, "k1", "v3", "v4")]


def test_waiting_commits_match_exactly(spark):
    twice = [("COMMIT", 1, 2, "k1"), ("COMMIT", 3, 4, "k2"), ("COMMIT", 4, 5, "k3")] * 2
    rows = [entry(i, *x) for i, x in enumerate(twice)]
    rows += [entry(14, "PREWRITE", 1, 0, "k1", "v1", "o1"), entry(15, "PREWRITE", 3, 0, "k2", "v2", "o2"), entry(16, "PREWRITE", 4, 0, "k2", "v3", "o3")]
    rows += [entry(17, "INITIALIZED", 0, 0, "")]
    want = [(17, 1, 2, "k1", "v1", "o1"), (17, 3, 4, "k2", "v2", "o2")]
    assert run(spark, rows) == want
    # The same after initialisation, with a prewrite and a commit that come again later.
    rows = [entry(-1, "INITIALIZED", 0, 0, ""), *rows[:-1], entry(20, "PREWRITE", 1, 0, "k1", "v1", "o1"), entry(21, "COMMIT", 1, 2, "k1")]
    assert [x[1:] for x in run(spark, rows)] == [x[1:] for x in want]


def test_the_last_value_is_taken(spark):
    sent = [entry(1, "PREWRITE", 1, 0, "k", "v1", "o"), entry(2, "PREWRITE", 1, 0, "k", "v2", "o"), entry(3, "PREWRITE", 1, 0, "k", None, "o"), entry(4, "COMMIT", 1, 2, "k"), entry(5, "PREWRITE", 1, 0, "k", "v3", "o")]
    for start in (0, 9):
        assert [x[4] for x in run(spark, [*sent, entry(start, "INITIALIZED", 0, 0, "")])] == ["v2"]


def test_echo_of_early_commits(spark):
    rows = [entry(0, "INITIALIZED", 0, 0, ""), entry(1, "COMMIT", 1, 2, "k"), entry(2, "PREWRITE", 1, 0, "k", "v", "o"), entry(3, "PREWRITE", 5, 0, "k", "w"), entry(4, "COMMIT", 5, 6, "k")]
    log = spark.createDataFrame(rows, SCHEMA)
    regions = spark.createDataFrame([(1, "", "")], "region_id long, start_key string, end_key string")
    found = matcher.ordered(matcher.changes(log, regions, include_prewrite_echo=True)).collect()
    assert [(r.commit_ts, r.new_value) for r in found] == [(0, "v"), (2, "v"), (6, "w")]


def test_waiting_rollbacks_clear_prewrites(spark):
    rows = [entry(i, "ROLLBACK", s, 0, k) for i, (s, k) in enumerate([(1, "k1"), (3, "k2"), (4, "k3")])]
    rows += [entry(3 + i, "PREWRITE", s, 0, k, "v", "o") for i, (s, k) in enumerate([(1, "k1"), (3, "k2"), (4, "k3")])]
    rows += [entry(6, "INITIALIZED", 0, 0, ""), entry(7, "COMMIT", 1, 9, "k1"), entry(8, "COMMIT", 3, 9, "k2"), entry(9, "COMMIT", 4, 9, "k3")]
    assert run(spark, rows) == []


class Model:
    """One region, entry by entry."""

    def __init__(self):
        self.open, self.pre, self.commits, self.dead, self.out, self.done = False, {}, {}, [], [], set()

    def take(self, seq, k, commit_ts):
        new, old = self.pre.pop(k)
        self.done.add(k)
        self.out.append((seq, k[0], commit_ts, k[1], new, old))

    def feed(self, r):
        seq, _, kind, _, key, start, commit, new, old = r
        k = (start, key)
        if kind == "INITIALIZED":
            self.open = True
            for w in list(self.commits):
                if w in self.pre:
                    self.take(seq, w, self.commits.pop(w))
            for d in self.dead:
                self.pre.pop(d, None)
        elif kind == "PREWRITE":
            if self.open and k in self.commits:
                self.done.add(k)
                self.out.append((seq, start, self.commits.pop(k), key, new, old))
            elif new or k not in self.pre:
                self.pre[k] = (new, old)
        elif kind == "COMMIT":
            if k in self.done:  # sent again
                return
            if k in self.pre and (self.open or self.pre[k][0]):
                self.commits.pop(k, None)  # its first copy waits no more
                self.take(seq, k, commit)
            else:
                self.commits[k] = commit
        elif kind == "ROLLBACK":
            if self.open:
                self.pre.pop(k, None)
            else:
                self.dead.append(k)


def random_log(seed):
    rng, rows = random.Random(seed), []
    for s in range(60):
        own = [("COMMIT", None)] * rng.choice([1, 1, 2]) + [("ROLLBACK", None)] * rng.choice([0, 0, 0, 1, 2])
        own += [("PREWRITE", f"v{s}.{i}") for i in range(rng.choice([0, 1, 1, 1, 1, 2, 3]))]
        rng.shuffle(own)
        at = sorted(rng.sample(range(10, 5000), len(own)))
        rows += [(t, kind, s, v) for t, (kind, v) in zip(at, own)]
        if rng.random() < 0.3:
            rows.append((rng.randrange(10, 2500), "PREWRITE", s, None))
    rows.append((2500, "INITIALIZED", None, None))
    rows.sort(key=lambda r: (r[0], str(r[1:])))
    return [entry(i, kind, s or 0, (s or 0) * 10 + 5 if kind == "COMMIT" else 0, f"k{s}" if s is not None else "", v, "old") for i, (_, kind, s, v) in enumerate(rows)]


@pytest.mark.parametrize("seed", range(5))
def test_random_logs_equal_the_model(spark, seed):
    rows = random_log(seed)
    model = Model()
    for r in rows:
        model.feed(r)
    assert run(spark, rows) == sorted(model.out)


def streamed(spark, tmp_path, batches, make):
    """The rows that ``make(stream)`` puts out over micro-batches of log rows."""
    source = tmp_path / "rows"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        source.mkdir(exist_ok=True)
        for f in (tmp_path / f"part{i}").glob("*.parquet"):
            shutil.copy(f, source / f"{i}.parquet")
            os.utime(source / f"{i}.parquet", (1000 + i, 1000 + i))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    query = make(stream).writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(str(tmp_path / "o")).collect(), query.lastProgress


def test_stream_emits_once_and_forgets(spark, tmp_path):
    one = [entry(0, "INITIALIZED", 0, 0, ""), entry(1, "PREWRITE", 10, 0, "a", "v1"), entry(2, "PREWRITE", 10, 0, "a", "v2"), entry(3, "COMMIT", 10, 12, "a"), entry(4, "COMMIT", 10, 12, "a")]
    one += [entry(5, "PREWRITE", 11, 0, "lost", "v"), entry(6, "COMMIT", 50, 52, "early"), entry(7, "PREWRITE", 60, 0, "open", "w")]
    two = [entry(10, "PREWRITE", 10, 0, "a", "v2"), entry(11, "COMMIT", 10, 12, "a"), entry(12, "PREWRITE", 50, 0, "early", "x"), entry(13, "RESOLVED", 0, 55, "")]
    three = [entry(20, "COMMIT", 60, 62, "open"), entry(21, "RESOLVED", 0, 70, "")]
    found, progress = streamed(spark, tmp_path, [one, two, three], stream_changes)
    assert sorted((r.emit_seq, r.key, r.new_value) for r in found) == [(3, "a", "v2"), (12, "early", "x"), (20, "open", "w")]
    assert progress["stateOperators"][0]["numRowsTotal"] == 1  # the initialisation alone


def test_late_changes_of_a_stream(spark, tmp_path):
    rows = [[entry(i, "COMMITTED", 1, 10 * i, f"k{i}", region=i) for i in range(1, 6)], [entry(9, "ADVANCE", 0, 75, ""), entry(8, "COMMITTED", 1, 70, "k", region=2), *[entry(i, "COMMITTED", 1, t, "k", region=i) for i, t in ((10, 70), (11, 75), (12, 80))]]]

    def make(stream):
        changes = stream.where("log_type = 'COMMITTED'").selectExpr("seq emit_seq", "region_id", "key", "commit_ts")
        return stream_late_filter(changes, stream.where("log_type = 'ADVANCE'").selectExpr("seq from_seq", "commit_ts resolved_ts"), 4)

    found, _ = streamed(spark, tmp_path, rows, make)
    assert sorted((r.emit_seq, r.frontier_ts) for r in found) == [*[(i, -1) for i in range(1, 6)], (8, -1), (12, 75)]


def test_delivery_and_close(spark, tmp_path):
    seen, closed = [], []

    class Listener:
        def __call__(self, batch, number):
            seen.extend(r.key for r in batch.collect())

        def close(self, error):
            closed.append(error)

    spark.createDataFrame([entry(1, "COMMITTED", 5, 9, "b", "v"), entry(2, "COMMITTED", 1, 3, "a", "v")], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in"))
    query = deliver(stream, [Listener(), lambda b, n: seen.append(n)], str(tmp_path / "ck"), available_now=True)
    query.awaitTermination()
    for _ in range(50):
        if closed:
            break
        time.sleep(0.1)
    assert seen == ["a", "b", 0] and closed == [None]


def test_stream_equals_batch(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    log, regions = derived.change_log(spark, sf), derived.key_regions(spark, sf)
    rows = matcher.in_range(log, regions).select(*COLUMNS)
    for i in range(3):
        rows.where(f"seq >= {i * 6000} and seq < {(i + 1) * 6000}").coalesce(1).write.parquet(str(tmp_path / f"log/part={i}"))
    parts = [str(tmp_path / f"log/part={i}") for i in range(3)]
    source = tmp_path / "in"
    source.mkdir()
    for i, p in enumerate(parts):
        for f in Path(p).glob("*.parquet"):
            shutil.copy(f, source / f"{i}.parquet")
            os.utime(source / f"{i}.parquet", (1000 + i, 1000 + i))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    query = stream_changes(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    columns = ["emit_seq", "region_id", "key", "start_ts", "commit_ts", "new_value", "old_value", "operate_type"]
    got = sorted(map(str, spark.read.parquet(str(tmp_path / "out")).select(*columns).collect()))
    assert got == sorted(map(str, matcher.changes(log, regions).select(*columns).collect())) and len(got) == 849
