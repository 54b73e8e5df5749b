"""A change feed by key range as one streaming query: matched changes, the frontier of its ranges, delivery in commit order.

    log -+- marks of regions -> RangeFrontier, a key range bucket -> Combined, one row a change of a bucket's minimum -+
         +- all rows -> RangeMatcher, a bucket and salt -> changes -------------------------------------------------- Release

State is keyed by ranges of keys, never by region: a region that is split or merged hands its transactions over by being
followed under other names, since its keys stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.scalar import operate_type
from millrace.model import COMMIT, COMMITTED, INITIALIZED, JOINED, MAX_TS, PREWRITE, RESOLVED, ROLLBACK, STOPPED, log_schema
from millrace.operators.frontier import assign
from millrace.operators.sweep import block_of, blocks_met
from millrace.streaming.matcher import change_schema

REGION_MARKS = (JOINED, INITIALIZED, RESOLVED, STOPPED)
CHANGE, RESOLVED_ROW = "change", "resolved"
_ENTRY = T.StructType().add("start_ts", "long").add("key", "string")
_REGION = T.StructType().add("start", "string").add("end", "string").add("open", "boolean").add("resolved", "long")
_ID = T.StructType().add("region_id", "long")


def feed_schema(value: T.DataType) -> T.StructType:
    """Rows of a log by key range. Marks carry their region's range as ``key`` and ``end_key`` (empty or null: open).

    JOINED says that the region is followed from the timestamp ``commit_ts`` on, INITIALIZED that its first scan is
    complete, RESOLVED that none of its commits at or below ``commit_ts`` is still to come, STOPPED that it is left.
    """
    return log_schema(T.StringType(), value).add("end_key", "string")


def by_range(log: DataFrame, splits: list[str]) -> DataFrame:
    """Rows with the bucket of their key; marks go to every bucket that their region meets. ``sweep.cuts_of`` finds splits."""
    mark = F.col("log_type").isin(*REGION_MARKS)
    return log.withColumn("bucket", F.explode(F.when(mark, blocks_met(F.col("key"), F.col("end_key"), splits)).otherwise(F.array(block_of(F.col("key"), splits)))))


class Blocks:
    """Rows of a state key in blocks of a timestamp, so that those up to a bound are found without a walk over the rest.

    Rows are tuples whose first field is the timestamp. New ones of a micro-batch become one chunk a block.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, row: T.StructType, width: int) -> None:
        self.width, self.new = width, {}
        place = T.StructType().add("block", "long").add("chunk", "long")
        self.chunks = handle.getMapState(name, place, T.StructType().add("rows", T.ArrayType(row)))
        self.count = handle.getValueState(f"{name}_count", T.StructType().add("n", "long"))

    def add(self, row: tuple) -> None:
        self.new.setdefault(row[0] // self.width, []).append(row)

    def take(self, bound: int) -> list[tuple]:
        """Remove and return the rows at or below ``bound``, in no order."""
        last, found = bound // self.width, []
        for place in [tuple(p) for p in self.chunks.keys() if p[0] <= last]:
            found += [tuple(r) for r in self.chunks.getValue(place)[0]]
            self.chunks.removeKey(place)
        for block in [b for b in self.new if b <= last]:
            found += self.new.pop(block)
        for row in (r for r in found if r[0] > bound):
            self.add(row)
        return [r for r in found if r[0] <= bound]

    def flush(self) -> None:
        if self.new:
            n = self.count.get()[0] if self.count.exists() else 0
            for block, rows in self.new.items():
                self.chunks.updateValue((block, n), (rows,))
            self.count.update((n + 1,))
            self.new = {}


class _Regions:
    """The regions followed in a bucket: [start, end, open, resolved] by id; only what changed is written back."""

    def __init__(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("regions", _ID, _REGION)

    def load(self) -> dict[int, list]:
        self.known = {k[0]: list(v) for k, v in self.state.iterator()}
        self.changed: set[int] = set()
        return self.known

    def mark(self, r: Row) -> bool:
        """Apply a mark; whether it opens its region, sets it forward, or ends it."""
        region = self.known.get(r.region_id)
        if r.log_type == JOINED:
            self.known[r.region_id] = [r.key or "", r.end_key or "", False, r.commit_ts]
        elif region is None or (r.log_type == INITIALIZED and region[2]) or (r.log_type == RESOLVED and (not region[2] or r.commit_ts < region[3])):
            return False
        elif r.log_type == STOPPED:
            del self.known[r.region_id]
        elif r.log_type == INITIALIZED:
            region[2] = True
        else:
            region[3] = r.commit_ts
        self.changed.add(r.region_id)
        return True

    def save(self) -> None:
        for region in self.changed:
            if region in self.known:
                self.state.updateValue((region,), tuple(self.known[region]))
            else:
                self.state.removeKey((region,))


class RangeFrontier(StatefulProcessor):
    """The least resolved timestamp of a bucket of the key space, through its interval map.

    The map starts at ``start_ts`` all over the span that is followed, so a range that no region has resolved holds the minimum,
    and so does the range of a region that is left until others have resolved all of it. Resolved timestamps of unknown, left or not
    initialised regions, and those that fall back, are passed over. Accepted ones are put out (by the bucket of the region's start), as
    is each change of the bucket's minimum.
    """

    SCHEMA = T.StructType().add("kind", "string").add("bucket", "integer").add("seq", "long").add("region_id", "long").add("start_key", "string").add("end_key", "string").add("ts", "long")

    def __init__(self, splits: list[str], start_ts: int, span: tuple[str, str]) -> None:
        self.splits, self.start_ts, self.span = splits, start_ts, span

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.regions = _Regions(handle)
        self.map = handle.getValueState("map", T.StructType().add("starts", T.ArrayType(T.StringType())).add("values", T.ArrayType(T.LongType())))

    def _first(self, low: str, high: str) -> tuple[list[str], list[int]]:
        starts, values = [low], [MAX_TS]
        start, end = max(low, self.span[0]), min(filter(None, (high, self.span[1])), default="")
        if not end or start < end:
            assign(starts, values, start, end, self.start_ts)
        return starts, values

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        (bucket,) = key
        low, high = ([""] + self.splits)[bucket], [*self.splits, ""][bucket]
        known = self.regions.load()
        fresh = not self.map.exists()
        starts, values = self._first(low, high) if fresh else map(list, self.map.get())
        least = None if fresh else min(values)
        for r in sorted(rows, key=lambda r: r.seq):
            if self.regions.mark(r) and r.log_type == RESOLVED:
                start, end, _, ts = known[r.region_id]
                if start >= low:
                    yield Row(kind=RESOLVED_ROW, bucket=bucket, seq=r.seq, region_id=r.region_id, start_key=start, end_key=end, ts=ts)
                assign(starts, values, max(start, low), min(filter(None, (end, high)), default=""), ts)
            if min(values) != least:
                least = min(values)
                yield Row(kind="minimum", bucket=bucket, seq=r.seq, region_id=None, start_key=None, end_key=None, ts=least)
        self.map.update((starts, values))
        self.regions.save()

    def close(self) -> None:
        pass


class Combined(StatefulProcessor):
    """The least of all buckets' minima, put out whenever it rises; its input is a row for each change of a bucket."""

    SCHEMA = T.StructType().add("from_seq", "long").add("resolved_ts", "long")

    def __init__(self, buckets: int, start_ts: int) -> None:
        self.buckets, self.start_ts = buckets, start_ts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("minima", T.StructType().add("last", "long").add("minima", T.ArrayType(T.LongType())))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        last, minima = self.state.get() if self.state.exists() else (self.start_ts, [self.start_ts] * self.buckets)
        minima, by_seq = list(minima), {}
        for r in rows:
            by_seq.setdefault(r.seq, []).append(r)
        for seq in sorted(by_seq):
            for r in by_seq[seq]:
                minima[r.bucket] = r.ts
            if (low := min(minima)) > last and low < MAX_TS:
                last = low
                yield Row(from_seq=seq, resolved_ts=low)
        self.state.update((last, minima))

    def close(self) -> None:
        pass


def stream_region_marks(log: DataFrame, splits: list[str], start_ts: int = 0, span: tuple[str, str] = ("", "")) -> DataFrame:
    """Accepted resolved rows and the changes of each bucket's minimum, of a streamed log's marks."""
    marks = by_range(log.where(F.col("log_type").isin(*REGION_MARKS)), splits).select("bucket", "seq", "region_id", "log_type", "key", "end_key", "commit_ts")
    return marks.groupBy("bucket").transformWithState(RangeFrontier(splits, start_ts, span), RangeFrontier.SCHEMA, outputMode="Append", timeMode="None")


def stream_range_frontier(log: DataFrame, splits: list[str], start_ts: int = 0, span: tuple[str, str] = ("", "")) -> DataFrame:
    """(from_seq, resolved_ts): the rises of the frontier over the whole ``span`` of keys of a streamed log."""
    minima = stream_region_marks(log, splits, start_ts, span).where("kind = 'minimum'").select("bucket", "seq", "ts", F.lit(0).alias("all"))
    return minima.groupBy("all").transformWithState(Combined(len(splits) + 1, start_ts), Combined.SCHEMA, outputMode="Append", timeMode="None")


class RangeMatcher(StatefulProcessor):
    """Joins commits with prewrites by (start_ts, key) within a bucket of keys, whatever region they come by.

    A row counts if its region is followed and its range holds the key. Before its region's initialisation a commit matches a
    prewrite with a value at once and waits otherwise; rollbacks wait too. After it, commits and prewrites match in either order and
    a rollback removes a waiting prewrite. A change is put out once, also if a region that has been joined again sends it again.
    What the least resolved timestamp of the bucket's regions has passed is forgotten, through blocks of timestamps.
    """

    def __init__(self, value: T.DataType, width: int) -> None:
        self.value, self.width = value, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.regions = _Regions(handle)
        self.prewrites = handle.getMapState("prewrites", _ENTRY, T.StructType().add("new_value", self.value).add("old_value", self.value))
        self.commits = handle.getMapState("commits", _ENTRY, T.StructType().add("commit_ts", "long").add("op_type", "string"))
        self.done = handle.getMapState("done", _ENTRY, T.StructType().add("commit_ts", "long"))
        self.rollbacks = handle.getMapState("rollbacks", _ENTRY, T.StructType().add("seq", "long"))
        self.ages = Blocks(handle, "ages", T.StructType().add("ts", "long").add("what", "string").add("start_ts", "long").add("key", "string"), self.width)

    def _put(self, what: str, entry: tuple, value: tuple, ts: int) -> None:
        getattr(self, what).updateValue(entry, value)
        self.ages.add((ts, what, *entry))

    def _taken(self, state, entry: tuple) -> tuple | None:
        if not state.containsKey(entry):
            return None
        value = tuple(state.getValue(entry))
        state.removeKey(entry)
        return value

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        known = self.regions.load()
        self.ages.new = {}

        def change(r: Row, entry: tuple, commit_ts: int, op: str, new, old) -> Row:
            self._put("done", entry, (commit_ts,), commit_ts)
            return Row(emit_seq=r.seq, region_id=r.region_id, key=entry[1], start_ts=entry[0], commit_ts=commit_ts, op_type=op, new_value=new, old_value=old)

        for r in sorted(rows, key=lambda r: r.seq):
            if r.log_type in REGION_MARKS:
                if self.regions.mark(r) and r.log_type == INITIALIZED:
                    yield from self._initialized(r, *known[r.region_id][:2], change)
                continue
            region, entry = known.get(r.region_id), (r.start_ts, r.key)
            if region is None or r.key < region[0] or (region[1] and r.key >= region[1]):
                continue
            was_done = r.log_type in (COMMITTED, COMMIT) and self.done.containsKey(entry) and self.done.getValue(entry)[0] == r.commit_ts
            if r.log_type == COMMITTED and not was_done:
                yield change(r, entry, r.commit_ts, r.op_type, r.new_value, r.old_value)
            elif r.log_type == PREWRITE:
                waiting = self._taken(self.commits, entry) if region[2] else None
                if waiting:
                    yield change(r, entry, *waiting, r.new_value, r.old_value)
                elif _has(r.new_value) or not self.prewrites.containsKey(entry):
                    self._put("prewrites", entry, (r.new_value, r.old_value), r.start_ts)
            elif r.log_type == COMMIT and not was_done:
                held = self.prewrites.getValue(entry) if self.prewrites.containsKey(entry) else None
                if held and (region[2] or _has(held[0])):
                    self._taken(self.commits, entry)
                    yield change(r, entry, r.commit_ts, r.op_type, *self._taken(self.prewrites, entry))
                elif not self.commits.containsKey(entry):
                    self._put("commits", entry, (r.commit_ts, r.op_type), r.commit_ts)
            elif r.log_type == ROLLBACK and region[2]:
                self.prewrites.removeKey(entry)
            elif r.log_type == ROLLBACK:
                self._put("rollbacks", entry, (r.seq,), r.start_ts)
        if known and all(region[2] for region in known.values()):
            self._forget(min(region[3] for region in known.values()))
        self.ages.flush()
        self.regions.save()

    def _initialized(self, r: Row, start: str, end: str, change) -> Iterator[Row]:
        """Waiting commits and rollbacks of the region's range are applied, in this order."""
        within = lambda entry: entry[1] >= start and (not end or entry[1] < end)
        for waiting, commit in [(tuple(k), tuple(v)) for k, v in self.commits.iterator() if within(k)]:
            found = self._taken(self.prewrites, waiting)
            if found:
                self.commits.removeKey(waiting)
                yield change(r, waiting, *commit, *found)
        for dead in [tuple(k) for k in self.rollbacks.keys() if within(k)]:
            self.prewrites.removeKey(dead)
            self.rollbacks.removeKey(dead)

    def _forget(self, resolved: int) -> None:
        for ts, what, *entry in self.ages.take(resolved):
            state, entry = getattr(self, what), tuple(entry)
            # A commit or a change may have been put again under a later timestamp, which has a row of its own.
            if state.containsKey(entry) and (what in ("prewrites", "rollbacks") or state.getValue(entry)[0] == ts):
                state.removeKey(entry)

    def close(self) -> None:
        pass


def _has(value) -> bool:
    return value is not None and value != "" and value != b""


def stream_range_changes(log: DataFrame, splits: list[str], salts: int = 1, width: int = 1 << 14) -> DataFrame:
    """The changelog of a streamed log by key range. ``salts`` deals the keys of a bucket over as many states, each of which sees its marks."""
    value = log.schema["new_value"].dataType
    rows, mark = by_range(log, splits), F.col("log_type").isin(*REGION_MARKS)
    own = F.array(F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int"))
    rows = rows.withColumn("salt", F.explode(F.when(mark, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(own)))
    found = rows.groupBy("bucket", "salt").transformWithState(RangeMatcher(value, width), change_schema(value), outputMode="Append", timeMode="None")
    return found.withColumn("operate_type", operate_type(F.col("op_type"), F.col("old_value")))


class Release(StatefulProcessor):
    """Holds changes until the frontier has reached their commit and lets them go by commit, region, key and transaction.

    A change at or below the frontier of an earlier micro-batch has come too late and is dropped: those above it have not been let go,
    so what leaves is in order within a micro-batch and over them. Bucket 0 puts out the frontier itself.
    """

    def __init__(self, change: T.StructType, width: int) -> None:
        self.change, self.width = change, width
        self.rest = [n for n in change.names if n not in _ORDER]

    def init(self, handle: StatefulProcessorHandle) -> None:
        row = T.StructType([self.change[n] for n in (*_ORDER, *self.rest)])
        self.held = Blocks(handle, "held", row, self.width)
        self.frontier = handle.getValueState("frontier", T.StructType().add("ts", "long"))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        before = now = self.frontier.get()[0] if self.frontier.exists() else -1
        self.held.new = {}
        for r in rows:
            if r.rise is not None:
                now = max(now, r.rise)
            elif r.change["commit_ts"] > before:
                self.held.add(tuple(r.change[n] for n in (*_ORDER, *self.rest)))
        if now > before:
            for row in sorted(self.held.take(now), key=lambda row: row[: len(_ORDER)]):
                yield Row(kind=CHANGE, **dict(zip((*_ORDER, *self.rest), row, strict=True)), frontier_ts=now)
            self.frontier.update((now,))
            if key[0] == 0:
                yield Row(kind=RESOLVED_ROW, **dict.fromkeys(self.change.names), frontier_ts=now)
        self.held.flush()

    def close(self) -> None:
        pass


_ORDER = ("commit_ts", "region_id", "key", "start_ts")


def stream_released(changes: DataFrame, rises: DataFrame, buckets: int = 64, width: int = 1 << 14) -> DataFrame:
    """``changes`` once the frontier has reached them, as rows of kind ``change``, and the frontier, of kind ``resolved``.

    ``rises`` is a stream of (from_seq, resolved_ts) of the same query. Changes are dealt by key over ``buckets`` states, the rises,
    a few rows, to each. No column of the changes may be named kind or frontier_ts.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in changes.columns])
    one = changes.select(F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), F.lit(None).cast("long").alias("rise"), row.alias("change"))
    many = rises.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), F.col("resolved_ts").alias("rise"), F.lit(None).cast(one.schema["change"].dataType).alias("change"))
    names = [*_ORDER, *[n for n in changes.columns if n not in _ORDER]]
    fields = [T.StructField(n, changes.schema[n].dataType) for n in names]
    schema = T.StructType([T.StructField("kind", T.StringType()), *fields, T.StructField("frontier_ts", T.LongType())])
    change = T.StructType([T.StructField(n, changes.schema[n].dataType) for n in changes.columns])
    return one.unionByName(many).groupBy("bucket").transformWithState(Release(change, width), schema, outputMode="Append", timeMode="None")


def stream_feed(log: DataFrame, splits: list[str], start_ts: int = 0, span: tuple[str, str] = ("", ""), salts: int = 1, buckets: int = 64) -> DataFrame:
    """A streamed log (``feed_schema``) as changes in commit order and the frontier that lets them go."""
    return stream_released(stream_range_changes(log, splits, salts), stream_range_frontier(log, splits, start_ts, span), buckets)
