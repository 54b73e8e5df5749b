"""The matcher as a stateful stream: one region's entries in order of arrival, state in the state store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.scalar import operate_type
from millrace.model import COMMIT, COMMITTED, INITIALIZED, PREWRITE, RESOLVED, ROLLBACK, STOPPED

_ENTRY = T.StructType().add("start_ts", "long").add("key", "string")


def change_schema(value: T.DataType) -> T.StructType:
    return (
        T.StructType()
        .add("emit_seq", "long")
        .add("region_id", "long")
        .add("key", "string")
        .add("start_ts", "long")
        .add("commit_ts", "long")
        .add("op_type", "string")
        .add("new_value", value)
        .add("old_value", value)
    )


class Matcher(StatefulProcessor):
    """Joins commits with prewrites by (start_ts, key) within a region.

    Before the region's initialisation mark a commit matches a prewrite with a value at once and waits for
    the mark otherwise; rollbacks wait too and are applied after the waiting commits. After it, commits and
    prewrites match in either order and a rollback removes a waiting prewrite. A prewrite is used up by its commit,
    and a commit that is sent again after that is dropped.

    A resolved mark says that no commit at or below its timestamp is still to come and that no transaction that began by
    then is still open: what waits or is remembered of those is forgotten, so state holds what is above
    the resolved timestamp alone. A stop mark forgets all of the region. Rows of a region and micro-batch are sorted in memory;
    the source's admission bounds them.
    """

    def __init__(self, value: T.DataType) -> None:
        self.value = value

    def init(self, handle: StatefulProcessorHandle) -> None:
        prewrite = T.StructType().add("new_value", self.value).add("old_value", self.value)
        commit = T.StructType().add("commit_ts", "long").add("op_type", "string")
        self.prewrites = handle.getMapState("prewrites", _ENTRY, prewrite)
        self.commits = handle.getMapState("commits", _ENTRY, commit)
        self.done = handle.getMapState("done", _ENTRY, T.StructType().add("commit_ts", "long"))
        self.rollbacks = handle.getMapState("rollbacks", _ENTRY, T.StructType().add("seq", "long"))
        self.started = handle.getValueState("started", T.StructType().add("seq", "long"))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        (region,) = key
        open_ = self.started.exists()
        resolved = -1

        def change(seq: int, entry: tuple, commit_ts: int, op: str, new, old) -> Row:
            return Row(emit_seq=seq, region_id=region, key=entry[1], start_ts=entry[0], commit_ts=commit_ts, op_type=op, new_value=new, old_value=old)

        for r in sorted(rows, key=lambda r: r.seq):
            entry = (r.start_ts, r.key)
            if r.log_type == INITIALIZED and not open_:
                open_ = True
                self.started.update((r.seq,))
                for waiting, commit in list(self.commits.iterator()):
                    found = self._take(tuple(waiting))
                    if found:
                        self.commits.removeKey(tuple(waiting))
                        self.done.updateValue(tuple(waiting), (commit[0],))
                        yield change(r.seq, tuple(waiting), commit[0], commit[1], *found)
                for dead in list(self.rollbacks.keys()):
                    self.prewrites.removeKey(tuple(dead))
                self.rollbacks.clear()
            elif r.log_type == COMMITTED:
                yield change(r.seq, entry, r.commit_ts, r.op_type, r.new_value, r.old_value)
            elif r.log_type == PREWRITE:
                waiting = self.commits.getValue(entry) if open_ and self.commits.containsKey(entry) else None
                if waiting:
                    self.commits.removeKey(entry)
                    self.done.updateValue(entry, (waiting[0],))
                    yield change(r.seq, entry, waiting[0], waiting[1], r.new_value, r.old_value)
                elif _has(r.new_value) or not self.prewrites.containsKey(entry):
                    self.prewrites.updateValue(entry, (r.new_value, r.old_value))
            elif r.log_type == RESOLVED:
                resolved = max(resolved, r.commit_ts)
            elif r.log_type == STOPPED:
                for state in (self.prewrites, self.commits, self.rollbacks, self.done, self.started):
                    state.clear()
                open_, resolved = False, -1
            elif r.log_type == COMMIT:
                if self.done.containsKey(entry) and self.done.getValue(entry)[0] == r.commit_ts:
                    continue
                held = self.prewrites.getValue(entry) if self.prewrites.containsKey(entry) else None
                if held and (open_ or _has(held[0])):
                    self.done.updateValue(entry, (r.commit_ts,))
                    if self.commits.containsKey(entry):  # its first copy waits no more
                        self.commits.removeKey(entry)
                    yield change(r.seq, entry, r.commit_ts, r.op_type, *self._take(entry))
                elif not self.commits.containsKey(entry):
                    self.commits.updateValue(entry, (r.commit_ts, r.op_type))
            elif r.log_type == ROLLBACK:
                if open_:
                    self.prewrites.removeKey(entry)
                else:
                    self.rollbacks.updateValue(entry, (r.seq,))

        if open_ and resolved >= 0:
            self._forget(resolved)

    def _forget(self, resolved: int) -> None:
        for state, ended in ((self.prewrites, lambda k, v: k[0]), (self.rollbacks, lambda k, v: k[0]), (self.commits, lambda k, v: v[0]), (self.done, lambda k, v: v[0])):
            for entry in [tuple(k) for k, v in state.iterator() if ended(k, v) <= resolved]:
                state.removeKey(entry)

    def _take(self, entry: tuple) -> tuple | None:
        if not self.prewrites.containsKey(entry):
            return None
        held = tuple(self.prewrites.getValue(entry))
        self.prewrites.removeKey(entry)
        return held

    def close(self) -> None:
        pass


def _has(value) -> bool:
    return value is not None and value != "" and value != b""


def stream_changes(log: DataFrame) -> DataFrame:
    """The changelog of a streamed log whose rows are in range. Keys are strings; values of any type."""
    value = log.schema["new_value"].dataType
    found = log.groupBy("region_id").transformWithState(Matcher(value), change_schema(value), outputMode="Append", timeMode="None")
    return found.withColumn("operate_type", operate_type(F.col("op_type"), F.col("old_value")))
