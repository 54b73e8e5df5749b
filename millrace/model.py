"""Data model: schemas, enumerations, options and errors of a change log."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MAX_TS = (1 << 63) - 1
"""A timestamp without bound: endless reading, or a range that nothing has advanced yet."""

INITIALIZED, COMMITTED, PREWRITE, COMMIT, ROLLBACK = LOG_TYPES = ("INITIALIZED", "COMMITTED", "PREWRITE", "COMMIT", "ROLLBACK")
#: Marks of a streamed log without a key: the region's resolved timestamp (as commit_ts), that it is left, that it is followed from commit_ts on.
RESOLVED, STOPPED, JOINED = MARKS = ("RESOLVED", "STOPPED", "JOINED")
PUT, DELETE = "PUT", "DELETE"

#: Fixed codes of the operation types; there is no code 5.
OPERATE_CODES = {"Ddl": 0, "Insert": 1, "Delete": 2, "Update": 3, "Heartbeat": 4, "Resolved": 6, "Unknown": 7}


def log_schema(key: T.DataType | None = None, value: T.DataType | None = None) -> T.StructType:
    """Rows of a change log; keys and values are opaque bytes unless the table's types are given."""
    key, value = key or T.BinaryType(), value or T.BinaryType()
    return (
        T.StructType()
        .add("seq", "long")
        .add("region_id", "long")
        .add("log_type", "string")
        .add("op_type", "string")
        .add("key", key)
        .add("start_ts", "long")
        .add("commit_ts", "long")
        .add("new_value", value)
        .add("old_value", value)
    )


def region_schema(key: T.DataType | None = None) -> T.StructType:
    """Half-open key ranges; a null or empty end is the end of all keys."""
    key = key or T.BinaryType()
    return T.StructType().add("region_id", "long").add("start_key", key).add("end_key", key)


@dataclass(frozen=True)
class Options:
    """Settings of a feed: how far to rewind, how large a row may be before it is noted, how fast a stream may read."""

    rewind: int = 20_000_000_000
    max_row_bytes: int = 12 << 20
    rate_kb_per_s: int = 20_000


class ChangeLogError(Exception):
    """Base of all errors of this library; ``code`` names the kind."""

    code = "ErrorEvent"

    def __init__(self, message: str, code: str | None = None) -> None:
        super().__init__(message)
        self.code = code or self.code


class VersionIncompatible(ChangeLogError):
    code = "ErrVersionIncompatible"


class ClusterMismatch(ChangeLogError):
    code = "ErrClusterIDMismatch"


class ClientError(ChangeLogError):
    """A request that can't be carried out as it was made."""


class ServerError(ChangeLogError):
    """A failure of the store; ``sql_state`` is its SQL state."""

    def __init__(self, message: str, code: str | None = None, sql_state: str | None = None) -> None:
        super().__init__(message, code)
        self.sql_state = sql_state


#: Errors of a region by what they call for: a new leader, a new division of its range, or the end of the query.
REGION_ERRORS = {
    "NotLeader": "relocate",
    "EpochNotMatch": "redivide",
    "RegionNotFound": "fail",
    "DuplicateRequest": "fail",
    "Compatibility": "fail",
    "ClusterIdMismatch": "fail",
}
