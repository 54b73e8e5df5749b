"""A Spark data source that reads key ranges page by page, one partition a region.

The transport is the user's: a function ``pages(start, n)`` that returns up to ``n`` rows, (key, value) or more, from
``start`` on and the end of the region that holds ``start``. It is named in the options as
``module:factory``; ``factory(region)`` makes it on the executor.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from millrace.functions.scalar import is_retryable, retry_delay
from millrace.model import ClientError

Rows = list[tuple]
Pages = Callable[[bytes, int], tuple[Rows | None, bytes]]


def paged_scan(pages: Pages, start: bytes, end: bytes, page: int = 256, limit: int | None = None) -> Iterator[tuple]:
    """Rows of ``[start, end)``; an empty end is open.

    A short page ends its region and the scan goes on at the region's end; after a full one it goes on
    behind its last key. No page at all ends the scan, an empty one doesn't. A page beyond what was
    asked for is an error.
    """
    left = limit
    while left is None or left > 0:
        n = page if left is None else min(left, page)
        rows, region_end = pages(start, n)
        if rows is None:
            return
        if len(rows) > n:
            raise ClientError(f"asked for {n} rows, got {len(rows)}")
        for row in rows:
            if end and row[0] >= end:
                return
            yield row
        if left is not None:
            left -= len(rows)
        start = rows[-1][0] + b"\0" if len(rows) == n else region_end
        if not start or (end and start >= end):
            return


def retried(pages: Pages, tries: int = 5, sleep: Callable[[float], None] = time.sleep) -> Pages:
    """``pages`` with failures tried again after growing delays, unless they can't be mended so."""

    def run(start: bytes, n: int) -> tuple[Rows | None, bytes]:
        for failures in range(1, tries + 1):
            try:
                return pages(start, n)
            except Exception as error:
                if failures == tries or not is_retryable(error):
                    raise
                sleep(retry_delay(failures))
        raise AssertionError

    return run


class RegionPartition(InputPartition):
    def __init__(self, region_id: int, start: bytes, end: bytes, checkpoint_ts: int) -> None:
        super().__init__(region_id)
        self.region_id, self.start, self.end, self.checkpoint_ts = region_id, start, end, checkpoint_ts


class KeyRangeSource(DataSource):
    """Options: ``pages`` (module:factory), ``regions`` (JSON list of region_id, start and end in hex, checkpoint_ts), ``page_size``, ``limit``.

    With ``versions`` pages return (key, value, commit_ts), and rows at or below their region's checkpoint_ts, which the factory
    gets with its region, are left out. With ``pushdown``, which needs ``spark.sql.python.filterPushdown.enabled``, filters on
    region_id, key and commit_ts reach the scan: regions that hold no such key aren't asked, the others from the first such key to
    the last, and from the least commit_ts on.
    """

    @classmethod
    def name(cls) -> str:
        return "keyrange"

    def schema(self) -> str:
        return "region_id long, key binary, value binary" + (", commit_ts long" if self.options.get("versions") else "")

    def reader(self, schema) -> DataSourceReader:
        return (_Pushing if self.options.get("pushdown") else _Reader)(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.pages = options["pages"]
        self.regions = json.loads(options["regions"])
        self.page, self.limit = int(options.get("page_size", 256)), options.get("limit")
        self.versions = bool(options.get("versions"))
        self.low, self.high, self.after, self.only = b"", b"", -1, None

    def partitions(self) -> list[RegionPartition]:
        found = []
        for r in self.regions:
            start, end = max(bytes.fromhex(r.get("start", "")), self.low), min(filter(None, (bytes.fromhex(r.get("end", "")), self.high)), default=b"")
            if (not end or start < end) and (self.only is None or r["region_id"] in self.only):
                found.append(RegionPartition(r["region_id"], start, end, max(r.get("checkpoint_ts", -1), self.after)))
        return found or [RegionPartition(-1, b"\0", b"\0", -1)]  # Spark asks for one at least; this one is empty

    def read(self, partition: RegionPartition) -> Iterator[tuple]:
        if partition.end and partition.start >= partition.end:
            return
        module, _, factory = self.pages.partition(":")
        pages = retried(getattr(importlib.import_module(module), factory)(partition))
        for row in paged_scan(pages, partition.start, partition.end, self.page, int(self.limit) if self.limit else None):
            if not self.versions or row[2] > partition.checkpoint_ts:
                yield partition.region_id, *row


class _Pushing(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        """Narrows the keys, the timestamps and the regions; Spark checks all filters again."""
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if name == ("key",) and isinstance(value, (bytes, bytearray)):
                self._narrow(type(f), bytes(value))
            elif name == ("commit_ts",) and isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                self.after = max(self.after, value - (not isinstance(f, GreaterThan)))
            elif name == ("region_id",) and isinstance(f, (EqualTo, In)):
                ids = {value} if isinstance(f, EqualTo) else set(value)
                self.only = ids if self.only is None else self.only & ids
            yield f

    def _narrow(self, kind: type, key: bytes) -> None:
        """An empty high end is open; behind a key comes the key with a zero byte."""
        low = {EqualTo: key, GreaterThanOrEqual: key, GreaterThan: key + b"\0"}.get(kind)
        high = {EqualTo: key + b"\0", LessThanOrEqual: key + b"\0", LessThan: key}.get(kind)
        if low is not None:
            self.low = max(self.low, low)
        if high is not None:
            self.high = min(filter(None, (self.high, high)), default=b"")
            self.only = set() if not high else self.only  # no key is below the empty one


class FeedPartition(InputPartition):
    def __init__(self, region_id: int, after: int, upto: int) -> None:
        super().__init__(region_id)
        self.region_id, self.after, self.upto = region_id, after, upto


class ChangeFeedSource(DataSource):
    """A change log as a stream, a partition a region, resumed by offsets (a timestamp a region).

    The transport is the user's, named ``module:factory`` in the option ``feed``; ``factory(options)`` makes an object with
    ``regions()``, a map from region to the (timestamp, bytes) of its entries that are ready and have not been admitted (given
    the offsets so far: ``ready(region, after)`` in order), and ``entries(region, after, upto)``, rows of the log's schema
    with a timestamp in that range, which can be read again after a restart. ``start_ts`` says where new
    queries begin, less ``rewind``. A region that comes up later, by a split or a merge, begins at the least timestamp of those that the
    object's ``parents(region)``, if it has this method, says it comes from; those that are gone are no longer asked, but their
    timestamps stay in the offset. ``rate_kb`` is the most that a micro-batch admits over all regions (one timestamp a
    region at least), which holds back both state and memory.
    """

    @classmethod
    def name(cls) -> str:
        return "changefeed"

    def schema(self) -> str:
        return "seq long, region_id long, log_type string, op_type string, key string, start_ts long, commit_ts long, new_value string, old_value string"

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _FeedReader(self.options)


class _FeedReader(DataSourceStreamReader):
    def __init__(self, options) -> None:
        self.options = dict(options)
        module, _, factory = options["feed"].partition(":")
        self.feed = getattr(importlib.import_module(module), factory)(self.options)
        self.start = int(options.get("start_ts", 0)) - int(options.get("rewind", 0))
        self.most = int(options.get("rate_kb", 20_000)) << 10
        self.now: dict[str, int] = {}

    def initialOffset(self) -> dict:  # noqa: N802
        return {str(r): self.start for r in self.feed.regions()}

    def latestOffset(self) -> dict:  # noqa: N802
        """The last offset and, in turn for each region, as many timestamps more as the rate admits."""
        found = self.now or self.initialOffset()
        regions = sorted(self.feed.regions())
        share, upto = self.most // max(len(regions), 1), dict(found)
        for region in regions:
            after, size = self._begin(region, found), 0
            upto[str(region)] = after
            for ts, n in self.feed.ready(region, after):
                if size and size + n > share and ts != upto[str(region)]:
                    break
                upto[str(region)], size = ts, size + n
        self.now = upto
        return upto

    def _begin(self, region: int, found: dict) -> int:
        """Where a region has got to; a new one, the least of where its parents, and theirs, had got to."""
        if str(region) in found:
            return found[str(region)]
        parents = self.feed.parents(region) if hasattr(self.feed, "parents") else []
        return min((self._begin(p, found) for p in parents), default=self.start)

    def partitions(self, start: dict, end: dict) -> list[FeedPartition]:
        self.now = {**self.now, **{r: max(ts, self.now.get(r, ts)) for r, ts in end.items()}}
        found = [(int(r), self._begin(int(r), start), ts) for r, ts in end.items()]
        return [FeedPartition(r, a, b) for r, a, b in sorted(found) if b > a]

    def read(self, partition: FeedPartition) -> Iterator[tuple]:
        yield from self.feed.entries(partition.region_id, partition.after, partition.upto)

    def commit(self, end: dict) -> None:
        pass
