"""Helpers that the training-data operators share: shared tables, Arrow plumbing, span hashes."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these bytes; ``bytes.split()`` cuts at exactly this set.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_UPPER = bytes(range(65, 91))
LOWER_ASCII = bytes.maketrans(_UPPER, _UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; without it only a local master may go on."""
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not path:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.stored_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Delete ``stored`` tables that nothing reads any more: no frame that is still to be run may come from them."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_path)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that extra columns never clash."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, so that helper columns never clash."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def bytes_of(size: str) -> int:
    """A byte size as Spark's settings write it: a number and a unit, if any."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) * _UNITS[unit]


def small_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Hold Arrow batches to ``most`` bytes in this session, so that long texts can't fill a Python worker.

    Frames are run after their operator has returned, so the setting stays; a smaller one of the user's is kept.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = bytes_of(spark.conf.get(name))
    if not 0 < now <= most:
        spark.conf.set(name, most)


#: Of the C library, if it has it: gives back what it holds free.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Give the memory that Arrow and the C library hold free back to the system.

    A Python worker lives on from task to task, and would hold on to the most that any of them took.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_kept: dict[str, Any] = {}


def forget() -> None:
    """Drop what the worker has ``kept``: for operators that keep nothing."""
    _kept.clear()


def kept(name: str, make: Callable[[], Any]) -> Any:
    """The cache that a Python worker keeps from task to task under ``name``, made if there is none.

    There is one at a time: a worker that goes on to another operator drops what it kept for those before.
    """
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``most`` bytes in each (one row at least).

    After each batch, free memory goes back to the system.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes.astype(np.int64)) - sizes) // most
        cuts = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
        del batch
        give_back()


_SEPARATOR = re.compile(rb"[\x20\x09-\x0D]")


def word_parts(raw: bytes, most: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``most`` bytes, so that a very long text is never one list."""
    at = 0
    while len(raw) - at > most:
        cut = _SEPARATOR.search(raw, at + most)
        if cut is None:
            break
        yield raw[at : cut.start()].split()
        at = cut.start()
    yield raw[at:].split()


class WordHashes(dict):
    """64-bit hashes by word, forgotten when there are ``most``."""

    def __init__(self, most: int = 300_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) < 64:
            self[word] = value
        return value

    def of(self, raw: bytes) -> np.ndarray:
        """The hashes of a text's words."""
        parts = [np.fromiter(map(self.__getitem__, words), np.uint64, len(words)) for words in word_parts(raw)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


_MULT = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_MULT), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class SpanHash:
    """64-bit polynomial hashes of any span of a sequence of 64-bit codes, in constant time a span."""

    _powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        if n + 1 > len(SpanHash._powers[0]):
            size = max(n + 1, 1 << 16)
            SpanHash._powers = tuple(
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, m, np.uint64))]) for m in (_MULT, _INVERSE)
            )
        self.up, self.down = SpanHash._powers
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * self.up[:n], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all spans of ``k`` codes."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)
