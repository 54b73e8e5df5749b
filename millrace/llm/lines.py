"""Line deduplication over levelled sorted runs of line hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_ASCII, only, slices, small_batches, stored, unused

STRIPPED = b" \t\n\x0b\x0c\r"
RUN_SCHEMA = "h1 long, h2 long, n_docs long, top_doc long"


def _keys(raw: bytes) -> list[bytes]:
    """The key of each line of a UTF-8 text; bytes below 128 are never part of another code point."""
    return [x.strip(STRIPPED) for x in raw.translate(LOWER_ASCII).split(b"\n")]


def _is_long(key: bytes, least: int) -> bool:
    """Whether a key has ``least`` code points, which are counted only if its bytes can't tell."""
    return len(key) >= least and (len(key) >= 4 * least or key.isascii() or len(key.decode()) >= least)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc_id) of each different line key of at least ``min_chars`` code points of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            raw, ids, sizes = [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), _texts(batch), strict=True):
                keys = {k for k in _keys(text or b"") if _is_long(k, min_chars)}
                raw += [hashlib.blake2b(k, digest_size=16).digest() for k in keys]
                ids.append(doc)
                sizes.append(len(keys))
            h = np.frombuffer(b"".join(raw), np.int64).reshape(-1, 2)
            at = pa.array(np.repeat(np.arange(len(ids)), sizes))
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), batch.column("doc_id").take(at)], ["h1", "h2", "doc_id"])

    small_batches(docs.sparkSession)
    return only(docs, "doc_id", "text").where("doc_id is not null").mapInArrow(run, "h1 long, h2 long, doc_id long")


class LineRuns:
    """An index of line hashes as a log-structured merge tree of sorted tables in the shared folder.

    Each run has a row a hash, sorted by hash: the number of documents that hold it, and the largest of
    their ids if no earlier batch had the hash (else null). ``add`` anti-joins a batch against all runs
    to learn which of its hashes are new, and writes the batch as a run of level 0; once a level has
    ``fanout`` runs they are merged into one of the next level. So a hash belongs to the first batch
    that brought it. All state is in the written runs: a lost executor costs the tasks it ran, no more.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3) -> None:
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def merged(self) -> DataFrame:
        """One row a hash over all runs."""
        runs = self.runs()
        return _merge(runs) if runs else self.spark.createDataFrame([], RUN_SCHEMA)

    def add(self, hashes: DataFrame) -> DataFrame:
        """Add a batch of (h1, h2, doc_id); returns its run, whose new hashes have a ``top_doc``."""
        run = hashes.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("top_doc"))
        for known in self.runs():
            known = known.where("top_doc is not null").select("h1", "h2", F.lit(True).alias("known"))
            run = run.join(known, ["h1", "h2"], "left").select("h1", "h2", "n_docs", F.when(F.col("known").isNull(), F.col("top_doc")).alias("top_doc"))
        run = stored(run.sortWithinPartitions("h1", "h2"), "run0")
        self._put(0, run)
        return run

    def fresh(self, hashes: DataFrame) -> DataFrame:
        """The rows of a batch whose hash no run holds; nothing is added."""
        for known in self.runs():
            hashes = hashes.join(known.select("h1", "h2"), ["h1", "h2"], "left_anti")
        return hashes

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = stored(_merge(self.levels[level]).sortWithinPartitions("h1", "h2"), f"run{level + 1}")
            self.levels[level] = []
            self._put(level + 1, merged)


def _merge(runs: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, runs).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("top_doc").alias("top_doc"))


def lines_to_drop(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 3) -> DataFrame:
    """(doc_id, drops): for each document that loses lines, the 16-byte hashes of their keys.

    The documents come in ``batches`` by descending doc_id, so a key's first batch has the largest
    doc_id that holds it. Each row counts as a document of its own, also if rows repeat.
    """
    spark = docs.sparkSession
    docs = only(docs, "doc_id", "text")
    shares = [i / batches for i in range(batches - 1, 0, -1)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else []
    bounds = sorted(set(bounds or []), reverse=True)
    index = LineRuns(spark)
    for high, low in zip([None, *bounds], [*bounds, None], strict=True):
        part = docs
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        index.add(line_hashes(part, min_chars))
    common = stored(index.merged().where(F.col("n_docs") >= min_docs).select("h1", "h2", "top_doc"), "common")
    held = line_hashes(docs, min_chars).join(common, ["h1", "h2"]).where("doc_id < top_doc")
    return held.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("drops"))


def _without(docs: DataFrame, drops: DataFrame, min_chars: int, names: list[str], finish, schema) -> DataFrame:
    """Run ``finish(batch, [(n_lines, n_dropped, what is kept, in UTF-8)])`` over ``docs`` joined with what they lose."""
    small_batches(docs.sparkSession)
    of, gone_at = unused(docs, "_of"), unused(docs, "_drops")
    joined = docs.join(drops.withColumnsRenamed({"doc_id": of, "drops": gone_at}), F.col("doc_id") == F.col(of), "left")

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(found, "text", 4 << 20):
            kept = []
            for text, gone in zip(_texts(batch), batch.column(gone_at).to_pylist(), strict=True):
                text = text or b""
                n = text.count(b"\n") + 1
                if not gone:
                    kept.append((n, 0, text))
                    continue
                drop = {np.array([g["h1"], g["h2"]], np.int64).tobytes() for g in gone}
                stay = [x for x, k in zip(text.split(b"\n"), _keys(text), strict=True) if not _is_long(k, min_chars) or hashlib.blake2b(k, digest_size=16).digest() not in drop]
                kept.append((n, n - len(stay), b"\n".join(stay)))
            yield finish(batch.select(names), kept)

    return joined.select(*[F.col(f"`{n}`") for n in dict.fromkeys([*names, "text", gone_at])]).mapInArrow(run, schema)


def line_digests(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 3) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of each row after line deduplication.

    Null and empty texts have one empty line and lose nothing; rows with a null doc_id count nowhere
    and lose nothing; an empty table gives an empty result.
    """
    docs = only(docs, "doc_id", "text")

    def finish(batch: pa.RecordBatch, kept: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([n for n, _, _ in kept], pa.int64()),
                pa.array([d for _, d, _ in kept], pa.int64()),
                pa.array([hashlib.sha256(k).hexdigest() for _, _, k in kept], pa.string()),
            ],
            ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
        )

    return _without(docs, lines_to_drop(docs, min_chars, min_docs, batches), min_chars, ["doc_id"], finish, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, batches: int = 3) -> DataFrame:
    """``docs``, all columns, with texts that lost their common lines. A null text stays null."""
    names = docs.columns

    def finish(batch: pa.RecordBatch, kept: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        old = batch.column("text").is_null().to_pylist()
        texts = [None if null else k for null, (_, _, k) in zip(old, kept, strict=True)]
        return batch.set_column(names.index("text"), "text", pa.array(texts, pa.binary()).cast(batch.column("text").type))

    return _without(docs, lines_to_drop(docs, min_chars, min_docs, batches), min_chars, names, finish, docs.schema)
