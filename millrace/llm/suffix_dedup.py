"""Removal of byte strings that occur more than once, by blockwise suffix sorting with a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import slices, unused
from millrace.llm.windows import Contexts, Kind, byte_codes, byte_symbols, covered, repeats, without

#: A difference cover: each difference modulo PERIOD is one of two members, so any two suffixes reach
#: sampled positions after the same number of bytes, fewer than PERIOD.
PERIOD, COVER = 7, (1, 2, 4)
_STEP = [[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)]


def refine(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Split ordered groups by a key; returns the members of groups of two or more, and their new groups."""
    order = np.lexsort((key, group))
    g, k = group[order], key[order]
    new = np.concatenate([[True], (np.diff(g) != 0) | (k[1:] != k[:-1])])
    number = np.cumsum(new) - 1
    tied = np.bincount(number)[number] > 1
    return order[tied], number[tied]


def cover_ranks(words: np.ndarray, length: int) -> np.ndarray:
    """Rank of each sampled position among all by its next ``length`` bytes (a multiple of PERIOD); 0 elsewhere.

    ``words`` has the next eight bytes of each position. Sampled positions stay sampled after PERIOD bytes,
    so ranks double in length within the sample alone. Two arrays are held at a time.
    """
    n = len(words)
    at = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
    rank = np.zeros(n + length, np.uint64)
    rank[at] = np.unique(words[at] >> np.uint64(8), return_inverse=True)[1] + 1
    done = PERIOD
    while 2 * done <= length:
        rank = _joined(rank, rank, done, at, n + length)
        done *= 2
    # The last ``done`` of the ``length`` bytes overlap the first ones: both together are all of them.
    return rank if done == length else _joined(rank, rank, length - done, at, n + length)


def _joined(head: np.ndarray, tail: np.ndarray, shift: int, at: np.ndarray, size: int) -> np.ndarray:
    both = (head[at] << np.uint64(32)) | tail[at + shift]
    rank = np.zeros(size, np.uint64)
    rank[at] = np.unique(both, return_inverse=True)[1] + 1
    return rank


def suffix_ties(contexts: Contexts, weights: np.ndarray, win: int) -> np.ndarray:
    """Mark the windows of a block whose suffix shares ``win`` bytes with another of its bucket.

    A context of weight over one is there more than once itself. One bucket after the other has its suffixes
    sorted, by their first 32 bytes. Those still tied are told apart by the cover: two suffixes agree on ``win`` bytes if they
    agree on their first and last bytes and the sampled positions that both reach after the same step have the
    same rank.
    """
    mark = weights[contexts.context] > 1
    padded = np.concatenate([contexts.symbols, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(contexts.symbols), np.uint64)
    for j in range(8):
        words = (words << np.uint64(8)) | padded[j : j + len(words)]
    tied, group = np.arange(len(contexts.window)), contexts.buckets[contexts.context]
    for depth in (0, 8, 16, 24, win - 16, win - 8):
        keep, group = refine(group, words[contexts.window[tied] + depth])
        tied = tied[keep]
        if not len(tied):
            return mark
    ranks = cover_ranks(words, (win - PERIOD + 1) // PERIOD * PERIOD)
    at, group = contexts.window[tied], group.astype(np.uint64) << np.uint64(32)
    classes = [np.flatnonzero(at % PERIOD == a) for a in range(PERIOD)]
    for a in range(PERIOD):
        for b in range(a, PERIOD):
            one, two = classes[a], classes[b]
            if not len(one) or not len(two):
                continue
            x = group[one] | ranks[at[one] + _STEP[a][b]]
            if a == b:
                _, inverse, n = np.unique(x, return_inverse=True, return_counts=True)
                mark[tied[one[n[inverse] > 1]]] = True
            else:
                y = group[two] | ranks[at[two] + _STEP[a][b]]
                mark[tied[one[np.isin(x, y)]]] = True
                mark[tied[two[np.isin(y, x)]]] = True
    return mark


def _kind(length: int) -> Kind:
    return Kind(length, min(48, length // 2), byte_symbols, byte_codes, "u1")


def _covers(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    if length < 64:
        raise ValueError("repeats must be of 64 bytes at least")

    def solver(contexts: Contexts, weights: np.ndarray, docs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return suffix_ties(contexts, weights, length), np.zeros(len(contexts.window), bool)

    return repeats(docs, _kind(length), solver, keep_first=False)


def repeated_byte_digests(docs: DataFrame, length: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: what is left of each text without repeats.

    A byte goes if a string of ``length`` bytes that covers it starts at any other place of the corpus,
    the same text or a repeated row included. Null texts count as empty and texts of fewer bytes lose nothing;
    very long texts are read in segments. Ids may be null, equal or of any size: rows are told apart by id and text. An
    empty table gives an empty result; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            rows = []
            for doc, raw, cover in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("cover").to_pylist(), strict=True):
                raw = raw or b""
                spans = covered(cover, length)
                kept = b"".join(raw[a:b] for a, b in without(spans, len(raw)))
                rows.append((doc, len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    rows, covers = _covers(docs, length)
    joined = rows.join(covers, "r", "left").select("doc_id", "text", "cover")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``docs``, all columns whatever their names, with the repeated bytes cut from ``text``; a null text stays null.

    A character of which a cut took some bytes goes as a whole. Rows that repeat wholly lose everything but
    what is shorter than ``length``, as each is a place of its own. An empty table gives an empty result.
    """
    _, covers = _covers(docs, length)
    names, key, cover = docs.columns, unused(docs, "_r"), unused(docs, "_cover")
    joined = docs.withColumn(key, F.xxhash64("doc_id", "text")).join(covers.withColumnsRenamed({"r": key, "cover": cover}), key, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            texts = []
            for raw, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column(cover).to_pylist(), strict=True):
                spans = covered(spans, length)
                texts.append(raw if not spans else b"".join(raw[a:b].decode("utf-8", "ignore").encode() for a, b in without(spans, len(raw))))
            rest = batch.select(names)
            yield rest.set_column(names.index("text"), "text", pa.array(texts, pa.binary()).cast(batch.column("text").type))

    return joined.select(*[F.col(f"`{c}`") for c in names], cover).mapInArrow(run, docs.schema)
