"""Removal of word windows that occurred before, by prefix-partitioned suffix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import slices
from millrace.llm.suffix_dedup import refine
from millrace.llm.windows import Contexts, Kind, covered, repeats, without, word_codes, word_symbols


def deep_nodes(contexts: Contexts, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows below the internal nodes of at least ``depth`` words of the block's suffix trees, and their nodes.

    One subtree for each bucket grows from its root, a word a level and all nodes of a level at once. A node
    with one suffix is a leaf and grows no further, so what is left at ``depth`` are the internal nodes.
    """
    alive, node = np.arange(len(contexts.window)), contexts.buckets[contexts.context]
    for level in range(depth):
        keep, node = refine(node, contexts.symbols[contexts.window[alive] + level])
        alive = alive[keep]
        if not len(alive):
            break
    return alive, node


def later_windows(contexts: Contexts, weights: np.ndarray, docs: np.ndarray, first: np.ndarray, win: int) -> tuple[np.ndarray, np.ndarray]:
    """Mark the windows that an earlier one of their deep node equals, and those whose context has later members."""
    mark = np.zeros(len(contexts.window), bool)
    alive, node = deep_nodes(contexts, win)
    if len(alive):
        order = np.lexsort((first[contexts.context[alive]] + contexts.offset[alive], docs[contexts.context[alive]], node))
        later = np.concatenate([[False], np.diff(node[order]) == 0])
        mark[alive[order[later]]] = True
    return mark, weights[contexts.context] > 1


def repeated_word_digests(docs: DataFrame, window: int = 20, gram: int = 4) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: what is left of each text without repeated windows.

    A word goes if a window of ``window`` words that covers it has the words of an earlier window (smaller
    doc_id, or same document and earlier start; null ids come first; rows with equal ids are ordered by
    place and then by a hash, and of rows that repeat wholly none is before the other). Kept words are joined by one
    space. Null texts have no words, texts of fewer words than ``window`` lose none, very long ones are read in
    segments. An empty table gives an empty result; other columns are not looked at.
    """
    kind = Kind(window, gram, word_symbols, word_codes, "u8")
    rows, covers = repeats(docs, kind, lambda contexts, weights, ids, first: later_windows(contexts, weights, ids, first, window), keep_first=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            found = []
            for doc, raw, cover in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), batch.column("cover").to_pylist(), strict=True):
                words = (raw or b"").split()
                spans = covered(cover, window)
                kept = [w for a, b in without(spans, len(words)) for w in words[a:b]] if spans else words
                found.append((doc, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                ["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    joined = rows.join(covers, "r", "left").select("doc_id", "text", "cover")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
