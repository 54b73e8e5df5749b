"""Spelling variants: words that differ by one code point, grouped by hashes of their deletions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import SpanHash, discard, mix, only, partitions, signed, slices, small_batches, stored

LETTERS = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Longer words send hashes first and their letters only where hashes meet, so that a word of a million letters
#: is never sent a million times.
LONG = 256

WHOLE = -1
_KEYS = T.StructType().add("key", "long").add("place", "integer").add("n", "long").add("name", "string")
_NEAR = T.StructType().add("word", "string").add("links", "long").add("best_n", "long").add("best", "string")


def _thinned(doc_id: Column, low: Column, every: int) -> Column:
    """``low`` without one code point where the crc32 of ``doc_id:low`` is a multiple of ``every``."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), low).cast("binary"))
    at = (h % F.length(low)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(low, F.lit(1), at), F.substring(low, at + 2, F.length(low)))).otherwise(low)


def words(docs: DataFrame, least: int = 7, times: int = 2, every: int = 31) -> DataFrame:
    """(word, n) of the runs of letters with ``least`` code points and ``times`` occurrences at least.

    Only A-Z are lower-cased. One occurrence in about ``every`` loses a code point, chosen by document and run, which plants
    variants of known words. A null text has no run, a null doc_id is written as nothing. Repeated rows count again.
    Frequent words are counted before they are shuffled.
    """
    # Shorter runs can't become words, so the pattern passes over them.
    runs = only(docs, "doc_id", "text").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least},}}+"), F.lit(0))).alias("run"))
    low = runs.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("low"))
    found = low.select(_thinned(F.col("doc_id"), F.col("low"), every).alias("word")).where(F.length("word") >= least)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= times)


class _WordHash(SpanHash):
    """Polynomial hashes of words that lie one behind the other, and of words without one code point."""

    def whole(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def without(self, start: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The prefix before ``at`` and the suffix behind it, which moves down by one place."""
        return (self.sums[at] - self.sums[start]) * self.down[start] + (self.sums[end] - self.sums[at + 1]) * self.down[start + 1]


def _hashed(batches: Iterator[pa.RecordBatch], step: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """The keys of each word: itself, each different deletion, and each place whose code point is left open."""
    for batch in batches:
        for part in slices(iter([batch]), "word", 1 << 18):
            text, sizes = part.column("word"), pc.utf8_length(part.column("word")).to_numpy()
            codes = np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
            hashes = _WordHash(mix(codes + np.uint64(1)))
            ends = np.cumsum(sizes)
            starts = ends - sizes
            yield _rows(part, np.arange(len(sizes)), mix(hashes.whole(starts, ends)), np.full(len(sizes), WHOLE))
            for at in range(0, len(codes), step):
                i = np.arange(at, min(at + step, len(codes)))
                word = np.searchsorted(ends, i, side="right")
                start, place = starts[word], i - starts[word]
                left = hashes.without(start, i, ends[word])
                # Of equal code points in a row only the first is deleted: the others give the same.
                first = (place == 0) | (codes[i] != codes[i - 1])
                yield _rows(part, word[first], mix(left[first]), -2 - place[first])
                yield _rows(part, word, mix(left ^ mix(place.astype(np.uint64) + np.uint64(1 << 40))), place)


def _rows(part: pa.RecordBatch, word: np.ndarray, key: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    owner = pa.array(word)
    return pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(place.astype(np.int32)), part.column("n").take(owner), part.column("name").take(owner)], _KEYS.names)


def _keyed(vocabulary: DataFrame, name: Column) -> DataFrame:
    return vocabulary.select("word", "n", name.alias("name")).mapInArrow(_hashed, _KEYS)


def deletion_keys(vocabulary: DataFrame) -> DataFrame:
    """(key, place, n, name): the hashes under which near words meet, with the word as ``name``.

    Words of up to LONG code points carry themselves. Longer ones carry a digest at first; the keys that two of them (or one of
    length LONG) share, as many as there are links, get their letters by a join.
    """
    length = F.length("word")
    short = _keyed(vocabulary.where(length <= LONG), F.col("word"))
    digest = F.sha2(F.col("word").cast("binary"), 256)
    hashed = _keyed(vocabulary.where(length >= LONG), digest)
    shared = hashed.groupBy("key").agg(F.count("*").alias("k")).where("k > 1").select("key")
    letters = vocabulary.where(length > LONG).select(digest.alias("name"), "word")
    long = hashed.join(shared, "key", "left_semi").join(letters, "name").select("key", "place", "n", F.col("word").alias("name"))
    return short.unionByName(long)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal keys; the rows come by key, then falling n, then word."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        key = batch.column("key").to_numpy()
        last = len(key) - int(np.argmax(key[::-1] != key[-1])) if key[0] != key[-1] else 0
        yield from _links(batch.slice(0, last))
        rest = batch.slice(last)
    if rest is not None:
        yield from _links(rest)


def _links(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    key = batch.column("key").to_numpy()
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[1:] == key[:-1]
    rows = np.flatnonzero(same[:-1] | same[1:])
    if not len(rows):
        return
    met = batch.take(pa.array(rows))
    key, place, n = (met.column(c).to_numpy() for c in ("key", "place", "n"))
    names = np.array(met.column("name").to_pylist(), object)
    # The hashes have only brought them together: what is left of the letters decides.
    rest = [w if p == WHOLE else w[: -2 - p] + w[-1 - p :] if p < WHOLE else f"{w[:p]}\0{w[p + 1 :]}" for w, p in zip(names, place.tolist(), strict=True)]
    new = np.ones(len(rest), bool)
    new[1:] = key[1:] != key[:-1]
    differs = np.fromiter((a != b for a, b in zip(rest, rest[1:], strict=False)), bool, len(rest) - 1)
    if (differs & ~new[1:]).any():  # different texts of one hash: sorted, and so apart
        order = np.array(sorted(range(len(rest)), key=lambda i, run=np.cumsum(new): (run[i], rest[i])))
        rest = [rest[i] for i in order]
        place, n, names, key = place[order], n[order], names[order], key[order]
        new[1:] = (key[1:] != key[:-1]) | np.fromiter((a != b for a, b in zip(rest, rest[1:], strict=False)), bool, len(rest) - 1)
    group = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    sizes = np.diff([*starts, len(rest)])
    # The root of a group of deletions is the word that is whole; without one they aren't near each other.
    root = np.full(len(starts), -1)
    root[group[place == WHOLE]] = np.flatnonzero(place == WHOLE)
    open_ = place >= 0
    at = np.arange(len(rest))
    first = np.where(starts[group] == at, np.minimum(starts[group] + 1, len(rest) - 1), starts[group])
    whole = root[group]
    best = np.where(open_, first, np.where(place == WHOLE, first, whole))
    links = np.where(open_ | (place == WHOLE), sizes[group] - 1, 1)
    keep = (sizes[group] > 1) & (open_ | (whole >= 0))
    best, keep = best[keep], np.flatnonzero(keep)
    yield pa.RecordBatch.from_arrays([pa.array(names[keep], pa.string()), pa.array(links[keep].astype(np.int64)), pa.array(n[best]), pa.array(names[best], pa.string())], _NEAR.names)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): how many words are one code point away, and the most frequent (ties: smallest) of them.

    Keys are cut into one range of their high bits a partition and sorted there, with the letters. Those that share a deletion
    at one place, or of which one is the other's deletion, are links; each word takes their number and their first from
    its groups, so no pair is written. A group holds no more than the alphabet times a word's length.
    """
    spark = vocabulary.sparkSession
    n = partitions(spark)
    high = F.shiftrightunsigned("key", 33)
    dealt = deletion_keys(vocabulary).repartitionById(n, F.shiftright(high * n, 31).cast("int"))
    met = dealt.sortWithinPartitions("key", F.desc("n"), "name").mapInArrow(_met, _NEAR)
    least = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best")))
    return met.groupBy("word").agg(F.sum("links").alias("n_near"), least.alias("b")).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word with a form: the last one its forms lead to, by pointer doubling."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        after = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(after, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        step = stored(step, "spelling-roots")
        moved = step.agg(F.max("moved")).first()[0]
        discard(now)
        now = step.drop("moved")
        now.stored_path = step.stored_path
        if not moved:
            return now


def variants(docs: DataFrame, least: int = 7, times: int = 2, every: int = 31, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text).

    A word's form is its most frequent near word (ties: the smallest in code-point order) if that occurs ``ratio`` times as often or
    more; its root is the end of its forms, or the word itself. Occurrences grow along the forms, so they end after the
    logarithm of the largest count. Empty tables give none; extra columns are passed over; long texts are split where they lie.
    """
    small_batches(docs.sparkSession)
    vocabulary = stored(words(docs, least, times, every), "spelling-words")
    near = near_words(vocabulary)
    known = F.coalesce(F.col("best_n") >= ratio * F.col("n"), F.lit(False))
    found = vocabulary.join(near, "word", "left").select(
        "word", F.when(known, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(known, F.col("best_n")).alias("form_n")
    )
    found = stored(found, "spelling-near")
    discard(vocabulary)
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
