"""Exact repeats of a fixed length, found without listing every position of the corpus.

A *window* is ``win`` symbols (bytes, or words) of one document in a row: the part of a suffix that matters.
Its *anchor* is the gram of ``k`` symbols inside it with the least hash, the rightmost of equal ones. Equal
windows have equal anchors at equal places, so windows that repeat are among those whose anchor gram
repeats, and all copies of a window meet under their anchor. Neighbouring windows mostly share an anchor:
such a run of windows is an *occurrence*, and the symbols from its first window's start to its last
one's end are its *context*.

1. Anchor grams that occur once are dropped; so is most of a corpus.
2. Occurrences with equal contexts (copies) are folded into one *class*, which counts as often as it occurs.
3. Anchors with several classes are *buckets*. One context of each class is sent to its bucket, where a solver
   (suffix array or suffix tree) compares their windows.
4. A bucket of more than ``MOST`` classes is split before that: its contexts are cut along anchors of longer
   grams, folded again, and so on up to grams of a whole window, of which a bucket has one class alone.

What the solver finds is carried back from classes to their members, level by level. No step gathers a
group whose size grows with the corpus: a bucket has at most ``MOST`` contexts of less than two windows,
a document's list is bounded by its own length, and all else are joins and aggregations.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BYTE_CODES, SpanHash, WordHashes, discard, kept, mix, only, signed, slices, small_batches, stored

#: Classes of a bucket beyond which it is split by longer grams.
MOST = 256
_SEGMENT = 1 << 18
_POSITION = np.uint64((1 << 24) - 1)

#: From the contexts of a block, their weights, documents and first places: the windows of which all members are
#: to go, and those of which all but the first member are.
Solver = Callable[["Contexts", np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def byte_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and the bounds of each text among them."""
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)])
    return np.frombuffer(b"".join(raw), np.uint8), bounds


def byte_codes(symbols: np.ndarray) -> np.ndarray:
    return BYTE_CODES[symbols]


def word_symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and the bounds of each text among them."""
    hashes = kept("word-hashes", WordHashes)
    found = [hashes.of(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in found], dtype=np.int64)])
    return np.concatenate([*found, np.zeros(0, np.uint64)]), bounds


def word_codes(symbols: np.ndarray) -> np.ndarray:
    return symbols


@dataclass(frozen=True)
class Kind:
    """How texts are read: length of a window and a gram, symbols, and their 64-bit codes."""

    win: int
    k: int
    symbols: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]
    codes: Callable[[np.ndarray], np.ndarray]
    dtype: str

    def grams(self) -> list[int]:
        """Lengths of the grams by level, each by three quarters nearer to the whole window than the one before."""
        found = [self.k]
        while found[-1] < self.win:
            found.append(self.win - (self.win - found[-1]) // 4)
        return found


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` keys in a row, in constant time a key."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def occurrences(symbols: np.ndarray, bounds: np.ndarray, kind: Kind, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, first window, last window, anchor hash, context hash) of all occurrences, in pieces."""
    win = kind.win
    for base in range(0, max(len(symbols) - win + 1, 0), _SEGMENT):
        part = symbols[base : base + _SEGMENT + win - 1]
        grams = SpanHash(kind.codes(part)).grams(k)
        n = len(part) - win + 1
        place = np.arange(len(grams), dtype=np.uint64)
        least = window_minima((grams & ~_POSITION) | (_POSITION - place), win - k + 1)
        anchor = (_POSITION - (least & _POSITION)).astype(np.int64)
        whole = np.zeros(n + 1, np.int64)  # windows that lie within one text
        for sign, at in ((1, bounds[:-1]), (-1, np.maximum(bounds[1:] - win + 1, bounds[:-1]))):
            np.add.at(whole, np.clip(at - base, 0, n), sign)
        first = np.flatnonzero(np.cumsum(whole[:-1]) > 0)
        if not len(first):
            continue
        new = np.concatenate([[True], (np.diff(first) > 1) | (np.diff(anchor[first]) != 0)])
        last = first[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(first) - 1]])]
        first = first[new]
        anchor = anchor[first]
        text = np.searchsorted(bounds, first + base, side="right") - 1
        raw, size = part.tobytes(), part.dtype.itemsize
        digest = xxhash.xxh3_64_intdigest
        context = np.fromiter((digest(raw[a:b]) for a, b in zip((first * size).tolist(), ((last + win) * size).tolist(), strict=True)), np.uint64, len(first))
        context ^= mix((anchor - first).astype(np.uint64))
        yield text, first + base - bounds[text], last + base - bounds[text], grams[anchor], context


def _rows(docs: DataFrame) -> DataFrame:
    return only(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("doc_id", "text").alias("r"))


_OCCURRENCE = "a long, c long, doc_id long, r long, first long, last long"


def _occurrence_rows(kind: Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SEGMENT):
            symbols, bounds = kind.symbols(batch.column("text"))
            for text, first, last, a, c in occurrences(symbols, bounds, kind, kind.k):
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a)), pa.array(signed(c)), batch.column("doc_id").take(at), batch.column("r").take(at), pa.array(first), pa.array(last)],
                    ["a", "c", "doc_id", "r", "first", "last"],
                )

    return run


class Contexts:
    """Contexts of a block of buckets side by side: symbols, bounds, and a bucket number for each."""

    def __init__(self, raw: list[bytes], buckets: np.ndarray, kind: Kind) -> None:
        self.symbols = np.frombuffer(b"".join(raw), kind.dtype)
        lengths = np.array([len(x) for x in raw], np.int64) // np.dtype(kind.dtype).itemsize
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.buckets = buckets
        owned = lengths - kind.win + 1
        self.context = np.repeat(np.arange(len(raw)), owned)
        self.offset = np.arange(len(self.context)) - np.repeat(np.cumsum(owned) - owned, owned)
        self.window = self.bounds[self.context] + self.offset


_CONTEXT = "a long, c long, n long, classes long, doc_id long, r long, first long, context binary"


def _shipped(rows: DataFrame, classes: DataFrame, kind: Kind) -> DataFrame:
    """One context of each class, cut from its text."""
    lists = classes.groupBy("r").agg(F.collect_list(F.struct("a", "c", "n", "classes", "first", "last")).alias("list"))
    joined = rows.join(lists, "r").select("doc_id", "text", "r", "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", _SEGMENT):
            symbols, bounds = kind.symbols(batch.column("text"))
            raw, size = symbols.tobytes(), symbols.itemsize
            lists = batch.column("list")
            at = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            items = lists.flatten()
            first, last = items.field("first").to_numpy(), items.field("last").to_numpy()
            start, end = (bounds[at] + first) * size, (bounds[at] + last + kind.win) * size
            for lo in range(0, len(at), 4096):  # a batch of contexts is larger than its texts
                part = slice(lo, lo + 4096)
                context = pa.array([raw[a:b] for a, b in zip(start[part].tolist(), end[part].tolist(), strict=True)], pa.binary())
                own, text = items.slice(lo, 4096), pa.array(at[part])
                yield pa.RecordBatch.from_arrays(
                    [*[own.field(x) for x in ("a", "c", "n", "classes")], batch.column("doc_id").take(text), batch.column("r").take(text), own.field("first"), context],
                    ["a", "c", "n", "classes", "doc_id", "r", "first", "context"],
                )

    return joined.mapInArrow(run, _CONTEXT)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Whole buckets, as many as come to about ``most`` bytes of contexts; the rows come sorted by bucket."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        a = batch.column("a").to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(np.diff(a)) + 1])
        sums = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("context")).to_numpy())])
        begin = 0
        goes_on = bool(held) and held[-1].column("a")[-1].as_py() == a[0]
        for i, s in enumerate(starts.tolist()):
            before = size + int(sums[s] - sums[begin])
            if before >= most and not (i == 0 and goes_on):
                if s > begin:
                    held.append(batch.slice(begin, s - begin))
                yield _joined_batch(held)
                held, size, begin = [], 0, s
        held.append(batch.slice(begin))
        size += int(sums[-1] - sums[begin])
    if held:
        yield _joined_batch(held)


def _joined_batch(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _runs(mark: np.ndarray, contexts: Contexts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first offset, last offset) of the runs of marked windows."""
    at = np.flatnonzero(mark)
    if not len(at):
        return at, at, at
    new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(contexts.context[at]) != 0)])
    start = at[new]
    end = at[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(at) - 1]])]
    return contexts.context[start], contexts.offset[start], contexts.offset[end]


#: Windows lo to hi of a class: all its members lose them, or with ``rest`` all but the first (t_doc, t_first, t_r).
_MARK = "a long, c long, lo long, hi long, rest boolean, t_doc long, t_first long, t_r long"


def _solved(contexts: DataFrame, kind: Kind, solver: Solver, most: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, most):
            a = block.column("a").to_numpy()
            buckets = np.cumsum(np.concatenate([[0], np.diff(a) != 0]))
            side = Contexts(block.column("context").to_pylist(), buckets, kind)
            docs = block.column("doc_id").fill_null(-(1 << 63)).to_numpy()
            first = block.column("first").to_numpy()
            for rest, mark in zip((False, True), solver(side, block.column("n").to_numpy(), docs, first), strict=True):
                which, lo, hi = _runs(mark, side)
                at = pa.array(which)
                take = lambda name: block.column(name).take(at)
                yield pa.RecordBatch.from_arrays(
                    [take("a"), take("c"), pa.array(lo), pa.array(hi), pa.array(np.full(len(which), rest)), take("doc_id"), take("first"), take("r")],
                    ["a", "c", "lo", "hi", "rest", "t_doc", "t_first", "t_r"],
                )

    return contexts.repartition("a").sortWithinPartitions("a").mapInArrow(run, _MARK)


def _cut_longer(contexts: DataFrame, kind: Kind, k: int) -> DataFrame:
    """The contexts of large buckets cut along anchors of ``k`` symbols: members (of classes a, c) of the parent class (pa, pc)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "context", _SEGMENT):
            side = Contexts(batch.column("context").to_pylist(), np.zeros(batch.num_rows, np.int64), kind)
            bucket = batch.column("a").to_numpy().view(np.uint64)
            raw, size = side.symbols.tobytes(), side.symbols.itemsize
            for which, first, last, a, c in occurrences(side.symbols, side.bounds, kind, k):
                at, start = pa.array(which), (side.bounds[which] + first) * size
                part = pa.array([raw[x:y] for x, y in zip(start.tolist(), (start + (last - first + kind.win) * size).tolist(), strict=True)], pa.binary())
                take = lambda name: batch.column(name).take(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(mix(a ^ mix(bucket[which])))), pa.array(signed(c)), take("a"), take("c"), pa.array(first), take("n"), take("doc_id"), take("r"), pa.array(batch.column("first").to_numpy()[which] + first), part],
                    ["a", "c", "pa", "pc", "off", "n", "doc_id", "r", "first", "context"],
                )

    return contexts.mapInArrow(run, "a long, c long, pa long, pc long, off long, n long, doc_id long, r long, first long, context binary")


def _sized(classes: DataFrame) -> DataFrame:
    """Classes with the number of them in their bucket; it is stored first, so that a hot bucket's join can be split."""
    return classes.join(stored(classes.groupBy("a").agg(F.count("*").alias("classes")), "buckets"), "a")


def _marks(contexts: DataFrame, kind: Kind, solver: Solver, most: int, level: int = 0) -> DataFrame:
    """Marks of the classes whose contexts are given with their buckets' numbers of classes."""
    marks = _solved(contexts.where(F.col("classes") <= MOST), kind, solver, most)
    large = contexts.where(F.col("classes") > MOST)
    grams = kind.grams()
    if level + 1 >= len(grams) or large.isEmpty():
        return marks
    members = stored(_cut_longer(large, kind, grams[level + 1]), "members")
    first = F.min(F.struct("doc_id", "first", "r")).alias("top")
    classes = members.groupBy("a", "c").agg(F.sum("n").alias("n"), first, F.any_value("context").alias("context"))
    found = stored(classes.select("a", "c", "n", "top.*", "context"), "classes")
    sizes = found.groupBy("a").agg(F.count("*").alias("classes"), F.sum("n").alias("all")).where("all > 1").drop("all")
    deeper = stored(found.join(sizes, "a").select("a", "c", "n", "classes", "doc_id", "r", "first", "context"), "contexts")
    inner = _marks(deeper, kind, solver, most, level + 1)
    both = members.select("a", "c", "pa", "pc", "off", "doc_id", "r", "first").join(inner, ["a", "c"])
    firsts = F.struct("doc_id", "first", "r").eqNullSafe(F.struct("t_doc", "t_first", "t_r"))
    # Of the first member's parent all but the first member stay marked, of the others' parents all.
    start = F.col("first") - F.col("off")
    carried = both.select(F.col("pa").alias("a"), F.col("pc").alias("c"), (F.col("lo") + F.col("off")).alias("lo"), (F.col("hi") + F.col("off")).alias("hi"), (F.col("rest") & firsts).alias("rest"), F.col("doc_id").alias("t_doc"), start.alias("t_first"), F.col("r").alias("t_r"))
    return marks.unionByName(carried)


def repeats(docs: DataFrame, kind: Kind, solver: Solver, keep_first: bool, most: int = 1 << 18) -> tuple[DataFrame, DataFrame]:
    """Rows of (doc_id, text) with a row key ``r``, and (r, cover): the windows to remove, as runs.

    With ``keep_first`` the first of equal windows by (doc_id, place) is not to be removed. Texts shorter
    than a window have none. Rows that repeat wholly are places of their own, but with ``keep_first`` none is
    before the other.
    """
    small_batches(docs.sparkSession)
    rows = _rows(docs)
    every = stored(rows.mapInArrow(_occurrence_rows(kind), _OCCURRENCE), "occurrences")
    again = stored(every.groupBy("a").count().where("count > 1").select("a"), "anchors")
    found = stored(every.join(again, "a"), "repeated-anchors")
    discard(every, again)
    classes = found.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "first", "r", "last")).alias("top"))
    plain = stored(classes.select("a", "c", "n", "top.*"), "classes")
    classes = stored(_sized(plain), "sized-classes")
    discard(plain)

    # A class alone in its bucket has equal members and nothing to be compared with.
    alone = classes.where("classes = 1 and n > 1").select("a", "c", F.lit(0).cast("long").alias("lo"), (F.col("last") - F.col("first")).alias("hi"), F.lit(keep_first).alias("rest"), F.col("doc_id").alias("t_doc"), F.col("first").alias("t_first"), F.col("r").alias("t_r"))
    contexts = stored(_shipped(rows, classes.where("classes > 1"), kind), "contexts")
    marks = stored(alone.unionByName(_marks(contexts, kind, solver, most)), "marks")
    covers = found.join(marks, ["a", "c"])
    if keep_first:
        covers = covers.where(~(F.col("rest") & F.struct("doc_id", "first", "r").eqNullSafe(F.struct("t_doc", "t_first", "t_r"))))
    covers = covers.select("r", (F.col("first") + F.col("lo")).alias("first"), (F.col("first") + F.col("hi")).alias("last"))
    return rows, covers.groupBy("r").agg(F.collect_list(F.struct("first", "last")).alias("cover"))


def covered(cover: list[dict] | None, win: int) -> list[tuple[int, int]]:
    """Disjoint, ordered spans of symbols under the windows of ``cover``."""
    spans: list[tuple[int, int]] = []
    for first, end in sorted((x["first"], x["last"] + win) for x in cover or ()):
        if spans and first <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((first, end))
    return spans


def without(spans: list[tuple[int, int]], n: int) -> Iterator[tuple[int, int]]:
    """The spans of ``range(n)`` that ``spans`` leave."""
    at = 0
    for a, b in spans:
        if a > at:
            yield at, a
        at = b
    if at < n:
        yield at, n
