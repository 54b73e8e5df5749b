"""Set-similarity self join of documents on word n-grams, by prefix filtering and prefix-tree verification.

All sets are ordered by one global order of n-grams: rare ones by their hash, then the frequent ones by
frequency. Two sets with a Jaccard similarity of t share an n-gram among the first n - ceil(t n) + 1 of
each, so candidates meet in an inverted list of these prefixes. A candidate pair must share so many prefix
n-grams that what is left could still reach the overlap. Sets of candidates are then stored in a
prefix tree under the set that they are compared with, which is matched against all of them at once.

Groups of near copies are not expanded into pairs. First each document is compared with the leader of
its lists, the least id of about its size, twice with other bounds of size. Lists whose members are in one
component by then are done: links within a component cannot change it. In the rest, pairs across components
are candidates if their sizes, their places in the lists and their sketches (bitmaps of the sets, which bound an overlap
from above) leave room for a link, so the components are those of the full join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import LOWER_ASCII, SpanHash, WordHashes, discard, kept, mix, only, signed, slices, small_batches, stored
from millrace.llm.components import components

#: N-grams that go to the end of the global order: at most so many, the most frequent ones.
MAX_FREQUENT = 100_000
_FREQUENT = np.uint64(1 << 63)
_SLICE = 1 << 19
#: Times at most that documents are compared with leaders before all pairs that still are candidates are.
TURNS = 2
#: N-grams before one in its list that are looked at for an earlier one that a pair shares.
BEFORE = 8
#: Columns of 64 bits in a set's sketch, which bounds overlaps from above.
SKETCH = [f"s{i}" for i in range(16)]


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct 63-bit hashes of the word n-grams of each text.

    A text of fewer words has one, of all its words; a text without words has none.
    """
    hashes = kept("word-hashes", WordHashes)
    found = [hashes.of((t or b"").translate(LOWER_ASCII)) for t in texts.cast(pa.binary()).to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in found], dtype=np.int64)])
    words = np.concatenate([*found, np.zeros(0, np.uint64)])
    spans = SpanHash(words)
    grams = spans.grams(size) >> np.uint64(1)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= size:
            own = np.sort(grams[a : b - size + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        else:
            sets.append((spans.spans(np.array([a]), np.array([b])) ^ np.uint64(b - a)) >> np.uint64(1) if b > a else np.zeros(0, np.uint64))
    return sets


def sketch(own: np.ndarray) -> np.ndarray:
    """The set as a bitmap over its n-grams' hashes, 64 bits in each of ``SKETCH``."""
    bits = np.zeros(64 * len(SKETCH), np.uint8)
    bits[(mix(own + np.uint64(3)) % np.uint64(len(bits))).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _bits(columns: list[Column]) -> Column:
    """How many bits of a sketch are set."""
    counts = [F.bit_count(c) for c in columns]
    return sum(counts[1:], counts[0])


def _common_bits(own: list[Column], other: list[Column]) -> Column:
    return _bits([a.bitwiseAND(b) for a, b in zip(own, other, strict=True)])


def _most_shared(n: Column, own: list[Column], other: list[Column]) -> Column:
    """So many of a set's n n-grams at most are in another: each of its bits that the other lacks stands for one that isn't."""
    return n - (_bits(own) - _common_bits(own, other))


def _signatures(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row a document (its set's size, digest and sketch), and rows (gram, documents) of n-grams that are frequent in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for part in slices(iter([batch]), "text", _SLICE) for s in shingle_sets(part.column("text"), size)]
            n = [len(s) for s in sets]
            one = [int(np.bitwise_xor.reduce(mix(s))) if len(s) else 0 for s in sets]
            two = [int(mix(s + np.uint64(7)).sum()) if len(s) else 0 for s in sets]
            grams, counts = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
            often = counts >= 3
            k = int(often.sum())
            drawn = np.array([sketch(x) for x in sets], np.int64).reshape(-1, len(SKETCH))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column("doc_id"), pa.nulls(k, pa.int64())]),
                    pa.array([*n, *[None] * k], pa.int64()),
                    pa.array(np.concatenate([signed(np.array(one, np.uint64)), signed(grams[often])])),
                    pa.array(np.concatenate([signed(np.array(two, np.uint64)), counts[often]])),
                    *[pa.concat_arrays([pa.array(drawn[:, i]), pa.nulls(k, pa.int64())]) for i in range(len(SKETCH))],
                ],
                ["doc_id", "n", "x", "y", *SKETCH],
            )

    return run


class Order:
    """The global order of n-grams: keys that compare as it does."""

    def __init__(self, frequent: list[tuple[int, int]]) -> None:
        ranked = sorted(frequent, key=lambda f: (f[1], f[0]))
        grams = np.array([g for g, _ in ranked], np.uint64)
        by_gram = np.argsort(grams)
        self.grams, self.ranks = grams[by_gram], by_gram.astype(np.uint64)

    def keys(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.grams):
            return grams
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        return np.sort(np.where(self.grams[at] == grams, self.ranks[at] | _FREQUENT, grams))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _least_shared(n: Column, m: Column, percent: int) -> Column:
    """So many prefix n-grams at least are shared by sets of sizes n and m that link."""
    overlap = F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))
    rest = lambda x: F.ceil(F.lit(percent) * x / 100) - 1
    return F.greatest(F.lit(1), overlap - F.greatest(rest(n), rest(m)))


def trie_join(probe: np.ndarray, sets: list[np.ndarray], percent: int) -> list[int]:
    """Numbers of the ``sets`` (ordered keys) with ``100 |A & B| >= percent |A | B|`` against ``probe``.

    The sets, sorted, are the leaves of a prefix tree whose edges hold the keys that all leaves below
    share. An edge's keys are matched when it is reached, once for all of these, and the overlap is handed down.
    A subtree is left, unmatched, as soon as the overlap so far and what is left of the probe and of the longest of
    its sets cannot reach the least overlap that any of them needs. Long edges are matched in parts, with
    the same test after each.
    """
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    rows = [sets[i] for i in order]
    common = [_common(a, b) for a, b in zip(rows, rows[1:], strict=False)]
    need = [-(-percent * (len(probe) + len(r)) // (100 + percent)) for r in rows]
    found, stack = [], [(0, len(rows), 0, 0)]
    while stack:
        low, high, depth, overlap = stack.pop()
        # The keys that all of low..high share beyond depth: one edge.
        end = min(common[low : high - 1], default=len(rows[low]))
        longest, least = max(len(r) for r in rows[low:high]), min(need[low:high])
        dead = False
        while depth < end and not dead:
            step = rows[low][depth : min(end, depth + 64)]
            overlap += int(np.count_nonzero(_in(step, probe)))
            depth += len(step)
            beyond = len(probe) - int(np.searchsorted(probe, step[-1], side="right"))
            dead = overlap + min(longest - depth, beyond) < least
        if dead:
            continue
        if high - low == 1:
            if overlap >= need[low]:
                found.append(order[low])
            continue
        start = low
        for i in range(low, high - 1):
            if common[i] == end:
                stack.append((start, i + 1, end, overlap))
                start = i + 1
        if start > low or len(rows[low]) > end:
            stack.append((start, high, end, overlap))
        else:  # equal sets
            found += [order[i] for i in range(low, high) if overlap >= need[i]]
    return found


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def _in(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return b[at] == a


class NgramJoin:
    """One join over ``docs`` (doc_id, text); keeps what its steps share."""

    def __init__(self, docs: DataFrame, size: int = 5, percent: int = 80) -> None:
        self.docs, self.size, self.percent = only(docs, "doc_id", "text").where("doc_id is not null"), size, percent
        small_batches(docs.sparkSession)
        rows = stored(self.docs.mapInArrow(_signatures(size), ", ".join(f"{c} long" for c in ("doc_id", "n", "x", "y", *SKETCH))), "signatures")
        self.signatures = rows.where("n is not null").select("doc_id", "n", F.col("x").alias("d1"), F.col("y").alias("d2"), *SKETCH)
        counts = rows.where("n is null").groupBy("x").agg(F.sum("y").alias("count")).where("count >= 20")
        top = counts.orderBy(F.desc("count"), "x").limit(MAX_FREQUENT).collect()  # at most MAX_FREQUENT numbers
        self.order = self.docs.sparkSession.sparkContext.broadcast(Order([(r[0], r[1]) for r in top]))
        #: One row a different set: its least doc_id stands for it.
        self.classes = stored(self.signatures.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), *[F.any_value(x).alias(x) for x in SKETCH]).withColumn("bits", _bits([F.col(x) for x in SKETCH])), "set-classes")

    def _prefixes(self) -> DataFrame:
        size, percent, order = self.size, self.percent, self.order

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rank = order.value
            for batch in slices(batches, "text", _SLICE):
                sets = [rank.keys(s) for s in shingle_sets(batch.column("text"), size)]
                parts = [s[: prefix_length(len(s), percent)] if len(s) else s for s in sets]
                at = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                sizes = np.array([len(s) for s in sets], np.int32)[at]
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(parts))), batch.column("doc_id").take(pa.array(at)), pa.array(sizes)], ["gram", "rep", "n"])

        return self.docs.mapInArrow(run, "gram long, rep long, n int")

    def _lists(self) -> DataFrame:
        """Inverted lists of the prefixes: (gram, rep, n), of n-grams in two documents or more."""
        short = F.col("gram").bitwiseAND(0x7FFFFFFF).cast("int")  # to count by; that some single n-grams stay does no harm
        prefixes = stored(self._prefixes(), "prefixes")  # read twice, so that texts are cut once
        live = prefixes.groupBy(short.alias("short")).count().where("count > 1").select("short")
        found = stored(prefixes.join(live, short == F.col("short")).select("gram", "rep", "n"), "prefix-lists")
        discard(prefixes)
        return found

    def _verified(self, pairs: DataFrame, chunk: int = 256) -> DataFrame:
        """Those pairs (u, v) that link. The texts beside each ``u`` go to prefix trees of about ``chunk`` sets."""
        percent, size, order = self.percent, self.size, self.order
        pairs = stored(pairs, "candidates")
        cut = pairs.groupBy("u").agg(F.ceil(F.count("*") / chunk).cast("int").alias("cut"))
        part = F.pmod(F.xxhash64("v"), F.col("cut")).cast("int").alias("part")
        leaves = pairs.join(cut, "u").select("u", part, F.lit(1).alias("side"), F.col("v").alias("doc_id"))
        roots = cut.select("u", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("part"), F.lit(0).alias("side"), F.col("u").alias("doc_id"))
        # The texts are shuffled at any size, so that the plan of small inputs is that of large ones.
        placed = self.docs.join(stored(roots.unionByName(leaves), "tree-places").hint("shuffle_merge"), "doc_id")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rank, group, key = order.value, [], None
            for whole in batches:
                for batch in slices(iter([whole]), "text", _SLICE):
                    found: list[tuple[int, int]] = []
                    sets = [rank.keys(s) for s in shingle_sets(batch.column("text"), size)]
                    for u, p, doc, own in zip(*[batch.column(c).to_pylist() for c in ("u", "part", "doc_id")], sets, strict=True):
                        if (u, p) != key:
                            found += _links(group, percent)
                            group, key = [], (u, p)
                        group.append((doc, own))
                    yield _pairs(found)
            yield _pairs(_links(group, percent))

        trees = placed.repartition("u", "part").sortWithinPartitions("u", "part", "side")
        return stored(trees.mapInArrow(run, "u long, v long"), "links")

    def _led(self, lists: DataFrame, turn: int) -> DataFrame:
        """(u, v): each document with one leader of another component that it may link with, among those of its lists and band of sizes.

        A list's leader is its least id in turn 0; later it has two, the least and the greatest by a hash, so that each turn has others.
        """
        step = 2 * math.log(100 / self.percent)
        rank = F.col("rep") if turn == 0 else F.xxhash64("rep", F.lit(turn))
        part = F.col("c") if "c" in lists.columns else F.col("rep")
        banded = lists.select("gram", "rep", "n", part.alias("c"), F.floor(F.log("n") / step + turn / 2).cast("int").alias("band"), rank.alias("rank"))
        ends = [f(F.struct("rank", "rep", "n", "c")) for f in ((F.min,) if turn == 0 else (F.min, F.max))]
        lead = banded.groupBy("gram", "band").agg(F.array(*ends).alias("leads"), F.count("*").alias("size")).where("size > 1")
        lead = lead.select("gram", "band", F.explode("leads").alias("lead"))
        lead = lead.select("gram", "band", F.col("lead.rep").alias("u"), F.col("lead.n").alias("m"), F.col("lead.c").alias("of"))
        beside = banded.join(lead, ["gram", "band"]).where("of <> c")
        shared = beside.groupBy("u", F.col("rep").alias("v"), "m", "n").count()
        # A leader need not lead all lists that it shares, so half the least number will do here.
        likely = shared.where(F.col("count") * 2 >= _least_shared(F.col("n"), F.col("m"), self.percent))
        pairs = likely.groupBy("v").agg(F.max_by("u", F.struct("count", "u")).alias("u"))
        for side in ("u", "v"):  # representatives alone have sketches, so rows with equal sets go here
            pairs = pairs.join(self.classes.select(F.col("rep").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "bits", *SKETCH)]), side)
        return pairs.where(self._able("u", "v")).select("u", "v")

    def _able(self, one: str, two: str) -> Column:
        """Whether the sketches of two sets leave room for the overlap that a link needs: ``_most_shared`` of either set reaches it.

        Bits in common are counted once for both sets, so that a join's condition has 16 terms and not 32.
        """
        a, b = F.col(f"n_{one}"), F.col(f"n_{two}")
        common = _common_bits(*[[F.col(f"{c}_{x}") for c in SKETCH] for x in (one, two)])
        overlap = F.ceil(F.lit(self.percent) * (a + b) / F.lit(100 + self.percent))
        return common >= overlap + F.greatest(F.col(f"bits_{one}") - a, F.col(f"bits_{two}") - b)

    def _rest(self, lists: DataFrame, groups: DataFrame, name: str) -> DataFrame:
        """Lists with members of several components: (gram, rep, n, c), one document a different set."""
        placed = lists.select("gram", "rep", "n").join(self.classes.select("rep"), "rep", "left_semi").join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        placed = stored(placed.select("gram", "rep", "n", F.coalesce("component", "rep").alias("c")), f"{name}-placed")
        across = placed.groupBy("gram").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high").select("gram")
        return stored(placed.join(across, "gram"), name)

    def members(self) -> DataFrame:
        """(rep, component) of every different set."""
        rest, links = self._lists(), None
        for turn in range(TURNS):
            found = self._verified(self._led(rest, turn))
            if turn and found.isEmpty():
                break
            links = found if links is None else links.unionByName(found)
            rest = self._rest(rest, components(links), f"lists-{turn}")

        # The first n-gram that two sets share stands early in both lists, as so many must follow it.
        own = Window.partitionBy("rep")
        ordered = own.orderBy(F.col("gram") < 0, "gram")
        before = F.collect_list("gram").over(ordered.rowsBetween(-BEFORE, -1))
        rest = rest.withColumns({"k": F.row_number().over(ordered), "all": F.count("*").over(own), "before": before})
        rest = stored(rest.join(self.classes.select("rep", "bits", *SKETCH), "rep"), "sketched-lists")
        one, two = (rest.select("gram", *[F.col(c).alias(f"{c}_{i}") for c in ("rep", "n", "c", "k", "all", "before", "bits", *SKETCH)]) for i in (1, 2))
        n1, n2 = F.col("n_1"), F.col("n_2")
        near = (n1 * 100 >= n2 * self.percent) & (n2 * 100 >= n1 * self.percent)
        least = _least_shared(n1, n2, self.percent)
        early = (F.col("k_1") <= F.col("all_1") - least + 1) & (F.col("k_2") <= F.col("all_2") - least + 1)
        # A pair comes from the first n-gram that it shares, and again only where none of the few before is shared. The sketches, which are
        # numbers, are asked before the arrays.
        first = ~F.arrays_overlap("before_1", "before_2")
        pairs = one.join(two, "gram").where((F.col("rep_1") < F.col("rep_2")) & (F.col("c_1") != F.col("c_2")) & near & early & self._able("1", "2") & first)
        pairs = pairs.select(*[F.col(f"{c}_{i}").alias(f"{c}{i}") for c in ("rep", "n") for i in (1, 2)])
        least = _least_shared(F.col("n1"), F.col("n2"), self.percent)
        pairs = pairs.distinct()
        grams = stored(rest.groupBy("rep").agg(F.collect_set("gram").alias("grams")), "prefix-sets")
        for i in (1, 2):
            pairs = pairs.join(grams.withColumnsRenamed({"rep": f"rep{i}", "grams": f"g{i}"}), f"rep{i}")
        pairs = pairs.where(F.size(F.array_intersect("g1", "g2")) >= least)
        links = links.unionByName(self._verified(pairs.select(F.col("rep1").alias("u"), F.col("rep2").alias("v"))))
        groups = components(links).withColumnRenamed("node", "rep")
        return self.classes.select("rep").join(groups, "rep", "left").select("rep", F.coalesce("component", "rep").alias("component"))

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id of each row."""
        named = self.classes.join(self.members(), "rep").select("d1", "d2", "n", "component")
        own = self.signatures.join(named, ["d1", "d2", "n"], "left")
        return own.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _links(group: list[tuple[int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    if len(group) < 2:
        return []
    return [(group[0][0], group[i + 1][0]) for i in trie_join(group[0][1], [own for _, own in group[1:]], percent)]


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.int64()), pa.array([v for _, v in found], pa.int64())], ["u", "v"])


def near_copies(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id: the components of all links between documents.

    Documents link if their sets of word n-grams have a Jaccard similarity of ``percent`` / 100 or more.
    Null texts and texts without words have empty sets and link with nothing; rows with a null
    doc_id are left out; rows with equal ids are one node. An empty table gives an empty result.
    """
    return NgramJoin(docs, size, percent).result()


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, without those that have a smaller doc_id in their component."""
    found = near_copies(docs, size, percent).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)
