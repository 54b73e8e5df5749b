"""Best-fit packing of token pieces into fixed-length sequences, after a dominance reduction.

Pieces are whole numbers of tokens from 1 to ``capacity``, so any corpus is a histogram of at most
``capacity`` counts. The reduction and the best fit run on that histogram with multiplicities: what
they return is a *plan* of at most a few thousand patterns, however many documents there are. Spark
then numbers the pieces of each length in parallel and each piece finds its slot by its number.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import kept, only, partitions, slices, stored

CAPACITY = 2048
Pattern = tuple[tuple[int, ...], int]  # lengths in order of their offsets, number of sequences like it


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Martello-Toth reduction: fix the sets of one or two lengths that dominate all other sets.

    For the longest remaining length ``s`` with residual ``r``: ``{s}`` alone dominates if nothing fits
    beside it; ``{s, j}`` with ``j`` the longest that fits dominates if ``j == r``, or if no two others
    fit together, or if no two that fit have a sum over ``j`` while no three fit. Lengths that have no
    dominating set are passed over and left to the caller.
    """
    left = {s: n for s, n in counts.items() if n}
    order = sorted(left)
    fixed: list[Pattern] = []
    for s in sorted(left, reverse=True):
        while left.get(s, 0):
            room = capacity - s
            if order[0] > room or (order[0] == s and left[s] == 1 and len(order) == 1):
                fixed.append(((s,), left[s]))
                used = {s: left[s]}
            else:
                at = bisect.bisect_right(order, room) - 1
                j = order[at]
                if j == s and left[s] == 1:
                    if at == 0:
                        fixed.append(((s,), 1))
                        used = {s: 1}
                        _take(left, order, used)
                        continue
                    at -= 1
                    j = order[at]
                if not (j == room or _pair_dominates(left, order, s, j, room)):
                    break
                n = left[s] // 2 if j == s else min(left[s], left[j])
                fixed.append(((s, j), n))
                used = {s: 2 * n} if j == s else {s: n, j: n}
            _take(left, order, used)
    return fixed, left


def _take(left: dict[int, int], order: list[int], used: dict[int, int]) -> None:
    for k, n in used.items():
        left[k] -= n
        if not left[k]:
            del left[k]
            order.remove(k)


def _pair_dominates(left: dict[int, int], order: list[int], s: int, j: int, room: int) -> bool:
    """No two others fit beside ``s``, or each two that do are no longer than ``j`` and no three fit."""
    least = []
    for k in order:
        least += [k] * min(3, left[k] - (k == s))
        if len(least) >= 3:
            break
    least = sorted(least)[:3]
    if len(least) < 2 or least[0] + least[1] > room:
        return True
    if len(least) == 3 and sum(least) <= room:
        return False
    low, high, best = 0, bisect.bisect_right(order, room) - 1, 0
    while low <= high:
        total = order[low] + order[high]
        if total > room:
            high -= 1
        elif low == high and left[order[low]] - (order[low] == s) < 2:
            low += 1
        else:
            best = max(best, total)
            low += 1
    return best <= j


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit in descending order of length, all equal sequences at once."""
    open_by_room: dict[int, dict[tuple[int, ...], int]] = {}
    rooms: list[int] = []

    def put(pattern: tuple[int, ...], n: int, room: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = {}
            bisect.insort(rooms, room)
        open_by_room[room][pattern] = open_by_room[room].get(pattern, 0) + n

    for s in sorted(counts, reverse=True):
        left = counts[s]
        while left:
            at = bisect.bisect_left(rooms, s)
            if at == len(rooms):
                fit = capacity // s
                if left >= fit:
                    put((s,) * fit, left // fit, capacity - fit * s)
                if left % fit:
                    put((s,) * (left % fit), 1, capacity - (left % fit) * s)
                break
            room = rooms[at]
            pattern, n = open_by_room[room].popitem()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            each = min(room // s, left)
            n_used = min(n, left // each)
            if n_used < n:
                put(pattern, n - n_used, room)
            put(pattern + (s,) * each, n_used, room - each * s)
            left -= each * n_used
    return [(p, n) for kinds in open_by_room.values() for p, n in kinds.items()]


def plan_packing(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns with their numbers of sequences; they use each length exactly as often as it is counted."""
    full = [((capacity,), counts[capacity])] if counts.get(capacity) else []
    fixed, rest = reduce_by_dominance({s: n for s, n in counts.items() if s < capacity}, capacity)
    return full + fixed + best_fit(rest, capacity)


def runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``values`` with these starts and sizes, one after the other."""
    ends = np.cumsum(sizes)
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class WordIds:
    """Ids by word, remembered in one array; what hasn't been used lately goes when there are more than ``most``.

    The vocabulary must part letters from signs, put letters in lower case and mark where a word ends. Then a word of
    Latin letters, after which there may be signs, is two tokens' worth of text: its letters and its signs are
    remembered apart. Letters are encoded in lower case, many words at once, and cut where a token ends a word.
    """

    _LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"

    def __init__(self, path: str, most: int = 600_000) -> None:
        from tokenizers import Tokenizer

        self.most = most
        self.tokenizer = known = Tokenizer.from_file(path)

        def ids(text: str) -> list[int]:
            return known.encode(text, add_special_tokens=False).ids

        ends = known.encode("Ab", add_special_tokens=False).tokens[-1].endswith("</w>")
        if not (ends and ids("Ab") == ids("ab") and ids(" ab  ab\n") == ids("ab") * 2 and ids("ab!") == ids("ab") + ids("!")):
            raise ValueError("a tokenizer is needed that drops white space, lowers letters and marks the ends of words")
        #: Signs that may follow a word's letters, alone or after one another.
        self.signs = "".join(c for c in ".,!?;:*#$%&" if ids("ab" + c) == ids("ab") + ids(c))
        vocabulary = known.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        #: What is remembered, by its number; its ids, from one bound to the next; whether it was used lately.
        self.numbers: dict[str, int] = {}
        self.ids, self.bounds, self.used = np.zeros(0, "<u4"), np.zeros(1, np.int64), np.zeros(0, bool)

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, word after word, and how many each has."""
        if len(self.numbers) > self.most:
            self._forget()
        core = pc.ascii_rtrim(words, self.signs)
        plain = pc.match_substring_regex(core, f"^{self._LETTERS}$")
        signed = pc.and_(plain, pc.less(pc.binary_length(core), pc.binary_length(words)))
        head = pc.if_else(plain, pc.utf8_lower(core), words).dictionary_encode()
        tail = pc.replace_substring_regex(words.filter(signed), f"^{self._LETTERS}", "").dictionary_encode()
        parts = np.zeros((len(words), 2), np.int64)
        parts[:, 0] = self._numbers(head.dictionary)[head.indices.to_numpy()]
        parts[:, 1] = self._numbers(pa.array([""]))[0]
        parts[np.flatnonzero(signed), 1] = self._numbers(tail.dictionary)[tail.indices.to_numpy()]
        sizes = np.diff(self.bounds)[parts]
        return runs(self.ids, self.bounds[parts.ravel()], sizes.ravel()), sizes.sum(axis=1)

    def _numbers(self, texts: pa.Array) -> np.ndarray:
        """The numbers of different texts; those that aren't known are encoded first."""
        listed = texts.to_pylist()
        found = np.fromiter(map(self.numbers.get, listed, repeat(-1)), np.int64, len(listed))
        new = np.flatnonzero(found < 0)
        if len(new):
            letters = pc.match_substring_regex(texts.take(pa.array(new)), f"^{self._LETTERS}$").to_numpy(zero_copy_only=False)
            plain, other = ([listed[i] for i in part.tolist()] for part in (new[letters], new[~letters]))
            found[np.concatenate([new[letters], new[~letters]])] = np.arange(len(self.numbers), len(self.numbers) + len(new))
            self.numbers.update(zip(plain + other, range(len(self.numbers), len(self.numbers) + len(new)), strict=True))
            coded = [*self._encode_lines(plain), *self._encode(other)]
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in coded)])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(np.concatenate([sizes for _, sizes in coded]))])
            self.used = np.concatenate([self.used, np.zeros(len(new), bool)])
        self.used[found] = True
        return found

    def _forget(self) -> None:
        """Drop what hasn't been used since the last time."""
        stay = np.flatnonzero(self.used)
        listed, sizes = list(self.numbers), np.diff(self.bounds)[stay]
        self.ids = runs(self.ids, self.bounds[stay], sizes)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.numbers = {listed[i]: k for k, i in enumerate(stay.tolist())}
        self.used = np.zeros(len(stay), bool)

    def _encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(texts), 4096):
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)]
            yield np.fromiter(chain.from_iterable(found), "<u4"), np.fromiter(map(len, found), np.int64)

    def _encode_lines(self, words: list[str], at_once: int = 128) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of letters, ``at_once`` a line."""
        for i in range(0, len(words), 64 * at_once):
            parts = [words[j : j + at_once] for j in range(i, min(i + 64 * at_once, len(words)), at_once)]
            for part, e in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, "<u4")
                cuts = np.flatnonzero(self.ends[ids]) + 1
                if len(cuts) != len(part) or cuts[-1] != len(ids):
                    yield from self._encode(part)
                else:
                    yield ids, np.diff(cuts, prepend=0)


def pieces_of(path: str, capacity: int, end: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function from (doc_id, text) to the pieces of the documents' ids, each ended by ``end``."""
    last = end.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = kept(f"word-ids {path}", lambda: WordIds(path))
        for batch in slices(batches, "text", 4 << 20):
            # White space beyond ASCII stays within a word here, which the tokenizer itself then parts.
            split = pc.ascii_split_whitespace(batch.column("text").fill_null(""))
            coded = split.flatten().dictionary_encode()
            known, n_ids = ids.of(coded.dictionary)
            which = coded.indices.to_numpy()
            sizes = n_ids[which]
            sums = np.concatenate([[0], np.cumsum(sizes)])
            flat = runs(known, (np.cumsum(n_ids) - n_ids)[which], sizes)
            bounds = sums[split.offsets.to_numpy()]
            rows: list[tuple] = []
            for doc, start, stop in zip(batch.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                raw = flat[start:stop].tobytes() + last
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids: doc_id, piece, start, length, ids_crc32.

    Null texts count as empty: a single piece with the end id alone. White space never joins or parts
    the ids of two words under this kind of vocabulary (it drops white space before it merges), so
    words are encoded once and remembered. Repeated rows give repeated pieces.
    """
    return only(docs, "doc_id", "text").mapInArrow(
        pieces_of(tokenizer_path, capacity, end), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Any other columns are kept, but for columns of those two names, which are replaced. Ties of length are numbered within hash slots of all the
    columns, as many as shuffle partitions, so one very common length is dealt over all tasks. Which of
    two equal pieces gets which slot carries no meaning. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    slots = partitions(spark)
    keep = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_slot", "_rank")]
    rows = stored(
        only(pieces, *keep).withColumn("_slot", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in keep]), F.lit(slots)).cast("int")), "pieces"
    )
    by_slot = rows.groupBy("length", "_slot").agg(F.count("*").alias("n"))
    counts = {r[0]: r[1] for r in by_slot.groupBy("length").agg(F.sum("n")).collect()}  # at most `capacity` rows
    if any(not 1 <= s <= capacity for s in counts):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    plan = plan_packing(counts, capacity)

    # For each length, its places in the plan: from number `base` on, `n` sequences with `copies` places each.
    places: dict[int, tuple[list[int], list[tuple[int, int, int, int]]]] = {}
    base, first = dict.fromkeys(counts, 0), 0
    for pattern, n in plan:
        offset = 0
        for s in dict.fromkeys(pattern):
            copies = pattern.count(s)
            starts, what = places.setdefault(s, ([], []))
            starts.append(base[s])
            what.append((first, n, copies, offset))
            base[s] += n * copies
            offset += s * copies
        first += n

    before = Window.partitionBy("length").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_slot.select("length", "_slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_from"))
    inner = Window.partitionBy("length", "_slot").orderBy(*[F.col(f"`{c}`") for c in keep if c != "length"])
    ranked = (
        rows.withColumn("_rank", F.row_number().over(inner) - 1)
        .join(offsets, ["length", "_slot"])
        .withColumn("_rank", F.col("_rank") + F.col("_from"))
        .drop("_slot", "_from")
    )
    shared = spark.sparkContext.broadcast(places)  # at most `capacity` lengths, a few thousand patterns
    at_length, at_rank = keep.index("length"), len(keep)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            seqs, offs = [], []
            for s, r in zip(batch.column(at_length).to_pylist(), batch.column(at_rank).to_pylist(), strict=True):
                starts, what = table[s]
                k = bisect.bisect_right(starts, r) - 1
                head, _, copies, offset = what[k]
                i, c = divmod(r - starts[k], copies)
                seqs.append(head + i)
                offs.append(offset + c * s)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:at_rank], pa.array(seqs, pa.int64()), pa.array(offs, pa.int64())], [*keep, "sequence_id", "offset"]
            )

    ranked = ranked.select(*[F.col(f"`{c}`") for c in keep], "_rank")
    schema = rows.select(*[F.col(f"`{c}`") for c in keep]).schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize and pack whole documents; only those longer than a sequence are cut."""
    return pack(tokenize_pieces(docs, tokenizer_path, capacity), capacity)
