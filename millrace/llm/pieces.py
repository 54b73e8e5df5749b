"""SentencePiece encoding and decoding of a byte-fallback BPE model, by matching its pieces in a suffix array."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import only, slices

SPACE = "▁"
_NONE = np.int32(np.iinfo(np.int32).max)


@dataclass
class PieceModel:
    """Pieces of a model file: what they are, their merge priority, and the ids of single bytes."""

    path: str
    pieces: np.ndarray = field(init=False)
    rank: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self) -> None:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(self.path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces:
            raise ValueError("a BPE model with byte fallback and the identity normalizer is needed")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        normal = [(p.piece, p.score, i) for i, p in enumerate(model.pieces) if p.type == 1]
        self.pieces = np.array([p for p, _, _ in normal])
        self.rank = np.unique([-s for _, s, _ in normal], return_inverse=True)[1].astype(np.int32)
        self.ids = np.array([i for _, _, i in normal], np.int32)
        self.longest = max(len(p) for p, _, _ in normal)
        self.bytes = np.zeros(256, np.int32)
        self.text = [b""] * len(model.pieces)
        for i, p in enumerate(model.pieces):
            if p.type == 6:
                value = int(p.piece[3:5], 16)
                self.bytes[value] = i
                self.text[i] = bytes([value])
            elif p.type == 1:
                self.text[i] = p.piece.replace(SPACE, " ").encode()
        # A piece has its spaces in front or is all spaces, so no merge crosses the start of a run of spaces.
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces that hold a space within are not supported")
        alone = "" if any("\n" in p and len(p) > 1 for p in self.pieces) else "\n"
        self.segment = re.compile(f"{alone}|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+" if alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def segments(self, text: str) -> list[str]:
        return self.segment.findall(self.prefix + text.replace(" ", SPACE)) if text else []

    def decode(self, ids: np.ndarray) -> bytes:
        raw = b"".join(map(self.text.__getitem__, ids.tolist()))
        return raw[1:] if self.prefix and raw[:1] == b" " else raw


@lru_cache(maxsize=2)
def load(path: str) -> PieceModel:
    return PieceModel(path)


def suffix_array(codes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all suffixes in order of their first ``depth`` characters, and these characters."""
    padded = np.concatenate([codes, np.zeros(depth - 1, np.uint32)])
    views = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, depth)).view(f"<U{depth}").ravel()
    order = np.argsort(views, kind="stable")
    return order, views[order]


def matches(model: PieceModel, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position and length: merge rank and id of the piece that matches there.

    Each piece is found by binary search as a range of the suffix array; the edges of all ranges are
    sorted by position into the two tables.
    """
    order, views = suffix_array(codes, model.longest)
    low = np.searchsorted(views, model.pieces, side="left")
    high = np.searchsorted(views, np.char.add(model.pieces, chr(0x10FFFF)), side="right")
    n = high - low
    which = np.repeat(np.arange(len(n)), n)
    at = order[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
    length = np.char.str_len(model.pieces)[which]
    by_position = np.lexsort((length, at))
    at, length, which = at[by_position], length[by_position], which[by_position]
    rank = np.full((len(codes) + 1, model.longest + 1), _NONE, np.int32)
    ids = np.full((len(codes) + 1, model.longest + 1), -1, np.int32)
    rank[at, length], ids[at, length] = model.rank[which], model.ids[which]
    return rank, ids


def relax(rank: np.ndarray, base: np.ndarray, length: int) -> list[np.ndarray]:
    """Merge bounds of words of one length: rounds in which each word takes its best edge between neighbours.

    Equal ranks go to the leftmost. Returns for each word the places at which its symbols start, and its end.
    """
    longest = rank.shape[1] - 1
    out: list[np.ndarray] = [np.zeros(0)] * len(base)
    row, bounds = np.arange(len(base)), np.tile(np.arange(length + 1), (len(base), 1))
    while len(row):
        width = bounds.shape[1]
        if width > 2:
            span = bounds[:, 2:] - bounds[:, :-2]
            cost = rank[base[row][:, None] + bounds[:, :-2], np.minimum(span, longest)]
            cost = np.where(span > longest, _NONE, cost)
            best = cost.argmin(axis=1)
            go = cost[np.arange(len(row)), best] != _NONE
        else:
            go, best = np.zeros(len(row), bool), np.zeros(len(row), np.int64)
        for r, b in zip(row[~go].tolist(), bounds[~go], strict=True):
            out[r] = b
        keep = np.ones((int(go.sum()), width), bool)
        keep[np.arange(len(keep)), best[go] + 1] = False
        row, bounds = row[go], bounds[go][keep].reshape(-1, width - 1)
    return out


def relax_long(rank: np.ndarray, base: int, length: int) -> np.ndarray:
    """The same for one long word, by a queue of edges."""
    longest = rank.shape[1] - 1
    after, before, alive = list(range(1, length + 1)), list(range(-1, length - 1)), [True] * length
    queue: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        if 0 <= a < length and after[a] < length:
            end = after[after[a]]
            if end - a <= longest and rank[base + a, end - a] != _NONE:
                heapq.heappush(queue, (int(rank[base + a, end - a]), a, end))

    for a in range(length - 1):
        offer(a)
    while queue:
        _, a, end = heapq.heappop(queue)
        if not alive[a] or after[a] >= length or after[after[a]] != end:
            continue
        alive[after[a]] = False
        after[a] = end
        if end < length:
            before[end] = a
        offer(a)
        offer(before[a])
    return np.array([a for a in range(length) if alive[a]] + [length])


class Encoder(dict):
    """Ids (little-endian bytes) by segment, remembered in two generations of bounded size."""

    def __init__(self, model: PieceModel, most: int = 300_000, batch_chars: int = 200_000) -> None:
        super().__init__()
        self.model, self.most, self.batch_chars, self.old = model, most, batch_chars, {}

    def learn(self, words: set[str]) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        todo, size = [], 0
        for w in words:
            if w in self:
                continue
            if w in self.old:
                self[w] = self.old[w]
                continue
            todo.append(w)
            size += len(w) + 1
            if size >= self.batch_chars:
                self._encode(todo)
                todo, size = [], 0
        if todo:
            self._encode(todo)

    def _encode(self, words: list[str]) -> None:
        words.sort(key=len)
        text = "\0".join(words)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.array([len(w) for w in words])
        starts = np.cumsum(lengths + 1) - lengths - 1
        rank, ids = matches(self.model, codes)
        for a, b in _equal_runs(lengths):
            n = int(lengths[a])
            cuts = relax(rank, starts[a:b], n) if n <= 64 else [relax_long(rank, int(s), n) for s in starts[a:b]]
            for w, base, c in zip(words[a:b], starts[a:b].tolist(), cuts, strict=True):
                found = ids[base + c[:-1], c[1:] - c[:-1]]
                self[w] = found.astype("<u4").tobytes() if (found >= 0).all() else self._with_bytes(w, c, found)

    def _with_bytes(self, word: str, cuts: np.ndarray, found: np.ndarray) -> bytes:
        parts = []
        for i, a, b in zip(found.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            parts += [i] if i >= 0 else self.model.bytes[list(word[a:b].encode("utf-8", "surrogatepass"))].tolist()
        return np.array(parts, "<u4").tobytes()


def _equal_runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(values)) + 1).tolist(), len(values)]
    return zip(cuts, cuts[1:], strict=False) if len(values) else iter(())


_encoders: dict[str, Encoder] = {}


def _each(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str], list[bytes]]]:
    encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(load(path)))
    for batch in slices(batches, "text", 2 << 20):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        split = [encoder.model.segments(t) for t in texts]
        encoder.learn(set().union(*split))
        yield batch, texts, [b"".join(map(encoder.__getitem__, s)) for s in split]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) of each row of (doc_id, text); none for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, raw in _each(path, batches):
            ids = pa.array([np.frombuffer(r, np.int32) for r in raw], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of each row of (doc_id, ids); bytes that are no UTF-8 become replacement characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            texts = [None if i is None else model.decode(np.array(i, np.int64)).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return only(encoded, "doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, decoded_sha256, round_trip: digests of the ids and of what they decode to.

    ``round_trip`` tells if the decoded bytes are those of the text (null: empty). A text that has the
    sign for a space (U+2581) itself decodes to a space there, as the format can't tell them apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, raw in _each(path, batches):
            model, rows = load(path), []
            for doc, text, r in zip(batch.column("doc_id").to_pylist(), texts, raw, strict=True):
                back = model.decode(np.frombuffer(r, np.uint32))
                rows.append((doc, len(r) // 4, zlib.crc32(r), hashlib.sha256(back).hexdigest(), back == text.encode()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()), strict=True)],
                ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "round_trip"],
            )

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean")
