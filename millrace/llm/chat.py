"""Chat formatting: root-to-leaf paths of reply trees, ranked, and written with a template that can be read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import discard, only, slices, small_batches, stored

# The template. A turn is its opening, its text and its closing; other roles than these three carry their name.
OPEN = {"system": "[SYS] ", "user": "[INST] ", "assistant": "<s> "}
CLOSE = {"system": " [/SYS]", "user": " [/INST]", "assistant": " </s>"}
OTHER_OPEN, NAME_END, OTHER_CLOSE = "[ROLE] ", " [NAME] ", " [/ROLE]"
LEARNT = "assistant"

_CONTROL = re.compile(r"([<\[])(?=/?s>|/?SYS\]|/?INST\]|/?ROLE\]|NAME\])")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"\[SYS\] |\[INST\] |<s> |\[ROLE\] ")

Turn = tuple[str, str]


def escape(text: str) -> str:
    """``text`` without a control string: a backslash behind its first sign breaks it; backslashes are doubled."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[Turn]) -> tuple[str, list[int], list[int]]:
    """The turns (role, text) as one string, with the starts and lengths, in code points, of what is to be learnt."""
    pieces, starts, lengths, at = [], [], [], 0
    for role, text in turns:
        opening = OPEN.get(role) or f"{OTHER_OPEN}{escape(role)}{NAME_END}"
        body, closing = escape(text), CLOSE.get(role, OTHER_CLOSE)
        if role == LEARNT:
            starts.append(at + len(opening))
            lengths.append(len(body))
        pieces += (opening, body, closing)
        at += len(opening) + len(body) + len(closing)
    return "".join(pieces), starts, lengths


def read_back(formatted: str) -> list[Turn]:
    """The turns of a formatted string. No text holds a control string, so each closing is the first behind its opening."""
    turns, at, roles = [], 0, {v: k for k, v in OPEN.items()}
    while at < len(formatted):
        opening = _TURN.match(formatted, at)
        if opening is None:
            raise ValueError(f"no turn begins at {at}")
        at, role = opening.end(), roles.get(opening[0])
        if role is None:
            end = formatted.index(NAME_END, at)
            role, at = unescape(formatted[at:end]), end + len(NAME_END)
        closing = CLOSE.get(role, OTHER_CLOSE) if opening[0] != OTHER_OPEN else OTHER_CLOSE
        end = formatted.index(closing, at)
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(closing)
    return turns


def learnt(formatted: str, starts: list[int], lengths: list[int]) -> list[str]:
    """The texts under the loss mask, unescaped."""
    return [unescape(formatted[a : a + n]) for a, n in zip(starts, lengths, strict=True)]


def thread(rows: DataFrame, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Messages (tree, message_id, parent_id, role, text, score) of conversations whose rows follow each other.

    Each row answers the one before it by ``order``; equal ones come by role and text, nulls first. Repeated rows are turns of
    their own. A null ``key`` is a conversation like others. A conversation's rows meet in one task, as the conversation is
    one value in the end.
    """
    source = only(rows, key, order, "role", "text").toDF("tree", "order", "role", "text")
    place = F.row_number().over(Window.partitionBy("tree").orderBy("order", "role", "text"))
    name = lambda n: F.concat(F.coalesce(F.col("tree").cast("string"), F.lit("")), F.when(F.col("tree").isNull(), "null").otherwise(""), F.lit(":"), n.cast("string"))
    numbered = source.withColumn("place", place)
    parent = F.when(F.col("place") > 1, name(F.col("place") - 1))
    return numbered.select("tree", name(F.col("place")).alias("message_id"), parent.alias("parent_id"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(leaf, distance, message_id): each message on the way from a leaf, a message without an answer, up to its root.

    ``messages`` has message_id and parent_id, each id once. Iterative self-joins double the jumps: links to the message 1, 2, 4, ...
    steps above; the rows of a path so far are joined with them, so a tree takes as many rounds as the logarithm of its depth.
    A message whose parent isn't there is a root. Messages on a circle have no leaf below or no root above: such paths are
    left out, which shows when jumps are longer than there are messages.
    """
    ids = messages.select("message_id")
    jumps = messages.where("parent_id is not null").select("message_id", F.col("parent_id").alias("above")).join(ids.select(F.col("message_id").alias("above")), "above", "left_semi")
    jumps = stored(jumps.select("message_id", "above"), "chat-jumps")
    leaves = ids.join(jumps.select(F.col("above").alias("message_id")), "message_id", "left_anti")
    found = stored(leaves.select(F.col("message_id").alias("leaf"), F.lit(0).cast("long").alias("distance"), "message_id"), "chat-paths")
    total, length = messages.count(), 1
    while not jumps.isEmpty():
        up = found.join(jumps, "message_id").select("leaf", (F.col("distance") + length).alias("distance"), F.col("above").alias("message_id"))
        if length > total:
            endless = up.select("leaf").distinct()
            return found.join(endless, "leaf", "left_anti")
        grown = stored(found.unionByName(up), "chat-paths")
        further = jumps.select(F.col("message_id").alias("above"), F.col("above").alias("next"))
        longer = stored(jumps.join(further, "above").select("message_id", F.col("next").alias("above")), "chat-jumps")
        discard(found, jumps)
        found, jumps, length = grown, longer, 2 * length
    discard(jumps)
    return found


def branches(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, place, role, text): the messages of each tree's best paths, from the root on.

    A path's score is the mean of its messages' scores (null: 0); ties go to the smaller leaf. ``keep`` is how many paths of a
    tree are chosen, None for all. ``messages`` has tree, message_id, parent_id, role, text and score; of several
    messages with one id the one with the smallest values stays, and messages without an id are left out. Null roles and texts are
    empty. Texts are joined only to the paths that are chosen.
    """
    names = ["tree", "message_id", "parent_id", "role", "text", "score"]
    one = F.min(F.struct(*[n for n in names if n != "message_id"])).alias("m")
    single = stored(only(messages, *names).where("message_id is not null").groupBy("message_id").agg(one).select("message_id", "m.*"), "chat-messages")
    found = paths(single.select("message_id", "parent_id"))
    scored = found.join(single.select("message_id", "tree", F.coalesce("score", F.lit(0.0)).alias("score")), "message_id")
    # Messages of one tree lie on one path's way; of its leaf the tree is taken, as a reply may name another.
    mean = scored.groupBy("leaf").agg(F.avg("score").alias("score"), F.max("distance").alias("depth"), F.max(F.when(F.col("distance") == 0, F.struct("tree"))).alias("t"))
    ranked = mean.select("leaf", "depth", "score", "t.tree").withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")))
    chosen = ranked if keep is None else ranked.where(F.col("rank") <= keep)
    ways = found.join(chosen, "leaf").select("tree", "leaf", "rank", (F.col("depth") - F.col("distance")).alias("place"), "message_id")
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return ways.join(single.select("message_id", blank("role"), blank("text")), "message_id").drop("message_id")


_FORMATTED = T.StructType().add("formatted", "string").add("loss_starts", T.ArrayType(T.LongType())).add("loss_lengths", T.ArrayType(T.LongType()))


def format_conversations(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_starts, loss_lengths): each chosen path as one conversation.

    ``loss_starts`` and ``loss_lengths`` mark what is to be learnt, the assistant's texts, in code points of ``formatted``. An
    empty table gives none. A path becomes one value, so it must fit a task.
    """
    small_batches(messages.sparkSession)
    turn = F.struct("place", "role", "text")
    whole = branches(messages, keep).groupBy("tree", "leaf", "rank").agg(F.transform(F.array_sort(F.collect_list(turn)), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):  # one conversation at a time is held as Python's strings
                part = batch.slice(at, 1)
                turns = [(t["role"], t["text"]) for t in part.column("turns")[0].as_py()]
                text, starts, lengths = format_turns(turns)
                values = [pa.array([text], pa.string()), pa.array([starts], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("tree", "leaf", "rank")), *values], ["tree", "leaf", "rank", *_FORMATTED.names])

    kept = whole.select("tree", "leaf", "rank").schema.fields
    return whole.mapInArrow(run, T.StructType([*kept, *_FORMATTED.fields]))


_DIGEST = T.StructType().add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long")


def digests(conversations: DataFrame) -> DataFrame:
    """What is read back from formatted conversations: (tree, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), "formatted"):
                rows = []
                for text, starts, lengths in zip(*(part.column(c) for c in _FORMATTED.names), strict=True):
                    text = text.as_py()
                    turns, said = read_back(text), "".join(learnt(text, starts.as_py(), lengths.as_py()))
                    written = hashlib.sha256()
                    for role, body in turns:
                        written.update(f"{role}\n{body}\n".encode())
                    rows.append((len(turns), written.hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest(), len(text)))
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("tree"), *columns], ["tree", *_DIGEST.names])

    rows = conversations.select("tree", *_FORMATTED.names)
    return rows.mapInArrow(run, T.StructType([rows.schema["tree"], *_DIGEST.fields]))
