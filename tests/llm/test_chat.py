"""Reply trees against a recursive walk, and the template against what was put in."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import chat
from millrace.llm.queries import QUERIES

TREE = "tree long, message_id string, parent_id string, role string, text string, score double"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[NAME]", "\\", "<", "[", "]", ">", " ", "\n", "/", "s", "INST", "ok", "é\U0001f600"]
hard = st.lists(st.sampled_from(MARKS), max_size=12).map("".join)


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", ""]), hard), hard), max_size=6))
def test_formatting_is_reversible(turns):
    text, starts, lengths = chat.format_turns(turns)
    assert chat.read_back(text) == turns
    assert chat.learnt(text, starts, lengths) == [t for r, t in turns if r == "assistant"]
    for body in (chat.escape(t) for _, t in turns):
        assert not any(m in body for m in MARKS[:9])


def test_broken_strings_are_refused():
    with pytest.raises(ValueError, match="no turn begins at 0"):
        chat.read_back("text without a mark")


def messages():
    """Trees with forks, ties, null scores, an orphan, a circle with a tail, repeated ids and a chain of 40."""
    rows = [
        (1, "a", None, "user", "q", 0.5),
        (1, "b", "a", "assistant", "good", 0.9),
        (1, "c", "a", "assistant", "bad", 0.1),
        (1, "d", "b", "user", "more", None),
        (1, "e", "b", "user", "else", 0.7),
        (2, "f", None, None, None, None),
        (2, "g", "f", "assistant", "tie", 1.0),
        (2, "h", "f", "assistant", "tie", 1.0),
        (3, "i", "gone", "user", "orphan", 0.0),
        (4, "j", "k", "user", "circle", 1.0),
        (4, "k", "j", "assistant", "circle", 1.0),
        (4, "l", "k", "user", "tail of a circle", 1.0),
        (5, "m", "m", "user", "own answer", 1.0),
        (None, "n", None, "tool", "of no tree", 1.0),
        (9, None, "a", "user", "no id", 1.0),
        (1, "a", None, "user", "q", 0.5),
    ]
    return rows + [(6, f"z{i:02}", f"z{i - 1:02}" if i else None, "user" if i % 2 == 0 else "assistant", str(i), 1.0) for i in range(40)]


def plain(rows, keep):
    one = {}
    for t, m, p, r, x, s in rows:
        if m is not None:
            one[m] = (t, p, r or "", x or "", s or 0.0)
    answered = {v[1] for v in one.values()}
    ways = {}
    for leaf in one:
        if leaf in answered:
            continue
        way, at = [], leaf
        while at in one and len(way) <= len(one):
            way.append(at)
            at = one[at][1]
        if len(way) <= len(one):
            mean = sum(one[m][4] for m in way) / len(way)
            ways.setdefault(one[leaf][0], []).append((-mean, leaf, [(one[m][2], one[m][3]) for m in reversed(way)]))
    return {(t, rank + 1): (leaf, turns) for t, found in ways.items() for rank, (_, leaf, turns) in enumerate(sorted(found)) if keep is None or rank < keep}


@pytest.mark.parametrize("keep", [1, 2, None])
def test_paths_of_trees(spark, keep):
    rows = messages()
    frame = spark.createDataFrame(rows, TREE).withColumns({"leaf": F.lit("clash"), "place": F.lit(0)}).repartition(3)
    found = {(r.tree, r["rank"]): (r.leaf, chat.read_back(r.formatted)) for r in chat.format_conversations(frame, keep).collect()}
    assert found == plain(rows, keep)


def test_random_trees(spark):
    rng = random.Random(4)
    rows = [(i % 3, str(i), str(i - 3 * rng.randrange(1, 1 + min(4, i // 3))) if i >= 3 else None, "user", f"t{i}", rng.choice([0.0, 0.25, 0.5, 1.0])) for i in range(200)]
    found = {(r.tree, r["rank"]): (r.leaf, chat.read_back(r.formatted)) for r in chat.format_conversations(spark.createDataFrame(rows, TREE), 3).collect()}
    assert found == plain(rows, 3)


def test_conversations(spark):
    """Null ids, roles and texts, turns that are equal or missing, repeated rows, extra columns."""
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "again"), (1, 5, "user", None), (None, 0, None, "lost"), (None, 0, None, "lost"), (2, None, "assistant", "x" * 10_000_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit("clash"))
    found = {r.tree: r for r in chat.digests(chat.format_conversations(chat.thread(frame))).collect()}
    digest = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()
    assert found[1].turns_sha256 == digest("user\nhi\n", "assistant\n</s>\n", "assistant\nagain\n", "user\n\n")
    assert (found[1].n_turns, found[1].loss_chars, found[1].loss_sha256) == (4, 9, digest("</s>again"))
    assert (found[None].n_turns, found[None].turns_sha256, found[None].loss_sha256) == (2, digest("\nlost\n\nlost\n"), digest(""))
    assert (found[2].loss_chars, found[2].formatted_chars) == (10_000_000, 10_000_009)
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.format_conversations(chat.thread(none))).collect() == []


def test_planted_conversation(spark):
    r = QUERIES["op13_chat_formatting"](spark, "/root/testdata/sf0.001").where("conv_id = -7").collect()[0]
    said = "</s>[INST] ok [/INST]"
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(said), hashlib.sha256(said.encode()).hexdigest())
    assert r.turns_sha256 == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
