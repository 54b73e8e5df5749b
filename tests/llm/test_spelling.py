"""Spelling variants against all pairs of a small vocabulary."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import spelling

SCHEMA = "doc_id long, text string"
LOWER = str.maketrans(spelling._UPPER, spelling._LOWER)


def plain_words(rows, least=7, times=2, every=31):
    seen = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % every == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= least:
                seen[low] += 1
    return {w: n for w, n in seen.items() if n >= times}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(rows, ratio=10, **kw):
    n = plain_words(rows, **kw)
    form, links = {}, {}
    for w in n:
        others = [v for v in n if v != w and abs(len(v) - len(w)) <= 1 and near(v, w)]
        links[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], links[w], n[form[w]] if form[w] else None)
    return out


def got(frame, **kw):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(frame, **kw).collect()}


def corpus(seed=11):
    rng = random.Random(seed)
    letters = "abcéÀz"
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([7, 8, 9, 12]))) for _ in range(12)]
    rows = []
    for doc in range(150):
        words = []
        for _ in range(40):
            w = rng.choice(base[:3] if rng.random() < 0.6 else base)
            if rng.random() < 0.15:
                i, kind = rng.randrange(len(w)), rng.randrange(3)
                w = w[:i] + ("" if kind == 0 else rng.choice(letters)) + w[i + (kind < 2) :]
            words.append(w.title() if rng.random() < 0.2 else w)
        rows.append((doc * 7, rng.choice([" ", "-", "\n", "1", "ß ", "Ā"]).join(words)))
    chain = ["abandoned" * 2] * 1000 + ["abandoneds" + "abandoned"] * 100 + ["abandoneds" + "abandonedx"] * 10
    return [*rows, (4, " ".join(chain)), (3, rows[0][1]), (None, rows[1][1]), (5, None), (6, ""), (8, "aaaaaaaaaa aaaaaaaaaa aaaaaaaaa aaaaaaaaa " * 6)]


@pytest.mark.parametrize("long", [256, 8])
def test_against_all_pairs(spark, long, monkeypatch):
    monkeypatch.setattr(spelling, "LONG", long)  # small: most words first send hashes alone
    rows = corpus()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"word": F.lit("clash"), "n": F.lit(0), "key": F.lit(1), "low": F.lit("x")}).repartition(3)
    want = plain_variants(rows)
    found = got(frame)
    assert found == want
    assert any(w != r and f != r for w, (f, r, *_) in found.items() if f), "no chain of forms in the data"


def test_hash_collisions_are_told_apart():
    """Rows brought together under one key by force: only equal remains count."""
    names = ["abcdefgh", "abcdefgx", "zzzzzzzz", "abcdefg"]
    rows = {"key": [5] * 4, "place": [7, 7, 7, spelling.WHOLE], "n": [9, 4, 3, 2], "name": names}
    batch = pa.RecordBatch.from_pydict(rows, pa.schema([("key", pa.int64()), ("place", pa.int32()), ("n", pa.int64()), ("name", pa.string())]))
    found = [r for b in spelling._met(iter([batch.slice(0, 2), batch.slice(2)])) for r in b.to_pylist()]
    assert sorted((r["word"], r["links"], r["best"], r["best_n"]) for r in found) == [("abcdefgh", 1, "abcdefgx", 4), ("abcdefgx", 1, "abcdefgh", 9)]


def test_keys_are_those_of_the_letters_left():
    words = ["aabbcdé", "abbcdéx", "xaabbcdé"]
    batch = pa.RecordBatch.from_pydict({"word": words, "n": [1, 1, 1], "name": words})
    keys = {}
    for part in spelling._hashed(iter([batch]), step=5):
        for r in part.to_pylist():
            p, w = r["place"], r["name"]
            left = w if p == spelling.WHOLE else w[: -2 - p] + w[-1 - p :] if p < 0 else w[:p] + "\0" + w[p + 1 :]
            assert keys.setdefault(r["key"], left) == left
    assert len(keys) == len(set(keys.values())), "one remainder has two keys"
    assert np.unique(list(keys)).size == len(keys)


def test_empty_table_and_ties(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == {}
    assert got(spark.createDataFrame([(1, None), (2, "short words only")], SCHEMA)) == {}
    rows = [(1, "middlea " * 30 + "middleb " * 30 + "middlec middlec middle middle ")]
    assert got(spark.createDataFrame(rows, SCHEMA), every=1 << 40)["middlec"] == ("middlea", "middlea", 2, 2, 30)


def test_very_long_texts_and_words(spark):
    """A text of ten megabytes and words of a hundred thousand letters."""
    rng = random.Random(1)
    word = "".join(rng.choice("abcdefghij") for _ in range(100_000))
    other = word[:50_000] + "x" + word[50_001:]
    rows = [(1, " ".join([word] * 11)), (2, f"{other} {other[:-1]}"), (3, f"{other} {other[:-1]}"), (4, "wordless text " * 700_000)]
    found = got(spark.createDataFrame(rows, SCHEMA).repartition(2), every=1 << 40)
    assert found[other] == (None, other, 2, 2, None)
    assert found[word] == (None, word, 11, 1, None)
    assert found["wordless"][2] == 700_000
    assert got(spark.createDataFrame(rows, SCHEMA), every=1 << 40, ratio=5)[other] == (word, word, 2, 2, 11)
