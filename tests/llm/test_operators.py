"""Each operator against a brute-force version on small tables with hard cases."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import common, embeddings, fingerprints, langid, lines, ngram_join, packing, pieces, substring_dedup, suffix_dedup, urls, windows
from millrace.llm.components import components
from millrace.llm.queries import QUERIES, URL_RULES, public_tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus(seed=7):
    """Copies, near copies, shared passages, empty, null, short, periodic and long texts, repeated rows."""
    rng = random.Random(seed)
    base = [" ".join(words(rng, rng.choice([3, 30, 120, 300]), 5000)) for _ in range(25)]
    passage = " ".join(words(rng, 90, 5000))
    texts = [*base, base[3], base[3], base[4], None, "", " \n\t", "a", "Zwei  Wörter", "To " * 400, "x" * 1500, "x" * 1500 + "y", "é" * 700]
    for i in range(12):
        w = base[10].split() if len(base[10].split()) > 20 else base[11].split()
        w[rng.randrange(len(w))] = f"edit{i}"
        texts.append(" ".join(w))
    texts += [f"{' '.join(words(rng, 20, 5000))} {passage} {' '.join(words(rng, 20, 5000))}" for _ in range(6)]
    texts += [passage.upper(), " ".join(words(rng, 6000, 100_000))]
    rng.shuffle(texts)
    return [(i * 3, t, None, "s", None) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # A clashing extra column must do no harm.
    return spark.createDataFrame(rows, SCHEMA).withColumn("r", F.lit("clash")).withColumn("first", F.lit(1)).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def hot_texts(n):
    """Texts around one passage, some of them copies, so that its buckets have many classes."""
    rng = random.Random(12)
    shared = " ".join(words(rng, 60, 9999))
    texts = [f"{' '.join(words(rng, 40, 9999))} {shared} {' '.join(words(rng, 40, 9999))}" for _ in range(n)]
    return [(i, t) for i, t in enumerate([*texts, *texts[:3], *texts[:2], shared, f"{shared} {shared}"])]


@pytest.mark.parametrize(("length", "most"), [(400, 256), (64, 2), (101, 256), (200, 3)])
def test_suffix_dedup(spark, docs, rows, length, most, monkeypatch):
    monkeypatch.setattr(windows, "MOST", most)  # small: buckets are split by longer and longer grams
    for frame, data in ((docs, rows), (spark.createDataFrame(hot_texts(25), "doc_id long, text string"), hot_texts(25))):
        got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.repeated_byte_digests(frame, length).collect()}
        raw = {d: (t or "").encode() for d, t, *_ in data}
        seen = collections.Counter(b[p : p + length] for b in raw.values() for p in range(len(b) - length + 1))
        for d, b in raw.items():
            mark = bytearray(len(b))
            for p in range(len(b) - length + 1):
                if seen[b[p : p + length]] > 1:
                    mark[p : p + length] = b"\1" * length
            kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
            spans = sum(m and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark))
            assert got[d] == (len(b), sum(mark), spans, hashlib.sha256(kept).hexdigest()), d


def test_suffix_dedup_of_hot_buckets(spark):
    rng = random.Random(3)
    shared = "".join(rng.choice("abcdefghij") for _ in range(430))
    texts = [("".join(rng.choice("abcdefghij") for _ in range(500)) + shared + "".join(rng.choice("klm") for _ in range(500))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = suffix_dedup.repeated_byte_digests(df).collect()
    assert all(r.n_spans == 1 and 430 <= r.n_removed < 450 for r in got) and len(got) == 200
    kept = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(df).collect()}
    assert all(shared not in t for t in kept.values())


@pytest.mark.parametrize("most", [256, 2])
def test_substring_dedup(spark, docs, rows, most, monkeypatch):
    monkeypatch.setattr(windows, "MOST", most)

    def check(frame, data):
        got = {r.doc_id: tuple(r)[1:] for r in substring_dedup.repeated_word_digests(frame).collect()}
        seen = set()
        for d, t in sorted(data):
            w = (t or "").encode().split()
            mark = bytearray(len(w))
            for p in range(len(w) - 19):
                k = tuple(w[p : p + 20])
                if k in seen:
                    mark[p : p + 20] = b"\1" * 20
                seen.add(k)
            kept = b" ".join(x for x, m in zip(w, mark, strict=True) if not m)
            assert got[d] == (len(w), sum(mark), hashlib.sha256(kept).hexdigest()), d

    check(docs, [(r[0], r[1]) for r in rows])
    check(spark.createDataFrame(hot_texts(25), "doc_id long, text string"), hot_texts(25))


def shingles(text):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    w = (text or "").encode().translate(low).split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def closure(nodes, linked):
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(found[a], found[b])
            if found[a] != low or found[b] != low:
                found[a] = found[b] = low
                changed = True
    return found


def near(rng, source, edits):
    w = source.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


def test_ngram_join(spark, docs, rows):
    rng = random.Random(11)
    bases = [" ".join(words(rng, 150, 9999)) for _ in range(4)]
    data = [(1000 + i, near(rng, rng.choice(bases), rng.randrange(6))) for i in range(120)] + [(r[0], r[1]) for r in rows]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    sets = {d: shingles(t) for d, t in data}
    ids = sorted(sets)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = closure(ids, linked)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_copies(df).collect()}
    assert got == {d: (len(sets[d]), want[d]) for d in ids}
    assert {r.doc_id for r in ngram_join.keep_one(df).collect()} == {d for d in ids if want[d] == d}


def test_sketches_bound_overlaps_in_one_pass(spark):
    """Bits in common are counted once for both sets; the last join's condition had twice as many terms."""
    rng = np.random.default_rng(3)
    pool = rng.integers(1, 1 << 62, 900, dtype=np.uint64)
    sets = [np.unique(np.concatenate([pool[:700], rng.choice(pool, k)])) for k in (0, 20, 80, 200)] + [np.unique(rng.choice(pool, k)) for k in (3, 90, 640)]
    drawn = [ngram_join.sketch(s) for s in sets]
    ones = lambda x: sum(int(v).bit_count() for v in x.view(np.uint64))
    columns = [f"{c}_{i}" for i in "12" for c in ("n", "bits", *ngram_join.SKETCH)]
    rows, want = [], []
    for s, a in zip(sets, drawn, strict=True):
        for t, b in zip(sets, drawn, strict=True):
            rows.append([len(s), ones(a), *a.tolist(), len(t), ones(b), *b.tolist()])
            need = -(-80 * (len(s) + len(t)) // 180)
            want.append(len(s) - ones(a & ~b) >= need and len(t) - ones(b & ~a) >= need)
    join = ngram_join.NgramJoin.__new__(ngram_join.NgramJoin)
    join.percent = 80
    able = join._able("1", "2")
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in columns))
    assert [r.able for r in df.select(able.alias("able")).collect()] == want and 7 < sum(want) < len(want)
    assert df.where(able)._jdf.queryExecution().optimizedPlan().toString().count("bit_count") == len(ngram_join.SKETCH)


def test_last_step_of_ngram_join_finds_what_leaders_miss(spark, monkeypatch):
    monkeypatch.setattr(ngram_join.NgramJoin, "_led", lambda self, lists, turn: self.classes.selectExpr("rep AS u", "rep AS v").limit(0))
    rng = random.Random(12)
    bases = [" ".join(words(rng, 120, 9999)) for _ in range(3)]
    data = [(i, near(rng, bases[i % 3], rng.randrange(6))) for i in range(60)]
    sets = {d: shingles(t) for d, t in data}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.component_id for r in ngram_join.near_copies(df).collect()} == closure(sorted(sets), linked)


def thue_morse(n):
    """Words of 2 ** n letters that polynomial hashes modulo 2 ** 64 can't tell from their complement."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_hashes_tell_thue_morse_words_apart(spark):
    one, two = thue_morse(12)
    df = spark.createDataFrame([(1, one), (2, two), (3, " ".join([one] * 20)), (4, " ".join([two] * 20))], "doc_id long, text string")
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_copies(df).collect()} == {(i, 1, i) for i in (1, 2, 3, 4)}
    assert {r.n_removed for r in substring_dedup.repeated_word_digests(df).collect()} == {0}
    raw = spark.createDataFrame([(1, one[:700]), (2, two[:700])], "doc_id long, text string")
    seen = collections.Counter(t[p : p + 400] for t in (one[:700], two[:700]) for p in range(301))
    want = {i: sum(any(seen[t[p : p + 400]] > 1 for p in range(max(0, x - 399), min(x, 300) + 1)) for x in range(700)) for i, t in ((1, one[:700]), (2, two[:700]))}
    assert {r.doc_id: r.n_removed for r in suffix_dedup.repeated_byte_digests(raw).collect()} == want


def test_sketches_bound_overlaps(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 400).astype(np.uint64)
    for k in (1, 30, 200, 399):
        a, b = np.sort(base[:300]), np.sort(base[k:])
        one, two = (ngram_join.sketch(x).tolist() for x in (a, b))
        df = spark.createDataFrame([(*one, *two)], ", ".join(f"{s}{c} long" for s in "ab" for c in ngram_join.SKETCH))
        most = ngram_join._most_shared(F.lit(len(a)), *[[F.col(f"{s}{c}") for c in ngram_join.SKETCH] for s in "ab"])
        assert df.select(most.alias("m")).first().m >= len(np.intersect1d(a, b))


def test_trie_join_equals_plain_overlap():
    rng = random.Random(2)
    for _ in range(60):
        probe = np.array(sorted(rng.sample(range(60), rng.randrange(1, 40))), np.uint64)
        sets = [np.array(sorted(rng.sample(range(60), rng.randrange(1, 40))), np.uint64) for _ in range(rng.randrange(1, 20))]
        sets += [sets[0], probe]
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 60 * len(np.union1d(s, probe))]
        assert sorted(ngram_join.trie_join(probe, sets, 60)) == want


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(5, None), (7, 7)]
    df = spark.createDataFrame(pairs, "u long, v long")
    real = [(a, b) for a, b in pairs if b is not None and a != b]
    want = closure({x for p in real for x in p}, real)
    assert {r.node: r.component for r in components(df).collect()} == want


def test_lines(docs, rows, spark):
    long = "This line has more than forty characters, " + "as it goes on"
    data = [(i, f"{'  ' if i % 2 else ''}{long.upper() if i % 3 == 0 else long}\nown {i}\n{long}") for i in range(6)] + [(90, None), (91, ""), (92, "short\n" * 9)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in lines.line_digests(df).collect()}
    for d, t in data:
        kept = (t or "").split("\n")
        n = len(kept)
        if d < 5:
            kept = [f"own {d}"]
        assert got[d] == (n, n - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()), d
    assert {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}[90] is None
    index = lines.LineRuns(spark, fanout=2)
    batch = lambda *x: spark.createDataFrame([(a, a, d) for a, d in x], "h1 long, h2 long, doc_id long")
    index.add(batch((1, 50), (2, 51)))
    assert sorted(r.h1 for r in index.fresh(batch((1, 40), (3, 41))).collect()) == [3]
    index.add(batch((1, 40), (3, 41)))
    index.add(batch((3, 9), (3, 8)))
    assert sorted((r.h1, r.n_docs, r.top_doc) for r in index.merged().collect()) == [(1, 2, 50), (2, 1, 51), (3, 3, 41)]
    assert [len(level) for level in index.levels] == [1, 1]


def best(counts, capacity):
    """The least number of sequences, by search."""
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    low = [len(items)]

    def place(i, rooms):
        if len(rooms) >= low[0]:
            return
        if i == len(items):
            low[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= items[i]}.values():
            place(i + 1, rooms[:j] + [rooms[j] - items[i]] + rooms[j + 1 :])
        place(i + 1, rooms + [capacity - items[i]])

    place(0, [])
    return low[0]


def test_dominance_keeps_the_optimum():
    rng = random.Random(6)
    for _ in range(150):
        counts = collections.Counter(rng.randrange(1, 20) for _ in range(rng.randrange(1, 9)))
        fixed, rest = packing.reduce_by_dominance(counts, 20)
        assert sum(n for _, n in fixed) + best(rest, 20) == best(counts, 20), counts
        used = collections.Counter()
        for pattern, n in packing.plan_packing(counts, 20):
            assert sum(pattern) <= 20
            used.update({s: n * pattern.count(s) for s in set(pattern)})
        assert used == counts


def test_packing(docs, rows, spark):
    from tokenizers import Tokenizer

    path = public_tokenizer("word_bpe_49k.json")
    odd = [(501, "Don't ΑΣ. İstanbul... <|endoftext|> it's 3,14!! a.b,c ﬁ e\u0301 日本"), (502, "hello, world!.,"), (503, "!!! ... ,,,")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = packing.pack_documents(df, path, 64).collect()
    encode = Tokenizer.from_file(path).encode
    want = {}
    for d, t in [(r[0], r[1]) for r in rows] + odd:
        ids = np.array(encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 64):
            want[d, k // 64] = (k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64].tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    by_sequence = collections.defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack_documents(empty(spark), path).count() == 0
    same = spark.createDataFrame([(i, "alike") for i in range(500)], "doc_id long, text string")
    assert packing.pack_documents(same, path, 7).select("sequence_id").distinct().count() <= 167 + 84


class Counting:
    """A tokenizer that counts the characters it encodes."""

    def __init__(self, tokenizer):
        self.tokenizer, self.seen = tokenizer, 0

    def __getattr__(self, name):
        return getattr(self.tokenizer, name)

    def encode_batch_fast(self, texts, **how):
        self.seen += sum(map(len, texts))
        return self.tokenizer.encode_batch_fast(texts, **how)


def test_packing_encodes_letters_once(monkeypatch):
    import tokenizers

    path = public_tokenizer("word_bpe_49k.json")
    made = tokenizers.Tokenizer.from_file(path)
    counting = Counting(made)
    monkeypatch.setattr(common, "_kept", {})
    monkeypatch.setattr(tokenizers, "Tokenizer", type("T", (), {"from_file": staticmethod(lambda _: counting)}))
    words = [a + b + c for a in ("über", "wort", "straß") for b in ("haus", "ähn", "ing") for c in ("lich", "keit", "ß", "ñor")]
    signs = ["", ".", "***", "$$$", "###", "%%%", "&&&", ",%%%", "?!", ";:"]
    text = " ".join(w + s for w in [*words, *map(str.title, words)] for s in signs)
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array([text, None])], ["doc_id", "text"])
    (got,) = packing.pieces_of(path, 1 << 20, 0)(iter([batch]))
    ids = np.array(made.encode(text, add_special_tokens=False).ids + [0], "<u4")
    assert got.column("length").to_pylist() == [len(ids), 1]
    assert got.column("ids_crc32")[0].as_py() == zlib.crc32(ids.tobytes())
    assert counting.seen < 2 * sum(map(len, words))


def test_packing_forgets_what_is_not_used():
    from tokenizers import Tokenizer

    path = public_tokenizer("word_bpe_49k.json")
    encode, ids = Tokenizer.from_file(path).encode, packing.WordIds(path, 20)
    assert [x.tolist() for x in ids.of(pa.array([], pa.string()))] == [[], []]
    for k in range(12):
        words = ["often", "Often,", "3.14", "", "!!!", "a_b", "it's", *(f"{chr(97 + k)}x{chr(97 + i)}{'.!' * (i % 2)}" for i in range(14))]
        want = [encode(w, add_special_tokens=False).ids for w in words]
        flat, sizes = ids.of(pa.array(words))
        assert flat.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
        assert len(ids.numbers) <= 20 + 22 and len(ids.numbers) == len(ids.used) == len(ids.bounds) - 1


def test_packing_keeps_separators(spark):
    from tokenizers import Tokenizer

    path = public_tokenizer("word_bpe_49k.json")
    texts = [f"ab{c}cd, {c} e{c}. {c}{c}" for c in map(chr, range(0x1C, 0x20))] + ["\x1c\x1d \x1e\x1f", "a" + "".join(map(chr, range(0x21))) + "b\x85\xa0c\u2028d\u3000e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encode = Tokenizer.from_file(path).encode
    ids = [np.array(encode(t, add_special_tokens=False).ids + [0], "<u4") for t in texts]
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack_documents(df, path).collect()}
    assert got == {i: (len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)}


def test_language_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = QUERIES["op7_language_id"](spark, SF).join(docs, "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9
    model = langid.fit(docs)
    english = docs.where("lang = 'en' and n_chars > 800").orderBy("doc_id").first().text[:800]
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 + 3 !"), (4, english)], "doc_id long, text string")
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[4].lang_pred == "en" and 0 <= got[4].score <= 1
    assert [r.doc_id for r in langid.keep_identified(odd, model).collect()] == [4]
    assert {r.lang_pred for r in langid.predict(odd, langid.fit(empty(spark))).collect()} == {"und"}


def test_language_id_of_few_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang is not null")
    few = docs.where(F.size(F.split(F.trim("text"), r"\s+")) <= 5).where(F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang").cache()
    model = langid.fit(docs.join(few, "doc_id", "left_anti"))
    n = few.count()
    found = langid.predict(few, model, 0.002).join(few, "doc_id")
    assert n > 50 and found.where("score = 0").count() > n / 2
    assert found.where("lang = lang_pred").count() >= 0.95 * n
    assert langid.keep_identified(few, model, 0.002).count() == n
    odd = spark.createDataFrame([(1, "日本"), (2, "1 + 2"), (3, "Eser thed nt of.")], "doc_id long, text string")
    assert [(r.lang_pred, r.score) for r in langid.predict(odd, model, 0.002).orderBy("doc_id").collect()] == [("en", 0.0), ("und", 0.0), ("en", 0.0)]
    small = langid.CompressionModel({"aa": b"one two three four", "bb": b"uno dos tres cuatro"}, rows={"aa": 1, "bb": 2})
    assert [small.likeliest(t, ["aa", "bb"]) for t in ("three", "tres", "xyz")] == ["aa", "bb", "bb"]


def test_fingerprints(docs, rows):
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(docs).collect()}
    order = sorted(((d, t or "") for d, t, *_ in rows), reverse=True)
    entries = lambda r: [tuple(x.split("@")) for x in r.fingerprint.split()]
    for i, (d, t) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (got[d].n_chars, got[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[d].near_edited <= 1 and 0 <= got[d].near_next <= 1
        pos = [int(p) for _, p in entries(got[d])]
        n = len(t.split())
        if n >= 5:  # every window of 16 grams has an entry
            marks = set(pos)
            assert all(any(q in marks for q in range(p, p + 16)) for p in range(max(n - 4 - 15, 0)))
    by_text = collections.defaultdict(set)
    for d, t in order:
        by_text[t].add(got[d].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_winnow_takes_the_rightmost_least(spark):
    rng = random.Random(1)
    for _ in range(5):
        hashes = [rng.randrange(6) << 40 for _ in range(60)]
        df = spark.createDataFrame([(hashes,)], "g array<long>")
        got = [(x.pos, x.hash) for x in df.select(fingerprints.winnow(F.col("g"), 7).alias("w")).first().w]
        want = []
        for i in range(60 - 6):
            part = hashes[i : i + 7]
            p = max(j for j in range(7) if part[j] == min(part)) + i
            if (p, hashes[p]) not in want:
                want.append((p, hashes[p]))
        assert got == want


def test_urls(spark):
    data = [(1, "http://a.b.NET/x?y#z"), (2, "https://Example.net/en/1"), (3, "https://m.example.net/enx"), (4, "http://example.com/de/"), (5, "http://q.org/fr/a/b")]
    data += [(6, "http://xnet/"), (7, None), (8, "no scheme"), (9, "ftp://net"), (10, "http://h.info?a=1"), (11, "x://y.net/a://b"), (11, "x://y.net/a://b")]
    data += [(100 + i, f"http://{'bad' if i % 2 else 'good'}.info/p/{i}?k={i}") for i in range(60)]
    pages = spark.createDataFrame(data, "page_id long, url string").withColumn("rule", F.lit("clash"))
    labels = spark.createDataFrame([(100 + i, None if i == 7 else i % 2 == 0, 0) for i in range(40)], "doc_id long, q boolean, toxic int").selectExpr("doc_id", "int(q) quality", "toxic")
    got = {r.page_id: r for r in urls.judge(pages, labels, URL_RULES).collect()}
    assert [(got[i].rule, got[i].verdict) for i in (1, 2, 3, 4, 5)] == [("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"), ("org/fr/", "allow")]
    assert (got[1].host, got[1].path) == ("a.b.net", "/x") and (got[10].host, got[10].path) == ("h.info", "")
    assert all((got[i].host, got[i].path, got[i].verdict) == ("", "", "allow") for i in (7, 8))
    assert got[6].rule is None and got[9].rule is None
    assert all(got[100 + i].verdict == ("block" if i % 2 else "allow") for i in range(60))
    assert urls.judge(pages, labels.limit(0), URL_RULES).count() == len(data)


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(30, 16))
    data = []
    for i in range(300):
        v = base[rng.integers(30)] + rng.normal(size=16) * rng.choice([0, 0.1, 0.3])
        data.append((i, v.astype(np.float32).tolist(), int(rng.integers(3))))
    data += [(300, None, 1), (301, [0.0] * 16, 1), (302, [1.0, None] * 8, 1), (303, [float("nan")] * 16, 1), (304, data[0][1], None), (305, [1.0, 2.0], 1), (306, data[0][1], data[0][2])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").repartition(4)
    got = {r.vec_id: r for r in embeddings.near_duplicates(df, pivots=32, chunk=20).collect()}
    good = {i: (np.array(v, np.float64) / np.linalg.norm(v), lab) for i, v, lab in data if i not in (300, 301, 302, 303, 304, 305)}
    linked = [(a, b) for a in good for b in good if a < b and good[a][1] == good[b][1] and good[a][0] @ good[b][0] >= 0.93]
    want, n = closure([i for i, *_ in data], linked), collections.Counter(x for p in linked for x in p)
    found = sum(r.n_links for r in got.values()) / (2 * len(linked))
    assert 0.9 <= found <= 1
    assert all(got[i].n_links <= n[i] and got[i].kept == (got[i].component_id == i) for i, *_ in data)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in range(300, 306))
    if found == 1:
        assert {i: r.component_id for i, r in got.items()} == want


def test_sentencepiece(docs, rows, spark):
    import sentencepiece

    path = public_tokenizer("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(9)
    odd = ["".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "漢", "x" * rng.randint(1, 90), "0", "ing", "\t", "🙂", "<s>", "<0x41>"]) for _ in range(rng.randint(0, 30))) for _ in range(150)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 1000)), "doc_id long, text string"))
    encoded = pieces.encode(df, path)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    back = {r.doc_id: r.text for r in pieces.decode(encoded, path).collect()}
    for d, t in [(r[0], r[1] or "") for r in rows] + list(enumerate(odd, 1000)):
        assert got[d] == own.encode(t), t
        assert back[d] == t
    assert all(r.round_trip for r in pieces.round_trips(df, path).collect())


@pytest.mark.parametrize(
    "run",
    [
        suffix_dedup.repeated_byte_digests,
        suffix_dedup.remove_repeats,
        substring_dedup.repeated_word_digests,
        ngram_join.near_copies,
        ngram_join.keep_one,
        lines.line_digests,
        lines.dedup_lines,
        fingerprints.edited_fingerprints,
        lambda d: pieces.round_trips(d, public_tokenizer("piece_bpe_32k.model")),
        lambda d: embeddings.near_duplicates(d.selectExpr("doc_id vec_id", "cast(null as array<float>) embedding", "1 label")),
    ],
)
def test_empty_tables(spark, run):
    assert run(empty(spark)).count() == 0


def test_repeated_rows(spark):
    text = " ".join(words(random.Random(8), 100))
    df = spark.createDataFrame([(1, text), (1, text), (2, "other words here")], "doc_id long, text string")
    assert [r.n_removed for r in suffix_dedup.repeated_byte_digests(df).where("doc_id = 1").collect()] == [len(text)] * 2
    assert substring_dedup.repeated_word_digests(df).count() == 3
    assert [r.component_id for r in ngram_join.near_copies(df).where("doc_id = 1").collect()] == [1, 1]
    assert lines.line_digests(df).count() == 3
    assert fingerprints.edited_fingerprints(df).count() == 3


def test_clashing_columns_stay(spark):
    text = "word " * 200
    df = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    for n in ("_r", "_cover", "_of", "_drops", "r", "a"):
        df = df.withColumn(n, F.lit(n))
    for run in (suffix_dedup.remove_repeats, lines.dedup_lines, ngram_join.keep_one):
        found = run(df)
        assert found.columns == df.columns and {r["_drops"] for r in found.collect()} == {"_drops"}


def test_fingerprints_of_wide_and_null_ids(spark):
    ids = [-(1 << 63) + 1, -5, 0, 7, (1 << 63) - 1]
    df = spark.createDataFrame([(d, f"text {i} of a few words more") for i, d in enumerate(ids)] + [(None, "no id here")], "doc_id long, text string")
    got = {r.doc_id: r.edited_sha256 for r in fingerprints.edited_fingerprints(df).collect()}
    order = [(d, f"text {ids.index(d)} of a few words more") for d in sorted(ids, reverse=True)] + [(None, "no id here")]
    for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        assert got[d] == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest(), d


def test_line_keys_on_bytes_count_code_points():
    """Keys equal those of plain strings, and are long by code points, not bytes."""
    texts = ["Ä" * 39, "Ä" * 40, "ÀB" * 20, " \x0b" + "x" * 39 + "é\r", " " + "y" * 39, "𝒜" * 10, "𝒜" * 40, "\u0085" + "Q" * 38, "", "A\nB\n\nÉ"]
    for text in texts:
        plain = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r")) for x in text.split("\n")]
        keys = lines._keys(text.encode())
        assert [k.decode() for k in keys] == plain
        assert [lines._is_long(k, 40) for k in keys] == [len(k) >= 40 for k in plain]
