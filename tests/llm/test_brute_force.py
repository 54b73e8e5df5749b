"""Fingerprints, mined url verdicts and the recall of the pivot index, each against a plain version."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import embeddings, fingerprints, langid, lines, ngram_join, pieces, substring_dedup, suffix_dedup, urls
from millrace.llm.queries import URL_RULES, public_tokenizer

ALL = (1 << 64) - 1


def fold(numbers):
    """The hash of several longs: each is hashed with the one before as its seed."""
    seed = 42
    for n in numbers:
        seed = xxhash.xxh64_intdigest(n.to_bytes(8, "little"), seed=seed)
    return seed


def plain_fingerprint(text, k=5, window=16):
    hashes = [xxhash.xxh64_intdigest(w, seed=42) for w in text.encode().split()]
    grams = [fold(hashes[i : i + k]) for i in range(len(hashes) - k + 1)] or ([fold(hashes)] if hashes else [])
    found = []
    for start in range(max(1, len(grams) - window + 1) if grams else 0):
        part = range(start, min(start + window, len(grams)))
        at = min(part, key=lambda i: (grams[i] >> 32, -i))
        if at not in found:
            found.append(at)
    return [(grams[at], at) for at in found]


def plain_likeness(a, b):
    one, two = {h for h, _ in a}, {h for h, _ in b}
    return len(one & two) / len(one | two) if one | two else 1.0


def test_fingerprints_recomputed(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in (1, 4, 5, 6, 19, 20, 21, 60, 300)]
    texts += ["", None, " \t\n", "word " * 100, "é漢 " * 40, "x" * 3000, texts[7], texts[8] + " more", "a\x0bb\x0cc\rd e f g"]
    rows = [(i * 7, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    order = [(d, t or "") for d, t in sorted(rows, reverse=True)]
    written = lambda fp: " ".join(f"{h & ALL:x}@{p}" for h, p in fp)
    for (d, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        own, new = plain_fingerprint(t), plain_fingerprint(edited)
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[d].fingerprint, got[d].edited_fingerprint) == (written(own), written(new)), d
        assert got[d].near_edited == pytest.approx(plain_likeness(own, new))
        assert got[d].near_next == pytest.approx(plain_likeness(own, plain_fingerprint(after)))


def test_fingerprints_of_uneven_ids(spark):
    ids = [*range(40), 1 << 62]
    df = spark.createDataFrame([(d, f"some words of text {d}") for d in ids], "doc_id long, text string")
    got = {r.doc_id: r.near_next for r in fingerprints.edited_fingerprints(df).collect()}
    assert sorted(got) == ids and set(got.values()) == {0.0}


def test_mined_verdicts(spark):
    rng = random.Random(8)
    data = []
    for i in range(200):
        parts = [rng.choice(["casino", "news", "blog", "shop"]), rng.choice(["win", "read", "buy"]), rng.choice(["a", "b"])]
        data.append((i, f"http://{rng.choice(['one', 'two', 'three'])}.info/{'/'.join(parts)}?{rng.choice(['k', 'q'])}=1", "casino" in parts and "win" in parts or rng.random() < 0.2))
    data += [(i + 200, u, b) for i, (_, u, b) in enumerate(data[:20])]
    support, confidence = 0.03, 0.6
    pages = spark.createDataFrame([(i, u) for i, u, _ in data], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not b), 0) for i, _, b in data[:120]], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urls.judge(pages, labels, URL_RULES, support, confidence).collect()}

    def tokens(url):
        rest, _, query = url.partition("://")[2].partition("?")
        host, *path = rest.split("/")
        return frozenset([*(f"h:{x}" for x in host.split(".")), *(f"p:{x}" for x in path), f"q:{query.partition('=')[0]}"])

    known = [(tokens(u), b) for _, u, b in data[:120]]
    rules, least = [], max(5, math.ceil(support * len(known)))
    for some in {frozenset(c) for t, _ in known for n in range(1, 4) for c in itertools.combinations(sorted(t), n)}:
        verdicts = [b for t, b in known if some <= t]
        if sum(verdicts) >= least and sum(verdicts) >= confidence * len(verdicts):
            rules.append(some)
    want = {i: "block" if any(r <= tokens(u) for r in rules) else "allow" for i, u, _ in data}
    assert got == want and set(want.values()) == {"block", "allow"}


def test_rows_of_many_tokens_are_mined_whole(spark):
    """A rule of tokens that are the least telling of rows with twenty: none of them is left out."""
    rng = random.Random(4)
    common = [f"t{i:02}" for i in range(20)]
    rows = []
    for i in range(240):
        pair = [x for x in ("y", "z") if rng.random() < 0.5]
        # y and z together are blocked; either alone is less telling than any other token.
        blocked = len(pair) == 2 or (not pair and rng.random() < 0.4)
        rows.append(([*pair, *(x for x in common if rng.random() < (0.9 if blocked else 0.6))], blocked))
    rows += [(None, True), (["y"], None)]
    got = urls.mine_rules(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), 0.02, 0.8).collect()
    known = [(frozenset(t), b) for t, b in rows if t is not None and b is not None]
    want = {}
    for size in (1, 2, 3):
        for some in map(frozenset, itertools.combinations([*common, "y", "z"], size)):
            verdicts = [b for t, b in known if some <= t]
            if sum(verdicts) >= 5 and sum(verdicts) >= 0.8 * len(verdicts) and not any(r < some for r in want):
                want[some] = sum(verdicts) / len(verdicts)
    assert {frozenset(r.antecedent): r.confidence for r in got} == want and frozenset("yz") in want
    assert len(got) == len(want) and any(len(r) == 3 for r in want) and all(r.pivot in r.antecedent for r in got)


def test_mining_of_long_urls_ends(spark):
    """Urls of 40 segments, shared by many labelled pages: tokens are bounded before they are combined."""
    rng = random.Random(3)
    names = [f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]
    data = [(i, "http://long.info/" + "/".join(n for n in names if rng.random() < 0.9), i % 3 == 0) for i in range(60)]
    data += [(60, "http://alone.info/" + "/".join(n[::-1] for n in names), True)]
    pages = spark.createDataFrame([(i, u) for i, u, _ in data], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(not b), 0) for i, _, b in data], "doc_id long, quality int, toxic int")
    got = {r.page_id: r.verdict for r in urls.judge(pages, labels, URL_RULES).collect()}
    assert len(got) == len(data) and got[60] == "allow", "a rule must not rest on one page"


def test_language_sizes_and_margins(spark):
    """Each text against plain compression with the model's dictionaries; a rare language changes nothing for the others."""
    import zstandard as zstd

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rare = spark.createDataFrame([(-i, "qq zz xx yy", "xx") for i in range(1, 5)], docs.schema)
    model, more = langid.fit(docs), langid.fit(docs.unionByName(rare))
    assert {k: v for k, v in more.dictionaries.items() if k != "xx"} == model.dictionaries and len(more.dictionaries["xx"]) < 60
    sizes = [len(d) for d in model.dictionaries.values()]
    assert max(sizes) <= 240_000 and min(sizes) > 200_000
    rows = docs.where("doc_id % 7 = 0").collect()
    got = {r.doc_id: r for r in langid.predict(docs, model, 0.002).collect()}
    encoders = {k: zstd.ZstdCompressor(level=5, dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False) for k, d in model.dictionaries.items()}
    none = zstd.ZstdCompressor(level=5, write_content_size=False, write_checksum=False)
    for r in rows:
        raw = (r.text or "").lower().encode()
        if not any(map(str.isalpha, r.text or "")):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score, got[r.doc_id].rejected) == ("und", 0.0, True)
            continue
        blocks = [raw[i : i + 4000] for i in range(0, len(raw), 4000)]
        first, second, *_ = sorted((sum(min(len(e.compress(b)), len(none.compress(b))) for b in blocks), k) for k, e in encoders.items())
        score = 1 - first[0] / second[0]
        assert got[r.doc_id].score == pytest.approx(score)
        assert got[r.doc_id].rejected == (0 < score < 0.002)
        assert score == 0 or got[r.doc_id].lang_pred == first[1]
    held = [r for r in docs.collect() if r.lang and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    learnt = docs.where("pmod(crc32(cast(cast(doc_id as string) as binary)), 4) <> 2")
    for frame in (learnt, learnt.unionByName(rare)):
        found = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.fit(frame)).collect()}
        assert sum(found[r.doc_id] == r.lang for r in held) >= 0.99 * len(held)


@pytest.mark.parametrize(("pivots", "n"), [(None, 3000), (256, 3000), (1024, 3000), (4096, 7000)])
def test_recall_of_the_pivot_index(spark, pivots, n):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 64))
    vectors = base[rng.integers(300, size=n)] + rng.normal(size=(n, 64)) * rng.choice([0.05, 0.2], size=(n, 1))
    unit = vectors.astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(unit)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, pivots=pivots).where("vec_id % 100 = 0").collect()}
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = {i: int((unit @ unit[i] >= 0.93).sum()) - 1 for i in range(0, n, 100)}
    assert sum(want.values()) > 100
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.9 * sum(want.values())


@pytest.mark.parametrize(
    ("run", "left"),
    [
        (suffix_dedup.repeated_byte_digests, 3),
        (suffix_dedup.remove_repeats, 3),
        (substring_dedup.repeated_word_digests, 3),
        (ngram_join.near_copies, 1),
        (lines.dedup_lines, 3),
        (fingerprints.edited_fingerprints, 3),
        (lambda d: pieces.round_trips(d, public_tokenizer("piece_bpe_32k.model")), 3),
        (lambda d: langid.predict(d, langid.fit(d)), 3),
    ],
)
def test_null_ids(spark, run, left):
    text = "the same forty words and more " * 30
    df = spark.createDataFrame([(None, text), (None, None), (4, text)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    assert run(df).count() == left


def test_vectors_without_ids_are_not_kept(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, None, 1), (3, [1.0, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    assert sorted((r.vec_id is None, r.kept) for r in embeddings.near_duplicates(df).collect()) == [(False, True), (True, False), (True, False)]
