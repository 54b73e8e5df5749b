"""Language identification by compression against per-language dictionaries."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import forget, only, slices, small_batches

UNKNOWN = "und"
GRAM = 4
#: Likelihood of a gram that no dictionary has.
UNSEEN = 1e-6


def _grams(text: str) -> Iterator[str]:
    padded = f" {' '.join(text.split())} "
    return (padded[i : i + GRAM] for i in range(max(1, len(padded) - GRAM + 1)))


@lru_cache(maxsize=64)
def _gram_counts(raw: bytes) -> Counter[str]:
    return Counter(_grams(raw.decode("utf-8", "replace")))


@dataclass(frozen=True)
class CompressionModel:
    """Raw-content dictionaries by language; all that a task needs to classify."""

    dictionaries: dict[str, bytes]
    level: int = 5
    block: int = 4000
    rows: dict[str, int] = field(default_factory=dict)  # labelled rows by language

    def likeliest(self, text: str, langs: list[str]) -> str:
        """The one of ``langs`` whose dictionary's 4-grams make the text likeliest; the commonest if none has any of them."""
        grams, found = Counter(_grams(text)), []
        for lang in langs:
            counts = _gram_counts(self.dictionaries[lang])
            # What isn't seen is as unlikely in a short dictionary as in a long one.
            share = 0.9 / max(1, counts.total())
            found.append((sum(n * math.log(counts[g] * share + UNSEEN) for g, n in grams.items()), any(g in counts for g in grams), lang))
        if any(seen for _, seen, _ in found):
            return min(found, key=lambda x: (-x[0], x[2]))[2]
        return min(langs, key=lambda x: (-self.rows.get(x, 0), x))

    def classifier(self):
        """Function from a text to (language or None, score, whether two languages or more share the smallest size)."""
        import zstandard as zstd

        encoders, none = [], zstd.ZstdCompressor(level=self.level, write_content_size=False, write_checksum=False)
        for lang, raw in sorted(self.dictionaries.items()):
            known = zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=self.level)
            encoders.append((lang, zstd.ZstdCompressor(level=self.level, dict_data=known, write_content_size=False, write_checksum=False)))
        block = self.block

        def classify(text: str | None) -> tuple[str | None, float]:
            if not encoders or not text or not any(map(str.isalpha, text)):
                return None, 0.0, False
            low = text.lower()
            raw = low.encode("utf-8", "replace")
            parts = [raw[i : i + block] for i in range(0, len(raw), block)]
            # A dictionary that misleads costs more than none: a short one, which can't, would win. So none is offered to all.
            plain = [len(none.compress(p)) for p in parts]
            sizes = sorted((sum(min(len(e.compress(p)), n) for p, n in zip(parts, plain, strict=True)), lang) for lang, e in encoders)
            if len(sizes) == 1:
                return sizes[0][1], 1.0, False
            if sizes[0][0] == sizes[1][0]:
                return self.likeliest(low, [lang for n, lang in sizes if n == sizes[0][0]]), 0.0, True
            return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0], False

        return classify


def fit(labelled: DataFrame, per_language: int = 150, level: int = 5, budget: int = 240_000) -> CompressionModel:
    """Learn a dictionary a language from a bounded sample of labelled rows (doc_id, text, lang).

    The sample: about ``per_language`` rows of each language, those whose id hashes lowest, and ``budget`` characters of each at
    most; this is the documented bound of what reaches the driver. Each language has the same budget of bytes, so that
    no dictionary is better for being larger; a rare language's stays shorter, which changes nothing for the others. Rows
    with null text or language are never used, nor are language names equal to ``und``; an empty table gives a model
    that knows no language.
    """
    rows = only(labelled, "doc_id", "text", "lang").where("text is not null and lang is not null and lang <> 'und'")
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a row a language
    if not counts:
        return CompressionModel({}, level)
    # A share of each language that holds twice the wanted number on average; all rows of a rare one.
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30))
    limit = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1 << 30, (2 * per_language << 30) // n + 1))])
    picked = rows.where(spread < limit[F.col("lang")]).select("lang", spread.alias("h"), "doc_id", F.substring("text", 1, budget).alias("text")).collect()
    texts: dict[str, list[bytes]] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["h"], r["doc_id"] or 0, r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"].lower().encode("utf-8", "replace"))
    found: dict[str, bytes] = {}
    for lang, t in texts.items():
        own = b"\n".join(t[:per_language])[:budget]
        if own.strip():
            found[lang] = own * -(-8 // len(own))  # the shortest dictionary that the library takes
    return CompressionModel(found, level, rows=counts)


def predict(docs: DataFrame, model: CompressionModel, min_margin: float = 0.0) -> DataFrame:
    """doc_id, lang_pred, score, rejected for each row; score is the margin 1 - smallest / second smallest size.

    Null texts and texts without a letter get ``und`` and score 0 and are rejected. Texts whose margin is under ``min_margin`` but not
    0 are rejected too, and keep the language found and their score. Texts of any length are compressed whole, in blocks. Repeated rows are
    judged alike, null and equal ids do no harm, and an empty table gives an empty result. Equal sizes say nothing (in a few words there is no match worth coding), so they are no narrow
    margin: among the languages that share the smallest size, the one whose 4-grams fit best is taken, with
    score 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        classify = model.classifier()
        for batch in slices(batches, "text", 8 << 20):
            found = [classify(t) for t in batch.column("text").to_pylist()]
            langs, scores = [lang or UNKNOWN for lang, _, _ in found], [s for _, s, _ in found]
            rejected = [lang is None or (not tied and s < min_margin) for lang, s, tied in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"]
            )

    small_batches(docs.sparkSession)
    return only(docs, "doc_id", "text").mapInArrow(run, docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean"))


def keep_identified(docs: DataFrame, model: CompressionModel, min_margin: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language ``predict`` identifies, all columns kept, in one pass and without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        classify = model.classifier()
        for batch in slices(batches, "text", 8 << 20):
            found = (classify(t) for t in batch.column("text").to_pylist())
            yield batch.filter(pa.array([lang is not None and (tied or s >= min_margin) for lang, s, tied in found], pa.bool_()))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
