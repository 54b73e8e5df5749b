"""Document fingerprints by winnowing, in DataFrame functions only.

k-grams of words are hashed as the gram rolls over the text, the least hash of each window of grams is
kept (the rightmost of equal ones) with its position. Texts that share ``window + k - 1`` words in a row
share a fingerprint entry whatever surrounds these words, and no match of fewer than ``k`` words counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import only, partitions

_LAST = (1 << 31) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body uses it in a lambda."""
    return F.transform(F.array(value), body)[0]


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")
    return F.transform(words, lambda x: F.xxhash64(x))


def gram_hashes(hashes: Column, k: int) -> Column:
    """A hash for each ``k`` words in a row; the whole sequence as one gram where there are fewer."""

    def grams(h: Column) -> Column:
        rolled = F.transform(F.slice(h, 1, F.greatest(F.size(h) - (k - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))
        return F.when(F.size(h) >= k, rolled).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(rolled)

    return _let(hashes, grams)


def _least_with(step: int) -> Callable[[Column], Column]:
    """Each number against the one ``step`` places on; the last ones stay as they are."""
    return lambda m: F.zip_with(m, F.slice(m, step + 1, F.size(m)), lambda a, b: F.least(a, b))


def winnow(grams: Column, window: int) -> Column:
    """Array of (pos, hash): the least gram of each window, the rightmost of equal ones."""

    def chosen(g: Column) -> Column:
        # Order by hash, then from right to left, in one number; its least over a window is the choice.
        keys = F.transform(g, lambda x, i: F.shiftleft(F.shiftrightunsigned(x, 32), 31).bitwiseOR(F.lit(_LAST) - i))
        width = 1
        while width < window:
            step = min(width, window - width)
            keys = _let(keys, _least_with(step))
            width += step
        whole = F.slice(keys, 1, F.greatest(F.size(g) - (window - 1), F.lit(1)))
        where = F.transform(F.array_distinct(whole), lambda x: (F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST))).cast("int"))
        return F.transform(where, lambda p: F.struct(p.alias("pos"), F.get(g, p).alias("hash")))

    return _let(grams, chosen)


def fingerprint(text: Column, k: int = 5, window: int = 16) -> Column:
    """Fingerprint of a text as an array of (pos, hash); empty for null texts and texts without words."""
    return winnow(gram_hashes(word_hashes(text), k), window)


def as_text(fp: Column) -> Column:
    return F.concat_ws(" ", F.transform(fp, lambda x: F.concat(F.lower(F.hex(x["hash"])), F.lit("@"), x["pos"].cast("string"))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the hashes of two fingerprints; 1 if both are empty."""
    one, two = F.transform(a, lambda x: x["hash"]), F.transform(b, lambda x: x["hash"])
    union = F.size(F.array_union(one, two))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(one, two)) / union)


def with_next(docs: DataFrame, key: str, names: dict[str, str]) -> tuple[DataFrame, Callable[[DataFrame, dict[str, str]], DataFrame], Callable[[DataFrame], DataFrame]]:
    """Each row beside its successor in descending order of ``key``; after the last row comes the first.

    Rows are dealt into ranges of the key between its quantiles, as many as shuffle partitions. A copy of the first row of
    the next range ends each range as its guest, so successors need one shuffle and no global order.
    Null keys come last; equal keys are ordered by the columns in ``names``.
    Returns the rows, a function that adds the successors' values of columns, and one that drops guests.
    """
    spark = docs.sparkSession
    order = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    parts = partitions(spark)
    bounds = docs.agg(F.percentile_approx(key, [i / parts for i in range(1, parts + 1)], 20 * parts)).first()[0] or []
    # The number of quantiles below the id: a larger id never gets a smaller range.
    ends = F.array(*[F.lit(b) for b in sorted(set(bounds))]).cast("array<long>")
    bucket = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(F.size(F.filter(ends, lambda b: b < F.col(key)))).cast("long")
    rows = docs.withColumn("_order", order).withColumn("_range", bucket)
    heads = rows.select("_order", "_range").groupBy("_range").agg(F.max("_order").alias("_order")).collect()  # a row a range
    heads = sorted((r["_range"], r["_order"]) for r in heads)
    above = [(o, heads[(i + 1) % len(heads)][0]) for i, (_, o) in enumerate(heads)]
    guests = spark.createDataFrame(above, "_order long, _host long")
    lent = rows.join(F.broadcast(guests), "_order").withColumn("_range", F.col("_host")).drop("_host")
    both = rows.withColumn("_guest", F.lit(False)).unionByName(lent.withColumn("_guest", F.lit(True)))
    window = Window.partitionBy("_range").orderBy("_guest", F.col("_order").desc(), *[F.col(c) for c in names])

    def add(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        return df.withColumns({new: F.lead(old).over(window) for old, new in columns.items()})

    return add(both, names), add, lambda df: df.where(~F.col("_guest")).drop("_guest", "_order", "_range")


def edited_fingerprints(docs: DataFrame, k: int = 5, window: int = 16) -> DataFrame:
    """Fingerprint every text and its edit: the second half gives way to the start of the next document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts
    count as empty. The next document is the one before it by doc_id (the largest, after the smallest);
    null ids come last, and rows with equal ids are ordered by text. An empty table gives no rows.
    """
    docs = only(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    rows, add, done = with_next(docs, "doc_id", {"text": "next_text"})
    rows = add(rows.withColumn("fp", fingerprint(F.col("text"), k, window)), {"fp": "next_fp"})
    rows = done(rows).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", edited.alias("edited"))
    rows = rows.withColumn("edited_fp", fingerprint(F.col("edited"), k, window))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
