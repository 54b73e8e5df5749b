"""Near-duplicate embeddings by a pivot-permutation index with exact verification."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import only, stored
from millrace.llm.components import components

#: Bounds of the sample of reference points of each vector length.
LEAST_PIVOTS, MOST_PIVOTS = 128, 16_384


def _usable() -> Column:
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return F.coalesce(named & ~bad & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def nearest_pivots(reps: DataFrame, pivots: list[np.ndarray], prefix: int) -> DataFrame:
    """Add ``near``: the numbers of the ``prefix`` nearest pivots, nearest first (ties: lower number)."""

    def run(batches):
        by_size = {}
        for i, p in enumerate(pivots):
            by_size.setdefault(len(p), ([], []))
            by_size[len(p)][0].append(i)
            by_size[len(p)][1].append(p / np.linalg.norm(p))
        tables = {d: (np.array(i), np.array(p)) for d, (i, p) in by_size.items()}
        for batch in batches:
            for d in np.unique(pc.list_value_length(batch.column("embedding")).to_numpy()):
                part = batch.filter(pc.equal(pc.list_value_length(batch.column("embedding")), int(d)))
                numbers, table = tables.get(int(d), (np.array([-1]), np.ones((1, int(d)))))
                unit, order = _matrix(part.column("embedding")), []
                for at in range(0, len(unit), rows := max(1, (1 << 22) // len(table))):
                    far = -(unit[at : at + rows] @ table.T)
                    some = np.sort(np.argpartition(far, min(prefix, far.shape[1]) - 1, axis=1)[:, :prefix], axis=1)
                    order.append(np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable"), 1))
                order = np.concatenate(order)
                near = pa.array(list(numbers[order].astype(np.int32)), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, near], [*part.schema.names, "near"])

    return reps.mapInArrow(run, T.StructType([*reps.schema.fields, T.StructField("near", T.ArrayType(T.IntegerType()))]))


def _link_block(threshold: float, shared: int):
    """Links between the two chunks of one inverted list that the list owns."""

    def run(key, table):
        pivot, one, two = key[1].as_py(), key[3].as_py(), key[4].as_py()
        ids, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        chunk, unit = table.column("chunk").to_numpy(), _matrix(table.column("embedding"))
        near = table.column("near").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        left, right = np.flatnonzero(chunk == one), np.flatnonzero(chunk == two)
        found = []
        # Retrieval: how many pivots two descriptions share, from the lists that they are in.
        _, column = np.unique(near, return_inverse=True)
        column = column.reshape(near.shape)
        filed = np.zeros((len(ids), int(column.max(initial=-1)) + 1), np.float32)
        filed[np.arange(len(ids))[:, None], column] = 1
        for at in range(0, len(left), 512):
            rows = left[at : at + 512]
            i, j = np.nonzero(filed[rows] @ filed[right].T >= min(shared, near.shape[1]))
            i, j = rows[i], right[j]
            keep = ids[i] < ids[j] if one == two else slice(None)
            found.append(np.stack([i[keep], j[keep]]))
        i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        keep = []
        for at in range(0, len(i), 1 << 16):
            x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            exact = np.flatnonzero(np.einsum("ij,ij->i", unit[x], unit[y]) >= threshold)
            same = (near[x[exact]][:, :, None] == near[y[exact]][:, None, :]).any(axis=2)
            owner = np.where(same, near[x[exact]], np.iinfo(np.int32).max).min(axis=1)
            found_here = np.zeros(len(x), bool)
            found_here[exact[owner == pivot]] = True
            keep.append(found_here)
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        i, j = i[keep], j[keep]
        links = np.bincount(np.concatenate([i, j]), np.concatenate([copies[j], copies[i]]), minlength=len(ids)).astype(np.int64)
        root = np.arange(len(ids))
        while True:  # the least member of each group within the block
            least = root.copy()
            np.minimum.at(least, i, root[j])
            np.minimum.at(least, j, root[i])
            least = least[least]
            if (least == root).all():
                break
            root = least
        some = np.flatnonzero(links)
        return pa.table({"rep": pa.array(ids[some]), "links": pa.array(links[some]), "other": pa.array(ids[root[some]])})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, pivots: int | None = None, prefix: int | None = None, shared: int = 2, chunk: int = 1024) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding, label).

    A vector is described by its ``prefix`` nearest of ``pivots`` reference points of its length at most, which are vectors
    that are least by hash in as many hash buckets (the documented sample that the index is fitted on; all rows are
    indexed). ``pivots`` is the square root of the number of rows unless given, ``LEAST_PIVOTS`` at least and ``MOST_PIVOTS`` at
    most, so lists grow with that root, and beyond the most with the rows. ``prefix`` is 10, and beyond 1024 pivots grows with the root of
    their number: among more points the nearest ones of two near vectors differ more. Vectors of one label that share ``shared`` pivots or more (as many as there are, if fewer) are then compared
    exactly, in the inverted list of the least pivot that they share; lists are cut into chunks of about ``chunk`` vectors
    and each pair of chunks is a task group of its own, so that no group is larger. Equal vectors are
    compared once and their number counts. Only counts and a forest of links leave a group.

    Rows whose vector, label or id is null, or whose vector is zero or holds null or non-finite numbers,
    link with nothing, nor do vectors of different lengths. Rows that repeat count one by one; a row without an id isn't kept.
    """
    vectors = only(vectors, "vec_id", "embedding", "label")
    rows = stored(vectors.where(_usable()).withColumns({"k1": F.xxhash64("embedding"), "k2": F.hash("embedding")}), "vectors")
    pivots = pivots or min(MOST_PIVOTS, max(LEAST_PIVOTS, math.isqrt(rows.count())))
    prefix = prefix or max(10, round(10 * math.sqrt(pivots / 1024)))
    keys = ["label", "k1", "k2"]
    reps = rows.groupBy(*keys).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    reps = stored(reps, "vector-classes")
    body = rows.join(reps, keys).where("vec_id = rep").dropDuplicates(["rep", *keys]).select("rep", "copies", "label", "embedding")
    drawn = rows.groupBy(F.size("embedding").alias("dim"), F.pmod(F.xxhash64("k1"), F.lit(pivots)).alias("bucket")).agg(F.min_by("embedding", F.struct("k1", "k2")).alias("embedding"))
    sample = drawn.orderBy("dim", "bucket").collect()  # at most `pivots` vectors of each length
    points = [np.array(r["embedding"], np.float64) for r in sample]
    described = stored(nearest_pivots(body, points, prefix), "vector-index")

    filed = described.withColumn("pivot", F.explode("near")).withColumn("dim", F.size("embedding"))
    lengths = described.select("label", F.explode("near").alias("pivot"), F.size("embedding").alias("dim")).groupBy("label", "pivot", "dim").count()
    cut = F.ceil(F.col("count") / F.lit(chunk)).cast("int")
    filed = filed.join(lengths.withColumn("cut", cut), ["label", "pivot", "dim"]).withColumn("chunk", F.pmod(F.xxhash64("rep"), F.col("cut")).cast("int"))
    filed = filed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)))
    blocks = filed.select("label", "pivot", "dim", F.least("chunk", "with").alias("one"), F.greatest("chunk", "with").alias("two"), "rep", "copies", "chunk", "embedding", "near")
    found = blocks.groupBy("label", "pivot", "dim", "one", "two").applyInArrow(_link_block(threshold, shared), "rep long, links long, other long")
    found = stored(found, "vector-links")

    groups = components(found.select(F.col("rep").alias("u"), F.col("other").alias("v")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (
        reps.join(links, "rep", "left")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*keys, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    usable = rows.select("vec_id", *keys).join(known, keys).select("vec_id", "n_links", "component_id")
    rest = vectors.where(~_usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
