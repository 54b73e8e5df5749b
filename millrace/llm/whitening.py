"""Whitening of embeddings: the Gramian of exactly centred rows, its eigenvectors, and rows projected on them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import only, small_batches, stored

#: Entries are counted in steps of 1 / SCALE.
SCALE = 256
_FITS = 1 << 62


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def steps(vector: Column) -> Column:
    """The entries as whole steps; what is beyond a long is held to its ends."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


@dataclass(frozen=True)
class Whitening:
    """What the distinct vectors of one length have in common; ``axes`` are the first components, a row each."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    axes: np.ndarray
    trace: float


def _block(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), np.int64).reshape(len(rows), -1)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """n * x - S without error: as longs where they suffice, else as Python's integers."""
    most = max(abs(int(x.min(initial=0))), int(x.max(initial=0)))
    if n * most + max(map(abs, sums), default=0) < _FITS:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sums(fit: DataFrame) -> tuple[int, tuple[int, ...]]:
    """The number of rows and the exact sums by dimension; each batch of each task is summed before anything is sent."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _block(batch["x"])
            # In halves, so that no sum of a batch is beyond a long.
            yield pd.DataFrame({"n": len(x), "dim": np.arange(x.shape[1]), "high": (x >> 32).sum(0), "low": (x & 0xFFFFFFFF).sum(0)})

    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    rows = fit.mapInPandas(run, "n long, dim int, high long, low long").groupBy("dim").agg(total("n"), total("high"), total("low")).orderBy("dim").collect()
    return int(rows[0].n), tuple((int(r.high) << 32) + int(r.low) for r in rows)


def _gram(rows: DataFrame, column: str, width: int) -> np.ndarray:
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(array_to_vector(column).alias(column)), column)
    return RowMatrix(vectors, 0, width).computeGramianMatrix().toArray()


def fit(distinct: DataFrame, size: int, components: int) -> Whitening:
    """The whitening of ``distinct`` (x: arrays of ``size`` longs, each once).

    The driver holds the sums and a square matrix of the dimension, nothing that grows with the rows. The covariance is the
    Gramian of (n * x - S) / n, whose numerators are exact, over n.
    """
    n, sums = _sums(distinct)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"c": list(_centred(_block(batch["x"]), n, sums).astype(np.float64) / n)})

    covariance = _gram(distinct.mapInPandas(run, "c array<double>"), "c", size) / n
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    # Values this small are the rounding of a zero: nothing varies there.
    noise = max(values.max(initial=0), 0) * size * np.finfo(np.float64).eps
    return Whitening(n, sums, np.where(values[order] > noise, values[order], 0), axes.T[order], float(np.trace(covariance)))


def project(rows: DataFrame, model: Whitening, *keep: str) -> DataFrame:
    """``keep`` of ``rows`` (x), with deviation and the whitened components in order (null where a component doesn't vary).

    The model, of the size of the components times the dimension, goes to the tasks as a broadcast variable.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        scale = np.sqrt(m.values, where=m.values > 0, out=np.ones_like(m.values))
        for batch in batches:
            diff = _centred(_block(batch["x"]), m.n, m.sums)
            white = (diff.astype(np.float64) / m.n) @ m.axes.T / scale
            far = max(abs(int(diff.min(initial=0))), abs(int(diff.max(initial=0))))
            exact = diff if diff.shape[1] * far * far < _FITS else diff.astype(object)
            whole = [int(s) if s < 1 << 63 else None for s in (exact * exact).sum(1)] if len(diff) else []
            out = batch[list(keep)].astype(object)
            out["deviation"] = pd.array(whole, "Int64")
            out["whitened"] = [[float(v) if on else None for v, on in zip(r, m.values > 0, strict=True)] for r in white]
            yield out

    kept = rows.select(*keep)
    return rows.mapInPandas(run, T.StructType([*kept.schema.fields, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]))


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """The largest entry by which the covariance of the whitened ``distinct`` is off the identity; None without a component that varies."""
    alive = [i for i, v in enumerate(model.values) if v > 0]
    if not alive:
        return None
    white = stored(project(distinct, model).select(F.array(*[F.col("whitened")[i] for i in alive]).alias("w")), "whitened")
    means = white.agg(*[F.avg(F.col("w")[i]) for i in range(len(alive))]).first()
    centred = white.select(F.array(*[F.col("w")[i] - F.lit(m) for i, m in enumerate(means)]).alias("w"))
    return float(np.abs(_gram(centred, "w", len(alive)) / model.n - np.eye(len(alive))).max())


def whiten(embeddings: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component.

    Vectors that are null or hold null or non-finite entries are left out; so are empty ones, which have no component. Each
    distinct vector counts once in the fit, however often it is there, and all its rows get the same result. Vectors of
    different lengths have no space in common: each length is whitened by itself, in turn (a table has few). Components number from 1
    by falling variance, as many as the dimension allows. Where nothing varies, ``whitened`` is null, and with a variance of
    zero overall so are ``explained`` and ``identity_error``. ``deviation`` is null where it is beyond a long. Null ids are
    ids like others; extra columns are passed over; a table without a usable vector gives no row.
    """
    spark = embeddings.sparkSession
    small_batches(spark)
    source = only(embeddings, id_col, vector_col).where(usable(F.col(f"`{vector_col}`")) & (F.size(f"`{vector_col}`") > 0))
    rows = source.select(F.col(f"`{id_col}`").alias("id"), steps(F.col(f"`{vector_col}`")).alias("x"))
    distinct = stored(rows.select("x").distinct(), "whitening-fit")
    sizes = sorted(r[0] for r in distinct.select(F.size("x")).distinct().collect())
    found = None
    for size in sizes:
        ours = distinct.where(F.size("x") == size)
        model = fit(ours, size, components)
        error = identity_error(ours, model)
        each = project(rows.where(F.size("x") == size), model, "id").select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        shares = F.array(*[F.lit(float(v) / model.trace if model.trace > 0 else None).cast("double") for v in model.values])
        part = each.select(
            F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
            shares[F.col("at")].alias("explained"), F.lit(error).cast("double").alias("identity_error"),
        )
        found = part if found is None else found.unionByName(part)
    if found is not None:
        return found
    schema = T.StructType([T.StructField(id_col, rows.schema["id"].dataType)]).add("component", "integer").add("n", "long").add("deviation", "long")
    return spark.createDataFrame([], schema.add("whitened", "double").add("explained", "double").add("identity_error", "double"))
