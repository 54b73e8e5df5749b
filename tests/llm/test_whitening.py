"""Whitening against plain integer arithmetic and a dense eigendecomposition."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=120, size=6, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 1 + d) for d in range(size)], i % 3) for i in range(n)]
    rows += [(1000 + i, rows[i][1], 0) for i in range(10)] + [rows[5], (None, rows[6][1], 1)]
    return rows + [(2000, None, 0), (2001, [None, *rows[0][1][1:]], 0), (2002, [float("nan")] * size, 0), (2003, [float("inf")] * size, 0), (2004, [], 0)]


def plain(rows, components):
    """(id, x) of the usable rows; n and sums; components and eigenvalues."""
    usable = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in usable]
    fit = sorted({x for _, x in xs})
    n, size = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(size)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return xs, n, sums, values[order], axes.T[order], values.sum()


def test_against_plain_arithmetic(spark):
    rows = vectors()
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"x": F.lit("clash"), "n": F.lit(1), "id": F.lit(None)}).repartition(5)
    got = whitening.whiten(frame).collect()
    xs, n, sums, values, axes, trace = plain(rows, 4)
    assert len(got) == 4 * len(xs)
    by_id = {}
    for r in got:
        by_id.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, x in xs:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(4):
            want = sum((a - s / n) * c for a, s, c in zip(x, sums, axes[k], strict=True)) / math.sqrt(values[k])
            for r in by_id[i, k + 1]:
                if abs(want) > 1e-6:
                    signs.setdefault(k, np.sign(want * r.whitened))
                assert r.n == n and r.deviation == deviation
                assert r.whitened == pytest.approx(signs.get(k, 1) * want, abs=1e-8)
                assert r.explained == pytest.approx(values[k] / trace, rel=1e-9)
                assert 0 <= r.identity_error < 1e-9
    assert len({r.identity_error for r in got}) == 1


def test_lengths_and_what_does_not_vary(spark):
    rows = [(i, [float(i % 4), 1.0, -2.5], 0) for i in range(12)] + [(50, [1.0, 2.0], 0), (51, [1.0, 2.0], 0), (60, [-0.0, 3e38, -3e38], 1)]
    got = whitening.whiten(spark.createDataFrame(rows[:-1], SCHEMA)).collect()
    long, short = [r for r in got if r.vec_id < 50], [r for r in got if r.vec_id >= 50]
    assert {r.n for r in long} == {4} and {r.n for r in short} == {1}
    assert {(r.component, r.whitened is None) for r in long} == {(1, False), (2, True), (3, True)}
    assert [r.explained for r in long if r.component == 1] == pytest.approx([1.0] * 12)
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in short) and len(short) == 4
    # Entries whose steps are beyond a long are held to its ends; deviations beyond it are null.
    wide = [r for r in whitening.whiten(spark.createDataFrame([rows[0], rows[1], rows[-1]], SCHEMA)).collect() if r.vec_id == 60]
    assert len(wide) == 3 and all(r.deviation is None and r.n == 3 for r in wide)


def test_empty_table(spark):
    none = whitening.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA))
    assert none.collect() == []
    assert none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whole_table_query(spark):
    from millrace.llm.queries import QUERIES

    found = QUERIES["op11_embedding_whitening"](spark, "/root/testdata/sf0.001").toPandas()
    wide = found.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.cov(wide.T, bias=True) - np.eye(4)).max() < 1e-6 or found["n"].iloc[0] != len(wide)
