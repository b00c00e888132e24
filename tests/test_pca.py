"""Subspace iteration against the exact decomposition of the whole product."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.operators.pca import pca


def exact(g):
    """g: samples x variants, nan missing; eigenvalues, vectors and trace of Z'Z / variants."""
    g = g[:, ~np.isnan(g).all(0)]
    p = np.nanmean(g, 0) / 2
    s = np.sqrt(2 * p * (1 - p))
    z = np.where(np.isnan(g) | (s == 0), 0, (g - 2 * p) / np.where(s == 0, 1, s))
    gram = z @ z.T / g.shape[1]
    val, vec = np.linalg.eigh(gram)
    return val[::-1], vec[:, ::-1], gram.trace()


@pytest.mark.parametrize("n,m,k", [(60, 200, 4), (5, 40, 10), (30, 3, 5)])
def test_equals_the_exact_decomposition(spark, n, m, k):
    rng = np.random.default_rng(n)
    half = (np.arange(n) < n // 2)[:, None]
    g = rng.binomial(2, np.where(half, rng.uniform(0.1, 0.9, m), rng.uniform(0.1, 0.9, m))).astype(float)
    g[:, 0] = 1  # no variance beyond the mean
    g[rng.random((n, m)) < 0.1] = np.nan
    rows = [(f"s{i:03}", v, int(g[i, v])) for i in range(n) for v in range(m) if g[i, v] == g[i, v]]
    calls = spark.createDataFrame([*rows, (None, 1, 1), ("s000", None, 1), ("s001", 1, None)], "sample string, variant long, alt_count int").repartition(3)
    got = pca(calls, k).orderBy("sample", "pc").toPandas()
    val, vec, trace = exact(g)
    k = max(1, min(k, n - 1, m - 1))
    assert len(got) == n * k
    assert got[:k]["eigenvalue"].to_numpy() == pytest.approx(val[:k], rel=1e-6)
    assert got[:k]["fraction"].to_numpy() == pytest.approx(val[:k] / trace, rel=1e-6)
    score = got["score"].to_numpy().reshape(n, k)
    for j in range(k):
        if val[j] - val[j + 1] > 0.02 * val[0] and (j == 0 or val[j - 1] - val[j] > 0.02 * val[0]):
            assert abs(score[:, j] @ vec[:, j]) == pytest.approx(1, abs=1e-5)
    assert (score[np.abs(score).argmax(0), np.arange(k)] > 0).all()


def test_an_empty_table_and_a_single_sample(spark):
    none = spark.createDataFrame([], "sample string, variant long, alt_count int")
    assert pca(none).collect() == []
    one = spark.createDataFrame([("a", 1, 1), ("a", 2, 0)], "sample string, variant long, alt_count int")
    assert [(r.sample, r.pc, r.eigenvalue, r.fraction) for r in pca(one).collect()] == [("a", 1, 0.0, 0.0)]


def test_many_samples(spark):
    """Two populations of 20,000 samples fall apart on the first component."""
    s = spark.range(20_000).select(F.col("id").alias("sample"))
    c = s.crossJoin(spark.range(24).select(F.col("id").alias("variant")))
    high = (F.col("sample") % 2 == 0) == (F.col("variant") % 2 == 0)
    calls = c.withColumn("alt_count", F.when(high, 1).otherwise(0) + (F.pmod(F.xxhash64("sample", "variant"), F.lit(10)) == 0).cast("int"))
    got = pca(calls, 1, extra=4).groupBy((F.col("sample") % 2).alias("p"), (F.col("score") > 0).alias("side")).count().collect()
    assert len(got) == 2


def test_eigenvalues_without_gaps_settle(spark):
    """Few samples over many variants without structure: a smaller subspace settles slowly."""
    g = np.random.default_rng(2).binomial(2, 0.4, (40, 3000)).astype(float)
    calls = spark.createDataFrame([(i, v, int(g[i, v])) for i in range(40) for v in range(3000)], "sample long, variant long, alt_count int")
    got = {r.pc: r.eigenvalue for r in pca(calls, 3, iterations=3).select("pc", "eigenvalue").distinct().collect()}
    assert [got[c] for c in (1, 2, 3)] == pytest.approx(exact(g)[0][:3], rel=1e-9)
