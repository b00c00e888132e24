"""Principal components of genotypes by randomised subspace iteration.

The genotype matrix stays in the executors as blocks of variants, two bits a call. An iteration sends the subspace
(samples x columns) to the blocks, each task multiplies its blocks with it and back, and the products are summed by
ranges of samples. The driver holds samples x (k + extra) numbers and no samples x samples product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cutpoint import cut
from .dedup import numbered

#: Samples whose sums meet in one task, and calls of a block, at most; samples that are few enough to be taken whole.
RANGE, CELLS, WHOLE = 512, 2_000_000, 256


def _pack(n: int, width: int):
    def pack(t: pa.Table) -> pa.Table:
        v, s, g = (t.column(c).to_numpy() for c in ("_v", "at", "g"))
        cell = np.full((width, -(-n // 4) * 4), 3, np.uint8)
        for k in (0, 1, 2):  # of repeated calls the largest counts
            cell[v[g == k] % width, s[g == k]] = k
        cell = cell[(cell < 3).any(1)].reshape(-1, cell.shape[1] // 4, 4)
        return pa.table({"rows": pa.array([len(cell)], pa.int32()), "data": pa.array([(cell << np.array([0, 2, 4, 6], np.uint8)).sum(2).astype(np.uint8).tobytes()], pa.binary())})

    return pack


def standardised(data: bytes, rows: int, n: int) -> np.ndarray:
    """variants x samples of (x - 2p) / sqrt(2p(1-p)), missing calls 0; a variant without variance is all 0."""
    code = (np.frombuffer(data, np.uint8).reshape(rows, -1, 1) >> np.array([0, 2, 4, 6], np.uint8)) & 3
    x = code.reshape(rows, -1)[:, :n]
    called = x < 3
    p = np.where(called, x, 0).sum(1) / np.maximum(called.sum(1), 1) / 2
    scale = np.sqrt(2 * p * (1 - p))[:, None]
    return np.where(called & (scale > 0), (x - 2 * p[:, None]) / np.where(scale > 0, scale, 1), 0)


def _products(q, n: int):
    """For each range of samples the task's sum of Z'Zq, and its share of the trace on range -1."""

    def products(it):
        own, trace = None, 0.0
        for b in it:
            for rows, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                z = standardised(data.as_buffer(), rows, n)
                got = z.T @ (z @ q.value)
                own = got if own is None else own.__iadd__(got)
                trace += float((z * z).sum())
        if own is not None:
            at = range(0, n, RANGE)
            data = [own[lo : lo + RANGE].tobytes() for lo in at] + [np.float64(trace).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([lo // RANGE for lo in at] + [-1], pa.int32()), pa.array(data, pa.binary())], names=["part", "data"])

    return products


def _sum(t: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer()) for x in t.column("data"))
    return pa.table({"part": t.column("part")[:1], "data": pa.array([total.tobytes()], pa.binary())})


def pca(calls: DataFrame, k: int = 10, extra: int = 20, iterations: int = 300, tolerance: float = 1e-10, seed: int = 0) -> DataFrame:
    """(sample, pc, score, eigenvalue, fraction) of standardised genotypes; missing calls count as the mean.

    Eigenvalues are those of Z'Z / variants and fractions are of its trace. Iterations end when the first ``k``
    change by less than ``tolerance`` of the largest; if ``iterations`` do not reach that, it raises. Components are
    unit vectors whose largest entry is positive. A variant counts if it has any call; null ids and calls outside
    0 to 2 are left out; an empty table has no components.
    """
    spark, kind = calls.sparkSession, dict(calls.dtypes)["sample"]
    schema = f"sample {kind}, pc int, score double, eigenvalue double, fraction double"
    g = F.col("alt_count")
    c = calls.where(g.between(0, 2) & F.col("sample").isNotNull() & F.col("variant").isNotNull()).select("sample", "variant", g.cast("tinyint").alias("g"))
    samples = cut(numbered(c.select("sample").distinct(), ["sample"], "at"))
    variants = cut(numbered(c.select("variant").distinct(), ["variant"], "_v"))
    n, m = samples.count(), variants.count()
    if not n:
        return spark.createDataFrame([], schema)
    width = max(1, CELLS // n)
    rows = c.join(samples, "sample").join(variants, "variant").select("at", "_v", "g").withColumn("_b", F.floor(F.col("_v") / width))
    blocks = cut(rows.groupBy("_b").applyInArrow(_pack(n, width), "rows int, data binary"))

    def times(q: np.ndarray) -> tuple[np.ndarray, float]:
        sent = spark.sparkContext.broadcast(q)
        try:
            got = blocks.mapInArrow(_products(sent, n), "part int, data binary").groupBy("part").applyInArrow(_sum, "part int, data binary").collect()
        finally:
            sent.unpersist()
        of = {r["part"]: np.frombuffer(r["data"]) for r in got}
        trace = float(of.pop(-1)[0])
        return np.concatenate([of[i].reshape(-1, q.shape[1]) for i in sorted(of)]) / m, trace / m

    k = max(1, min(k, n - 1, m - 1))
    columns = n if n <= WHOLE else min(n, k + extra)  # the whole space needs no gap between eigenvalues to settle
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, columns)))[0]
    before = None
    for _ in range(iterations):
        y, trace = times(q)
        # Rayleigh-Ritz: the best values and vectors within the subspace
        values, turn = np.linalg.eigh(q.T @ y)
        values, turn = values[::-1], turn[:, ::-1]
        if before is not None and np.abs(values[:k] - before).max() <= tolerance * max(values[0], 1e-300):
            break
        before = values[:k]
        q = np.linalg.qr(y @ turn)[0]
    else:
        raise RuntimeError(f"eigenvalues did not settle in {iterations} iterations")
    vectors = q @ turn[:, :k]
    vectors *= np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    out = pa.table({"at": pa.array(np.repeat(np.arange(n), k)), "pc": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), "score": pa.array(vectors.ravel())})
    scores = spark.createDataFrame(out.to_pandas())
    e = spark.createDataFrame([(i + 1, float(v), float(v / trace) if trace else 0.0) for i, v in enumerate(values[:k])], "pc int, eigenvalue double, fraction double")
    return samples.join(scores, "at").join(F.broadcast(e), "pc").select("sample", F.col("pc").cast("int").alias("pc"), "score", "eigenvalue", "fraction")  # k rows
