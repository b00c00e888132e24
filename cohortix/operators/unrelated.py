"""The unrelated set: which samples go so that no related pair is left."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cutpoint import cut


def _greedy(pdf: pd.DataFrame) -> list:
    """The sequential rule on edges (a, b, ma, mb), both directions of each: by a heap whose stale entries are put back."""
    near: dict = {}
    miss = dict(zip(pdf["a"], pdf["ma"], strict=True))
    for a, b in zip(pdf["a"], pdf["b"], strict=True):
        near.setdefault(a, set()).add(b)
    place = {s: i for i, s in enumerate(sorted(near))}
    heap = [(-len(x), -miss[s], -place[s], s) for s, x in near.items()]
    heapq.heapify(heap)
    out = []
    while heap:
        n, m, p, s = heapq.heappop(heap)
        left = len(near[s])
        if left != -n:
            if left:
                heapq.heappush(heap, (-left, m, p, s))
            continue
        out.append(s)
        for other in near.pop(s):
            near[other].discard(s)
        near[s] = set()
    return out


def unrelated_removal(pairs: DataFrame, missing: DataFrame, local: int = 200_000) -> DataFrame:
    """Samples to remove so that no related pair is left: (sample, round).

    The rule takes the sample with most relatives left, then the most missing (null: none), then the last id,
    again and again. A sample that stands before all its relatives in this order is taken before any of them,
    whatever happens elsewhere, so each round takes all such samples at once: the result is that of the rule one
    by one. When at most ``local`` edges are left, one task ends the work by the rule itself.

    A pair counts once in whichever direction and however often it is given; a sample paired with itself and null
    ids are left out.
    """
    kind = dict(pairs.dtypes)["a"]
    once = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    both = once.unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = missing.where("sample is not null").groupBy("sample").agg(F.max(F.coalesce("missing_fraction", F.lit(0.0))).alias("m"))
    of = lambda c: m.withColumnsRenamed({"sample": c, "m": f"m{c}"})
    zero = lambda c: F.coalesce(c, F.lit(0.0)).cast("double").alias(c)
    edges = cut(both.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", zero("ma"), zero("mb")))
    spark = pairs.sparkSession
    taken, step = spark.createDataFrame([], f"sample {kind}, round int"), 0
    while edges.count() > 2 * local:
        own = cut(edges.groupBy("a").agg(F.struct(F.count("*").alias("n"), F.max("ma").alias("m"), F.col("a").alias("s")).alias("p")))
        theirs = edges.select("a", "b").join(own.select(F.col("a").alias("b"), F.col("p").alias("q")), "b").groupBy("a").agg(F.max("q").alias("q"))
        gone = cut(own.join(theirs, "a").where("p > q").select("a"))
        taken = taken.unionByName(gone.select(F.col("a").alias("sample"), F.lit(step).alias("round")))
        edges = cut(edges.join(gone, "a", "left_anti").join(gone.withColumnRenamed("a", "b"), "b", "left_anti").select("a", "b", "ma", "mb"))
        step += 1

    def finish(pdf: pd.DataFrame) -> pd.DataFrame:
        got = _greedy(pdf)
        return pd.DataFrame({"sample": pd.Series(got, dtype=pdf["a"].dtype), "round": pd.Series([step] * len(got), dtype="int32")})

    rest = edges.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(finish, f"sample {kind}, round int")  # at most 2 * local rows
    return taken.unionByName(rest)
