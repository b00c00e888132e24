"""Exact quantiles of groups of any size: histograms narrow each rank down, and only the bin of the rank is sorted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .annotate import sized
from .cutpoint import cut

#: Bins of a histogram; values that are sorted in one task at most.
BINS, DIRECT = 4_096, 100_000
_LARGEST = 1.7976931348623157e308


def quantiles(df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), direct: int = DIRECT, bins: int = BINS) -> DataFrame:
    """(by, q: an array in the order of ``probabilities``): quantiles that interpolate linearly, a row a group.

    Groups of at most ``direct`` rows are one aggregate. In larger ones each rank starts from the group's least and
    largest value; a round counts ``bins`` bins between the two and goes on with the least and largest value of the
    rank's bin, until it holds ``direct`` rows at most or one value. Nulls and NaN are left out and infinite values
    count as the largest numbers; a group without values is not there.
    """
    v = F.col(value).cast("double")
    keys = list(by)
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(*keys, F.greatest(F.least(v, F.lit(_LARGEST)), F.lit(-_LARGEST)).alias("_v"))
    same = lambda a, b: [a[k].eqNullSafe(b[k]) for k in keys]
    size = cut(rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    large = size.where(F.col("_n") > direct)
    p = F.array(*[F.lit(float(x)) for x in probabilities])
    if large.isEmpty():
        return rows.groupBy(*keys).agg(F.percentile("_v", p).alias("q"))

    def inside(t: DataFrame) -> DataFrame:
        """Rows of the groups of ``t`` between its bounds, with the columns of ``t``."""
        own = t.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        on = [rows[k].eqNullSafe(own[f"_k_{k}"]) for k in keys]
        between = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        hit = rows.join(sized(own), on) if keys else rows.crossJoin(F.broadcast(own))  # a row a rank
        return hit.where(between).drop(*[f"_k_{k}" for k in keys])

    # ranks below and above each quantile, with what is left of the rank within its bounds
    h = F.array(*[F.lit(float(x)) * (F.col("_n") - 1) for x in probabilities])
    ranks = F.array_distinct(F.concat(F.transform(h, lambda x: F.floor(x)), F.transform(h, lambda x: F.ceil(x))))
    at = large.withColumn("_rank", F.explode(ranks)).select(*keys, "_rank", F.col("_rank").alias("_r"), "_lo", "_hi", "_n")
    done = None
    while True:
        wide = (F.col("_lo") < F.col("_hi")) & (F.col("_n") > direct)
        at = cut(at)
        ended = at.where(~wide)
        done = ended if done is None else done.unionByName(ended)
        if at.where(wide).isEmpty():
            break
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        hit = inside(at.where(wide).select(*keys, "_rank", "_r", "_lo", "_hi")).withColumn("_bin", F.least(F.floor(share * bins), F.lit(bins - 1)))
        hit = hit.groupBy(*keys, "_rank", "_r", "_bin").agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.sum("_n").over(Window.partitionBy(*keys, "_rank").orderBy("_bin")) - F.col("_n")  # of at most ``bins`` rows
        hit = hit.withColumn("_before", before).where((F.col("_before") <= F.col("_r")) & (F.col("_r") < F.col("_before") + F.col("_n")))
        at = hit.select(*keys, "_rank", (F.col("_r") - F.col("_before")).alias("_r"), "_lo", "_hi", "_n")
    counts = inside(done.select(*keys, "_rank", "_r", "_lo", "_hi")).groupBy(*keys, "_rank", "_r", "_v").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_rank").orderBy("_v"))  # of at most ``direct`` values
    found = counts.withColumn("_upto", upto).where((F.col("_upto") > F.col("_r")) & (F.col("_upto") - F.col("_n") <= F.col("_r")))
    values = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_m"))  # two a probability
    both = large.join(values, same(large, values)).select(*[large[k] for k in keys], "_n", "_m") if keys else large.crossJoin(F.broadcast(values)).select("_n", "_m")
    of = lambda x: F.element_at("_m", F.floor(x)) * (1 - (x - F.floor(x))) + F.element_at("_m", F.ceil(x)) * (x - F.floor(x))
    big = both.select(*keys, F.transform(h, of).alias("q"))
    small = size.where(F.col("_n") <= direct)
    if not keys or small.isEmpty():
        return big
    rest = rows.join(small.select(*keys), same(rows, small), "left_semi").groupBy(*keys).agg(F.percentile("_v", p).alias("q"))
    return big.unionByName(rest)
