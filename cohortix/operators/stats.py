"""Statistics of genotypes that need more than an aggregate: exact tests, pruning, projection, runs."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cutpoint import cut


def _hwe(hom1: int, het: int, hom2: int) -> float:
    """Exact Hardy-Weinberg p-value: all heterozygote counts no likelier than the observed one.

    Relative probabilities come from the recurrence between counts two apart (Wigginton 2005).
    """
    n = hom1 + het + hom2
    if n == 0:
        return float("nan")
    rare = 2 * min(hom1, hom2) + het
    hets = np.arange(rare % 2, rare + 1, 2)
    # log P(het + 2) - log P(het)
    r = (rare - hets[:-1]) / 2
    c = n - hets[:-1] - r
    log_p = np.concatenate([[0.0], np.cumsum(np.log(4.0) + np.log(r) + np.log(c) - np.log(hets[:-1] + 2) - np.log(hets[:-1] + 1))])
    p = np.exp(log_p - log_p.max())
    own = p[np.searchsorted(hets, het)]
    return float(min(1.0, p[p <= own * (1 + 1e-9)].sum() / p.sum()))


def _hwe_column(hom1: pd.Series, het: pd.Series, hom2: pd.Series) -> pd.Series:
    """Exact p-value from genotype counts; counts that occur again are not computed again."""
    memo: dict[tuple, float] = {}
    out = []
    for k in zip(hom1, het, hom2, strict=True):
        if k not in memo:
            memo[k] = _hwe(int(k[0]), int(k[1]), int(k[2]))
        out.append(memo[k])
    return pd.Series(out, dtype="float64")


def hardy_weinberg(metrics: DataFrame, least: float = 1e-6) -> DataFrame:
    """p of each variant from its genotype counts; a variant without calls passes."""
    hwe_p = F.pandas_udf(_hwe_column, "double")
    p = metrics.withColumn("hwe_p", F.nanvl(hwe_p("n_hom_ref", "n_het", "n_hom_alt"), F.lit(None).cast("double")))
    return p.withColumn("fail_hwe", F.coalesce(F.col("hwe_p") < least, F.lit(False)))


def _ld_sums(window: int, step: int, width: int):
    """Sums over one block of samples for the pairs of one window's variants, as a row.

    A sample with one call in the window is in no pair; the others fill matrices of at most ``width`` samples. Of pairs,
    the cells that are not empty leave the task.
    """

    def sums(t: pa.Table) -> pa.Table:
        w = t.column("w")[0].as_py()
        lists = t.column("s").combine_chunks()
        row = np.repeat(t.column("i").to_numpy() - w * step, pc.list_value_length(lists).to_numpy())
        s = lists.flatten().dictionary_encode(null_encoding="encode").indices.to_numpy()
        x = t.column("g").combine_chunks().flatten().to_numpy()
        last = np.append((row[1:] != row[:-1]) | (s[1:] != s[:-1]), True)  # of repeated calls the largest
        row, s, x = row[last], s[last], x[last]
        own = np.stack([np.bincount(row, y, window) for y in (x, np.ones(len(x)), x * x)])
        paired = np.bincount(s) > 1
        paired &= np.bincount(s[row < step], minlength=len(paired)) > 0
        some = paired[s]
        row, s, x = row[some], (np.cumsum(paired) - 1)[s[some]], x[some]
        order = np.argsort(s, kind="stable")
        row, s, x = row[order], s[order], x[order]
        both = np.zeros((4, step, window))
        for lo in range(0, int(paired.sum()), width):
            at = slice(*np.searchsorted(s, [lo, lo + width]))
            g, m = np.zeros((2, window, s[at][-1] - lo + 1))
            g[row[at], s[at] - lo], m[row[at], s[at] - lo] = x[at], 1
            gs, ms = g[:step], m[:step]
            both += np.stack([gs @ g.T, gs @ m.T, ms @ g.T, ms @ m.T])
        both = both.reshape(4, -1)
        cells = np.flatnonzero(both[3])
        data = {"cells": cells.astype(np.int32), "both": both[:, cells], "own": own}
        return pa.table({"chromosome": t.column("chromosome")[:1], "w": t.column("w")[:1], **{k: pa.array([v.tobytes()], pa.binary()) for k, v in data.items()}})

    return sums


def _ld_partners(window: int, step: int, r2: float):
    """Each variant of a window's first ``step`` with its frequency and the later ones over ``r2``."""

    def partners(t: pa.Table) -> pa.Table:
        own, both = np.zeros((3, window)), np.zeros((4, step * window))
        for cells, x, y in zip(*(t.column(c).to_pylist() for c in ("cells", "both", "own")), strict=True):
            both[:, np.frombuffer(cells, np.int32)] += np.frombuffer(x).reshape(4, -1)
            own += np.frombuffer(y).reshape(3, window)
        s, n, q = own
        gg, gm, mg, mm = both.reshape(4, step, window)
        mean = s / np.maximum(n, 1)
        var = n * q - s * s  # whole numbers, so a variant without variance has exactly 0
        norm = np.sqrt(np.where(var > 0, var / np.maximum(n, 1), 0))
        dot = gg - gm * mean - mean[:step, None] * mg + mm * mean[:step, None] * mean
        scale = norm[:step, None] * norm
        over = (scale > 0) & (np.divide(dot, scale, out=np.zeros_like(dot), where=scale > 0) ** 2 > r2) & (np.arange(window) > np.arange(step)[:, None])
        at = np.flatnonzero(n[:step] > 0)
        f = np.minimum(mean / 2, 1 - mean / 2)
        first = t.column("w")[0].as_py() * step
        named = pa.array([t.column("chromosome")[0].as_py()] * len(at), t.schema.field("chromosome").type)
        return pa.table({"chromosome": named, "i": first + at, "f": f[at], "varies": norm[at] > 0, "partners": pa.array([first + np.flatnonzero(over[j]) for j in at], pa.list_(pa.int64()))})

    return partners


def _ld_windows(index: DataFrame, window: int, step: int, most: int) -> DataFrame:
    """(chromosome, seg, windows): the windows (w, b) that hold each ``step`` of variants, with ``b`` blocks of samples.

    Blocks are a power of two, so many that one has about ``most`` calls: what is in a window counts, not the samples.
    """
    reach = -(-window // step)
    w = Window.partitionBy("chromosome").orderBy("seg")
    n = F.sum("_n").over(w.rowsBetween(0, reach - 1))
    b = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(n / most, F.lit(1.0))))).cast("long")
    segs = index.groupBy("chromosome", "seg").agg(F.sum("_n").alias("_n")).withColumn("b", b)
    return segs.select("chromosome", "seg", F.collect_list(F.struct(F.col("seg").alias("w"), "b")).over(w.rowsBetween(1 - reach, 0)).alias("windows"))


def _ld_parts(calls: DataFrame, index: DataFrame, window: int, step: int, sample_block: int) -> DataFrame:
    """Sums of each window and block of samples: (chromosome, w, cells, both, own)."""
    key = ["chromosome", "position", "variant"]
    windows = cut(_ld_windows(index, window, step, window * sample_block))
    finest = windows.agg(F.max(F.array_max("windows.b"))).first()[0] or 1
    wide = calls.groupBy(*key, F.pmod(F.xxhash64("sample"), F.lit(finest)).alias("sb")).agg(F.sort_array(F.collect_list(F.struct("sample", "g"))).alias("x"))
    named = index.select(*[F.col(c).alias(f"_{c}") for c in key], "i", "seg")
    wide = wide.join(named, [_same(c, f"_{c}") for c in key]).select("chromosome", "sb", "i", "seg", F.col("x.sample").alias("s"), F.col("x.g").alias("g"))
    wide = wide.join(windows.select(F.col("chromosome").alias("_c"), F.col("seg").alias("_s"), "windows"), [_same("chromosome", "_c"), _same("seg", "_s")])
    wide = wide.withColumn("at", F.explode("windows")).where(F.col("at.w") * step + window > F.col("i"))
    wide = wide.select("chromosome", F.col("at.w").alias("w"), F.pmod("sb", F.col("at.b")).alias("sb"), "i", "s", "g")
    return wide.groupBy("chromosome", "w", "sb").applyInArrow(_ld_sums(window, step, sample_block), f"chromosome {dict(calls.dtypes)['chromosome']}, w long, cells binary, both binary, own binary")


def _same(x: str, y: str) -> Column:
    return F.col(x).eqNullSafe(F.col(y))


def ld_prune(calls: DataFrame, window: int = 200, step: int = 50, r2: float = 0.2, sample_block: int = 4_096) -> DataFrame:
    """(chromosome, position, variant, keep): greedy pruning in windows of variants, by chromosome.

    Of a pair over ``r2`` within a window the one of lower minor-allele frequency goes (then the
    later). Sums over samples are taken for each window and block of at most about ``window`` times
    ``sample_block`` calls, whatever the number of samples. The choice is sequential within a run of variants that pairs
    above ``r2`` reach across, and runs are chosen apart; only the windows that number variants and find the
    runs go over a whole chromosome, with a few numbers a variant.
    """
    if step > window:
        raise ValueError("a step beyond the window would leave variants out")
    key, kind, same = ["chromosome", "position", "variant"], dict(calls.dtypes), _same
    called = cut(calls.where("alt_count is not null").select(*key, "sample", F.col("alt_count").cast("double").alias("g")))
    order = Window.partitionBy("chromosome").orderBy(F.col("position").asc_nulls_last(), "variant")
    index = called.groupBy(*key).agg(F.count("*").alias("_n")).withColumn("i", (F.row_number().over(order) - 1).cast("long"))
    index = cut(index.withColumn("seg", F.floor(F.col("i") / step).cast("long")))
    part = _ld_parts(called, index, window, step, sample_block)
    found = part.groupBy("chromosome", "w").applyInArrow(_ld_partners(window, step, r2), f"chromosome {kind['chromosome']}, i long, f double, varies boolean, partners array<long>")
    found = found.withColumnsRenamed({"chromosome": "_chromosome", "i": "_i"})
    rows = index.join(found, [same("chromosome", "_chromosome"), same("i", "_i")]).select(*key, "i", "f", "varies", "partners")
    rows = cut(rows)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        """The rule within one run of variants, in the windows of the whole chromosome."""
        pdf = pdf.sort_values("i").reset_index(drop=True)
        own, f = pdf["i"].to_numpy(), pdf["f"].to_numpy()
        keep, partners = pdf["varies"].to_numpy(bool).copy(), pdf["partners"].to_list()
        if len(pdf) > 1:
            for lo in range(max(0, ((own[0] - window) // step + 1) * step), own[-1] + 1, step):
                for i in range(*np.searchsorted(own, [lo, lo + window])):
                    for x in partners[i]:
                        if x >= lo + window or not keep[i]:
                            break
                        j = np.searchsorted(own, x)
                        if keep[j]:
                            keep[i if f[i] < f[j] else j] = False
        return pdf[key].assign(keep=keep)

    # A variant that no pair reaches across begins a new run: what is kept before it has no say in it.
    w = Window.partitionBy("chromosome").orderBy("i")
    reach = F.greatest("i", F.coalesce(F.array_max("partners"), F.lit(0)))
    before = F.max("_reach").over(w.rowsBetween(Window.unboundedPreceding, -1))
    spans = cut(rows.select("chromosome", "i", reach.alias("_reach")).withColumn("_new", F.coalesce(F.col("i") > before, F.lit(True)).cast("int")))
    runs = spans.select(F.col("chromosome").alias("_c"), F.col("i").alias("_j"), F.sum("_new").over(w).alias("run"))
    rows = rows.join(runs, [same("chromosome", "_c"), same("i", "_j")]).drop("_c", "_j")
    alone = rows.where(F.size("partners") == 0).join(rows.groupBy("chromosome", "run").agg(F.count("*").alias("_m")).where("_m = 1").select(F.col("chromosome").alias("_c"), F.col("run").alias("_r")), [same("chromosome", "_c"), same("run", "_r")], "left_semi")
    linked = rows.join(alone.select(F.col("chromosome").alias("_c"), F.col("i").alias("_j")), [same("chromosome", "_c"), same("i", "_j")], "left_anti")
    chosen = linked.groupBy("chromosome", "run").applyInPandas(choose, ", ".join(f"{c} {kind[c]}" for c in key) + ", keep boolean")
    return chosen.unionByName(alone.select(*key, F.col("varies").alias("keep")))


def project(calls: DataFrame, loadings: DataFrame) -> DataFrame:
    """(sample, pc, score): sums of dosage times loading over the shared variants."""
    return calls.where("alt_count is not null").join(loadings, "variant").groupBy("sample", "pc").agg(F.sum(F.col("alt_count") * F.col("loading")).alias("score"))


def shared_loadings(calls: DataFrame, loadings: DataFrame, least: int = 100) -> DataFrame:
    """Loadings of the variants that the cohort has too; raises where fewer than ``least`` are shared."""
    own = calls.select("variant").distinct()
    shared = loadings.join(own, "variant", "left_semi")
    n = shared.agg(F.count_distinct("variant")).first()[0]
    if n < least:
        raise ValueError(f"cohort and reference share {n} variants, {least} are needed")
    return shared


def ancestry(calls: DataFrame, loadings: DataFrame, reference: DataFrame, populations: DataFrame, least: int = 100) -> DataFrame:
    """(id, label, confidence): the population (sample, label) whose centre is nearest to each sample.

    Both cohorts are projected on the variants they share; a score is a sum over called genotypes.
    """
    shared = shared_loadings(calls, loadings, least)

    def vectors(c: DataFrame) -> DataFrame:
        per = project(c, shared).groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("pc", "score"))).alias("x"))
        return per.select("sample", F.transform("x", lambda p: p["score"]).alias("v"))

    known = vectors(reference).join(populations, "sample").select("label", "v")
    return nearest_centroid(vectors(calls).withColumnRenamed("sample", "id"), known)


def nearest_centroid(points: DataFrame, known: DataFrame) -> DataFrame:
    """(id, label, confidence): nearest centre of ``known`` (label, v) to each of ``points`` (id, v).

    Centres are a row a label; confidence is 1 - d1/d2, and 1 where there is one label only.
    """
    k = known.select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    centres = k.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("c"))
    d = points.join(F.broadcast(centres))  # a row a label
    diff = F.zip_with("v", "c", lambda a, b: (a - b) * (a - b))
    d = d.withColumn("d", F.sqrt(F.aggregate(diff, F.lit(0.0), lambda s, x: s + x)))
    best = d.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("d", "label"))).alias("o"))
    d1, d2 = F.get("o", F.lit(0)), F.get("o", F.lit(1))["d"]
    return best.select("id", d1["label"].alias("label"), F.when(d2.isNull(), 1.0).otherwise(1 - d1["d"] / F.when(d2 > 0, d2)).alias("confidence"))


def runs_of_homozygosity(calls: DataFrame, least_sites: int = 50, least_length: int = 1_000_000, most_gap: int = 1_000_000) -> DataFrame:
    """Segments of homozygous calls per sample and chromosome: gaps and islands over positions."""
    w = Window.partitionBy("sample", "chromosome").orderBy("position")
    c = calls.where("alt_count is not null").withColumn("hom", F.col("alt_count") != 1)
    starts = ~F.col("hom") | F.coalesce(F.lag("hom").over(w) != F.col("hom"), F.lit(True)) | (F.col("position") - F.coalesce(F.lag("position").over(w), F.col("position")) > most_gap)
    c = c.withColumn("island", F.sum(starts.cast("int")).over(w)).where("hom")
    seg = c.groupBy("sample", "chromosome", "island").agg(F.min("position").alias("start"), F.max("position").alias("end"), F.count("*").alias("n_sites"))
    return seg.where((F.col("n_sites") >= least_sites) & (F.col("end") - F.col("start") >= least_length)).drop("island").withColumn("length", F.col("end") - F.col("start"))


def roh_per_sample(segments: DataFrame) -> DataFrame:
    return segments.groupBy("sample").agg(F.count("*").alias("n_segments"), F.sum("length").alias("total_length"), F.avg("length").alias("mean_length"))
