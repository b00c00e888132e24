"""Profiles of typed columns: counts, moments, quantiles, missingness. One pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions.text import long_form

from .annotate import sized
from .quantiles import quantiles


def value_counts(df: DataFrame, c: str, name: str = "n") -> DataFrame:
    """Frequencies, largest first, then by value."""
    return df.groupBy(c).agg(F.count("*").alias(name)).orderBy(F.desc(name), F.asc_nulls_last(c))


def numeric_profile(df: DataFrame, c: str, by: Sequence[str] = ()) -> DataFrame:
    """n, mean, sd (n - 1), min, max, median, q01, q99, skewness and how many lie beyond 5 sd.

    Quantiles interpolate linearly; the skewness is the population one. What lies beyond 5 sd needs
    the mean and sd first, so a bounded summary row is joined back.
    """
    v = F.col(c).cast("double")
    s = df.where(v.isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.skewness(v).alias("skewness"),
    )
    q = quantiles(df, c, (0.5, 0.01, 0.99), by)
    named = q.withColumnsRenamed({k: f"_k_{k}" for k in by})
    s = s.join(named, [s[k].eqNullSafe(named[f"_k_{k}"]) for k in by], "left") if by else s.crossJoin(F.broadcast(q))  # one row
    s = s.select(*by, "n", "mean", "sd", "min", "max", F.col("q")[0].alias("median"), F.col("q")[1].alias("q01"), F.col("q")[2].alias("q99"), "skewness")
    keys = s.select(*by, F.col("mean").alias("_m"), F.col("sd").alias("_s"))
    far = df.join(sized(keys), list(by)) if by else df.crossJoin(F.broadcast(keys))  # one row
    far = far.groupBy(*by).agg(F.count_if(F.abs(v - F.col("_m")) > 5 * F.col("_s")).alias("n_beyond_5sd"))
    return s.join(far, list(by), "left") if by else s.crossJoin(far)


def binary_profile(df: DataFrame, code: str) -> DataFrame:
    n, cases = F.count(code), F.count_if(F.col(code) == 1)
    return df.agg(cases.alias("n_cases"), F.count_if(F.col(code) == 0).alias("n_controls"), F.round(cases / F.when(n > 0, n), 4).alias("case_fraction"))


def class_profile(df: DataFrame, c: str, small: int = 10) -> DataFrame:
    """Class sizes; ``is_small`` marks those under ``small``."""
    return df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n")).withColumn("is_small", F.col("n") < small)


def covariate_profile(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row a variable: missing fraction, mean, sd, min, max, number of levels, whether constant."""
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in (*numeric, *categorical)])
    long = long_form(wide, [], wide.columns, "variable", "value")
    num = F.when(F.col("variable").isin(list(numeric)), F.col("value").try_cast("double"))
    return long.groupBy("variable").agg(
        (F.count_if(F.col("value").isNull()) / F.count("*")).alias("missing_fraction"), F.avg(num).alias("mean"), F.stddev_samp(num).alias("sd"),
        F.min(num).alias("min"), F.max(num).alias("max"), F.count_distinct("value").alias("n_levels"), (F.count_distinct("value") <= 1).alias("is_constant"),
    )


def clinical_profile(long: DataFrame) -> DataFrame:
    v = F.col("value_numeric")
    return long.groupBy("variable").agg(
        F.count("*").alias("n"), F.count_if(F.col("value_text").isNull()).alias("n_missing"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")
    )


def matrix_long(df: DataFrame, sample: str, values: str) -> DataFrame:
    """(sample, feature, value) of an array column; the place in the array is the feature."""
    return df.select(F.col(sample).alias("sample"), F.posexplode_outer(values).alias("feature", "value"))


def matrix_features(long: DataFrame) -> DataFrame:
    """Per feature: samples, missing fraction, min, median, max, share of zeros and of negative values."""
    v = F.col("value")
    return long.groupBy("feature").agg(
        F.count("*").alias("n"), (F.count_if(v.isNull()) / F.count("*")).alias("missing_fraction"), F.min(v).alias("min"), F.percentile(v, F.lit(0.5)).alias("median"), F.max(v).alias("max"),
        (F.count_if(v == 0) / F.count("*")).alias("zero_fraction"), (F.count_if(v < 0) / F.count("*")).alias("negative_fraction"),
    )


def matrix_samples(long: DataFrame) -> DataFrame:
    return long.groupBy("sample").agg((F.count_if(F.col("value").isNull()) / F.count("*")).alias("missing_fraction"))


def matrix_summary(long: DataFrame, most_missing: float = 0.2) -> DataFrame:
    """One row: overall missing fraction, features and samples over the bound."""
    f = matrix_features(long).agg(F.count("*").alias("n_features"), F.count_if(F.col("missing_fraction") > most_missing).alias("features_over"))
    s = matrix_samples(long).agg(F.count("*").alias("n_samples"), F.count_if(F.col("missing_fraction") > most_missing).alias("samples_over"))
    m = long.agg((F.count_if(F.col("value").isNull()) / F.count("*")).alias("missing_fraction"))
    return f.crossJoin(s).crossJoin(m)  # one row each


def histogram(df: DataFrame, c: str, lo: float, hi: float, bins: int = 40) -> DataFrame:
    b = F.width_bucket(F.col(c).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(bins))
    return df.where(F.col(c).isNotNull()).groupBy(b.alias("bin")).agg(F.count("*").alias("n"))


def missing_rule(fraction: Column, most: float = 0.2) -> Column:
    return F.when(fraction > most, "WARN").otherwise("PASS")


def table_digest(df: DataFrame) -> DataFrame:
    """Rows and a digest that no order of rows or columns changes; equal tables have equal digests."""
    cols = sorted(df.columns)
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in cols])
    part = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(part), F.lit(0)).cast("decimal(38,0)").cast("string").alias("digest"))


def inspect(df: DataFrame, participant: str | None = None) -> DataFrame:
    """Rows, columns and distinct participants in one pass."""
    ids = F.count_distinct(participant) if participant else F.lit(None).cast("bigint")
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), ids.alias("n_participants"))


def drop_empty_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` without those of ``columns`` that hold no value."""
    if not columns:
        return df
    got = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return df.drop(*[c for c in columns if got[c] == 0])
