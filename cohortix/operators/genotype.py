"""Genotype quality control on long calls: (sample, variant, alt_count), alt_count null when missing.

A variant or a sample may hold any share of the rows: every statistic here is a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions.alleles import alt_count, genotype_text, maf, orientation, ploidy

#: Quality thresholds (fixed values).
SAMPLE_MISSING, VARIANT_MISSING, MAF_MIN, HWE_MIN, HET_SD = 0.02, 0.02, 0.01, 1e-6, 3.0
KINSHIP_CUTS = ((0.354, "duplicate_or_twin"), (0.177, "first_degree"), (0.0884, "second_degree"), (0.0442, "third_degree"))


def oriented_sites(sites: DataFrame, reference: str | Column = "reference") -> DataFrame:
    """Sites (chromosome, position, a1, a2) with status, ref, alt, a1_is_alt and variant_key."""
    o = orientation("a1", "a2", reference)
    key = F.concat("chromosome", F.lit(":"), F.col("position").cast("string"), F.lit(":"), F.col("_o.ref"), F.lit(":"), F.col("_o.alt"))
    return sites.withColumn("_o", o).select("*", "_o.status", "_o.ref", "_o.alt", "_o.a1_is_alt", key.alias("variant_key")).drop("_o")


def call_columns(calls: DataFrame, raw_chrom: str = "raw_chromosome") -> DataFrame:
    """A1 counts with chromosome, a1_is_alt and male become ploidy, ALT count, genotype and zygosity."""
    p = calls.withColumn("ploidy", ploidy("chromosome", raw_chrom, "male"))
    c = p.withColumn("alt_count", alt_count("a1_count", "a1_is_alt", "ploidy"))
    n, k = F.col("alt_count"), F.col("ploidy")
    return c.withColumns({"GT": genotype_text("alt_count", "ploidy"), "heterozygous": (n == 1) & (k == 2), "homozygous_alt": n == k})


def carriers(calls: DataFrame) -> DataFrame:
    """Rows that carry an ALT allele: a called count over 0, or a positive dosage."""
    return calls.where((F.col("alt_count") > 0) | (F.col("dosage") > 0 if "dosage" in calls.columns else F.lit(False)))


def site_statistics(calls: DataFrame) -> DataFrame:
    n = F.col("alt_count")
    return calls.groupBy("variant").agg(
        F.count(n).alias("n_called"), F.count_if(n > 0).alias("n_carriers"), F.count_if(n == 2).alias("n_hom_alt"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("alt_allele_count")
    )


def sample_missingness(calls: DataFrame, most: float = SAMPLE_MISSING) -> DataFrame:
    miss = F.count_if(F.col("alt_count").isNull())
    return calls.groupBy("sample").agg(F.count("*").alias("n_total"), miss.alias("n_missing"), (miss / F.count("*")).alias("missing_fraction")).withColumn("fail_missing", F.col("missing_fraction") > most)


def variant_metrics(calls: DataFrame) -> DataFrame:
    """Missingness, ALT frequency, MAF, genotype counts and flags of each variant, in one pass."""
    n = F.col("alt_count")
    freq = F.sum(n) / F.when(F.count(n) > 0, 2 * F.count(n))
    m = calls.groupBy("variant").agg(
        F.count("*").alias("n_total"), (F.count_if(n.isNull()) / F.count("*")).alias("missing_fraction"), freq.alias("alt_freq"),
        F.count_if(n == 0).alias("n_hom_ref"), F.count_if(n == 1).alias("n_het"), F.count_if(n == 2).alias("n_hom_alt"),
    )
    m = m.withColumn("maf", maf("alt_freq"))
    flags = {"fail_missing": F.col("missing_fraction") > VARIANT_MISSING, "fail_maf": F.coalesce("maf", F.lit(0.0)) < MAF_MIN}
    return m.withColumns(flags).withColumn("passes", ~F.col("fail_missing") & ~F.col("fail_maf"))


def heterozygosity(calls: DataFrame, sd: float = HET_SD) -> DataFrame:
    """F = (observed - expected) / (called - expected) homozygotes of each sample, and outliers.

    The expectation of a variant with frequency p among n called samples is 1 - 2p(1-p) * 2n/(2n-1).
    """
    n = F.col("alt_count")
    freq = calls.groupBy("variant").agg(F.count(n).alias("called"), F.sum(n).alias("alts")).where("called > 1")
    p = F.col("alts") / (2 * F.col("called"))
    expected = freq.select("variant", (1 - 2 * p * (1 - p) * (2 * F.col("called")) / (2 * F.col("called") - 1)).alias("e"))
    per = calls.where(n.isNotNull()).join(expected, "variant").groupBy("sample").agg(F.count_if(n != 1).alias("o_hom"), F.sum("e").alias("e_hom"), F.count("*").alias("n_called"))
    per = per.withColumn("f", (F.col("o_hom") - F.col("e_hom")) / F.when(F.col("n_called") != F.col("e_hom"), F.col("n_called") - F.col("e_hom")))
    line = per.agg(F.avg("f").alias("_m"), F.stddev_samp("f").alias("_s"))
    return per.crossJoin(F.broadcast(line)).withColumn("fail_het", F.coalesce(F.abs(F.col("f") - F.col("_m")) > sd * F.col("_s"), F.lit(False))).drop("_m", "_s")  # one row


def relationship(kinship: str | Column) -> Column:
    """Degree of a pair, from the highest cut-off down; the cut-off itself is not enough."""
    k = F.col(kinship) if isinstance(kinship, str) else kinship
    out = F.when(k > KINSHIP_CUTS[0][0], KINSHIP_CUTS[0][1])
    for cut, name in KINSHIP_CUTS[1:]:
        out = out.when(k > cut, name)
    return out.otherwise("unrelated")


def sex_check(calls: DataFrame, chrom: str = "X", male_at: float = 0.8, female_at: float = 0.2) -> DataFrame:
    """Inbreeding on X against the declared sex (1 male, 2 female); PROBLEM where they disagree."""
    x = heterozygosity(calls.where(F.col("chromosome") == chrom)).select("sample", "f")
    got = F.when(F.col("f") > male_at, 1).when(F.col("f") < female_at, 2).otherwise(0)
    declared = calls.select("sample", "sex").distinct()
    out = declared.join(x, "sample", "left").withColumn("snp_sex", got)
    return out.withColumn("status", F.when(F.col("f").isNull(), "SKIPPED").when((F.col("sex") == F.col("snp_sex")) & (F.col("sex") != 0), "OK").otherwise("PROBLEM"))


def sample_metrics(samples: DataFrame, *metrics: DataFrame) -> DataFrame:
    """``samples`` ⟕ each table of metrics (a row a sample); what a sample lacks is null and fails nothing."""
    out = samples
    for m in metrics:
        out = out.join(m, "sample", "left")
    return out


def passing_variants(variants: DataFrame, metrics: DataFrame) -> DataFrame:
    """Variants whose metrics pass; those without metrics do not."""
    return variants.join(metrics.where("passes").select("variant"), "variant", "left_semi")


def final_decision(samples: DataFrame, flags: list[str]) -> DataFrame:
    """Fail reasons of each sample; ``keep`` where there is none."""
    reasons = F.concat_ws(";", *[F.when(F.coalesce(F.col(f), F.lit(False)), F.lit(f.removeprefix("fail_"))) for f in flags])
    return samples.withColumn("fail_reasons", reasons).withColumn("keep", F.col("fail_reasons") == "")


def cohort_status(decided: DataFrame, fail_at: float = 0.5, warn_at: float = 0.05) -> DataFrame:
    share = F.count_if(~F.col("keep")) / F.count("*")
    return decided.agg(share.alias("fail_fraction")).withColumn("status", F.when(F.col("fail_fraction") > fail_at, "FAIL").when(F.col("fail_fraction") > warn_at, "WARN").otherwise("PASS"))


def reason_counts(decided: DataFrame) -> DataFrame:
    return decided.where("fail_reasons <> ''").select(F.explode(F.split("fail_reasons", ";")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def placed(variants: DataFrame) -> DataFrame:
    return variants.where("position >= 1")
