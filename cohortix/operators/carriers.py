"""From genotype files to carriers: oriented sites, ploidy, ALT counts, carrier rows and statistics of sites."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.alleles import KEEP_STATUS, chromosome, strand_ambiguous
from cohortix.sources import genotype as files
from cohortix.sources.fasta import bases_of

from .annotate import joined, sized
from .cutpoint import cut
from .genotype import call_columns, oriented_sites

COLUMNS = ("participant_id", "native_sample_id", "variant_key", "variant_id", "rsid", "chromosome", "position", "ref", "alt", "GT", "hardcall_alt_count", "dosage", "ploidy", "heterozygous", "homozygous_alt", "info_r2", "genome_build", "source_id")


def _rsid(c: str = "variant_id") -> Column:
    return F.when(F.col(c).startswith("rs"), F.col(c))


def plink_sites(bim: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Sites of a .bim with ref, alt, a1_is_alt, ref_check, strand_ambiguous, included and variant_key.

    The reference comes from the FASTA of ``index``; without one A2 is taken for it, unverified. A place outside the
    FASTA is a mismatch. Sites that match neither way are not included and have no key.
    """
    s = bim.withColumn("chromosome", chromosome("raw_chromosome"))
    if index is None:
        s = s.withColumn("bases", F.lit(None).cast("string"))
    else:
        s = bases_of(s, index, F.greatest(F.length("a1"), F.length("a2"), F.lit(1)))
    o = oriented_sites(s.drop("ref", "alt"), "bases")
    kept = F.col("status").isin(*KEEP_STATUS)
    return o.withColumns({"included": kept, "variant_key": F.when(kept, F.col("variant_key")), "rsid": _rsid(), "strand_ambiguous": strand_ambiguous("a1", "a2")}).withColumnRenamed("status", "ref_check").drop("bases")


def _statistics(calls: DataFrame, keys: list[str]) -> DataFrame:
    n = F.col("alt_count")
    return calls.groupBy(*keys).agg(
        F.count(n).alias("n_called"), F.count_if(n > 0).alias("n_carriers"), F.count_if(n == F.col("ploidy")).alias("n_hom_alt"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("alt_allele_count")
    )


def _carrier_rows(calls: DataFrame, carrier_only: bool, genome_build: str | None, source_id: str | None) -> DataFrame:
    c = calls.withColumns({"genome_build": F.lit(genome_build).cast("string"), "source_id": F.lit(source_id).cast("string"), "hardcall_alt_count": F.col("alt_count")})
    return (c.where((F.col("alt_count") > 0) | (F.col("dosage") > 0)) if carrier_only else c).select(*COLUMNS)


def bed_carriers(spark: SparkSession, prefix: str, aliases: DataFrame | None = None, index: DataFrame | None = None, carrier_only: bool = True, genome_build: str | None = None, source_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(carriers, sites) of a PLINK fileset, or of all filesets of a folder: of ranges of sites or batches of samples.

    ``aliases``: native_id (the IID), participant_id; a sample without one has a null participant. A male's calls on
    X (23) and all on Y and MT are haploid; a haploid heterozygote is missing. Lines of the same chromosome, id, place
    and alleles are one site.
    """
    every = [prefix] if files.files.exists(f"{prefix}.bed") else files.prefixes(prefix)
    if not every:
        raise ValueError(f"{prefix}: no .bed fileset found")
    calls = files.read_filesets(spark, every, called=carrier_only)
    if aliases is not None:
        calls = joined(calls, aliases.select(F.col("native_id").alias("native_sample_id"), "participant_id").dropDuplicates(["native_sample_id"]), "native_sample_id", "left")
    else:
        calls = calls.withColumn("participant_id", F.col("native_sample_id"))
    site = ["raw_chromosome", "variant_id", "position", "a1", "a2"]
    sites = cut(plink_sites(files.read_bims(spark, every).distinct(), index))
    calls = call_columns(joined(calls, sites, site))  # calls are read by Python and taken for few bytes, so they would be broadcast
    calls = calls.withColumns({"dosage": F.col("alt_count").cast("double"), "info_r2": F.lit(None).cast("double")})
    table = sites.join(_statistics(calls, site).hint("merge"), site, "left").select(
        "variant_key", "variant_id", "rsid", "chromosome", "position", F.col("ref").alias("reference"), F.col("alt").alias("alternate"), "a1", "a2", "ref_check", "strand_ambiguous", "included",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_called", "n_carriers", "n_hom_alt", "alt_allele_count")],
    )
    return _carrier_rows(calls.where("included"), carrier_only, genome_build, source_id), table


def vcf_carriers(spark: SparkSession, path: str, aliases: DataFrame | None = None, index: DataFrame | None = None, carrier_only: bool = True, genome_build: str | None = None, source_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(carriers, sites) of a biallelic VCF; REF must be what the FASTA has, where there is one.

    A sample is known by its name, or by what follows its first underscore. Where DS is missing the dosage is the hard
    call; a positive dosage makes a carrier whatever the hard call is.
    """
    own = lambda df: df.where("alt <> ''").withColumn("chromosome", chromosome("chromosome"))
    c = own(files.read_vcf_calls(spark, path, called=carrier_only))
    site = ["chromosome", "position", "variant_id", "ref", "alt", "info_r2"]
    s = own(files.read_vcf_records(spark, path)).select(*site).distinct()
    if index is None:
        s = s.withColumn("ref_check", F.lit("unverified"))
    else:
        s = bases_of(s, index, F.length("ref")).withColumn("ref_check", F.when(F.col("bases") == F.col("ref"), "match").otherwise("mismatch")).drop("bases")
    key = F.concat_ws(":", "chromosome", F.col("position").cast("string"), "ref", "alt")
    s = s.withColumns({"variant_key": key, "rsid": _rsid(), "included": F.col("ref_check") != "mismatch"})
    s = cut(s)
    named = s.withColumnsRenamed({x: f"_{x}" for x in site})
    same = [F.col(x).eqNullSafe(F.col(f"_{x}")) for x in site]
    n = F.size(F.split("GT", "/"))
    calls = c.join(sized(named), same).withColumn("ploidy", F.coalesce(n, F.lit(2)))
    k, p = F.col("alt_count"), F.col("ploidy")
    calls = calls.withColumns({
        "dosage": F.coalesce("dosage", k.cast("double")), "heterozygous": (k == 1) & (p == 2), "homozygous_alt": k == p, "native_sample_id": F.col("sample"), "GT": F.coalesce("GT", F.lit("./.")),
        "variant_id": F.when(F.col("variant_id") == ".", F.col("variant_key")).otherwise(F.col("variant_id")),
    })
    if aliases is not None:
        a = aliases.select("native_id", F.col("participant_id").alias("_p")).dropDuplicates(["native_id"])
        tail = F.regexp_replace("native_sample_id", "^[^_]*_", "")
        whole = calls.join(sized(a), F.col("native_sample_id") == F.col("native_id"), "left").drop("native_id")
        by_tail = a.select(F.col("native_id").alias("_n"), F.col("_p").alias("_q"))
        calls = whole.join(sized(by_tail), tail == F.col("_n"), "left").withColumn("participant_id", F.coalesce("_p", "_q"))
    else:
        calls = calls.withColumn("participant_id", F.col("native_sample_id"))
    table = s.join(_statistics(calls.select("variant_key", "alt_count", "ploidy"), ["variant_key"]), "variant_key", "left").where("included").select(
        "variant_key", F.when(F.col("variant_id") == ".", F.col("variant_key")).otherwise(F.col("variant_id")).alias("variant_id"), "rsid", "chromosome", "position", F.col("ref").alias("reference"), F.col("alt").alias("alternate"), "ref_check", "included",
        *[F.coalesce(x, F.lit(0)).alias(x) for x in ("n_called", "n_carriers", "n_hom_alt", "alt_allele_count")],
    )
    return _carrier_rows(calls.where("included"), carrier_only, genome_build, source_id), table


def ref_checks(spark: SparkSession, path: str, sites: DataFrame) -> DataFrame:
    """(check, n) of a VCF: the sites' statuses, and the sites with several ALT alleles or none."""
    skipped = files.vcf_skipped(spark, path).unpivot([], ["multiallelic", "no_alt"], "check", "n")
    skipped = skipped.select(F.when(F.col("check") == "no_alt", "monomorphic").otherwise("multiallelic_excluded").alias("check"), "n").where("n > 0")
    return sites.groupBy(F.col("ref_check").alias("check")).agg(F.count("*").alias("n")).unionByName(skipped)
