"""Chromosomes, alleles and variant keys as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: Numeric and mitochondrial codes of chromosomes (fixed values). The three tables differ on purpose:
#: carriers fold the pseudo-autosomal XY into X, build evidence does not know XY, and the lift-over
#: names the mitochondrion as chain files do.
CARRIER_ALIASES = {"23": "X", "24": "Y", "25": "X", "XY": "X", "26": "MT", "M": "MT"}
BUILD_ALIASES = {"23": "X", "24": "Y", "25": "X", "26": "MT", "M": "MT"}
CHAIN_ALIASES = {"23": "X", "24": "Y", "25": "X", "XY": "X", "26": "M", "MT": "M"}
HAPLOID = ("Y", "MT")
STRAND_AMBIGUOUS = ("AT", "TA", "CG", "GC")
KEEP_STATUS = ("match", "swapped", "strand_flipped", "strand_flipped_swapped", "unverified")


def _lookup(key: Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key], key)


def strip_chr(c: str | Column) -> Column:
    return F.regexp_replace(col(c).cast("string"), "(?i)^chr", "")


def chromosome(c: str | Column, aliases: dict[str, str] = CARRIER_ALIASES) -> Column:
    return _lookup(F.upper(strip_chr(F.trim(col(c).cast("string")))), aliases)


def chain_name(c: str | Column) -> Column:
    return F.concat(F.lit("chr"), chromosome(c, CHAIN_ALIASES))


def complement(c: str | Column) -> Column:
    return F.translate(col(c), "ACGTacgt", "TGCAtgca")


def strand_ambiguous(a: str | Column, b: str | Column) -> Column:
    return F.concat(F.upper(col(a)), F.upper(col(b))).isin(*STRAND_AMBIGUOUS)


def variant_key(chrom: str | Column, pos: str | Column, ref: str | Column, alt: str | Column) -> Column:
    """``chrom:pos:ref:alt``; null where any part is."""
    return F.concat(chromosome(chrom), F.lit(":"), col(pos).cast("bigint").cast("string"), F.lit(":"), col(ref), F.lit(":"), col(alt))


def starts_reference(reference: Column, allele: Column) -> Column:
    return F.substring(reference, 1, F.char_length(allele)) == allele


def orientation(a1: str | Column, a2: str | Column, reference: str | Column) -> Column:
    """A struct (status, ref, alt, a1_is_alt) of a site's alleles against the reference bases.

    ``reference`` is null where there is no reference to check against. Deletions and insertions
    compare by their prefix, so ``reference`` must be as long as the longer allele.
    """
    x, y, r = F.upper(col(a1)), F.upper(col(a2)), F.upper(col(reference))
    cx, cy = complement(x), complement(y)
    plain = x.rlike("^[ACGTN]+$") & y.rlike("^[ACGTN]+$")
    ambiguous = strand_ambiguous(x, y)
    none = F.lit(None).cast("string")

    def said(status: str, ref: Column, alt: Column, forward: bool) -> Column:
        return F.struct(F.lit(status).alias("status"), ref.alias("ref"), alt.alias("alt"), F.lit(forward).alias("a1_is_alt"))

    return (
        F.when(x.isin("0", ".", "") | y.isin("0", ".", ""), said("monomorphic", none, none, True))
        .when(r.isNull(), said("unverified", y, x, True))
        .when(~plain, said("non_nucleotide", none, none, True))
        .when(starts_reference(r, y), said("match", y, x, True))
        .when(starts_reference(r, x), said("swapped", x, y, False))
        .when(~ambiguous & starts_reference(r, cy), said("strand_flipped", cy, cx, True))
        .when(~ambiguous & starts_reference(r, cx), said("strand_flipped_swapped", cx, cy, False))
        .otherwise(said("mismatch", none, none, True))
    )


def ploidy(chrom: str | Column, raw_chrom: str | Column, male: str | Column) -> Column:
    """1 on Y and MT and, for males, on X outside the pseudo-autosomal region (raw code X or 23)."""
    own_x = F.upper(strip_chr(raw_chrom)).isin("X", "23")
    return F.when(col(chrom).isin(*HAPLOID), 1).when(own_x & F.coalesce(col(male), F.lit(False)), 1).otherwise(2)


def alt_count(a1_count: str | Column, a1_is_alt: str | Column, copies: str | Column) -> Column:
    """ALT alleles of a call; null for a missing call and for a haploid heterozygote."""
    a, p = col(a1_count), col(copies)
    n = F.when(col(a1_is_alt), a).otherwise(2 - a)
    return F.when(a.isNull() | (a < 0), None).when((p == 1) & (n == 1), None).when(p == 1, (n / 2).cast("int")).otherwise(n.cast("int"))


def genotype_text(count: str | Column, copies: str | Column) -> Column:
    n, p = col(count), col(copies)
    return (
        F.when(n.isNull(), F.when(p == 1, ".").otherwise("./."))
        .when(p == 1, n.cast("string"))
        .otherwise(F.when(n == 0, "0/0").when(n == 1, "0/1").otherwise("1/1"))
    )


def maf(freq: str | Column) -> Column:
    """Minor-allele frequency; null for a null frequency (``least`` alone would give 1 - null)."""
    f = col(freq)
    return F.when(f.isNotNull(), F.least(f, 1 - f))


def gt_alt_count(gt: str | Column) -> Column:
    """ALT alleles of a VCF genotype; null where any allele is missing."""
    alleles = F.split(F.regexp_replace(col(gt), r"\|", "/"), "/")
    none = F.exists(alleles, lambda a: (a == ".") | (a == ""))
    return F.when(col(gt).isNotNull() & ~none, F.size(F.filter(alleles, lambda a: a != "0")))
