"""Variant consequence terms: severity, picks and groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: Sequence Ontology consequence terms, most severe first (fixed values, the order Ensembl publishes).
SEVERITY = (
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
    "stop_lost",
    "start_lost",
    "transcript_amplification",
    "feature_elongation",
    "feature_truncation",
    "inframe_insertion",
    "inframe_deletion",
    "missense_variant",
    "protein_altering_variant",
    "splice_donor_5th_base_variant",
    "splice_region_variant",
    "splice_donor_region_variant",
    "splice_polypyrimidine_tract_variant",
    "incomplete_terminal_codon_variant",
    "start_retained_variant",
    "stop_retained_variant",
    "synonymous_variant",
    "coding_sequence_variant",
    "mature_miRNA_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "non_coding_transcript_exon_variant",
    "intron_variant",
    "NMD_transcript_variant",
    "non_coding_transcript_variant",
    "coding_transcript_variant",
    "upstream_gene_variant",
    "downstream_gene_variant",
    "TFBS_ablation",
    "TFBS_amplification",
    "TF_binding_site_variant",
    "regulatory_region_ablation",
    "regulatory_region_amplification",
    "regulatory_region_variant",
    "intergenic_variant",
    "sequence_variant",
)
#: Terms that always have a column in the counts (fixed values).
REPORTED = (
    "missense_variant",
    "synonymous_variant",
    "stop_gained",
    "stop_lost",
    "start_lost",
    "frameshift_variant",
    "inframe_insertion",
    "inframe_deletion",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "splice_region_variant",
    "5_prime_UTR_variant",
    "3_prime_UTR_variant",
    "intron_variant",
    "intergenic_variant",
    "regulatory_region_variant",
)
#: Loss-of-function and splice terms (fixed values).
LOSS_OF_FUNCTION = (
    "transcript_ablation",
    "splice_acceptor_variant",
    "splice_donor_variant",
    "stop_gained",
    "frameshift_variant",
    "stop_lost",
    "start_lost",
)
SPLICE = (
    "splice_acceptor_variant",
    "splice_donor_variant",
    "splice_region_variant",
    "splice_donor_5th_base_variant",
    "splice_donor_region_variant",
    "splice_polypyrimidine_tract_variant",
)
DAMAGING_SCORE, RARE_FREQUENCY = 0.564, 0.01
SPLICE_CUTS = (0.2, 0.5, 0.8)


def terms(consequence: str | Column) -> Column:
    """The terms of ``a&b,c`` text; an empty array for null or empty text."""
    parts = F.split(F.regexp_replace(F.coalesce(col(consequence), F.lit("")), ",", "&"), "&")
    return F.filter(parts, lambda t: t != "")


def rank(term: Column) -> Column:
    """Place in ``SEVERITY``; unknown terms come after all known ones, null stays null."""
    at = F.array_position(F.array(*[F.lit(t) for t in SEVERITY]), term)
    return F.when(at > 0, at - 1).when(term.isNotNull(), len(SEVERITY))


def most_severe(consequence: str | Column) -> Column:
    """The most severe term; of unknown terms the first."""
    ranked = F.transform(terms(consequence), lambda t, i: F.struct(rank(t).alias("r"), i.alias("i"), t.alias("t")))
    return F.array_min(ranked)["t"]


def has_any(consequence: str | Column, wanted: tuple[str, ...]) -> Column:
    return F.arrays_overlap(terms(consequence), F.array(*[F.lit(t) for t in wanted]))


def pathogenic(significance: str | Column) -> Column:
    """Said to be pathogenic and not conflicting. ``_`` in a LIKE pattern is any character."""
    c = col(significance)
    return F.coalesce((c.like("%Pathogenic%") | c.like("%Likely_pathogenic%")) & ~c.like("%Conflicting%"), F.lit(False))
