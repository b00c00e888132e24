"""Summary statistics: standard fields, sanity rules, duplicates, lift-over.

The rules are our own: plain alleles that differ, chromosomes 1-22, X, Y, MT, positions from 1 on,
frequencies and p-values within bounds, standard errors over 0; of rows of one variant the smallest
p-value stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.functions.alleles import chromosome
from cohortix.functions.text import to_number, to_whole

from .dedup import best_row
from .infer import gwas_columns, gwas_missing

TEXT, WHOLE = ("snpid", "rsid", "chrom", "ea", "nea"), ("pos", "n", "ncase", "ncontrol")


def standard(df: DataFrame) -> DataFrame:
    """Recognised columns under their field names and types. Raises where essentials are missing."""
    fields = gwas_columns(df.columns)
    if lack := gwas_missing(list(fields)):
        raise ValueError("summary statistics lack " + "; ".join(lack))
    made = {f: (F.col(f"`{c}`").cast("string") if f in TEXT else to_whole(f"`{c}`") if f in WHOLE else to_number(f"`{c}`")) for f, c in fields.items()}
    out = df.select(*[v.alias(f) for f, v in made.items()])
    fix = {c: F.upper(c) for c in ("ea", "nea")} | ({"chrom": chromosome("chrom")} if "chrom" in fields else {})
    return out.withColumns(fix)


def checked(df: DataFrame) -> DataFrame:
    """Rows that keep the rules, one a variant."""
    have = set(df.columns)
    keep = F.col("ea").rlike("^[ACGT]+$") & F.col("nea").rlike("^[ACGT]+$") & (F.col("ea") != F.col("nea"))
    if {"chrom", "pos"} <= have:
        keep = keep & F.col("chrom").rlike("^([1-9]|1[0-9]|2[0-2]|X|Y|MT)$") & (F.col("pos") >= 1)
    for c in have & {"eaf", "p"}:
        keep = keep & (F.col(c).isNull() | F.col(c).between(0, 1))
    if "se" in have:
        keep = keep & (F.col("se").isNull() | (F.col("se") > 0))
    key = ["pos", "chrom", "ea", "nea"] if {"chrom", "pos"} <= have else [next(c for c in ("snpid", "rsid") if c in have), "ea", "nea"]
    order = [F.asc_nulls_last(c) for c in ("p", *sorted(have - {"p"})) if c in have]
    return best_row(df.where(keep), key, order)


def for_phenotype(registry: DataFrame, phenotype: str) -> DataFrame:
    return registry.where(F.col("target_phenotype") == phenotype)


def accession_folder(accession: str) -> str:
    """Folder of an accession: blocks of a thousand."""
    n = int(accession.removeprefix("GCST"))
    lo = (n - 1) // 1000 * 1000 + 1
    width = len(accession) - 4
    return f"GCST{lo:0{width}d}-GCST{lo + 999:0{width}d}"
