"""Parsers of annotation and score files, as text scans and column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.alleles import strip_chr
from cohortix.functions.text import extra_map, info_value, to_number, to_whole

from .sqlite import read_sqlite

#: Columns of PLINK reports that are numbers (fixed values).
PLINK_REALS = {"F_MISS", "ALT_FREQS", "P", "KINSHIP", "HETHET", "IBS0", "F", "O(HOM)", "E(HOM)", "MISSING_FREQ", "OBS_CT_FREQ"}
PLINK_WHOLES = {"OBS_CT", "MISSING_CT", "NSNP", "POS", "BP", "KB", "NSEG"}
SPLICE_FIELDS = ("allele", "symbol", "ds_ag", "ds_al", "ds_dg", "ds_dl", "dp_ag", "dp_al", "dp_dg", "dp_dl")
#: chromosome, position and alleles in a model's variant id.
VARIANT_ID = r"^(?:chr)?([0-9XYMT]+)[_:](\d+)[_:]([ACGT]+)[_:]([ACGT]+)(?:[_:]b(37|38))?$"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.col("value") != "")


def _header(lines: DataFrame, starts: Column, sep: str) -> list[str]:
    got = lines.where(starts).limit(1).collect()
    return got[0][0].lstrip("#").split(sep) if got else []


def _fields(lines: DataFrame, names: Sequence[str], sep: str = "\t") -> DataFrame:
    f = F.split("value", sep, -1)
    return lines.select(*[F.get(f, F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_plink_report(spark: SparkSession, path: str) -> DataFrame:
    """A white-space table with ``#`` before the header and ``##`` comments, typed by column names."""
    lines = _lines(spark, path).where(~F.col("value").startswith("##")).select(F.trim(F.regexp_replace("value", r"\s+", " ")).alias("value"))
    first = lines.limit(1).collect()[0][0]
    names = first.lstrip("#").split(" ")
    df = _fields(lines.where(F.col("value") != first), names, " ")
    return df.select(*[(to_number(f"`{n}`") if n in PLINK_REALS else to_whole(f"`{n}`") if n in PLINK_WHOLES else F.col(f"`{n}`")).alias(n) for n in names])


def read_lookup(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A VCF or TSV reference as text columns: comments skipped, rows of a wrong width dropped."""
    lines = _lines(spark, path)
    vcf = F.col("value").startswith("#CHROM")
    names = _header(lines, vcf | ~F.col("value").startswith("#"), sep)
    body = lines.where(~F.col("value").startswith("#"))
    if not lines.where(vcf).limit(1).count():
        body = body.where(F.col("value") != sep.join(names))
    return _fields(body.where(F.size(F.split("value", sep, -1)) == len(names)), names, sep)


def vcf_reference(df: DataFrame) -> DataFrame:
    """A looked-up VCF under the engine's names; one row a record."""
    return df.select(F.col("CHROM").alias("chromosome"), F.col("POS").cast("bigint").alias("position"), F.col("ID").alias("reference_id"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"), F.col("INFO").alias("info"))


def clinvar(df: DataFrame) -> DataFrame:
    keys = ("CLNSIG", "CLNREVSTAT", "CLNDN", "GENEINFO")
    return vcf_reference(df).select("chromosome", "position", "ref", "alt", "reference_id", *[info_value("info", k).alias(k) for k in keys])


def gnomad(df: DataFrame, fields: Sequence[str] = ("AF", "AF_afr", "AF_amr", "AF_eas", "AF_nfe", "AF_sas", "nhomalt")) -> DataFrame:
    return vcf_reference(df).select("chromosome", "position", "ref", "alt", *[F.nullif(info_value("info", k), F.lit("")).try_cast("double").alias(k) for k in fields])


def alphamissense(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("CHROM").alias("chromosome"), F.col("POS").cast("bigint").alias("position"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"), "uniprot_id", "transcript_id", "protein_variant",
        to_number("am_pathogenicity").alias("alphamissense_score"), F.col("am_class").alias("alphamissense_class"),
    )


def read_vep(spark: SparkSession, path: str, extra: Sequence[str] = ("IMPACT", "SYMBOL", "PICK", "CANONICAL", "HGVSc", "HGVSp")) -> DataFrame:
    """VEP tab output: ``-`` is null, ``Extra`` becomes columns."""
    lines = _lines(spark, path).where(~F.col("value").startswith("##"))
    names = _header(lines, F.col("value").startswith("#"), "\t")
    df = _fields(lines.where(~F.col("value").startswith("#")), names)
    plain = [F.nullif(F.col(n), F.lit("-")).alias(n) for n in names if n != "Extra"]
    more = [extra_map("Extra")[k].alias(k) for k in extra if k not in names] if "Extra" in names else []
    return df.select(*plain, *more)


def spliceai(df: DataFrame) -> DataFrame:
    """A row per variant and gene from INFO ``SpliceAI=``; entries with fewer than ten fields are dropped."""
    ref = vcf_reference(df)
    e = ref.withColumn("e", F.explode(F.split(info_value("info", "SpliceAI"), ","))).withColumn("f", F.split("e", r"[|]")).where(F.size("f") >= len(SPLICE_FIELDS))
    got = {n: F.get("f", F.lit(i)) for i, n in enumerate(SPLICE_FIELDS)}
    out = e.select("chromosome", "position", "ref", "alt", got["symbol"].alias("symbol"), *[got[n].try_cast("double").alias(n) for n in SPLICE_FIELDS[2:6]])
    return out.withColumn("score", F.greatest("ds_ag", "ds_al", "ds_dg", "ds_dl"))


def read_cravat(spark: SparkSession, path: str) -> DataFrame:
    """OpenCRAVAT report: comments skipped, repeated header names numbered, ragged rows padded with nulls."""
    lines = _lines(spark, path).where(~F.col("value").startswith("#"))
    first = lines.limit(1).collect()[0][0]
    seen: dict[str, int] = {}
    names = []
    for n in first.split("\t"):
        seen[n] = seen.get(n, 0) + 1
        names.append(n if seen[n] == 1 else f"{n}_{seen[n]}")
    return _fields(lines.where(F.col("value") != first), names)


def read_predictdb(spark: SparkSession, path: str) -> DataFrame:
    """Weights ⟕ gene table of a model database, both read by ranges of rows where the file lies."""
    w, x = read_sqlite(spark, path, "weights"), read_sqlite(spark, path, "extra")
    pick = lambda df, *names: next(F.col(f"`{n}`") for n in names if n in df.columns)
    vid = pick(w, "varID", "varid", "rsid")
    part = lambda i: F.nullif(F.regexp_extract(vid, VARIANT_ID, i), F.lit(""))
    w = w.select(
        F.col("gene").alias("feature_id"), pick(w, "rsid", "varID").alias("variant_id"), part(1).alias("chromosome"), part(2).cast("bigint").alias("position"),
        pick(w, "eff_allele", "effect_allele").alias("effect_allele"), pick(w, "ref_allele", "other_allele").alias("other_allele"), to_number("weight").alias("weight"),
        F.concat(F.lit("GRCh"), part(5)).alias("genome_build"),
    )
    x = x.select(F.col("gene").alias("feature_id"), pick(x, "genename", "gene").alias("feature_name"), to_number(pick(x, "pred.perf.R2", "R2", "gene")).alias("validation_r2"))
    return w.join(x, "feature_id", "left")


def read_scoring_file(spark: SparkSession, path: str, harmonized: bool = False, header_lines: int = 10_000) -> tuple[dict[str, str], DataFrame]:
    """(header ``#key=value`` pairs, weights); harmonized positions come first where asked for.

    A file of more than ``header_lines`` pairs is refused: the header goes to the driver.
    """
    lines = _lines(spark, path)
    pairs = lines.where(F.col("value").startswith("#") & F.col("value").contains("=")).limit(header_lines + 1).collect()
    if len(pairs) > header_lines:
        raise ValueError(f"{path}: more than {header_lines} header lines")
    meta = dict(r[0].lstrip("#").split("=", 1) for r in pairs)
    body = lines.where(~F.col("value").startswith("#"))
    first = body.limit(1).collect()[0][0]
    names = first.split("\t")
    df = _fields(body.where(F.col("value") != first), names)
    pick = lambda *c: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in c if n in names], F.lit(None).cast("string"))
    chrom = pick("hm_chr", "chr_name") if harmonized else pick("chr_name")
    pos = pick("hm_pos", "chr_position") if harmonized else pick("chr_position")
    rs = pick("hm_rsID", "rsID") if harmonized else pick("rsID")
    return meta, df.select(
        rs.alias("variant_id"), strip_chr(chrom).alias("chromosome"), to_whole(pos).alias("position"), F.upper(pick("effect_allele")).alias("effect_allele"),
        F.upper(pick("other_allele", "hm_inferOtherAllele")).alias("other_allele"), to_number(pick("effect_weight")).alias("weight"),
    )


def read_model_export(spark: SparkSession, path: str) -> DataFrame:
    """Methylation model export: typed columns, ``NA`` and empty as null."""
    df = spark.read.csv(path, sep="\t", header=True, inferSchema=False, nullValue="NA")
    kinds = {"method_index": "int", "position": "bigint", "test_r2": "double", "weight": "double", "lambda": "double", "valid": "boolean"}
    whole = lambda c, k: F.col(c).try_cast("double").try_cast(k)
    return df.select(*[(whole(c, kinds[c]) if kinds.get(c) in ("int", "bigint") else F.col(c).try_cast(kinds[c]) if c in kinds else F.col(c)).alias(c) for c in df.columns])


def validation_r2(df: DataFrame) -> DataFrame:
    """(feature_id, validation_r2): the id column and the main R² column, internal validation first."""
    ids = next(c for c in df.columns if c.lower().endswith("id"))
    r2 = sorted((c for c in df.columns if c.lower().endswith("_r2")), key=lambda c: ("internal" not in c.lower(), df.columns.index(c)))[0]
    return df.select(F.col(f"`{ids}`").alias("feature_id"), to_number(f"`{r2}`").alias("validation_r2"))


def prediction_long(df: DataFrame) -> DataFrame:
    """FID IID and a column a gene to (native_id, feature_id, value)."""
    genes = [c for c in df.columns if c not in ("FID", "IID")]
    long = df.select(F.col("IID").alias("native_id"), *[to_number(f"`{g}`").alias(g) for g in genes])
    return long.unpivot("native_id", genes, "feature_id", "value")


def read_eigenvalues(spark: SparkSession, path: str) -> DataFrame:
    v = spark.read.text(path).select(F.posexplode(F.split(F.trim("value"), r"\s+")).alias("i", "v"), F.monotonically_increasing_id().alias("_o"))
    return v.select("_o", "i", to_number("v").alias("eigenvalue")).where("eigenvalue is not null")


def read_hla(df: DataFrame) -> DataFrame:
    """HLA calls: sample, locus, two alleles and the posterior."""
    return df.select("sample_id", "locus", "allele1", "allele2", to_number("posterior").alias("posterior"))


def version_of_vcf(lines: DataFrame) -> DataFrame:
    """The ``##fileDate`` of a VCF as a date version."""
    d = lines.where(F.col("value").startswith("##fileDate=")).select(F.regexp_replace(F.regexp_extract("value", r"=(.*)$", 1), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3").alias("version"))
    return d.limit(1)
