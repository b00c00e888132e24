"""Queries that write surrogate text files and tables to the shared folder and read them back with the library's readers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.operators.cutpoint import checkpoint_dir
from cohortix.sources import files, parsers, sinks, sqlite, tables, versions
from cohortix.sources import genotype as g

from . import surrogates as su
from .registry import register


def _place(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cohortix-{uuid.uuid4().hex}/{name}"


def _file(rows: DataFrame, order: str, line: Column, name: str, head: str = "") -> str:
    """One file of the given lines in order, after the lines of ``head``; a task streams it out."""
    at = _place(rows.sparkSession, name)

    def write(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = files.place(at)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(path) as out:
            out.write(head.encode())
            for b in it:
                out.write("".join(f"{v}\n" for v in b.column(0).to_pylist()).encode())
        yield pa.RecordBatch.from_arrays([pa.array([at])], names=["at"])

    one = rows.select(line.alias("value"), order).repartition(1).sortWithinPartitions(order).select("value")
    one.mapInArrow(write, "at string").collect()
    return at


def _tab(*cols: Column | str) -> Column:
    return F.concat_ws("\t", *cols)


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# ---- tables -----------------------------------------------------------------------------------


@register("SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def csv_table(spark, d):
    """A CSV whose format follows from its name; empty fields stay empty text."""
    c = su.table(spark, d, "customer")
    at = _file(c, "c_custkey", F.concat_ws(",", _s("c_custkey"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment")), _s("c_nationkey")), "a.csv", "id,segment,nation\n")
    assert tables.table_columns(spark, at) == ["id", "segment", "nation"]
    return tables.read_table(spark, at).select(*[F.coalesce(x, F.lit("")).alias(x) for x in ("id", "segment", "nation")])


@register("SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment FROM customer")
def whitespace_table(spark, d):
    """A table of unknown format, parted by runs of white space."""
    c = su.table(spark, d, "customer")
    at = _file(c, "c_custkey", F.concat(F.lit("  "), _s("c_custkey"), F.lit(" \t  "), "c_mktsegment", F.lit(" ")), "a.cov", "id   segment\n\n")
    return tables.read_table(spark, at)


_OMICS = "o AS (SELECT 'S' || c_custkey AS sample, c_custkey AS k FROM customer), f AS (SELECT sample, unnest(['G1', 'G2', 'G3']) AS feature, unnest([CAST(k % 7 AS VARCHAR), CASE WHEN k % 5 = 0 THEN 'NA' ELSE CAST(k % 11 AS VARCHAR) END, '-1.5']) AS raw FROM o)"


@register(f"WITH {_OMICS} SELECT sample, feature, raw, TRY_CAST(raw AS DOUBLE) AS value FROM f")
def omics_by_samples(spark, d):
    c, k = su.table(spark, d, "customer"), F.col("c_custkey")
    at = _file(c, "c_custkey", _tab(F.concat(F.lit("S"), _s("c_custkey")), (k % 7).cast("string"), F.when(k % 5 == 0, "NA").otherwise((k % 11).cast("string")), F.lit("-1.5")), "omics.tsv", "sample\tG1\tG2\tG3\n")
    return tables.read_samples_by_features(tables.read_table(spark, at), "sample").select("sample", "feature", "raw", "value")


@register("SELECT 'S' || s AS sample, 'P' || p_partkey AS feature, CAST(p_partkey * s % 13 AS VARCHAR) AS raw, CAST(p_partkey * s % 13 AS DOUBLE) AS value FROM part, range(1, 6) r(s)")
def omics_by_features(spark, d):
    p, k = su.table(spark, d, "part"), F.col("p_partkey")
    at = _file(p, "p_partkey", _tab(F.concat(F.lit("P"), _s("p_partkey")), *[(k * s % 13).cast("string") for s in range(1, 6)]), "omics.tsv", "feature\t" + "\t".join(f"S{s}" for s in range(1, 6)) + "\n")
    return tables.read_features_by_samples(tables.read_table(spark, at), "feature").select("sample", "feature", "raw", "value")


# ---- genotype text ----------------------------------------------------------------------------


@register("SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS sample_idx, 'F' || c_nationkey AS \"FID\", 'P' || c_custkey AS \"IID\", CAST(1 + c_custkey % 2 AS VARCHAR) AS \"SEX\" FROM customer")
def psam_samples(spark, d):
    c = su.table(spark, d, "customer")
    at = _file(c, "c_custkey", _tab(F.concat(F.lit("F"), _s("c_nationkey")), su.participant_id(), (1 + F.col("c_custkey") % 2).cast("string")), "a.psam", "##made up\n#FID\tIID\tSEX\n")
    return g.read_psam(spark, at).select("sample_idx", "FID", "IID", "SEX")


@register(su.with_("sites") + "SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS variant_idx, chromosome, CAST(position AS BIGINT) AS position, 'v' || p_partkey AS variant_id, ref, alt FROM sites")
def pvar_variants(spark, d):
    s = su.sites(spark, d)
    at = _file(s, "p_partkey", _tab(F.concat(F.lit("chr"), "chromosome"), _s("position"), F.concat(F.lit("v"), _s("p_partkey")), F.lower("ref"), "alt"), "a.pvar", "##made up\n#CHROM\tPOS\tID\tREF\tALT\n")
    return g.read_pvar(spark, at)


@register(su.with_("sites") + "SELECT chromosome, CAST(position AS BIGINT) AS position, 'v' || p_partkey AS variant_id, ref, alt FROM sites")
def bim_variants(spark, d):
    s = su.sites(spark, d)
    at = _file(s, "p_partkey", F.concat_ws(" ", F.concat(F.lit("chr"), "chromosome"), F.concat(F.lit("v"), _s("p_partkey")), F.lit("0"), _s("position"), "alt", F.lower("ref")), "a.bim")
    return g.read_bim(spark, at).select("chromosome", "position", "variant_id", "ref", "alt")


@register("SELECT 'P' || c_custkey AS \"IID\", CAST(c_custkey % 50 AS BIGINT) AS \"MISSING_CT\", CAST(200 AS BIGINT) AS \"OBS_CT\", (c_custkey % 50) / 200 AS \"F_MISS\" FROM customer")
def plink_report(spark, d):
    c, k = su.table(spark, d, "customer"), F.col("c_custkey")
    at = _file(c, "c_custkey", F.concat_ws("  ", su.participant_id(), (k % 50).cast("string"), F.lit("200"), (k % 50 / 200).cast("string")), "a.smiss", "##made up\n#IID  MISSING_CT OBS_CT F_MISS\n")
    return parsers.read_plink_report(spark, at)


# ---- annotation -------------------------------------------------------------------------------


def _lookup(spark: SparkSession, d: str) -> DataFrame:
    """A sites VCF with INFO fields; each ninth row is cut short."""
    s, k = su.sites(spark, d), F.col("p_partkey")
    info = F.concat(F.lit("CLNSIG="), "p_brand", F.when(k % 4 != 0, F.concat(F.lit(";AF=0."), (k % 90 + 10).cast("string"))).otherwise(""), F.lit(";GENEINFO=G:"), _s("p_size"))
    whole = _tab("chromosome", _s("position"), F.concat(F.lit("rs"), _s("p_partkey")), "ref", "alt", F.lit("."), F.lit("."), info)
    at = _file(s, "p_partkey", F.when(k % 9 == 0, _tab("chromosome", _s("position"))).otherwise(whole), "ref.vcf", "##fileformat=VCFv4.2\n##fileDate=20240131\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n")
    return parsers.read_lookup(spark, at)


@register(su.with_("sites") + "SELECT chromosome, CAST(position AS BIGINT) AS position, ref, alt, 'rs' || p_partkey AS reference_id, p_brand AS clnsig, 'G:' || p_size AS geneinfo FROM sites WHERE p_partkey % 9 <> 0")
def clinvar_lookup(spark, d):
    c = parsers.clinvar(_lookup(spark, d))
    return c.select("chromosome", "position", "ref", "alt", "reference_id", F.col("CLNSIG").alias("clnsig"), F.col("GENEINFO").alias("geneinfo"))


@register(su.with_("sites") + "SELECT chromosome, CAST(position AS BIGINT) AS position, ref, alt, CASE WHEN p_partkey % 4 <> 0 THEN (p_partkey % 90 + 10) / 100 END AS af FROM sites WHERE p_partkey % 9 <> 0")
def gnomad_lookup(spark, d):
    return parsers.gnomad(_lookup(spark, d), ["AF"]).withColumnRenamed("AF", "af")


@register(su.with_("sites") + "SELECT chromosome, CAST(position AS BIGINT) AS position, ref, alt, p_brand AS uniprot_id, 'T' || p_partkey AS transcript_id, 'A1B' AS protein_variant, p_size / 100 AS alphamissense_score, CASE WHEN p_size > 30 THEN 'likely_pathogenic' ELSE 'ambiguous' END AS alphamissense_class FROM sites")
def alphamissense_lookup(spark, d):
    s = su.sites(spark, d)
    line = _tab("chromosome", _s("position"), "ref", "alt", F.lit("hg38"), "p_brand", F.concat(F.lit("T"), _s("p_partkey")), F.lit("A1B"), (F.col("p_size") / 100).cast("string"), F.when(F.col("p_size") > 30, "likely_pathogenic").otherwise("ambiguous"))
    at = _file(s, "p_partkey", line, "am.tsv", "# made up\n#CHROM\tPOS\tREF\tALT\tgenome\tuniprot_id\ttranscript_id\tprotein_variant\tam_pathogenicity\tam_class\n")
    return parsers.alphamissense(parsers.read_lookup(spark, at))


@register("SELECT 'k' || p_partkey AS uploaded, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END AS gene, CASE WHEN p_partkey % 2 = 0 THEN 'HIGH' END AS impact, 'S' || p_size AS symbol FROM part")
def vep_table(spark, d):
    p, k = su.table(spark, d, "part"), F.col("p_partkey")
    extra = F.concat(F.when(k % 2 == 0, "IMPACT=HIGH;").otherwise(""), F.lit("SYMBOL=S"), _s("p_size"))
    at = _file(p, "p_partkey", _tab(F.concat(F.lit("k"), _s("p_partkey")), F.when(k % 3 == 0, "-").otherwise(F.col("p_brand")), F.lit("intron_variant"), extra), "vep.tab", "## made up\n#Uploaded_variation\tGene\tConsequence\tExtra\n")
    return parsers.read_vep(spark, at).select(F.col("Uploaded_variation").alias("uploaded"), F.col("Gene").alias("gene"), F.col("IMPACT").alias("impact"), F.col("SYMBOL").alias("symbol"))


@register("SELECT CAST(p_partkey AS VARCHAR) AS uid, p_brand AS note, CASE WHEN p_partkey % 2 = 0 THEN 'second' END AS note_2 FROM part")
def cravat_report(spark, d):
    p = su.table(spark, d, "part")
    at = _file(p, "p_partkey", F.when(F.col("p_partkey") % 2 == 0, _tab(_s("p_partkey"), "p_brand", F.lit("second"))).otherwise(_tab(_s("p_partkey"), "p_brand")), "cravat.tsv", "#made up\nuid\tnote\tnote\n")
    return parsers.read_cravat(spark, at)


# ---- scores -----------------------------------------------------------------------------------


@register(su.with_("sites") + "SELECT 'rs' || p_partkey AS variant_id, chromosome, CAST(CASE WHEN p_partkey % 2 = 0 THEN position + 7 ELSE position END AS BIGINT) AS position, alt AS effect_allele, ref AS other_allele, p_size / 10 AS weight FROM sites")
def scoring_file(spark, d):
    """Harmonized places come first where a row has them."""
    s, k = su.sites(spark, d), F.col("p_partkey")
    line = _tab(F.concat(F.lit("rs"), _s("p_partkey")), F.concat(F.lit("chr"), "chromosome"), _s("position"), F.lower("alt"), "ref", (F.col("p_size") / 10).cast("string"), F.col("chromosome"), F.when(k % 2 == 0, (F.col("position") + 7).cast("string")).otherwise(""))
    at = _file(s, "p_partkey", line, "score.txt", "#pgs_id=P1\n#genome_build=GRCh38\nrsID\tchr_name\tchr_position\teffect_allele\tother_allele\teffect_weight\thm_chr\thm_pos\n")
    meta, rows = parsers.read_scoring_file(spark, at, harmonized=True)
    assert meta == {"pgs_id": "P1", "genome_build": "GRCh38"}
    return rows


@register("SELECT 'cg' || p_partkey AS cpg, CAST(p_size AS BIGINT) AS position, CASE WHEN p_partkey % 3 <> 0 THEN p_size / 100 END AS weight, p_partkey % 2 = 0 AS valid FROM part")
def model_export(spark, d):
    p, k = su.table(spark, d, "part"), F.col("p_partkey")
    at = _file(p, "p_partkey", _tab(F.concat(F.lit("cg"), _s("p_partkey")), F.concat(_s("p_size"), F.lit(".0")), F.when(k % 3 != 0, (F.col("p_size") / 100).cast("string")).otherwise("NA"), F.when(k % 2 == 0, "true").otherwise("false")), "models.tsv", "cpg\tposition\tweight\tvalid\n")
    return parsers.read_model_export(spark, at)


@register("SELECT 'G' || p_partkey AS feature_id, CASE WHEN p_partkey % 4 <> 0 THEN p_size / 100 END AS validation_r2 FROM part")
def validation_table(spark, d):
    p = su.table(spark, d, "part")
    at = _file(p, "p_partkey", _tab(F.concat(F.lit("G"), _s("p_partkey")), F.lit("0.9"), F.when(F.col("p_partkey") % 4 != 0, (F.col("p_size") / 100).cast("string")).otherwise("NA")), "val.tsv", "gene_id\tExternal_R2\tInternal_R2\n")
    return parsers.validation_r2(tables.read_table(spark, at))


@register("SELECT 'P' || c_custkey AS native_id, 'G' || i AS feature_id, CAST(c_custkey * i % 17 AS DOUBLE) / 4 AS value FROM customer, range(1, 5) r(i)")
def predicted_expression(spark, d):
    c, k = su.table(spark, d, "customer"), F.col("c_custkey")
    at = _file(c, "c_custkey", _tab(su.participant_id(), su.participant_id(), *[(k * i % 17 / 4).cast("string") for i in range(1, 5)]), "predicted.tsv", "FID\tIID\tG1\tG2\tG3\tG4\n")
    return parsers.prediction_long(tables.read_table(spark, at))


@register("SELECT CAST(c_custkey AS DOUBLE) / 8 AS eigenvalue FROM customer")
def eigenvalue_list(spark, d):
    at = _file(su.table(spark, d, "customer"), "c_custkey", (F.col("c_custkey") / 8).cast("string"), "a.eigenval")
    return parsers.read_eigenvalues(spark, at).select("eigenvalue")


@register("SELECT 'P' || c_custkey AS sample_id, CASE WHEN c_custkey % 6 <> 0 THEN 'A' END AS locus, CASE WHEN c_custkey % 6 <> 0 THEN 'A*0' || (c_custkey % 5) END AS allele1, CASE WHEN c_custkey % 6 <> 0 THEN 'A*02' END AS allele2, CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey % 100 AS DOUBLE) / 100 END AS posterior, c_mktsegment AS segment FROM customer")
def hla_of_samples(spark, d):
    """Samples with their HLA calls; each sixth sample has none."""
    c, k = su.table(spark, d, "customer"), F.col("c_custkey")
    at = _file(c.where(k % 6 != 0), "c_custkey", _tab(su.participant_id(), F.lit("A"), F.concat(F.lit("A*0"), (k % 5).cast("string")), F.lit("A*02"), (k % 100 / 100).cast("string")), "hla.tsv", "sample_id\tlocus\tallele1\tallele2\tposterior\n")
    calls = parsers.read_hla(tables.read_table(spark, at))
    return c.select(su.participant_id().alias("sample_id"), F.col("c_mktsegment").alias("segment")).join(calls, "sample_id", "left")


@register(su.with_("sites") + "SELECT 'G' || p_partkey % 50 AS feature_id, 'rs' || p_partkey AS variant_id, chromosome, CAST(position AS BIGINT) AS position, alt AS effect_allele, ref AS other_allele, p_size / 10 AS weight, 'GRCh38' AS genome_build, 'N' || p_partkey % 50 AS feature_name, CASE WHEN p_partkey % 50 % 3 <> 0 THEN (p_partkey % 50) / 100 END AS validation_r2 FROM sites")
def model_database(spark, d):
    """Weights of a SQLite model database with the names and R² of their genes."""
    import sqlite3

    s = su.sites(spark, d)
    at = _place(spark, "model.db")
    rows = s.select(F.concat(F.lit("G"), (F.col("p_partkey") % 50).cast("string")), F.concat(F.lit("rs"), _s("p_partkey")), F.concat_ws("_", F.concat(F.lit("chr"), "chromosome"), _s("position"), "ref", "alt", F.lit("b38")), "ref", "alt", F.col("p_size") / 10)
    db = sqlite3.connect(":memory:")  # the fixture is made here; it is read by the executors
    db.execute("create table weights (gene text, rsid text, varID text, ref_allele text, eff_allele text, weight real)")
    db.executemany("insert into weights values (?, ?, ?, ?, ?, ?)", map(tuple, rows.toLocalIterator()))
    db.execute('create table extra (gene text, genename text, "pred.perf.R2" real)')
    db.executemany("insert into extra values (?, ?, ?)", [(f"G{i}", f"N{i}", i / 100 if i % 3 else None) for i in range(50)])
    db.commit()
    files.write(at, db.serialize())
    assert sqlite.read_sqlite(spark, at, "weights", rows=500).columns[0] == "gene"
    return parsers.read_predictdb(spark, at)


# ---- sinks ------------------------------------------------------------------------------------


@register("SELECT o_orderkey, o_custkey + 1 AS o_custkey, (SELECT count(*) FROM orders) AS n_before FROM orders")
def versioned_orders(spark, d):
    """The second version of a table, and how many rows the first still has."""
    o, at = su.table(spark, d, "orders").select("o_orderkey", "o_custkey"), _place(spark, "orders")
    first = sinks.write_atomic(o, at)
    versions.write_version(versions.read_version(spark, at, first).withColumn("o_custkey", F.col("o_custkey") + 1), at, expect=first)
    n = versions.read_version(spark, at, first).agg(F.count("*").alias("n_before"))
    return versions.read_version(spark, at).crossJoin(F.broadcast(n))  # one row


@register(su.with_("sites", "calls", "carriers") + "SELECT participant_id, variant_key, chromosome, CAST(position AS BIGINT) AS position, hardcall_alt_count FROM carriers")
def partitioned_carriers(spark, d):
    at = _place(spark, "carriers")
    c = su.carriers(spark, d).select("participant_id", "variant_key", "chromosome", F.col("position").cast("bigint").alias("position"), "hardcall_alt_count")
    sinks.write_sorted_partitions(c, at, "chromosome", ["position", "variant_key"])
    return sinks.read_partitioned(spark, at, "participant_id string, variant_key string, position bigint, hardcall_alt_count bigint, chromosome string").select(*c.columns)


@register("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem")
def bucketed_lines(spark, d):
    at = _place(spark, "lines")
    sinks.write_buckets(su.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), at, "l_partkey", 8)
    return spark.read.parquet(at).select("l_orderkey", "l_linenumber", "l_partkey")


@register(su.with_("sites") + "SELECT chromosome, CAST(position AS BIGINT) AS position, variant_key AS variant_id, ref, alt FROM sites")
def sites_vcf(spark, d):
    """Lines of a sites-only VCF, written and read as sites."""
    at = _place(spark, "sites.vcf")
    sinks.write_lines(sinks.sites_vcf_lines(su.sites(spark, d), "GRCh38"), at)
    return g.read_vcf_sites(spark, at)


@register("SELECT 'P' || c_custkey AS iid, CAST(c_nationkey AS VARCHAR) AS score FROM customer")
def score_lines(spark, d):
    at = _place(spark, "scores")
    sinks.write_tsv(su.table(spark, d, "customer").select(su.participant_id().alias("iid"), F.col("c_nationkey").alias("score")), at)
    return spark.read.csv(at, sep="\t", header=True)


@register("SELECT 'customer' AS table_name, true AS ok, count(*) AS n_rows FROM customer UNION ALL SELECT 'part', true, count(*) FROM part")
def snapshot_verified(spark, d):
    at = _place(spark, "snapshot")
    manifest = sinks.freeze({t: su.table(spark, d, t) for t in ("customer", "part")}, at)
    return sinks.verify(spark, at).join(manifest.select("table_name", "n_rows"), "table_name")
