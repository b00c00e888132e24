"""Queries over single operators: parsers, look-ups, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.functions import alleles as al
from cohortix.functions import consequences as cq
from cohortix.functions.text import extra_map, info_value, without_version
from cohortix.operators import annotate, builds, dedup, genotype, profile, registry, score
from cohortix.sources.parsers import VARIANT_ID

from . import surrogates as su
from .registry import register
from .scores import _W, _harmonized


@register("""SELECT CASE WHEN event_id % 2 = 0 THEN 'blood' ELSE '?' END AS tissue, event_type AS material, 'W' || CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT) AS event_id, count(*) AS n, count(DISTINCT user_id) AS n_participants FROM events GROUP BY ALL""")
def biospecimen_summary(spark, d):
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    e = su.table(spark, d, "events").select(F.when(F.col("event_id") % 2 == 0, "blood").alias("tissue"), F.col("event_type").alias("material"), F.concat(F.lit("W"), week.cast("string")).alias("event_id"), F.col("user_id").alias("participant_id"))
    return registry.biospecimen_summary(e)


@register("SELECT o_orderpriority AS phenotype, round(count(*) FILTER (o_orderkey % 7 = 0) / count(*), 9) AS missing_fraction FROM orders GROUP BY 1")
def phenotype_missingness(spark, d):
    o = su.table(spark, d, "orders").select(F.col("o_orderpriority").alias("phenotype"), (F.col("o_orderkey") % 7 == 0).alias("is_missing"))
    return registry.phenotype_missingness(o).withColumn("missing_fraction", F.round("missing_fraction", 9))


@register("""WITH a AS (SELECT 'S' || o_orderpriority AS source_id, o_custkey AS p FROM orders), f AS (SELECT p, min(source_id) AS s FROM a GROUP BY 1)
SELECT source_id, count(DISTINCT p) AS n_participants, coalesce((SELECT count(*) FROM f WHERE s = source_id), 0) AS n_first_seen FROM a GROUP BY 1""")
def participants_per_source(spark, d):
    a = su.table(spark, d, "orders").select(F.concat(F.lit("S"), "o_orderpriority").alias("source_id"), F.col("o_custkey").cast("string").alias("participant_id"))
    first = a.groupBy("participant_id").agg(F.min("source_id").alias("first_source"))
    return registry.participants_per_source(a, first)


@register("""WITH art AS (SELECT s_suppkey AS artifact_id, CASE WHEN s_suppkey % 2 = 0 THEN 'expression' ELSE 'genotype' END AS modality, CASE WHEN s_suppkey % 3 = 0 THEN 'predicted' ELSE 'observed' END AS origin, 'T' || (s_nationkey % 4) AS tissue FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT 'S' || (l_linenumber % 3) AS source_id, modality, origin, max(tissue) AS tissue, max(artifact_id) AS artifact_id, count(DISTINCT l_orderkey) AS n_participants FROM lineitem JOIN art ON l_suppkey = artifact_id GROUP BY ALL""")
def availability_groups(spark, d):
    k = F.col("s_suppkey")
    art = su.table(spark, d, "supplier").select(k.alias("artifact_id"), F.when(k % 2 == 0, "expression").otherwise("genotype").alias("modality"), F.when(k % 3 == 0, "predicted").otherwise("observed").alias("origin"), F.concat(F.lit("T"), (F.col("s_nationkey") % 4).cast("string")).alias("tissue"), F.when(k % 5 != 0, "current").otherwise("superseded").alias("status"))
    assays = su.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("artifact_id"), F.concat(F.lit("S"), (F.col("l_linenumber") % 3).cast("string")).alias("source_id"), F.col("l_orderkey").alias("participant_id"))
    return registry.availability_groups(assays, art)


@register("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS v FROM orders UNION ALL SELECT o_orderkey + 100000000, o_totalprice FROM orders WHERE o_orderkey % 1000 = 0")
def upsert_rows(spark, d):
    old = su.table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"))
    new = old.where("o_orderkey % 3 = 0").withColumn("v", F.col("v") + 1).unionByName(old.where("o_orderkey % 1000 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 100000000))
    return dedup.upsert(old, new, ["o_orderkey"])


@register("""WITH g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CASE l_linenumber % 5 WHEN 0 THEN '0|1' WHEN 1 THEN './.' WHEN 2 THEN '1/1' WHEN 3 THEN '0' ELSE '1|2' END AS gt FROM lineitem)
SELECT l_partkey, replace(gt, '|', '/') AS gt, CASE WHEN gt LIKE '%.%' THEN NULL ELSE len([a for a in regexp_split_to_array(gt, '[|/]') if a <> '0']) END::INT AS alt_count, count(*) AS n FROM g GROUP BY ALL""")
def vcf_genotype_fields(spark, d):
    m = F.col("l_linenumber") % 5
    gt = F.when(m == 0, "0|1").when(m == 1, "./.").when(m == 2, "1/1").when(m == 3, "0").otherwise("1|2")
    g = su.table(spark, d, "lineitem").select("l_partkey", F.regexp_replace(gt, r"\|", "/").alias("gt"), al.gt_alt_count(gt).alias("alt_count"))
    return g.groupBy("l_partkey", "gt", "alt_count").agg(F.count("*").alias("n"))


@register(su.with_("sites") + "SELECT p_partkey, substr('ACGTTGCATC', CAST((position - 1) % 10 AS INT) + 1, 1) || substr('ACGTTGCATC', CAST(position % 10 AS INT) + 1, 1) AS bases FROM sites")
def reference_bases(spark, d):
    s = su.sites(spark, d).select("p_partkey", "chromosome", "position")
    last = s.agg(F.max("position")).first()[0] or 0
    chunks = spark.range(last // 50 + 2).select(F.col("id").alias("chunk_no"), F.expr("repeat('ACGTTGCATC', 5)").alias("seq"))
    ref = chunks.withColumn("chromosome", F.explode(F.array(*[F.lit(str(c)) for c in range(1, 23)])))
    return builds.bases_at(s, ref, 50, F.lit(2)).select("p_partkey", "bases")


@register(su.with_("sites") + """, j AS (SELECT position, CASE WHEN p_partkey % 40 = 0 THEN 1 ELSE position END AS pos_37, position + 5 AS pos_38 FROM sites WHERE p_partkey % 2 = 0)
SELECT 'GRCh37' AS supports, CAST(0.95 AS DOUBLE) AS weight, count(*) AS n_markers FROM j HAVING count(*) >= 20 AND count(*) FILTER (position = pos_37) / count(*) >= 0.9""")
def marker_panel_evidence(spark, d):
    s = su.sites(spark, d).select(F.concat(F.lit("rs"), F.col("p_partkey").cast("string")).alias("variant_id"), "position", "p_partkey")
    panel = s.where("p_partkey % 2 = 0").select(F.col("variant_id").alias("rsid"), F.when(F.col("p_partkey") % 40 == 0, 1).otherwise(F.col("position")).alias("pos_37"), (F.col("position") + 5).alias("pos_38"))
    return builds.marker_evidence(s.select("variant_id", "position"), panel)


@register(_W + "SELECT p_partkey, CASE WHEN mt IN ('exact', 'strand_flip') THEN alt ELSE ref END AS counted_allele, " + ", ".join(f"round(sum(weight) FILTER (feature_id = 'F{i}'), 6) AS F{i}" for i in range(20)) + " FROM h WHERE outcome = 'matched' GROUP BY 1, 2")
def weights_wide(spark, d):
    m = _harmonized(spark, d).where("outcome = 'matched'")
    w = score.weights_wide(m.withColumn("geno_variant_id", F.substring("variant_id", 2, 20).cast("bigint")), [f"F{i}" for i in range(20)])
    return w.select(F.col("geno_variant_id").alias("p_partkey"), "counted_allele", *[F.round(f"F{i}", 6).alias(f"F{i}") for i in range(20)])


@register(su.with_("sites", "ann") + ", t AS (SELECT unnest(string_split(consequence, '&')) AS term FROM ann WHERE consequence IS NOT NULL) SELECT term, count(*) AS n FROM t GROUP BY 1")
def consequence_counts(spark, d):
    return annotate.consequence_counts(su.annotation(spark, d).withColumnRenamed("consequence", "Consequence"))


@register("""WITH t AS (SELECT l_partkey, CASE l_linenumber % 4 WHEN 0 THEN 'intron_variant&stop_gained' WHEN 1 THEN 'zzz,missense_variant' WHEN 2 THEN 'qqq&zzz' END AS c FROM lineitem)
SELECT l_partkey, coalesce(CASE c WHEN 'intron_variant&stop_gained' THEN 'stop_gained' WHEN 'zzz,missense_variant' THEN 'missense_variant' WHEN 'qqq&zzz' THEN 'qqq' END, '') AS most_severe, count(*) AS n FROM t GROUP BY 1, 2""")
def most_severe_term(spark, d):
    m = F.col("l_linenumber") % 4
    c = F.when(m == 0, "intron_variant&stop_gained").when(m == 1, "zzz,missense_variant").when(m == 2, "qqq&zzz")
    t = su.table(spark, d, "lineitem").select("l_partkey", F.coalesce(cq.most_severe(c), F.lit("")).alias("most_severe"))
    return t.groupBy("l_partkey", "most_severe").agg(F.count("*").alias("n"))


@register("""WITH s AS (SELECT l_partkey, max(l_discount * 10) AS s FROM lineitem GROUP BY 1) SELECT count(*) AS n_variants, count(*) FILTER (s >= 0.2) AS n_ge_0_2, count(*) FILTER (s >= 0.5) AS n_ge_0_5, count(*) FILTER (s >= 0.8) AS n_ge_0_8 FROM s""")
def splice_summary(spark, d):
    li = su.table(spark, d, "lineitem").select(F.col("l_partkey").alias("variant_key"), (F.col("l_discount") * 10).alias("score"))
    return annotate.splice_summary(li)


@register("""WITH e AS (SELECT p_partkey, 'C|' || p_brand || '|0.1|0.' || (p_size % 10) || '|0.3|0|1|2|3|4,C|short' AS v FROM part), x AS (SELECT p_partkey, unnest(string_split(v, ',')) AS e FROM e), f AS (SELECT p_partkey, string_split(e, '|') AS f FROM x)
SELECT p_partkey, f[2] AS symbol, greatest(f[3]::DOUBLE, f[4]::DOUBLE, f[5]::DOUBLE, f[6]::DOUBLE) AS score FROM f WHERE len(f) >= 10""")
def spliceai_entries(spark, d):
    from cohortix.sources.parsers import spliceai

    info = F.concat(F.lit("X=1;SpliceAI=C|"), "p_brand", F.lit("|0.1|0."), (F.col("p_size") % 10).cast("string"), F.lit("|0.3|0|1|2|3|4,C|short;Y=2"))
    p = su.table(spark, d, "part").select(F.lit("1").alias("CHROM"), F.col("p_partkey").cast("string").alias("POS"), F.lit("x").alias("ID"), F.lit("A").alias("REF"), F.lit("C").alias("ALT"), info.alias("INFO"))
    return spliceai(p).select(F.col("position").alias("p_partkey"), "symbol", "score")


@register("SELECT p_partkey, 'LOW' AS impact, CASE WHEN p_size % 2 = 0 THEN '1' END AS pick, CAST(NULL AS VARCHAR) AS canonical, 'ENSG' || p_partkey AS gene FROM part")
def vep_extra_fields(spark, d):
    p = su.table(spark, d, "part").select("p_partkey", F.concat(F.lit("IMPACT=LOW;X"), F.when(F.col("p_size") % 2 == 0, ";PICK=1").otherwise("")).alias("e"), F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string"), F.lit(".7")).alias("g"))
    m = extra_map("e")
    return p.select("p_partkey", m["IMPACT"].alias("impact"), m["PICK"].alias("pick"), m["CANONICAL"].alias("canonical"), without_version("g").alias("gene"))


@register(su.with_("sites") + "SELECT p_partkey, chromosome AS chrom, CAST(position AS VARCHAR) AS pos, ref, alt, CASE WHEN p_partkey % 2 = 0 THEN '38' ELSE '' END AS build FROM sites")
def variant_id_fields(spark, d):
    s = su.sites(spark, d)
    vid = F.concat(F.lit("chr"), F.regexp_replace("variant_key", ":", "_"), F.when(F.col("p_partkey") % 2 == 0, "_b38").otherwise(""))
    return s.select("p_partkey", *[F.regexp_extract(vid, VARIANT_ID, i).alias(n) for i, n in enumerate(("chrom", "pos", "ref", "alt", "build"), 1)])


@register(su.with_("calls") + ", m AS (SELECT sample, count(*) FILTER (alt_count IS NULL) / count(*) > 0.02 AS bad FROM calls GROUP BY 1) SELECT count(*) FILTER (bad) / count(*) AS fail_fraction, CASE WHEN count(*) FILTER (bad) / count(*) > 0.5 THEN 'FAIL' WHEN count(*) FILTER (bad) / count(*) > 0.05 THEN 'WARN' ELSE 'PASS' END AS status FROM m")
def cohort_status(spark, d):
    m = genotype.sample_missingness(su.calls(spark, d))
    return genotype.cohort_status(genotype.final_decision(m, ["fail_missing"]))


@register("""SELECT count(*) AS n_rows, CAST(CAST(sum(CAST(('0x' || substr(md5(concat_ws(chr(31), CAST(o_custkey AS VARCHAR), CAST(o_orderkey AS VARCHAR), o_orderpriority)), 1, 15))::UBIGINT AS HUGEINT)) AS DECIMAL(38, 0)) AS VARCHAR) AS digest FROM orders""")
def table_digest(spark, d):
    return profile.table_digest(su.table(spark, d, "orders").select("o_orderpriority", "o_orderkey", "o_custkey"))


@register("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Pathogenic' WHEN c_custkey % 3 = 1 THEN '' ELSE 'Likely_pathogenic' END AS sig, c_custkey % 3 <> 1 AS pathogenic FROM customer")
def clinvar_flags(spark, d):
    k = F.col("c_custkey") % 3
    info = F.when(k == 0, "CLNSIG=Pathogenic;A=1").when(k == 1, "XCLNSIG=Pathogenic").otherwise("B;CLNSIG=Likely_pathogenic")
    c = su.table(spark, d, "customer").select("c_custkey", info_value(info, "CLNSIG").alias("sig"))
    return c.withColumn("pathogenic", cq.pathogenic("sig"))


@register("""SELECT c_mktsegment, o_orderpriority, o_orderdate, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn = 1""")
def latest_rows(spark, d):
    o, c = su.table(spark, d, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey"), su.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).select("c_mktsegment", "o_orderpriority", "o_orderdate", "o_orderkey")
    return dedup.latest(j, ["c_mktsegment", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@register("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def duplicated_keys(spark, d):
    return dedup.duplicated(su.table(spark, d, "orders"), ["o_custkey"])
