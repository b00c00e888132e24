"""Queries over model weights and genetic scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions import alleles as al
from cohortix.operators import score, units

from . import surrogates as su
from .registry import register


def _weights(spark: SparkSession, d: str) -> DataFrame:
    """Line items as model weights; the allele pair says which match is met. ``_ord`` numbers equal keys."""
    s = su.sites(spark, d).select("p_partkey", "chromosome", "position", "ref", "alt")
    li = su.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount", "l_extendedprice")
    k = F.col("l_linenumber") % 5
    ea = F.when(k == 0, F.col("alt")).when(k == 1, F.col("ref")).when(k == 2, al.complement("alt")).when(k == 3, al.complement("ref")).otherwise("N")
    oa = F.when(k == 0, F.col("ref")).when(k == 1, F.col("alt")).when(k == 2, al.complement("ref")).when(k == 3, al.complement("alt")).otherwise("N")
    w = li.join(s, li["l_partkey"] == s["p_partkey"]).select(
        F.concat(F.lit("M"), (F.col("l_suppkey") % 5).cast("string")).alias("model_id"), F.concat(F.lit("F"), (F.col("l_suppkey") % 20).cast("string")).alias("feature_id"),
        "chromosome", "position", F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("variant_id"), ea.alias("effect_allele"), oa.alias("other_allele"), (F.col("l_discount") - 0.05).alias("weight"),
        F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount").alias("_ord"),
    )
    return w


def _model_sites(spark: SparkSession, d: str) -> DataFrame:
    """Sites without every 29th; every 50th is listed twice."""
    s = su.sites(spark, d).where("p_partkey % 29 <> 0").select(F.col("variant_key").alias("variant_id"), "chromosome", "position", "ref", "alt", "p_partkey")
    twice = s.where("p_partkey % 50 = 0").withColumn("variant_id", F.concat("variant_id", F.lit(":b")))
    return s.unionByName(twice)


_W = su.with_("sites") + """, w AS (SELECT 'M' || (l_suppkey % 5) AS model_id, 'F' || (l_suppkey % 20) AS feature_id, s.chromosome, s.position, 'v' || l_partkey AS variant_id, s.p_partkey, s.ref, s.alt, l_linenumber % 5 AS k, l_discount - 0.05 AS weight,
  CASE l_linenumber % 5 WHEN 0 THEN s.alt WHEN 1 THEN s.ref WHEN 2 THEN translate(s.alt, 'ACGT', 'TGCA') WHEN 3 THEN translate(s.ref, 'ACGT', 'TGCA') ELSE 'N' END AS ea,
  CASE l_linenumber % 5 WHEN 0 THEN s.ref WHEN 1 THEN s.alt WHEN 2 THEN translate(s.ref, 'ACGT', 'TGCA') WHEN 3 THEN translate(s.alt, 'ACGT', 'TGCA') ELSE 'N' END AS oa, l_orderkey, l_linenumber, l_extendedprice, l_discount FROM lineitem JOIN sites s ON s.p_partkey = l_partkey),
n AS (SELECT *, row_number() OVER (PARTITION BY model_id, feature_id, variant_id, ea, oa ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_discount) AS rn FROM w),
o AS (SELECT *, CASE WHEN ea || oa IN ('AT', 'TA', 'CG', 'GC') THEN 'ambiguous' WHEN ea = alt AND oa = ref THEN 'exact' WHEN ea = ref AND oa = alt THEN 'allele_swap' WHEN translate(ea, 'ACGT', 'TGCA') = alt AND translate(oa, 'ACGT', 'TGCA') = ref THEN 'strand_flip'
  WHEN translate(ea, 'ACGT', 'TGCA') = ref AND translate(oa, 'ACGT', 'TGCA') = alt THEN 'strand_flip_swap' ELSE 'mismatch' END AS mt FROM n),
h AS (SELECT *, CASE WHEN rn > 1 THEN 'duplicate' WHEN p_partkey % 29 = 0 THEN 'missing' WHEN mt = 'ambiguous' THEN 'ambiguous' WHEN mt = 'mismatch' THEN 'allele_mismatch' WHEN p_partkey % 50 = 0 THEN 'multiallelic' ELSE 'matched' END AS outcome FROM o)
"""


def _harmonized(spark: SparkSession, d: str) -> DataFrame:
    return score.harmonize(_weights(spark, d), _model_sites(spark, d))


@register(_W + "SELECT model_id, feature_id, variant_id, ea AS effect_allele, oa AS other_allele, mt AS match_type, mt IN ('exact', 'strand_flip') AS counts_alt, CASE WHEN mt IN ('exact', 'strand_flip') THEN alt ELSE ref END AS counted_allele FROM h WHERE outcome = 'matched'")
def harmonize_match_types(spark, d):
    return _harmonized(spark, d).where("outcome = 'matched'").select("model_id", "feature_id", "variant_id", "effect_allele", "other_allele", "match_type", "counts_alt", "counted_allele")


@register(_W + "SELECT model_id, feature_id, outcome AS reason, count(*) AS n FROM h WHERE outcome <> 'matched' GROUP BY 1, 2, 3")
def harmonize_exclusions(spark, d):
    return _harmonized(spark, d).where("outcome <> 'matched'").groupBy("model_id", "feature_id", F.col("outcome").alias("reason")).agg(F.count("*").alias("n"))


_Q = """, q AS (SELECT model_id, feature_id, count(*) AS n_model_variants, count(*) FILTER (outcome = 'matched') AS n_matched_variants, count(*) FILTER (outcome = 'matched' AND mt = 'exact') AS n_exact_matches, count(*) FILTER (outcome = 'matched' AND mt = 'allele_swap') AS n_allele_swaps,
  count(*) FILTER (outcome = 'matched' AND mt LIKE 'strand%') AS n_strand_flips, count(*) FILTER (outcome = 'missing') AS n_missing_variants, count(*) FILTER (outcome = 'ambiguous') AS n_ambiguous_excluded, count(*) FILTER (outcome = 'multiallelic') AS n_multiallelic_excluded,
  count(*) FILTER (outcome = 'allele_mismatch') AS n_allele_mismatch, count(*) FILTER (outcome = 'duplicate') AS n_duplicate_excluded FROM h GROUP BY 1, 2), c AS (SELECT *, n_matched_variants / greatest(n_model_variants - n_duplicate_excluded, 1) AS coverage_fraction FROM q)
"""


@register(_W + _Q + "SELECT *, CASE WHEN n_matched_variants = 0 THEN 'NO_MATCH' WHEN coverage_fraction < 0.5 THEN 'LOW_COVERAGE' ELSE 'OK' END AS status, false AS below_threshold, n_matched_variants > 0 AND coverage_fraction >= 0.5 AS predict FROM c")
def model_qc_coverage(spark, d):
    return score.coverage_status(score.model_quality(_harmonized(spark, d)))


@register(
    su.with_("calls") + ", " + _W.removeprefix("WITH ")
    + """SELECT c.sample, h.model_id, h.feature_id, round(sum(h.weight * CASE WHEN h.mt IN ('exact', 'strand_flip') THEN c.alt_count ELSE 2 - c.alt_count END), 6) AS score FROM h JOIN calls c ON c.variant = h.p_partkey WHERE h.outcome = 'matched' AND c.alt_count IS NOT NULL GROUP BY 1, 2, 3"""
)
def weighted_score(spark, d):
    s = su.sites(spark, d).select("p_partkey", "variant_key")
    c = su.calls(spark, d).join(s, F.col("variant") == F.col("p_partkey")).select("sample", F.col("variant_key").alias("variant"), F.col("alt_count").cast("double").alias("dosage"))
    got = score.weighted_sum(c, _harmonized(spark, d).where("outcome = 'matched'"))
    return got.select("sample", "model_id", "feature_id", F.round("score", 6).alias("score"))


@register(
    """WITH e AS (SELECT vec_id, i, CASE WHEN (vec_id + i) % 23 <> 0 THEN CAST(x AS DOUBLE) END AS o, CASE WHEN (vec_id + i) % 19 <> 0 THEN CAST(x AS DOUBLE) * 0.5 + (vec_id % 7) / 10.0::DOUBLE END AS p FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings))
SELECT CAST(i AS INT) AS feature_id, count(*) AS n, CASE WHEN count(*) >= 10 AND stddev_samp(o) > 0 AND stddev_samp(p) > 0 THEN round(corr(o, p), 6) END AS r FROM e WHERE o IS NOT NULL AND p IS NOT NULL GROUP BY 1"""
)
def observed_vs_predicted_corr(spark, d):
    e = su.table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("feature_id", "x"))
    k, x = F.col("vec_id") + F.col("feature_id"), F.col("x").cast("double")
    obs = e.select(F.col("vec_id").alias("participant_id"), "feature_id", F.when(k % 23 != 0, x).alias("value"))
    pred = e.select(F.col("vec_id").alias("participant_id"), "feature_id", F.when(k % 19 != 0, x * 0.5 + (F.col("vec_id") % 7) / 10.0).alias("value"))
    return score.compare(obs, pred).withColumn("r", F.round("r", 6))


@register(
    """WITH s AS (SELECT l_partkey AS cpg_id, 'm' || (l_linenumber % 4) AS method, max(l_returnflag <> 'N') AS valid, max(CASE WHEN l_linenumber % 5 <> 0 THEN l_discount END) AS test_r2, count(CASE WHEN l_tax > 0 THEN l_tax END) AS n_weights FROM lineitem GROUP BY 1, 2),
b AS (SELECT *, row_number() OVER (PARTITION BY cpg_id ORDER BY test_r2 DESC NULLS LAST, CASE method WHEN 'm2' THEN 0 WHEN 'm1' THEN 1 WHEN 'm3' THEN 2 ELSE 3 END) AS rn FROM s WHERE valid AND n_weights > 0)
SELECT cpg_id, method, test_r2, n_weights, coalesce(test_r2 <= 0.005, true) AS below_threshold FROM b WHERE rn = 1"""
)
def best_model_per_cpg(spark, d):
    li = su.table(spark, d, "lineitem")
    x = li.select(
        F.col("l_partkey").alias("cpg_id"), F.concat(F.lit("m"), (F.col("l_linenumber") % 4).cast("string")).alias("method"), (F.col("l_returnflag") != "N").alias("valid"),
        F.when(F.col("l_linenumber") % 5 != 0, F.col("l_discount")).alias("test_r2"), F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("weight"),
    )
    got = score.best_models(score.model_stats(x), ["m2", "m1", "m3", "m0"])
    return got.select("cpg_id", "method", "test_r2", "n_weights", "below_threshold")


@register(
    """WITH a AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN [c_mktsegment] WHEN 1 THEN ['BUILDING', 'MACHINERY'] WHEN 2 THEN [c_mktsegment, 'BUILDING'] END AS model, CASE WHEN c_custkey % 5 <> 0 THEN list_distinct(['BUILDING', c_mktsegment]) END AS cohort FROM customer),
b AS (SELECT *, len(list_intersect(list_distinct(model), cohort)) AS k FROM a)
SELECT c_custkey, CASE WHEN model IS NULL OR cohort IS NULL THEN 'unknown' WHEN k = 0 THEN 'mismatched' WHEN k = len(cohort) AND len(model) = 1 THEN 'matched' WHEN k = len(cohort) THEN 'mixed' ELSE 'partial' END AS status FROM b"""
)
def ancestry_match_status(spark, d):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    model = F.when(k % 4 == 0, F.array(seg)).when(k % 4 == 1, F.array(F.lit("BUILDING"), F.lit("MACHINERY"))).when(k % 4 == 2, F.array(seg, F.lit("BUILDING")))
    cohort = F.when(k % 5 != 0, F.array_distinct(F.array(F.lit("BUILDING"), seg)))
    return su.table(spark, d, "customer").select("c_custkey", score.ancestry_match(model, cohort).alias("status"))


@register(
    """WITH g AS (SELECT 'rs' || l_partkey AS snp, CAST(l_partkey % 24 + 1 AS VARCHAR) AS chrom, 1000 + l_partkey AS pos, CASE l_linenumber % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'I' END AS ea, 'T' AS nea, l_discount AS p, l_tax AS se, l_extendedprice / 1000 AS beta FROM lineitem),
c AS (SELECT *, CASE chrom WHEN '23' THEN 'X' WHEN '24' THEN 'Y' ELSE chrom END AS chr2 FROM g), k AS (SELECT * FROM c WHERE ea <> 'I' AND p BETWEEN 0 AND 1 AND se > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY chr2, pos, ea, nea ORDER BY p, beta) AS rn FROM k) SELECT snp AS snpid, chr2 AS chrom, pos, ea, nea, p FROM r WHERE rn = 1"""
)
def gwas_checked(spark, d):
    from cohortix.operators import gwas

    li, m = su.table(spark, d, "lineitem"), F.col("l_linenumber") % 4
    raw = li.select(
        F.concat(F.lit("rs"), F.col("l_partkey").cast("string")).alias("SNP"), (F.col("l_partkey") % 24 + 1).cast("string").alias("CHR"), (1000 + F.col("l_partkey")).cast("string").alias("BP"),
        F.when(m == 0, "a").when(m == 1, "c").when(m == 2, "g").otherwise("i").alias("A1"), F.lit("t").alias("A2"), F.col("l_discount").cast("string").alias("P"), F.col("l_tax").cast("string").alias("SE"), (F.col("l_extendedprice") / 1000).cast("string").alias("BETA"),
    )
    return gwas.checked(gwas.standard(raw)).select("snpid", "chrom", "pos", "ea", "nea", "p")


@register(
    """WITH s AS (SELECT l_partkey AS variant_key, 'ENST' || l_suppkey || '.' || l_linenumber AS transcript_id, l_discount AS score FROM lineitem), p AS (SELECT l_partkey AS variant_key, min('ENST' || l_suppkey) AS t FROM lineitem GROUP BY 1),
j AS (SELECT s.*, regexp_replace(s.transcript_id, '\\.\\d+$', '') = p.t AS same FROM s JOIN p USING (variant_key)), r AS (SELECT *, row_number() OVER (PARTITION BY variant_key ORDER BY same DESC, score DESC NULLS LAST, transcript_id) AS rn FROM j)
SELECT variant_key, transcript_id, score FROM r WHERE rn = 1"""
)
def best_annotation_row(spark, d):
    from cohortix.operators.annotate import best_scored

    li = su.table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_discount")
    t = F.concat(F.lit("ENST"), F.col("l_suppkey").cast("string"))
    scores = li.select(F.col("l_partkey").alias("variant_key"), F.concat(t, F.lit("."), F.col("l_linenumber").cast("string")).alias("transcript_id"), F.col("l_discount").alias("score"))
    picked = li.groupBy(F.col("l_partkey").alias("variant_key")).agg(F.min(t).alias("Feature"))
    return best_scored(picked, scores, "score")


@register("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS rn FROM lineitem) SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey FROM r WHERE rn > 1""")
def duplicate_model_rows(spark, d):
    from cohortix.operators.dedup import later_rows

    li = su.table(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice").alias("_ord"))
    return later_rows(li, ["l_partkey"]).drop("_ord")


# One unit of weights: every third feature is below the provider's threshold; names and R² follow from the feature's number.
_UNIT = su.with_("calls") + ", " + _W.removeprefix("WITH ") + """, q AS (SELECT model_id, feature_id, CAST(substr(feature_id, 2) AS INT) AS i, count(*) AS n, count(*) FILTER (outcome = 'matched') AS m, count(*) FILTER (outcome = 'duplicate') AS du FROM h GROUP BY 1, 2),
c1 AS (SELECT *, m / greatest(n - du, 1) AS cov, i % 3 = 0 AS below, CASE WHEN i % 4 <> 0 THEN i / 20 END AS r2 FROM q),
s1 AS (SELECT *, CASE WHEN m = 0 THEN 'NO_MATCH' WHEN cov < 0.55 THEN 'LOW_COVERAGE' ELSE 'OK' END AS status FROM c1)
"""


def _unit(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    w = _weights(spark, d).withColumn("genome_build", F.lit("GRCh38"))
    i = F.substring("feature_id", 2, 9).cast("int")
    features = w.select("model_id", "feature_id").distinct().withColumns({"feature_name": F.concat(F.lit("N"), i.cast("string")), "n_variants": F.lit(1).cast("bigint"), "validation_r2": F.when(i % 4 != 0, i / 20), "below_threshold": i % 3 == 0})
    s = su.sites(spark, d).select("p_partkey", "variant_key")
    c = su.calls(spark, d).join(s, F.col("variant") == F.col("p_partkey")).select("sample", F.col("variant_key").alias("variant"), F.col("alt_count").cast("double").alias("dosage"))
    k = F.col("c_custkey")
    people = su.table(spark, d, "customer").select(k.alias("sample"), F.when(k % 7 != 0, F.concat(F.lit("N"), k.cast("string"))).alias("native_id"), su.participant_id().alias("participant_id"))
    return features, *units.run_unit(w, features, _model_sites(spark, d), c, people, "GRCh38", 0.55, ord_col="_ord")


@register(
    _UNIT
    + """SELECT CASE WHEN c.sample % 7 <> 0 THEN 'N' || c.sample ELSE CAST(c.sample AS VARCHAR) END AS native_id, 'P' || c.sample AS participant_id, h.model_id, h.feature_id, round(sum(h.weight * CASE WHEN h.mt IN ('exact', 'strand_flip') THEN c.alt_count ELSE 2 - c.alt_count END), 6) AS predicted_value
FROM h JOIN s1 USING (model_id, feature_id) JOIN calls c ON c.variant = h.p_partkey WHERE h.outcome = 'matched' AND c.alt_count IS NOT NULL AND s1.status = 'OK' AND NOT s1.below GROUP BY 1, 2, 3, 4"""
)
def unit_scores(spark, d):
    _, scores, _, _ = _unit(spark, d)
    return scores.withColumn("predicted_value", F.round("predicted_value", 6))


@register(
    _UNIT
    + """SELECT count(*) AS features_in_model, count(*) FILTER (status = 'OK' AND NOT below) AS features_predicted, count(*) FILTER (status = 'LOW_COVERAGE') AS low_coverage_features, round(median(cov), 6) AS median_coverage_fraction, round(median(r2), 6) AS median_validation_r2, 'GRCh38' AS genome_build FROM s1"""
)
def unit_manifest(spark, d):
    _, _, _, m = _unit(spark, d)
    return m.withColumns({c: F.round(c, 6) for c in ("median_coverage_fraction", "median_validation_r2")})


@register(
    _UNIT
    + """SELECT model_id, 'p' AS provider, 'd' AS provider_dataset_id, 'expression' AS modality, feature_id, 'N' || i AS feature_name, CAST(NULL AS VARCHAR) AS tissue, 'GRCh38' AS genome_build, r2 AS validation_r2, CAST(1 AS BIGINT) AS n_variants, round(cov, 6) AS coverage_fraction, status FROM s1
UNION ALL SELECT 'old', 'p', 'd', 'expression', 'G' || p_partkey, NULL, CASE p_partkey % 3 WHEN 0 THEN 'liver' ELSE 'blood' END, NULL, NULL, NULL, NULL, 'OK' FROM part WHERE p_partkey % 4 IN (0, 1)"""
)
def model_catalogue(spark, d):
    """A unit of no tissue takes the place of old rows of no tissue and of an empty one; other tissues stay."""
    p, k = su.table(spark, d, "part"), F.col("p_partkey")
    tissue = F.when(k % 4 == 2, "").when(k % 4 != 3, F.when(k % 3 == 0, "liver").otherwise("blood"))
    old = p.select(F.lit("old").alias("model_id"), F.lit("p").alias("provider"), F.lit("d").alias("provider_dataset_id"), F.lit("expression").alias("modality"), F.concat(F.lit("G"), k.cast("string")).alias("feature_id"), tissue.alias("tissue"), F.lit("OK").alias("status"))
    features, _, quality, _ = _unit(spark, d)
    rows = units.catalogue_rows(features, quality, "p", "d", "expression", None, "GRCh38").withColumn("coverage_fraction", F.round("coverage_fraction", 6))
    return units.replace_unit(units.standardize(old, units.CATALOGUE), rows)


@register(su.with_("sites") + "SELECT chromosome, CAST(position AS BIGINT) AS position, ref AS reference, alt AS alternate, p_brand AS track, p_size / 50 AS effect FROM sites WHERE p_partkey % 3 = 0")
def atlas_join(spark, d):
    s = su.sites(spark, d).withColumnsRenamed({"ref": "reference", "alt": "alternate"})
    wanted = s.select("chromosome", F.col("position").cast("bigint").alias("position"), "reference", "alternate")
    k = F.col("p_partkey")
    table = s.select(F.concat(F.lit("chr"), "chromosome").alias("chromosome"), F.col("position").cast("string").alias("position"), F.when(k % 3 == 0, F.col("reference")).otherwise("N").alias("reference"), "alternate", F.col("p_brand").alias("track"), (F.col("p_size") / 50).alias("effect"))
    return units.atlas(wanted, table)


@register("SELECT 'P' || c_custkey AS participant_id, 'F' || c_nationkey AS feature_id, CAST(c_custkey AS DOUBLE) AS score, CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey / 25 END AS validation_r2 FROM customer")
def scores_with_validation(spark, d):
    c, n = su.table(spark, d, "customer"), su.table(spark, d, "nation")
    v = n.select(F.concat(F.lit("F"), F.col("n_nationkey").cast("string")).alias("feature_id"), F.when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey") / 25).alias("validation_r2"))
    s = c.select(su.participant_id().alias("participant_id"), F.concat(F.lit("F"), F.col("c_nationkey").cast("string")).alias("feature_id"), F.col("c_custkey").cast("double").alias("score"))
    return units.with_validation(s, v)
