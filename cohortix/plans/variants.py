"""Queries over variants, genotypes and annotation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions import alleles as al
from cohortix.functions.text import info_value
from cohortix.operators import annotate as an
from cohortix.operators import builds, genotype, pairs, stats, unrelated
from cohortix.operators import pca as components
from cohortix.operators.annotate import sized

from . import surrogates as su
from .registry import register

CARRIED = ("sites", "calls", "carriers", "ann", "carried")


def _carried(spark: SparkSession, d: str) -> DataFrame:
    return an.carried(su.carriers(spark, d), su.annotation(spark, d))


_TOTALS = """SELECT participant_id, count(*) AS n_variants_total, sum(dosage) AS alt_alleles_total, count(*) FILTER (heterozygous) AS n_heterozygous, count(*) FILTER (homozygous_alt) AS n_homozygous_alt,
  count(*) FILTER (consequence IS NULL) AS n_unannotated, count(*) FILTER (is_lof) AS n_lof, coalesce(sum(dosage) FILTER (is_lof), 0) AS alt_burden_lof, count(*) FILTER (is_splice) AS n_splice,
  count(*) FILTER (is_damaging_missense) AS n_damaging_missense, coalesce(sum(dosage) FILTER (is_damaging_missense), 0) AS alt_burden_damaging_missense, count(*) FILTER (is_pathogenic) AS n_clinvar_pathogenic,
  count(*) FILTER (is_rare) AS n_rare, count(*) FILTER (is_rare AND (is_lof OR is_damaging_missense)) AS n_rare_damaging,
  count(*) FILTER (spliceai_max_score >= 0.2) AS n_spliceai_ge_0_2, count(*) FILTER (spliceai_max_score >= 0.5) AS n_spliceai_ge_0_5, count(*) FILTER (spliceai_max_score >= 0.8) AS n_spliceai_ge_0_8
  FROM carried GROUP BY 1"""
_TOTAL_COLS = "n_variants_total alt_alleles_total n_heterozygous n_homozygous_alt n_unannotated n_lof alt_burden_lof n_splice n_damaging_missense alt_burden_damaging_missense n_clinvar_pathogenic n_rare n_rare_damaging n_spliceai_ge_0_2 n_spliceai_ge_0_5 n_spliceai_ge_0_8".split()


@register(su.with_(*CARRIED) + f", t AS ({_TOTALS}) SELECT 'P' || c_custkey AS participant_id, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in _TOTAL_COLS) + " FROM customer LEFT JOIN t ON t.participant_id = 'P' || c_custkey")
def participant_burden_totals(spark, d):
    return an.with_all_participants(su.participants(spark, d), an.participant_totals(_carried(spark, d)))


_REPORTED = ("missense_variant", "synonymous_variant", "stop_gained", "splice_region_variant", "intron_variant", "stop_lost")


@register(
    su.with_(*CARRIED)
    + ", t AS (SELECT participant_id, dosage, unnest(string_split(consequence, '&')) AS term FROM carried WHERE consequence IS NOT NULL), w AS (SELECT participant_id, "
    + ", ".join(f"count(*) FILTER (term = '{t}') AS n_{t}, coalesce(sum(dosage) FILTER (term = '{t}'), 0) AS alt_burden_{t}" for t in _REPORTED)
    + " FROM t GROUP BY 1) SELECT 'P' || c_custkey AS participant_id, "
    + ", ".join(f"coalesce(n_{t}, 0) AS n_{t}, coalesce(alt_burden_{t}, 0) AS alt_burden_{t}" for t in _REPORTED)
    + " FROM customer LEFT JOIN w ON w.participant_id = 'P' || c_custkey"
)
def consequence_term_matrix(spark, d):
    return an.consequence_matrix(su.participants(spark, d), _carried(spark, d), _REPORTED)


@register(
    su.with_(*CARRIED)
    + """SELECT participant_id, gene_id, min(gene_symbol) AS gene_symbol, count(*) AS n_variants, sum(dosage) AS n_alt_alleles, count(*) FILTER (is_missense) AS n_missense, count(*) FILTER (is_lof) AS n_lof,
  count(*) FILTER (is_splice) AS n_splice, count(*) FILTER (is_damaging_missense) AS n_damaging_missense, max(alphamissense_score) AS max_alphamissense, max(spliceai_max_score) AS max_spliceai, min(gnomad_af) AS min_gnomad_af
FROM carried WHERE gene_id IS NOT NULL GROUP BY 1, 2"""
)
def gene_burden(spark, d):
    return an.gene_burden(_carried(spark, d))


@register(
    su.with_("sites")
    + """, t AS (SELECT l_partkey, l_suppkey, l_returnflag = 'R' AND l_linestatus = 'F' AS pick, l_returnflag = 'A' AS canon,
  CASE split_part(p_type, ' ', 1) WHEN 'PROMO' THEN 'stop_gained' WHEN 'SMALL' THEN 'missense_variant' WHEN 'MEDIUM' THEN 'synonymous_variant' WHEN 'ECONOMY' THEN 'intron_variant' END AS cons
  FROM lineitem JOIN sites ON p_partkey = l_partkey),
r AS (SELECT *, CASE WHEN l_suppkey % 3 = 0 THEN 'stop_lost' ELSE cons END AS c2 FROM t),
k AS (SELECT *, CASE c2 WHEN 'stop_gained' THEN 3 WHEN 'stop_lost' THEN 5 WHEN 'missense_variant' THEN 12 WHEN 'synonymous_variant' THEN 21 WHEN 'intron_variant' THEN 27 END AS rk FROM r),
b AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY pick DESC, canon DESC, rk ASC NULLS LAST, lpad(CAST(l_suppkey AS VARCHAR), 9, '0')) AS rn FROM k)
SELECT l_partkey AS variant_key, lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS feature, c2 AS most_severe_consequence, CASE WHEN pick THEN 'PICK' WHEN canon THEN 'canonical' ELSE 'most_severe' END AS picked_by FROM b WHERE rn = 1"""
)
def vep_pick_best_row(spark, d):
    s = su.sites(spark, d).withColumn("cons", F.when(~F.col("p_type").startswith("LARGE"), su.consequence()))
    li = su.table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
    rows = li.join(s, li["l_partkey"] == s["p_partkey"]).select(
        F.col("l_partkey").alias("variant_key"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0").alias("Feature"), F.when(F.col("l_suppkey") % 3 == 0, "stop_lost").otherwise(F.col("cons")).alias("Consequence"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "1").alias("PICK"), F.when(F.col("l_returnflag") == "A", "YES").alias("CANONICAL"),
    )
    return an.pick_transcript(rows).select("variant_key", F.col("Feature").alias("feature"), "most_severe_consequence", "picked_by")


@register(
    su.with_("sites", "ann")
    + """SELECT s.variant_key, a.gene_id, a.gene_symbol, a.consequence, nullif(a.most_severe_consequence, '') AS most_severe_consequence, CASE WHEN s.p_partkey % 3 <> 0 THEN a.clinvar_significance END AS clinvar_significance,
  CASE WHEN s.p_partkey % 5 <> 0 THEN a.gnomad_af END AS gnomad_af, a.alphamissense_score, CAST(NULL AS DOUBLE) AS spliceai_max_score FROM sites s LEFT JOIN ann a USING (variant_key)"""
)
def annotation_table_left_chain(spark, d):
    s, a = su.sites(spark, d), su.annotation(spark, d)
    keep = lambda m: s.where(F.col("p_partkey") % m != 0).select("variant_key")
    vep = a.select("variant_key", "gene_id", "gene_symbol", "consequence", "most_severe_consequence")
    clin = a.join(keep(3), "variant_key", "left_semi").select("variant_key", "clinvar_significance")
    freq = a.join(keep(5), "variant_key", "left_semi").select("variant_key", "gnomad_af")
    out = an.annotation_table(s, vep, clin, freq, a.select("variant_key", "alphamissense_score"))
    return out.drop("transcript_id", "impact")


@register(
    su.with_("sites")
    + """, refs AS (SELECT CASE WHEN p_partkey % 2 = 1 THEN 'chr' ELSE '' END || chromosome AS chromosome, position, lower(ref) AS ref, alt || ',' || CASE WHEN alt = 'A' THEN 'C' ELSE 'A' END AS alts, 'rs' || p_partkey AS id FROM sites),
e AS (SELECT regexp_replace(chromosome, '^chr', '') AS chromosome, position, upper(ref) AS ref, unnest(string_split(alts, ',')) AS alt, id FROM refs)
SELECT DISTINCT s.variant_key, e.id AS reference_id FROM sites s JOIN e USING (chromosome, position, ref, alt)"""
)
def reference_lookup_multiallelic(spark, d):
    s = su.sites(spark, d)
    other = F.when(F.col("alt") == "A", "C").otherwise("A")
    refs = s.select(F.concat(F.when(F.col("p_partkey") % 2 == 1, "chr").otherwise(""), "chromosome").alias("chromosome"), "position", F.lower("ref").alias("ref"), F.concat_ws(",", "alt", other).alias("alt"), F.concat(F.lit("rs"), F.col("p_partkey").cast("string")).alias("reference_id"))
    return an.reference_lookup(s, refs, ["reference_id"])


@register("""WITH i AS (SELECT p_partkey, 'AF=' || CAST(p_size AS VARCHAR) || ';CLNSIG=' || p_brand || ';XAF=9' AS info FROM part)
SELECT p_partkey, regexp_extract(info, '(?:^|;)AF=([^;]*)', 1) AS af, regexp_extract(info, '(?:^|;)CLNSIG=([^;]*)', 1) AS clnsig, regexp_extract(info, '(?:^|;)LNSIG=([^;]*)', 1) AS absent FROM i""")
def info_field_extract(spark, d):
    p = su.table(spark, d, "part").select("p_partkey", F.concat(F.lit("AF="), F.col("p_size").cast("string"), F.lit(";CLNSIG="), "p_brand", F.lit(";XAF=9")).alias("info"))
    return p.select("p_partkey", info_value("info", "AF").alias("af"), info_value("info", "CLNSIG").alias("clnsig"), info_value("info", "LNSIG").alias("absent"))


@register("""SELECT page_id, CASE WHEN url LIKE '%?%page=%' THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) ELSE '' END AS page, regexp_extract(url, '^([a-z]+)://', 1) AS scheme FROM pages""")
def url_field_extract(spark, d):
    p = su.table(spark, d, "pages").select("page_id", "url")
    return p.select("page_id", F.when(F.col("url").like("%?%page=%"), F.regexp_extract("url", "[?&]page=([^&#]*)", 1)).otherwise("").alias("page"), F.regexp_extract("url", "^([a-z]+)://", 1).alias("scheme"))


# Reference bases of the surrogate sites: five outcomes by key.
_REF_CASE = "CASE p_partkey % 6 WHEN 0 THEN ref WHEN 1 THEN alt WHEN 2 THEN translate(ref, 'ACGT', 'TGCA') WHEN 3 THEN translate(alt, 'ACGT', 'TGCA') WHEN 4 THEN 'N' END"


@register(
    su.with_("sites")
    + f""", r AS (SELECT *, {_REF_CASE} AS base, (ref || alt) IN ('AT', 'TA', 'CG', 'GC') AS amb, translate(ref, 'ACGT', 'TGCA') AS cref, translate(alt, 'ACGT', 'TGCA') AS calt FROM sites)
SELECT p_partkey, CASE WHEN base IS NULL THEN 'unverified' WHEN base = ref THEN 'match' WHEN base = alt THEN 'swapped' WHEN NOT amb AND base = cref THEN 'strand_flipped' WHEN NOT amb AND base = calt THEN 'strand_flipped_swapped' ELSE 'mismatch' END AS status FROM r"""
)
def orientation_status(spark, d):
    s = su.sites(spark, d)
    m = F.col("p_partkey") % 6
    base = F.when(m == 0, F.col("ref")).when(m == 1, F.col("alt")).when(m == 2, al.complement("ref")).when(m == 3, al.complement("alt")).when(m == 4, "N")
    return s.select("p_partkey", al.orientation("alt", "ref", base)["status"].alias("status"))


@register(
    su.with_("sites", "calls")
    + """, c AS (SELECT sample, variant, CASE chromosome WHEN '21' THEN '23' WHEN '22' THEN '24' ELSE chromosome END AS raw, sample % 2 = 1 AS male, alt_count, variant % 2 = 0 AS fwd FROM calls JOIN sites ON p_partkey = variant),
p AS (SELECT *, CASE WHEN raw = '24' THEN 1 WHEN raw = '23' AND male THEN 1 ELSE 2 END AS ploidy, CASE WHEN fwd THEN alt_count ELSE 2 - alt_count END AS n FROM c)
SELECT sample, variant, ploidy, CASE WHEN n IS NULL OR (ploidy = 1 AND n = 1) THEN NULL WHEN ploidy = 1 THEN CAST(n / 2 AS INT) ELSE CAST(n AS INT) END AS alt_count,
  CASE WHEN n IS NULL OR (ploidy = 1 AND n = 1) THEN CASE WHEN ploidy = 1 THEN '.' ELSE './.' END WHEN ploidy = 1 THEN CAST(CAST(n / 2 AS INT) AS VARCHAR) WHEN n = 0 THEN '0/0' WHEN n = 1 THEN '0/1' ELSE '1/1' END AS gt FROM p"""
)
def alt_count_ploidy(spark, d):
    s = su.sites(spark, d).select("p_partkey", F.when(F.col("chromosome") == "21", "23").when(F.col("chromosome") == "22", "24").otherwise(F.col("chromosome")).alias("raw_chromosome"))
    c = su.calls(spark, d).withColumnRenamed("alt_count", "a1_count").join(sized(s), F.col("variant") == F.col("p_partkey"))
    c = c.withColumns({"chromosome": al.chromosome("raw_chromosome"), "male": F.col("sample") % 2 == 1, "a1_is_alt": F.col("variant") % 2 == 0})
    return genotype.call_columns(c).select("sample", "variant", "ploidy", "alt_count", F.col("GT").alias("gt"))


@register(su.with_("calls") + "SELECT variant, count(alt_count) AS n_called, count(*) FILTER (alt_count > 0) AS n_carriers, count(*) FILTER (alt_count = 2) AS n_hom_alt, CAST(coalesce(sum(alt_count), 0) AS BIGINT) AS alt_allele_count FROM calls GROUP BY 1")
def site_statistics(spark, d):
    return genotype.site_statistics(su.calls(spark, d))


@register(su.with_("calls") + "SELECT sample, count(*) AS n_total, count(*) FILTER (alt_count IS NULL) AS n_missing, count(*) FILTER (alt_count IS NULL) / count(*) AS missing_fraction, count(*) FILTER (alt_count IS NULL) / count(*) > 0.02 AS fail_missing FROM calls GROUP BY 1")
def sample_missingness(spark, d):
    return genotype.sample_missingness(su.calls(spark, d))


@register(
    su.with_("calls")
    + """, m AS (SELECT variant, count(*) AS n_total, count(*) FILTER (alt_count IS NULL) / count(*) AS missing_fraction, CAST(sum(alt_count) AS BIGINT) / nullif(2 * count(alt_count), 0) AS alt_freq, count(*) FILTER (alt_count = 0) AS n_hom_ref,
  count(*) FILTER (alt_count = 1) AS n_het, count(*) FILTER (alt_count = 2) AS n_hom_alt FROM calls GROUP BY 1), k AS (SELECT *, CASE WHEN alt_freq IS NOT NULL THEN least(alt_freq, 1 - alt_freq) END AS maf FROM m)
SELECT *, missing_fraction > 0.02 AS fail_missing, coalesce(maf, 0) < 0.01 AS fail_maf, NOT (missing_fraction > 0.02) AND NOT (coalesce(maf, 0) < 0.01) AS passes FROM k"""
)
def variant_maf_missingness(spark, d):
    return genotype.variant_metrics(su.calls(spark, d))


@register(
    su.with_("calls")
    + """, m AS (SELECT variant, count(*) FILTER (alt_count = 0) AS r, count(*) FILTER (alt_count = 1) AS h, count(*) FILTER (alt_count = 2) AS a FROM calls GROUP BY 1),
e AS (SELECT DISTINCT r, h, a, r + h + a AS n, 2 * least(r, a) + h AS rare FROM m WHERE r + h + a > 0), k AS (SELECT *, unnest(range(rare % 2, rare + 1, 2)) AS k FROM e),
l AS (SELECT *, k * ln(2) - lgamma((rare - k) / 2 + 1) - lgamma(k + 1) - lgamma(n - k - (rare - k) / 2 + 1) AS l FROM k), o AS (SELECT r, h, a, max(l) FILTER (k = h) AS own, max(l) AS top FROM l GROUP BY 1, 2, 3),
p AS (SELECT r, h, a, least(1, sum(exp(l - top)) FILTER (l <= own + 1e-9) / sum(exp(l - top))) AS p FROM l JOIN o USING (r, h, a) GROUP BY 1, 2, 3)
SELECT variant, r AS n_hom_ref, h AS n_het, a AS n_hom_alt, round(p, 9) AS hwe_p, coalesce(p < 1e-6, false) AS fail_hwe FROM m LEFT JOIN p USING (r, h, a)"""
)
def hwe_exact(spark, d):
    return stats.hardy_weinberg(genotype.variant_metrics(su.calls(spark, d))).select("variant", "n_hom_ref", "n_het", "n_hom_alt", F.round("hwe_p", 9).alias("hwe_p"), "fail_hwe")


@register(su.with_("calls") + "SELECT variant, count(*) FILTER (alt_count = 0) AS n_hom_ref, count(*) FILTER (alt_count = 1) AS n_het, count(*) FILTER (alt_count = 2) AS n_hom_alt FROM calls GROUP BY 1")
def hwe_counts(spark, d):
    return genotype.variant_metrics(su.calls(spark, d)).select("variant", "n_hom_ref", "n_het", "n_hom_alt")


@register(
    su.with_("calls")
    + """, f AS (SELECT variant, count(alt_count) AS called, CAST(sum(alt_count) AS BIGINT) AS alts FROM calls GROUP BY 1 HAVING count(alt_count) > 1),
e AS (SELECT variant, 1 - 2 * (alts / (2 * called)) * (1 - alts / (2 * called)) * (2 * called) / (2 * called - 1) AS e FROM f),
s AS (SELECT sample, count(*) FILTER (alt_count <> 1) AS o_hom, sum(e) AS e_hom, count(*) AS n_called FROM calls JOIN e USING (variant) WHERE alt_count IS NOT NULL GROUP BY 1),
g AS (SELECT *, (o_hom - e_hom) / nullif(n_called - e_hom, 0) AS f FROM s)
SELECT sample, o_hom, round(e_hom, 6) AS e_hom, n_called, round(f, 6) AS f, coalesce(abs(f - (SELECT avg(f) FROM g)) > 3 * (SELECT stddev_samp(f) FROM g), false) AS fail_het FROM g"""
)
def heterozygosity_f(spark, d):
    h = genotype.heterozygosity(su.calls(spark, d))
    return h.select("sample", "o_hom", F.round("e_hom", 6).alias("e_hom"), "n_called", F.round("f", 6).alias("f"), "fail_het")


# All pairs of customers that share a part.
_PAIRS = """own AS (SELECT DISTINCT o_custkey AS s, l_partkey AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey), n AS (SELECT s, count(*) AS n FROM own GROUP BY 1),
pairs AS (SELECT x.s AS a, y.s AS b, count(*) AS n_shared FROM own x JOIN own y ON x.v = y.v AND x.s < y.s GROUP BY 1, 2),
k AS (SELECT a, b, n_shared, n_shared / least(na.n, nb.n) AS share FROM pairs JOIN n na ON na.s = a JOIN n nb ON nb.s = b)"""


def _own(spark: SparkSession, d: str) -> DataFrame:
    li, o = su.table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), su.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(F.col("o_custkey").alias("sample"), F.col("l_partkey").alias("variant"))


@register(f"WITH {_PAIRS} SELECT a, b, n_shared, share FROM k WHERE n_shared >= 2")
def pair_sharing(spark, d):
    return pairs.shared(_own(spark, d), 2)


@register(f"WITH {_PAIRS} SELECT CASE WHEN share > 0.354 THEN 'duplicate_or_twin' WHEN share > 0.177 THEN 'first_degree' WHEN share > 0.0884 THEN 'second_degree' WHEN share > 0.0442 THEN 'third_degree' ELSE 'unrelated' END AS relationship, count(*) AS n_pairs FROM k GROUP BY 1")
def relationship_degree(spark, d):
    return pairs.degree_counts(_own(spark, d))


_KING = """, c AS (SELECT * FROM calls WHERE alt_count IS NOT NULL), h AS (SELECT sample, count(*) AS n FROM c WHERE alt_count = 1 GROUP BY 1),
p AS (SELECT x.sample AS a, y.sample AS b, count(*) FILTER (x.alt_count = 1 AND y.alt_count = 1) AS het_het, count(*) FILTER (abs(x.alt_count - y.alt_count) = 2) AS ibs0, count(*) AS n_sites FROM c x JOIN c y ON x.variant = y.variant AND x.sample < y.sample GROUP BY 1, 2),
k AS (SELECT p.*, (het_het - 2 * ibs0) / (ha.n + hb.n) AS kinship FROM p JOIN h ha ON ha.sample = a JOIN h hb ON hb.sample = b)"""


@register(
    su.with_("calls")
    + _KING
    + """
SELECT a, b, n_sites, het_het, ibs0, round(kinship, 9) AS kinship, CASE WHEN kinship > 0.354 THEN 'duplicate_or_twin' WHEN kinship > 0.177 THEN 'first_degree' WHEN kinship > 0.0884 THEN 'second_degree' ELSE 'third_degree' END AS relationship FROM k WHERE kinship > 0.0442"""
)
def king_kinship(spark, d):
    return pairs.kinship(su.calls(spark, d)).withColumn("kinship", F.round("kinship", 9))


# The rule one sample after another: the edges left are a list that each step filters.
_UNRELATED = """miss AS (SELECT sample, count(*) FILTER (alt_count IS NULL) / count(*) AS m FROM calls GROUP BY 1),
st AS (SELECT 0 AS step, (SELECT list({'a': a, 'b': b, 'ma': ma.m, 'mb': mb.m}) FROM k JOIN miss ma ON ma.sample = a JOIN miss mb ON mb.sample = b WHERE kinship > 0.0442) AS e, CAST(NULL AS BIGINT) AS gone
  UNION ALL SELECT step + 1, [x FOR x IN e IF x.a <> v AND x.b <> v], v FROM (SELECT step, e, (SELECT s.s FROM (SELECT unnest(list_concat([{'s': x.a, 'm': x.ma} FOR x IN e], [{'s': x.b, 'm': x.mb} FOR x IN e])) AS s) GROUP BY s.s, s.m ORDER BY count(*) DESC, s.m DESC, s.s DESC LIMIT 1) AS v FROM st WHERE len(e) > 0))"""


@register(su.with_("calls").replace("WITH", "WITH RECURSIVE", 1) + _KING + ",\n" + _UNRELATED + "\nSELECT gone AS sample FROM st WHERE gone IS NOT NULL")
def unrelated_set(spark, d):
    """Samples to remove until no pair over the third degree is left, after kinship over all calls."""
    c = su.calls(spark, d)
    return unrelated.unrelated_removal(pairs.kinship(c).select("a", "b"), genotype.sample_missingness(c)).select("sample")


@register(
    """WITH e AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings), c AS (SELECT label, i, avg(CAST(x AS DOUBLE)) AS x FROM e GROUP BY 1, 2),
d AS (SELECT e.vec_id, c.label, sqrt(sum((CAST(e.x AS DOUBLE) - c.x) * (CAST(e.x AS DOUBLE) - c.x))) AS d FROM e JOIN c USING (i) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS rn FROM d)
SELECT a.vec_id AS id, a.label, round(1 - a.d / b.d, 6) AS confidence FROM r a JOIN r b ON a.vec_id = b.vec_id AND a.rn = 1 AND b.rn = 2"""
)
def nearest_centroid(spark, d):
    e = su.table(spark, d, "embeddings").select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    got = stats.nearest_centroid(e.select(F.col("vec_id").alias("id"), "v"), e.select("label", "v"))
    return got.withColumn("confidence", F.round("confidence", 6))


def _blocks(spark: SparkSession) -> DataFrame:
    rows = []
    for c in range(1, 23):
        rows += [(str(c), 0, 8000, str(c), 500, 0, False, 0), (str(c), 9000, 15000, str(c) if c % 5 else str(c % 22 + 1), 9600, 0, False, 1), (str(c), 15000, 4_000_000, str(c), 1000, 9_000_000, c % 2 == 0, 2)]
    return spark.createDataFrame(rows, "chromosome string, start bigint, end bigint, target_chromosome string, target_start bigint, target_size bigint, reverse boolean, rank int")


@register(
    su.with_("sites")
    + """, b AS (SELECT CAST(c AS VARCHAR) AS chromosome, s AS bstart, e AS bend, CASE WHEN k = 1 AND c % 5 = 0 THEN CAST(c % 22 + 1 AS VARCHAR) ELSE CAST(c AS VARCHAR) END AS tc, t AS tstart, k = 2 AND c % 2 = 0 AS rev
  FROM range(1, 23) r(c), (VALUES (0, 0, 8000, 500), (1, 9000, 15000, 9600), (2, 15000, 4000000, 1000)) v(k, s, e, t)),
h AS (SELECT s.p_partkey, s.chromosome, s.position, b.tc, b.rev, CASE WHEN b.rev THEN 9000000 - (s.position - 1 - bstart + tstart) ELSE s.position - 1 - bstart + tstart + 1 END AS p FROM sites s LEFT JOIN b ON b.chromosome = s.chromosome AND s.position - 1 >= bstart AND s.position - 1 < bend)
SELECT p_partkey AS site_id, chromosome, position, CASE WHEN tc IS NULL THEN 'unmapped' WHEN tc <> chromosome THEN 'chromosome_changed' WHEN rev THEN 'reverse_strand' ELSE 'mapped' END AS status, tc AS lifted_chromosome, CAST(p AS BIGINT) AS lifted_position FROM h"""
)
def liftover_blocks(spark, d):
    return builds.lift(su.sites(spark, d).select(F.col("p_partkey").alias("site_id"), "chromosome", "position"), _blocks(spark))


@register(
    su.with_("sites")
    + """, m AS (SELECT chromosome, max(position * 120) AS p FROM sites GROUP BY 1), l(build, chromosome, n) AS (VALUES ('old', '1', 100000), ('old', '2', 1000), ('old', '3', 1000000000), ('new', '1', 1000000000), ('new', '2', 1000000000), ('new', '3', 1000000000)),
o AS (SELECT build, count(*) FILTER (p > n) AS k FROM m JOIN l USING (chromosome) GROUP BY 1)
SELECT y.build AS supports, CASE WHEN x.k >= 2 THEN CAST(0.9 AS DOUBLE) ELSE CAST(0.7 AS DOUBLE) END AS weight, x.k AS n_chromosomes FROM o x JOIN o y ON x.build <> y.build WHERE x.k > 0 AND y.k = 0"""
)
def build_bounds_evidence(spark, d):
    lengths = {"old": {"1": 100_000, "2": 1_000, "3": 10**9}, "new": {"1": 10**9, "2": 10**9, "3": 10**9}}
    v = su.sites(spark, d).select("chromosome", (F.col("position") * 120).alias("position"))
    return builds.bounds_evidence(v, builds.lengths_frame(spark, lengths))


@register(
    su.with_("sites", "calls")
    + """, x AS (SELECT sample, chromosome, position, alt_count <> 1 AS hom, lag(alt_count <> 1) OVER w AS ph, lag(position) OVER w AS pp FROM calls JOIN sites ON p_partkey = variant WHERE alt_count IS NOT NULL WINDOW w AS (PARTITION BY sample, chromosome ORDER BY position)),
i AS (SELECT *, sum(CASE WHEN NOT hom OR coalesce(ph <> hom, true) OR position - coalesce(pp, position) > 5000 THEN 1 ELSE 0 END) OVER (PARTITION BY sample, chromosome ORDER BY position) AS isl FROM x)
SELECT sample, chromosome, min(position) AS start, max(position) AS "end", count(*) AS n_sites, max(position) - min(position) AS length FROM i WHERE hom GROUP BY sample, chromosome, isl HAVING count(*) >= 2 AND max(position) - min(position) >= 100"""
)
def runs_of_homozygosity(spark, d):
    s = su.sites(spark, d).select(F.col("p_partkey").alias("variant"), "chromosome", "position")
    return stats.runs_of_homozygosity(su.calls(spark, d).join(s, "variant"), 2, 100, 5000)


@register(None)
def ld_pruned_variants(spark, d):
    s = su.sites(spark, d).select(F.col("p_partkey").alias("variant"), "chromosome", "position")
    return stats.ld_prune(su.calls(spark, d).join(s, "variant"))


@register(
    su.with_("sites", "calls")
    + ", l AS (SELECT p_partkey AS variant, pc, ((p_partkey * pc) % 7 - 3) / 10.0::DOUBLE AS w FROM sites, range(1, 4) r(pc)) SELECT sample, CAST(pc AS INT) AS pc, round(sum(alt_count * w), 6) AS score FROM calls JOIN l USING (variant) WHERE alt_count IS NOT NULL GROUP BY 1, 2"
)
def ancestry_projection(spark, d):
    k = su.sites(spark, d).select(F.col("p_partkey").alias("variant"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("pc"))
    got = stats.project(su.calls(spark, d), k.withColumn("loading", ((F.col("variant") * F.col("pc")) % 7 - 3) / 10.0))
    return got.select("sample", "pc", F.round("score", 6).alias("score"))


# Nations as samples, parts as variants. The leading eigenvalue is tr(GP)/tr(P) for a high power P of the product G,
# by repeated squaring; the next is that of G without the first.
def _eigen_sql(k: int, squarings: int = 14) -> str:
    sql = """WITH n AS (SELECT c_nationkey AS s, l_partkey AS v, CAST(sum(CAST(l_quantity AS BIGINT)) % 3 AS DOUBLE) AS g FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
p AS (SELECT v, avg(g) / 2 AS p FROM n GROUP BY 1), z AS (SELECT s, v, CASE WHEN p > 0 AND p < 1 THEN (g - 2 * p) / sqrt(2 * p * (1 - p)) ELSE 0 END AS z FROM n JOIN p USING (v)),
g1 AS MATERIALIZED (SELECT a.s AS i, b.s AS j, sum(a.z * b.z) / (SELECT count(*) FROM p) AS x FROM z a JOIN z b USING (v) GROUP BY 1, 2),
t AS (SELECT sum(x) AS t FROM g1 WHERE i = j)"""
    for c in range(1, k + 1):
        last = f"g{c}"
        for q in range(squarings):
            new = f"p{c}_{q}"
            sql += f",\n{new}r AS MATERIALIZED (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY 1, 2), {new} AS MATERIALIZED (SELECT i, j, x / (SELECT sum(x) FROM {new}r WHERE i = j) AS x FROM {new}r)"
            last = new
        sql += f",\ne{c} AS (SELECT sum(a.x * b.x) AS e FROM g{c} a JOIN {last} b ON a.i = b.j AND a.j = b.i)"
        sql += f",\ng{c + 1} AS MATERIALIZED (SELECT i, j, a.x - b.x * (SELECT e FROM e{c}) AS x FROM g{c} a JOIN {last} b USING (i, j))"
    return sql + "\n" + " UNION ALL ".join(f"SELECT CAST({c} AS INT) AS pc, round(e, 6) AS eigenvalue, round(e / t, 6) AS fraction, round(CAST(1 AS DOUBLE), 6) AS length FROM e{c}, t" for c in range(1, k + 1))


@register(_eigen_sql(3))
def pca_eigenvalues(spark, d):
    """Leading eigenvalues and the lengths of their components, of nations over the parts they ordered."""
    li, o, c = su.table(spark, d, "lineitem"), su.table(spark, d, "orders"), su.table(spark, d, "customer")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(sized(c), F.col("o_custkey") == F.col("c_custkey"))
    calls = j.groupBy(F.col("c_nationkey").alias("sample"), F.col("l_partkey").alias("variant")).agg((F.sum(F.col("l_quantity").cast("bigint")) % 3).alias("alt_count"))
    got = components.pca(calls, 3)
    return got.groupBy("pc").agg(F.round(F.first("eigenvalue"), 6).alias("eigenvalue"), F.round(F.first("fraction"), 6).alias("fraction"), F.round(F.sqrt(F.sum(F.col("score") * F.col("score"))), 6).alias("length"))
