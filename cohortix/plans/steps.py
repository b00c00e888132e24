"""Queries over validators, registry steps, sample and variant selections, and score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.operators import annotate, builds, coding, dedup, genotype, quality, registry, score, stats

from . import surrogates as su
from .cohort import _ASSAYS, _COVAR, _MATRIX, _PHENO, _assays, _covar, _matrix, _pheno
from .registry import register
from .scores import _Q, _W, _harmonized, _model_sites, _weights
from .variants import _blocks

# ---- validators -------------------------------------------------------------------------------


def _line(name: str, count: str, rel: str, bad: str = "FAIL", examples: str = "''") -> str:
    """SQL of one check: ``count`` over ``rel``, and up to five examples."""
    return f"""SELECT '{name}' AS "check", CASE WHEN n > 0 THEN '{bad}' ELSE 'PASS' END AS status, n AS count, {examples} AS examples FROM (SELECT {count} AS n FROM {rel})"""


def _five(value: str, rel: str) -> str:
    return f"coalesce((SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT {value} AS v FROM {rel} ORDER BY v LIMIT 5)), '')"


def _many(c: str, missing: str) -> str:
    n = f"count(*) FILTER ({c} = '{missing}')"
    return f"CASE WHEN {n} > 0.05 * count(*) THEN {n} ELSE 0 END"


def _joined(checked: DataFrame) -> DataFrame:
    return checked.withColumn("examples", F.array_join("examples", ","))


@register(
    f"WITH {_COVAR} " + " UNION ALL ".join([
        _line("columns_present", "CAST(0 AS BIGINT)", "(SELECT 1)"), _line("missing_ids", "count(*)", "cv WHERE iid IS NULL"),
        _line("missing:site", _many("site", "NA"), "cv", "WARN"), _line("missing:seg", _many("seg", "."), "cv", "WARN"), _line("missing:bal", _many("bal", ""), "cv", "WARN"), _line("missing:one", "0", "(SELECT 1)"),
        _line("undeclared_categorical:seg", "count(*)", "cv WHERE seg <> '.'", "WARN", _five("seg", "cv WHERE seg <> '.'")), _line("undeclared_categorical:bal", "0", "(SELECT 1)"), _line("unique_ids", "0", "(SELECT 1)"),
    ])
)
def covariate_checks(spark, d):
    return _joined(quality.validate_covariates(_covar(spark, d), "iid", ["site", "seg", "bal", "one"], ["site", "one"]))


_RAW = f"WITH {_MATRIX}, m AS (SELECT vec_id, feature, CASE WHEN (vec_id + feature) % 97 <> 0 THEN v END AS v, (vec_id + feature) % 97 = 0 AS bad FROM e) "


def _raw_matrix(spark, d) -> DataFrame:
    bad = (F.col("sample") + F.col("feature")) % 97 == 0
    m = _matrix(spark, d).withColumn("raw", F.when(bad, "bad").otherwise(F.col("value").cast("string")))
    return m.withColumn("value", F.when(~bad, F.col("value")))


def _matrix_lines(name: str, out: str) -> str:
    return " UNION ALL ".join([
        _line("non_numeric_values", "count(*)", "m WHERE bad", examples="CASE WHEN n > 0 THEN 'bad' ELSE '' END"), _line(name, "count(*)", f"m WHERE {out}", examples=_five("CAST(feature AS VARCHAR)", f"m WHERE {out}")),
        _line("at_least_one_feature", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "m"), _line("all_missing_features", "count(*)", "(SELECT feature FROM m GROUP BY 1 HAVING count(v) = 0)", "WARN"),
        _line("missing_ids", "0", "(SELECT 1)"), _line("duplicate_ids", "count(*)", "(SELECT vec_id FROM embeddings GROUP BY 1 HAVING count(*) > 1)"),
    ])


def _matrix_checks(spark, d, measurement: str) -> DataFrame:
    samples = su.table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("sample"))
    return _joined(quality.validate_matrix(_raw_matrix(spark, d), samples, "sample", measurement=measurement))


@register(_RAW + _matrix_lines("non_negative", "v < 0"))
def count_matrix_checks(spark, d):
    return _matrix_checks(spark, d, "counts")


@register(_RAW + _matrix_lines("within_0_1", "(v < 0 OR v > 1)"))
def beta_matrix_checks(spark, d):
    return _matrix_checks(spark, d, "beta")


@register("WITH k AS (SELECT o_custkey || ':' || o_orderpriority AS k FROM orders GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1) " + _line("columns_present", "CAST(1 AS BIGINT)", "(SELECT 1)", examples="'visit_weight'") + " UNION ALL " + _line("duplicate_ids", "count(*)", "k", "WARN", _five("k", "k")))
def clinical_checks(spark, d):
    return _joined(quality.validate_clinical(su.table(spark, d, "orders"), "o_custkey", ["o_totalprice", "visit_weight"], "o_orderpriority"))


_GENO = """WITH s AS (SELECT CASE WHEN c_custkey % 31 = 0 THEN '0' WHEN c_custkey % 37 = 0 THEN 'P1' ELSE 'P' || c_custkey END AS iid FROM customer), v AS (SELECT CASE WHEN p_partkey % 41 = 0 THEN 0 ELSE p_partkey END AS pos, CASE WHEN p_partkey % 43 = 0 THEN '.' WHEN p_partkey % 47 = 0 THEN 'rs1' ELSE 'rs' || p_partkey END AS id FROM part),
ds AS (SELECT iid FROM s GROUP BY 1 HAVING count(*) > 1), dv AS (SELECT id FROM v WHERE id <> '.' GROUP BY 1 HAVING count(*) > 1) """


@register(
    _GENO + " UNION ALL ".join([
        _line("empty_sample_ids", "count(*)", "s WHERE iid = '0'"), _line("unique_sample_ids", "count(*)", "ds", examples=_five("iid", "ds")), _line("unplaced_variants", "count(*)", "v WHERE pos < 1", "WARN"),
        _line("missing_variant_ids", "count(*)", "v WHERE id = '.'", "WARN"), _line("duplicate_variant_ids", "count(*)", "dv", "WARN", _five("id", "dv")), _line("build_confidence", "1", "(SELECT 1)", "WARN"),
    ])
)
def genotype_checks(spark, d):
    k, p = F.col("c_custkey"), F.col("p_partkey")
    s = su.table(spark, d, "customer").select(F.when(k % 31 == 0, "0").when(k % 37 == 0, "P1").otherwise(su.participant_id()).alias("IID"))
    v = su.table(spark, d, "part").select(F.when(p % 41 == 0, 0).otherwise(p).alias("position"), F.when(p % 43 == 0, ".").when(p % 47 == 0, "rs1").otherwise(F.concat(F.lit("rs"), p.cast("string"))).alias("variant_id"))
    return _joined(quality.validate_genotype(s, v, 0.7))


@register(_GENO + "SELECT CASE WHEN (SELECT count(*) FROM ds) > 0 OR (SELECT count(*) FROM s WHERE iid = '0') > 0 THEN 'FAIL' WHEN (SELECT count(*) FROM dv) > 0 OR (SELECT count(*) FROM v WHERE pos < 1 OR id = '.') > 0 THEN 'WARN' ELSE 'PASS' END AS status")
def genotype_status(spark, d):
    return quality.status_of(genotype_checks(spark, d))


# ---- phenotypes and registry ------------------------------------------------------------------


@register(f"WITH {_COVAR} SELECT iid FROM cv WHERE site <> 'NA' OR seg <> '.' OR bal <> ''")
def covariates_present(spark, d):
    return coding.typed(_covar(spark, d), ["site", "seg", "bal"]).where(coding.any_value(["site", "seg", "bal"])).select("iid")


@register(f"WITH {_PHENO} SELECT iid AS participant_id, TRY_CAST(cont AS DOUBLE) AS cont FROM ph")
def original_values(spark, d):
    return coding.original_values(_pheno(spark, d), "iid", "cont", "continuous")


@register("SELECT 'P' || c_custkey AS participant_id, CAST(to_json({'c_name': c_name, 'c_mktsegment': c_mktsegment}) AS VARCHAR) AS attributes FROM customer")
def master_list(spark, d):
    return registry.master_list(su.table(spark, d, "customer").select(su.participant_id().alias("p"), "c_name", "c_mktsegment"), "p")


_MAPPED = """WITH a AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'lab' ELSE 'clinic' END AS source_id, c_name AS native_id, 'P' || c_custkey AS participant_id FROM customer WHERE c_custkey % 3 <> 0), m AS (SELECT c_name AS native_id, 'P' || c_custkey AS participant_id FROM customer WHERE c_custkey % 5 = 0)
"""


def _mapped(spark, d) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    c = su.table(spark, d, "customer").select(k, F.when(k % 2 == 0, "lab").otherwise("clinic").alias("source_id"), F.col("c_name").alias("native_id"), su.participant_id().alias("participant_id"))
    a = c.where("c_custkey % 3 <> 0").drop("c_custkey")
    people = a.select("participant_id", F.col("source_id").alias("first_source"))
    return registry.register_mapping(people, a, c.where("c_custkey % 5 = 0").select("native_id", "participant_id"), "lab")


@register(_MAPPED + "SELECT * FROM a WHERE source_id <> 'lab' UNION ALL SELECT 'lab', native_id, participant_id FROM m")
def mapped_aliases(spark, d):
    return _mapped(spark, d)[1]


@register(_MAPPED + "SELECT participant_id, source_id AS first_source FROM a UNION ALL SELECT participant_id, 'lab' FROM m WHERE participant_id NOT IN (SELECT participant_id FROM a)")
def mapped_participants(spark, d):
    return _mapped(spark, d)[0]


_BIO = """WITH b AS (SELECT 'B' || (o_orderkey % 1000) AS biospecimen_id, 'P' || o_custkey AS participant_id, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS event_id, row_number() OVER (PARTITION BY o_orderkey % 1000 ORDER BY o_orderkey) AS rn FROM orders), f AS (SELECT biospecimen_id, participant_id, event_id FROM b WHERE rn = 1)
"""


def _biospecimens(spark, d) -> DataFrame:
    k = F.col("o_orderkey")
    o = su.table(spark, d, "orders").select(F.concat(F.lit("B"), (k % 1000).cast("string")).alias("b"), su.participant_id("o_custkey").alias("p"), F.when(k % 7 != 0, F.col("o_orderpriority")).alias("e"), k.alias("_ord"))
    return registry.biospecimens_of(o, "b", "p", event_id=F.col("e"))


@register(_BIO + "SELECT * FROM f")
def biospecimens_first(spark, d):
    return _biospecimens(spark, d).drop("_ord")


@register(_BIO + "SELECT event_id, count(*) AS n FROM f WHERE event_id IS NOT NULL GROUP BY 1")
def biospecimens_per_event(spark, d):
    return registry.biospecimens_per_event(_biospecimens(spark, d))


@register(_BIO + ", x AS (SELECT l_orderkey, l_linenumber, 'B' || (l_partkey % 2000) AS biospecimen_id, 'P0' AS p, CASE WHEN l_linenumber = 1 THEN 'own' END AS e FROM lineitem) SELECT l_orderkey, l_linenumber, biospecimen_id, coalesce(f.participant_id, p) AS participant_id, coalesce(e, f.event_id) AS event_id FROM x LEFT JOIN f USING (biospecimen_id)")
def biospecimen_observations(spark, d):
    x = su.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("B"), (F.col("l_partkey") % 2000).cast("string")).alias("biospecimen_id"), F.lit("P0").alias("participant_id"), F.when(F.col("l_linenumber") == 1, "own").alias("event_id"))
    return registry.biospecimen_observations(x, _biospecimens(spark, d))


@register(f"WITH {_ASSAYS} SELECT origin, modality, count(DISTINCT participant_id) AS n_participants, count(DISTINCT tissue) AS n_tissues FROM assays GROUP BY ALL")
def availability_by_origin(spark, d):
    return registry.summary_by_origin(_assays(spark, d))


@register("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_orders(spark, d):
    """The first rows of a report: its limit is the feature."""
    return dedup.top_rows(su.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 50)


# ---- variants and samples ---------------------------------------------------------------------

_PASS = ", k AS (SELECT variant, CAST(sum(alt_count) AS BIGINT) / nullif(2 * count(alt_count), 0) AS p, count(*) FILTER (alt_count IS NULL) / count(*) AS m FROM calls GROUP BY 1), ok AS (SELECT variant FROM k WHERE NOT (m > 0.02) AND NOT (coalesce(least(p, 1 - p), 0) < 0.01)) "


def _named_sites(spark, d) -> DataFrame:
    return su.sites(spark, d).select(F.col("p_partkey").alias("variant"), "variant_key", "chromosome", "position")


@register(su.with_("sites", "calls") + _PASS + "SELECT p_partkey AS variant, variant_key, chromosome, position FROM sites WHERE p_partkey IN (SELECT variant FROM ok)")
def cohort_variants(spark, d):
    return annotate.cohort_variants(_named_sites(spark, d), genotype.variant_metrics(su.calls(spark, d)))


@register(su.with_("sites") + "SELECT p_partkey AS variant FROM sites WHERE p_partkey % 41 <> 0")
def placed_variants(spark, d):
    s = _named_sites(spark, d).withColumn("position", F.when(F.col("variant") % 82 == 0, None).when(F.col("variant") % 41 == 0, 0).otherwise(F.col("position")))
    return genotype.placed(s).select("variant")


_HET = """f AS (SELECT variant, count(alt_count) AS called, CAST(sum(alt_count) AS BIGINT) AS alts FROM {x} GROUP BY 1 HAVING count(alt_count) > 1),
e AS (SELECT variant, 1 - 2 * (alts / (2 * called)) * (1 - alts / (2 * called)) * (2 * called) / (2 * called - 1) AS e FROM f),
s AS (SELECT sample, count(*) FILTER (alt_count <> 1) AS o_hom, sum(e) AS e_hom, count(*) AS n_called FROM {x} JOIN e USING (variant) WHERE alt_count IS NOT NULL GROUP BY 1),
g AS (SELECT sample, (o_hom - e_hom) / nullif(n_called - e_hom, 0) AS f FROM s)"""


@register(
    su.with_("sites", "calls") + ", x AS (SELECT calls.* FROM calls JOIN sites ON p_partkey = variant WHERE CAST(chromosome AS INT) <= 6), " + _HET.format(x="x")
    + """, r AS (SELECT d.*, f, CASE WHEN f > 0.8 THEN 1 WHEN f < 0.2 THEN 2 ELSE 0 END AS snp_sex FROM (SELECT DISTINCT sample, sample % 2 + 1 AS sex FROM calls) d LEFT JOIN g USING (sample))
SELECT sample, sex, round(f, 6) AS f, snp_sex, CASE WHEN f IS NULL THEN 'SKIPPED' WHEN sex = snp_sex THEN 'OK' ELSE 'PROBLEM' END AS status FROM r"""
)
def sex_checked(spark, d):
    s = _named_sites(spark, d).select("variant", F.when(F.col("chromosome").cast("int") <= 6, "X").otherwise(F.col("chromosome")).alias("chromosome"))
    c = su.calls(spark, d).join(annotate.sized(s), "variant").withColumn("sex", F.col("sample") % 2 + 1)
    return genotype.sex_check(c).withColumn("f", F.round("f", 6))


@register(
    su.with_("calls") + ", " + _HET.format(x="calls")
    + """, m AS (SELECT sample, count(*) FILTER (alt_count IS NULL) / count(*) > 0.02 AS miss FROM calls GROUP BY 1), z AS (SELECT 'P' || c_custkey AS participant_id, miss, abs(f - (SELECT avg(f) FROM g)) > 3 * (SELECT stddev_samp(f) FROM g) AS het FROM customer LEFT JOIN m ON m.sample = c_custkey LEFT JOIN g ON g.sample = c_custkey)
SELECT participant_id, concat_ws(';', CASE WHEN miss THEN 'missing' END, CASE WHEN het THEN 'het' END) AS fail_reasons, NOT coalesce(miss, false) AND NOT coalesce(het, false) AS keep FROM z"""
)
def samples_decided(spark, d):
    c = su.calls(spark, d)
    all_ = su.table(spark, d, "customer").select(F.col("c_custkey").alias("sample"))
    m = genotype.sample_metrics(all_, genotype.sample_missingness(c).select("sample", "fail_missing"), genotype.heterozygosity(c).select("sample", "fail_het"))
    return genotype.final_decision(m, ["fail_missing", "fail_het"]).select(su.participant_id("sample").alias("participant_id"), "fail_reasons", "keep")


_LIFT = su.with_("sites") + """, b AS (SELECT CAST(c AS VARCHAR) AS chromosome, s AS bstart, e AS bend, CASE WHEN k = 1 AND c % 5 = 0 THEN CAST(c % 22 + 1 AS VARCHAR) ELSE CAST(c AS VARCHAR) END AS tc, t AS tstart, k = 2 AND c % 2 = 0 AS rev
  FROM range(1, 23) r(c), (VALUES (0, 0, 8000, 500), (1, 9000, 15000, 9600), (2, 15000, 4000000, 1000)) v(k, s, e, t)),
h AS (SELECT s.p_partkey, s.chromosome, CASE WHEN tc IS NULL THEN 'unmapped' WHEN tc <> s.chromosome THEN 'chromosome_changed' WHEN rev THEN 'reverse_strand' ELSE 'mapped' END AS status, s.position - bstart + tstart AS p FROM sites s LEFT JOIN b ON b.chromosome = s.chromosome AND s.position - 1 >= bstart AND s.position - 1 < bend)
"""


def _lifted(spark, d) -> DataFrame:
    return builds.lift(_named_sites(spark, d).select(F.col("variant").alias("site_id"), "chromosome", "position"), _blocks(spark))


@register(_LIFT + "SELECT status, count(*) AS n FROM h GROUP BY 1")
def liftover_status_counts(spark, d):
    return builds.status_counts(_lifted(spark, d))


@register(_LIFT + "SELECT p_partkey AS site_id, chromosome, CAST(p AS BIGINT) AS position FROM h WHERE status = 'mapped'")
def lifted_sites(spark, d):
    return builds.lifted_sites(_lifted(spark, d))


@register(
    su.with_("sites", "calls")
    + """, l AS (SELECT p_partkey AS variant, pc, ((p_partkey * pc) % 7 - 3) / 10.0::DOUBLE AS w FROM sites, range(1, 4) r(pc) WHERE p_partkey % 3 <> 0), v AS (SELECT sample, pc, sum(alt_count * w) AS x FROM calls JOIN l USING (variant) WHERE alt_count IS NOT NULL GROUP BY 1, 2),
c AS (SELECT 'pop' || (sample % 3) AS label, pc, avg(x) AS x FROM v WHERE sample % 4 = 0 GROUP BY 1, 2), q AS (SELECT sample, label, sqrt(sum((v.x - c.x) * (v.x - c.x))) AS d FROM v JOIN c USING (pc) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY d, label) AS rn FROM q)
SELECT a.sample AS id, round(1 - a.d / b.d, 5) AS confidence FROM r a JOIN r b ON a.sample = b.sample AND a.rn = 1 AND b.rn = 2 WHERE a.sample % 4 <> 0"""
)
def ancestry_of_samples(spark, d):
    k = su.table(spark, d, "part").where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("variant"), F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("pc"))
    k = k.withColumn("loading", ((F.col("variant") * F.col("pc")) % 7 - 3) / 10.0)
    c = su.calls(spark, d)
    known = F.col("sample") % 4 == 0
    people = c.where(known).select("sample", F.concat(F.lit("pop"), (F.col("sample") % 3).cast("string")).alias("label")).distinct()
    got = stats.ancestry(c.where(~known), k, c.where(known), people, least=20)
    return got.select("id", F.round("confidence", 5).alias("confidence"))


# ---- scores -----------------------------------------------------------------------------------


@register(_W + "SELECT model_id, feature_id, 'rs' || p_partkey AS variant_id, ea AS effect_allele, oa AS other_allele, mt AS match_type FROM h WHERE outcome = 'matched'")
def harmonize_by_rsid(spark, d):
    rs = lambda c: F.concat(F.lit("rs"), c)
    w = _weights(spark, d).withColumns({"variant_id": rs(F.substring("variant_id", 2, 20)), "position": F.lit(None).cast("bigint")})
    s = _model_sites(spark, d).withColumn("rsid", rs(F.col("p_partkey").cast("string")))
    return score.harmonize(w, s).where("outcome = 'matched'").select("model_id", "feature_id", "variant_id", "effect_allele", "other_allele", "match_type")


@register(_W + ", x AS (SELECT *, row_number() OVER (PARTITION BY model_id, feature_id ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_discount) AS r FROM w) SELECT model_id, feature_id, min(variant_id) FILTER (r = 1) AS name, count(*) AS n_weights, round(min(l_discount) FILTER (r = 1), 6) AS r2 FROM x GROUP BY 1, 2")
def feature_summary(spark, d):
    w = _weights(spark, d).withColumns({"name": F.col("variant_id"), "r2": F.col("_ord.l_discount")})
    return score.feature_summary(w).withColumn("r2", F.round("r2", 6))


@register(_W + _Q + ", u AS (SELECT model_id, feature_id, count(*) AS n_weights FROM w GROUP BY 1, 2) SELECT u.model_id, u.feature_id, n_weights, n_matched_variants FROM u LEFT JOIN (SELECT * FROM c WHERE model_id <> 'M3') q2 USING (model_id, feature_id)")
def feature_catalogue(spark, d):
    f = score.feature_summary(_weights(spark, d).withColumns({"name": F.col("variant_id"), "r2": F.col("_ord.l_discount")}))
    q = score.model_quality(_harmonized(spark, d).where("model_id <> 'M3'"))
    return score.with_quality(f, q).select("model_id", "feature_id", "n_weights", "n_matched_variants")


@register(su.with_("sites") + ", t AS (SELECT variant_key, p_partkey AS o, chromosome FROM sites UNION ALL SELECT variant_key, p_partkey + 10000000, chromosome FROM sites WHERE p_partkey % 9 = 0) SELECT variant_key, min(o) AS ord FROM t GROUP BY 1")
def keyed_sites(spark, d):
    s = su.sites(spark, d).select("chromosome", "position", "ref", "alt", F.col("p_partkey").alias("_ord"))
    again = s.where("_ord % 9 = 0").withColumns({"chromosome": F.concat(F.lit("chr"), "chromosome"), "ref": F.lower("ref"), "_ord": F.col("_ord") + 10000000})
    return score.keyed_sites(s.unionByName(again)).select("variant_key", F.col("_ord").alias("ord"))


@register(su.with_("sites") + "SELECT l_orderkey, l_linenumber, variant_key FROM lineitem LEFT JOIN (SELECT * FROM sites WHERE p_partkey % 11 <> 0) ON p_partkey = l_partkey")
def transcripts_keyed(spark, d):
    v = su.sites(spark, d).where("p_partkey % 11 <> 0").select(F.col("p_partkey").cast("string").alias("variant_id"), "variant_key")
    rows = su.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("Uploaded_variation"))
    return annotate.keyed_transcripts(rows, v).select("l_orderkey", "l_linenumber", "variant_key")


@register("WITH s AS (SELECT o_custkey AS sample, o_orderpriority AS feature_id, sum(o_totalprice) AS x FROM orders GROUP BY 1, 2) SELECT sample, feature_id, round(x, 4) AS score, c_name AS native_id, CASE WHEN c_custkey IS NOT NULL THEN 'P' || c_custkey END AS participant_id FROM s LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 6 <> 0) ON c_custkey = sample")
def scores_of_samples(spark, d):
    s = su.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("sample"), F.col("o_orderpriority").alias("feature_id")).agg(F.round(F.sum("o_totalprice"), 4).alias("score"))
    c = su.table(spark, d, "customer").where("c_custkey % 6 <> 0").select(F.col("c_custkey").alias("sample"), F.col("c_name").alias("native_id"), su.participant_id().alias("participant_id"))
    return score.with_samples(s, c)
