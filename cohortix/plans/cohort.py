"""Queries over phenotypes, covariates, visits, availability, artifacts and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.text import as_text, fail_reasons, native_id, null_if_missing, to_number
from cohortix.operators import coding, dedup, genotype, infer, profile, quality, registry

from . import surrogates as su
from .registry import register

# ---- phenotypes and covariates ----------------------------------------------------------------

_PHENO = """ph AS (SELECT 'P' || c_custkey AS iid, CASE WHEN c_custkey % 17 = 0 THEN '-9' WHEN c_custkey % 101 = 0 THEN 'x' WHEN c_acctbal > 0 THEN '2' ELSE '1' END AS bin, CASE WHEN c_custkey % 13 = 0 THEN 'NA' ELSE CAST(c_acctbal AS VARCHAR) END AS cont,
  CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_mktsegment END AS seg, c_custkey AS ord FROM customer)"""


def _pheno(spark: SparkSession, d: str) -> DataFrame:
    c, k = su.table(spark, d, "customer"), F.col("c_custkey")
    return c.select(
        su.participant_id().alias("iid"), F.when(k % 17 == 0, "-9").when(k % 101 == 0, "x").when(F.col("c_acctbal") > 0, "2").otherwise("1").alias("bin"),
        F.when(k % 13 == 0, "NA").otherwise(F.col("c_acctbal").cast("string")).alias("cont"), F.when(k % 11 == 0, "").otherwise(F.col("c_mktsegment")).alias("seg"), k.alias("_ord"),
    )


@register(f"WITH {_PHENO} SELECT iid AS participant_id, CASE bin WHEN '2' THEN CAST(1 AS DOUBLE) WHEN '1' THEN CAST(0 AS DOUBLE) END AS code, bin = '-9' AS is_missing, bin = 'x' AS is_invalid FROM ph")
def phenotype_coding_binary(spark, d):
    p = _pheno(spark, d)
    c = coding.code_binary(p, "bin", ["2"], ["1"])
    return p.select(F.col("iid").alias("participant_id"), c.code.alias("code"), c.missing.alias("is_missing"), c.invalid.alias("is_invalid"))


@register("""WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN '.' ELSE o_orderpriority END AS v FROM orders)
SELECT o_orderkey, CASE v WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 END::DOUBLE AS code, v = '.' AS is_missing, v NOT IN ('.', '5-LOW', '4-NOT SPECIFIED', '3-MEDIUM', '2-HIGH', '1-URGENT') AS is_invalid FROM o""")
def phenotype_coding_ordinal(spark, d):
    o = su.table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 19 == 0, ".").otherwise(F.col("o_orderpriority")).alias("v"))
    c = coding.code_levels(o, "v", ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"])
    return o.select("o_orderkey", c.code.alias("code"), c.missing.alias("is_missing"), c.invalid.alias("is_invalid"))


@register(f"WITH {_PHENO}, l AS (SELECT DISTINCT seg FROM ph WHERE seg <> ''), r AS (SELECT seg, row_number() OVER (ORDER BY seg) - 1 AS k FROM l) SELECT iid AS participant_id, CAST(k AS DOUBLE) AS code FROM ph LEFT JOIN r USING (seg)")
def phenotype_coding_multiclass(spark, d):
    p = _pheno(spark, d)
    return coding.with_level_code(p, "seg").select(F.col("iid").alias("participant_id"), "code")


@register(f"WITH {_PHENO} SELECT iid AS participant_id, 'baseline' AS event_id, TRY_CAST(cont AS DOUBLE) AS value_numeric, CASE WHEN cont <> 'NA' THEN cont END AS value_text, cont = 'NA' AS is_missing FROM ph")
def phenotype_observations(spark, d):
    return coding.observations(_pheno(spark, d), "iid", "cont", "continuous")


@register(
    """WITH v AS (SELECT c_mktsegment AS seg, c_acctbal AS x FROM customer), s AS (SELECT seg, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd, min(x) AS min, max(x) AS max, median(x) AS median, quantile_cont(x, 0.01) AS q01, quantile_cont(x, 0.99) AS q99 FROM v GROUP BY 1),
m AS (SELECT seg, avg(pow(x - mean, 3)) / pow(avg(pow(x - mean, 2)), 1.5) AS sk, count(*) FILTER (abs(x - mean) > 5 * sd) AS far FROM v JOIN s USING (seg) GROUP BY 1)
SELECT seg, n, round(mean, 6) AS mean, round(sd, 6) AS sd, min, max, round(median, 6) AS median, round(q01, 6) AS q01, round(q99, 6) AS q99, round(sk, 6) AS skewness, far AS n_beyond_5sd FROM s JOIN m USING (seg)"""
)
def continuous_profile(spark, d):
    c = su.table(spark, d, "customer").select(F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("x"))
    p = profile.numeric_profile(c, "x", ["seg"])
    return p.select("seg", "n", *[F.round(x, 6).alias(x) for x in ("mean", "sd")], "min", "max", *[F.round(x, 6).alias(x) for x in ("median", "q01", "q99", "skewness")], "n_beyond_5sd")


@register(f"WITH {_PHENO} SELECT count(*) FILTER (bin = '2') AS n_cases, count(*) FILTER (bin = '1') AS n_controls, round(count(*) FILTER (bin = '2') / nullif(count(*) FILTER (bin IN ('1', '2')), 0), 4) AS case_fraction FROM ph")
def binary_profile(spark, d):
    p = _pheno(spark, d)
    return profile.binary_profile(p.select(coding.code_binary(p, "bin", ["2"], ["1"]).code.alias("code")), "code")


@register("SELECT p_brand, count(*) AS n, count(*) < 80 AS is_small FROM part GROUP BY 1")
def class_profile(spark, d):
    return profile.class_profile(su.table(spark, d, "part"), "p_brand", 80)


_COVAR = """cv AS (SELECT 'P' || c_custkey AS iid, CASE WHEN c_custkey % 13 = 0 THEN 'NA' ELSE CAST(c_nationkey AS VARCHAR) END AS site, CASE WHEN c_custkey % 9 = 0 THEN '.' ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE CAST(c_acctbal AS VARCHAR) END AS bal, 'k' AS one, c_custkey AS ord FROM customer)"""


def _covar(spark: SparkSession, d: str) -> DataFrame:
    c, k = su.table(spark, d, "customer"), F.col("c_custkey")
    return c.select(
        su.participant_id().alias("iid"), F.when(k % 13 == 0, "NA").otherwise(F.col("c_nationkey").cast("string")).alias("site"), F.when(k % 9 == 0, ".").otherwise(F.col("c_mktsegment")).alias("seg"),
        F.when(k % 7 == 0, "").otherwise(F.col("c_acctbal").cast("string")).alias("bal"), F.lit("k").alias("one"), k.alias("_ord"),
    )


@register(f"WITH {_COVAR} SELECT iid, CASE WHEN site <> 'NA' THEN CAST(site AS DOUBLE) END AS site, CASE WHEN seg <> '.' THEN seg END AS seg, CASE WHEN bal <> '' THEN CAST(bal AS DOUBLE) END AS bal FROM cv")
def covariate_typing(spark, d):
    return coding.typed(_covar(spark, d), ["site", "seg", "bal"]).select("iid", "site", "seg", "bal")


@register(
    f"""WITH {_COVAR}, t AS (SELECT CASE WHEN site <> 'NA' THEN site END AS site, CASE WHEN seg <> '.' THEN seg END AS seg, CASE WHEN bal <> '' THEN bal END AS bal, one FROM cv),
l AS (SELECT 'site' AS variable, site AS v, false AS num FROM t UNION ALL SELECT 'seg', seg, false FROM t UNION ALL SELECT 'bal', bal, true FROM t UNION ALL SELECT 'one', one, false FROM t)
SELECT variable, round(count(*) FILTER (v IS NULL) / count(*), 6) AS missing_fraction, round(avg(CASE WHEN num THEN TRY_CAST(v AS DOUBLE) END), 6) AS mean, round(stddev_samp(CASE WHEN num THEN TRY_CAST(v AS DOUBLE) END), 6) AS sd, min(CASE WHEN num THEN TRY_CAST(v AS DOUBLE) END) AS min, max(CASE WHEN num THEN TRY_CAST(v AS DOUBLE) END) AS max,
  CASE WHEN variable <> 'bal' THEN count(DISTINCT v) END AS n_levels, count(DISTINCT v) <= 1 AS is_constant FROM l GROUP BY variable"""
)
def covariate_profile(spark, d):
    t = coding.typed(_covar(spark, d), ["site", "seg", "bal", "one"], ["site"])
    p = profile.covariate_profile(t, ["bal"], ["site", "seg", "one"])
    return p.select("variable", *[F.round(c, 6).alias(c) for c in ("missing_fraction", "mean", "sd")], "min", "max", F.when(F.col("variable") != "bal", F.col("n_levels")).alias("n_levels"), "is_constant")


@register(
    """WITH l AS (SELECT 'l_quantity' AS variable, CASE WHEN l_orderkey % 10 <> 0 THEN l_quantity END AS v FROM lineitem UNION ALL SELECT 'l_discount', CASE WHEN l_orderkey % 11 <> 0 THEN l_discount END FROM lineitem UNION ALL SELECT 'l_tax', l_tax FROM lineitem)
SELECT variable, count(*) AS n, count(*) FILTER (v IS NULL) AS n_missing, round(avg(v), 6) AS mean, min(v) AS min, max(v) AS max FROM l GROUP BY 1"""
)
def clinical_unpivot_profile(spark, d):
    k = F.col("l_orderkey")
    li = su.table(spark, d, "lineitem").select(k.cast("string").alias("pid"), F.when(k % 10 != 0, F.col("l_quantity").cast("string")).otherwise("NA").alias("l_quantity"), F.when(k % 11 != 0, F.col("l_discount").cast("string")).alias("l_discount"), F.col("l_tax").cast("string").alias("l_tax"))
    p = profile.clinical_profile(coding.clinical_long(li, "pid", ["l_quantity", "l_discount", "l_tax"]))
    return p.withColumn("mean", F.round("mean", 6))


_MATRIX = "e AS (SELECT vec_id, CAST(i AS INT) AS feature, CASE WHEN (vec_id + i) % 23 <> 0 THEN CAST(x AS DOUBLE) END AS v FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings))"


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    long = profile.matrix_long(su.table(spark, d, "embeddings"), "vec_id", "embedding")
    return long.withColumn("value", F.when((F.col("sample") + F.col("feature")) % 23 != 0, F.col("value").cast("double")))


@register(f"WITH {_MATRIX} SELECT feature, count(*) AS n, round(count(*) FILTER (v IS NULL) / count(*), 6) AS missing_fraction, min(v) AS min, round(median(v), 6) AS median, max(v) AS max, count(*) FILTER (v = 0) / count(*) AS zero_fraction, round(count(*) FILTER (v < 0) / count(*), 6) AS negative_fraction FROM e GROUP BY 1")
def omics_matrix_qc(spark, d):
    m = profile.matrix_features(_matrix(spark, d))
    return m.select("feature", "n", F.round("missing_fraction", 6).alias("missing_fraction"), "min", F.round("median", 6).alias("median"), "max", "zero_fraction", F.round("negative_fraction", 6).alias("negative_fraction"))


@register(f"WITH {_MATRIX}, s AS (SELECT vec_id, count(*) FILTER (v IS NULL) / count(*) AS m FROM e GROUP BY 1) SELECT vec_id AS sample, round(m, 6) AS missing_fraction, CASE WHEN m > 0.04 THEN 'WARN' ELSE 'PASS' END AS status FROM s")
def omics_sample_missingness(spark, d):
    m = profile.matrix_samples(_matrix(spark, d))
    return m.select("sample", F.round("missing_fraction", 6).alias("missing_fraction"), profile.missing_rule(F.col("missing_fraction"), 0.04).alias("status"))


# ---- checks -----------------------------------------------------------------------------------


@register(
    f"""WITH {_PHENO}, i AS (SELECT CASE WHEN ord % 23 = 0 THEN 'P1' WHEN ord % 29 = 0 THEN NULL ELSE iid END AS iid, bin FROM ph), dup AS (SELECT iid FROM i WHERE iid IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT 'columns_present' AS "check", 'PASS' AS status, CAST(0 AS BIGINT) AS count, '' AS examples UNION ALL SELECT 'type_supported', 'PASS', 0, '' UNION ALL
SELECT 'missing_ids', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*), '' FROM i WHERE iid IS NULL UNION ALL
SELECT 'invalid_values', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*), CASE WHEN count(*) > 0 THEN 'x' ELSE '' END FROM i WHERE bin = 'x' UNION ALL
SELECT 'missing_values', 'INFO', count(*), '' FROM i WHERE bin = '-9' UNION ALL
SELECT 'missing_fraction', 'PASS', 0, '' UNION ALL
SELECT 'duplicate_ids', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*), coalesce(min(iid), '') FROM dup"""
)
def validation_checks(spark, d):
    k = F.col("_ord")
    p = _pheno(spark, d).withColumn("iid", F.when(k % 23 == 0, "P1").when(k % 29 == 0, None).otherwise(F.col("iid")))
    v = quality.validate_phenotype(p, "iid", "bin", "binary", case=["2"], control=["1"])
    return v.withColumn("examples", F.array_join("examples", ","))


@register("""WITH c AS (SELECT 'P' || c_custkey AS p FROM customer), g AS (SELECT DISTINCT 'P' || o_custkey AS p FROM orders WHERE o_custkey % 10 <> 0), l AS (SELECT p FROM c WHERE p NOT IN (SELECT p FROM g))
SELECT 'phenotypes_exist' AS "check", 'PASS' AS status, CAST(0 AS BIGINT) AS count, '' AS examples UNION ALL SELECT 'predictive_sources_exist', 'PASS', 0, '' UNION ALL
SELECT 'phenotype_without_genotype', CASE WHEN count(*) > 0 THEN 'WARN' ELSE 'PASS' END, count(*), coalesce((SELECT string_agg(p, ',' ORDER BY p) FROM (SELECT p FROM l ORDER BY p LIMIT 5)), '') FROM l UNION ALL
SELECT 'conflicting_builds', 'FAIL', 2, 'GRCh37,GRCh38'""")
def cross_source_checks(spark, d):
    g = su.table(spark, d, "orders").where("o_custkey % 10 <> 0").select(su.participant_id("o_custkey").alias("participant_id"))
    b = su.table(spark, d, "customer").select(F.when(F.col("c_custkey") % 2 == 0, "GRCh37").otherwise("GRCh38").alias("build"))
    return quality.cross_source(su.participants(spark, d), g, b).withColumn("examples", F.array_join("examples", ","))


@register("""SELECT 'not_null:c_name' AS "check", 'PASS' AS status, CAST(0 AS BIGINT) AS count UNION ALL SELECT 'isin:c_mktsegment', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') UNION ALL
SELECT 'at_least:c_acctbal', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'unique:c_nationkey', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)""")
def output_contract(spark, d):
    c = su.table(spark, d, "customer")
    return quality.contract(c, ["c_name"], ["c_nationkey"], {"c_mktsegment": ["BUILDING", "MACHINERY"]}, {"c_acctbal": 0.0}).drop("examples")


_FAILS = """f AS (SELECT sample, count(*) FILTER (alt_count IS NULL) / count(*) > 0.05 AS m, count(*) < 15 AS few, sample % 41 = 0 AS sex FROM calls GROUP BY 1)"""


@register(su.with_("calls") + f", {_FAILS}, r AS (SELECT 'missingness' AS reason FROM f WHERE m UNION ALL SELECT 'few_calls' FROM f WHERE few UNION ALL SELECT 'sex' FROM f WHERE sex) SELECT reason, count(*) AS n FROM r GROUP BY 1")
def fail_reasons_explode(spark, d):
    m = genotype.sample_missingness(su.calls(spark, d))
    s = m.select("sample", (F.col("missing_fraction") > 0.05).alias("fail_missingness"), (F.col("n_total") < 15).alias("fail_few_calls"), (F.col("sample") % 41 == 0).alias("fail_sex"))
    return genotype.reason_counts(genotype.final_decision(s, ["fail_missingness", "fail_few_calls", "fail_sex"]))


@register(su.with_("calls") + f", {_FAILS} SELECT sample, concat_ws(';', CASE WHEN m THEN 'missingness' END, CASE WHEN few THEN 'few_calls' END, CASE WHEN sex THEN 'sex' END) AS reasons FROM f")
def fail_reason_strings(spark, d):
    m = genotype.sample_missingness(su.calls(spark, d))
    return m.select("sample", fail_reasons({"missingness": F.col("missing_fraction") > 0.05, "few_calls": F.col("n_total") < 15, "sex": F.col("sample") % 41 == 0}).alias("reasons"))


# ---- typing and inference ---------------------------------------------------------------------


@register(
    f"""WITH {_COVAR}, l AS (SELECT 'site' AS "column", CASE WHEN site <> 'NA' THEN site END AS v FROM cv UNION ALL SELECT 'seg', CASE WHEN seg <> '.' THEN seg END FROM cv UNION ALL SELECT 'bal', CASE WHEN bal <> '' THEN bal END FROM cv UNION ALL SELECT 'one', one FROM cv)
SELECT "column", count(v) AS n, count(v) = count(TRY_CAST(v AS DOUBLE)) AS numeric, count(v) = count(TRY_CAST(v AS DOUBLE)) AND count(*) FILTER (TRY_CAST(v AS DOUBLE) <> floor(TRY_CAST(v AS DOUBLE))) = 0 AS whole, count(DISTINCT v) AS n_levels, min(v) AS first_level FROM l GROUP BY 1"""
)
def numeric_level_inference(spark, d):
    f = infer.column_facts(_covar(spark, d), ["site", "seg", "bal", "one"])
    return f.select("column", "n", "numeric", "whole", "n_levels", F.get("levels", F.lit(0)).alias("first_level"))


@register("SELECT * FROM (VALUES ('site', 'batch', true), ('seg', 'other', true), ('bal', 'other', false), ('one', 'other', true)) t(variable, role, categorical)")
def covariate_roles(spark, d):
    got = infer.infer_covariates(_covar(spark, d).drop("_ord"))
    return spark.createDataFrame([(c, *v) for c, v in got.items()], "variable string, role string, categorical boolean")


@register("SELECT * FROM (VALUES ('bin', 'multiclass', CAST(NULL AS VARCHAR)), ('cont', 'continuous', NULL), ('seg', 'multiclass', NULL), ('status', 'binary', 'yes')) t(phenotype, type, case_value)")
def phenotype_types(spark, d):
    p = _pheno(spark, d).withColumn("status", F.when(F.col("_ord") % 2 == 0, "yes").otherwise("no"))
    got = infer.infer_phenotypes(p, "iid", ["bin", "cont", "seg", "status"])
    return spark.createDataFrame([(c, v[0], v[1]) for c, v in got.items()], "phenotype string, type string, case_value string")


@register("""SELECT doc_id, w[1] AS first_word, w[2] AS second_word, len(w) AS n_words FROM (SELECT doc_id, string_split_regex(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''), '\\s+') AS w FROM documents WHERE regexp_matches(text, '\\S'))""")
def whitespace_table_parse(spark, d):
    t = su.table(spark, d, "documents").where(F.col("text").rlike(r"\S")).select("doc_id", F.split(as_text("text"), r"\s+").alias("w"))
    return t.select("doc_id", F.get("w", F.lit(0)).alias("first_word"), F.get("w", F.lit(1)).alias("second_word"), F.size("w").cast("bigint").alias("n_words"))


@register("SELECT c_custkey, CASE WHEN c_nationkey % 4 = 0 THEN '0' ELSE CAST(c_nationkey AS VARCHAR) END || '_' || c_name AS native_id, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS number FROM customer")
def native_ids(spark, d):
    c = su.table(spark, d, "customer")
    f = F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey").cast("string"))
    t = F.when(F.col("c_custkey") % 13 == 0, F.lit(" NA\t")).otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string")))
    return c.select("c_custkey", native_id(f, "c_name").alias("native_id"), to_number(null_if_missing(t)).alias("number"))


# ---- registry ---------------------------------------------------------------------------------


@register(
    """WITH a AS (SELECT 'lab' AS src, c_name AS native, 'P' || c_custkey AS pid FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT '*', c_name, 'W' || c_custkey FROM customer WHERE c_custkey % 2 = 0)
SELECT c_name AS native_id, coalesce(x.pid, y.pid, c_name) AS participant_id FROM customer LEFT JOIN a x ON x.src = 'lab' AND x.native = c_name LEFT JOIN a y ON y.src = '*' AND y.native = c_name"""
)
def alias_resolution(spark, d):
    c = su.table(spark, d, "customer").select("c_name", "c_custkey")
    rows = lambda m, s, p: c.where(F.col("c_custkey") % m == 0).select(F.lit(s).alias("source_id"), F.concat(F.lit("  "), "c_name", F.lit("\t")).alias("native_id"), F.concat(F.lit(p), F.col("c_custkey").cast("string")).alias("participant_id"))
    return registry.resolve_aliases(c.select(F.col("c_name").alias("native_id")), rows(3, "lab", "P").unionByName(rows(2, "*", "W")), "lab")


@register(su.with_("visits", "first_visits") + "SELECT participant_id, event_id, study_day, event_date, ord FROM first_visits")
def events_keep_first(spark, d):
    return _first_visits(spark, d).withColumnRenamed("_ord", "ord")


def _first_visits(spark: SparkSession, d: str) -> DataFrame:
    v = su.visits(spark, d)
    return registry.events_of(v, "participant_id", "event_id", study_day=F.col("study_day"), event_date=F.col("event_date"))


@register(su.with_("visits", "first_visits") + ", n AS (SELECT participant_id, event_id, ord + 1000000 AS ord FROM first_visits UNION ALL SELECT participant_id, 'X1', ord FROM first_visits WHERE event_id = 'W0') SELECT participant_id, event_id, ord FROM first_visits WHERE event_id <> 'W2' UNION ALL SELECT participant_id, event_id, ord FROM n WHERE event_id IN ('X1', 'W2')")
def events_insert_if_absent(spark, d):
    v = _first_visits(spark, d).select("participant_id", "event_id", F.col("_ord").alias("ord"))
    new = v.withColumn("ord", F.col("ord") + 1000000).unionByName(v.where("event_id = 'W0'").withColumn("event_id", F.lit("X1")))
    return registry.add_events(v.where("event_id <> 'W2'"), new)


@register("""WITH old AS (SELECT o_orderkey, 'S' || (o_custkey % 5) AS source_id, o_totalprice AS v FROM orders) SELECT * FROM old WHERE source_id NOT IN ('S1', 'S3') UNION ALL SELECT o_orderkey, source_id, v + 1 FROM old WHERE source_id IN ('S1', 'S3') AND o_orderkey % 2 = 0""")
def refresh_by_source(spark, d):
    old = su.table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("S"), (F.col("o_custkey") % 5).cast("string")).alias("source_id"), F.col("o_totalprice").alias("v"))
    new = old.where("source_id in ('S1', 'S3') and o_orderkey % 2 = 0").withColumn("v", F.col("v") + 1)
    return dedup.refresh_source(old, new)


@register(su.with_("visits", "first_visits") + "SELECT event_id, count(DISTINCT participant_id) AS n_participants FROM first_visits GROUP BY 1")
def timeline_per_event(spark, d):
    return registry.per_event(_first_visits(spark, d))


@register(
    su.with_("visits", "first_visits")
    + """, o AS (SELECT event_id, row_number() OVER (ORDER BY median(study_day) NULLS LAST, min(event_date) NULLS LAST, min(ord)) AS event_no FROM first_visits GROUP BY 1), s AS (SELECT DISTINCT participant_id, event_no, event_id FROM first_visits JOIN o USING (event_id)), f AS (SELECT participant_id FROM s WHERE event_no = 1)
SELECT event_no, event_id, count(*) AS n_present, count(*) FILTER (participant_id IN (SELECT participant_id FROM f)) AS n_retained, count(*) FILTER (participant_id IN (SELECT participant_id FROM f)) / (SELECT count(*) FROM f) AS retained_ratio FROM s GROUP BY 1, 2"""
)
def timeline_attrition(spark, d):
    return registry.attrition(_first_visits(spark, d)).withColumn("event_no", F.col("event_no").cast("bigint"))


@register(
    su.with_("visits", "first_visits")
    + ", t AS (SELECT DISTINCT participant_id, study_day AS t FROM first_visits), g AS (SELECT t - lag(t) OVER (PARTITION BY participant_id ORDER BY t) AS gap FROM t) SELECT count(gap) AS n_gaps, median(gap) AS median_gap, min(gap) AS min_gap, max(gap) AS max_gap FROM g WHERE gap IS NOT NULL"
)
def timeline_gaps(spark, d):
    return registry.gap_statistics(_first_visits(spark, d))


_ASSAYS = "assays AS (SELECT 'P' || user_id AS participant_id, event_type AS modality, CASE WHEN event_id % 2 = 0 THEN 'blood' ELSE 'liver' END AS tissue, CASE WHEN event_id % 5 = 0 THEN 'predicted' ELSE 'observed' END AS origin, 'W' || CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT) AS event_id FROM events)"


def _assays(spark: SparkSession, d: str) -> DataFrame:
    e, k = su.table(spark, d, "events"), F.col("event_id")
    week = F.floor(F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 7)
    return e.select(F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("participant_id"), F.col("event_type").alias("modality"), F.when(k % 2 == 0, "blood").otherwise("liver").alias("tissue"), F.when(k % 5 == 0, "predicted").otherwise("observed").alias("origin"), F.concat(F.lit("W"), week.cast("string")).alias("event_id"))


@register(f"WITH {_ASSAYS}, p AS (SELECT modality, tissue, participant_id, count(DISTINCT event_id) AS n FROM assays GROUP BY ALL) SELECT modality, tissue, count(*) AS n_participants FROM p WHERE n > 1 GROUP BY ALL")
def repeated_measures(spark, d):
    return registry.repeated_measures(_assays(spark, d))


@register(f"WITH {_ASSAYS} SELECT event_id, modality, tissue, origin, count(DISTINCT participant_id) AS n_participants FROM assays GROUP BY ALL")
def modalities_per_event(spark, d):
    return registry.modalities_per_event(_assays(spark, d))


@register(su.with_("visits", "first_visits") + "SELECT event_id, median(study_day) AS median_day, min(event_date) AS first_date, min(ord) AS first_seen, row_number() OVER (ORDER BY median(study_day) NULLS LAST, min(event_date) NULLS LAST, min(ord)) AS event_no FROM first_visits GROUP BY 1")
def event_order(spark, d):
    return registry.event_order(_first_visits(spark, d)).withColumn("event_no", F.col("event_no").cast("bigint"))


_SOURCES = ("urgent_order", "event", "embedding", "label")
_AVAIL = """av AS (SELECT 'P' || c_custkey AS participant_id, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') AS urgent_order, c_custkey IN (SELECT user_id FROM events) AS event, c_custkey IN (SELECT vec_id FROM embeddings) AS embedding, c_custkey IN (SELECT doc_id FROM labels) AS label FROM customer)"""


def _availability(spark: SparkSession, d: str) -> DataFrame:
    t = lambda n: su.table(spark, d, n)
    src = {
        "urgent_order": t("orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'").select(F.col("o_custkey").alias("k")),
        "event": t("events").select(F.col("user_id").alias("k")),
        "embedding": t("embeddings").select(F.col("vec_id").alias("k")),
        "label": t("labels").select(F.col("doc_id").alias("k")),
    }
    long = reduce(DataFrame.unionByName, [df.select(su.participant_id("k").alias("participant_id"), F.lit(n).alias("column")) for n, df in src.items()])
    return registry.availability_matrix(long, su.participants(spark, d), _SOURCES)


@register(f"WITH {_AVAIL} SELECT * FROM av")
def availability_matrix(spark, d):
    return _availability(spark, d)


@register(f"WITH {_AVAIL} SELECT urgent_order, event, embedding, label, count(*) AS n FROM av GROUP BY ALL")
def availability_patterns(spark, d):
    return registry.availability_patterns(_availability(spark, d), _SOURCES)


@register(f"WITH {_AVAIL} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, count(*) FILTER ({a} AND {b}) AS n FROM av" for i, a in enumerate(_SOURCES) for b in _SOURCES[i:]))
def availability_pairwise(spark, d):
    return registry.availability_pairwise(_availability(spark, d), _SOURCES)


@register(f"WITH {_AVAIL} " + " UNION ALL ".join(f"SELECT '{a} & {b}' AS combination, count(*) FILTER ({a} AND {b}) AS n FROM av" for a in ("label", "urgent_order") for b in ("event", "embedding")))
def key_intersections(spark, d):
    return registry.key_intersections(_availability(spark, d), {"phenotype": ["label", "urgent_order"], "omics": ["event", "embedding"]})


@register(f"WITH {_AVAIL} SELECT participant_id FROM av WHERE urgent_order AND embedding")
def snapshot_select(spark, d):
    return registry.select_participants(_availability(spark, d), ["urgent_order", "embedding"])


@register("WITH a AS (SELECT 'O' || o_orderkey AS artifact_id, 'S' || (o_custkey % 50) AS source_id, o_orderpriority AS kind, o_orderdate AS created_at FROM orders WHERE o_orderstatus <> 'P'), r AS (SELECT *, row_number() OVER (PARTITION BY source_id, kind ORDER BY created_at DESC, artifact_id DESC) AS rn FROM a) SELECT artifact_id, source_id, kind FROM r WHERE rn = 1")
def artifact_latest(spark, d):
    o = su.table(spark, d, "orders")
    a = o.select(F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("artifact_id"), F.concat(F.lit("S"), (F.col("o_custkey") % 50).cast("string")).alias("source_id"), F.col("o_orderpriority").alias("kind"), F.col("o_orderdate").alias("created_at"), F.when(F.col("o_orderstatus") != "P", "current").otherwise("superseded").alias("status"))
    return registry.latest_artifact(a, ["source_id", "kind"]).select("artifact_id", "source_id", "kind")


_EDGES = """edges AS (SELECT DISTINCT 'l:' || l_orderkey || ':' || l_linenumber AS child, 'o:' || l_orderkey AS parent FROM lineitem UNION ALL SELECT 'o:' || o_orderkey, 'c:' || o_custkey FROM orders UNION ALL SELECT 'c:' || c_custkey, 'n:' || c_nationkey FROM customer UNION ALL SELECT 'n:' || n_nationkey, 'r:' || n_regionkey FROM nation)"""


def _edges(spark: SparkSession, d: str, repeats: bool = False) -> DataFrame:
    key = lambda p, *c: F.concat_ws(":", F.lit(p), *[F.col(x).cast("string") for x in c])
    t = lambda n, a, b: su.table(spark, d, n).select(a.alias("child"), b.alias("parent"))
    lines = t("lineitem", key("l", "l_orderkey", "l_linenumber"), key("o", "l_orderkey"))
    return (
        (lines if repeats else lines.distinct()).unionByName(t("orders", key("o", "o_orderkey"), key("c", "o_custkey")))
        .unionByName(t("customer", key("c", "c_custkey"), key("n", "c_nationkey"))).unionByName(t("nation", key("n", "n_nationkey"), key("r", "n_regionkey")))
    )


@register(f"WITH RECURSIVE {_EDGES}, up AS (SELECT child AS start, parent AS ancestor, 1 AS depth FROM edges WHERE child LIKE 'o:%' UNION ALL SELECT start, parent, depth + 1 FROM up JOIN edges ON child = ancestor) SELECT start, ancestor, CAST(min(depth) AS INT) AS depth FROM up GROUP BY 1, 2")
def lineage_ancestors(spark, d):
    e = _edges(spark, d, repeats=True)
    return registry.lineage(e, e.where(F.col("child").startswith("o:")).select(F.col("child").alias("id")))


@register(f"WITH {_EDGES} SELECT 'o:' || o_orderkey AS artifact_id, string_agg(parent, ',' ORDER BY parent) AS parents FROM orders LEFT JOIN edges ON child = 'o:' || o_orderkey GROUP BY 1")
def artifacts_with_parents(spark, d):
    a = su.table(spark, d, "orders").select(F.concat(F.lit("o:"), F.col("o_orderkey").cast("string")).alias("artifact_id"))
    return registry.with_parents(a, _edges(spark, d))


@register("SELECT event_id, 'k' AS metric, CAST(props->>'k' AS DOUBLE) AS value, props->>'k' AS text FROM events UNION ALL SELECT event_id, 'inner.value', value, CAST(value AS VARCHAR) FROM (SELECT event_id, CAST(round(value) AS BIGINT)::DOUBLE AS value0, value FROM events) WHERE false UNION ALL SELECT event_id, 'inner.type', NULL, event_type FROM events")
def qc_metrics_flatten(spark, d):
    e = su.table(spark, d, "events")
    m = F.struct(F.get_json_object("props", "$.k").alias("k"), F.struct(F.col("event_type").alias("type")).alias("inner"))
    return registry.flatten_metrics(e.select("event_id", m.alias("m")), ["event_id"], "m")


@register(
    f"""WITH {_PHENO}, o AS (SELECT iid, bin, cont FROM ph)
SELECT iid AS participant_id, (CASE WHEN bin IN ('1', '2') THEN 1 ELSE 0 END)::BIGINT AS n_features, CASE WHEN bin IN ('1', '2') THEN bin = '1' END AS excluded, TRY_CAST(cont AS DOUBLE) AS measured FROM o WHERE bin IN ('1', '2') OR cont <> 'NA'"""
)
def phenopacket_json(spark, d):
    p = _pheno(spark, d)
    bin_ = p.select(F.col("iid").alias("participant_id"), F.lit("trait").alias("phenotype"), F.lit("binary").alias("type"), coding.code_binary(p, "bin", ["2"], ["1"]).code.alias("value_numeric"))
    cont = p.select(F.col("iid").alias("participant_id"), F.lit("balance").alias("phenotype"), F.lit("continuous").alias("type"), coding.code_continuous(p, "cont").code.alias("value_numeric"))
    j = registry.phenopackets(bin_.unionByName(cont))
    got = F.from_json("packet", "phenotypicFeatures array<struct<label string, excluded boolean>>, measurements array<struct<assay string, value double>>")
    j = j.withColumn("g", got)
    return j.select("participant_id", F.size("g.phenotypicFeatures").cast("bigint").alias("n_features"), F.get("g.phenotypicFeatures", F.lit(0))["excluded"].alias("excluded"), F.get("g.measurements", F.lit(0))["value"].alias("measured"))


@register("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, d):
    return profile.value_counts(su.table(spark, d, "events"), "event_type")


@register("SELECT CAST(least(greatest(floor((c_acctbal + 1000) / 300) + 1, 0), 41) AS BIGINT) AS bin, count(*) AS n FROM customer GROUP BY 1")
def balance_histogram(spark, d):
    return profile.histogram(su.table(spark, d, "customer"), "c_acctbal", -1000, 11000)


@register("""SELECT count(*) AS n_rows, CAST(5 AS INT) AS n_columns, count(DISTINCT user_id) AS n_participants FROM events""")
def tabular_inspect(spark, d):
    return profile.inspect(su.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value"), "user_id")


@register("SELECT p_partkey, p_name FROM part ORDER BY md5('7|' || p_partkey), p_partkey LIMIT 100")
def sampled_rows(spark, d):
    """The sampling operator: its limit is the feature."""
    return dedup.seeded_sample(su.table(spark, d, "part").select("p_partkey", "p_name"), 100, ["p_partkey"], 7)


@register("SELECT o_orderkey, o_custkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row FROM orders")
def running_numbers(spark, d):
    return dedup.numbered(su.table(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"])


@register("SELECT s_suppkey, 'S/' || s_nationkey || '/' || CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS VARCHAR) AS assay_id FROM supplier")
def recorded_assays(spark, d):
    s = su.table(spark, d, "supplier")
    rows = s.select(F.col("s_nationkey").cast("string").alias("participant_id"), F.lit(None).cast("string").alias("event_id"), F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("artifact_id"))
    old = rows.limit(0).select(F.lit("").alias("assay_id"), F.lit("").alias("source_id"), "participant_id", "event_id", "artifact_id")
    return registry.record_assays(old, "S", rows).select(F.col("artifact_id").cast("bigint").alias("s_suppkey"), "assay_id")
