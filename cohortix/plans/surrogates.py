"""The star-schema tables seen as a cohort: customers are participants, parts are variant sites.

Every definition exists twice, as a DataFrame here and as SQL in ``SQL``; queries build on the first,
their oracles on the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.operators.annotate import dealt


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def participant_id(c: str = "c_custkey") -> Column:
    return F.concat(F.lit("P"), F.col(c).cast("string"))


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(participant_id().alias("participant_id"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    base = lambda at: F.substr(F.lit("ACGT"), at.cast("int"), F.lit(1))
    return table(spark, sf_dir, "part").select(
        "p_partkey", (k % 22 + 1).cast("string").alias("chromosome"), (1000 + 10 * k).alias("position"), base(k % 4 + 1).alias("ref"), base((k + 1 + k % 3) % 4 + 1).alias("alt"),
        "p_brand", "p_type", "p_size",
    ).withColumn("variant_key", F.concat_ws(":", "chromosome", F.col("position").cast("string"), "ref", "alt"))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample, variant, alt_count): every tenth customer carries nothing; null where no tax was paid."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_tax")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").where("o_custkey % 10 <> 0")
    n = table(spark, sf_dir, "lineitem").count()
    j = dealt(li, n, "l_orderkey").join(dealt(o, n, "o_orderkey"), li["l_orderkey"] == o["o_orderkey"])
    g = dealt(j, n, "o_custkey", "l_partkey").groupBy(F.col("o_custkey").alias("sample"), F.col("l_partkey").alias("variant")).agg(F.max("l_tax").alias("_t"), F.max(F.col("l_linenumber") % 3).alias("_n"))
    return g.select("sample", "variant", F.when(F.col("_t") != 0, F.col("_n")).cast("bigint").alias("alt_count"))


def carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sites(spark, sf_dir).select(F.col("p_partkey").alias("variant"), "variant_key", "chromosome", "position")
    c = calls(spark, sf_dir).where("alt_count is not null")
    n = F.col("alt_count")
    return c.join(s, "variant").select(
        participant_id("sample").alias("participant_id"), "variant_key", "chromosome", "position", n.alias("hardcall_alt_count"), n.cast("double").alias("dosage"), (n == 1).alias("heterozygous"), (n == 2).alias("homozygous_alt")
    )


_TERMS = {"PROMO": "stop_gained", "SMALL": "missense_variant", "LARGE": "missense_variant&splice_region_variant", "MEDIUM": "synonymous_variant", "ECONOMY": "intron_variant"}


def consequence() -> Column:
    kind = F.split("p_type", " ")[0]
    out = None
    for k, t in _TERMS.items():
        out = F.when(kind == k, t) if out is None else out.when(kind == k, t)
    return out


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortix.functions.consequences import most_severe

    k = F.col("p_partkey")
    a = sites(spark, sf_dir).withColumn("consequence", consequence())
    return a.select(
        "variant_key", F.col("p_brand").alias("gene_id"), F.concat(F.lit("SYM-"), "p_brand").alias("gene_symbol"), "consequence", most_severe("consequence").alias("most_severe_consequence"),
        F.when(F.col("consequence").like("%missense%"), F.col("p_size") / 50.0).alias("alphamissense_score"),
        F.when(k % 7 != 0, (k % 100) / 1000.0).alias("gnomad_af"), ((k % 11) / 10.0).alias("spliceai_max_score"),
        F.when(k % 13 == 0, "Pathogenic").when(k % 13 == 1, "Likely_pathogenic").when(k % 13 == 2, "Conflicting_Pathogenic").when(k % 13 == 3, "Benign").alias("clinvar_significance"),
    )


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(participant_id, event_id, study_day, event_date, _ord): weekly visits from the event log."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    e = e.withColumn("study_day", day).withColumn("week", F.floor(day / 7))
    e = e.where((F.col("week") == 0) | ((F.col("user_id") + F.col("week")) % 4 != 0))
    return e.select(F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("participant_id"), F.concat(F.lit("W"), F.col("week").cast("string")).alias("event_id"), F.col("study_day").cast("double").alias("study_day"), F.col("ts").cast("date").alias("event_date"), F.col("event_id").alias("_ord"))


SQL = {
    "sites": """sites AS (SELECT p_partkey, CAST(p_partkey % 22 + 1 AS VARCHAR) AS chromosome, 1000 + 10 * p_partkey AS position,
  substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) AS ref, substr('ACGT', CAST((p_partkey + 1 + p_partkey % 3) % 4 + 1 AS INT), 1) AS alt, p_brand, p_type, p_size,
  CAST(p_partkey % 22 + 1 AS VARCHAR) || ':' || CAST(1000 + 10 * p_partkey AS VARCHAR) || ':' || substr('ACGT', CAST(p_partkey % 4 + 1 AS INT), 1) || ':' || substr('ACGT', CAST((p_partkey + 1 + p_partkey % 3) % 4 + 1 AS INT), 1) AS variant_key FROM part)""",
    "calls": """calls AS (SELECT o_custkey AS sample, l_partkey AS variant, CASE WHEN max(l_tax) <> 0 THEN CAST(max(l_linenumber % 3) AS BIGINT) END AS alt_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 10 <> 0 GROUP BY 1, 2)""",
    "carriers": """carriers AS (SELECT 'P' || sample AS participant_id, s.variant_key, s.chromosome, s.position, alt_count AS hardcall_alt_count, CAST(alt_count AS DOUBLE) AS dosage,
  alt_count = 1 AS heterozygous, alt_count = 2 AS homozygous_alt FROM calls JOIN sites s ON s.p_partkey = variant WHERE alt_count IS NOT NULL)""",
    "ann": """ann0 AS (SELECT *, CASE split_part(p_type, ' ', 1) WHEN 'PROMO' THEN 'stop_gained' WHEN 'SMALL' THEN 'missense_variant' WHEN 'LARGE' THEN 'missense_variant&splice_region_variant'
  WHEN 'MEDIUM' THEN 'synonymous_variant' WHEN 'ECONOMY' THEN 'intron_variant' END AS consequence FROM sites),
ann AS (SELECT variant_key, p_brand AS gene_id, 'SYM-' || p_brand AS gene_symbol, consequence, split_part(consequence, '&', 1) AS most_severe_consequence,
  CASE WHEN consequence LIKE '%missense%' THEN p_size / 50.0::DOUBLE END AS alphamissense_score, CASE WHEN p_partkey % 7 <> 0 THEN (p_partkey % 100) / 1000.0::DOUBLE END AS gnomad_af,
  (p_partkey % 11) / 10.0::DOUBLE AS spliceai_max_score, CASE p_partkey % 13 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Likely_pathogenic' WHEN 2 THEN 'Conflicting_Pathogenic' WHEN 3 THEN 'Benign' END AS clinvar_significance FROM ann0)""",
    "carried": """carried AS (SELECT c.*, a.gene_id, a.gene_symbol, a.consequence, a.alphamissense_score, a.gnomad_af, a.spliceai_max_score,
  coalesce(a.consequence, '') LIKE '%stop_gained%' AS is_lof, coalesce(a.consequence, '') LIKE '%splice_region%' AS is_splice,
  coalesce(a.consequence, '') LIKE '%missense_variant%' AS is_missense, (coalesce(a.consequence, '') LIKE '%missense_variant%' AND a.alphamissense_score >= 0.564) AS is_damaging_missense,
  coalesce(a.clinvar_significance IN ('Pathogenic', 'Likely_pathogenic'), false) AS is_pathogenic, a.gnomad_af < 0.01 AS is_rare FROM carriers c LEFT JOIN ann a USING (variant_key)
  WHERE hardcall_alt_count > 0)""",
    "visits": """visits AS (SELECT 'P' || user_id AS participant_id, 'W' || CAST(week AS VARCHAR) AS event_id, CAST(study_day AS DOUBLE) AS study_day, d AS event_date, event_id AS ord FROM
  (SELECT *, CAST(ts AS DATE) AS d, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS study_day, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) AS BIGINT) AS week FROM events)
  WHERE week = 0 OR (user_id + week) % 4 <> 0)""",
    "first_visits": "first_visits AS (SELECT participant_id, event_id, min(ord) AS ord, arg_min(study_day, ord) AS study_day, arg_min(event_date, ord) AS event_date FROM visits GROUP BY 1, 2)",
}


def with_(*names: str) -> str:
    """A WITH clause of the named definitions, in this order."""
    return "WITH " + ",\n".join(SQL[n] for n in names) + "\n"
