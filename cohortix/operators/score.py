"""Genetic scores: allele harmonization of model weights, coverage, weighted sums, comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortix.functions.alleles import complement, strand_ambiguous, strip_chr

from .annotate import dealt, sized, with_key
from .cutpoint import cut
from .dedup import best_row, keep_first

KEYS = ("model_id", "feature_id", "chromosome", "position", "variant_id", "effect_allele", "other_allele")
GOOD = ("exact", "allele_swap", "strand_flip", "strand_flip_swap")
MIN_COVERAGE = 0.5
#: Calls that a task joins with the terms of their variants.
TERM_ROWS = 250_000


def check_builds(model: str | None, genotype: str | None) -> None:
    """Raise unless both builds are known and equal."""
    if not model or not genotype or "unknown" in (model, genotype):
        raise ValueError(f"a score needs known builds: model {model}, genotype {genotype}")
    if model != genotype:
        raise ValueError(f"model is on {model}, genotype on {genotype}: lift one of them first")


def match_type(effect: Column, other: Column, ref: Column, alt: Column, forward_strand: bool = False) -> Column:
    """How a weight's alleles (effect, other) meet a site's (ref, alt)."""
    other_known = other.isNotNull() & (other != "")

    def meets(e: Column, o: Column, to: Column, from_: Column) -> Column:
        return (e == to) & (~other_known | (o == from_))

    amb = F.coalesce(strand_ambiguous(effect, other), F.lit(False))
    flip_e, flip_o = complement(effect), complement(other)
    return (
        F.when(amb & F.lit(not forward_strand), "ambiguous")
        .when(meets(effect, other, alt, ref), "exact")
        .when(meets(effect, other, ref, alt), "allele_swap")
        .when(~amb & meets(flip_e, flip_o, alt, ref), "strand_flip")
        .when(~amb & meets(flip_e, flip_o, ref, alt), "strand_flip_swap")
        .otherwise("mismatch")
    )


def prepared(weights: DataFrame, ord_col: str = "_ord") -> DataFrame:
    """Weights with upper-case alleles, plain chromosomes and ``_dup``: a later row of the same key."""
    n = weights.count()
    w = weights.withColumns({"effect_allele": F.upper("effect_allele"), "other_allele": F.upper("other_allele"), "chromosome": strip_chr("chromosome")})
    # by position first, which a sort tells apart by its prefix; weights that have one are dealt by it, as their join needs
    by = sorted(KEYS, key=lambda c: c not in ("position", "variant_id"))
    dup = F.row_number().over(Window.partitionBy(*by).orderBy(ord_col)) > 1
    placed = dealt(w.where("position is not null"), n, "chromosome", "position").withColumn("_dup", dup)
    return placed.unionByName(w.where("position is null").withColumn("_dup", dup))


def with_sites(weights: DataFrame, sites: DataFrame) -> DataFrame:
    """Weights with ``_sites``, all sites of their position, or of their rsID where they have no position.

    Sites are one row a position before the join, so a weight stays one row; null where there is none.
    """
    s = sites.select(
        F.col("variant_id").alias("geno_variant_id"), F.col("rsid" if "rsid" in sites.columns else "variant_id").alias("_rsid"), strip_chr("chromosome").alias("chromosome"),
        F.col("position").cast("bigint").alias("position"), F.upper("ref").alias("g_ref"), F.upper("alt").alias("g_alt"),
    )
    one = F.collect_list(F.struct("geno_variant_id", "g_ref", "g_alt")).alias("_sites")
    got = weights.where("position is not null").join(sized(s.groupBy("chromosome", "position").agg(one)), ["chromosome", "position"], "left")
    rest = weights.where("position is null")
    ids = s.where(F.col("_rsid").startswith("rs")).groupBy("_rsid").agg(one)
    rest = rest.join(sized(ids), rest["variant_id"] == F.col("_rsid"), "left").drop("_rsid")
    return got.unionByName(rest)


def harmonize(weights: DataFrame, sites: DataFrame, ord_col: str = "_ord", forward_strand: bool = False) -> DataFrame:
    """Every weight with its outcome: matched (with site, counted allele) or the reason it is excluded.

    Columns: the weight's own, outcome, match_type, geno_variant_id, counts_alt, counted_allele.
    Outcomes in order: duplicate, matched, multiallelic, missing, ambiguous, allele_mismatch. After one
    join a weight's sites are judged within its row: no aggregate and no join back. A single site is judged by
    expressions that compile; functions over the array, which do not, are left to positions of several sites.
    """
    w = with_sites(prepared(weights, ord_col), sites)
    kind = lambda x: match_type(F.col("effect_allele"), F.col("other_allele"), x["g_ref"], x["g_alt"], forward_strand)
    many, only = F.size("_sites") > 1, F.get("_sites", F.lit(0))
    w = w.withColumn("_kind", F.when(F.size("_sites") == 1, kind(only)))
    w = w.withColumn("_met", F.when(many, F.transform("_sites", lambda x: F.struct(kind(x).alias("match_type"), x.alias("at")))))
    w = w.withColumn("_good", F.when(many, F.filter("_met", lambda m: m["match_type"].isin(*GOOD))))
    n = F.when(many, F.size("_good")).otherwise(F.coalesce(F.col("_kind").isin(*GOOD), F.lit(False)).cast("int"))
    ambiguous = F.when(many, F.exists("_met", lambda m: m["match_type"] == "ambiguous")).otherwise(F.col("_kind") == "ambiguous")
    outcome = (
        F.when(F.col("_dup"), "duplicate").when(n == 1, "matched").when(n > 1, "multiallelic")
        .when(F.col("_sites").isNull(), "missing").when(ambiguous, "ambiguous").otherwise("allele_mismatch")
    )
    one = F.when(many, F.get("_good", F.lit(0))).otherwise(F.struct(F.col("_kind").alias("match_type"), only.alias("at")))
    out = w.withColumn("outcome", outcome).withColumn("_site", F.when(F.col("outcome") == "matched", one))
    out = out.withColumns({"match_type": F.col("_site.match_type"), "geno_variant_id": F.col("_site.at.geno_variant_id")})
    out = out.withColumn("counts_alt", F.col("match_type").isin("exact", "strand_flip"))
    counted = F.when(F.col("counts_alt"), F.col("_site.at.g_alt")).otherwise(F.col("_site.at.g_ref"))
    return out.withColumn("counted_allele", counted).drop("_dup", "_sites", "_kind", "_met", "_good", "_site")


def model_quality(harmonized: DataFrame) -> DataFrame:
    """Counts and coverage of each (model, feature), in one aggregate over the outcomes."""
    o, m = F.col("outcome"), F.col("match_type")
    q = harmonized.groupBy("model_id", "feature_id").agg(
        F.count("*").alias("n_model_variants"), F.count_if(o == "matched").alias("n_matched_variants"), F.count_if(m == "exact").alias("n_exact_matches"),
        F.count_if(m == "allele_swap").alias("n_allele_swaps"), F.count_if(m.isin("strand_flip", "strand_flip_swap")).alias("n_strand_flips"),
        F.count_if(o == "missing").alias("n_missing_variants"), F.count_if(o == "ambiguous").alias("n_ambiguous_excluded"),
        F.count_if(o == "multiallelic").alias("n_multiallelic_excluded"), F.count_if(o == "allele_mismatch").alias("n_allele_mismatch"), F.count_if(o == "duplicate").alias("n_duplicate_excluded"),
    )
    return q.withColumn("coverage_fraction", F.col("n_matched_variants") / F.greatest(F.col("n_model_variants") - F.col("n_duplicate_excluded"), F.lit(1)))


def coverage_status(quality: DataFrame, least: float = MIN_COVERAGE, allow_low: bool = False, r2: str | None = None, least_r2: float | None = None) -> DataFrame:
    status = F.when(F.col("n_matched_variants") == 0, "NO_MATCH").when(F.col("coverage_fraction") < least, "LOW_COVERAGE").otherwise("OK")
    low = F.coalesce(F.col(r2) <= least_r2, F.lit(False)) if r2 and least_r2 is not None else F.lit(False)
    q = quality.withColumns({"status": status, "below_threshold": low})
    return q.withColumn("predict", (F.col("status") == "OK") | ((F.col("status") == "LOW_COVERAGE") & F.lit(allow_low)))


def lines(matched: DataFrame, rows: int = 0) -> DataFrame:
    """(variant, terms): what a dosage adds to each score, as one row a site.

    All weights of a site and a score are one line ``base + slope * dosage``: a weight on the ALT allele
    adds weight * dosage, one on the REF allele weight * (2 - dosage). ``rows`` is what they are dealt by.
    """
    w, alt = F.col("weight"), F.col("counts_alt")
    m = dealt(matched.select(F.col("geno_variant_id").alias("variant"), "model_id", "feature_id", "weight", "counts_alt"), rows, "variant", most=TERM_ROWS)
    per = m.groupBy("variant", "model_id", "feature_id").agg(
        F.sum(F.when(alt, 0.0).otherwise(2 * w)).alias("base"), F.sum(F.when(alt, w).otherwise(-w)).alias("slope")
    )
    return per.groupBy("variant").agg(F.collect_list(F.struct("model_id", "feature_id", "base", "slope")).alias("terms"))


def weighted_sum(calls: DataFrame, matched: DataFrame, intercepts: DataFrame | None = None) -> DataFrame:
    """Scores (sample, model_id, feature_id, score) from called dosages (sample, variant, dosage).

    A missing genotype adds 0, because only called rows are joined. One join and one sum. Few terms of a variant's
    calls meet in a score, so they go to their samples before they are summed, by tasks of a stated number of calls.
    """
    called = cut(calls.where("dosage is not null").select("sample", "variant", "dosage"))
    n = called.count()
    t = dealt(called, n, "variant", most=TERM_ROWS).join(lines(matched, n), "variant").select("sample", "dosage", F.explode("terms").alias("t"))
    t = t.select("sample", "t.model_id", "t.feature_id", (F.col("t.base") + F.col("t.slope") * F.col("dosage")).alias("x"))
    s = dealt(t, n, "sample", most=TERM_ROWS).groupBy("sample", "model_id", "feature_id").agg(F.sum("x").alias("score"))
    if intercepts is not None:
        s = s.join(sized(intercepts), ["model_id", "feature_id"], "left").withColumn("score", F.col("score") + F.coalesce("intercept", F.lit(0.0))).drop("intercept")
    return s


def weighted_sum_of_carriers(carriers: DataFrame, called: DataFrame, matched: DataFrame) -> DataFrame:
    """The same from carriers only (dosage > 0), with the sites each sample has a call at.

    A REF-counted weight adds 2 * weight at every called site, less weight * dosage where ALT is
    carried; ``called`` (sample, variant) says where there is a call.
    """
    m = matched.select(F.col("geno_variant_id").alias("variant"), "model_id", "feature_id", F.when(F.col("counts_alt"), F.col("weight")).otherwise(-F.col("weight")).alias("w"), F.when(F.col("counts_alt"), 0.0).otherwise(2 * F.col("weight")).alias("base"))
    alt = carriers.join(m, "variant").select("sample", "model_id", "feature_id", (F.col("dosage") * F.col("w")).alias("x"))
    ref = called.join(m.where("base <> 0"), "variant").select("sample", "model_id", "feature_id", F.col("base").alias("x"))
    return alt.unionByName(ref).groupBy("sample", "model_id", "feature_id").agg(F.sum("x").alias("score"))


def compare(observed: DataFrame, predicted: DataFrame, least: int = 10) -> DataFrame:
    """Pearson r per feature over participants with both values; null under ``least`` pairs or no spread."""
    j = observed.select("participant_id", "feature_id", F.col("value").alias("o")).join(predicted.select("participant_id", "feature_id", F.col("value").alias("p")), ["participant_id", "feature_id"])
    j = j.where("o is not null and p is not null").groupBy("feature_id").agg(F.count("*").alias("n"), F.corr("o", "p").alias("_r"), F.stddev_samp("o").alias("_so"), F.stddev_samp("p").alias("_sp"))
    return j.select("feature_id", "n", F.when((F.col("n") >= least) & (F.col("_so") > 0) & (F.col("_sp") > 0), F.col("_r")).alias("r"))


def compare_summary(per_feature: DataFrame, good: float = 0.1) -> DataFrame:
    return per_feature.agg(F.count("r").alias("n_features"), F.median("r").alias("median_r"), F.count_if(F.col("r") > good).alias("n_above"))


def best_models(stats: DataFrame, methods: Sequence[str], least_r2: float = 0.005) -> DataFrame:
    """One model a CpG: valid ones by R² descending, then in the order of ``methods``."""
    place = F.array_position(F.array(*[F.lit(m) for m in methods]), F.col("method"))
    best = best_row(stats.where("valid and n_weights > 0"), ["cpg_id"], [F.desc_nulls_last("test_r2"), place, F.asc("method")])
    return best.withColumn("below_threshold", F.coalesce(F.col("test_r2") <= least_r2, F.lit(True)))


def model_stats(export: DataFrame) -> DataFrame:
    return export.groupBy("cpg_id", "method").agg(F.max("valid").alias("valid"), F.max("test_r2").alias("test_r2"), F.count("weight").alias("n_weights"))


def ancestry_match(model: Column, cohort: Column) -> Column:
    """matched, mixed, partial, mismatched or unknown, from two arrays of ancestry labels."""
    both = F.size(F.array_intersect(model, cohort))
    none = model.isNull() | cohort.isNull() | (F.size(model) == 0) | (F.size(cohort) == 0)
    inside = both == F.size(F.array_distinct(cohort))
    return F.when(none, "unknown").when(both == 0, "mismatched").when(inside & (F.size(model) == 1), "matched").when(inside, "mixed").otherwise("partial")


def keyed_sites(sites: DataFrame, ord_col: str = "_ord") -> DataFrame:
    """Sites with ``variant_key`` (chromosome:position:ref:alt); of equal keys the first in file order stays."""
    plain = sites.withColumns({"chromosome": strip_chr("chromosome"), "ref": F.upper("ref"), "alt": F.upper("alt")})
    return keep_first(with_key(plain), ["variant_key"], ord_col)


def feature_summary(weights: DataFrame, ord_col: str = "_ord") -> DataFrame:
    """(model_id, feature_id, name, n_weights, r2): name and R² of a feature's first weight, and their number."""
    first = lambda c: F.min_by(c, ord_col).alias(c)
    return weights.groupBy("model_id", "feature_id").agg(first("name"), F.count("*").alias("n_weights"), first("r2"))


def with_quality(features: DataFrame, quality: DataFrame) -> DataFrame:
    """Features with their model quality; null where a model was not harmonized."""
    return features.join(sized(quality), ["model_id", "feature_id"], "left")


def with_samples(scores: DataFrame, samples: DataFrame) -> DataFrame:
    """Scores with the columns of their sample (native_id, participant_id); null where it is unknown."""
    return scores.join(sized(samples), "sample", "left")


def weights_wide(matched: DataFrame, features: Sequence[str]) -> DataFrame:
    """A column a feature, cells that meet summed; for few features, given by name."""
    return matched.groupBy("geno_variant_id", "counted_allele").pivot("feature_id", list(features)).agg(F.sum("weight"))


def catalogue(models: DataFrame, **contains: str) -> DataFrame:
    """Catalogue rows whose columns contain the given texts, whatever their case."""
    out = models
    for c, text in contains.items():
        out = out.where(F.lower(c).contains(text.lower()))
    return out
