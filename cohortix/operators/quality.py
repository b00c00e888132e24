"""Validators: each looks at one source and returns all its checks, failed or not.

A check row is (check, status, count, examples): PASS, FAIL, WARN or INFO, how many rows or values
offend, and up to five of them. Nothing stops at the first problem.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.text import is_missing, to_number

from .coding import HANDLERS
from .dedup import smallest

SCHEMA = "check string, status string, count bigint, examples array<string>"


@dataclass(frozen=True)
class Check:
    """A check: its aggregate ``count``, and ``shown``, the value of a row that offends (else null)."""

    name: str
    count: Column
    shown: Column | None = None
    bad: str = "FAIL"
    good: str = "PASS"

    def row(self) -> Column:
        n = F.coalesce(self.count, F.lit(0)).cast("bigint")
        return F.struct(F.lit(self.name).alias("check"), F.when(n > 0, self.bad).otherwise(self.good).alias("status"), n.alias("count"))


check = Check


def offending(c: str | Column, when: Column) -> Column:
    return F.when(when, c if isinstance(c, Column) else F.col(c).cast("string"))


def checks(df: DataFrame, *made: Check) -> DataFrame:
    """One pass over ``df`` for all counts, one for the examples of those that show any; a row each."""
    got = df.agg(F.array(*[m.row() for m in made]).alias("c")).select(F.inline("c"))
    none = F.array().cast("array<string>")
    shown = [F.struct(F.lit(m.name).alias("check"), m.shown.cast("string").alias("v")) for m in made if m.shown is not None]
    if not shown:
        return got.withColumn("examples", none)
    few = smallest(df.select(F.inline(F.array(*shown))).where("v is not null"), ["check"], "v", 5, "examples")
    return got.join(F.broadcast(few), "check", "left").withColumn("examples", F.coalesce("examples", none))  # a row a check


def fixed(spark: SparkSession, rows: Sequence[tuple[str, str, int, list[str]]]) -> DataFrame:
    return spark.createDataFrame(list(rows), SCHEMA)


def duplicate_check(df: DataFrame, keys: Sequence[str], name: str = "duplicate_ids", bad: str = "FAIL") -> DataFrame:
    """Distinct keys that occur more than once."""
    twice = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return checks(twice.withColumn("k", F.concat_ws(":", *keys)), check(name, F.count("*"), F.col("k"), bad))


def columns_check(df: DataFrame, wanted: Sequence[str], name: str = "columns_present") -> DataFrame:
    absent = [c for c in wanted if c not in df.columns]
    return fixed(df.sparkSession, [(name, "FAIL" if absent else "PASS", len(absent), sorted(absent)[:5])])


def validate_phenotype(df: DataFrame, participant: str, value: str, kind: str, event: str | None = None, **options) -> DataFrame:
    head = columns_check(df, [participant, value, *([event] if event else [])])
    known = kind in HANDLERS
    head = head.unionByName(fixed(df.sparkSession, [("type_supported", "PASS" if known else "FAIL", int(not known), [] if known else [kind])]))
    if not known or any(c not in df.columns for c in (participant, value)):
        return head
    coded = HANDLERS[kind](df, value, **options)
    ids = is_missing(participant)
    got = checks(
        df,
        check("missing_ids", F.count_if(ids)),
        check("invalid_values", F.count_if(coded.invalid), offending(value, coded.invalid)),
        check("missing_values", F.count_if(coded.missing), bad="INFO", good="INFO"),
        check("missing_fraction", F.when(F.count_if(coded.missing) > 0.2 * F.count("*"), F.count_if(coded.missing)), bad="WARN"),
    )
    return head.unionByName(got).unionByName(duplicate_check(df.where(~ids), [participant, *([event] if event else [])]))


def validate_covariates(df: DataFrame, participant: str, columns: Sequence[str], categorical: Sequence[str] = (), most_missing: float = 0.05) -> DataFrame:
    head = columns_check(df, [participant, *columns])
    have = [c for c in columns if c in df.columns]
    made = [check(f"missing:{c}", F.when(F.count_if(is_missing(c)) > most_missing * F.count("*"), F.count_if(is_missing(c))), bad="WARN") for c in have]
    made += [
        check(f"undeclared_categorical:{c}", F.count_if(~is_missing(c) & to_number(c).isNull()), offending(c, ~is_missing(c) & to_number(c).isNull()), bad="WARN")
        for c in have
        if c not in categorical
    ]
    return head.unionByName(checks(df, check("missing_ids", F.count_if(is_missing(participant))), *made)).unionByName(duplicate_check(df, [participant], "unique_ids"))


def validate_matrix(long: DataFrame, samples: DataFrame, sample: str, event: str | None = None, measurement: str = "") -> DataFrame:
    """``long``: (sample, feature, value, raw) of an omics matrix; ``samples``: its rows' ids."""
    v, raw = F.col("value"), F.col("raw")
    bad = raw.isNotNull() & v.isNull()
    made = [check("non_numeric_values", F.count_if(bad), offending("raw", bad))]
    if measurement == "counts":
        made.append(check("non_negative", F.count_if(v < 0), offending("feature", v < 0)))
    if measurement == "beta":
        out = (v < 0) | (v > 1)
        made.append(check("within_0_1", F.count_if(out), offending("feature", out)))
    per = long.groupBy("feature").agg(F.count("value").alias("n"))
    empty = checks(per, check("at_least_one_feature", F.when(F.count("*") == 0, 1)), check("all_missing_features", F.count_if(F.col("n") == 0), offending("feature", F.col("n") == 0), bad="WARN"))
    ids = checks(samples, check("missing_ids", F.count_if(is_missing(sample))))
    return checks(long, *made).unionByName(empty).unionByName(ids).unionByName(duplicate_check(samples, [sample, *([event] if event else [])]))


def validate_clinical(df: DataFrame, participant: str, variables: Sequence[str], event: str | None = None) -> DataFrame:
    keys = [participant, *([event] if event else [])]
    return columns_check(df, [*keys, *variables]).unionByName(duplicate_check(df, keys, bad="WARN"))


def validate_genotype(samples: DataFrame, variants: DataFrame, build_confidence: float | None = None) -> DataFrame:
    """``samples``: IID; ``variants``: variant_id and position."""
    s = checks(samples, check("empty_sample_ids", F.count_if(is_missing("IID", ("", "0")))))
    v = checks(
        variants,
        check("unplaced_variants", F.count_if(F.coalesce("position", F.lit(0)) < 1), bad="WARN"),
        check("missing_variant_ids", F.count_if(is_missing("variant_id", ("", "."))), bad="WARN"),
    )
    out = s.unionByName(duplicate_check(samples, ["IID"], "unique_sample_ids")).unionByName(v)
    out = out.unionByName(duplicate_check(variants.where(~is_missing("variant_id", ("", "."))), ["variant_id"], "duplicate_variant_ids", "WARN"))
    if build_confidence is not None:
        low = build_confidence < 0.8
        out = out.unionByName(fixed(samples.sparkSession, [("build_confidence", "WARN" if low else "PASS", int(low), [])]))
    return out


def cross_source(phenotypes: DataFrame, genotypes: DataFrame, builds: DataFrame) -> DataFrame:
    """Participants with a phenotype and no genotype; sources on different genome builds."""
    lone = phenotypes.select("participant_id").distinct().join(genotypes.select("participant_id").distinct(), "participant_id", "left_anti")
    out = checks(phenotypes, check("phenotypes_exist", F.when(F.count("*") == 0, 1)))
    out = out.unionByName(checks(genotypes, check("predictive_sources_exist", F.when(F.count("*") == 0, 1))))
    out = out.unionByName(checks(lone, check("phenotype_without_genotype", F.count("*"), F.col("participant_id"), bad="WARN")))
    return out.unionByName(checks(builds.select("build").distinct(), check("conflicting_builds", F.when(F.count("*") > 1, F.count("*")), F.col("build"))))


def contract(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (), isin: dict[str, Sequence[str]] | None = None, at_least: dict[str, float] | None = None) -> DataFrame:
    """An output's contract: nulls, uniqueness, allowed values and lower bounds."""
    made = [check(f"not_null:{c}", F.count_if(F.col(c).isNull())) for c in not_null]
    made += [check(f"isin:{c}", F.count_if(~F.col(c).isin(list(v))), offending(c, ~F.col(c).isin(list(v)))) for c, v in (isin or {}).items()]
    made += [check(f"at_least:{c}", F.count_if(F.col(c) < v), offending(c, F.col(c) < v)) for c, v in (at_least or {}).items()]
    out = checks(df, *made) if made else fixed(df.sparkSession, [])
    return out.unionByName(duplicate_check(df, list(unique), "unique:" + ",".join(unique))) if unique else out


def status_of(checked: DataFrame) -> DataFrame:
    """One row: FAIL if any check fails, else WARN if any warns, else PASS."""
    s = F.col("status")
    return checked.agg(F.when(F.count_if(s == "FAIL") > 0, "FAIL").when(F.count_if(s == "WARN") > 0, "WARN").otherwise("PASS").alias("status"))
