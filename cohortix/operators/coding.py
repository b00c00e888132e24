"""Column typing and phenotype coding: text columns become typed columns with stated rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions.text import as_text, is_missing, long_form, null_if_missing, to_number

from .annotate import sized
from .dedup import keep_first, numbered


def numeric_columns(df: DataFrame, columns: Sequence[str], categorical: Sequence[str] = ()) -> dict[str, bool]:
    """Which columns are numeric: none of their non-missing values fails the cast. One pass for all."""
    open_ = [c for c in columns if c not in categorical]
    bad = df.agg(*[F.count_if(~is_missing(c) & to_number(c).isNull()).alias(c) for c in open_]).first() if open_ else {}
    return {c: c not in categorical and bad[c] == 0 for c in columns}


def typed(df: DataFrame, columns: Sequence[str], categorical: Sequence[str] = ()) -> DataFrame:
    """``df`` with missing tokens as nulls and numeric columns as doubles."""
    kinds = numeric_columns(df, columns, categorical)
    return df.select([(to_number(c) if kinds[c] else null_if_missing(c)).alias(c) if c in kinds else F.col(c) for c in df.columns])


def any_value(columns: Sequence[str]) -> Column:
    """At least one of the columns has a value."""
    return F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()


def all_true(columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.col(c), F.lit(False))
    return out


@dataclass(frozen=True)
class Coded:
    """Columns made of one text column: the code, whether the value is missing, whether it is invalid."""

    code: Column
    missing: Column
    invalid: Column


def binary_sets(df: DataFrame, c: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """(case, control) values: 2 and 1 where only those occur and 2 does, else 1 and 0."""
    seen = {r[0] for r in df.select(null_if_missing(c).alias("v")).where("v is not null").distinct().limit(4).collect()}
    return (("2",), ("1",)) if "2" in seen and seen <= {"1", "2"} else (("1",), ("0",))


def code_binary(df: DataFrame, c: str, case: Sequence[str] = (), control: Sequence[str] = ()) -> Coded:
    yes, no = (tuple(case), tuple(control)) if case or control else binary_sets(df, c)
    text, missing = as_text(c), is_missing(c)
    code = F.when(missing, None).when(text.isin(*yes), 1.0).when(text.isin(*no), 0.0)
    return Coded(code, missing, ~missing & code.isNull())


def code_continuous(df: DataFrame, c: str) -> Coded:
    missing = is_missing(c)
    code = F.when(~missing, to_number(c))
    return Coded(code, missing, ~missing & code.isNull())


#: Levels that go into an expression; for more there is ``with_level_code``.
MOST_LEVELS = 1_000


def code_levels(df: DataFrame, c: str, levels: Sequence[str] | None = None) -> Coded:
    """Index in ``levels``; without levels, in the sorted distinct values, of which there may be ``MOST_LEVELS``."""
    if levels is None:
        got = df.select(null_if_missing(c).alias("v")).where("v is not null").distinct().limit(MOST_LEVELS + 1).collect()
        if len(got) > MOST_LEVELS:
            raise ValueError(f"{c} has more than {MOST_LEVELS} levels: use with_level_code")
        levels = sorted(r[0] for r in got)
    missing = is_missing(c)
    at = F.array_position(F.array(*[F.lit(x) for x in levels]), as_text(c)) if levels else F.lit(0)
    code = F.when(~missing & (at > 0), (at - 1).cast("double"))
    return Coded(code, missing, ~missing & code.isNull())


def with_level_code(df: DataFrame, c: str, name: str = "code") -> DataFrame:
    """``df`` with the index of each value in the sorted distinct values, however many; null where it is missing.

    Levels are numbered in ranges and joined back, so that neither the driver nor one task holds them all.
    """
    level = null_if_missing(c).alias("_level")
    ranks = numbered(df.select(level).where("_level is not null").distinct(), ["_level"], "_rank").select(F.col("_level").alias("_l"), F.col("_rank").cast("double").alias("_rank"))
    got = df.withColumn("_level", null_if_missing(c)).join(sized(ranks), F.col("_level") == F.col("_l"), "left")
    return got.select(*df.columns, F.col("_rank").alias(name))


#: Phenotype types and the function that codes a column of each; users may add their own.
HANDLERS: dict[str, Callable[..., Coded]] = {
    "binary": code_binary,
    "continuous": code_continuous,
    "multiclass": code_levels,
    "ordinal": code_levels,
}


def observations(df: DataFrame, participant: str, value: str, kind: str, event: str | None = None, ord_col: str = "_ord", **options) -> DataFrame:
    """participant_id, event_id, value_numeric, value_text, is_missing: one row per participant and event."""
    coded = HANDLERS[kind](df, value, **options)
    rows = df.select(
        F.col(participant).alias("participant_id"),
        (F.col(event) if event else F.lit("baseline")).alias("event_id"),
        coded.code.alias("value_numeric"),
        F.when(~coded.missing, as_text(value)).alias("value_text"),
        F.col(ord_col).alias("_ord"),
    ).where("participant_id is not null")
    rows = rows.withColumn("is_missing", F.col("value_numeric").isNull() & F.col("value_text").isNull())
    return keep_first(rows, ["participant_id", "event_id"]).drop("_ord")


def original_values(df: DataFrame, participant: str, value: str, kind: str) -> DataFrame:
    """The column under its own name; a double only for continuous phenotypes."""
    v = to_number(value) if kind == "continuous" else F.col(value).cast("string")
    return df.select(F.col(participant).alias("participant_id"), v.alias(value))


def clinical_long(df: DataFrame, participant: str, variables: Sequence[str], event: str | None = None) -> DataFrame:
    """Wide clinical columns to (participant_id, event_id, variable, value_text, value_numeric); nulls stay."""
    base = df.select(F.col(participant).alias("participant_id"), (F.col(event) if event else F.lit("baseline")).alias("event_id"), *[F.col(v).cast("string").alias(v) for v in variables])
    long = long_form(base, ["participant_id", "event_id"], variables, "variable", "raw")
    return long.select("participant_id", "event_id", "variable", null_if_missing("raw").alias("value_text"), to_number(null_if_missing("raw")).alias("value_numeric"))
