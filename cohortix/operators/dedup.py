"""One row per key: first, best, latest; duplicates; samples. Every choice has a stated total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortix.functions.text import col

from .cutpoint import cut


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keep_first(df: DataFrame, keys: Sequence[str], ord_col: str = "_ord") -> DataFrame:
    """The row of smallest ``ord_col`` of each key. Rows with a null in the key are a key like any other.

    ``min_by`` combines on the map side, so a key that holds a third of all rows is no longer than
    the others after the first stage.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(ord_col)).alias("_r"))
    return picked.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def later_rows(df: DataFrame, keys: Sequence[str], ord_col: str = "_ord") -> DataFrame:
    """What ``keep_first`` leaves out."""
    w = Window.partitionBy(*keys).orderBy(ord_col)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn > 1").drop("_rn")


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def latest(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``by``."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_r"))
    return picked.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def numbered(df: DataFrame, order: Sequence[Column | str], name: str = "row", start: int = 0) -> DataFrame:
    """A running number over a stated order, without moving all rows to one task.

    Rows are range-partitioned by the order; each partition adds the sizes of those before it.
    """
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    # written, so that both readers see the same partitions even where an executor is lost
    part = cut(df.repartitionByRange(int(n), *[col(c) for c in order]).withColumn("_p", F.spark_partition_id()))
    before = part.groupBy("_p").count().withColumn("_before", F.sum("count").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    keys = F.broadcast(before.select("_p", F.coalesce("_before", F.lit(0)).alias("_before")))
    return part.withColumn("_i", inside).join(keys, "_p").withColumn(name, F.col("_i") - 1 + F.col("_before") + start).drop("_p", "_i", "_before")


def seeded_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """``n`` rows, the same for any partitioning: those of smallest MD5 of ``seed|key|...``."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return df.orderBy(F.md5(text.cast("binary")), *keys).limit(n)


def top_rows(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order``; each task keeps its own first ``k`` before they are merged."""
    return df.orderBy(*order).limit(k)


def smallest(df: DataFrame, keys: Sequence[str], value: str, most: int, name: str) -> DataFrame:
    """(keys, array ``name``): the ``most`` smallest distinct values of each key, in order.

    Every task keeps its own smallest before the shuffle, so no group is ever held whole.
    """
    w = Window.partitionBy(*keys).orderBy(value)
    top = df.select(*keys, value).distinct().withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most)
    return top.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias(name))


# ---- sets of rows that replace others ---------------------------------------------------------


def insert_absent(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` and those of ``new`` whose key it lacks."""
    return old.unionByName(new.join(old.select(*keys).distinct(), list(keys), "left_anti"))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those with the same key.

    Of new rows that share a key the last in ``by`` stays, by default that of the largest values.
    """
    rest = [c for c in new.columns if c not in keys]
    one = latest(new, keys, [*by, *rest]) if rest else new.distinct()
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(one)


def refresh_source(old: DataFrame, new: DataFrame, source: str = "source_id") -> DataFrame:
    """All rows of the sources that ``new`` holds are replaced by those in ``new``."""
    return old.join(new.select(source).distinct(), source, "left_anti").unionByName(new)
