"""Tabular sources. Text columns arrive as strings; typing is a separate, stated step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKED = (".gz", ".bgz", ".zst")


def table_format(path: str, declared: str | None = None) -> str:
    """Declared format, else by suffix under any compression suffix; else ``txt``, to be sniffed."""
    if declared and declared != "auto":
        return declared
    name = path.lower().rstrip("/")
    for p in _PACKED:
        name = name.removesuffix(p)
    for kind, ends in (("parquet", (".parquet", ".pq")), ("csv", (".csv",)), ("tsv", (".tsv", ".tab")), ("h5ad", (".h5ad",)), ("zarr", (".zarr",))):
        if name.endswith(ends):
            return kind
    return "txt"


def sniff_separator(spark: SparkSession, path: str) -> str | None:
    """Tab, else comma, else None for runs of white space, from the first line alone."""
    line = spark.read.text(path).limit(1).collect()
    head = line[0][0] if line else ""
    return "\t" if "\t" in head else "," if "," in head else None


def read_whitespace(spark: SparkSession, path: str) -> DataFrame:
    """A table split at runs of white space. Blank lines are dropped; rows must match the header's width."""
    lines = spark.read.text(path).where(F.col("value").rlike(r"\S"))
    words = F.split(F.regexp_replace(F.regexp_replace("value", r"^\s+", ""), r"\s+$", ""), r"\s+")
    rows = lines.select(words.alias("w"), F.col("value"))
    head = rows.limit(1).collect()
    if not head:
        raise ValueError(f"{path} has no header")
    names, first = head[0]["w"], head[0]["value"]
    body = rows.where(F.col("value") != first).select("w")
    width = F.assert_true(F.size("w") == len(names), F.lit(f"a row of {path} does not have {len(names)} fields"))
    return body.select(*[F.when(width.isNull(), F.get("w", F.lit(i))).alias(n) for i, n in enumerate(names)])


def read_table(spark: SparkSession, path: str, fmt: str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Any supported table; text formats with every column as a string, empty fields as empty strings."""
    kind = table_format(path, fmt)
    if kind == "parquet":
        df = spark.read.parquet(path)
    elif kind in ("csv", "tsv", "txt"):
        sep = {"csv": ",", "tsv": "\t"}.get(kind) or sniff_separator(spark, path)
        df = read_whitespace(spark, path) if sep is None else spark.read.csv(path, sep=sep, header=True, inferSchema=False, nullValue=None, emptyValue="", enforceSchema=False)
    else:
        raise ValueError(f"{path}: {kind} is not a tabular format here; convert it to Parquet")
    return df.select(*columns) if columns else df


def table_columns(spark: SparkSession, path: str, fmt: str | None = None) -> list[str]:
    return read_table(spark, path, fmt).columns


def read_samples_by_features(df: DataFrame, sample: str, metadata: Sequence[str] = ()) -> DataFrame:
    """(sample, feature, raw, value) of an omics table with a row a sample."""
    features = [c for c in df.columns if c != sample and c not in metadata]
    long = df.select(F.col(sample).cast("string").alias("sample"), *[F.col(f"`{c}`").cast("string").alias(c) for c in features]).unpivot("sample", features, "feature", "raw")
    return long.withColumn("value", F.col("raw").try_cast("double"))


def read_features_by_samples(df: DataFrame, feature: str) -> DataFrame:
    """The same from a table with a row a feature: sample columns become rows; no transposition."""
    samples = [c for c in df.columns if c != feature]
    long = df.select(F.col(feature).cast("string").alias("feature"), *[F.col(f"`{c}`").cast("string").alias(c) for c in samples]).unpivot("feature", samples, "sample", "raw")
    return long.select("sample", "feature", "raw", F.col("raw").try_cast("double").alias("value"))


def split_columns(df: DataFrame, known: Sequence[str]) -> tuple[list[str], list[str]]:
    """(observation columns, feature columns) of a stored omics artifact."""
    return [c for c in df.columns if c in known], [c for c in df.columns if c not in known]


def with_order(df: DataFrame, name: str = "_ord") -> DataFrame:
    """An explicit ingest order, for rules that say "first". It follows the files as they are read."""
    return df.withColumn(name, F.monotonically_increasing_id())
