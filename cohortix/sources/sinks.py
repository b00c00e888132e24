"""Sinks: versioned and partitioned Parquet, text exchange files, JSON."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .versions import write_version


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_atomic(df: DataFrame, path: str, by: Sequence[str] = ()) -> int:
    """The next version of the table at ``path``: readers see the old one or the new one, whenever the writer dies.

    It is read with ``versions.read_version``.
    """
    return write_version(df, path, by)


def write_sorted_partitions(df: DataFrame, path: str, by: str, order: Sequence[str]) -> None:
    """A folder a value of ``by``, rows in order within files.

    Tasks take ranges of ``by``, ``order`` and a hash of the row, so a value with a large share of the rows is
    written by many, and statistics of its files still tell which hold a place.
    """
    keys = [F.col(by), *map(F.col, order), F.xxhash64(*df.columns)]
    df.repartitionByRange(*keys).sortWithinPartitions(by, *order).write.mode("overwrite").option("compression", "zstd").partitionBy(by).parquet(path)


def write_buckets(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Long tables in folders by hash of the key, so that a reader of one key opens one folder.

    Tasks take ranges of bucket, key and a hash of the row: neither a large bucket nor a hot key is one task's.
    """
    df = df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    df.repartitionByRange("bucket", key, F.xxhash64(*df.columns)).sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_partitioned(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned table whose folder values keep the given types ("02" stays text)."""
    return spark.read.schema(schema).parquet(path)


def sites_vcf_lines(variants: DataFrame, build: str) -> DataFrame:
    """Lines (value) of a sites-only VCF: header, then sites by chromosome and position; null alleles dropped."""
    spark = variants.sparkSession
    head = spark.createDataFrame([(0, "##fileformat=VCFv4.2"), (1, f"##reference={build}"), (2, "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")], "i long, value string")
    v = variants.where("ref is not null and alt is not null").select(F.lit(3).cast("long").alias("i"), "chromosome", "position", F.concat_ws("\t", "chromosome", F.col("position").cast("string"), "variant_key", "ref", "alt", F.lit("."), F.lit("."), F.lit(".")).alias("value"))
    h = head.select("i", F.lit("").alias("chromosome"), F.lit(0).cast("bigint").alias("position"), "value")
    return h.unionByName(v).orderBy("i", "chromosome", "position", "value").select("value")


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").csv(path, sep="\t", header=header)


def export_tables(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        write_atomic(df, f"{folder}/{name}")


def freeze(tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """A snapshot: all tables under a new folder, or none; returns its manifest (table, n_rows, digest)."""
    from cohortix.operators.profile import table_digest

    spark = next(iter(tables.values())).sparkSession
    jvm, to, fs = _fs(spark, folder)
    if fs.exists(to):
        raise FileExistsError(f"{folder}: a snapshot is never changed")
    staged = f"{folder.rstrip('/')}.{uuid.uuid4().hex}"
    rows = []
    for name, df in tables.items():
        df.write.parquet(f"{staged}/{name}")
        rows.append((name, *table_digest(spark.read.parquet(f"{staged}/{name}")).first()))
    manifest = spark.createDataFrame(rows, "table_name string, n_rows bigint, digest string")
    manifest.coalesce(1).write.json(f"{staged}/_manifest")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), to):
        raise OSError(f"could not rename {staged}")
    return manifest


def verify(spark: SparkSession, folder: str) -> DataFrame:
    """(table_name, ok) of a snapshot: digests of what is there against the manifest."""
    from cohortix.operators.profile import table_digest

    said = spark.read.schema("table_name string, n_rows bigint, digest string").json(f"{folder}/_manifest").collect()
    now = [(r["table_name"], tuple(table_digest(spark.read.parquet(f"{folder}/{r['table_name']}")).first()) == (r["n_rows"], r["digest"])) for r in said]
    return spark.createDataFrame(now, "table_name string, ok boolean")
