"""Tables in versions: a write never touches what readers read, and a small numbered file says which data is current.

A table's folder holds data folders and ``_versions/<n>``, a file that names one of them. Version n + 1 is committed by
renaming a written file to its number, which fails where the number is taken: of writers that began from one version
one wins. A writer that dies leaves a data folder that no version names. The newest number is the current version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


class Conflict(Exception):
    """Another writer committed the version that this one was to be."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions in order; none for a table that is not there."""
    _, p, fs = _hadoop(spark, f"{path.rstrip('/')}/_versions")
    if not fs.exists(p):
        return []
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit())


def _commit(spark: SparkSession, path: str, n: int, data: str) -> None:
    base = f"{path.rstrip('/')}/_versions"
    jvm, staged, fs = _hadoop(spark, f"{base}/.{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps({"version": n, "data": data}).encode()))
    out.close()
    to = jvm.org.apache.hadoop.fs.Path(f"{base}/{n}")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(staged), fs.makeQualified(to), none)
    except Exception as e:
        fs.delete(staged, False)
        if fs.exists(to):
            raise Conflict(f"{path}: version {n} is taken") from e
        raise


def write_version(df: DataFrame, path: str, by: Sequence[str] = (), expect: int | None = None, retries: int = 20) -> int:
    """Write ``df`` as the next version and return its number.

    With ``expect``, the version that the new one is made from (0: none), a version of another writer in between
    raises ``Conflict``. Without it the write follows whatever is newest, trying again with the next number.
    """
    spark = df.sparkSession
    data = f"data-{uuid.uuid4().hex}"
    w = df.write.option("compression", "zstd")
    (w.partitionBy(*by) if by else w).parquet(f"{path.rstrip('/')}/{data}")
    for left in range(retries, -1, -1):
        n = expect + 1 if expect is not None else (versions(spark, path) or [0])[-1] + 1
        try:
            _commit(spark, path, n, data)
            return n
        except Conflict:
            if expect is not None or not left:
                raise
    raise AssertionError("unreachable")


def _named(spark: SparkSession, path: str, n: int) -> str:
    text = spark.read.text(f"{path.rstrip('/')}/_versions/{n}", wholetext=True).first()[0]
    return f"{path.rstrip('/')}/{json.loads(text)['data']}"


def read_version(spark: SparkSession, path: str, version: int | None = None, schema: str | None = None) -> DataFrame:
    """The current version, or an earlier one that is still there."""
    there = versions(spark, path)
    if not there or (version is not None and version not in there):
        raise FileNotFoundError(f"{path}: no version {'yet' if version is None else version}")
    r = spark.read.schema(schema) if schema else spark.read
    return r.parquet(_named(spark, path, version if version is not None else there[-1]))


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` versions, and return which; data that no version names is removed by nobody else.

    Only for a time when no reader is on an old version and no writer is at work.
    """
    there = versions(spark, path)
    named = {n: _named(spark, path, n) for n in there}
    kept = {named[n].rpartition("/")[2] for n in there[-max(1, keep) :]}
    jvm, p, fs = _hadoop(spark, path)
    for n in there[: -max(1, keep)]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_versions/{n}"), False)
    for s in fs.listStatus(p):
        if s.getPath().getName().startswith("data-") and s.getPath().getName() not in kept:
            fs.delete(s.getPath(), True)
    return there[: -max(1, keep)]
