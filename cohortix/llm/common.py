"""Helpers the training-data operators share: the shared folder, cut points and word hashing.

Cut points are Parquet tables in the folder that the cluster names in ``spark.checkpoint.dir``, so
a lost executor costs a re-read and never a re-run of what lies before the cut.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A broadcast side never holds more rows than this; beyond it the join is shuffled.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder's address under ``spark.checkpoint.dir``.

    Only where that setting is absent on a single machine (tests) is a folder of our own used.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_dir()
    return f"{base.rstrip('/')}/cohortix-{uuid.uuid4().hex}"


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-cohortix-")


def cut(df: DataFrame, where: str | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return what is read back, with its lineage cut.

    ``options`` are Parquet write options, such as the compression.
    """
    spark = df.sparkSession
    path = f"{where or shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a cut point that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def give_back() -> None:
    """Return memory that was used for a while and is free again to the system, where its allocator can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small(df: DataFrame, rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only when its counted ``rows`` are within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def held_out(id_col: str, folds: int, fold: int):
    """crc32 of the id as text, modulo ``folds``, equals ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each value of an Arrow string column, null as empty."""
    for v in pc.fill_null(column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column, b"").to_pylist():
        yield v


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased; other letters stay as they are."""
    return text.lower().split()


class WordHash:
    """64-bit hashes of words. The memo is emptied when it is full, so memory is bounded."""

    def __init__(self, most: int = 400_000):
        self.memo: dict[bytes, int] = {}
        self.most = most

    def __call__(self, ws: list[bytes]) -> np.ndarray:
        memo, h = self.memo, xxhash.xxh3_64_intdigest
        if len(memo) > self.most:
            memo.clear()
        for w in set(ws).difference(memo):
            memo[w] = h(w)
        return np.fromiter(map(memo.__getitem__, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; a shorter text is one shingle, no words none."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64)
    m = max(n - width + 1, 1)
    acc = np.full(m, min(n, width), np.uint64)
    for j in range(min(n, width)):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + m])
    return np.unique(acc)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows from an iterator of tuples."""
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield to_batch(held, schema)
            held = []
    if held:
        yield to_batch(held, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
