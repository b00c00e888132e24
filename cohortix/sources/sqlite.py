"""Tables of SQLite files by ranges of row ids, read where the file lies; no row goes through the driver.

A file at a local or mounted path is opened there. One at another address is taken into a task's memory whole, so such
a file has to fit there. A table without row ids is one range.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from contextlib import closing

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from . import files

#: Rows of a range, and of a batch.
ROWS, BATCH = 1_000_000, 20_000


def connect(path: str) -> sqlite3.Connection:
    fs, where = files.place(path)
    if isinstance(fs, pafs.LocalFileSystem):
        if not files.exists(path):
            raise FileNotFoundError(path)
        return sqlite3.connect(f"file:{where}?mode=ro", uri=True)
    db = sqlite3.connect(":memory:")
    with fs.open_input_file(where) as f:
        db.deserialize(f.read())
    return db


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class _Rows(InputPartition):
    def __init__(self, lo: int | None, hi: int | None):
        self.lo, self.hi = lo, hi


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, table: str, rows: int, names: list[str]):
        self.path, self.table, self.rows, self.names = path, table, rows, names

    def partitions(self):
        with closing(connect(self.path)) as db:
            try:
                lo, hi = db.execute(f"select min(rowid), max(rowid) from {_quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:
                return [_Rows(None, None)]
        return [] if lo is None else [_Rows(x, x + self.rows) for x in range(lo, hi + 1, self.rows)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty table
            return
        with closing(connect(self.path)) as db:
            own = "" if partition.lo is None else f" where rowid >= {partition.lo} and rowid < {partition.hi}"
            cur = db.execute(f"select {', '.join(map(_quoted, self.names))} from {_quoted(self.table)}{own}")
            while rows := cur.fetchmany(BATCH):
                cols = [[None if v is None else v.decode() if isinstance(v, bytes) else str(v) for v in c] for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=self.names)


class SqliteDataSource(DataSource):
    """``spark.read.format("sqlite").option("table", t).load(path)``: every column as text."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _names(self) -> list[str]:
        with closing(connect(self.options["path"])) as db:
            names = [r[1] for r in db.execute(f"pragma table_info({_quoted(self.options['table'])})")]
        if not names:
            raise ValueError(f"{self.options['path']} has no table {self.options['table']}")
        return names

    def schema(self) -> str:
        return ", ".join(f"`{n.replace('`', '``')}` string" for n in self._names())

    def reader(self, schema) -> SqliteReader:
        o = self.options
        return SqliteReader(o["path"], o["table"], int(o.get("rows", ROWS)), self._names())


def read_sqlite(spark: SparkSession, path: str, table: str, rows: int = ROWS) -> DataFrame:
    spark.dataSource.register(SqliteDataSource)
    return spark.read.format("sqlite").option("table", table).option("rows", rows).load(path)
