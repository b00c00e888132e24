"""Exact deduplication as a stateful stream: disk-backed keyed state without expiry, checked on full bytes.

Two Structured Streaming queries share a folder, ``where``:

- *landing* (stateless): each text is lower-cased (A-Z only) and stored once a task in a content file, compressed.
  A row a document goes to ``members``: its id, the SHA-256 and the content's locator (file, offset, size).
- *settling* (stateful): members of one content are combined inside the tasks, so a text with any number of copies
  sends a row a task. The state, in RocksDB and checkpointed to ``where``, holds for each digest and slot the stable
  identifier (the largest id), the content's locator and the number of rows; it has no time to live and no watermark.
  On a hit the full bytes behind both locators are compared; a text of another content goes to the next slot.

Both queries are exactly-once: they go on from their checkpoints, in this run or a later one with more input.

Defined results: a null text is empty; null ids come before all others; rows that repeat an id and text all count and
are all kept if their id is the one that stays; an empty stream gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from .common import cut, shared_dir, small, texts_of

#: Bytes of texts that a landing task remembers to store each of them once; contents that it settles before it sends them on.
REMEMBERED, COMBINED = 64 << 20, 200_000
#: Bytes of input in a micro-batch.
BATCH = 256 << 30
MEMBERS = "doc_id {}, sha binary, key binary, file string, at long, size long"
UPDATES = "key binary, slot int, keep {}, n long, file string, at long"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # a store takes local disk and memory while its task runs, not for good
}


def _fs(address: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(address if "://" in address else address.replace("file:/", "file:///", 1))


# ---- contents ---------------------------------------------------------------------------------


class ContentWriter:
    """Appends contents to one file of its own name; an attempt that fails leaves a file that nothing names."""

    def __init__(self, folder: str):
        import zstandard

        self.folder, self.name, self.out, self.at = folder, uuid.uuid4().hex, None, 0
        self.pack = zstandard.ZstdCompressor(level=1).compress

    def add(self, content: bytes) -> tuple[str, int, int]:
        if self.out is None:
            fs, path = _fs(f"{self.folder}/{self.name}")
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            self.out = fs.open_output_stream(path)
        data = self.pack(content)
        self.out.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


class ContentReader:
    """Reads contents by locator; a few files stay open."""

    def __init__(self, folder: str, most: int = 32):
        import zstandard

        self.folder, self.most, self.files = folder, most, OrderedDict()
        self.unpack = zstandard.ZstdDecompressor().decompress

    def __call__(self, file: str, at: int, size: int) -> bytes:
        if file not in self.files:
            fs, path = _fs(f"{self.folder}/{file}")
            self.files[file] = fs.open_input_file(path)
            if len(self.files) > self.most:
                self.files.popitem(last=False)[1].close()
        self.files.move_to_end(file)
        return self.unpack(self.files[file].read_at(size, at))


def stream_of(spark: SparkSession, path: str, batch: int = BATCH) -> DataFrame:
    """The Parquet table at ``path``, a folder or a single file, as a stream of ``batch`` bytes at a time.

    The last letter is written as a pattern: a stream takes a single file by a pattern only.
    """
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch).parquet(f"{path[:-1]}[{path[-1]}]")


# ---- landing ----------------------------------------------------------------------------------


def _store(folder: str, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def store(it):
        writer, seen, held = ContentWriter(folder), {}, 0
        mask = ((1 << bits) - 1) << (256 - bits)
        for b in it:
            rows = []
            for text in texts_of(b.column(1)):
                t = text.lower()
                if (row := seen.get(t)) is None:  # the same bytes, not the same digest only
                    sha = hashlib.sha256(t).digest()
                    key = sha if bits == 256 else (int.from_bytes(sha) & mask).to_bytes(32)
                    row = (sha, key, *writer.add(t))
                    held += len(t)
                    if held > REMEMBERED:
                        seen, held = {}, len(t)
                    seen[t] = row
                rows.append(row)
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.binary(), pa.binary(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, cols, kinds)], names=["doc_id", "sha", "key", "file", "at", "size"])
        writer.close()

    return store


def land(stream: DataFrame, where: str, doc_id: str = "doc_id", text: str = "text", bits: int = 256) -> StreamingQuery:
    """Store the contents and members of what is there of ``stream``; ends when all of it is landed."""
    kind = dict(stream.dtypes)[doc_id]
    rows = stream.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(_store(f"{where}/content", bits), MEMBERS.format(kind))
    return rows.writeStream.format("parquet").option("path", f"{where}/members").option("checkpointLocation", f"{where}/landing").trigger(availableNow=True).start()


# ---- settling ---------------------------------------------------------------------------------


def _combine(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each content that a task has read: its key and locator, the largest id and the number of rows."""
    held: dict[tuple, list] = {}
    schema = None

    def out():
        cols = list(zip(*[(k[0], k[1], k[2], v[0], v[1], v[2]) for k, v in held.items()], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    for b in it:
        ids = b.column(4)
        schema = pa.schema([("key", pa.binary()), ("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("id", ids.type), ("n", pa.int64())])
        for key, file, at, size, i in zip(*[c.to_pylist() for c in b.columns], strict=True):
            got = held.setdefault((key, file, at), [size, i, 0])
            got[2] += 1
            if i is not None and (got[1] is None or i > got[1]):
                got[1] = i
        if len(held) >= COMBINED:
            yield out()
            held.clear()
    if held:
        yield out()


class Settle(StatefulProcessor):
    """Keeps (digest, slot) -> (id, locator, rows); tells a new content from a copy by its bytes."""

    def __init__(self, folder: str, kind: str):
        self.folder, self.kind = folder, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getMapState("seen", "key binary, slot int", f"id {self.kind}, file string, at long, size long, n long")
        self.read = ContentReader(self.folder)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known: dict[tuple, list | None] = {}
        changed: dict[tuple, None] = {}
        apart = []
        for pdf in rows:
            for k, file, at, size, i, n in zip(pdf["key"], pdf["file"], pdf["at"], pdf["size"], pdf["id"], pdf["n"], strict=True):
                i, own, slot = None if pd.isna(i) else i, None, 0
                while True:
                    if (k, slot) not in known:
                        got = self.state.getValue((k, slot))
                        known[k, slot] = list(got) if got is not None else None
                    was = known[k, slot]
                    if was is None:
                        known[k, slot] = [i, file, int(at), int(size), int(n)]
                        break
                    if (was[1], was[2]) != (file, at):  # a hit: the bytes decide
                        own = self.read(file, int(at), int(size)) if own is None else own
                        if own != self.read(was[1], was[2], was[3]):
                            slot += 1
                            continue
                    was[0] = i if was[0] is None or (i is not None and i > was[0]) else was[0]
                    was[4] += int(n)
                    break
                changed[k, slot] = None
                if slot:
                    apart.append((k, slot, None, None, file, int(at)))
        for at in changed:
            self.state.updateValue(at, tuple(known[at]))
        out = [(k, s, known[k, s][0], known[k, s][4], None, None) for k, s in changed] + apart
        yield pd.DataFrame(out, columns=["key", "slot", "keep", "n", "file", "at"]).astype({"n": "Int64", "at": "Int64"})

    def close(self) -> None:
        pass


def settle(spark: SparkSession, where: str, kind: str, buckets: int = 4_096, batch: int = BATCH) -> StreamingQuery:
    """Bring the landed members of ``where`` into the state; ends when all of them are settled.

    ``kind`` is the type of the ids. Digests are grouped in ``buckets`` for the calls only: the state has an entry
    for each digest and slot.
    """
    members = spark.readStream.schema(MEMBERS.format(kind)).option("maxBytesPerTrigger", batch).parquet(f"{where}/members")
    rows = members.select("key", "file", "at", "size", F.col("doc_id").alias("id")).mapInArrow(_combine, f"key binary, file string, at long, size long, id {kind}, n long")
    grouped = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")).groupBy("bucket")
    out = grouped.transformWithStateInPandas(Settle(f"{where}/content", kind), UPDATES.format(kind), "Append", "None")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        return out.writeStream.format("parquet").option("path", f"{where}/updates").option("checkpointLocation", f"{where}/settling").outputMode("append").trigger(availableNow=True).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def settled(spark: SparkSession, where: str, kind: str) -> DataFrame:
    """A row for each landed document: doc_id, keep_id, group_size, kept, text_sha256.

    Copies of one text may be any share of all rows: the last join is a sort-merge join of written tables, which
    adaptive execution splits at skewed keys.
    """
    members, updates = (spark.read.schema(s.format(kind)).parquet(f"{where}/{t}") for s, t in ((MEMBERS, "members"), (UPDATES, "updates")))
    # ids and counts of a slot only grow, so the largest are the last
    groups = cut(updates.where("n is not null").groupBy("key", "slot").agg(F.max("keep").alias("keep_id"), F.max("n").alias("group_size")), where)
    apart = updates.where("n is null").select("file", "at", F.col("slot").alias("_slot")).distinct()
    m = members.select("doc_id", "sha", "key", "file", "at")
    if n := apart.count():
        m = m.join(small(apart, n), ["file", "at"], "left").withColumn("slot", F.coalesce("_slot", F.lit(0)))
    else:
        m = m.withColumn("slot", F.lit(0))
    rows = m.select("doc_id", "sha", "key", "slot").join(groups.hint("merge"), ["key", "slot"])
    return rows.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def stream_dedup(stream: DataFrame, where: str | None = None, doc_id: str = "doc_id", text: str = "text", bits: int = 256, buckets: int = 4_096) -> DataFrame:
    """Land and settle what is there of ``stream`` and return all that ``where`` holds.

    ``where`` is a folder that all executors share, a new one under ``spark.checkpoint.dir`` unless it is given; a
    later call with the same folder goes on from the state of the earlier ones. ``bits`` shortens the digest (tests
    of equal digests of different texts).
    """
    spark, kind = stream.sparkSession, dict(stream.dtypes)[doc_id]
    where = where or shared_dir(spark)
    land(stream, where, doc_id, text, bits).awaitTermination()
    settle(spark, where, kind, buckets).awaitTermination()
    return settled(spark, where, kind)
