"""Reference sequences: indexes of FASTA files and bases at sites, by byte ranges.

An index row (.fai) says where a contig's bases begin and how long its lines are. Sites are sent to the range of bytes
that holds them, in order, and each range is read once. A FASTA may be one file or a folder of files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortix.functions.alleles import chromosome
from cohortix.operators.annotate import sized

from . import files

#: Bytes of a range of sites, of a range of an index scan, and beyond a range's end.
RANGE, SCAN, BEYOND = 4 << 20, 64 << 20, 1 << 12
INDEX = "contig string, length long, offset long, line_bases long, line_width long, file string"


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """The index beside a FASTA file: contig, length, offset, line_bases, line_width, file."""
    f = F.split("value", "\t")
    cols = [f[i].cast("bigint").alias(n) for i, n in enumerate(("length", "offset", "line_bases", "line_width"), 1)]
    return spark.read.text(f"{path}.fai").where(F.col("value").rlike(r"\S")).select(f[0].alias("contig"), *cols, F.lit(path).alias("file"))


def _headers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Header lines that begin within each range, with the width of the first line after them."""
    read = files.Ranges()

    def line_end(path: str, at: int, end: int) -> int:
        while at < end:
            got = read(path, at, 1 << 16)
            if (k := got.find(b"\n")) >= 0:
                return at + k
            at += len(got)
        return end

    for b in it:
        for path, lo, hi, end in zip(*[c.to_pylist() for c in b.columns], strict=True):
            data = read(path, max(lo - 1, 0), hi - max(lo - 1, 0))
            first = [0] if lo == 0 and data.startswith(b">") else []
            at, k = first, data.find(b"\n>")
            while k >= 0:
                at.append(max(lo - 1, 0) + k + 1)
                k = data.find(b"\n>", k + 1)
            rows = []
            for x in at:
                stop = line_end(path, x, end)
                name = read(path, x + 1, stop - x - 1).decode().split()
                line = line_end(path, stop + 1, end)
                text = read(path, stop + 1, line - stop - 1) if line - stop <= BEYOND else read(path, line - 1, 1)
                cr = int(text.endswith(b"\r"))
                rows.append((path, x, name[0] if name else "", stop + 1, line - stop - 1 - cr, line - stop))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["file", "at", "contig", "offset", "line_bases", "line_width"])


def fasta_index(spark: SparkSession, path: str, scan: int = SCAN) -> DataFrame:
    """The index of FASTA files without one: header lines are looked for in byte ranges, by all executors."""
    ranges, ends = [], []
    read = files.Ranges()
    for f in files.files_of(path):
        n = files.size(f)
        tail = read(f, max(0, n - 64), 64)
        ends.append((f, n - len(tail) + len(tail.rstrip(b"\r\n"))))
        ranges += [(f, lo, min(lo + scan, n), n) for lo in range(0, n, scan)]
    df = spark.createDataFrame(ranges, "file string, lo long, hi long, size long").repartition(max(1, len(ranges)), "file", "lo")
    found = df.mapInArrow(_headers, "file string, at long, contig string, offset long, line_bases long, line_width long")
    found = found.join(F.broadcast(spark.createDataFrame(ends, "file string, end long")), "file")  # a row a file
    after = F.lead("at").over(Window.partitionBy("file").orderBy("at"))
    brk = F.col("line_width") - F.col("line_bases")
    n = F.greatest(F.lit(0), F.coalesce(after - brk, "end") - F.col("offset"))
    full = F.floor(n / F.col("line_width"))
    return found.select("contig", (full * F.col("line_bases") + n - full * F.col("line_width")).cast("bigint").alias("length"), "offset", "line_bases", "line_width", "file")


def _read_bases(size: int):
    def bases(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, held = files.Ranges(), (None, 0, b"")
        for b in it:
            out = []
            for path, lo, hi in zip(*[b.column(b.num_columns - 3 + i).to_pylist() for i in range(3)], strict=True):
                if path is None or hi <= lo:
                    out.append("")
                    continue
                if held[:2] != (path, lo // size):
                    held = (path, lo // size, read(path, lo // size * size, size + BEYOND))
                at = lo - held[1] * size
                raw = held[2][at : at + hi - lo] if at + hi - lo <= size + BEYOND else read(path, lo, hi - lo)
                out.append(raw.translate(None, b"\r\n").decode().upper())
            yield pa.RecordBatch.from_arrays([*b.columns[:-3], pa.array(out, pa.string())], names=[*b.schema.names[:-3], "bases"])

    return bases


def bases_of(sites: DataFrame, index: DataFrame, length: str | Column | None = None, size: int = RANGE) -> DataFrame:
    """Sites (chromosome, position) with ``bases``: the reference from each position on, upper-case.

    ``length`` bases (1), fewer at a contig's end; empty outside the contigs and for a null place. Names of
    chromosomes are compared without ``chr`` and by their aliases. An index has a row a contig and is broadcast.
    """
    n = F.lit(1) if length is None else (F.col(length) if isinstance(length, str) else length)
    i = index.select(chromosome("contig").alias("_name"), F.col("length").alias("_length"), "offset", "line_bases", "line_width", "file").dropDuplicates(["_name"])
    at = sites.withColumn("_n", n).withColumn("_chrom", chromosome("chromosome")).join(sized(i), F.col("_chrom") == F.col("_name"), "left")
    p0 = F.col("position") - 1
    last = F.least(p0 + F.col("_n"), F.col("_length")) - 1
    byte = lambda p: F.col("offset") + F.floor(p / F.col("line_bases")) * F.col("line_width") + p % F.col("line_bases")
    inside = (p0 >= 0) & (last >= p0)
    rows = at.select(*sites.columns, F.when(inside, F.col("file")).alias("_file"), F.when(inside, byte(p0)).otherwise(0).cast("bigint").alias("_lo"), F.when(inside, byte(last) + 1).otherwise(0).cast("bigint").alias("_hi"))
    rows = rows.repartition("_file", F.floor(F.col("_lo") / size)).sortWithinPartitions("_file", "_lo")
    kinds = ", ".join(f"`{c}` {t}" for c, t in sites.dtypes)
    return rows.mapInArrow(_read_bases(size), f"{kinds}, bases string")


def write_fasta(bases: DataFrame, folder: str, width: int = 60) -> None:
    """A file a contig from (contig, position, base): what is not given is N. A task writes a contig."""

    def one(t: pa.Table) -> pa.Table:
        contig = t.column("contig")[0].as_py()
        at = t.column("position").to_numpy() - 1
        seq = np.full(int(at.max()) + 1, 78, np.uint8)
        seq[at] = np.frombuffer("".join(t.column("base").to_pylist()).encode(), np.uint8)
        full = -(-len(seq) // width)
        lines = np.full((full, width + 1), 10, np.uint8)
        padded = np.concatenate([seq, np.zeros(full * width - len(seq), np.uint8)]).reshape(full, width)
        lines[:, :width] = padded
        head = f">{contig}\n".encode()
        body = lines.tobytes().replace(b"\0", b"")
        path = f"{folder}/{contig}.fa"
        files.write(path, head + body)
        return pa.table({"contig": pa.array([contig]), "length": pa.array([len(seq)], pa.int64())})

    rows = bases.select(F.col("contig").cast("string"), F.col("position").cast("bigint"), "base").groupBy("contig")
    rows.applyInArrow(one, "contig string, length long").collect()  # a row a contig
