"""BGEN files of layout 2: samples, variants and genotype probabilities.

Variant blocks have no fixed length, so the driver walks their headers once, without the probabilities, and hands out
ranges of blocks by offset. Dosages are expectations over the stored probabilities, for any ploidy, phased or not.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cohortix.functions.alleles import strip_chr

from . import files

#: Bytes that are read at once while headers are walked; how far a dosage may lie from a hard call.
AHEAD, HARD_CALL = 1 << 16, 0.1
CALLS = "variant_idx long, sample_idx long, raw_chromosome string, position long, variant_id string, rsid string, a1 string, a2 string, n_alleles int, dosage double"


class Header(NamedTuple):
    first: int  # of the variant blocks
    variants: int
    samples: int
    compression: int
    layout: int
    ids: bool
    end: int  # of the header block


def header(path: str) -> Header:
    raw = files.Ranges()(path, 0, 24 + AHEAD)
    offset, size, m, n = struct.unpack_from("<IIII", raw)
    if raw[16:20] not in (b"bgen", b"\0\0\0\0") or size < 20:
        raise ValueError(f"{path} is not a BGEN file")
    flags = struct.unpack("<I", files.Ranges()(path, size, 4))[0]
    return Header(offset + 4, m, n, flags & 3, flags >> 2 & 15, bool(flags >> 31), size + 4)


def variant_count(path: str) -> int:
    return header(path).variants


def samples(spark: SparkSession | None, path: str) -> list[str]:
    """Samples: the ``.sample`` file beside it, else the block inside it; raises where there is neither."""
    side = path.removesuffix(".bgen") + ".sample"
    if files.exists(side):
        text = files.Ranges()(side, 0, files.size(side)).decode()
        rows = [x.split() for x in text.splitlines() if x.strip()]
        return [r[1] for r in rows[2:]]  # names and types come first
    h = header(path)
    if not h.ids:
        raise ValueError(f"{path} has no sample ids and no .sample file beside it")
    raw, at, out = files.Ranges()(path, h.end, h.first - h.end), 8, []
    for _ in range(struct.unpack_from("<I", raw, 4)[0]):
        n = struct.unpack_from("<H", raw, at)[0]
        out.append(raw[at + 2 : at + 2 + n].decode())
        at += 2 + n
    return out


class Site(NamedTuple):
    variant_id: str
    rsid: str
    chromosome: str
    position: int
    alleles: list[str]
    data: int  # offset of the probability block's length
    size: int


def _site(get, at: int) -> Site:
    """The identifying data at an offset; ``get(at, n)`` gives bytes."""
    said = []
    for _ in range(3):
        n = struct.unpack("<H", get(at, 2))[0]
        said.append(get(at + 2, n).decode())
        at += 2 + n
    position, k = struct.unpack("<IH", get(at, 6))
    at += 6
    alleles = []
    for _ in range(k):
        n = struct.unpack("<I", get(at, 4))[0]
        alleles.append(get(at + 4, n).decode())
        at += 4 + n
    return Site(*said, position, alleles, at, struct.unpack("<I", get(at, 4))[0])


class _Window:
    """Bytes of a file through a window that moves on; what lies between two reads is not read."""

    def __init__(self, path: str):
        self.path, self.read, self.lo, self.data = path, files.Ranges(), 0, b""

    def __call__(self, at: int, n: int) -> bytes:
        if not self.lo <= at or at + n > self.lo + len(self.data):
            self.lo, self.data = at, self.read(self.path, at, max(n, AHEAD))
        got = self.data[at - self.lo : at - self.lo + n]
        if len(got) < n:
            raise ValueError(f"{self.path} ends within a variant block")
        return got


def alt_dosage(data: bytes, samples: int) -> np.ndarray:
    """Expected copies of the second allele of each sample from an uncompressed biallelic block; nan where missing."""
    n, k = struct.unpack_from("<IH", data)
    if n != samples or k != 2:
        raise ValueError(f"a block of {n} samples and {k} alleles, not of {samples} and 2")
    ploidy = np.frombuffer(data, np.uint8, n, 8)
    missing, ploidy = ploidy >> 7 == 1, (ploidy & 63).astype(np.int64)
    phased, bits = data[8 + n], data[9 + n]
    raw = np.frombuffer(data, np.uint8, offset=10 + n)
    total = int(ploidy.sum())  # one probability a haplotype, or one less than genotypes of 2 alleles: the same number
    if bits in (8, 16, 32):
        p = raw[: total * bits // 8].view(f"<u{bits // 8}").astype(np.float64)
    else:
        one = np.unpackbits(raw, bitorder="little")[: total * bits].reshape(total, bits)
        p = one @ (2.0 ** np.arange(bits))
    p = p / (2.0**bits - 1)
    own = np.repeat(np.arange(n), ploidy)
    start = np.cumsum(ploidy) - ploidy
    if phased:
        dosage = np.bincount(own, 1 - p, minlength=n)  # each is the first allele's
    else:
        copies = np.arange(total) - start[own]  # the genotypes 0, 1, ... copies; the last is what is left
        dosage = np.bincount(own, p * copies, minlength=n) + ploidy * (1 - np.bincount(own, p, minlength=n))
    return np.where(missing, np.nan, dosage)


def _unpacked(data: bytes, compression: int) -> bytes:
    if compression == 0:
        return data
    size = struct.unpack_from("<I", data)[0]
    if compression == 1:
        out = zlib.decompress(data[4:])
    else:
        import zstandard

        out = zstandard.ZstdDecompressor().decompress(data[4:], max_output_size=size)
    if len(out) != size:
        raise ValueError("a probability block has not its stated length")
    return out


def _ranges(path: str, head: Header, step: int) -> Iterator[tuple[int, int, int]]:
    """Ranges of at most ``step`` variants: number and offset of the first, and how many; one range needs no walk."""
    get, at = _Window(path), head.first
    for i in range(0, head.variants, step):
        yield i, at, min(step, head.variants - i)
        if i + step < head.variants:
            for _ in range(step):
                s = _site(get, at)
                at = s.data + 4 + s.size


class _Blocks(InputPartition):
    def __init__(self, index: int, at: int, n: int):
        self.index, self.at, self.n = index, at, n


class BgenReader(DataSourceReader):
    def __init__(self, path: str, cells: int):
        self.path, self.head = path, header(path)
        if self.head.layout != 2:
            raise ValueError(f"{path} is of layout {self.head.layout}; 2 is read")
        self.step = max(1, cells // max(1, self.head.samples))

    def partitions(self):
        return [_Blocks(*x) for x in _ranges(self.path, self.head, self.step)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a file without variants
            return
        get, at, n = _Window(self.path), partition.at, self.head.samples
        for i in range(partition.index, partition.index + partition.n):
            s = _site(get, at)
            at = s.data + 4 + s.size
            dosage = alt_dosage(_unpacked(get(s.data + 4, s.size), self.head.compression), n) if len(s.alleles) == 2 else np.full(n, np.nan)
            same = lambda x, kind: pa.array([x], kind).take(pa.array(np.zeros(n, np.int32)))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [
                    same(i, pa.int64()), pa.array(np.arange(n)), same(s.chromosome, pa.string()), same(s.position, pa.int64()), same(s.variant_id, pa.string()), same(s.rsid, pa.string()),
                    same(s.alleles[0] if s.alleles else None, pa.string()), same(s.alleles[1] if len(s.alleles) > 1 else None, pa.string()), same(len(s.alleles), pa.int32()), pa.array(dosage, mask=np.isnan(dosage)),
                ],
                names=[c.split()[0] for c in CALLS.split(", ")],
            )


class BgenDataSource(DataSource):
    """``spark.read.format("bgen").load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "bgen"

    def schema(self) -> str:
        return CALLS

    def reader(self, schema) -> BgenReader:
        return BgenReader(self.options["path"], int(self.options.get("cells", 20_000_000)))


def read_bgen(spark: SparkSession, path: str) -> DataFrame:
    """A row a variant and sample: site, dosage of the second allele, and the hard call where one is within 0.1.

    Variants that do not have two alleles have no dosage; missing calls are null.
    """
    spark.dataSource.register(BgenDataSource)
    ids = spark.createDataFrame(list(enumerate(samples(spark, path))), "sample_idx long, sample string")
    from cohortix.operators.annotate import sized

    near = F.round("dosage")
    rows = spark.read.format("bgen").load(path).join(sized(ids), "sample_idx")
    return rows.withColumns({"chromosome": strip_chr("raw_chromosome"), "alt_count": F.when(F.abs(F.col("dosage") - near) <= HARD_CALL, near).cast("int")})


_CALLED = "variant_id string, rsid string, raw_chromosome string, position long, a1 string, a2 string, sample string, dosage double"


def _bgen_ranges(cells: int):
    def ranges(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for path in b.column(0).to_pylist():
                h = header(path)
                if h.layout != 2:
                    raise ValueError(f"{path} is of layout {h.layout}; 2 is read")
                own = [(path, at, n) for _, at, n in _ranges(path, h, max(1, cells // max(1, h.samples)))]
                cols = list(zip(*own, strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["file", "at", "n"])

    return ranges


def _called(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
    names, own = [c.split()[0] for c in _CALLED.split(", ")], None
    for b in it:
        for path, at, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if own != path:
                own, head, ids, get = path, header(path), pa.array(samples(None, path), pa.string()), _Window(path)
            sites, at_sample, dosages, held = [], [], [], 0
            for left in range(n - 1, -1, -1):
                s = _site(get, at)
                at = s.data + 4 + s.size
                if len(s.alleles) == 2:
                    x = alt_dosage(_unpacked(get(s.data + 4, s.size), head.compression), head.samples)
                    i = np.flatnonzero(~np.isnan(x))
                    sites.append((s.variant_id, s.rsid, s.chromosome, s.position, *s.alleles))
                    at_sample.append(i)
                    dosages.append(x[i])
                    held += len(i)
                if sites and (held >= 50_000 or len(sites) >= 50_000 or not left):
                    v = pa.array(np.repeat(np.arange(len(sites)), [len(x) for x in at_sample]))
                    cols = [pa.array(c, k).take(v) for c, k in zip(zip(*sites, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([*cols, ids.take(pa.array(np.concatenate(at_sample))), pa.array(np.concatenate(dosages))], names=names)
                    sites, at_sample, dosages, held = [], [], [], 0


def read_called(spark: SparkSession, paths: list[str], cells: int = 20_000_000) -> DataFrame:
    """The dosages of biallelic variants of BGEN files that are not missing, with sample and hard call (``alt_count``).

    Each file has samples of its own; a task reads about ``cells`` calls.
    """
    of = spark.createDataFrame([(p,) for p in paths], "file string").repartition(max(1, min(len(paths), 1_000)), "file")
    ranges = of.mapInArrow(_bgen_ranges(cells), "file string, at long, n long").collect()  # a row a range
    df = spark.createDataFrame(ranges, "file string, at long, n long").repartition(max(1, min(len(ranges), 4_000)), "file", "at")
    near = F.round("dosage")
    return df.mapInArrow(_called, _CALLED).withColumns({"chromosome": strip_chr("raw_chromosome"), "alt_count": F.when(F.abs(F.col("dosage") - near) <= HARD_CALL, near).cast("int")})


def _text(x: str, k: str) -> bytes:
    return struct.pack(k, len(x.encode())) + x.encode()


def write_batches(calls: DataFrame, sites: DataFrame, people: DataFrame, folder: str, batch: int = 256) -> list[str]:
    """BGEN files of ``genotype.batches`` of samples, each with the variants called in it, 8 bits a probability; returns their paths.

    ``calls``: variant, sample and the probabilities p1 and p2 of one and two copies; ``sites``: variant, name,
    variant_id, chromosome, position, ref, alt; ``people``: sample, IID.
    """
    from cohortix.operators.cutpoint import cut

    from .genotype import batches

    fixed = ("name", "variant_id", "chromosome", "position", "ref", "alt")
    who_of, rows = batches(calls.select("variant", "sample", "p1", "p2"), sites.select("variant", *fixed), people.select("sample", "IID"), batch)

    def one(who: pa.Table, t: pa.Table) -> pa.Table:
        import uuid

        who, t = who.sort_by("s"), t.sort_by([("chromosome", "ascending"), ("position", "ascending"), ("variant", "ascending")])
        part, ids = (who if len(who) else t).column("part")[0].as_py(), who.column("IID").to_pylist()
        v = t.column("variant").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
        called = t.column("s").is_valid().to_numpy()
        s, p1, p2 = (t.column(c).to_numpy() for c in ("s", "p1", "p2"))
        block = b"".join(_text(x, "<H") for x in ids)
        block = struct.pack("<II", 8 + len(block), len(ids)) + block
        head = struct.pack("<III", 20, len(first), len(ids)) + b"bgen" + struct.pack("<I", 1 | 2 << 2 | 1 << 31)
        out = [struct.pack("<I", len(head) + len(block)), head, block]
        of = t.take(pa.array(first))
        for lo, hi, name, rsid, chrom, position, *alleles in zip(first, np.append(first[1:], len(v)), *(of.column(c).to_pylist() for c in fixed), strict=True):
            ok = called[lo:hi]
            at, x1, x2 = s[lo:hi][ok].astype(np.int64), p1[lo:hi][ok], p2[lo:hi][ok]
            ploidy, p = np.full(len(ids), 2 | 128, np.uint8), np.zeros((len(ids), 2), np.uint8)
            ploidy[at] = 2
            p[at, 0], p[at, 1] = np.rint((1 - x1 - x2) * 255), np.rint(x1 * 255)
            data = struct.pack("<IHBB", len(ids), 2, 2, 2) + ploidy.tobytes() + bytes([0, 8]) + p.tobytes()
            stored = struct.pack("<I", len(data)) + zlib.compress(data, 1)
            out += [_text(name, "<H"), _text(rsid, "<H"), _text(chrom, "<H"), struct.pack("<IH", position, 2), *(_text(a, "<I") for a in alleles), struct.pack("<I", len(stored)), stored]
        path = f"{folder}/batch-{part:06}-{uuid.uuid4().hex[:8]}.bgen"
        files.write(path, b"".join(out))
        return pa.table({"path": pa.array([path])})

    named = who_of.groupBy("part").cogroup(rows.groupBy("part")).applyInArrow(one, "path string")
    kept = sorted(r["path"] for r in cut(named).collect())  # a row a file
    files.keep_named(folder, [p.removesuffix(".bgen") for p in kept])
    return kept


def write_bgen(path: str, ids: list[str], variants: list[tuple], bits: int = 8, compression: int = 1) -> None:
    """Fixture writer: variants of (variant_id, rsid, chromosome, position, alleles, probabilities).

    Probabilities: for each sample a tuple of those of 0, 1, ... copies of the second allele, or None where missing.
    """
    block = b"".join(struct.pack("<H", len(x.encode())) + x.encode() for x in ids)
    block = struct.pack("<II", 8 + len(block), len(ids)) + block
    head = struct.pack("<III", 20, len(variants), len(ids)) + b"bgen" + struct.pack("<I", compression | 2 << 2 | 1 << 31)
    out = [struct.pack("<I", len(head) + len(block)), head, block]
    for vid, rsid, chrom, position, alleles, probabilities in variants:
        ploidy = [2 if p is None else len(p) - 1 for p in probabilities]
        flat = [v for p, z in zip(probabilities, ploidy, strict=True) for v in ([0.0] * z if p is None else p[:-1])]
        whole = np.rint(np.array(flat) * (2**bits - 1)).astype(np.uint64)
        packed = np.packbits((whole[:, None] >> np.arange(bits, dtype=np.uint64) & 1).astype(np.uint8).ravel(), bitorder="little").tobytes()
        data = struct.pack("<IHBB", len(ids), len(alleles), min(ploidy, default=2), max(ploidy, default=2)) + bytes(z | 128 * (p is None) for p, z in zip(probabilities, ploidy, strict=True)) + bytes([0, bits]) + packed
        if compression == 1:
            stored = struct.pack("<I", len(data)) + zlib.compress(data)
        elif compression == 2:
            import zstandard

            stored = struct.pack("<I", len(data)) + zstandard.compress(data)
        else:
            stored = data
        out += [_text(vid, "<H"), _text(rsid, "<H"), _text(chrom, "<H"), struct.pack("<IH", position, len(alleles)), *(_text(a, "<I") for a in alleles), struct.pack("<I", len(stored)), stored]
    files.write(path, b"".join(out))
