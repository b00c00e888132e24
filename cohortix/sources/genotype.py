"""Genotype sources: PLINK text and binary files and VCF, at any address that ``files`` knows.

The ``.bed`` reader is a Python data source: a partition is a range of variants, read by offset, so a
file of any size is decoded by all executors. Missing calls are null. The writer makes a fileset a
range of variants, so that all executors write. BGEN is in ``bgen``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cohortix.functions.alleles import gt_alt_count, strip_chr
from cohortix.functions.text import info_value

from . import files

#: A1 copies by two-bit code 0-3; code 1 is a missing call (fixed values of the format).
A1_COPIES = (2, -1, 1, 0)
MAGIC = b"\x6c\x1b\x01"
#: A byte of four missing calls.
NONE_CALLED = 0b01010101
_MEMBERS = (".pvar.zst", ".pgen", ".pvar", ".psam", ".bed", ".bim", ".fam")


def genotype_format(path: str) -> str | None:
    """vcf, bcf or bgen by suffix; pgen or bed by the files that go with the prefix."""
    name = path.lower()
    if name.endswith((".vcf", ".vcf.gz", ".vcf.bgz")):
        return "vcf"
    for kind in ("bcf", "bgen"):
        if name.endswith("." + kind):
            return kind
    prefix = file_prefix(path)
    return next((k for k in ("pgen", "bed") if files.exists(f"{prefix}.{k}")), None)


def file_prefix(path: str) -> str:
    return next((path[: -len(m)] for m in _MEMBERS if path.endswith(m)), path)


def fileset(path: str) -> dict[str, list[str]]:
    """Members that are there and companions that are missing."""
    kind, prefix = genotype_format(path), file_prefix(path)
    if kind is None:
        raise ValueError(f"{path}: no genotype format found")
    want = {"bed": ["bed", "bim", "fam"], "pgen": ["pgen", "pvar", "psam"]}.get(kind)
    if want is None:
        return {"format": [kind], "members": [path], "missing": [], "index": [p for p in (path + ".tbi", path + ".csi", path + ".bgi") if files.exists(p)]}
    have = {w: next((p for p in (f"{prefix}.{w}", f"{prefix}.{w}.zst") if files.exists(p)), None) for w in want}
    return {"format": [kind], "members": [p for p in have.values() if p], "missing": [w for w, p in have.items() if not p], "index": []}


# ---- text members -----------------------------------------------------------------------------


def _rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    w = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    return spark.read.text(path).where(F.col("value").rlike(r"\S")).select(F.col("value"), w.alias("w"), F.monotonically_increasing_id().alias("_ord"))


def read_fam(spark: SparkSession, path: str) -> DataFrame:
    """FID, IID, sex and phenotype in file order; ``sample_idx`` is the row's place in the ``.bed``."""
    f = lambda i: F.get("w", F.lit(i))
    rows = _rows(spark, path).select("_ord", f(0).alias("FID"), f(1).alias("IID"), f(2).alias("PAT"), f(3).alias("MAT"), f(4).alias("SEX"), f(5).alias("PHENO"))
    return _indexed(rows, "sample_idx")


def read_bim(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Sites in file order: chromosome, variant_id, position, a1, a2, ref (A2), alt (A1)."""
    f = lambda i: F.get("w", F.lit(i))
    rows = _rows(spark, path).select(
        "_ord", f(0).alias("raw_chromosome"), strip_chr(f(0)).alias("chromosome"), f(1).alias("variant_id"), f(3).cast("bigint").alias("position"),
        F.upper(f(4)).alias("a1"), F.upper(f(5)).alias("a2"), F.upper(f(5)).alias("ref"), F.upper(f(4)).alias("alt"),
    )
    out = _indexed(rows, "variant_idx")
    return out.where(F.col("variant_idx") < limit) if limit is not None else out


def _indexed(df: DataFrame, name: str) -> DataFrame:
    from cohortix.operators.dedup import numbered

    return numbered(df, ["_ord"], name).drop("_ord")


def read_psam(spark: SparkSession, path: str) -> DataFrame:
    """``.psam`` with or without a header; columns by their names, FID null where there is none."""
    rows = _rows(spark, path).where(~F.col("value").startswith("##"))
    head = rows.where(F.col("value").startswith("#")).limit(1).collect()
    names = [n.lstrip("#") for n in head[0]["w"]] if head else ["FID", "IID", "PAT", "MAT", "SEX", "PHENO"]
    at = {n: F.get("w", F.lit(i)) for i, n in enumerate(names)}
    null = F.lit(None).cast("string")
    body = rows.where(~F.col("value").startswith("#"))
    return _indexed(body.select("_ord", *[at.get(c, null).alias(c) for c in ("FID", "IID", "SEX")]), "sample_idx")


def read_pvar(spark: SparkSession, path: str) -> DataFrame:
    rows = _rows(spark, path).where(~F.col("value").startswith("#"))
    f = lambda i: F.get("w", F.lit(i))
    return _indexed(rows.select("_ord", strip_chr(f(0)).alias("chromosome"), f(1).cast("bigint").alias("position"), f(2).alias("variant_id"), F.upper(f(3)).alias("ref"), F.upper(f(4)).alias("alt")), "variant_idx")


# ---- .bed -------------------------------------------------------------------------------------


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class BedReader(DataSourceReader):
    def __init__(self, path: str, samples: int, variants: int, cells: int):
        self.path, self.samples, self.variants = path, samples, variants
        self.step = max(1, cells // max(1, samples))
        self.width = -(-samples // 4)

    def partitions(self):
        if files.Ranges()(self.path, 0, 3) != MAGIC:
            raise ValueError(f"{self.path} is not a SNP-major .bed file")
        if files.size(self.path) != 3 + self.width * self.variants:
            raise ValueError(f"{self.path} does not hold {self.variants} variants of {self.samples} samples")
        return [_Range(lo, min(lo + self.step, self.variants)) for lo in range(0, self.variants, self.step)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        raw = np.frombuffer(files.Ranges()(self.path, 3 + partition.lo * self.width, (partition.hi - partition.lo) * self.width), np.uint8)
        codes = (raw.reshape(-1, self.width, 1) >> np.array([0, 2, 4, 6], np.uint8)) & 3
        copies = np.array(A1_COPIES, np.int8)[codes.reshape(len(codes), -1)[:, : self.samples]]
        many = max(1, 100_000 // max(1, self.samples))
        for lo in range(0, len(copies), many):
            own = copies[lo : lo + many]
            at = np.arange(partition.lo + lo, partition.lo + lo + len(own))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(at, self.samples)), pa.array(np.tile(np.arange(self.samples), len(own))), pa.array(own.ravel().astype(np.int32), mask=own.ravel() < 0)],
                names=["variant_idx", "sample_idx", "a1_count"],
            )


class BedDataSource(DataSource):
    """``spark.read.format("bed").option("samples", n).option("variants", m).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "bed"

    def schema(self) -> str:
        return "variant_idx bigint, sample_idx bigint, a1_count int"

    def reader(self, schema) -> BedReader:
        o = self.options
        return BedReader(o["path"], int(o["samples"]), int(o["variants"]), int(o.get("cells", 20_000_000)))


def read_bed(spark: SparkSession, prefix: str) -> DataFrame:
    """Calls (variant_idx, sample_idx, a1_count) with the sites' and samples' columns joined on."""
    from cohortix.operators.annotate import sized

    spark.dataSource.register(BedDataSource)
    fam, bim = read_fam(spark, f"{prefix}.fam"), read_bim(spark, f"{prefix}.bim")
    calls = spark.read.format("bed").option("samples", fam.count()).option("variants", bim.count()).load(f"{prefix}.bed")
    return calls.join(sized(fam), "sample_idx").join(sized(bim), "variant_idx")


def prefixes(folder: str) -> list[str]:
    """Filesets of a folder, in order."""
    return [p.removesuffix(".bed") for p in files.files_of(folder) if p.endswith(".bed")]


def packed(copies: np.ndarray) -> bytes:
    """variants x samples A1 copies (-1 missing) as the bytes of a SNP-major file."""
    code = np.array([3, 2, 0, 1], np.uint8)[copies]  # -1 is the last entry
    pad = (-code.shape[1]) % 4
    a, b, c, d = (np.pad(code, ((0, 0), (0, pad)))[:, k::4] for k in range(4))
    return MAGIC + (a | b << 2 | c << 4 | d << 6).tobytes()


def write_bed(path: str, copies: np.ndarray) -> None:
    files.write(path, packed(copies))


def write_filesets(calls: DataFrame, sites: DataFrame, samples: DataFrame, folder: str, cells: int = 20_000_000) -> list[str]:
    """Write filesets .bed, .bim and .fam of ranges of sites into a new folder; returns their prefixes.

    ``calls``: variant, sample, a1_count; ``sites``: variant, chromosome, position, variant_id, a1, a2; ``samples``:
    sample, FID, IID, SEX. Sites are in the order of chromosome, position and variant, samples in that of their ids; a
    call that is not there is missing. A task writes a fileset of about ``cells`` calls by its own name, and the names
    of those tasks that ended well are kept: other files are removed.
    """
    from cohortix.operators.cutpoint import cut
    from cohortix.operators.dedup import numbered

    if files.exists(folder) and files.files_of(folder):
        raise ValueError(f"{folder} is not empty")
    own = cut(numbered(samples.select("sample", "FID", "IID", "SEX"), ["sample"], "_s"))
    n = own.count()
    fam = "".join(f"{r.FID or 0} {r.IID} 0 0 {r.SEX or 0} -9\n" for r in own.orderBy("_s").toLocalIterator())
    step = max(1, cells // max(1, n))
    at = cut(numbered(sites, ["chromosome", "position", "variant"], "_v").withColumn("_part", F.floor(F.col("_v") / step).cast("int")))
    got = calls.where("a1_count is not null").select("variant", "sample", "a1_count").join(own.select("sample", "_s"), "sample").join(at.select("variant", "_v", "_part"), "variant").select(F.col("_part").alias("part"), F.col("_v").alias("v"), F.col("_s").alias("s"), F.col("a1_count").cast("int").alias("n"))

    def one(places: pa.Table, called: pa.Table) -> pa.Table:
        import uuid

        places, part = places.sort_by("_v"), places.column("_part")[0].as_py()
        copies = np.full((len(places), n), -1, np.int8)
        copies[called.column("v").to_numpy() % step, called.column("s").to_numpy()] = called.column("n").to_numpy()
        prefix = f"{folder}/part-{part:05}-{uuid.uuid4().hex[:8]}"
        bim = zip(*(places.column(c).to_pylist() for c in ("chromosome", "variant_id", "position", "a1", "a2")), strict=True)
        files.write(f"{prefix}.bim", "".join(f"{c}\t{i}\t0\t{p}\t{a}\t{b}\n" for c, i, p, a, b in bim).encode())
        files.write(f"{prefix}.fam", fam.encode())
        files.write(f"{prefix}.bed", packed(copies))
        return pa.table({"part": pa.array([part], pa.int32()), "prefix": pa.array([prefix])})

    named = at.groupBy("_part").cogroup(got.groupBy("part")).applyInArrow(one, "part int, prefix string")
    return files.keep_named(folder, [r["prefix"] for r in cut(named).orderBy("part").collect()])  # a row a fileset


def batches(calls: DataFrame, sites: DataFrame, samples: DataFrame, batch: int) -> tuple[DataFrame, DataFrame]:
    """The rows of filesets of ``batch`` samples, by ``part``: people in the order of their ids, and calls with their sites.

    A batch has the sites that are called in it, so that what is written grows with the calls and not with samples times
    sites. Each site is also in one batch by its hash, with a null ``s`` where no call makes it be there.
    """
    from cohortix.operators.cutpoint import cut
    from cohortix.operators.dedup import numbered

    own = cut(numbered(samples, ["sample"], "_s"))
    n = max(1, -(-own.count() // batch))
    part, s = F.floor(F.col("_s") / batch).cast("int").alias("part"), (F.col("_s") % batch).cast("int").alias("s")
    rest = [F.col(c) for c in calls.columns if c not in ("variant", "sample")]
    called = calls.join(own.select("sample", part, s), "sample").select("part", "variant", "s", *rest).join(sites, "variant")
    home = sites.select(F.pmod(F.xxhash64("variant"), F.lit(n)).cast("int").alias("part"), F.lit(None).cast("int").alias("s"), "*")
    return own.select(part, s, *[c for c in samples.columns if c != "sample"]), called.unionByName(home, allowMissingColumns=True)


def write_batches(calls: DataFrame, sites: DataFrame, samples: DataFrame, folder: str, batch: int = 512) -> list[str]:
    """``write_filesets`` by ``batches`` of samples: a task writes a fileset of one batch and the sites called in it."""
    from cohortix.operators.cutpoint import cut

    if files.exists(folder) and files.files_of(folder):
        raise ValueError(f"{folder} is not empty")
    people, rows = batches(calls.where("a1_count is not null").select("variant", "sample", F.col("a1_count").cast("int").alias("n")), sites.select("variant", "chromosome", "position", "variant_id", "a1", "a2"), samples.select("sample", "FID", "IID", "SEX"), batch)

    def one(who: pa.Table, t: pa.Table) -> pa.Table:
        import uuid

        who, t = who.sort_by("s"), t.sort_by([("chromosome", "ascending"), ("position", "ascending"), ("variant", "ascending")])
        part, v = (who if len(who) else t).column("part")[0].as_py(), t.column("variant").to_numpy()
        first = np.concatenate([[True], v[1:] != v[:-1]]) if len(v) else np.zeros(0, bool)
        copies = np.full((int(first.sum()), len(who)), -1, np.int8)
        called = t.column("s").is_valid().to_numpy()
        copies[(np.cumsum(first) - 1)[called], t.column("s").drop_null().to_numpy()] = t.column("n").drop_null().to_numpy()
        prefix = f"{folder}/batch-{part:06}-{uuid.uuid4().hex[:8]}"
        bim = zip(*(t.column(c).filter(pa.array(first)).to_pylist() for c in ("chromosome", "variant_id", "position", "a1", "a2")), strict=True)
        fam = zip(*(who.column(c).to_pylist() for c in ("FID", "IID", "SEX")), strict=True)
        files.write(f"{prefix}.bim", "".join(f"{c}\t{i}\t0\t{p}\t{a}\t{b}\n" for c, i, p, a, b in bim).encode())
        files.write(f"{prefix}.fam", "".join(f"{f or 0} {i} 0 0 {x or 0} -9\n" for f, i, x in fam).encode())
        files.write(f"{prefix}.bed", packed(copies))
        return pa.table({"part": pa.array([part], pa.int32()), "prefix": pa.array([prefix])})

    named = people.groupBy("part").cogroup(rows.groupBy("part")).applyInArrow(one, "part int, prefix string")
    return files.keep_named(folder, [r["prefix"] for r in cut(named).orderBy("part").collect()])  # a row a fileset


_SITE = "raw_chromosome string, variant_id string, position long, a1 string, a2 string"


def read_bims(spark: SparkSession, prefixes: list[str]) -> DataFrame:
    """The sites of filesets as they are written, in no order."""
    f = lambda i: F.get("w", F.lit(i))
    return _rows(spark, [f"{p}.bim" for p in prefixes]).select(f(0).alias("raw_chromosome"), f(1).alias("variant_id"), f(3).cast("bigint").alias("position"), F.upper(f(4)).alias("a1"), F.upper(f(5)).alias("a2"))


def _bed_ranges(cells: int):
    """Ranges of variants of each fileset and the bytes of their lines in the .bim, by one pass over it."""

    def ranges(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = files.Ranges()
        for b in it:
            for prefix in b.column(0).to_pylist():
                n = sum(1 for x in _lines(read, f"{prefix}.fam") if x.strip())
                step, rows, at, v = max(1, cells // max(1, n)), [], 0, 0
                for line in _lines(read, f"{prefix}.bim"):
                    if line.strip():
                        if v % step == 0:
                            rows.append((prefix, v, at))
                        v += 1
                    at += len(line)
                if read(f"{prefix}.bed", 0, 3) != MAGIC:
                    raise ValueError(f"{prefix}.bed is not a SNP-major .bed file")
                if files.size(f"{prefix}.bed") != 3 + -(-n // 4) * v:
                    raise ValueError(f"{prefix}.bed does not hold {v} variants of {n} samples")
                ends = [x[2] for x in rows[1:]] + [at]
                cols = list(zip(*((*x, min(step, v - x[1]), e - x[2]) for x, e in zip(rows, ends, strict=True)), strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), *[pa.int64()] * 4), strict=True)], names=["fileset", "lo", "at", "n", "size"])

    return ranges


def _lines(read: files.Ranges, path: str, ahead: int = 4 << 20) -> Iterator[bytes]:
    at, end, held = 0, files.size(path), b""
    while at < end:
        held += read(path, at, ahead)
        at += ahead
        *whole, held = held.splitlines(keepends=True) if at < end else [*held.splitlines(keepends=True), b""]
        yield from whole


def _bed_calls(called: bool):
    def calls(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read, own, iid, male = files.Ranges(), None, None, None
        for b in it:
            for prefix, lo, at, n, size in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if own != prefix:
                    fam = [x.split() for x in _lines(read, f"{prefix}.fam") if x.strip()]
                    own, iid, male = prefix, pa.array([x[1].decode() for x in fam], pa.string()), pa.array([len(x) > 4 and x[4] == b"1" for x in fam], pa.bool_())
                bim = [x.decode().split() for x in read(f"{prefix}.bim", at, size).splitlines() if x.strip()]
                sites = [pa.array([x[0] for x in bim]), pa.array([x[1] for x in bim]), pa.array([int(x[3]) for x in bim], pa.int64()), pa.array([x[4].upper() for x in bim]), pa.array([x[5].upper() for x in bim])]
                width = -(-len(iid) // 4)
                many = max(1, 1_000_000 // max(1, len(iid)))
                for k in range(0, n, many):
                    raw = np.frombuffer(read(f"{prefix}.bed", 3 + (lo + k) * width, min(many, n - k) * width), np.uint8)
                    byte = np.flatnonzero(raw != NONE_CALLED) if called else np.arange(len(raw))
                    x = np.array(A1_COPIES, np.int32)[raw[byte, None] >> np.array([0, 2, 4, 6], np.uint8) & 3]
                    s = byte[:, None] % width * 4 + np.arange(4)
                    some = (s < len(iid)) & (x >= 0 if called else True)
                    v, s, x = pa.array(np.broadcast_to(byte[:, None] // width, s.shape)[some] + k), pa.array(s[some]), x[some]
                    yield pa.RecordBatch.from_arrays([iid.take(s), male.take(s), *[c.take(v) for c in sites], pa.array(x, mask=x < 0)], names=["native_sample_id", "male", *[c.split()[0] for c in _SITE.split(", ")], "a1_count"])

    return calls


def read_filesets(spark: SparkSession, prefixes: list[str], called: bool = False, cells: int = 20_000_000) -> DataFrame:
    """Calls of filesets with their samples and sites, without a join; only those that are not missing where ``called``.

    A task reads about ``cells`` calls by offset, with the lines of the .bim that go with them.
    """
    of = spark.createDataFrame([(p,) for p in prefixes], "fileset string").repartition(min(len(prefixes), 1_000), "fileset")
    ranges = of.mapInArrow(_bed_ranges(cells), "fileset string, lo long, at long, n long, size long").collect()  # a row a range
    df = spark.createDataFrame(ranges, "fileset string, lo long, at long, n long, size long").repartition(max(1, min(len(ranges), 4_000)), "fileset", "lo")
    return df.mapInArrow(_bed_calls(called), f"native_sample_id string, male boolean, {_SITE}, a1_count int")


# ---- VCF --------------------------------------------------------------------------------------


def vcf_header(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(F.col("value").startswith("##"))


def vcf_columns(spark: SparkSession, path: str) -> list[str]:
    line = spark.read.text(path).where(F.col("value").startswith("#CHROM")).limit(1).collect()
    return line[0][0].lstrip("#").split("\t") if line else []


def _vcf_samples(spark: SparkSession, path: str) -> DataFrame:
    """(file, names): the samples of each file that has a header line; a row a file."""
    from cohortix.operators.cutpoint import cut

    f = F.split("value", "\t")
    return cut(spark.read.text(path).where(F.col("value").startswith("#CHROM")).select(F.col("_metadata.file_path").alias("file"), F.slice(f, 10, F.greatest(F.size(f) - 9, F.lit(0))).alias("names")))


def read_vcf_sites(spark: SparkSession, path: str) -> DataFrame:
    """CHROM POS ID REF ALT of every record; the genotype columns are not split."""
    f = F.split("value", "\t", 6)
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(f.alias("f"))
    g = lambda i: F.get("f", F.lit(i))
    return rows.select(strip_chr(g(0)).alias("chromosome"), g(1).cast("bigint").alias("position"), g(2).alias("variant_id"), F.upper(g(3)).alias("ref"), F.upper(g(4)).alias("alt"))


def read_vcf_records(spark: SparkSession, path: str) -> DataFrame:
    """chromosome, position, variant_id, ref, alt and info_r2 of every record that ``read_vcf_calls`` reads."""
    return _records(spark, path).where(~_skipped()).select(*_VCF_SITE, _r2().alias("info_r2"))


def read_vcf_calls(spark: SparkSession, path: str, called: bool = False) -> DataFrame:
    """A row per record and sample: GT, ALT count, dosage (DS, unrounded) and imputation R2.

    Records with several ALT alleles, ``*`` or ``.`` are skipped (``vcf_skipped`` counts them). Files of a folder have
    samples of their own where each has a header, else those of the one header. ``called``: only calls that say
    anything; the others are dropped before they are taken apart.
    """
    heads = _vcf_samples(spark, path)
    n = heads.count()
    rows = _records(spark, path).where(~_skipped()).withColumn("r2", _r2())
    long = rows.select("file", *_VCF_SITE, "r2", F.split("format", ":").alias("fmt"), F.posexplode(F.split("calls", "\t")).alias("i", "call"))
    if called:
        long = long.where((F.col("call") != ".") & ~F.col("call").rlike("^[.:/|]*$"))
    part = lambda key: F.get(F.split("call", ":"), (F.array_position("fmt", key) - 1).cast("int"))
    field = lambda key: F.when(F.array_position("fmt", key) > 0, part(key))
    if n > 1:
        long = long.join(F.broadcast(heads), "file")  # a row a file
    elif n:
        long = long.crossJoin(F.broadcast(heads.select("names")))  # one row
    else:
        long = long.withColumn("names", F.array().cast("array<string>"))
    return long.select(
        F.get("names", F.col("i")).alias("sample"), *_VCF_SITE, F.regexp_replace(field("GT"), r"\|", "/").alias("GT"),
        gt_alt_count(field("GT")).alias("alt_count"), field("DS").try_cast("double").alias("dosage"), F.col("r2").alias("info_r2"),
    )


_VCF_SITE = ("chromosome", "position", "variant_id", "ref", "alt")


def _r2():
    return F.coalesce(*[F.nullif(info_value("info", k), F.lit("")).try_cast("double") for k in ("R2", "DR2", "INFO", "IMPINFO")])


def _records(spark: SparkSession, path: str) -> DataFrame:
    f = F.split("value", "\t", 10)
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(f.alias("f"), F.col("_metadata.file_path").alias("file"))
    g = lambda i: F.get("f", F.lit(i))
    return rows.select(
        "file", strip_chr(g(0)).alias("chromosome"), g(1).cast("bigint").alias("position"), g(2).alias("variant_id"), F.upper(g(3)).alias("ref"), F.upper(g(4)).alias("alt"),
        g(7).alias("info"), g(8).alias("format"), g(9).alias("calls"),
    )


def _skipped():
    return F.col("alt").contains(",") | F.col("alt").isin("*", ".")


def vcf_skipped(spark: SparkSession, path: str) -> DataFrame:
    """Sites with several ALT alleles or none; one that several files of a folder have counts once."""
    sites = _records(spark, path).where(_skipped()).select(*_VCF_SITE).distinct()
    return sites.agg(F.count_if(F.col("alt").contains(",")).alias("multiallelic"), F.count_if(F.col("alt").isin("*", ".")).alias("no_alt"))


def write_vcf_batches(calls: DataFrame, sites: DataFrame, samples: DataFrame, folder: str, batch: int = 128) -> None:
    """Compressed VCFs of ``batches`` of samples, each with the records called in it; ``.`` where there is no call.

    ``calls``: variant, sample, call; ``sites``: variant and the first nine columns by their names; ``samples``: sample, IID.
    """
    from cohortix.operators.cutpoint import cut

    columns = ("CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT")
    people, rows = batches(calls.select("variant", "sample", "call"), sites.select("variant", *columns), samples.select("sample", "IID"), batch)

    def one(who: pa.Table, t: pa.Table) -> pa.Table:
        import gzip
        import uuid

        who, t = who.sort_by("s"), t.sort_by([("CHROM", "ascending"), ("POS", "ascending"), ("variant", "ascending")])
        part, names = (who if len(who) else t).column("part")[0].as_py(), who.column("IID").to_pylist()
        lines, last, cells = ["##fileformat=VCFv4.2", "\t".join(["#" + columns[0], *columns[1:], *names])], None, []
        fixed = zip(*(t.column(c).to_pylist() for c in columns), strict=True)
        for v, site, s, call in zip(t.column("variant").to_pylist(), fixed, t.column("s").to_pylist(), t.column("call").to_pylist(), strict=True):
            if v != last:
                if last is not None:
                    lines.append("\t".join(cells))
                last, cells = v, [*map(str, site), *["."] * len(names)]
            if s is not None:
                cells[len(columns) + s] = call
        if last is not None:
            lines.append("\t".join(cells))
        name = f"{folder}/batch-{part:06}-{uuid.uuid4().hex[:8]}.vcf"
        files.write(f"{name}.gz", gzip.compress("".join(x + "\n" for x in lines).encode(), 1))
        return pa.table({"name": pa.array([name])})

    named = people.groupBy("part").cogroup(rows.groupBy("part")).applyInArrow(one, "name string")
    files.keep_named(folder, [r["name"] for r in cut(named).collect()])  # a row a file
