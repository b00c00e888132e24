"""Carriers from files, FASTA, chains and BGEN on small files with known contents."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.operators import builds, carriers
from cohortix.sources import bgen, chain, fasta, files
from cohortix.sources import genotype as g


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def make_fasta(spark, tmp_path, contigs, name="ref.fa"):
    text = ""
    for c, at in contigs.items():
        seq = ["C"] * 260
        for p, b in at.items():
            seq[p - 1] = b
        text += f">{c} made up\n" + "\n".join("".join(seq)[i : i + 60] for i in range(0, 260, 60)) + "\n"
    return fasta.fasta_index(spark, put(tmp_path / name, text))


def make_bed(tmp_path, samples, variants, counts, sex=None):
    g.write_bed(str(tmp_path / "g.bed"), np.array(counts))
    put(tmp_path / "g.fam", "".join(f"{s} {s} 0 0 {(sex or [0] * len(samples))[i]} -9\n" for i, s in enumerate(samples)))
    put(tmp_path / "g.bim", "".join(f"{c}\t{v}\t0\t{p}\t{a}\t{b}\n" for c, v, p, a, b in variants))
    return str(tmp_path / "g")


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ---- carriers of .bed filesets ----------------------------------------------------------------


def test_alt_counts_in_both_orientations(spark, tmp_path):
    i = make_fasta(spark, tmp_path, {"chr1": {100: "A", 200: "A"}})
    p = make_bed(tmp_path, ["P1", "P2", "P3"], [("1", "v1", 100, "G", "A"), ("1", "v2", 200, "A", "G")], [[0, 1, 2], [2, 1, 0]])
    got, sites = carriers.bed_carriers(spark, p, index=i, carrier_only=False)
    for key in ("1:100:A:G", "1:200:A:G"):
        assert rows(got.where(F.col("variant_key") == key), "participant_id", "hardcall_alt_count", "GT") == [("P1", 0, "0/0"), ("P2", 1, "0/1"), ("P3", 2, "1/1")]
    assert rows(sites, "variant_key", "a1", "a2", "ref_check") == [("1:100:A:G", "G", "A", "match"), ("1:200:A:G", "A", "G", "swapped")]


def test_only_carriers_with_all_their_columns(spark, tmp_path):
    i = make_fasta(spark, tmp_path, {"1": {100: "A"}})
    p = make_bed(tmp_path, ["P1", "P2", "P3"], [("1", "rs1", 100, "G", "A")], [[0, 1, 2]])
    alias = spark.createDataFrame([("P2", "two"), ("P2", "two")], "native_id string, participant_id string")
    got, sites = carriers.bed_carriers(spark, p, alias, i, genome_build="GRCh38", source_id="S")
    assert got.columns == list(carriers.COLUMNS)
    assert rows(got, "participant_id", "native_sample_id", "hardcall_alt_count", "dosage", "heterozygous", "homozygous_alt", "rsid") == [("two", "P2", 1, 1.0, True, False, "rs1"), (None, "P3", 2, 2.0, False, True, "rs1")]
    assert rows(sites, "n_called", "n_carriers", "n_hom_alt", "alt_allele_count") == [(3, 2, 1, 3)]


def test_mismatches_missing_calls_and_places_outside(spark, tmp_path):
    i = make_fasta(spark, tmp_path, {"1": {100: "A", 150: "T"}})
    p = make_bed(tmp_path, ["P1", "P2"], [("1", "v1", 100, "G", "A"), ("1", "v2", 150, "G", "C"), ("9", "v3", 5, "G", "A"), ("1", "v4", 999, "G", "A")], [[-1, 2], [2, 2], [1, 1], [1, 1]])
    got, sites = carriers.bed_carriers(spark, p, index=i, carrier_only=False)
    assert rows(got, "variant_key", "participant_id", "GT", "hardcall_alt_count") == [("1:100:A:G", "P1", "./.", None), ("1:100:A:G", "P2", "1/1", 2)]
    assert rows(sites, "variant_id", "ref_check", "included") == [("v1", "match", True), ("v2", "mismatch", False), ("v3", "mismatch", False), ("v4", "mismatch", False)]
    assert {r["ref_check"] for r in carriers.bed_carriers(spark, p)[1].collect()} == {"unverified"}


def test_haploid_calls(spark, tmp_path):
    i = make_fasta(spark, tmp_path, {"X": {100: "A"}, "MT": {50: "A"}})
    p = make_bed(tmp_path, ["M1", "F1"], [("23", "x1", 100, "G", "A"), ("26", "m1", 50, "G", "A"), ("23", "x2", 101, "G", "C")], [[2, 1], [2, 0], [1, 0]], sex=[1, 2])
    got, _ = carriers.bed_carriers(spark, p, index=i)
    assert rows(got, "variant_key", "participant_id", "hardcall_alt_count", "ploidy", "GT") == [("MT:50:A:G", "M1", 1, 1, "1"), ("X:100:A:G", "F1", 1, 2, "0/1"), ("X:100:A:G", "M1", 1, 1, "1")]


def test_filesets_by_ranges_come_back(spark, tmp_path):
    rng = np.random.default_rng(5)
    counts = rng.integers(-1, 3, (23, 9))
    calls = spark.createDataFrame([(v, s, int(counts[v, s])) for v in range(23) for s in range(9) if counts[v, s] >= 0], "variant long, sample long, a1_count int")
    sites = spark.createDataFrame([(v, str(1 + v % 2), 1000 - v, f"v{v}", "A", "G") for v in range(23)], "variant long, chromosome string, position long, variant_id string, a1 string, a2 string")
    samples = spark.createDataFrame([(s, None, f"P{s}", s % 3) for s in range(9)], "sample long, FID string, IID string, SEX int")
    made = g.write_filesets(calls, sites, samples, f"{tmp_path}/out", cells=45)
    assert len(made) == 5 and g.prefixes(f"{tmp_path}/out") == made
    got = {(r["variant_id"], r["IID"]): r["a1_count"] for p in made for r in g.read_bed(spark, p).collect()}
    assert got == {(f"v{v}", f"P{s}"): None if counts[v, s] < 0 else counts[v, s] for v in range(23) for s in range(9)}
    with pytest.raises(ValueError, match="not empty"):
        g.write_filesets(calls, sites, samples, f"{tmp_path}/out")


def test_vcf_dosages_and_reference_check(spark, tmp_path):
    i = make_fasta(spark, tmp_path, {"1": {100: "A"}})
    v = put(tmp_path / "d.vcf", "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tP1\tx_P2\tP3\n1\t100\trs1\tA\tG\t.\t.\tR2=0.91\tGT:DS\t0/0:0.02\t0/1:0.93\t1/1:1.97\n1\t120\trs2\tT\tG\t.\t.\t.\tGT:DS\t0/1:1\t0/0:0\t0/0:0\n1\t130\t.\tC\tA,T\t.\t.\t.\tGT\t0/1\t0/0\t0/0\n1\t140\t.\tC\t.\t.\t.\t.\tGT\t0/0\t0/0\t0/0\n")
    alias = spark.createDataFrame([("P1", "one"), ("P2", "two"), ("P3", "three")], "native_id string, participant_id string")
    got, sites = carriers.vcf_carriers(spark, v, alias, i)
    assert rows(got, "participant_id", "hardcall_alt_count", "dosage", "info_r2") == [("one", 0, 0.02, 0.91), ("three", 2, 1.97, 0.91), ("two", 1, 0.93, 0.91)]
    assert rows(sites, "variant_key", "n_called", "n_carriers", "n_hom_alt", "alt_allele_count") == [("1:100:A:G", 3, 2, 1, 3)]
    assert {r["check"]: r["n"] for r in carriers.ref_checks(spark, v, sites).collect()} == {"match": 1, "multiallelic_excluded": 1, "monomorphic": 1}


# ---- FASTA ------------------------------------------------------------------------------------


@pytest.mark.parametrize("scan,size", [(64 << 20, 4 << 20), (37, 16)])
@pytest.mark.parametrize("newline,last", [("\n", "\n"), ("\n", ""), ("\r\n", "\r\n\r\n")])
def test_bases_equal_a_plain_reading(spark, tmp_path, scan, size, newline, last):
    """Contigs of full and short last lines, one on a single line, with and without a line end at the end."""
    rng = np.random.default_rng(1)
    seqs = {f"chr{c}": "".join(rng.choice(list("ACGTacgtN"), n)) for c, n in (("1", 200), ("2", 120), ("3", 7), ("X", 333))}
    text = newline.join(f">{c} x" + newline + newline.join(s[i : i + 40] for i in range(0, len(s), 40)) for c, s in seqs.items()) + last
    index = fasta.fasta_index(spark, put(tmp_path / "a.fa", text), scan)
    assert {r["contig"]: r["length"] for r in index.collect()} == {c: len(s) for c, s in seqs.items()}
    where = [(c.removeprefix("chr"), p, n) for c, s in seqs.items() for p in (1, 2, 39, 40, 41, 80, len(s) - 1, len(s), len(s) + 1, 0) for n in (1, 3, 90)] + [("23", 5, 2), ("7", 1, 1), ("1", None, 1)]
    got = fasta.bases_of(spark.createDataFrame(where, "chromosome string, position long, n int"), index, "n", size)
    want = [(c, p, n, (seqs["chrX" if c == "23" else f"chr{c}"][p - 1 : p - 1 + n].upper() if p and p > 0 and c != "7" else "")) for c, p, n in where]
    assert rows(got, "chromosome", "position", "n", "bases") == sorted(want, key=str)


def test_fai_and_folders(spark, tmp_path):
    put(tmp_path / "c1.fa", ">1\nACGT\nAC\n")
    put(tmp_path / "c2.fa", ">2\nTTTT")
    put(tmp_path / "c1.fa.fai", "1\t6\t3\t4\t5\n")
    (tmp_path / "c1.fa.fai").rename(tmp_path / "keep.fai")
    index = fasta.fasta_index(spark, str(tmp_path))
    assert rows(index.where("contig <> ''"), "contig", "length", "offset", "line_bases", "line_width")[:2] == [("1", 6, 3, 4, 5), ("2", 4, 3, 4, 5)]
    (tmp_path / "keep.fai").rename(tmp_path / "c1.fa.fai")
    assert rows(fasta.read_fai(spark, str(tmp_path / "c1.fa")), "contig", "length", "offset", "line_bases", "line_width") == [("1", 6, 3, 4, 5)]


# ---- chains -----------------------------------------------------------------------------------


def test_chain_lift(spark, tmp_path):
    c = put(tmp_path / "t.chain", "# made up\nchain 1000 chr1 1000 + 0 300 chr1 1000 + 10 310 1\n100 50 50\n150\n\nchain 500 chr2 1000 + 0 100 chr3 1000 - 0 100 2\n100\n\nchain 9 chr1 1000 + 0 130 chr1 1000 + 500 630 3\n130\n\nchain 7 chrM 100 + 0 50 chrM 100 - 0 50 4\n50\n")
    blocks = chain.read_chain(spark, c)
    sites = spark.createDataFrame([("a", "1", 1), ("b", "chr1", 160), ("c", "1", 140), ("d", "2", 5), ("e", "5", 5), ("f", "1", 0), ("g", "1", 120), ("h", "MT", 1)], "site_id string, raw string, position long")
    got = builds.lift(sites.withColumn("chromosome", chain.site_chromosome("raw")), blocks)
    assert rows(got, "site_id", "status", "lifted_chromosome", "lifted_position") == [
        ("a", "mapped", "1", 11), ("b", "mapped", "1", 170), ("c", "unmapped", None, None), ("d", "chromosome_changed", "3", 996), ("e", "unmapped", None, None), ("f", "unplaced", None, None), ("g", "mapped", "1", 620), ("h", "reverse_strand", "MT", 100),
    ]
    with pytest.raises(ValueError, match="fill"):
        chain.parse_chain("chain 1 a 9 + 0 5 b 9 + 0 5 1\n4\n")


@pytest.mark.parametrize("flip", [False, True])
def test_lifted_base_evidence(spark, tmp_path, flip):
    """38 is 37 moved by 30 places; sites of one of them support it, and not when the other build does not agree."""
    rng = np.random.default_rng(2)
    seq = "".join(rng.choice(list("ACGT"), 900))
    old = fasta.fasta_index(spark, put(tmp_path / "old.fa", f">chr1\n{seq}\n"))
    new = fasta.fasta_index(spark, put(tmp_path / "new.fa", ">chr1\n" + "N" * 30 + seq + "\n"))
    wrong = fasta.fasta_index(spark, put(tmp_path / "wrong.fa", ">chr1\n" + "A" * 930 + "\n"))
    to_new = chain.read_chain(spark, put(tmp_path / "up.chain", "chain 5 chr1 900 + 0 900 chr1 930 + 30 930 1\n900\n"))
    to_old = chain.read_chain(spark, put(tmp_path / "down.chain", "chain 5 chr1 930 + 30 930 chr1 900 + 0 900 1\n900\n"))
    sites = [(p, "chr1", p + (30 if flip else 0), seq[p - 1], "A" if seq[p - 1] != "A" else "C") for p in range(1, 860, 9)] + [(0, "X", 5, "A", "C"), (-1, "1", 6, "AT", "A"), (-2, "1", None, "A", "C")]
    s = spark.createDataFrame(sites, "site_id long, chromosome string, position long, ref string, alt string")
    r = builds.lifted_base_evidence(s, old, new, to_new, to_old).first()
    assert (r["supports"], r["weight"], r["lifted_rate"]) == ("GRCh38" if flip else "GRCh37", 1.0, 1.0) and r["tested"] >= 90
    if not flip:
        assert builds.lifted_base_evidence(s, old, wrong, to_new, to_old).first()["supports"] is None
        assert builds.lifted_base_evidence(s.limit(10), old, new, to_new, to_old).collect() == []


# ---- BGEN -------------------------------------------------------------------------------------

PROBS = [[(1.0, 0.0, 0.0), (0.0, 1.0, 0.0), None, (0.2, 0.2, 0.6)], [(0.0, 1.0), (0.6, 0.4), (0.0, 0.0, 1.0), (0.4, 0.0, 0.2, 0.4)]]


@pytest.mark.parametrize("bits", [8, 16, 11, 32])
@pytest.mark.parametrize("compression", [0, 1, 2])
def test_bgen_dosages(spark, tmp_path, bits, compression):
    p = str(tmp_path / "a.bgen")
    variants = [("v0", "rs0", "chr1", 100, ["A", "G"], PROBS[0]), ("v1", "rs1", "X", 200, ["A", "GT"], PROBS[1]), ("v2", "rs2", "2", 5, ["A", "C", "G"], PROBS[0])]
    bgen.write_bgen(p, ["a", "b", "c", "d"], variants, bits, compression)
    want = {("v0", "a"): 0, ("v0", "b"): 1, ("v0", "c"): None, ("v0", "d"): 1.4, ("v1", "a"): 1, ("v1", "b"): 0.4, ("v1", "c"): 2, ("v1", "d"): 1.6}
    want |= {("v2", s): None for s in "abcd"}
    df = bgen.read_bgen(spark, p)
    assert {(r["variant_id"], r["sample"]): r["dosage"] for r in df.collect()} == {k: v if v is None else pytest.approx(v, abs=1.5 / (2**bits - 1)) for k, v in want.items()}
    assert {r["sample"]: r["alt_count"] for r in df.where("variant_id = 'v0'").collect()} == {"a": 0, "b": 1, "c": None, "d": None}
    assert bgen.variant_count(p) == 3
    reader = bgen.BgenReader(p, 4)
    assert [(x.index, x.n) for x in reader.partitions()] == [(0, 1), (1, 1), (2, 1)] and sum(len(b) for x in reader.partitions() for b in reader.read(x)) == 12


def test_bgen_phased_and_samples(spark, tmp_path):
    data = (2).to_bytes(4, "little") + (2).to_bytes(2, "little") + bytes([1, 2, 2, 1, 1, 8]) + bytes([255, 0, 51])
    assert bgen.alt_dosage(data, 2) == pytest.approx([1.0, 0.8])
    p = str(tmp_path / "b.bgen")
    bgen.write_bgen(p, ["a", "b"], [])
    assert bgen.samples(spark, p) == ["a", "b"] and bgen.read_bgen(spark, p).count() == 0
    raw = bytearray(files.Ranges()(p, 0, files.size(p)))
    raw[20:24] = (1 | 2 << 2).to_bytes(4, "little")
    files.write(p, bytes(raw))
    with pytest.raises(ValueError, match="no sample ids"):
        bgen.samples(spark, p)
    put(tmp_path / "b.sample", "ID_1 ID_2 missing\n0 0 0\nf1 i1 0\nf2 i2 0\n")
    assert bgen.samples(spark, p) == ["i1", "i2"]
