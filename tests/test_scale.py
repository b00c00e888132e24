"""Queries on tables whose keys or sizes lie beyond those of the test tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix import plans
from cohortix.operators import annotate, builds, carriers, registry, stats
from cohortix.sources import bgen
from cohortix.sources import genotype as g


def test_chain_reaches_the_last_site(spark, sf_dir, tmp_path):
    part = spark.read.parquet(f"{sf_dir}/part.parquet").limit(50)
    part.withColumn("p_partkey", part["p_partkey"] * 40_000).write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    con.sql(f"create view part as select * from '{tmp_path}/part.parquet/*.parquet'")
    want = con.sql(plans.oracle_sql()["chain_lift"]).fetchall()
    assert sorted(map(tuple, plans.queries()["chain_lift"](spark, str(tmp_path)).collect())) == sorted(want)


def cohort(spark, n):
    """``n`` samples with two calls each, and ``n`` sites; the last has no call."""
    samples = spark.range(n).select(F.col("id").alias("sample"), F.format_string("P%d", "id").alias("FID"), F.format_string("P%d", "id").alias("IID"), (F.col("id") % 2 + 1).cast("int").alias("SEX"))
    sites = spark.range(n).select(F.col("id").alias("variant"), F.lit("1").alias("chromosome"), (F.col("id") + 1).alias("position"), F.format_string("rs%d", "id").alias("variant_id"), F.lit("G").alias("a1"), F.lit("A").alias("a2"))
    calls = samples.select("sample", F.explode(F.array(F.col("sample"), (F.col("sample") * 7 + 1) % n)).alias("variant")).where(F.col("variant") < n - 1).distinct()
    return calls.withColumn("a1_count", (F.col("variant") % 3).cast("int")), sites, samples


def test_filesets_by_batches_grow_with_their_calls(spark, tmp_path):
    calls, sites, samples = cohort(spark, 400)
    made = g.write_batches(calls, sites, samples, f"{tmp_path}/out", 16)
    assert len(made) == 25 and sum((tmp_path / "out" / f"{p.rpartition('/')[2]}.bed").stat().st_size for p in made) < 400 * 400 // 4 // 4
    want = {(f"P{r.sample}", f"rs{r.variant}", r.a1_count) for r in calls.collect()}
    read = g.read_filesets(spark, made, called=True, cells=100).collect()
    assert len(read) == len(want) and {(r.native_sample_id, r.variant_id, r.a1_count) for r in read} == want
    got, table = carriers.bed_carriers(spark, f"{tmp_path}/out")
    assert {(r.native_sample_id, r.variant_id, r.hardcall_alt_count) for r in got.collect()} == {x for x in want if x[2]}
    n = {r.variant_id: r.n_called for r in table.collect()}
    assert len(n) == 400 and n["rs399"] == 0 and sum(n.values()) == len(want)


def test_vcfs_by_batches_have_samples_of_their_own(spark, tmp_path):
    calls, sites, samples = cohort(spark, 200)
    site = sites.select("variant", F.col("chromosome").alias("CHROM"), F.col("position").alias("POS"), F.col("variant_id").alias("ID"), F.lit("A").alias("REF"), F.when(F.col("variant") % 5 == 0, "G,T").otherwise("G").alias("ALT"), *[F.lit(".").alias(c) for c in ("QUAL", "FILTER", "INFO")], F.lit("GT").alias("FORMAT"))
    call = F.element_at(F.array(*map(F.lit, ("0/0", "0|1", "1/1"))), F.col("a1_count") + 1)
    g.write_vcf_batches(calls.select("variant", "sample", call.alias("call")), site, samples, f"{tmp_path}/out", 16)
    want = {(f"P{r.sample}", f"rs{r.variant}", r.a1_count) for r in calls.where("variant % 5 <> 0").collect()}
    read = g.read_vcf_calls(spark, f"{tmp_path}/out", called=True).collect()
    assert len(read) == len(want) and {(r["sample"], r.variant_id, r.alt_count) for r in read} == want
    got, table = carriers.vcf_carriers(spark, f"{tmp_path}/out")
    assert {(r.native_sample_id, r.variant_id, r.hardcall_alt_count) for r in got.collect()} == {x for x in want if x[2]}
    n = {r.variant_id: r.n_called for r in table.collect()}
    assert len(n) == 160 and n["rs199"] == 0 and sum(n.values()) == len(want)
    assert g.vcf_skipped(spark, f"{tmp_path}/out").first().multiallelic == 40


def test_bgens_by_batches(spark, tmp_path):
    calls, sites, samples = cohort(spark, 200)
    s = sites.select("variant", F.format_string("v%d", "variant").alias("name"), "variant_id", "chromosome", "position", F.lit("A").alias("ref"), F.lit("G").alias("alt"))
    p = [(F.col("a1_count") == k).cast("double").alias(f"p{k}") for k in (1, 2)]
    made = bgen.write_batches(calls.select("variant", "sample", *p), s, samples, f"{tmp_path}/out", 16)
    want = {(f"P{r.sample}", f"v{r.variant}", float(r.a1_count), r.a1_count) for r in calls.collect()}
    for cells in (20_000_000, 64):
        got = bgen.read_called(spark, made, cells).collect()
        assert len(got) == len(want) and {(r["sample"], r.variant_id, r.dosage, r.alt_count) for r in got} == want
    assert len(made) == 13 and {r.variant_id for p in made for r in bgen.read_bgen(spark, p).select("variant_id").distinct().collect()} == {f"v{v}" for v in range(200)}


def test_ld_sums_grow_with_calls_and_not_with_samples(spark):
    """400 samples in blocks of 8 by 12 variants: a window has few calls, so it has few sums and not one a sample block."""
    rows = [("1", 10 * v, v, (v * 37 + k * (k + v % 5)) % 400, (v + k) % 3) for v in range(60) for k in range(20)]
    calls = spark.createDataFrame(rows, "chromosome string, position long, variant long, sample long, alt_count long")
    made = {}
    for block in (8, 4096):
        sums = []
        with pytest.MonkeyPatch.context() as m:
            m.setattr(stats, "_ld_parts", lambda *x, real=stats._ld_parts: sums.append(real(*x)) or sums[0])
            made[block] = sorted(map(tuple, stats.ld_prune(calls, 12, 4, 0.2, sample_block=block).collect()))
        n = sums[0].count()
        assert n <= 15 * (4 if block == 8 else 1)
    assert made[8] == made[4096] and len(made[8]) == 60


def ancestors(edges, starts):
    """(start, ancestor, depth) by a search from each start."""
    parents, out = {}, set()
    for c, p in edges:
        parents.setdefault(c, set()).add(p)
    for s in starts:
        seen, front, depth = {s}, {s}, 0
        while front:
            depth += 1
            front = {p for c in front for p in parents.get(c, ())} - seen
            seen |= front
            out |= {(s, p, depth) for p in front}
    return out


@pytest.mark.parametrize("few", [3, 500_000])
def test_lineage_follows_only_what_can_be_reached(spark, few):
    """400 starts below 40, 10 and 5 ids, among them several parents, repeats, loops and a ring; 4,000 edges lead to starts only."""
    starts = [f"s{i}" for i in range(400)]
    edges = [(s, f"a{i % 40}") for i, s in enumerate(starts)] + [(s, f"a{(i * 7) % 40}") for i, s in enumerate(starts) if i % 9 == 0] + [("s0", "s0"), ("s5", "s6"), ("s1", "a1")]
    edges += [(f"a{i}", f"b{i % 10}") for i in range(40)] + [("a3", "a4"), ("a7", "s7"), ("a8", "b1"), ("a0", "a0")] + [(f"b{i}", f"c{i % 5}") for i in range(10)] + [(f"c{i}", f"c{(i + 1) % 5}") for i in range(5)]
    leaves = [(f"l{i}", f"s{i % 400}") for i in range(4_000)]
    e = spark.createDataFrame(edges + leaves + [(None, "a1"), ("s1", None)], "child string, parent string")
    rows = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(annotate, "BROADCAST_ROWS", few)
        m.setattr(registry, "cut", lambda df, real=registry.cut: rows.append((made := real(df)).count()) or made)
        got = sorted(map(tuple, registry.lineage(e, spark.createDataFrame([(s,) for s in [*starts, "s1", "x"]], "id string")).collect()))
    assert got == sorted(ancestors(edges, starts))
    assert sum(rows) < 1_500 < 4_000


@pytest.mark.parametrize("few", [3, 500_000])
def test_bases_of_equal_and_incomplete_sites(spark, few):
    """Equal sites keep their rows, a null elsewhere in a row does not lose its bases, and chunks may be missing."""
    ref = spark.createDataFrame([("1", 0, "ACGT"), ("1", 1, "ttgg"), ("1", 3, "CCCC"), ("2", 0, "GATT"), ("2", 1, "ACA")], "chromosome string, chunk_no bigint, seq string")
    rows = [("a", "1", 4, 2), ("a", "1", 4, 2), (None, "1", 4, 2), (None, "1", 2, 1), (None, "1", 2, 1), ("b", "1", 0, 2), ("b", "1", 6, 9), ("c", "2", 3, 5), ("d", "2", 3, 0), ("e", "1", None, 1), ("f", "1", 1, None), ("g", None, 1, 1), ("h", "1", 11, 3)]
    text = {"1": {0: "ACGT", 1: "TTGG", 3: "CCCC"}, "2": {0: "GATT", 1: "ACA"}}

    def want(c, p, n):
        if p is None or n is None:
            return None
        return "".join(text.get(c, {}).get(x // 4, "")[x % 4 : x % 4 + 1] for x in range(p - 1, p - 1 + n) if x >= 0) or None

    with pytest.MonkeyPatch.context() as m:
        m.setattr(annotate, "BROADCAST_ROWS", few)
        m.setattr(annotate.dealt, "__kwdefaults__", {"most": 2})
        got = builds.bases_at(spark.createDataFrame(rows, "site string, chromosome string, position bigint, n int"), ref, 4, "n").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(((*r, want(*r[1:])) for r in rows), key=key)


def broadcasts(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_bases_do_not_broadcast_a_generated_reference(spark):
    """22 times 30,000 chunks are taken for few bytes by Spark's estimate."""
    ref = spark.range(30_000).select(F.col("id").alias("chunk_no"), F.expr("repeat('ACGTTGCATC', 5)").alias("seq")).withColumn("chromosome", F.explode(F.array(*[F.lit(str(c)) for c in range(1, 23)])))
    sites = spark.range(100).select(F.format_string("%d", F.col("id") % 22 + 1).alias("chromosome"), (F.col("id") * 10 + 1).alias("position"))
    got = builds.bases_at(sites, ref, 50, F.lit(2))
    assert broadcasts(got) == 0 and {r.bases for r in got.select("bases").distinct().collect()} == {"AC"}


def test_lookup_does_not_broadcast_a_small_file_of_many_rows(spark, tmp_path):
    spark.range(2_000).select(F.lit("1").alias("chromosome"), "id", F.lit("a").alias("ref"), F.lit("C,G").alias("alt")).write.parquet(f"{tmp_path}/s")
    s = spark.read.parquet(f"{tmp_path}/s").withColumn("position", F.col("id") + 1).drop("id")
    v = s.withColumns({"alt": F.lit("G"), "variant_key": F.col("position").cast("string")})
    ref = s.withColumn("id", F.col("position"))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(annotate, "BROADCAST_ROWS", 1_000)
        m.setattr(annotate.dealt, "__kwdefaults__", {"most": 200})
        got = annotate.reference_lookup(v.unionByName(v), ref.unionByName(ref), ["id"])
        assert broadcasts(got) == 0 and {(r.variant_key, r.id) for r in got.collect()} == {(str(i), i) for i in range(1, 2_001)} and got.count() == 2_000
    few = annotate.reference_lookup(v, ref, ["id"])
    assert broadcasts(few) and few.count() == 2_000


def test_carriers_of_filesets_do_not_broadcast_calls(spark, tmp_path):
    """Calls that Python reads are taken for few bytes by Spark's estimate; with many sites they were broadcast whole."""
    calls, sites, samples = cohort(spark, 403)
    g.write_batches(calls, sites, samples, f"{tmp_path}/out", 18)
    want = sorted((f"P{r.sample}", f"rs{r.variant}", r.a1_count) for r in calls.collect())
    with pytest.MonkeyPatch.context() as m:
        m.setattr(annotate, "BROADCAST_ROWS", 100)
        got, table = carriers.bed_carriers(spark, f"{tmp_path}/out")
    rows = [(r.native_sample_id, r.variant_id, r.hardcall_alt_count) for r in got.collect()]
    assert broadcasts(got) == 0 and sorted(rows) == [x for x in want if x[2]]
    assert broadcasts(table) == 0 and {r.variant_id: (r.n_called, r.alt_allele_count) for r in table.collect()} == {f"rs{v}": (sum(w[1] == f"rs{v}" for w in want), sum(w[2] for w in want if w[1] == f"rs{v}")) for v in range(403)}


@pytest.mark.parametrize("n", [1, 5, 8])
def test_missing_calls_and_padding_of_a_bed_are_left_out(spark, tmp_path, n):
    copies = np.array([[-1] * n, [2] * n, [(i % 4) - 1 for i in range(n)]], np.int8)
    g.write_bed(f"{tmp_path}/x.bed", copies)
    (tmp_path / "x.fam").write_text("".join(f"F s{i} 0 0 1 -9\n" for i in range(n)))
    (tmp_path / "x.bim").write_text("".join(f"1\trs{v}\t0\t{v + 1}\tA\tC\n" for v in range(3)))
    every = [(f"s{i}", f"rs{v}", None if copies[v, i] < 0 else int(copies[v, i])) for v in range(3) for i in range(n)]
    for called in (True, False):
        got = [(r.native_sample_id, r.variant_id, r.a1_count) for r in g.read_filesets(spark, [f"{tmp_path}/x"], called).collect()]
        assert got == [x for x in every if x[2] is not None or not called]
