"""Operators on small hand-made inputs: what SQL over the driver's tables cannot show."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.functions import alleles as al
from cohortix.functions import consequences as cq
from cohortix.functions.text import info_value, is_missing, to_number, to_whole
from cohortix.operators import annotate, builds, coding, dedup, genotype, gwas, infer, quality, registry, score, stats


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_numbers_and_missing_tokens(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("1e3",), ("1d",), ("nan",), ("NA",), ("",), (None,), ("12.7",), ("x",)], "t string")
    got = [tuple(r) for r in df.select(to_number("t"), to_whole("t"), is_missing("t")).collect()]
    assert got == [(1.5, None, False), (1000.0, 1000, False), (None, None, False), (None, None, True), (None, None, True), (None, None, True), (None, None, True), (12.7, None, False), (None, None, False)]


@pytest.mark.parametrize(
    ("a1", "a2", "ref", "status"),
    [
        ("A", "G", "G", "match"), ("A", "G", "A", "swapped"), ("A", "G", "C", "strand_flipped"), ("A", "G", "T", "strand_flipped_swapped"), ("A", "T", "G", "mismatch"),
        ("0", "G", "G", "monomorphic"), ("A", "G", None, "unverified"), ("<DEL>", "G", "G", "non_nucleotide"), ("A", "AT", "ATG", "match"), ("AT", "A", "CAT", "mismatch"),
    ],
)
def test_orientation(spark, a1, a2, ref, status):
    lit = lambda v: F.lit(v).cast("string")
    assert one(spark, al.orientation(lit(a1), lit(a2), lit(ref))["status"])[0] == status


def test_chromosome_tables_differ(spark):
    lit = F.lit("chrXY")
    assert tuple(one(spark, al.chromosome(lit), al.chromosome(lit, al.BUILD_ALIASES), al.chain_name(F.lit("26")), al.chromosome(F.lit("M")))) == ("X", "XY", "chrM", "MT")


def test_most_severe_and_pathogenic(spark):
    r = one(spark, cq.most_severe(F.lit("intron_variant&stop_gained,missense_variant")), cq.most_severe(F.lit("zzz&yyy")), cq.most_severe(F.lit(None).cast("string")), cq.pathogenic(F.lit("Likely_pathogenic")), cq.pathogenic(F.lit("Conflicting_Pathogenic")), cq.pathogenic(F.lit(None).cast("string")))
    assert tuple(r) == ("stop_gained", "zzz", None, True, False, False)


def test_info_key_is_whole(spark):
    assert one(spark, info_value(F.lit("XAF=9;AF=1"), "AF"), info_value(F.lit("XAF=9"), "AF")) == ("1", "")


def test_keep_first_and_numbering_ignore_partitioning(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("_ord"), (F.col("id") * 3).alias("v"))
    want = sorted(map(tuple, dedup.keep_first(df, ["k"]).collect()))
    assert want == sorted(map(tuple, dedup.keep_first(df.repartition(13), ["k"]).collect())) == [(i, i, 3 * i) for i in range(7)]
    rows = dedup.numbered(df.repartition(9), ["_ord"]).collect()
    assert all(r["row"] == r["_ord"] for r in rows)


def test_binary_coding_rules(spark):
    plink = spark.createDataFrame([("1",), ("2",), ("-9",)], "v string")
    c = coding.code_binary(plink, "v")
    assert [r[0] for r in plink.select(c.code).collect()] == [0.0, 1.0, None]
    plain = spark.createDataFrame([("1",), ("0",), ("7",)], "v string")
    c = coding.code_binary(plain, "v")
    assert [tuple(r) for r in plain.select(c.code, c.invalid).collect()] == [(1.0, False), (0.0, False), (None, True)]


def test_hwe_against_sums_of_probabilities():
    def brute(h1, het, h2):
        n, rare = h1 + het + h2, 2 * min(h1, h2) + het
        p = {}
        for k in range(rare % 2, rare + 1, 2):
            r, c = (rare - k) // 2, n - k - (rare - k) // 2
            p[k] = math.exp(math.lgamma(n + 1) - math.lgamma(r + 1) - math.lgamma(k + 1) - math.lgamma(c + 1) + k * math.log(2))
        return sum(v for v in p.values() if v <= p[het] * (1 + 1e-9)) / sum(p.values())

    for g in [(10, 5, 2), (0, 20, 0), (57, 14, 50), (3, 0, 0), (1, 1, 1)]:
        assert stats._hwe(*g) == pytest.approx(brute(*g), rel=1e-9)
    assert math.isnan(stats._hwe(0, 0, 0))


def test_ld_pruning_drops_a_copy(spark):
    rng = np.random.default_rng(2)
    g = rng.integers(0, 3, (3, 40))
    g[1] = g[0]
    rows = [("1", 100 + v, f"v{v}", f"s{i:02d}", int(g[v, i])) for v in range(3) for i in range(40)]
    got = {r["variant"]: r["keep"] for r in stats.ld_prune(spark.createDataFrame(rows, "chromosome string, position long, variant string, sample string, alt_count int")).collect()}
    assert got == {"v0": True, "v1": False, "v2": True}


def test_lift_statuses(spark):
    blocks = spark.createDataFrame([("1", 0, 100, "1", 50, 0, False, 0), ("1", 200, 300, "2", 0, 0, False, 1), ("1", 300, 400, "1", 10, 1000, True, 2)], "chromosome string, start bigint, end bigint, target_chromosome string, target_start bigint, target_size bigint, reverse boolean, rank int")
    sites = spark.createDataFrame([(1, "1", 1), (2, "1", 100), (3, "1", 101), (4, "1", 250), (5, "1", 301), (6, "1", 0), (7, "9", 5)], "site_id int, chromosome string, position bigint")
    got = {r["site_id"]: (r["status"], r["lifted_position"]) for r in builds.lift(sites, blocks).collect()}
    assert got == {1: ("mapped", 51), 2: ("mapped", 150), 3: ("unmapped", None), 4: ("chromosome_changed", 50), 5: ("reverse_strand", 990), 6: ("unplaced", None), 7: ("unmapped", None)}


def test_build_decisions():
    assert builds.decide_build([("GRCh37", 0.9)]) == ("GRCh37", 1.0)
    assert builds.decide_build([("GRCh37", 0.6)])[0] == "unknown"
    assert builds.decide_build([("GRCh38", 1.0)], "GRCh37")[0] == "unknown"
    assert builds.decide_build([], "GRCh38") == ("GRCh38", 1.0)


def test_bases_across_chunks(spark):
    ref = spark.createDataFrame([("1", 0, "ACGT"), ("1", 1, "TTGG")], "chromosome string, chunk_no bigint, seq string")
    sites = spark.createDataFrame([(1, "1", 4), (2, "1", 8), (3, "1", 99)], "site int, chromosome string, position bigint")
    assert {r["site"]: r["bases"] for r in builds.bases_at(sites, ref, 4, F.lit(2)).collect()} == {1: "TT", 2: "G", 3: None}


def test_weighted_sum_counts_missing_as_nothing(spark):
    calls = spark.createDataFrame([("s", "v1", 1.0), ("s", "v2", None), ("t", "v1", 0.0), ("t", "v2", 2.0)], "sample string, variant string, dosage double")
    m = spark.createDataFrame([("v1", "m", "f", 0.5, True), ("v2", "m", "f", 1.0, False)], "geno_variant_id string, model_id string, feature_id string, weight double, counts_alt boolean")
    assert {r["sample"]: r["score"] for r in score.weighted_sum(calls, m).collect()} == {"s": 0.5, "t": 0.0}
    carriers, called = calls.where("dosage > 0"), calls.where("dosage is not null").select("sample", "variant")
    assert {r["sample"]: r["score"] for r in score.weighted_sum_of_carriers(carriers, called, m).collect()} == {"s": 0.5, "t": 0.0}


def test_score_builds_must_agree():
    score.check_builds("GRCh37", "GRCh37")
    for pair in ((None, "GRCh37"), ("GRCh37", "GRCh38"), ("unknown", "unknown")):
        with pytest.raises(ValueError):
            score.check_builds(*pair)


def test_dosage_only_carriers_count_from_a_half(spark):
    c = spark.createDataFrame([("p", "k", None, 0.5), ("p", "k", None, 0.4), ("p", "k", 0, 0.0), ("p", "k", 1, 1.0)], "participant_id string, variant_key string, hardcall_alt_count int, dosage double")
    ann = annotate.annotation_table(c.select("variant_key"))
    assert annotate.carried(c, ann).count() == 2


def test_genotype_from_calls(spark):
    rows = [("1", "1", 1, True, False), ("X", "23", 1, True, True), ("X", "XY", 1, True, True), ("Y", "Y", 2, True, True), ("1", "1", None, True, False), ("1", "1", 2, False, False)]
    df = spark.createDataFrame(rows, "chromosome string, raw_chromosome string, a1_count int, a1_is_alt boolean, male boolean")
    got = [(r["ploidy"], r["alt_count"], r["GT"]) for r in genotype.call_columns(df).collect()]
    assert got == [(2, 1, "0/1"), (1, None, "."), (2, 1, "0/1"), (1, 1, "1"), (2, None, "./."), (2, 0, "0/0")]


def test_inference_rules(spark):
    assert infer.id_column(["FID", "#IID"]) == "#IID" and infer.id_column(["x"]) is None
    assert infer.gwas_columns(["CHR", "BP", "SNP", "A1", "A2", "N", "SE", "P", "OR", "INFO"])["chrom"] == "CHR"
    assert infer.gwas_missing(["snpid", "ea", "nea", "OR", "se"]) == ["p-value"]
    df = spark.createDataFrame([("1", "M", "3.5", "yes"), ("2", "F", "4.5", "no"), ("3", "M", None, "yes")], "iid string, sex string, pc1 string, outcome string")
    assert infer.infer_covariates(df) == {"sex": ("sex", True), "pc1": ("pc", False), "outcome": ("other", True)}
    assert infer.infer_phenotypes(df)["outcome"] == ("binary", "yes", "no")
    assert infer.default_name("height", "trait", True) == "trait"


def test_gwas_rules(spark):
    raw = spark.createDataFrame([("rs1", "chr1", "10", "a", "g", "0.1", "1.1"), ("rs1", "1", "10", "A", "G", "0.01", "1.2"), ("rs2", "1", "0", "A", "G", "0.1", "1"), ("rs3", "1", "5", "A", "A", "0.1", "1"), ("rs4", "1", "5", "I", "D", "0.1", "1")], "SNP string, CHR string, BP string, A1 string, A2 string, P string, OR string")
    got = gwas.checked(gwas.standard(raw)).collect()
    assert [(r["snpid"], r["p"]) for r in got] == [("rs1", 0.01)]
    assert gwas.accession_folder("GCST90000123") == "GCST90000001-GCST90001000"
    with pytest.raises(ValueError):
        gwas.standard(raw.drop("P"))


def test_validation_collects_all_problems(spark):
    rows = [("a", "1"), ("a", "2"), (None, "2"), ("b", "x"), ("c", "NA")]
    got = {r["check"]: (r["status"], r["count"]) for r in quality.validate_phenotype(spark.createDataFrame(rows, "iid string, v string"), "iid", "v", "binary", case=["2"], control=["1"]).collect()}
    assert got["missing_ids"] == ("FAIL", 1) and got["duplicate_ids"] == ("FAIL", 1) and got["invalid_values"] == ("FAIL", 1) and got["missing_values"] == ("INFO", 1)
    assert quality.validate_phenotype(spark.createDataFrame(rows, "iid string, v string"), "iid", "v", "nosuch").where("status = 'FAIL'").count() == 1


def test_lineage_ends_on_cycles(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "child string, parent string")
    got = {(r["ancestor"], r["depth"]) for r in registry.lineage(e, spark.createDataFrame([("a",)], "id string")).collect()}
    assert got == {("b", 1), ("c", 1)}


def test_supersede_keeps_rows(spark):
    a = spark.createDataFrame([("1", "s", "k", "current")], "artifact_id string, source_id string, kind string, status string")
    n = spark.createDataFrame([("2", "s", "k", "current")], a.schema)
    assert sorted((r["artifact_id"], r["status"]) for r in registry.supersede(a, n, ["source_id", "kind"]).collect()) == [("1", "superseded"), ("2", "current")]


def test_ld_pruning_by_blocks_of_samples_equals_one_matrix(spark):
    import numpy as np

    r = np.random.default_rng(5)
    n, m, window, step, r2 = 70, 60, 12, 5, 0.2
    g = r.binomial(2, 0.3, (m, n)).astype(float)
    for i in range(3, m):  # many variants follow one shortly before
        if r.random() < 0.5:
            g[i] = np.where(r.random(n) < 0.8, g[i - r.integers(1, 4)], g[i])
    g[20] = 1
    g[r.random((m, n)) < 0.05] = np.nan
    rows = [("1", i, f"v{i:02}", f"s{j}", int(g[i, j])) for i in range(m) for j in range(n) if g[i, j] == g[i, j]]
    calls = spark.createDataFrame(rows, "chromosome string, position long, variant string, sample string, alt_count int")
    mean = np.nanmean(g, axis=1)
    f = np.minimum(mean / 2, 1 - mean / 2)
    z = np.where(np.isnan(g), 0, g - mean[:, None])
    norm = np.sqrt((z * z).sum(1))
    keep = norm > 0
    for lo in range(0, m, step):
        idx = np.flatnonzero(keep[lo : lo + window]) + lo
        for a, i in enumerate(idx):
            for j in idx[a + 1 :]:
                if keep[i] and keep[j] and (z[i] @ z[j] / norm[i] / norm[j]) ** 2 > r2:
                    keep[i if f[i] < f[j] else j] = False
    assert 10 < keep.sum() < 50
    for block in (16, 4096):
        got = {x["position"]: x["keep"] for x in stats.ld_prune(calls, window, step, r2, sample_block=block).collect()}
        assert got == dict(enumerate(keep.tolist()))


def test_column_facts_rank_before_they_collect(spark):
    df = spark.createDataFrame([(f"{i:03}", None) for i in range(300)], "a string, b string")
    facts = infer.column_facts(df, ["a", "b"])
    assert "WindowGroupLimit" in facts._jdf.queryExecution().toString()
    got = {x["column"]: (x["n"], x["n_levels"], x["levels"]) for x in facts.collect()}
    assert got == {"a": (300, 300, [f"{i:03}" for i in range(infer.MOST_CODES + 1)]), "b": (0, 0, [])}


def test_lineage_goes_on_to_the_end(spark):
    e = spark.createDataFrame([(f"a{i}", f"a{i + 1}") for i in range(24)] + [("a24", "a0")], "child string, parent string")
    start = spark.createDataFrame([("a0",)], "id string")
    got = {r["ancestor"]: r["depth"] for r in registry.lineage(e, start).collect()}
    assert got == {f"a{i}": i for i in range(1, 25)}


def test_upsert_keeps_the_last_of_new_rows(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, t int")
    new = spark.createDataFrame([(2, "c", 2), (2, "d", 1), (3, "e", 1), (3, "e", 1)], "k int, v string, t int")
    assert sorted(map(tuple, dedup.upsert(old, new, ["k"], ["t"]).collect())) == [(1, "a", 0), (2, "c", 2), (3, "e", 1)]
    assert sorted(map(tuple, dedup.upsert(old, new, ["k"]).collect())) == [(1, "a", 0), (2, "d", 1), (3, "e", 1)]
    src = spark.createDataFrame([("s", 1), ("s", 2)], "source_id string, x int")
    assert dedup.refresh_source(src.limit(0), src).count() == 2


def test_availability_names_follow_the_source(spark):
    df = spark.createDataFrame([("s1", "expression", "observed"), ("s2", "expression", "predicted"), ("s3", "genotype", "observed"), ("s4", "methylation", None)], "s string, m string, o string")
    got = [r[0] for r in df.select(registry.availability_name(F.col("s"), F.col("m"), F.col("o"))).collect()]
    assert got == ["s1_OBSERVED", "s2", "s3", "s4"]
    art = spark.createDataFrame([(1, "m", "o", "t", "current"), (2, "m", "o", "t", "SUPERSEDED"), (3, "m", "o", "t", "qc_fail"), (4, "m", "o", "u", "registered")], "artifact_id int, modality string, origin string, tissue string, status string")
    assays = spark.createDataFrame([(1, "s", "p"), (2, "s", "q"), (3, "s", "r"), (4, "s", "x"), (4, "s", None)], "artifact_id int, source_id string, participant_id string")
    assert [tuple(r) for r in registry.availability_groups(assays, art).collect()] == [("s", "m", "o", "u", 4, 2)]


def test_phenotype_types_and_roles(spark):
    cols = {"one_two": "1 2 2 1", "zero_one": "0 1.0 1 0", "words": "Case control case control", "text": "b a b a", "three": "x y z x", "codes": "1 2 3 3", "sex": "m x m f", "pc1": "a b c d", "age": "41 50 62 33"}
    rows = list(zip(*(v.split() for v in cols.values()), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    got = infer.infer_phenotypes(df, columns=list(cols))
    assert got["one_two"] == ("binary", "2", "1") and got["text"] == ("binary", "b", "a") and got["three"][0] == got["codes"][0] == "multiclass"
    assert infer.infer_covariates(df)["sex"] == ("other", True) and infer.infer_covariates(df)["pc1"] == ("other", True) and infer.infer_covariates(df)["age"] == ("age", False)
    two = spark.createDataFrame([("Case", "0"), ("control", "1.0")], "words string, zero_one string")
    assert infer.infer_phenotypes(two, columns=["words", "zero_one"]) == {"words": ("binary", "Case", "control"), "zero_one": ("binary", "1.0", "0")}
    many = spark.createDataFrame([(str(i), str(i)) for i in range(12)] + [("1", None)], "n string, m string")
    assert infer.infer_phenotypes(many, columns=["n"])["n"] == ("continuous", None, None)


def test_examples_are_the_smallest(spark):
    df = spark.createDataFrame([(i % 50, f"v{i % 50:02}") for i in range(500)], "k int, v string").repartition(7)
    got = quality.contract(df, isin={"v": ["v03"]}, at_least={"k": 5}).collect()
    assert {r["check"]: (r["count"], r["examples"]) for r in got} == {"isin:v": (490, ["v00", "v01", "v02", "v04", "v05"]), "at_least:k": (50, ["0", "1", "2", "3", "4"])}


def test_projection_needs_enough_shared_variants(spark):
    calls = spark.createDataFrame([(1, 10, 1), (1, 11, 2)], "sample int, variant int, alt_count int")
    loadings = spark.createDataFrame([(10, 1, 0.5), (11, 1, 0.25), (12, 1, 1.0)], "variant int, pc int, loading double")
    assert stats.shared_loadings(calls, loadings, 2).count() == 2
    with pytest.raises(ValueError, match="share 2 variants"):
        stats.shared_loadings(calls, loadings, 3)


def test_cohort_variants_by_mark_or_by_metrics(spark):
    marked = spark.createDataFrame([(1, True), (2, False), (3, None)], "variant int, included boolean")
    assert [r[0] for r in annotate.cohort_variants(marked).collect()] == [1]
    with pytest.raises(ValueError, match="included"):
        annotate.cohort_variants(marked.drop("included"))


def test_keyed_sites_keep_the_first_of_equal_keys(spark):
    s = spark.createDataFrame([("chr1", 5, "a", "g", 2), ("1", 5, "A", "G", 1), ("1", 5, "A", "T", 3)], "chromosome string, position bigint, ref string, alt string, _ord int")
    assert sorted((r["variant_key"], r["_ord"]) for r in score.keyed_sites(s).collect()) == [("1:5:A:G", 1), ("1:5:A:T", 3)]


def test_levels_are_ranked_however_many(spark):
    df = spark.createDataFrame([(f"l{i:04}",) for i in range(1500)] + [("NA",), (None,), ("l0003",)], "v string")
    got = coding.with_level_code(df, "v").collect()
    assert {r["v"]: r["code"] for r in got} == {f"l{i:04}": float(i) for i in range(1500)} | {"NA": None, None: None} and len(got) == 1503
    with pytest.raises(ValueError, match="with_level_code"):
        coding.code_levels(df, "v")


def test_numbers_in_text_are_matched_once(spark):
    from cohortix.functions import text

    said = [" 1.5\t", "\x0b-2e3\f\n", "1d", "NaN", "", " ", "5\u2028", "5 \u0085", "1 2", ".5", "7.", "+4", None]
    df = spark.createDataFrame([(x,) for x in said], "x string").select("x", text.to_number("x").alias("n"), F.when(text.as_text("x").rlike(text.NUMBER), text.as_text("x").try_cast("double")).alias("want"))
    assert [r.n for r in df.collect()] == [r.want for r in df.collect()] == [1.5, -2000.0, *[None] * 7, 0.5, 7.0, 4.0, None]
    assert "regexp_replace" not in df.select("n")._jdf.queryExecution().optimizedPlan().toString()
