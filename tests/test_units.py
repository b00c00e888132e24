"""Standard tables, weights from files, builds, the catalogue and the choice of a genotype."""

from __future__ import annotations

import sqlite3

import pytest

from cohortix.operators import units


def test_standardize_adds_casts_and_normalizes(spark):
    df = spark.createDataFrame([("m", "chr1", "10", "a", None, "x", "kept?")], "model_id string, chromosome string, position string, effect_allele string, other_allele string, weight string, other string")
    out = units.standardize(df, tissue="liver")
    assert out.columns == [c.split()[0] for c in units.WEIGHTS.split(", ")]
    r = out.first()
    assert (r["chromosome"], r["position"], r["effect_allele"], r["other_allele"], r["weight"], r["tissue"], r["feature_id"]) == ("1", 10, "A", None, None, "liver", None)


def test_weights_from_both_kinds_of_files(spark, tmp_path):
    db = str(tmp_path / "m.db")
    with sqlite3.connect(db) as c:
        c.execute("create table weights (gene, rsid, varID, ref_allele, eff_allele, weight)")
        c.execute('create table extra (gene, genename, "pred.perf.R2")')
        c.execute("insert into weights values ('G', 'rs1', 'chr1_100_A_G', 'A', 'g', 0.5)")
        c.execute("insert into extra values ('G', 'name', 0.2)")
    w, f = units.load_weights(spark, db, "M", "GRCh38")
    assert (w.first()["genome_build"], w.first()["effect_allele"], units.build_of(w)) == ("GRCh38", "G", "GRCh38")
    assert tuple(f.select("model_id", "feature_id", "feature_name", "n_variants", "validation_r2").first()) == ("M", "G", "name", 1, 0.2)
    w.withColumn("genome_build", w["genome_build"]).write.parquet(str(tmp_path / "set" / "weights"))
    f.write.parquet(str(tmp_path / "set" / "features"))
    w2, f2 = units.load_weights(spark, str(tmp_path / "set"), "other", "GRCh37")
    assert w2.first()["genome_build"] == "GRCh38" and w2.first()["model_id"] == "M" and f2.count() == 1
    both = w.unionByName(w.withColumn("genome_build", units.F.lit("GRCh37")))
    with pytest.raises(ValueError, match="several builds"):
        units.build_of(both)


def test_a_unit_needs_equal_builds(spark):
    w = units.standardize(spark.createDataFrame([("m",)], "model_id string"), genome_build="GRCh37")
    with pytest.raises(ValueError, match="lift"):
        units.run_unit(w, None, None, None, None, "GRCh38")


def test_the_genotype_to_use(spark):
    rows = [("a1", "S", "source", "GRCh37", "current", 1), ("a2", "S", "liftover_genotype", "GRCh38", "current", 2), ("a3", "S", "qc_genotype", "GRCh38", "current", 3), ("a4", "S", "qc_genotype", "GRCh38", "superseded", 9), ("b1", "T", "source", "GRCh37", "current", 1)]
    a = spark.createDataFrame(rows, "artifact_id string, source_id string, artifact_type string, genome_build string, status string, created_at int")
    of = lambda *x, **k: [r["artifact_id"] for r in units.resolve_genotype(a, *x, **k).collect()]
    assert of("S", "GRCh38") == ["a3"] and of("S", "GRCh38", use_qc=False) == ["a2"] and of("S", "GRCh37", use_qc=False) == ["a1"]
    assert of("T", "GRCh38") == ["b1"] and of("U", "GRCh38") == []


def test_multiqc_table(spark, tmp_path):
    units.write_multiqc(spark.createDataFrame([("s2", 0.5), ("s1", None)], "sample string, f double"), str(tmp_path / "q"))
    text = "".join(p.read_text() for p in (tmp_path / "q").glob("part-*"))
    assert text == "# id: 'sample_qc'\n# section_name: 'Sample QC'\n# plot_type: 'table'\nsample\tf\ns1\t\ns2\t0.5\n"
