"""Sources, sinks and streams on small files."""

from __future__ import annotations

import sqlite3

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.functions.alleles import gt_alt_count
from cohortix.operators import registry
from cohortix.sources import genotype as g
from cohortix.sources import parsers, sinks, sqlite, tables, versions
from cohortix.streaming import events


def write(path, text):
    path.write_text(text)
    return str(path)


def test_formats_and_separators(spark, tmp_path):
    assert [tables.table_format(p) for p in ("a.CSV.gz", "a.tab", "a.pq", "a.height")] == ["csv", "tsv", "parquet", "txt"]
    ws = write(tmp_path / "a.cov", "FID IID  age\n\n1  x   3\n2 y 4 \n")
    assert sorted(map(tuple, tables.read_table(spark, ws).collect())) == [("1", "x", "3"), ("2", "y", "4")]
    csv = write(tmp_path / "b.csv", "id,v\na,\nb,007\n")
    assert sorted(map(tuple, tables.read_table(spark, csv).collect()))[1] == ("b", "007")
    with pytest.raises(ValueError):
        tables.read_table(spark, "x.h5ad")


def test_ragged_white_space_rows_raise(spark, tmp_path):
    bad = write(tmp_path / "bad.txt", "a b\n1 2\n3\n")
    with pytest.raises(Exception, match="fields"):
        tables.read_table(spark, bad).collect()


def test_bed_round_trip(spark, tmp_path):
    copies = np.random.default_rng(3).integers(-1, 3, (7, 10))
    g.write_bed(str(tmp_path / "c.bed"), copies)
    write(tmp_path / "c.fam", "".join(f"f{i} s{i} 0 0 {1 + i % 2} -9\n" for i in range(10)))
    write(tmp_path / "c.bim", "".join(f"chr{1 + i % 2} v{i} 0 {100 + i} a g\n" for i in range(7)))
    rows = g.read_bed(spark, str(tmp_path / "c")).collect()
    assert len(rows) == 70 and all((-1 if r["a1_count"] is None else r["a1_count"]) == copies[r["variant_idx"], r["sample_idx"]] for r in rows)
    assert g.genotype_format(str(tmp_path / "c")) == "bed" and g.fileset(str(tmp_path / "c"))["missing"] == []
    (tmp_path / "c.bed").write_bytes(b"xxx")
    with pytest.raises(Exception, match="bed"):
        g.read_bed(spark, str(tmp_path / "c")).count()


def test_vcf(spark, tmp_path):
    v = write(tmp_path / "a.vcf", "##fileformat=VCFv4.2\n##contig=<ID=1>\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\ts1\ts2\nchr1\t10\trs1\ta\tg\t.\t.\tR2=0.9\tGT:DS\t0|1:0.98\t./.:0.1\n1\t11\trs2\tA\tG,T\t.\t.\t.\tGT\t0/1\t1/1\n")
    got = {r["sample"]: (r["chromosome"], r["GT"], r["alt_count"], r["dosage"], r["info_r2"]) for r in g.read_vcf_calls(spark, v).collect()}
    assert got == {"s1": ("1", "0/1", 1, 0.98, 0.9), "s2": ("1", "./.", None, 0.1, 0.9)}
    assert tuple(g.vcf_skipped(spark, v).first()) == (1, 0) and g.read_vcf_sites(spark, v).count() == 2 and g.vcf_header(spark, v).count() == 2
    assert spark.range(1).select(gt_alt_count(F.lit("1|2"))).first()[0] == 2


def test_annotation_parsers(spark, tmp_path):
    vep = write(tmp_path / "v.tab", "## c\n#Uploaded_variation\tGene\tFeature\tConsequence\tExtra\nk1\t-\tT1\tintron_variant\tIMPACT=LOW;PICK=1\n")
    r = parsers.read_vep(spark, vep).first()
    assert (r["Gene"], r["IMPACT"], r["PICK"], r["CANONICAL"]) == (None, "LOW", "1", None)
    look = write(tmp_path / "c.vcf", "##x\n#CHROM\tPOS\tID\tREF\tALT\tINFO\n1\t5\trs\tA\tC,G\tCLNSIG=Benign;AF=0.1\n1\tbroken\n")
    df = parsers.read_lookup(spark, look)
    assert parsers.clinvar(df).first()["CLNSIG"] == "Benign" and parsers.gnomad(df, ["AF", "X"]).first()["X"] is None
    sp = spark.createDataFrame([("1", "5", "x", "A", "C", "SpliceAI=C|G1|0.1|0.2|0.9|0|1|2|3|4,C|short")], "CHROM string, POS string, ID string, REF string, ALT string, INFO string")
    assert [(r["symbol"], r["score"]) for r in parsers.spliceai(sp).collect()] == [("G1", 0.9)]
    cr = write(tmp_path / "r.tsv", "#c\nuid\tnote\tnote\n1\ta\n")
    assert parsers.read_cravat(spark, cr).columns == ["uid", "note", "note_2"]


def test_score_files(spark, tmp_path):
    db = str(tmp_path / "m.db")
    with sqlite3.connect(db) as c:
        c.execute('create table weights (gene, rsid, varID, ref_allele, eff_allele, weight)')
        c.execute('create table extra (gene, genename, "pred.perf.R2")')
        c.execute("insert into weights values ('G', 'rs1', 'chr1_100_A_G_b38', 'A', 'G', 0.5)")
        c.execute("insert into extra values ('G', 'name', 0.2)")
    r = parsers.read_predictdb(spark, db).first()
    assert (r["chromosome"], r["position"], r["genome_build"], r["weight"], r["validation_r2"]) == ("1", 100, "GRCh38", 0.5, 0.2)
    pgs = write(tmp_path / "p.txt", "#pgs_id=P1\nrsID\tchr_name\tchr_position\teffect_allele\tother_allele\teffect_weight\thm_chr\thm_pos\nrs1\t1\t5\ta\tg\t0.1\t2\t6\n")
    meta, w = parsers.read_scoring_file(spark, pgs, harmonized=True)
    assert meta == {"pgs_id": "P1"} and (w.first()["chromosome"], w.first()["position"], w.first()["effect_allele"]) == ("2", 6, "A")
    with pytest.raises(ValueError, match="header lines"):
        parsers.read_scoring_file(spark, pgs, header_lines=0)


def test_sqlite_tables_by_ranges(spark, tmp_path):
    db = str(tmp_path / "t.db")
    with sqlite3.connect(db) as c:
        c.execute('create table "odd name" (a integer primary key, "b c" text, d blob)')
        c.executemany('insert into "odd name" values (?, ?, ?)', [(i * 7 - 30, None if i == 3 else f"v{i}", b"x" if i % 2 else 1.5) for i in range(40)])
        c.execute("create table empty (x)")
        c.execute("create table plain (k text primary key, v) without rowid")
        c.execute("insert into plain values ('a', 1)")
    df = sqlite.read_sqlite(spark, db, "odd name", rows=50)
    assert df.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, df.collect())) == sorted((str(i * 7 - 30), None if i == 3 else f"v{i}", "x" if i % 2 else "1.5") for i in range(40))
    assert sqlite.read_sqlite(spark, db, "empty").collect() == []
    assert list(map(tuple, sqlite.read_sqlite(spark, f"file://{db}", "plain").collect())) == [("a", "1")]
    with pytest.raises(Exception, match="no table"):
        sqlite.read_sqlite(spark, db, "none").collect()


def test_snapshots_are_verified(spark, tmp_path):
    t = {"a": spark.range(5).toDF("x"), "b": spark.range(2).toDF("y")}
    sinks.freeze(t, str(tmp_path / "s1"))
    assert [r["ok"] for r in sinks.verify(spark, str(tmp_path / "s1")).collect()] == [True, True]
    with pytest.raises(FileExistsError):
        sinks.freeze(t, str(tmp_path / "s1"))
    spark.range(6).toDF("x").write.mode("overwrite").parquet(str(tmp_path / "s1" / "a"))
    assert {r["table_name"]: r["ok"] for r in sinks.verify(spark, str(tmp_path / "s1")).collect()} == {"a": False, "b": True}


def test_atomic_and_partitioned_writes(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("chromosome"), F.col("id").alias("position"))
    for _ in range(2):
        sinks.write_atomic(df, str(tmp_path / "t"))
    assert versions.read_version(spark, str(tmp_path / "t")).count() == 100 and versions.versions(spark, str(tmp_path / "t")) == [1, 2]
    sinks.write_sorted_partitions(df.withColumn("chromosome", F.lpad("chromosome", 2, "0")), str(tmp_path / "p"), "chromosome", ["position"])
    assert sinks.read_partitioned(spark, str(tmp_path / "p"), "position bigint, chromosome string").select("chromosome").distinct().count() == 3
    sinks.write_buckets(df, str(tmp_path / "b"), "position", 8)
    v = df.select("chromosome", "position", F.lit("A").alias("ref"), F.lit("C").alias("alt"), F.lit("k").alias("variant_key"))
    assert sinks.sites_vcf_lines(v, "GRCh38").count() == 103


def test_stream_ingestion_adds_absent_events(spark, tmp_path):
    src = str(tmp_path / "in")
    schema = "participant_id string, event_id string, ts timestamp"
    rows = spark.createDataFrame([("a", "W0"), ("a", "W0"), ("b", "W1")], "participant_id string, event_id string").withColumn("ts", F.current_timestamp())
    rows.write.parquet(src)
    q = events.ingest(spark.readStream.schema(schema).parquet(src), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out/v0")).count() == 2


def test_stream_windows(spark, tmp_path):
    spark.sql("select timestamp'2024-01-01 01:00:00' ts, 'x' event_type, 2.0D value, 'p' participant_id, 'e' event_id").write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("ts timestamp, event_type string, value double, participant_id string, event_id string").parquet(str(tmp_path / "in"))
    for name, f in (("daily", events.daily_counts), ("visits", events.visits), ("first", events.first_events)):
        q = f(s).writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination(60)
        assert q.exception() is None


def test_parents_are_sorted(spark):
    a = spark.createDataFrame([("x",), ("y",)], "artifact_id string")
    e = spark.createDataFrame([("x", "q"), ("x", "p")], "child string, parent string")
    assert {r["artifact_id"]: r["parents"] for r in registry.with_parents(a, e).collect()} == {"x": "p,q", "y": None}
