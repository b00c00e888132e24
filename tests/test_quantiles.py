"""Exact quantiles by narrowing, and tables in versions."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.operators.quantiles import quantiles
from cohortix.sources import sinks, versions

P = (0.0, 0.01, 0.5, 0.77, 1.0)


@pytest.mark.parametrize("direct,bins", [(100_000, 4_096), (0, 64)])
def test_quantiles_equal_sorting(spark, direct, bins):
    rng = np.random.default_rng(direct)
    groups = {"flat": rng.random(300), "ties": rng.integers(0, 3, 250).astype(float), "one": np.full(120, 7.0), "few": np.array([3.0, 1.0]), "spread": 2.0 ** rng.integers(-30, 30, 150), None: rng.normal(size=90), "huge": np.array([-1.7e308, 1.7e308, 0.0] * 30)}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("flat", None), ("flat", math.nan), ("gone", None)]
    got = {r["g"]: r["q"] for r in quantiles(spark.createDataFrame(rows, "g string, x double").repartition(3), "x", P, ["g"], direct, bins).collect()}
    assert got.keys() == groups.keys()
    for g, xs in groups.items():
        assert got[g] == pytest.approx(np.quantile(xs, P).tolist(), rel=1e-12), g
    whole = quantiles(spark.createDataFrame(rows, "g string, x double").where("g = 'flat'"), "x", P, (), direct, bins).first()["q"]
    assert whole == pytest.approx(np.quantile(groups["flat"], P).tolist(), rel=1e-12)


def test_quantiles_of_nothing(spark):
    none = spark.createDataFrame([], "g string, x double")
    assert quantiles(none, "x", P, ["g"]).collect() == []


def test_a_writer_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "t")
    assert sinks.write_atomic(spark.range(3), at) == 1
    with monkeypatch.context() as m:
        m.setattr(versions, "_commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            sinks.write_atomic(spark.range(9), at)
    assert versions.read_version(spark, at).count() == 3 and versions.versions(spark, at) == [1]
    assert sinks.write_atomic(spark.range(5), at) == 2
    assert versions.read_version(spark, at).count() == 5 and versions.read_version(spark, at, 1).count() == 3


def test_of_two_writers_one_wins(spark, tmp_path):
    at = str(tmp_path / "t")
    assert versions.write_version(spark.range(1), at, expect=0) == 1
    assert versions.write_version(spark.range(2), at, expect=1) == 2
    with pytest.raises(versions.Conflict):
        versions.write_version(spark.range(3), at, expect=1)
    assert versions.read_version(spark, at).count() == 2
    with pytest.raises(versions.Conflict):
        versions._commit(spark, at, 2, "data-other")
    assert versions.write_version(spark.range(4), at) == 3
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, at, 9)
    assert versions.remove_old(spark, at, 1) == [1, 2] and versions.read_version(spark, at).count() == 4
    assert sorted(x.name[:5] for x in (tmp_path / "t").iterdir()) == ["_vers", "data-"]


def test_a_hot_partition_is_spread(spark, tmp_path):
    df = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, "1").otherwise((F.col("id") % 40).cast("string")).alias("chromosome"), (F.col("id") * 7 % 6_000).alias("position"), F.lit("x" * 50).alias("pad"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_sorted_partitions(df, str(tmp_path / "p"), "chromosome", ["position"])
        sinks.write_buckets(df.withColumn("k", F.col("id") % 1 if "id" in df.columns else F.lit(5)), str(tmp_path / "b"), "k", 8)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "p" / "chromosome=1").glob("*.parquet"))) > 1
    assert sum(len(list(x.glob("*.parquet"))) for x in (tmp_path / "b").glob("bucket=*")) > 1
    back = sinks.read_partitioned(spark, str(tmp_path / "p"), "position bigint, pad string, chromosome string")
    assert back.count() == 6_000
    for f in (tmp_path / "p").rglob("*.parquet"):
        at = [r["position"] for r in spark.read.parquet(str(f)).collect()]
        assert at == sorted(at)
