"""Every registered query of the engine against its SQL, and against a reshuffled input."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cohortix import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return str(v)[:19] if hasattr(v, "isoformat") else v


def key(row):
    return tuple((v is not None, type(v).__name__ if isinstance(v, str) else "n", v if v is not None else 0) for v in row)


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{os.path.join(sf_dir, t)}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    rel = duck.sql(plans.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
    want = sorted((tuple(norm(r[rel.columns.index(c)]) for c in cols) for r in rel.fetchall()), key=key)
    assert got == want


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_queries_without_sql_are_few(spark):
    assert set(plans.queries()) - set(plans.oracle_sql()) == {"ld_pruned_variants"}
