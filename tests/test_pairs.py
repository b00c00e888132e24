"""Kinship by blocks, shared things and the unrelated set against plain loops."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from cohortix.operators import pairs, unrelated


def brute_kinship(g, least):
    """g: samples x variants, -1 missing."""
    het = (g == 1).sum(1)
    out = {}
    for a, b in combinations(range(len(g)), 2):
        both = (g[a] >= 0) & (g[b] >= 0)
        hh, ibs0 = int(((g[a] == 1) & (g[b] == 1)).sum()), int((both & (abs(g[a] - g[b]) == 2)).sum())
        if het[a] + het[b] and (k := (hh - 2 * ibs0) / (het[a] + het[b])) > least:
            out[f"s{a:04}", f"s{b:04}"] = (int(both.sum()), hh, ibs0, round(k, 12))
    return out


def cohort(n, m, called, seed):
    rng = np.random.default_rng(seed)
    g = rng.binomial(2, rng.uniform(0.05, 0.6, m), (n, m))
    for i in range(1, n, 3):
        g[i] = np.where(rng.random(m) < 0.6, g[i - 1], g[i])
    g[rng.random((n, m)) >= called] = -1
    return g


def calls_of(spark, g):
    rows = [(f"s{i:04}", v, None if x < 0 else int(x)) for i, row in enumerate(g) for v, x in enumerate(row)]
    return spark.createDataFrame(rows, "sample string, variant long, alt_count long")


@pytest.mark.parametrize("called", [0.97, 0.1])
@pytest.mark.parametrize("sizes", [pairs.Sizes(), pairs.Sizes(16, 64, 2, 500)])
def test_kinship_equals_all_pairs(spark, called, sizes):
    """Dense and sparse cohorts; small blocks and ranges make several of each and sums over parts."""
    g = cohort(50, 300, called, 3)
    got = {(r.a, r.b): (r.n_sites, r.het_het, r.ibs0, round(r.kinship, 12)) for r in pairs.kinship(calls_of(spark, g), 0.02, sizes).collect()}
    assert got == brute_kinship(g, 0.02) and len(got) > 10


@pytest.mark.parametrize("lists", [pairs.Lists(), pairs.Lists(5, 20, 400, 30, 10)])
def test_sparse_cohorts_are_compared_by_lists(spark, monkeypatch, lists):
    """Fewer joint calls than pairs; several blocks, pieces and slices give what one does."""
    monkeypatch.setattr(pairs, "_by_blocks", None)
    g = cohort(120, 300, 0.05, 5)
    got = {(r.a, r.b): (r.n_sites, r.het_het, r.ibs0, round(r.kinship, 12)) for r in pairs.kinship(calls_of(spark, g), 0.02, lists=lists).collect()}
    assert got == brute_kinship(g, 0.02) and len(got) > 10


def test_lists_pass_their_index_in_pieces(spark):
    """1.5 million calls in one block with 21 million joint ones: a task holds the index, a piece and a slice."""

    def finish(a_at, b_at, counts, na, nb):
        import pyarrow as pa

        with open("/proc/self/status") as f:
            mb = next(int(x.split()[1]) >> 10 for x in f if x.startswith("VmRSS"))
        return pa.table({"mb": pa.array([mb]), "n": pa.array([int(counts[2].sum())])})

    own = spark.range(1_500_000).selectExpr("id % 30000 as sample", "(id * 7919 + id div 30000) % 50000 as variant", "1 as alt_count")
    want = own.distinct().groupBy("variant").count().selectExpr("sum(count * (count - 1) div 2) as n").first().n
    got, _ = pairs.compare(own, finish, "mb long, n long", lists=pairs.Lists(1))
    rows = got.collect()
    assert sum(r.n for r in rows) == want > 20_000_000 and max(r.mb for r in rows) < 330


@pytest.mark.parametrize("joint", [1, 7, 1_000_000])
def test_a_sample_with_many_joint_calls_is_counted_by_parts(spark, joint):
    g = np.full((90, 200), -1)
    rng = np.random.default_rng(8)
    g[rng.random(g.shape) < 0.04] = 1
    g[rng.random(g.shape) < 0.02] = 2
    g[0], g[45] = rng.integers(0, 3, (2, 200))
    got = {(r.a, r.b): (r.n_sites, r.het_het, r.ibs0, round(r.kinship, 12)) for r in pairs.kinship(calls_of(spark, g), 0.0, lists=pairs.Lists(3, 50, 500, 60, joint)).collect()}
    assert got == brute_kinship(g, 0.0) and len(got) > 10


def test_kinship_leaves_out_what_is_no_call(spark):
    rows = [("a", 1, 1), ("b", 1, 1), ("a", 2, 7), ("b", 2, 1), (None, 1, 1), ("c", None, 1), ("c", 1, None), ("a", 3, 0), ("a", 3, 1), ("b", 3, 1)]
    got = pairs.kinship(spark.createDataFrame(rows, "sample string, variant long, alt_count long")).collect()
    assert [(r.a, r.b, r.n_sites, r.het_het, r.relationship) for r in got] == [("a", "b", 2, 2, "duplicate_or_twin")]
    assert pairs.kinship(spark.createDataFrame([], "sample string, variant long, alt_count long")).collect() == []


def test_shared_things(spark):
    rnd = random.Random(4)
    own = {s: {rnd.randrange(40) for _ in range(rnd.randrange(1, 12))} for s in range(60)}
    df = spark.createDataFrame([(s, v) for s, x in own.items() for v in x], "sample long, variant long")
    want = {(a, b): (len(own[a] & own[b]), len(own[a] & own[b]) / min(len(own[a]), len(own[b]))) for a, b in combinations(range(60), 2)}
    assert {(r.a, r.b): (r.n_shared, r.share) for r in pairs.shared(df, 2).collect()} == {k: v for k, v in want.items() if v[0] >= 2}
    label = lambda x: next((n for c, n in pairs.KINSHIP_CUTS if x > c), "unrelated")
    assert {r.relationship: r.n_pairs for r in pairs.degree_counts(df).collect()} == Counter(label(v[1]) for v in want.values() if v[0])


def sequential(edges, miss):
    """The rule, one sample after another."""
    edges, removed = {frozenset(e) for e in edges if e[0] != e[1]}, set()
    while edges:
        degree = Counter(s for e in edges for s in e)
        worst = max(degree, key=lambda s: (degree[s], miss.get(s) or 0.0, s))
        removed.add(worst)
        edges = {e for e in edges if worst not in e}
    return removed


@pytest.mark.parametrize("seed", range(2))
def test_rounds_equal_the_sequential_rule(spark, seed):
    """One giant family with hubs and ties, and small ones; all by rounds, and by rounds ended in one task."""
    rnd = random.Random(seed)
    names = [f"s{i:03}" for i in range(160)]
    edges = [(names[int(rnd.random() ** 2 * 110)], names[rnd.randrange(110)]) for _ in range(170)]
    edges += [(names[i], names[i + 1]) for i in range(110, 150, 2)] + [("s150", x) for x in names[151:]]
    edges += [(b, a) for a, b in edges[:20]] + edges[:5]
    miss = {s: rnd.choice([0.0, 0.1, 0.2, None]) for s in names[:140]}
    p = spark.createDataFrame(edges, "a string, b string")
    m = spark.createDataFrame(list(miss.items()), "sample string, missing_fraction double")
    want = sequential(edges, miss)
    for local in (0, 60):
        got = [r["sample"] for r in unrelated.unrelated_removal(p, m, local).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_unrelated_takes_the_hub(spark):
    p = spark.createDataFrame([("a", "b"), ("a", "c"), ("d", "e"), ("f", "f"), (None, "a")], "a string, b string")
    m = spark.createDataFrame([("d", 0.1), ("e", 0.2)], "sample string, missing_fraction double")
    assert sorted(r["sample"] for r in unrelated.unrelated_removal(p, m).collect()) == ["a", "e"]
    assert unrelated.unrelated_removal(p.where("false"), m).collect() == []
