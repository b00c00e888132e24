"""Near-duplicates against brute force over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from cohortix.llm import near_dup
from cohortix.llm.common import WordHash, shingle_set, words


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    par = {i: i for i, _ in rows}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if both and 100 * both >= 75 * (len(s) + len(t) - both):
                x, y = find(i), find(j)
                par[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed=0):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(3000)]
    passage = " ".join(r.choices(vocab, k=60))
    rows, n = [], 0
    for _ in range(40):
        base = r.choices(vocab, k=r.choice([3, 5, 8, 40, 300, 900]))
        for _ in range(r.choice([1, 1, 2, 9])):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, len(t) // 40, len(t) // 25])):
                t[r.randrange(len(t))] = r.choice(vocab)
            rows.append((n, " ".join(t)))
            n += 1
    rows += [(n + k, passage + " " + " ".join(r.choices(vocab, k=r.choice([5, 30, 200])))) for k in range(30)]
    rows += [(900, ""), (901, None), (902, "\n\t "), (903, "Same WORDS here"), (904, "same words\there"), (905, "x " * 3000)]
    return rows


@pytest.mark.parametrize("leaf", [2000, 2])
def test_components_equal_brute_force(spark, docs, leaf):
    rows = corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(docs(rows).repartition(3), leaf=leaf).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in brute(rows).items()}


def test_repeated_rows_null_ids_and_empty_tables(spark, docs):
    t = "a b c d e f g"
    got = sorted(map(tuple, near_dup.near_duplicates(docs([(1, t), (1, t), (None, t), (2, t)])).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (None, 3, None, True), (2, 3, 1, False)], key=str)
    assert near_dup.near_duplicates(docs([])).collect() == []
    kept = near_dup.keep_one(docs([(1, t), (1, t), (None, t), (2, t)]))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, None] and "component_id" in kept.columns


def test_estimates_are_close():
    r = np.random.default_rng(0)
    for n, share in ((40, 0.8), (5000, 0.75), (5000, 0.5)):
        both = r.integers(0, 2**64, int(n * share), np.uint64)
        x, y = (np.unique(np.concatenate([both, r.integers(0, 2**64, n - len(both), np.uint64)])) for _ in range(2))
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        a, b = near_dup.signature(x, 64)[1], near_dup.signature(y, 64)[1]
        assert abs(near_dup.estimate(a, b) - true) < 0.08


def test_shingle_sets_follow_the_words():
    wh = WordHash(2)
    assert len(shingle_set(wh(words(b"a b c")))) == 1 and len(shingle_set(wh(words(b"")))) == 0
    assert np.array_equal(shingle_set(wh(words(b"A b\x0bc d e f"))), shingle_set(wh(words(b"a b c d e f"))))
    assert not np.array_equal(shingle_set(wh(words(b"a b"))), shingle_set(wh(words(b"b a"))))


def test_short_texts_that_share_a_passage(spark, docs):
    # each text has one other at a similarity of 8 / 10 and all others at 7 / 11
    passage = " ".join(f"p{i}" for i in range(11))
    rows = [(2 * i + j, f"{passage} own{i} end{i}x{j}") for i in range(250) for j in range(2)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.near_duplicates(docs(rows)).collect()}
    assert got == brute(rows)


def test_estimates_do_not_depend_on_how_they_are_counted():
    r = np.random.default_rng(1)
    x = (r.integers(1, 256, (300, 512)) * (r.random((300, 512)) < r.random((300, 1)))).astype(np.uint8)
    y = np.where(r.random((300, 512)) < 0.8, x, x[::-1])
    either = ((x > 0) | (y > 0)).sum(-1)
    assert np.array_equal(near_dup.estimate(x, y), ((x == y) & (x > 0)).sum(-1) / np.maximum(either, 1))
    assert np.array_equal(near_dup.estimate(x, y[0]), ((x == y[0]) & (x > 0)).sum(-1) / np.maximum(((x > 0) | (y[0] > 0)).sum(-1), 1))


def test_keep_one_with_columns_of_its_own_names(spark):
    t = "one two three four five six seven"
    rows = spark.createDataFrame([(2, t, 5, "k", 7), (1, t, 6, "k", 8), (3, "else", 5, None, 9)], "doc_id long, text string, _id long, _key string, _times long")
    got = near_dup.keep_one(rows)
    assert sorted(map(tuple, got.collect())) == [(1, t, 6, "k", 8), (3, "else", 5, None, 9)]
    named = near_dup.keep_one(rows.toDF("_id", "_key", "doc", "t", "_times"), doc_id="_id", text="_key")
    assert sorted(r["_id"] for r in named.collect()) == [1, 3]
