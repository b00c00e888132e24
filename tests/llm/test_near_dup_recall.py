"""Recall of the similarity join over set sizes and similarities, and in a group of over 1,000."""

from __future__ import annotations

import random
from collections import defaultdict
from math import ceil

import pytest

from cohortix.llm import near_dup

SIZES, SHARES, PAIRS = (2, 5, 10, 30, 100, 500, 2_000), (0.75, 0.8, 0.9), {2_000: 10, 500: 30}


def words(rnd, n):
    return ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(n)]


def pair(rnd, n, share):
    """Two texts of ``n`` distinct shingles each with the smallest intersection of at least that similarity."""
    s = ceil(2 * n * share / (1 + share) - 1e-9)
    head = words(rnd, s + 4)
    return " ".join(head + words(rnd, n - s)), " ".join(head + words(rnd, n - s))


@pytest.mark.parametrize("leaf", [2_000, 50])
def test_recall_over_sizes_and_similarities(spark, docs, leaf):
    """With small leaves the trees branch here as they do on large tables."""
    rnd, rows, of = random.Random(11), [], {}
    for n in SIZES:
        for share in SHARES:
            for _ in range(PAIRS.get(n, 120)):
                a, b = pair(rnd, n, share)
                of[len(rows)] = (n, share)
                rows += [(len(rows), a), (len(rows) + 1, b)]
    # a group of near copies of one text: each keeps 86 of its 96 shingles, 86 / 106 = 0.81
    base, first = words(rnd, 100), len(rows)
    rows += [(first, " ".join(base))] + [(first + 1 + i, " ".join(base[:90] + words(rnd, 10))) for i in range(1_200)]
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs(rows).repartition(4), leaf=leaf).collect()}
    found = defaultdict(list)
    for i, key in of.items():
        assert got[i] == i and got[i + 1] in (i, i + 1)  # nothing links different pairs
        found[key].append(got[i + 1] == i)
    recall = {k: sum(v) / len(v) for k, v in found.items()}
    print({k: round(v, 4) for k, v in sorted(recall.items())})
    every = [x for v in found.values() for x in v]
    assert sum(every) / len(every) >= 0.99
    for share in SHARES:
        own = [x for (n, s), v in found.items() if s == share for x in v]
        assert sum(own) / len(own) >= 0.99, share
    assert min(recall.values()) >= 0.95, recall
    # the near copies share their first 90 words: all are one component
    assert {got[first + i] for i in range(1_201)} == {first}
