"""Spelling variants against a plain comparison of all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortix.llm import spelling as S


def one_edit(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    return len(x) + 1 == len(y) and any(y[:k] + y[k + 1 :] == x for k in range(len(y)))


def brute(rows, least_length=5, least_count=3, slip=97):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % slip == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1 :]
            if len(w) >= least_length:
                n[w] += 1
    n = {w: c for w, c in n.items() if c >= least_count}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else -1) for w in n)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def varied(seed, n=900):
    """Texts of words near to each other in chains, with letters beyond a-z, mixed case and hot words."""
    rnd = random.Random(seed)
    letters = "abenorstu" + "éÀ÷ßÿ"
    words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 8))) for _ in range(60)]
    for _ in range(240):
        w = rnd.choice(words)
        k = rnd.randrange(len(w))
        words.append(rnd.choice([w[:k] + w[k + 1 :], w[:k] + rnd.choice(letters) + w[k:], w[:k] + rnd.choice(letters) + w[k + 1 :]]))
    weights = [1 / (i + 1) for i in range(len(words))]
    return [(i, rnd.choice([" ", ", ", "1"]).join(w.upper() if rnd.random() < 0.1 else w for w in rnd.choices(words, weights, k=20))) for i in range(n)]


@pytest.mark.parametrize("size", [S.BLOCK, 3])
def test_equals_a_comparison_of_all_words(spark, docs, size):
    rows = varied(size) + [(5000, None), (5001, ""), (None, "nullid nullid nullid nullids"), (7, "x" * 3000), (7, "x" * 3000), (7, "x" * 3001 + " " + "x" * 3000), (8, ("y" + "x" * 3000 + " ") * 3)]
    assert got(S.spelling_variants(docs(rows).repartition(4), size=size)) == brute(rows)


def test_documents_equal_a_comparison_of_all_words(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 60")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    assert got(S.spelling_variants(d, slip=5)) == brute(rows, slip=5)


def test_chains_lead_to_the_last_form(spark, docs):
    words = ["chainaaa"[:8], "chainaab", "chainabb", "chainbbb", "chaibbbb", "chabbbbb"]
    rows = [(0, " ".join(" ".join([w] * (3 * 2**k)) for k, w in enumerate(words)))]
    out = got(S.spelling_variants(docs(rows), slip=10**9 + 7))
    assert {w: r for w, _, r, *_ in out} == dict.fromkeys(words, "chabbbbb")


def test_an_empty_table(spark, docs):
    assert got(S.spelling_variants(docs([]))) == [] == got(S.spelling_variants(docs([(1, None), (2, "a b")])))


def test_no_neighbouring_key_is_missed():
    """Any edit changes length and class counts by one of the stated changes or the reverse of one."""
    rnd, stated = random.Random(1), set(S._deltas())
    stated |= {tuple(-x for x in d) for d in stated}
    key = lambda w: np.array([len(w), *[sum(c in k for c in w) for k in S.CLASSES]])
    for _ in range(3000):
        w = "".join(rnd.choice("eatnsoiurlhxyé") for _ in range(rnd.randint(1, 9)))
        k, c = rnd.randrange(len(w)), rnd.choice("eatnsoiurlhxyé")
        for v in (w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]):
            assert tuple((key(v) - key(w)).tolist()) in stated
