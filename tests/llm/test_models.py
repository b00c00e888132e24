"""The language model, the classifiers: exact likelihoods, held-out quality, odd inputs."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cohortix.llm import hmm, quality, toxicity


def held(i, folds, fold):
    return i is not None and zlib.crc32(str(i).encode()) % folds == fold


# ---- hidden Markov model -----------------------------------------------------------------------


def tiny_model(k=3, c=5, seed=0):
    r = np.random.default_rng(seed)
    m = hmm.HMM({}, 3, 1, 10, 3, np.zeros(1))
    m.start, m.trans, m.emit = (lambda x: x / x.sum())(r.random(k)), (lambda x: x / x.sum(1, keepdims=True))(r.random((k, k))), (lambda x: x / x.sum(0))(r.random((c, k)))
    return m


def test_forward_and_counts_equal_sums_over_paths():
    m = tiny_model()
    seqs = [np.array(s) for s in ([0, 1, 2, 4], [3], [2, 2, 0], [4, 4, 4, 4, 1])]
    start, trans, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    want = []
    for s in seqs:
        paths = list(itertools.product(range(3), repeat=len(s)))
        p = np.array([m.start[z[0]] * m.emit[s[0], z[0]] * math.prod(m.trans[z[t - 1], z[t]] * m.emit[s[t], z[t]] for t in range(1, len(s))) for z in paths])
        want.append(math.log(p.sum()))
        for z, w in zip(paths, p / p.sum(), strict=True):
            start[z[0]] += w
            for t, o in enumerate(s):
                emit[o, z[t]] += w
                if t:
                    trans[z[t - 1], z[t]] += w
    assert np.allclose(hmm.forward(seqs, m), want)
    for got, exact in zip(hmm.expected_counts(seqs, m), (start, trans, emit), strict=True):
        assert np.allclose(got, exact)


def test_windows_count_each_transition_and_emission_once():
    m = tiny_model()
    m.start = hmm.stationary(m)
    seq = np.array([0, 1, 2, 4, 3, 3, 1, 0, 2])
    cuts = hmm.windows(seq, 4)
    assert [w.tolist() for w in cuts] == [[0, 1, 2, 4], [4, 3, 3, 1, 0], [0, 2]]
    start, trans, emit = hmm.expected_counts(cuts, m, np.array([True, False, False]))
    assert start.sum() == pytest.approx(1) and trans.sum() == pytest.approx(len(seq) - 1)
    assert np.allclose(emit.sum(1), np.bincount(seq, minlength=5))
    assert hmm.windows(np.array([1]), 4)[0].tolist() == [1] and len(hmm.windows(seq, 9)) == 1


@pytest.mark.parametrize("lexicon", [0, 2, 7, 1000])
def test_scores_equal_a_recursion_by_hand(spark, docs, monkeypatch, lexicon):
    # a lexicon smaller than a bin of equal counts takes a part of it; the rest is joined
    r = random.Random(5)
    rows = [(i, " ".join(r.choices(["aa", "b", "c", "dd", "e", "ff", "g", "h", f"x{i % 9}"], k=r.choice([0, 3, 30])))) for i in range(60)] + [(300, None), (301, "new words only")]
    kept = {}
    real = hmm.baum_welch
    monkeypatch.setattr(hmm, "baum_welch", lambda *a, **k: kept.setdefault("m", real(*a, **k)))
    d = docs(rows).selectExpr("cast(doc_id as int) doc_id", "text", "1 as score", "2 as th")
    got = hmm.hmm_scores(d, lexicon=lexicon, n_words=4, n_buckets=3, states=2, iterations=1)
    assert dict(got.dtypes)["doc_id"] == "int"
    out = got.collect()
    m = kept["m"]
    assert len(m.lexicon) <= lexicon + 1 and (lexicon != 7 or len(m.lexicon) > 1)
    tok = lambda t: [*(t or "").encode().lower().split(), hmm.END]
    train = Counter(w for i, t in rows if not held(i, 7, 2) for w in tok(t))
    single = {w: k for w, (k, _) in m.lexicon.items() if k >= 0}
    groups = {g: [c for w, c in train.items() if w not in single and hmm.bucket(w, 3) == g] for g in range(3)}
    assert len(out) == len(rows)
    for g in out:
        want, a = 0.0, m.start
        for t, w in enumerate(tok(dict(rows)[g["doc_id"]])):
            b = hmm.bucket(w, 3)
            p = (a @ m.trans if t else a) * m.emit[single.get(w, m.n_words + b)]
            want, a = want + math.log10(p.sum()), p / p.sum()
            if w not in single:
                want += math.log10((train[w] + 1) / (sum(groups[b]) + len(groups[b]) + 1))
        assert g["score"] == pytest.approx(want, abs=1e-6)


def test_base_scores_and_counts_equal_the_definition(spark, docs):
    r = random.Random(2)
    rows = [(i, " ".join(r.choices(["Aa", "b", "c\x0bd", "e", f"q{i}"], k=r.choice([0, 1, 40])))) for i in range(80)] + [(200, None), (201, ""), (500, "again"), (500, "again"), (None, "b b zz")]
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    train = [w for i, t in rows if not held(i, 7, 2) for w in tok(t)]
    counts = {w: train.count(w) for w in set(train)}
    n, v = len(train), len(counts)
    got = hmm.hmm_scores(docs(rows), lexicon=6, n_words=3, states=2, iterations=2).collect()
    assert len(got) == len(rows)
    for g in got:
        t = next(t for i, t in rows if i == g["doc_id"])
        ws = tok(t)
        assert g["held_out"] == held(g["doc_id"], 7, 2) and g["n_tokens"] == len(ws) and g["train_tokens"] == n
        assert g["n_known"] == sum(w in counts for w in ws)
        assert g["base_score"] == pytest.approx(sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in ws), abs=1e-6)
        assert math.isfinite(g["score"]) and g["score"] < 0


def test_the_model_beats_its_base_on_mixed_languages(spark, docs):
    r = random.Random(4)
    vocab = [[f"{p}{i}" for i in range(150)] for p in "xyz"]
    rows = [(i, " ".join(r.choices(vocab[i % 3], k=60))) for i in range(240)]
    got = hmm.hmm_scores(docs(rows), states=4, n_words=200).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"] * 0.9  # both negative: nearer to 0 by a tenth at least


def test_hmm_without_training_rows(spark, docs):
    i = next(i for i in range(100) if held(i, 7, 2))
    r = hmm.hmm_scores(docs([(i, "a b")])).first()
    assert (r["n_known"], r["train_tokens"], r["base_score"]) == (0, 0, 0.0)
    assert hmm.hmm_scores(docs([])).collect() == []


# ---- classifiers -------------------------------------------------------------------------------


def test_additive_model_learns_an_interaction():
    r = np.random.default_rng(0)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = quality.fit(x, y, n_pairs=1, pair_rounds=60)
    assert m.pairs[0][:2] == (0, 1) and ((m.score(x) > 0.5) == y).mean() > 0.9


@pytest.mark.parametrize("kind", ["quality", "toxic"])
def test_held_out_accuracy(spark, sf_dir, kind):
    d = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    if kind == "quality":
        got = quality.score_quality(docs, quality.train_quality(docs, labels))
    else:
        got = toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, labels))
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out").select("predicted", kind).collect()
    assert sum(p == t for p, t in rows) / len(rows) > 0.95


def test_toxicity_scores_are_probabilities(spark, sf_dir):
    # the calibration belongs to the scores given out: on held-out rows their mean and squares agree with the labels
    d = sf_dir.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = toxicity.score_toxicity(docs.join(labels.select("doc_id"), "doc_id", "left_semi"), toxicity.train_toxicity(docs, labels))
    rows = got.join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    assert len(rows) > 500 and abs(sum(s - t for s, t in rows)) / len(rows) < 0.03 and sum((s - t) ** 2 for s, t in rows) / len(rows) < 0.03
    for lo, hi in ((0, 0.1), (0.9, 1.01)):
        own = [t for s, t in rows if lo <= s < hi]
        assert own and abs(sum(own) / len(own) - (lo > 0.5)) < 0.1


def test_the_sample_is_bounded_and_has_an_id_once(spark, docs):
    rows = [(i, f"text {i}") for i in range(3000)] + [(0, "again")] * 500
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, quality int")
    got = quality.labelled_sample(docs(rows), labels, "quality", 400).collect()
    assert 300 < len(got) <= 400 and len({r["text"] for r in got}) == len(got)
    every = quality.labelled_sample(docs(rows), labels, "quality", 20_000).collect()
    assert sorted(r["text"] for r in every) == sorted(f"text {i}" for i in range(3000) if not held(i, 5, 0))


def test_one_slot_larger_than_the_sample(spark, docs):
    rows = [(i, f"text {i}") for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, quality int")
    got = quality.labelled_sample(docs(rows), labels, "quality", 400, slots=1).collect()
    assert 300 < len(got) < 500 and {r["y"] for r in got} == {0.0, 1.0}
    assert 0 < quality.labelled_sample(docs(rows), labels, "quality", 10, slots=4).count() < 40


def test_predictions_follow_the_limits(spark, docs):
    # without labels of both kinds every score is the share of label 1: ties at the limits
    rows = [(i, f"t{i}") for i in range(40)]
    kept = [i for i in range(40) if not held(i, 5, 0)][:10]
    labels = spark.createDataFrame([(i, 1, 1) for i in kept], "doc_id long, quality int, toxic int")
    out = toxicity.score_toxicity(docs(rows), toxicity.train_toxicity(docs(rows), labels), cut=1.0).collect()
    assert all(r["score"] == 1.0 and r["predicted"] == 1 for r in out)
    q = quality.train_quality(docs(rows), labels)
    p = quality.score_quality(docs(rows), q).first()["score"]
    assert all(r["predicted"] == 1 for r in quality.score_quality(docs(rows), q, cut=p).collect())


def test_odd_rows_have_scores(spark, docs):
    rows = [(1, None), (2, ""), (3, "\n"), (4, "z" * 100_000), (None, "a b"), (1, "a b"), (1, "a b")]
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for got in (
        quality.score_quality(docs(rows), quality.train_quality(docs(rows), labels)),
        toxicity.score_toxicity(docs(rows), toxicity.train_toxicity(docs(rows), labels)),
        quality.score_quality(docs(rows), quality.train_quality(docs(rows), labels.limit(0))),
        toxicity.score_toxicity(docs(rows), toxicity.train_toxicity(docs(rows), labels.limit(0))),
    ):
        out = got.collect()
        assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    model = quality.train_quality(docs(rows), labels.limit(0))
    assert quality.keep_quality(docs(rows), model).columns == docs(rows).columns
    assert quality.score_quality(docs([]), model).collect() == []


def test_isotonic_is_monotone_and_boosting_fits():
    r = np.random.default_rng(1)
    x = r.random((2000, 4))
    y = ((x[:, 0] > 0.7) & (x[:, 2] < 0.4)).astype(float)
    base, f, c, v = toxicity.boost(x, y, trees=30)
    m = toxicity.Boosted(toxicity.Lexicon({}, {}), base, 3, f, c, v, toxicity.isotonic(r.random(50), r.integers(0, 2, 50).astype(float)))
    assert (np.diff(m.steps[1]) >= 0).all() and ((m.margin(x) > 0) == y).mean() > 0.97


def test_hidden_insults_count():
    lex = toxicity.Lexicon({}, {})
    f = lambda t: dict(zip(toxicity.FEATURES, toxicity.features(t, lex), strict=True))
    assert f("you st*pid 1d1ot")["hidden"] >= 1 and f("what a s t u p i d thing")["spaced"] == 1 and f("you are an idiot")["near_you"] == 1
