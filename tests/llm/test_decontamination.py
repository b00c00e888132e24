"""Containment against brute force, and natively."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cohortix.llm import decontamination as dc


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    width = min(width, len(w))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set()


def test_pairs_equal_brute_force(spark, docs):
    r = random.Random(5)
    vocab = [f"v{i}" for i in range(400)]
    items = [(k, " ".join(r.choices(vocab, k=r.choice([2, 4, 5, 9, 30, 60])))) for k in range(25)] + [(90, ""), (91, None), (92, "a a a a a a a a")]
    rows = []
    for i in range(60):
        t = r.choices(vocab, k=r.choice([0, 3, 50, 2000]))
        own = items[r.randrange(25)][1].split()
        cut = own[: len(own) - r.choice([0, 0, len(own) // 8, len(own) // 3])]
        at = r.randrange(len(t) + 1)
        rows.append((i, " ".join([*t[:at], *cut, *t[at:]]).upper()))
    rows += [(70, "x " * 10 + "a " * 9), (71, None), (None, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in rows:
        for k, q in items:
            s = shingles(q)
            w = len(q.split()) if q else 0
            have = shingles(t, 5) if w >= 5 else {tuple((t or "").encode().lower().split()[j : j + w]) for j in range(len((t or "").split()) - w + 1)} if w else set()
            if i is not None and s and len(s & have) >= 0.75 * len(s):
                want[i, k] = (len(s), len(s & have))
    df = dc.contained_items(docs(rows), bench)
    assert {(r["doc_id"], r["item_id"]): (r["n_item_shingles"], r["n_shared"]) for r in df.collect()} == want
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval", "Cartesian", "NestedLoop"))
    clean = dc.drop_contaminated(docs(rows), bench)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in want}
    assert clean.columns == docs(rows).columns


def test_repeated_ids_are_one_set(spark, docs):
    # item 1 is the six shingles of two texts, of which document 5 holds five in two rows
    bench = spark.createDataFrame([(1, "a b c d e f g"), (1, "p q r s t u v"), (2, "x y"), (2, "x y")], "item_id long, text string")
    rows = [(5, "a b c d e f g"), (5, "q r s t u v"), (6, "a b c d e f g"), (7, "w x y z"), (7, "w x y z")]
    got = {(r["doc_id"], r["item_id"]): (r["n_item_shingles"], r["n_shared"]) for r in dc.contained_items(docs(rows), bench).collect()}
    assert got == {(5, 1): (6, 5), (7, 2): (1, 1)}


def test_partitions_prune_by_their_own_bound_and_size(spark, docs):
    r = random.Random(8)
    vocab = [f"v{i}" for i in range(5000)]
    items = [(k, " ".join(r.choices(vocab, k=200))) for k in range(40)] + [(90 + k, " ".join(r.choices(vocab, k=6))) for k in range(2)]
    sets, widths = dc.item_sets(spark.createDataFrame(items, "item_id long, text string"), 0.75, 5, "item_id", "text")
    _, bounds = dc.size_partitions(sets)
    assert [b[0] for b in bounds] == [1, 7] and [b[2] for b in bounds] == [2, 147]
    text = " ".join(r.choices(vocab, k=400))
    probes = lambda t, own: docs([(1, t)]).select(dc.word_array(F.col("text")).alias("w")).select(F.explode(dc.probes_of(dc.hash_set(F.col("w"), widths), own)).alias("p")).select("p._part", "p._h").collect()
    long, short = probes(text, bounds), probes(" ".join(text.split()[:100]), bounds)
    assert {p["_part"] for p in long} == {1, 7} and {p["_part"] for p in short} == {1}  # 96 shingles can't hold 147
    for part, bound, _ in bounds:
        assert all(p["_h"] <= bound for p in long if p["_part"] == part)
    smaller = [(p, b if p == 1 else b - (1 << 61), n) for p, b, n in bounds]
    fewer = probes(text, smaller)
    assert sum(p["_part"] == 7 for p in fewer) < sum(p["_part"] == 7 for p in long) and sum(p["_part"] == 1 for p in fewer) == sum(p["_part"] == 1 for p in long)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contained_items(docs([(1, "a b c d e f")]), none).collect() == []
    assert dc.contained_items(docs([]), spark.createDataFrame([(1, "a b c d e f")], none.schema)).collect() == []
