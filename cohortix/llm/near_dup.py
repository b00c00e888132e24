"""MinHash near-duplicates by a chosen-path set similarity join.

Texts with the same shingle set are one set from the start, so copies never become pairs. Each set
has a signature of minwise values. A tree sends a set down the children that belong to minwise
positions chosen for the node, so that like sets meet again and unlike ones part; ``trees``
independent trees repeat this. Levels take turns in sending a set to one child and to two: that is
4/3 on average, so that the expected number of common children of two sets grows from level to level
only above the similarity of 0.75.

What is asked for are components, and a link inside a component is not needed twice. On each level
the members of a node are first compared with one of them, its hub: one row a member, however large
the group, joins most of what is alike. A node that still holds several components is compared
exhaustively once that takes at most ``leaf`` squared comparisons, and branches on otherwise, until
``depth``, where it is compared all the same: nothing is capped. Comparisons run on blocks of bounded
size, of signatures first; the members that may be linked across components form clusters, and each
cluster is settled on full shingle sets inside a task, from the likeliest pair down. What leaves a
task are the members of clusters and the links of a spanning forest, never pairs of a group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, WordHash, cut, mix, shared_dir, shingle_set, small, texts_of, words

#: Pairs whose estimated similarity lies this far under the threshold are ruled out. The estimate is
#: over up to ``BINS`` minwise values, so that is 3.6 standard deviations at a similarity of 0.75.
MARGIN = 0.07
#: Bins of the hash range, each with the smallest hash in it; a power of two.
BINS = 512
#: Sets in a block of comparisons, and the bytes of their shingle hashes.
BLOCK, BLOCK_BYTES = 1024, 24 << 20


def signature(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(branching values, estimation bytes) of a sorted set of 64-bit hashes, by one permutation.

    The smallest hash of each bin is a minwise value. For branching, ``k`` places of the hash range
    take the value of the next filled bin, so that small sets have one at every place. For
    estimation, every bin has a byte, 0 where it is empty.
    """
    bins = (s >> np.uint64(55)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    filled, least = bins[first], s[first]
    value = mix(least)
    low = np.zeros(BINS, np.uint8)
    low[filled] = (value % np.uint64(255)).astype(np.uint8) + 1
    at = np.searchsorted(filled, np.arange(0, BINS, BINS // k))
    return (value[at % len(filled)] >> np.uint64(32)).astype(np.uint32), low


def text_key(text: str | Column):
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")))


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def sketches(docs: DataFrame, doc_id: str, text: str, width: int, k: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, digest of the set, sig, low) of every row; an empty set has no digest.

    ``text_key`` tells apart the texts of one id. ``sig`` holds the values by which nodes branch, ``low`` the bytes by which similarity is estimated.
    """
    kind = dict(docs.dtypes)[doc_id]

    def make(it):
        wh = WordHash()
        for batch in it:
            n, dig, sig, low = [], [], [], []
            for t in texts_of(batch.column(1)):
                s = shingle_set(wh(words(t)), width)
                v, w = signature(s, k) if len(s) else (None, None)
                n.append(len(s))
                dig.append(_digest(s))
                sig.append(v.tobytes() if len(s) else None)
                low.append(w.tobytes() if len(s) else None)
            cols = [batch.column(0), batch.column(2), pa.array(n, pa.int64()), *[pa.array(x, pa.binary()) for x in (dig, sig, low)]]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_key", "n_shingles", "digest", "sig", "low"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text), text_key(text)).mapInArrow(make, f"doc_id {kind}, text_key binary, n_shingles long, digest binary, sig binary, low binary")


# ---- components -------------------------------------------------------------------------------


def components(edges: DataFrame, where: str, most: int = 60) -> DataFrame:
    """(v, c): the smallest vertex reachable from each vertex of the links (a, b), by label passing.

    Each round takes the smallest label among the neighbours and then the label of the label.
    """
    both = cut(edges.select(F.col("a").alias("v"), F.col("b").alias("u")).unionByName(edges.select(F.col("b").alias("v"), F.col("a").alias("u"))).distinct(), where)
    lab = cut(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("c")), where)
    n = lab.count()
    for _ in range(most):
        near = both.join(small(lab.select(F.col("v").alias("u"), "c"), n), "u").groupBy("v").agg(F.min("c").alias("n"))
        got = near.join(small(lab, n), "v").select("v", F.col("c").alias("old"), F.least("c", "n").alias("c"))
        jump = got.join(small(lab.select(F.col("v").alias("c"), F.col("c").alias("j")), n), "c", "left")
        new = cut(jump.select("v", "old", F.least("c", "j").alias("c")), where)
        lab = new.select("v", "c")
        if new.where("c <> old").limit(1).count() == 0:
            return lab
    raise RuntimeError("components did not settle")


def _merge(label: DataFrame | None, links: DataFrame, where: str) -> DataFrame:
    """``label`` (v, c) after ``links`` (a, b) joined its components; only they are walked again."""
    if label is None:
        return components(links, where)
    edges = _labelled(links, label).select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a <> b").distinct()
    joined = components(edges, where)
    rows = joined.count()
    new = joined.select("v", F.col("v").alias("c")).join(small(label.select("v").where("v = c"), label.count()), "v", "left_anti")
    grown = label.unionByName(new).join(small(joined.select(F.col("c").alias("_c"), F.col("v").alias("c")), rows), "c", "left")
    return cut(grown.select("v", F.coalesce("_c", "c").alias("c")), where)


def _labelled(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """``pairs`` with the components ``ca`` and ``cb`` of their ends."""
    n = label.count()
    a, b = (small(label.withColumnsRenamed({"v": x, "c": f"c{x}"}), n) for x in "ab")
    return pairs.join(a, "a", "left").join(b, "b", "left").withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")})


# ---- estimates and exact checks ---------------------------------------------------------------


def _trues(m: np.ndarray) -> np.ndarray:
    """The number of trues in each row of ``BINS`` booleans, added eight bytes at a time."""
    words = np.ascontiguousarray(m).view(np.uint64)  # a byte of the sum holds at most BINS / 8
    return words.sum(-1, dtype=np.uint64, keepdims=True).view(np.uint8).sum(-1, dtype=np.int64)


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows of estimation bytes: equal bins of those that either has filled."""
    empty = _trues((x | y) == 0)
    return (_trues(x == y) - empty) / np.maximum(BINS - empty, 1)


def linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether 100 * |p and q| >= percent * |p or q|, of sorted distinct hashes."""
    if min(len(p), len(q)) * 100 < percent * max(len(p), len(q)):
        return False
    both = np.concatenate([p, q])
    both.sort(kind="stable")  # two sorted runs: a merge
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared > 0 and 100 * shared >= percent * (len(p) + len(q) - shared)


def _alike(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """``pairs`` (a, b) with the estimated similarity ``est``, those under ``least`` ruled out."""

    def share(it):
        for b in it:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint8).reshape(b.num_rows, -1) for i in (2, 3))
            est = estimate(x, y)
            m = pa.array(est >= least)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(m), b.column(1).filter(m), pa.array(est).filter(m)], names=["a", "b", "est"])

    low = sets.select("rid", "low")
    got = pairs.join(low.withColumnsRenamed({"rid": "a", "low": "x"}), "a").join(low.withColumnsRenamed({"rid": "b", "low": "y"}), "b")
    return got.select("a", "b", "x", "y").mapInArrow(share, "a binary, b binary, est double")


def _full_sets(rids: DataFrame, sets: DataFrame, docs: DataFrame, width: int, where: str) -> DataFrame:
    """(rid, s): the whole shingle sets of ``rids``, read from the text of the row that stands for each."""

    def make(it):
        wh = WordHash()
        for b in it:
            keys, out = [], []
            for key, t in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                s = shingle_set(wh(words(t)), width)
                if _digest(s) == key:  # an id may come again with another text
                    keys.append(key)
                    out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.binary())], names=["rid", "s"])

    n = rids.count()
    want = cut(sets.select("rid", "doc_id").join(small(rids, n // 5), "rid", "left_semi"), where)
    texts = docs.where(F.col("doc_id").isNotNull()).join(small(want, n // 5), "doc_id")
    got = texts.select("rid", "text").mapInArrow(make, "rid binary, s binary")
    return cut(got.dropDuplicates(["rid"]), where)


def _verified(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets are linked."""

    def check(it):
        for b in it:
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            m = pa.array([linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64), percent) for p, q in zip(x, y, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(m), b.column(1).filter(m)], names=["a", "b"])

    got = pairs.select("a", "b").join(full.withColumnsRenamed({"rid": "a", "s": "x"}), "a").join(full.withColumnsRenamed({"rid": "b", "s": "y"}), "b")
    return got.select("a", "b", "x", "y").mapInArrow(check, "a binary, b binary")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("rid")).unionByName(pairs.select(F.col("b").alias("rid"))).distinct()


# ---- trees ------------------------------------------------------------------------------------


def _roots(sets: DataFrame, k: int, trees: int, branches: int, seed: int) -> DataFrame:
    """(node, rid, n): the first level of all trees. A tree's root is chosen by its number alone."""

    def go(it):
        for b in it:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(b.num_rows, k)
            roots = trees * branches
            for j in range(roots):
                # trees share no first position, and the positions spread over the whole hash range, so
                # that small sets, which fill few bins, still show most of their values
                child = mix(mix(sig[:, j * max(1, k // roots) % k].astype(np.uint64) + np.uint64(seed)) + np.uint64(j)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(child), b.column(0), b.column(2)], names=["node", "rid", "n"])

    return sets.select("rid", "sig", "n").mapInArrow(go, "node long, rid binary, n long")


def _children(nodes: DataFrame, k: int, branches: int, seed: int) -> DataFrame:
    """(node, rid, n) one level down: ``branches`` minwise positions chosen for each node."""

    def go(it):
        for b in it:
            if not b.num_rows:
                continue
            node = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            sig = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint32).reshape(len(node), k)
            for j in range(branches):
                pick = mix(node + np.uint64(seed + j + 1))
                value = sig[np.arange(len(node)), (pick % np.uint64(k)).astype(np.int64)].astype(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(mix(mix(pick ^ value) + np.uint64(j)).view(np.int64)), b.column(1), b.column(3)], names=["node", "rid", "n"])

    return nodes.select("node", "rid", "sig", "n").mapInArrow(go, "node long, rid binary, n long")


def _shared(nodes: DataFrame, label: DataFrame, where: str) -> DataFrame:
    """(node, rid, n, c, total, main, hub, hn, blocks, minors, minor_blocks) of nodes of several components.

    ``main`` is a component that most members belong to, ``hub`` one of its members in the node,
    ``minors`` the number of the others; the blocks hold ``BLOCK`` members and ``BLOCK_BYTES`` at most.
    """
    names = small(label.withColumnRenamed("v", "rid"), label.count())
    own = cut(nodes.join(names, "rid", "left").select("node", "rid", "n", F.coalesce("c", "rid").alias("c")), where)
    by = own.groupBy("node", "c").agg(F.count("*").alias("m"), F.sum("n").alias("s"), F.min(F.struct(F.xxhash64("node", "rid"), "rid", "n")).alias("h"))
    stats = by.groupBy("node").agg(F.sum("m").alias("total"), F.sum("s").alias("all"), F.count("*").alias("comps"), F.max(F.struct("m", "s", "c", "h")).alias("top")).where("comps > 1")
    blocks = lambda m, s: F.ceil(F.greatest(m / F.lit(BLOCK), 8 * s / F.lit(BLOCK_BYTES)))
    minors, rest = F.col("total") - F.col("top.m"), F.col("all") - F.col("top.s")
    stats = stats.select(
        "node", "total", F.col("top.c").alias("main"), F.col("top.h.rid").alias("hub"), F.col("top.h.n").alias("hn"), minors.alias("minors"),
        blocks(F.col("total"), F.col("all")).alias("blocks"), blocks(minors, rest).alias("minor_blocks"),
    )
    return cut(own.join(stats, "node"), where)


def _stars(nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of a member and the hub of its node, where their sizes allow a link."""
    fit = nodes.where("rid <> hub").where(100 * F.least("n", "hn") >= percent * F.greatest("n", "hn"))
    return fit.select(F.least("rid", "hub").alias("a"), F.greatest("rid", "hub").alias("b")).distinct()


def _clusters(nodes: DataFrame, sets: DataFrame, percent: int, least: float) -> DataFrame:
    """(cluster, rids): members of a node that likely pairs across components hold together.

    One of a pair is outside the node's main component. Members are dealt into blocks by their hash;
    each block of outsiders meets each block of members. A cluster is named by its members, so the
    same one found in several nodes is one row.
    """
    rows = nodes.join(sets.select("rid", "low"), "rid").withColumn("minor", F.col("c") != F.col("main"))
    deal = lambda size: F.pmod(F.xxhash64("rid"), F.col(size)).cast("int")
    packed = [F.collect_list(c).alias(c) for c in ("rid", "n", "c", "low", "minor")]
    member = rows.groupBy("node", deal("blocks").alias("blk")).agg(*packed)
    other = rows.where("minor").groupBy("node", deal("minor_blocks").alias("_blk")).agg(*packed[:4]).withColumnsRenamed({x: f"_{x}" for x in ("rid", "n", "c", "low")})
    met = member.join(other, "node").select("rid", "n", "c", "low", "minor", "_rid", "_n", "_c", "_low")

    def compare(it):
        for b in it:
            keys, found = [], []
            for i in range(b.num_rows):
                ids, ns, cs, lows, minor, ids2, ns2, cs2, lows2 = (b.column(j)[i].as_py() for j in range(9))
                for got in join_blocks(ids, ns, cs, lows, minor, ids2, ns2, cs2, lows2, percent, least):
                    keys.append(xxhash.xxh3_128_digest(b"".join(got)))
                    found.append(got)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.binary()))], names=["cluster", "rids"])

    return met.mapInArrow(compare, "cluster binary, rids array<binary>").dropDuplicates(["cluster"])


def join_blocks(ids, ns, cs, lows, minor, ids2, ns2, cs2, lows2, percent: int, least: float) -> list[list[bytes]]:
    """Clusters (sorted ids) of the members that likely pairs of two blocks hold together."""
    at = {x: i for i, x in enumerate(ids)}
    for x in ids2:
        at.setdefault(x, len(at))
    group = np.arange(len(at))
    hit = np.zeros(len(at), bool)
    number: dict[bytes, int] = {}
    comp, comp2 = (np.array([number.setdefault(c, len(number)) for c in v]) for v in (cs, cs2))
    ns, ns2, minor = np.array(ns), np.array(ns2), np.array(minor)
    x, y = (np.frombuffer(b"".join(v), np.uint8).reshape(len(v), BINS) for v in (lows, lows2))
    order, order2 = (np.array([int.from_bytes(i[:8], "big") for i in v], np.uint64) for v in (ids, ids2))
    for k, other in enumerate(ids2):
        # two outsiders meet in both orders: the smaller id is compared with the larger
        ok = (comp != comp2[k]) & (100 * np.minimum(ns, ns2[k]) >= percent * np.maximum(ns, ns2[k])) & (~minor | (order >= order2[k]))
        near = np.flatnonzero(ok)
        if len(near):
            near = near[estimate(x[near], y[k]) >= least]
        if len(near):
            own = at[other]
            touched = np.unique(group[[own, *near]])
            hit[near] = hit[own] = True
            if len(touched) > 1:
                group[np.isin(group, touched)] = touched[0]
    names = np.array(list(at), object)
    return [sorted(names[hit & (group == g)]) for g in np.unique(group[hit])]


def settle(comps: list, sets: list[bytes], k: int, percent: int, least: float) -> list[tuple[int, int]]:
    """Links that join the components of a cluster's members as far as exact similarity allows.

    Pairs are taken from the likeliest down and checked unless links found before join them already,
    so at most one link less than members comes back, and none that would join more is left out.
    """
    s = [np.frombuffer(b, np.uint64) for b in sets]
    low = np.stack([signature(v, k)[1] for v in s])
    n = np.array([len(v) for v in s])
    number: dict = {}
    group = np.array([number.setdefault(c, len(number)) for c in comps])
    left, right, est = [], [], []
    for i in range(len(s) - 1):
        ok = np.flatnonzero((group[i + 1 :] != group[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= percent * np.maximum(n[i + 1 :], n[i]))) + i + 1
        e = estimate(low[ok], low[i]) if len(ok) else np.empty(0)
        ok, e = ok[e >= least], e[e >= least]
        left.append(np.full(len(ok), i))
        right.append(ok)
        est.append(e)
    left, right, est = (np.concatenate(v) if v else np.empty(0, np.int64) for v in (left, right, est))
    by = np.argsort(-est, kind="stable")
    left, right = left[by], right[by]
    links, step = [], 256
    while len(left):
        for i, j in zip(left[:step].tolist(), right[:step].tolist(), strict=True):
            if group[i] != group[j] and linked(s[i], s[j], percent):
                links.append((i, j))
                group[group == group[j]] = group[i]
        left, right = left[step:], right[step:]
        open_ = group[left] != group[right]
        left, right = left[open_], right[open_]
    return links


def _settled(clusters: DataFrame, label: DataFrame, full: DataFrame, k: int, percent: int, least: float) -> DataFrame:
    """Links (a, b) of a spanning forest of each cluster, confirmed on whole sets."""

    def go(it):
        for b in it:
            a, z = [], []
            for i in range(b.num_rows):
                ids, comps, sets = (b.column(j)[i].as_py() for j in range(3))
                for p, q in settle(comps, sets, k, percent, least):
                    a.append(min(ids[p], ids[q]))
                    z.append(max(ids[p], ids[q]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(z, pa.binary())], names=["a", "b"])

    rows = clusters.select("cluster", F.explode("rids").alias("rid")).join(small(label.withColumnRenamed("v", "rid"), label.count()), "rid", "left")
    rows = rows.withColumn("c", F.coalesce("c", "rid")).join(full, "rid")
    packed = rows.groupBy("cluster").agg(*[F.collect_list(x).alias(x) for x in ("rid", "c", "s")])
    return packed.select("rid", "c", "s").mapInArrow(go, "a binary, b binary").distinct()


# ---- the operator -----------------------------------------------------------------------------


def _judged(docs: DataFrame, doc_id: str, text: str, percent: int, width: int, trees: int, depth: int, leaf: int, k: int, seed: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, component, component_id) of every row; ``component`` is null of what has no links."""
    where = shared_dir(docs.sparkSession)
    rows = cut(sketches(docs, doc_id, text, width, k), where)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # copies are one set, and the row with the smallest id stands for it
    ids = rows.where(F.col("doc_id").isNotNull() & F.col("digest").isNotNull())
    sets = ids.groupBy(F.col("digest").alias("rid")).agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("low").alias("low"))
    sets = cut(sets, where)
    least = percent / 100 - MARGIN

    # the first level: all members meet the hub of their node, which each node chooses by itself
    nodes = _roots(sets, k, trees, 2, seed)
    hubs = nodes.groupBy("node").agg(F.count("*").alias("m"), F.min(F.struct(F.xxhash64("node", "rid"), "rid", "n")).alias("h")).where("m > 1")
    hubs = hubs.select("node", F.col("h.rid").alias("hub"), F.col("h.n").alias("hn"))
    nodes = cut(nodes.join(hubs, "node"), where)
    pending = cut(_alike(_stars(nodes, percent), sets, least), where)
    full = _full_sets(_ends(pending), sets, texts, width, where)
    label = None
    for likeliest in (_by_end, _by_components):
        # the likeliest hub of each member, then the likeliest pair of any two components left
        links = cut(_verified(likeliest(pending, label), full, percent), where)
        label = _merge(label, links, where)

    live, level, ready = _shared(nodes.select("node", "rid", "n"), label, where), 1, []
    while True:
        done = (F.col("minors") * F.col("total") <= leaf * leaf) | F.lit(level >= depth)
        ready.append(live.where(done))
        open_ = live.where(~done)
        if level >= depth or open_.limit(1).count() == 0:
            break
        kids = cut(_children(open_.join(sets.select("rid", "sig"), "rid"), k, 1 + (level + 1) % 2, seed + level), where)
        live = _shared(kids, label, where)
        level += 1
        # members outside a large node's main component meet its hub before the node is compared
        large = live.where(F.col("minors") * F.col("total") > leaf * leaf).where("c <> main")
        stars = cut(_alike(_stars(large, percent), sets, least), where)
        if stars.limit(1).count():
            more = cut(_verified(_by_components(stars, label), _full_sets(_ends(stars), sets, texts, width, where), percent), where)
            if more.limit(1).count():
                label = _merge(label, more, where)
                live = _shared(kids, label, where)

    left = ready[0]
    for r in ready[1:]:
        left = left.unionByName(r)
    clusters = cut(_clusters(left, sets, percent, least), where)
    members = clusters.select(F.explode("rids").alias("rid")).distinct()
    links = cut(_settled(clusters, label, _full_sets(members, sets, texts, width, where), k, percent, least), where)
    if links.limit(1).count():
        label = _merge(label, links, where)

    # a row finds its set, the set its component, the component its smallest id
    least_id = sets.select("rid", "doc_id").join(label.withColumnRenamed("v", "rid"), "rid").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    named = label.join(least_id, "c").select(F.col("v").alias("rid"), "c", "component_id")
    comp = sets.select("rid", "doc_id").join(named, "rid", "left")
    comp = cut(comp.select(F.col("rid").alias("digest"), F.coalesce("c", "rid").alias("component"), F.coalesce("component_id", "doc_id").alias("component_id")), where)
    out = rows.select("doc_id", "text_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(comp, "digest", "left")
    return out.select("doc_id", "text_key", "n_shingles", "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def _by_end(pairs: DataFrame, label: DataFrame | None) -> DataFrame:
    """For each set the pair (a, b) of highest estimate."""
    ends = pairs.select(F.col("a").alias("v"), F.struct("est", "a", "b").alias("p")).unionByName(pairs.select(F.col("b").alias("v"), F.struct("est", "a", "b").alias("p")))
    return ends.groupBy("v").agg(F.max("p").alias("p")).select("p.a", "p.b").distinct()


def _by_components(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """For any two components the pair (a, b) of highest estimate between them."""
    at = _labelled(pairs, label).where("ca <> cb")
    return at.groupBy(F.least("ca", "cb").alias("x"), F.greatest("ca", "cb").alias("y")).agg(F.max(F.struct("est", "a", "b")).alias("p")).select("p.a", "p.b")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = 75,
    width: int = 5,
    trees: int = 8,
    depth: int = 7,
    leaf: int = 2000,
    k: int = 64,
    seed: int = 7,
) -> DataFrame:
    """Components of the documents linked by a shingle similarity of ``percent`` or more.

    Returns a row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable)
    and kept. A null or empty text or a null id is linked with nothing; the component of a null id is
    null, and such rows are kept. A row that repeats an id is judged by its own text. Extra columns
    are ignored. ``leaf`` squared bounds the comparisons of a node that is compared before ``depth``.
    """
    out = _judged(docs, doc_id, text, percent, width, trees, depth, leaf, k, seed).select("doc_id", "n_shingles", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = 75, width: int = 5, trees: int = 8, depth: int = 7, leaf: int = 2000, k: int = 64, seed: int = 7) -> DataFrame:
    """One row of each group of near-duplicates, with the columns it came with: that of the smallest id.

    Rows with a null id stay, and so do texts without words, one row for each id. Of rows that repeat
    an id in one group, that of the smallest MD5 of the text stays; of equal rows, any one.
    """
    where = shared_dir(docs.sparkSession)
    rows = _judged(docs, doc_id, text, percent, width, trees, depth, leaf, k, seed).where("doc_id = component_id")
    times = rows.groupBy("doc_id", "text_key", "component").agg(F.count("*").alias("times"))
    alone = F.when(F.col("component").isNull(), F.col("doc_id"))
    kept = times.groupBy("component", alone.alias("_a")).agg(F.min(F.struct("doc_id", "text_key", "times")).alias("k"))
    kept = cut(kept.select(F.col("k.doc_id").alias("_id"), F.col("k.text_key").alias("_key"), F.col("k.times").alias("_times")), where)
    # columns by their frames: the documents may have columns of the same names
    own = lambda rows: docs.join(rows, (docs[doc_id] == rows["_id"]) & (text_key(docs[text]) == rows["_key"]), "left_semi")
    out = own(kept.where("_times = 1")).unionByName(docs.where(F.col(doc_id).isNull()))
    again = kept.where("_times > 1")
    return out.unionByName(own(again).dropDuplicates([doc_id, text])) if again.limit(1).count() else out
