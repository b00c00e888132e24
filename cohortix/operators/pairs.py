"""Pairs of samples by blocks: packed genotypes, sample block times sample block inside one task.

Where samples share many variants, calls become blocks of 1,024 samples by 4,096 variants: three bit planes (0, 1 and
2 ALT alleles), or a list of calls where that is smaller. A task gets all blocks of two sample blocks over a range of
variants, counts joint states of all its pairs by population counts, and only the pairs that are asked for leave it.
Blocks are sent to as many tasks as there are sample blocks; no row is made for a pair and a variant.

Where joint calls are fewer than pairs of samples, only pairs that share a variant are looked at: sixteen sample blocks,
or so many that one has at most 12 million calls, are lists, so that the lists are sent sixteen times whatever the
number of samples. A task holds one block as an index by variant; pieces of the other pass it, some samples at a time.

Calls that are null or outside 0 to 2 count as missing; rows without a sample or variant are left out; of repeated
calls the largest counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cutpoint import cut
from .dedup import numbered
from .genotype import KINSHIP_CUTS, relationship


class Sizes(NamedTuple):
    """Samples and variants of a block; variant blocks that a task reads for two sample blocks (its memory is these
    twice); joint calls that two lists may make at once, beyond which their blocks are multiplied as planes."""

    samples: int = 1_024
    variants: int = 4_096
    span: int = 16
    joint: int = 20_000_000


class Lists(NamedTuple):
    """Sample blocks that a long list is cut into; calls of a block that are worth one of their own, and at most, which
    a task holds in 8 bytes each; calls of a packed piece; joint calls that a task holds at once."""

    blocks: int = 16
    least: int = 100_000
    most: int = 12_000_000
    piece: int = 250_000
    joint: int = 1_000_000


def _pack(t: pa.Table, z: Sizes) -> pa.Table:
    """One block from its calls (sb, vb, s, v, g)."""
    sb, vb = t.column("sb")[0], t.column("vb")[0]
    s, v, g = (t.column(c).to_numpy() for c in "svg")
    if len(s) * 5 < 3 * z.samples * z.variants // 8:
        order = np.lexsort((-g, s, v))
        s, v, g = s[order], v[order], g[order]
        first = np.concatenate([[True], (s[1:] != s[:-1]) | (v[1:] != v[:-1])])
        data = b"".join((v[first].astype(np.uint16).tobytes(), s[first].astype(np.uint16).tobytes(), g[first].astype(np.uint8).tobytes()))
        n = int(first.sum())
    else:
        cell = np.full((z.samples, z.variants), 3, np.uint8)
        for k in (0, 1, 2):
            cell[s[g == k], v[g == k]] = k
        data = b"".join(np.packbits(cell == k, axis=1, bitorder="little").tobytes() for k in (0, 1, 2))
        n = -1
    return pa.table({"sb": pa.array([sb.as_py()], pa.int32()), "vb": pa.array([vb.as_py()], pa.int32()), "n": pa.array([n], pa.int32()), "data": pa.array([data], pa.binary())})


class Block:
    """A packed block; ``calls`` are sorted by variant, ``planes`` are (3, samples, words)."""

    def __init__(self, n: int, data: bytes, z: Sizes):
        self.calls, self._planes, self.z = None, None, z
        if n < 0:
            self._planes = np.frombuffer(data, np.uint64).reshape(3, z.samples, -1)
        else:
            self.calls = np.frombuffer(data, np.uint16, n), np.frombuffer(data, np.uint16, n, 2 * n), np.frombuffer(data, np.uint8, n, 4 * n)

    @property
    def planes(self) -> np.ndarray:
        if self._planes is None:
            v, s, g = self.calls
            cell = np.zeros((3, self.z.samples, self.z.variants), bool)
            cell[g, s, v] = True
            self._planes = np.packbits(cell, axis=2, bitorder="little").view(np.uint64)
        return self._planes

    def hets(self) -> np.ndarray:
        if self.calls:
            return np.bincount(self.calls[1][self.calls[2] == 1], minlength=self.z.samples)
        return np.bitwise_count(self.planes[1]).sum(1, dtype=np.int64)


def _lists(a: Block, b: Block, counts: np.ndarray) -> bool:
    """Add the joint calls of two lists; False where they are too many."""
    (va, sa, ga), (vb, sb, gb) = a.calls, b.calls
    lo, hi = np.searchsorted(vb, va), np.searchsorted(vb, va, "right")
    n = hi - lo
    if (total := int(n.sum())) > a.z.joint:
        return False
    i = np.repeat(np.arange(len(va)), n)
    j = np.arange(total) - np.repeat(np.cumsum(n) - n - lo, n)
    size = a.z.samples
    at, x, y = sa[i].astype(np.int64) * size + sb[j], ga[i], gb[j]
    for k, sel in enumerate(((x == 1) & (y == 1), (x + y == 2) & (x != y), slice(None))):
        counts[k] += np.bincount(at[sel], minlength=size * size).reshape(size, size)
    return True


def _planes(a: Block, b: Block, counts: np.ndarray) -> None:
    x, y = a.planes, b.planes
    called_x, called_y = x[0] | x[1] | x[2], y[0] | y[1] | y[2]
    for i in np.flatnonzero(called_x.any(1)):
        for k, both in enumerate((y[1] & x[1, i], (y[0] & x[2, i]) | (y[2] & x[0, i]), called_y & called_x[i])):
            counts[k, i] += np.bitwise_count(both).sum(1, dtype=np.int32)


def _empty(z: Sizes) -> tuple[np.ndarray, np.ndarray]:
    return np.zeros((3, z.samples, z.samples), np.int32), np.zeros((2, z.samples), np.int64)


def _joint(t: pa.Table, z: Sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts (both heterozygous, opposite homozygous, both called) and heterozygotes of either side."""
    counts, own = _empty(z)
    sides: dict[int, dict[int, Block]] = {0: {}, 1: {}}
    for vb, right, n, data in zip(*(t.column(c).to_pylist() for c in ("vb", "right", "n", "data")), strict=True):
        block = Block(n, data, z)
        for k in (0, 1) if t.column("i")[0].as_py() == t.column("j")[0].as_py() else (int(right),):
            sides[k][vb] = block
            own[k] += block.hets()
    for vb in sorted(set(sides[0]) & set(sides[1])):
        a, b = sides[0][vb], sides[1][vb]
        if a.calls is None or b.calls is None or not _lists(a, b, counts):
            _planes(a, b, counts)
    return counts, own[0], own[1]


#: What is asked of pairs that share a heterozygous call: numbers of the first and second samples, counts (both
#: heterozygous, opposite homozygous, both called) and heterozygotes of either, to a table.
Finish = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], pa.Table]


def _pairs_of(mask: np.ndarray, a_at: np.ndarray, b_at: np.ndarray, counts: np.ndarray, na: np.ndarray, nb: np.ndarray) -> pa.Table:
    cols = {"a_at": a_at, "b_at": b_at, "het_het": counts[0], "ibs0": counts[1], "n_sites": counts[2], "na": na, "nb": nb}
    return pa.table({k: pa.array(v[mask].astype(np.int64)) for k, v in cols.items()})


_PAIRS = "a_at long, b_at long, het_het long, ibs0 long, n_sites long, na long, nb long"


def compare(calls: DataFrame, finish: Finish, schema: str, z: Sizes = Sizes(), lists: Lists = Lists()) -> tuple[DataFrame, DataFrame]:
    """What ``finish`` makes of the pairs of two sample blocks, and the samples (sample, at) by their numbers.

    Of two samples the first is before the second in the order of ids.
    """
    g = F.col("alt_count")
    c = cut(calls.where(g.between(0, 2) & F.col("sample").isNotNull() & F.col("variant").isNotNull()).select("sample", "variant", g.cast("tinyint").alias("g")))
    samples = cut(numbered(c.select("sample").distinct(), ["sample"], "at"))
    variants = cut(numbered(c.groupBy("variant").agg(F.count("*").alias("_n")), ["variant"], "_v"))
    n = samples.count()
    m, total, joint = variants.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.col("_n") * (F.col("_n") - 1.0) / 2), F.lit(0.0))).first()
    rows = c.join(samples, "sample").join(variants.drop("_n"), "variant").select("at", "_v", "g")
    if joint <= n * n / 2:
        return _by_lists(rows, n, total, finish, schema, lists), samples
    return _by_blocks(rows, n, m, finish, schema, z), samples


def _sides(packed: DataFrame, last: int, *columns: Column | str) -> DataFrame:
    """Every block beside every block: ``i`` and ``j``, and whether it is the second of the two."""
    other = packed.withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(last))))
    return other.select(F.least("sb", "o").alias("i"), F.greatest("sb", "o").alias("j"), (F.col("sb") > F.col("o")).alias("right"), *columns)


def _by_blocks(rows: DataFrame, n: int, m: int, finish: Finish, schema: str, z: Sizes) -> DataFrame:
    block = lambda at, size: (F.floor(F.col(at) / size).cast("int"), (F.col(at) % size).cast("int"))
    (sb, s), (vb, v) = block("at", z.samples), block("_v", z.variants)
    packed = cut(rows.select(sb.alias("sb"), vb.alias("vb"), s.alias("s"), v.alias("v"), "g").groupBy("sb", "vb").applyInArrow(lambda t: _pack(t, z), "sb int, vb int, n int, data binary"))
    sides = _sides(packed, max(0, -(-n // z.samples) - 1), F.floor(F.col("vb") / z.span).cast("int").alias("vr"), "vb", "n", "data")

    def done(i: int, j: int, counts: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
        x, y = np.nonzero((counts[0] > 0) & _once(i, j, len(a)))
        return finish(i * len(a) + x, j * len(b) + y, counts[:, x, y], a[x], b[y])

    if m <= z.span * z.variants:

        def all_of(t: pa.Table) -> pa.Table:
            return done(t.column("i")[0].as_py(), t.column("j")[0].as_py(), *_joint(t, z))

        return sides.groupBy("i", "j").applyInArrow(all_of, schema)

    def part(t: pa.Table) -> pa.Table:
        counts, a, b = _joint(t, z)
        return pa.table({"i": t.column("i")[:1], "j": t.column("j")[:1], "counts": pa.array([counts.tobytes()], pa.binary()), "own": pa.array([np.stack([a, b]).tobytes()], pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        counts, own = _empty(z)
        for x, y in zip(t.column("counts"), t.column("own"), strict=True):
            counts += np.frombuffer(x.as_buffer(), np.int32).reshape(counts.shape)
            own += np.frombuffer(y.as_buffer(), np.int64).reshape(own.shape)
        return done(t.column("i")[0].as_py(), t.column("j")[0].as_py(), counts, *own)

    parts = sides.groupBy("i", "j", "vr").applyInArrow(part, "i int, j int, counts binary, own binary")
    return parts.groupBy("i", "j").applyInArrow(add, schema)


def _once(i: int, j: int, n: int) -> np.ndarray | bool:
    """Each pair of a block with itself once."""
    return np.triu(np.ones((n, n), bool), 1) if i == j else True


def _bytes(x: np.ndarray) -> bytes:
    """All first bytes, then all second ones and so on, which compresses well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _whole(data: memoryview, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, 4 * n).reshape(4, n).T).view("<u4").ravel()


def _listed(t: pa.Table) -> pa.Table:
    """A piece of a sample block: steps of variants, samples and counts by variant; of repeated calls the largest."""
    s, v, g = (t.column(c).to_numpy() for c in "svg")
    order = np.lexsort((-g, s, v))
    s, v, g = s[order], v[order], g[order]
    first = np.concatenate([[True], (s[1:] != s[:-1]) | (v[1:] != v[:-1])])
    data = _bytes(np.diff(v[first], prepend=0)) + _bytes(s[first]) + g[first].astype(np.uint8).tobytes()
    return pa.table({"sb": t.column("sb")[:1], "n": pa.array([int(first.sum())], pa.int32()), "data": pa.array([pa.compress(data, codec="zstd", asbytes=True)], pa.binary())})


def _unlisted(n: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Variants, samples and counts of a piece by variant."""
    x = memoryview(pa.decompress(data, 9 * n, codec="zstd"))
    return np.cumsum(_whole(x, n), dtype=np.uint64), _whole(x[4 * n :], n), np.frombuffer(x, np.uint8, n, 8 * n)


def _index(pieces: list[tuple[int, bytes]], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Calls of a sample block as sorted numbers of variant, sample and count (32, 30 and 2 bits), and heterozygotes."""
    calls, hets, at = np.empty(sum(n for n, _ in pieces), np.uint64), np.zeros(size, np.int64), 0
    for n, data in pieces:
        v, s, g = _unlisted(n, data)
        calls[at : at + n] = v << 32 | s.astype(np.uint64) << 2 | g
        hets += np.bincount(s[g == 1], minlength=size)
        at += n
    calls.sort()
    return calls, hets


def _states(ga: np.ndarray, gb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both heterozygous, opposite homozygous."""
    return (ga == 1) & (gb == 1), np.abs(ga - gb) == 2


def _met(piece: tuple[np.ndarray, np.ndarray, np.ndarray], calls: np.ndarray, size: int, same: bool, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of samples of a piece and of an index, and their counts; about ``most`` joint calls at once."""
    v, s, g = piece
    lo = np.searchsorted(calls, v << 32)
    many = np.searchsorted(calls, v + 1 << 32) - lo
    order = np.flatnonzero(many)
    order = order[np.argsort(s[order], kind="stable")]
    s, g, lo, many = s[order].astype(np.int64), g[order].astype(np.int64), lo[order], many[order]
    ends = np.flatnonzero(np.concatenate([s[1:] != s[:-1], np.ones(min(1, len(s)), bool)])) + 1  # of the samples' calls
    before = np.cumsum(many)

    def joint(at: int, end: int) -> tuple[np.ndarray, ...]:
        x = np.repeat(np.arange(at, end), many[at:end])
        y = np.arange(len(x)) + np.repeat(lo[at:end] - before[at:end] + many[at:end] + (before[at - 1] if at else 0), many[at:end])
        own = (calls[y] & 0xFFFFFFFF).astype(np.int64)
        return s[x], own >> 2, g[x], own & 3

    at = 0
    while at < len(s):  # at least one sample
        done = before[at - 1] if at else 0
        fit = np.searchsorted(before[ends - 1], done + most, "right")
        end = int(ends[max(fit - 1, np.searchsorted(ends, at, "right"))])
        if before[end - 1] - done > most:  # one sample, by parts
            counts, a = np.zeros((3, size), np.int64), s[at]
            while at < end:
                stop = min(end, max(at + 1, int(np.searchsorted(before, (before[at - 1] if at else 0) + most, "right"))))
                _, b, ga, gb = joint(at, stop)
                for k, w in enumerate((*_states(ga, gb), slice(None))):
                    counts[k] += np.bincount(b[w], minlength=size)
                at = stop
            b = np.flatnonzero(counts[0])
            b = b[b > a] if same else b
            yield np.full(len(b), a), b, counts[:, b]
            continue
        a, b, ga, gb = joint(at, end)
        at, key = end, (a * size + b) * 16 + ga * 4 + gb
        if same:
            key = key[a < b]
        if not len(key):
            continue
        key.sort()
        pair = key >> 4
        start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        states = _states(key >> 2 & 3, key & 3)
        counts = np.stack([*(np.add.reduceat(w, start, dtype=np.int64) for w in states), np.diff(np.append(start, len(key)))])
        pair, some = pair[start], counts[0] > 0
        yield pair[some] // size, pair[some] % size, counts[:, some]


def _by_lists(rows: DataFrame, n: int, total: int, finish: Finish, schema: str, z: Lists) -> DataFrame:
    k = max(1, min(z.blocks, -(-total // z.least)), -(-total // z.most))
    size = max(1, -(-n // k))
    last = max(0, -(-n // size) - 1)
    width = max(1, -(-size // max(1, -(-total // (k * z.piece)))))  # samples of a piece
    s = F.col("at") % size
    at = rows.select(F.floor(F.col("at") / size).cast("int").alias("sb"), F.floor(s / width).cast("int").alias("ss"), s.cast("int").alias("s"), F.col("_v").alias("v"), "g")
    packed = cut(at.groupBy("sb", "ss").applyInArrow(_listed, "sb int, n int, data binary"))
    sides = F.concat(
        F.transform(F.sequence(F.lit(0), "sb"), lambda o: F.struct(o.alias("i"), F.col("sb").alias("j"), F.lit(False).alias("left"))),
        F.transform(F.sequence("sb", F.lit(last)), lambda o: F.struct(F.col("sb").alias("i"), o.alias("j"), F.lit(True).alias("left"))),
    )
    sent = packed.select(F.explode(sides).alias("x"), "n", "data").select("x.*", "n", "data")
    # a task holds one block as an index; the pieces of the other, which are whole samples, pass it
    dealt = sent.repartitionById((last + 1) * (last + 2) // 2, (F.col("j") * (F.col("j") + 1) / 2 + F.col("i")).cast("int")).sortWithinPartitions("i", "j", "left")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, index = None, [], None
        for batch in batches:
            for row in range(batch.num_rows):
                i, j, left, *piece = (batch.column(c)[row].as_py() for c in ("i", "j", "left", "n", "data"))
                if at != (i, j):
                    at, held, index = (i, j), [], None
                if not left:
                    held.append(piece)
                    continue
                if index is None:
                    index, held = _index(held, size), []
                own = _unlisted(*piece)
                hets = np.bincount(own[1][own[2] == 1], minlength=size)
                for a, b, counts in _met(own, index[0], size, i == j, z.joint):
                    yield from finish(i * size + a, j * size + b, counts, hets[a], index[1][b]).to_batches()

    return dealt.mapInArrow(joined, schema)


def _named(pairs: DataFrame, samples: DataFrame) -> DataFrame:
    name = lambda new: samples.select(F.col("sample").alias(new), F.col("at").alias(f"{new}_at"))
    return pairs.join(name("a"), "a_at").join(name("b"), "b_at")


def kinship(calls: DataFrame, least: float = 0.0442, sizes: Sizes = Sizes(), lists: Lists = Lists()) -> DataFrame:
    """KING-robust kinship of the pairs of samples over ``least`` (0 or more): (a, b, n_sites, het_het, ibs0, kinship, relationship).

    phi = (het-het - 2 * opposite homozygotes) / (het_i + het_j); Manichaikul 2010, between families. Every pair that
    shares a heterozygous call is compared, and no other can be over 0; rows out are as many as related pairs.
    """

    def finish(a_at, b_at, counts, na, nb):
        return _pairs_of(counts[0] - 2 * counts[1] > least * (na + nb), a_at, b_at, counts, na, nb)

    pairs, samples = compare(calls, finish, _PAIRS, sizes, lists)
    k = _named(pairs, samples).withColumn("kinship", (F.col("het_het") - 2 * F.col("ibs0")) / (F.col("na") + F.col("nb"))).where(F.col("kinship") > least)
    return k.select("a", "b", "n_sites", "het_het", "ibs0", "kinship").withColumn("relationship", relationship("kinship"))


def _members(own: DataFrame) -> DataFrame:
    return own.select(F.col("sample"), F.col("variant"), F.lit(1).alias("alt_count"))


def shared(own: DataFrame, least: int = 1) -> DataFrame:
    """Pairs of owners of ``own`` (sample, variant) with at least ``least`` things in common: (a, b, n_shared, share).

    ``share`` is of the smaller owner's things.
    """

    def finish(a_at, b_at, counts, na, nb):
        return _pairs_of(counts[0] >= max(1, least), a_at, b_at, counts, na, nb)

    pairs, samples = compare(_members(own), finish, _PAIRS)
    return _named(pairs, samples).select("a", "b", F.col("het_het").alias("n_shared"), (F.col("het_het") / F.least("na", "nb")).alias("share"))


def degree_counts(own: DataFrame, cuts: tuple = KINSHIP_CUTS) -> DataFrame:
    """(relationship, n_pairs) over all pairs that share anything, counted where the pairs are compared."""
    names = [name for _, name in cuts] + ["unrelated"]

    def finish(a_at, b_at, counts, na, nb):
        share = counts[0] / np.minimum(na, nb)
        at = np.argmax(np.stack([*(share > c for c, _ in cuts), np.ones(len(share), bool)]), axis=0)
        return pa.table({"relationship": pa.array(names), "n": pa.array(np.bincount(at, minlength=len(names)))})

    got, _ = compare(_members(own), finish, "relationship string, n long")
    return got.groupBy("relationship").agg(F.sum("n").alias("n_pairs")).where("n_pairs > 0")
