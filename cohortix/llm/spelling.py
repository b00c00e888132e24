"""Grouping of spelling variants by blocked Gram matrices of letter counts.

Words are counted inside the tasks first. Words of one length and of equal counts in four letter classes form blocks of
bounded size. One edit leaves the length or adds one, and moves a count of one class, so a block meets only the
blocks of its own and of fifteen neighbouring keys: none of the other pairs can be near. A meeting of two blocks is a
matrix product that gives all squared distances between letter counts; pairs at one or two are verified letter by
letter, and what leaves the task is a row a word: how many words are near and which of them is the most frequent.

Defined results: null and empty texts have no words; rows that repeat count again; a null id is written as nothing
before the colon; an empty table gives no rows; extra columns are ignored; words of any length are compared whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small, texts_of

#: Letter classes of about the same weight; all other letters are a fifth class. They decide speed, not results.
CLASSES = ("ea", "tns", "oiu", "rlh")
#: Words in a block, and letters in it, at most on average.
BLOCK, LETTERS = 4_096, 2_000_000
#: Distinct words that a counting task holds before it sends them on.
HELD = 300_000
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Code points by column of a count matrix: a-z, then U+00C0 to U+00FF.
LETTER = np.zeros(256, np.uint8)
LETTER[97:123], LETTER[192:256] = np.arange(26), np.arange(26, 90)
WIDTH = 90
NEAR = "word string, n_near long, best_n long, best string"


# ---- words ------------------------------------------------------------------------------------


def _count(least_length: int, slip: int):
    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        crc32 = zlib.crc32

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return b

        for b in it:
            for i, text in zip(b.column(0).to_pylist(), texts_of(b.column(1)), strict=True):
                start = crc32(f"{'' if i is None else i}:".encode())
                for w, n in Counter(RUN.findall(text.lower().decode())).items():
                    h = crc32(w.encode(), start)
                    if h % slip == 0:
                        k = h % len(w)
                        w = w[:k] + w[k + 1 :]
                    if len(w) >= least_length:
                        held[w] = held.get(w, 0) + n
                if len(held) >= HELD:
                    yield out()
        if held:
            yield out()

    return count


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_length: int = 5, least_count: int = 3, slip: int = 97) -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased; where ``slip`` divides the crc32 of ``id:run``, one letter is left out."""
    rows = docs.select(F.col(doc_id).cast("string"), F.col(text).cast("string").alias("text")).mapInArrow(_count(least_length, slip), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# ---- blocks -----------------------------------------------------------------------------------


def _deltas() -> list[tuple[int, ...]]:
    """Changes of (length, counts of the classes) by one edit; of a change and its reverse only one."""
    k = len(CLASSES)
    one = [tuple(int(j == i) for j in range(k)) for i in range(k)] + [(0,) * k]
    moved = {(0, *(x - y for x, y in zip(a, b, strict=True))) for a in one for b in one}
    return [d for d in sorted(moved) if d >= (0,) * (k + 1)] + [(1, *x) for x in one]


def _key(counts: list[Column]) -> Column:
    return F.concat_ws(":", *[c.cast("string") for c in counts])


def blocks(words: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Blocks (counts, key, split, words in order, their numbers) and the number of splits of each key."""
    counts = [F.length("word"), *[F.length("word") - F.length(F.translate("word", c, "")) for c in CLASSES]]
    named = [f"c{i}" for i in range(len(counts))]
    w = words.select("word", "n", *[c.cast("int").alias(k) for c, k in zip(counts, named, strict=True)])
    w = w.withColumn("key", _key([F.col(c) for c in named]))
    most = F.greatest(F.lit(1), F.least(F.lit(size), F.floor(F.lit(LETTERS) / F.col("c0"))))
    splits = cut(w.groupBy("key", "c0").agg(F.count("*").alias("n")).select("key", F.ceil(F.col("n") / most).cast("int").alias("splits")))
    w = w.join(small(splits, splits.count()), "key").withColumn("split", F.pmod(F.xxhash64("word"), F.col("splits")).cast("int"))
    rows = w.groupBy("key", "split", *named).agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("w"))
    return cut(rows.select(*named, "key", "split", F.col("w.word").alias("words"), F.col("w.n").alias("n"))), splits


def _meetings(own: DataFrame, splits: DataFrame) -> DataFrame:
    """A row for each two blocks that may hold near words; a block meets itself once."""
    named = [f"c{i}" for i in range(len(CLASSES) + 1)]
    deltas = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(d)]) for d in _deltas()])
    left = own.withColumn("d", F.explode(deltas))
    left = left.select("key", "split", F.col("words").alias("words_a"), F.col("n").alias("n_a"), _key([F.col(c) + F.col(f"d.d{i}") for i, c in enumerate(named)]).alias("other"))
    there = splits.withColumnsRenamed({"key": "other", "splits": "others"})
    left = left.join(small(there, splits.count()), "other").withColumn("other_split", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    left = left.where((F.col("key") != F.col("other")) | (F.col("split") <= F.col("other_split")))
    right = own.select(F.col("key").alias("other"), F.col("split").alias("other_split"), F.col("words").alias("words_b"), F.col("n").alias("n_b"))
    same = (F.col("key") == F.col("other")) & (F.col("split") == F.col("other_split"))
    return left.join(right.hint("merge"), ["other", "other_split"]).select(same.alias("same"), "words_a", "n_a", "words_b", "n_b")


def _codes(words: list[str]) -> np.ndarray:
    """Letters of words of one length, a row a word."""
    return LETTER[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)].reshape(len(words), -1)


def _counts(codes: np.ndarray) -> np.ndarray:
    flat = (np.arange(len(codes))[:, None] * WIDTH + codes).ravel()
    return np.bincount(flat, minlength=len(codes) * WIDTH).reshape(-1, WIDTH).astype(np.float32)


def _one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of letters, of one length or ``y`` one longer, differ by one edit."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    head = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= x.shape[1]


def near_pairs(a: np.ndarray, b: np.ndarray, stripe: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words of two blocks that differ by one edit, from the letters of each.

    |x - y|^2 - 1.5 is one product of the counts with the norms beside them; it is between -1 and 1 where the
    squared distance is 1 or 2.
    """
    xa, xb = _counts(a), _counts(b)
    left = np.concatenate([xa, (xa * xa).sum(1, keepdims=True), np.ones((len(xa), 1), np.float32)], 1)
    right = np.concatenate([-2 * xb, np.ones((len(xb), 1), np.float32), (xb * xb).sum(1, keepdims=True) - 1.5], 1).T
    found = [(np.empty(0, np.int64),) * 2]
    most = max(1, 4_000_000 // a.shape[1])
    for lo in range(0, len(a), stripe):
        d = left[lo : lo + stripe] @ right
        i, j = np.nonzero(np.abs(d, out=d) < 1)
        i += lo
        for at in range(0, len(i), most):
            p, q = i[at : at + most], j[at : at + most]
            ok = _one_edit(a[p], b[q])
            found.append((p[ok], q[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _best(own: list[str], i: np.ndarray, other: list[str], j: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """For each word with a near one: how many there are, and the most frequent, the first in order among equals."""
    order = np.lexsort((j, -n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]])) if len(i) else np.empty(0, np.int64)
    times = np.diff(np.append(first, len(i)))
    cols = [pa.array([own[x] for x in i[first]], pa.string()), pa.array(times, pa.int64()), pa.array(n[j[first]], pa.int64()), pa.array([other[x] for x in j[first]], pa.string())]
    return pa.RecordBatch.from_arrays(cols, names=["word", "n_near", "best_n", "best"])


def _meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in it:
        for k in range(len(batch)):
            same, a, na, b, nb = (c[k].as_py() for c in batch.columns)
            i, j = near_pairs(_codes(a), _codes(b))
            yield _best(a, i, b, j, np.array(nb, np.int64))
            if not same:
                yield _best(b, j, a, i, np.array(na, np.int64))


# ---- forms and roots --------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round a word takes its root's root, until none changes.

    A form has at least twice the count, so a way to a root is short and has no ring.
    """
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = cut(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = new.drop("moved")
        if new.where("moved").isEmpty():
            return at


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = BLOCK, **counting) -> DataFrame:
    """A row a word: word, form, root, n, n_near, form_n.

    Words are near if one inserted, deleted or replaced letter parts them. ``form`` is the near word of the largest
    count (of equals the first in code-point order), if that is at least twice the word's own.
    """
    words = cut(word_counts(docs, doc_id, text, **counting))
    meetings = _meetings(*blocks(words, size))
    near = meetings.mapInArrow(_meet, NEAR)
    near = near.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best").alias("form"))).alias("b"))
    near = near.select(F.col("word").alias("_w"), "n_near", (-F.col("b.m")).alias("best_n"), "b.form")
    has = F.col("best_n") >= 2 * F.col("n")
    rows = words.join(near, words["word"] == near["_w"], "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
    rows = cut(rows)
    roots = _roots(rows.where("form is not null")).withColumnRenamed("word", "_w")
    return rows.join(roots, rows["word"] == roots["_w"], "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
