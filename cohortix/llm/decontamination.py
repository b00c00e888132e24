"""Benchmark decontamination by size-partitioned MinHash containment search, verified exactly.

DataFrame operations only. A benchmark item of n distinct shingles is contained in a document when
at least t*n of them occur there. Its MinHash sketch is its k smallest shingle hashes with
``k = n - ceil(t*n) + 1``: a document that holds t*n of the n shingles misses at most k - 1 of
them, so it holds one of the k smallest. Items fall into partitions by the logarithm of their size.
Each partition has a hash bound, the largest sketch value in it, and a least size. A document probes
only the partitions whose least size its own set can hold, each with its hashes within that
partition's bound, and the search joins on partition and hash. Candidates lose no containment; they
are then verified on the full shingle sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, shared_dir

#: Bytes that separate words, each turned into a space before the split.
_SPACES = "\t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, split at ASCII white space, null as no words."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER + _SPACES, _LOWER + " " * len(_SPACES))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def shingle_hashes(w: Column, width: int) -> Column:
    """64-bit hashes of the shingles of ``width`` words, in text order; [] for shorter texts."""
    return F.when(
        F.size(w) >= width,
        F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.xxhash64(*[F.get(w, i + (j - 1)) for j in range(width)])),
    ).otherwise(F.array().cast("array<bigint>"))


def hash_set(w: Column, widths: list[int]) -> Column:
    """Distinct shingle hashes of all ``widths``; the number of words is part of what is hashed."""
    return F.array_distinct(F.concat(*[shingle_hashes(w, v) for v in widths]))


def item_sets(items: DataFrame, threshold: float, width: int, item_id: str, text: str) -> tuple[DataFrame, list[int]]:
    """(item_id, _set, _n, _need) of the items, and the shingle widths that occur in them.

    An item of fewer than ``width`` words is one shingle of all its words. The texts of an id that
    comes again are one set.
    """
    it = items.select(F.col(item_id).alias("item_id"), word_array(F.col(text)).alias("_w")).where(F.col("item_id").isNotNull() & (F.size("_w") > 0))
    it = it.withColumn("_width", F.least(F.size("_w"), F.lit(width)))
    widths = sorted(r[0] for r in it.select("_width").distinct().collect())  # at most ``width`` values
    own = F.array().cast("array<bigint>")
    for v in widths:
        own = F.when(F.col("_width") == v, shingle_hashes(F.col("_w"), v)).otherwise(own)
    sets = it.select("item_id", own.alias("_s")).groupBy("item_id").agg(F.array_distinct(F.flatten(F.collect_list("_s"))).alias("_set"))
    return sets.withColumn("_n", F.size("_set")).withColumn("_need", F.ceil(F.col("_n") * F.lit(threshold)).cast("int")), widths


def size_partitions(sets: DataFrame) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """Sketches (_part, _h, item_id), and each partition with its hash bound and least needed size.

    The order of the signed hashes is as good a random order as any.
    """
    part = F.floor(F.log2("_n")).cast("int").alias("_part")
    sketch = sets.select("item_id", part, "_need", F.explode(F.slice(F.sort_array("_set"), F.lit(1), F.col("_n") - F.col("_need") + 1)).alias("_h"))
    bounds = sketch.groupBy("_part").agg(F.max("_h"), F.min("_need")).collect()  # a row for each power of two
    return sketch.select("_part", "_h", "item_id"), sorted((r[0], r[1], r[2]) for r in bounds)


def probes_of(hashes: Column, bounds: list[tuple[int, int, int]]) -> Column:
    """(_part, _h) structs with which a document's hash set probes the partitions it can answer for."""
    none = F.array().cast("array<struct<_part:int,_h:bigint>>")

    def own(part: int, bound: int, least: int) -> Column:
        within = F.transform(F.filter(hashes, lambda h: h <= F.lit(bound)), lambda h: F.struct(F.lit(part).alias("_part"), h.alias("_h")))
        return F.when(F.size(hashes) >= least, within).otherwise(none)

    return F.concat(*[own(*b) for b in bounds])


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.75,
    width: int = 5,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item it contains.

    Returns doc_id, item_id, n_item_shingles, n_shared and containment (>= ``threshold``), one row
    per pair of ids. Null or empty texts and null ids contain nothing and are contained nowhere.
    An item of fewer than ``width`` words is one shingle of its own width and is looked up among
    the documents' shingles of that width. The texts of an id that comes again, of an item or of a
    document, count as one set. Extra columns are ignored.
    """
    where = shared_dir(docs.sparkSession)
    sets, widths = item_sets(items, threshold, width, item_id, text)
    if not widths:
        return docs.sparkSession.createDataFrame([], _result_type(docs, items, doc_id, item_id))
    sets = cut(sets, where)
    sketch, bounds = size_partitions(sets)
    sketch = cut(sketch, where)
    n_probes = sketch.count()

    base = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), word_array(F.col(text)).alias("_w"))
    hashed = base.select("doc_id", hash_set(F.col("_w"), widths).alias("_have"))
    sent = hashed.select("doc_id", F.explode(probes_of(F.col("_have"), bounds)).alias("_p")).select("doc_id", "_p._part", "_p._h")
    found = sent.join(F.broadcast(sketch) if n_probes <= 10 * BROADCAST_ROWS else sketch, ["_part", "_h"])
    cand = cut(found.select("doc_id", "item_id").distinct(), where)
    n_cand = cand.count()

    # Exact verification: the candidates' whole texts against the items' whole sets.
    ids = cand.select("doc_id").distinct()
    ids = F.broadcast(ids) if n_cand <= BROADCAST_ROWS else ids
    full = hashed.join(ids, "doc_id", "left_semi")
    pairs = cand.join(F.broadcast(sets) if n_probes <= BROADCAST_ROWS else sets, "item_id")
    pairs = F.broadcast(pairs) if n_cand <= BROADCAST_ROWS // 20 else pairs
    shared = full.join(pairs, "doc_id").select("doc_id", "item_id", "_n", "_need", F.array_intersect("_set", "_have").alias("_both"))
    return (
        shared.groupBy("doc_id", "item_id", "_n", "_need")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("_both")))).cast("long").alias("n_shared"))
        .where("n_shared >= _need")
        .select("doc_id", "item_id", F.col("_n").cast("long").alias("n_item_shingles"), "n_shared", (F.col("n_shared") / F.col("_n")).alias("containment"))
    )


def _result_type(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str) -> str:
    kinds = dict(docs.dtypes)[doc_id], dict(items.dtypes)[item_id]
    return f"doc_id {kinds[0]}, item_id {kinds[1]}, n_item_shingles bigint, n_shared bigint, containment double"


def drop_contaminated(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that contain no item, with the columns they came with. Null ids stay."""
    key = kw.get("doc_id", "doc_id")
    bad = cut(contained_items(docs, items, **kw).select(F.col("doc_id").alias("_bad")).distinct())
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    return docs.join(bad, docs[key] == bad["_bad"], "left_anti")
