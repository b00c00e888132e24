"""UCSC chain files as interval blocks, ready for a range join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.alleles import chain_name

BLOCKS = "chain_chromosome string, start long, end long, target_chain_chromosome string, target_start long, target_size long, reverse boolean, score long, id string"


def plain(chain_chromosome: str | Column) -> Column:
    """The name without ``chr``; the mitochondrion is MT."""
    c = F.col(chain_chromosome) if isinstance(chain_chromosome, str) else chain_chromosome
    return F.regexp_replace(F.regexp_replace(c, "^chr", ""), "^M$", "MT")


def parse_chain(text: str) -> list[tuple]:
    """Blocks of one chain: a header, then lines of size, gap in the source and gap in the target, the last of size only."""
    lines = [x for x in text.splitlines() if x.strip() and not x.startswith("#")]
    if not lines:
        return []
    head = lines[0].split()
    if head[0] != "chain" or len(head) < 12 or head[4] != "+":
        raise ValueError(f"not a chain of a forward source: {lines[0][:200]}")
    _, score, t_name, _, _, t_start, t_end, q_name, q_size, q_strand, q_start, q_end = head[:12]
    sizes = np.array([([int(v) for v in x.split()] + [0, 0])[:3] for x in lines[1:]], np.int64).reshape(-1, 3)
    start = int(t_start) + np.cumsum(sizes[:, 0] + sizes[:, 1]) - sizes[:, 0] - sizes[:, 1]
    at = int(q_start) + np.cumsum(sizes[:, 0] + sizes[:, 2]) - sizes[:, 0] - sizes[:, 2]
    if len(sizes) and (start[-1] + sizes[-1, 0] != int(t_end) or at[-1] + sizes[-1, 0] != int(q_end)):
        raise ValueError(f"blocks do not fill the chain: {lines[0][:200]}")
    of_chain = (q_name, int(q_size), q_strand == "-", int(float(score)), head[12] if len(head) > 12 else "")
    return [(t_name, int(s), int(s + n), of_chain[0], int(q), *of_chain[1:]) for s, n, q in zip(start, sizes[:, 0], at, strict=True)]


def _parse(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.string())
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    for b in it:
        for text in b.column(0).to_pylist():
            rows = parse_chain(text)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def read_chain(spark: SparkSession, path: str) -> DataFrame:
    """Blocks for ``builds.lift``: chromosome, start, end, target_chromosome, target_start, target_size, reverse, rank.

    Chains are parted by empty lines; of the chains that hold a site the one of the highest score is first.
    """
    text = spark.read.text(path, lineSep="\n\n")
    b = text.mapInArrow(_parse, BLOCKS)
    return b.select(
        plain("chain_chromosome").alias("chromosome"), "start", "end", plain("target_chain_chromosome").alias("target_chromosome"), "target_start", "target_size", "reverse",
        F.struct((-F.col("score")).alias("s"), "id").alias("rank"),
    )


def site_chromosome(c: str | Column) -> Column:
    """A site's chromosome as the blocks name it: 23 and 25 are X, 24 is Y, 26 and M are MT."""
    return plain(chain_name(c))
