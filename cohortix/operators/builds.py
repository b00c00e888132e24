"""Genome builds: lift-over by interval blocks and evidence for the build of a site list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions.alleles import BUILD_ALIASES, chromosome

from .annotate import dealt, joined
from .cutpoint import cut

#: Chromosome lengths of the two builds as published (fixed values).
LENGTHS = {
    "GRCh37": {
        "1": 249250621, "2": 243199373, "3": 198022430, "4": 191154276, "5": 180915260, "6": 171115067,
        "7": 159138663, "8": 146364022, "9": 141213431, "10": 135534747, "11": 135006516, "12": 133851895,
        "13": 115169878, "14": 107349540, "15": 102531392, "16": 90354753, "17": 81195210, "18": 78077248,
        "19": 59128983, "20": 63025520, "21": 48129895, "22": 51304566, "X": 155270560, "Y": 59373566,
    },
    "GRCh38": {
        "1": 248956422, "2": 242193529, "3": 198295559, "4": 190214555, "5": 181538259, "6": 170805979,
        "7": 159345973, "8": 145138636, "9": 138394717, "10": 133797422, "11": 135086622, "12": 133275309,
        "13": 114364328, "14": 107043718, "15": 101991189, "16": 90338345, "17": 83257441, "18": 80373285,
        "19": 58617616, "20": 64444167, "21": 46709983, "22": 50818468, "X": 156040895, "Y": 57227415,
    },
}
#: Bins of the range join: a block is listed in every bin it touches.
BIN = 1 << 20


def lift(sites: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lift_with_strand`` without the strand."""
    return lift_with_strand(sites, blocks).drop("lifted_reverse")


def lift_with_strand(sites: DataFrame, blocks: DataFrame) -> DataFrame:
    """Sites (site_id, chromosome, position) through chain blocks; the first block that holds a site counts.

    ``blocks``: chromosome, start, end (half open, 0-based), target_chromosome, target_start,
    target_size, reverse, rank. Status: unplaced, unmapped, chromosome_changed, reverse_strand, mapped.
    A range join: equality on chromosome and bin, then the interval.
    """
    s = sites.withColumn("_bin", F.floor((F.col("position") - 1) / BIN))
    b = blocks.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("start") / BIN), F.floor((F.col("end") - 1) / BIN)))).withColumnRenamed("chromosome", "_chrom")
    hit = s.where("position >= 1").join(b, (F.col("chromosome") == F.col("_chrom")) & (s["_bin"] == b["_bin"]) & (F.col("position") - 1 >= F.col("start")) & (F.col("position") - 1 < F.col("end")))
    at = F.col("position") - 1 - F.col("start") + F.col("target_start")
    hit = hit.select("site_id", F.struct("rank", "target_chromosome", F.when(F.col("reverse"), F.col("target_size") - at).otherwise(at + 1).alias("pos"), "reverse").alias("h"))
    first = hit.groupBy("site_id").agg(F.min("h").alias("h"))
    out = sites.join(first, "site_id", "left")
    status = (
        F.when(F.coalesce("position", F.lit(0)) < 1, "unplaced").when(F.col("h").isNull(), "unmapped")
        .when(F.col("h.target_chromosome") != F.col("chromosome"), "chromosome_changed").when(F.col("h.reverse"), "reverse_strand").otherwise("mapped")
    )
    return out.select(*sites.columns, status.alias("status"), F.col("h.target_chromosome").alias("lifted_chromosome"), F.col("h.pos").cast("bigint").alias("lifted_position"), F.col("h.reverse").alias("lifted_reverse"))


def lifted_sites(lifted: DataFrame) -> DataFrame:
    """Mapped sites at their new positions."""
    kept = lifted.where("status = 'mapped'").withColumn("position", F.col("lifted_position"))
    return kept.drop("status", "lifted_chromosome", "lifted_position").orderBy("chromosome", "position", "site_id")


def status_counts(lifted: DataFrame, c: str = "status") -> DataFrame:
    return lifted.groupBy(c).agg(F.count("*").alias("n"))


def lengths_frame(spark, lengths: dict[str, dict[str, int]] = LENGTHS) -> DataFrame:
    return spark.createDataFrame([(b, c, n) for b, t in lengths.items() for c, n in t.items()], "build string, chromosome string, length bigint")


def last_positions(variants: DataFrame) -> DataFrame:
    return variants.groupBy(chromosome("chromosome", BUILD_ALIASES).alias("chromosome")).agg(F.max("position").alias("last_position"))


def bounds_evidence(variants: DataFrame, lengths: DataFrame) -> DataFrame:
    """(build, weight, n_chromosomes): builds supported because sites lie beyond the other build's ends.

    One chromosome weighs 0.7, several 0.9; nothing is said where both builds are exceeded.
    """
    over = last_positions(variants).join(F.broadcast(lengths), "chromosome").groupBy("build").agg(F.count_if(F.col("last_position") > F.col("length")).alias("n"))
    other = over.withColumnsRenamed({"build": "supports", "n": "n_other"})
    pairs = over.where("n > 0").join(other, (F.col("build") != F.col("supports")) & (F.col("n_other") == 0))
    return pairs.select("supports", F.when(F.col("n") >= 2, 0.9).otherwise(0.7).alias("weight"), F.col("n").alias("n_chromosomes"))


def marker_evidence(variants: DataFrame, panel: DataFrame, least: int = 20, agree: float = 0.9, weight: float = 0.95) -> DataFrame:
    """Agreement of known markers' positions (rsid, pos_37, pos_38) with the site list's."""
    j = variants.join(panel, variants["variant_id"] == panel["rsid"])
    s = j.agg(F.count("*").alias("n"), F.count_if(F.col("position") == F.col("pos_37")).alias("GRCh37"), F.count_if(F.col("position") == F.col("pos_38")).alias("GRCh38"))
    long = s.unpivot("n", ["GRCh37", "GRCh38"], "supports", "hits").where((F.col("n") >= least) & (F.col("hits") / F.col("n") >= agree))
    return long.select("supports", F.lit(weight).alias("weight"), F.col("n").alias("n_markers"))


def reference_evidence(sites: DataFrame, least: float = 0.95, margin: float = 0.1) -> DataFrame:
    """Sites (a1, a2, base_37, base_38): the build whose reference base is one of the alleles."""
    hit = lambda c: F.avg((F.col(c).isin("A", "C", "G", "T") & ((F.col(c) == F.col("a1")) | (F.col(c) == F.col("a2")))).cast("int"))
    s = sites.agg(hit("base_37").alias("GRCh37"), hit("base_38").alias("GRCh38"))
    best = F.when((F.col("GRCh37") >= least) & (F.col("GRCh37") - F.col("GRCh38") >= margin), "GRCh37").when((F.col("GRCh38") >= least) & (F.col("GRCh38") - F.col("GRCh37") >= margin), "GRCh38")
    return s.select(best.alias("supports"), F.lit(1.0).alias("weight"), "GRCh37", "GRCh38").where("supports is not null")


def lifted_base_evidence(sites: DataFrame, index_37: DataFrame, index_38: DataFrame, blocks_37: DataFrame, blocks_38: DataFrame, least: int = 20) -> DataFrame:
    """(supports, weight, rate_37, rate_38, lifted_rate, tested): the build of SNVs (site_id, chromosome, position, ref, alt).

    Bases of both builds' FASTA indexes are looked up at the same places. The likelier build's sites are lifted by its
    chain (``blocks_37`` lead from 37 to 38, ``blocks_38`` back) and compared with the other build's bases there. A
    build is supported where 0.9 of its bases are alleles, at most 0.8 of the other's, and 0.9 of the lifted ones
    agree if any were lifted forward. Autosomal SNVs on both builds count; under ``least`` of them there is no row.
    """
    from cohortix.sources.fasta import bases_of

    name = chromosome("chromosome", BUILD_ALIASES)
    snv = sites.withColumn("chromosome", name).where(F.col("chromosome").isin(*map(str, range(1, 23))) & (F.col("position") > 0) & F.col("ref").isin(*"ACGT") & F.col("alt").isin(*"ACGT"))
    at = bases_of(bases_of(snv, index_37).withColumnRenamed("bases", "base_37"), index_38).withColumnRenamed("bases", "base_38").where("base_37 <> '' and base_38 <> ''")
    at = cut(at)
    hit = lambda c: (F.col(c) == F.col("ref")) | (F.col(c) == F.col("alt"))
    s = at.agg(F.count("*").alias("tested"), F.avg(hit("base_37").cast("int")).alias("rate_37"), F.avg(hit("base_38").cast("int")).alias("rate_38"))
    n, rate_37, rate_38 = s.first()
    if n < least:
        return at.sparkSession.createDataFrame([], "supports string, weight double, rate_37 double, rate_38 double, lifted_rate double, tested bigint")
    likely = "GRCh37" if rate_37 >= rate_38 else "GRCh38"
    blocks, other = (blocks_37, index_38) if likely == "GRCh37" else (blocks_38, index_37)
    there = lift_with_strand(at, blocks).where(F.col("lifted_position").isNotNull() & F.col("status").isin("mapped", "chromosome_changed"))
    there = there.where(~F.coalesce(F.col("lifted_reverse"), F.lit(False))).select("ref", "alt", F.col("lifted_chromosome").alias("chromosome"), F.col("lifted_position").alias("position"))
    lifted = bases_of(there, other).where("bases <> ''").agg(F.avg(hit("bases").cast("int")).alias("lifted_rate"))
    best = F.when(F.col("rate_37") > F.col("rate_38"), "GRCh37").otherwise("GRCh38")
    sure = (F.greatest("rate_37", "rate_38") >= 0.9) & (F.least("rate_37", "rate_38") <= 0.8) & (F.coalesce("lifted_rate", F.lit(1.0)) >= 0.9)
    both = s.crossJoin(F.broadcast(lifted))  # one row each
    return both.select(F.when(sure, best).alias("supports"), F.when(sure, 1.0).otherwise(0.0).alias("weight"), "rate_37", "rate_38", "lifted_rate", "tested")


def header_evidence(lines: DataFrame, lengths: DataFrame) -> DataFrame:
    """VCF header lines (value): a named reference weighs 0.6, matching contig lengths 0.9."""
    low = F.lower("value")
    named = F.when(low.rlike("grch37|hg19|b37|hs37"), "GRCh37").when(low.rlike("grch38|hg38|b38"), "GRCh38")
    ref = lines.where(F.col("value").startswith("##reference=")).select(named.alias("supports"), F.lit(0.6).alias("weight")).where("supports is not null").distinct()
    contig = lines.where(F.col("value").startswith("##contig=")).select(
        chromosome(F.regexp_extract("value", r"ID=([^,>]+)", 1), BUILD_ALIASES).alias("chromosome"), F.regexp_extract("value", r"length=(\d+)", 1).try_cast("bigint").alias("length")
    )
    hits = contig.join(F.broadcast(lengths), ["chromosome", "length"]).groupBy("build").agg(F.count("*").alias("n"))
    return ref.unionByName(hits.select(F.col("build").alias("supports"), F.lit(0.9).alias("weight")))


def decide_build(evidence: Sequence[tuple[str, float]], declared: str | None = None) -> tuple[str, float]:
    """(build, confidence) from (supports, weight) votes; a declared build is a vote of 0.8.

    Votes add up. The winner needs 0.8, and four fifths of all weight where the other build has any;
    else the build is unknown. So is a declared one that evidence of 1.0 or more contradicts.
    """
    total = dict.fromkeys(LENGTHS, 0.0)
    for build, weight in [*evidence, *([(declared, 0.8)] if declared in LENGTHS else [])]:
        if build in total:
            total[build] += weight
    everything = sum(total.values())
    if not everything:
        return "unknown", 0.0
    best = max(total, key=total.__getitem__)
    confidence = total[best] / everything
    if declared in LENGTHS and declared != best and total[best] >= 1.0:
        return "unknown", confidence
    sure = total[best] >= 0.8 and (confidence >= 0.8 or min(total.values()) == 0)
    return (best if sure else "unknown"), confidence


def bases_at(sites: DataFrame, reference: DataFrame, chunk: int, length: str | Column | None = None) -> DataFrame:
    """Reference bases at each site from a chunked sequence table (chromosome, chunk_no, seq; each chunk once).

    Equality on chromosome and chunk. Bases of a site within a chunk need no aggregate; only sites that go beyond
    a chunk's end meet the next ones too and are put together, equal sites once.
    """
    n = F.lit(1) if length is None else (F.col(length) if isinstance(length, str) else length)
    s = sites.withColumn("_n", n).withColumn("_first", F.floor((F.col("position") - 1) / chunk)).withColumn("_last", F.floor((F.col("position") + F.col("_n") - 2) / chunk))
    start = F.col("position") - 1 - F.col("chunk_no") * chunk
    piece = F.when(start >= 0, F.substr("seq", (start + 1).cast("int"), F.col("_n").cast("int"))).otherwise(F.substr("seq", F.lit(1), (F.col("_n") + start).cast("int")))
    cols, rows = sites.columns, sites.count()
    met = lambda df: joined(df, reference, ["chromosome", "chunk_no"], "left", rows)
    beyond = F.coalesce(F.col("_last") > F.col("_first"), F.lit(False))
    within = met(s.where(~beyond).withColumn("chunk_no", F.col("_first"))).select(*cols, piece.alias("bases"))
    several = dealt(s.where(beyond), rows, *cols).groupBy(*cols, "_n", "_first", "_last").agg(F.count("*").alias("_copies"))
    parts = met(several.withColumn("chunk_no", F.explode(F.sequence("_first", "_last")))).select(*cols, "_copies", F.struct("chunk_no", piece.alias("p")).alias("_p"))
    whole = dealt(parts, rows, *cols).groupBy(*cols, "_copies").agg(F.array_join(F.transform(F.sort_array(F.collect_list("_p")), lambda x: x["p"]), "").alias("bases"))
    whole = whole.select(*cols, "bases", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*cols, "bases")
    return within.unionByName(whole).withColumn("bases", F.upper(F.nullif("bases", F.lit(""))))
