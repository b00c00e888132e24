"""Variant annotation: reference look-ups, transcript picks, the annotation table, and gene burden."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions import consequences as cq
from cohortix.functions.alleles import strip_chr, variant_key
from cohortix.functions.text import column_or_null, without_version

from .dedup import best_row
from .genotype import passing_variants

#: A look-up side is broadcast up to this many rows; beyond it the join is shuffled.
BROADCAST_ROWS = 500_000
#: Rows that a task gets where rows are dealt by their number.
TASK_ROWS = 500_000


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows; counting stops there."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def dealt(df: DataFrame, rows: int, *keys: str, most: int = TASK_ROWS) -> DataFrame:
    """``df`` of ``rows`` rows dealt by ``keys`` to tasks of about ``most``, so that no task's memory grows with the table.

    Small tables stay as they are, as a join of them may need no shuffle.
    """
    n, spark = -(-rows // most), df.sparkSession
    if n <= spark.sparkContext.defaultParallelism:
        return df
    # under the number of shuffle partitions a join would deal them again
    return df.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)


def joined(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner", rows: int = 0) -> DataFrame:
    """A join that broadcasts ``right`` behind the counted bound and sorts both sides beyond it.

    Left to itself, Spark broadcasts a side by its estimate, which takes a small file or a generated table for few
    rows. With ``rows``, those of ``left``, both sides are dealt by ``on``.
    """
    n = right.count()
    if n <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, how)
    if rows:
        left, right = dealt(left, max(n, rows), *on), dealt(right, max(n, rows), *on)
    return left.join(right.hint("merge"), on, how)


def with_key(df: DataFrame, chrom: str = "chromosome", pos: str = "position", ref: str = "ref", alt: str = "alt") -> DataFrame:
    return df.withColumn("variant_key", variant_key(chrom, pos, ref, alt))


def split_alts(reference: DataFrame, alt: str = "alt") -> DataFrame:
    """A row per ALT allele; alleles upper-case, chromosomes without ``chr``."""
    df = reference.withColumn("alt", F.explode(F.split(F.col(alt), ","))).withColumn("chromosome", strip_chr("chromosome"))
    return df.withColumns({"ref": F.upper("ref"), "alt": F.upper("alt")})


def reference_lookup(variants: DataFrame, reference: DataFrame, values: Sequence[str]) -> DataFrame:
    """Cohort variants with the ``values`` of the reference rows of the same four keys.

    The reference may be far larger than the cohort: a cohort behind the bound for a broadcast is broadcast, so that
    the reference is scanned once and not shuffled. Beyond it, both sides are dealt by the keys and sorted.
    """
    keys = ["chromosome", "position", "ref", "alt"]
    own = variants.select(strip_chr("chromosome").alias("chromosome"), F.col("position").cast("bigint").alias("position"), F.upper("ref").alias("ref"), F.upper("alt").alias("alt"), "variant_key")
    ref = split_alts(reference).select("chromosome", F.col("position").cast("bigint").alias("position"), "ref", "alt", *values)
    n = variants.count()
    if n <= BROADCAST_ROWS or own.distinct().limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return ref.join(F.broadcast(own.distinct()), keys).select("variant_key", *values).distinct()
    rows = max(n, ref.count())
    met = dealt(ref, rows, *keys).join(dealt(own, rows, *keys).distinct().hint("merge"), keys).select("variant_key", *values)
    return dealt(met, rows, "variant_key").distinct()


def pick_transcript(rows: DataFrame) -> DataFrame:
    """One row a variant: flagged pick, then canonical, then most severe, then smallest feature.

    ``picked_by`` says which of these decided.
    """
    cols = rows.columns
    r = rows.withColumns({
        "_pick": F.coalesce(column_or_null(cols, "PICK").cast("string") == "1", F.lit(False)),
        "_canon": F.coalesce(column_or_null(cols, "CANONICAL").cast("string") == "YES", F.lit(False)),
        "most_severe_consequence": cq.most_severe("Consequence"),
    })
    # the smallest of a struct combines before the shuffle, so a variant of many transcripts is no hot key
    order = F.struct(~F.col("_pick"), ~F.col("_canon"), F.coalesce(cq.rank(F.col("most_severe_consequence")).cast("int"), F.lit(1 << 30)), F.col("Feature").isNull(), F.col("Feature"))
    kept = [c for c in r.columns if c != "variant_key"]
    best = r.groupBy("variant_key").agg(F.min_by(F.struct(*kept), order).alias("_r")).select("variant_key", *[F.col("_r")[c].alias(c) for c in kept])
    return best.withColumn("picked_by", F.when(F.col("_pick"), "PICK").when(F.col("_canon"), "canonical").otherwise("most_severe")).drop("_pick", "_canon")


def keyed_transcripts(rows: DataFrame, variants: DataFrame) -> DataFrame:
    """Transcript rows with the key of the variant they were uploaded as; null where it is unknown."""
    keys = variants.select(F.col("variant_id").alias("Uploaded_variation"), "variant_key")
    return rows.join(sized(keys), "Uploaded_variation", "left")


def cohort_variants(variants: DataFrame, metrics: DataFrame | None = None) -> DataFrame:
    """The cohort's variants: those marked ``included`` where sites say so, else those that pass quality control."""
    if "included" in variants.columns:
        return variants.where("included")
    if metrics is None:
        raise ValueError("sites without an included column need variant metrics")
    return passing_variants(variants, metrics)


def consequence_counts(picked: DataFrame) -> DataFrame:
    t = picked.select(F.explode(cq.terms("Consequence")).alias("term"))
    return t.groupBy("term").agg(F.count("*").alias("n"))


def best_scored(picked: DataFrame, scores: DataFrame, score: str) -> DataFrame:
    """One score row a variant: that of the picked transcript first, then the highest."""
    p = picked.select("variant_key", without_version("Feature").alias("_t"))
    s = scores.join(p, "variant_key", "left").withColumn("_same", F.coalesce(without_version("transcript_id") == F.col("_t"), F.lit(False)))
    return best_row(s, ["variant_key"], [F.desc("_same"), F.desc_nulls_last(score), F.asc_nulls_last("transcript_id")]).drop("_same", "_t")


#: Columns of the annotation table and where they come from (fixed values).
ANNOTATION = {
    "gene_id": "string",
    "gene_symbol": "string",
    "transcript_id": "string",
    "consequence": "string",
    "most_severe_consequence": "string",
    "impact": "string",
    "clinvar_significance": "string",
    "gnomad_af": "double",
    "alphamissense_score": "double",
    "spliceai_max_score": "double",
}


def annotation_table(variants: DataFrame, *sources: DataFrame) -> DataFrame:
    """Variants ⟕ every source, one row a key each; a source that is absent leaves typed nulls.

    Each source has ``variant_key`` once and some of the ``ANNOTATION`` columns.
    """
    out = variants.select("variant_key").distinct()
    for s in sources:
        out = out.join(s.select("variant_key", *[c for c in ANNOTATION if c in s.columns]), "variant_key", "left")
    return out.select("variant_key", *[(F.col(c) if c in out.columns else F.lit(None)).cast(t).alias(c) for c, t in ANNOTATION.items()])


def carried(carriers: DataFrame, annotation: DataFrame, weights: dict[str, float] | None = None, damaging: float = cq.DAMAGING_SCORE, rare: float = cq.RARE_FREQUENCY) -> DataFrame:
    """Carried alleles with annotation and flags. A null hard call counts from a dosage of 0.5 on."""
    n, d = F.col("hardcall_alt_count"), F.col("dosage")
    c = carriers.where((F.coalesce(n, F.lit(0)) > 0) | (n.isNull() & (d >= 0.5)))
    c = c.withColumn("dosage", F.coalesce(d, n.cast("double"))).join(sized(annotation), "variant_key", "left")
    weight = F.lit(0.0)
    if weights:
        weight = F.coalesce(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])[F.col("most_severe_consequence")], F.lit(0.0))
    return c.withColumns({
        "is_lof": cq.has_any("consequence", cq.LOSS_OF_FUNCTION),
        "is_splice": cq.has_any("consequence", cq.SPLICE),
        "is_damaging_missense": F.array_contains(cq.terms("consequence"), "missense_variant") & (F.col("alphamissense_score") >= damaging),
        "is_pathogenic": cq.pathogenic("clinvar_significance"),
        "is_rare": F.col("gnomad_af") < rare,
        "burden_weight": weight,
    })


def _sum_if(value: str, when: Column) -> Column:
    return F.coalesce(F.sum(F.when(when, F.col(value))), F.lit(0.0))


def participant_totals(rows: DataFrame, splice_cuts: Sequence[float] = cq.SPLICE_CUTS) -> DataFrame:
    harm = F.col("is_lof") | F.col("is_damaging_missense")
    made = {
        "n_variants_total": F.count("*"),
        "alt_alleles_total": F.sum("dosage"),
        "n_heterozygous": F.count_if("heterozygous"),
        "n_homozygous_alt": F.count_if("homozygous_alt"),
        "n_unannotated": F.count_if(F.col("consequence").isNull()),
        "n_lof": F.count_if("is_lof"),
        "alt_burden_lof": _sum_if("dosage", F.col("is_lof")),
        "n_splice": F.count_if("is_splice"),
        "n_damaging_missense": F.count_if("is_damaging_missense"),
        "alt_burden_damaging_missense": _sum_if("dosage", F.col("is_damaging_missense")),
        "n_clinvar_pathogenic": F.count_if("is_pathogenic"),
        "n_rare": F.count_if("is_rare"),
        "n_rare_damaging": F.count_if(F.col("is_rare") & harm),
    }
    made |= {f"n_spliceai_ge_{str(t).replace('.', '_')}": F.count_if(F.col("spliceai_max_score") >= t) for t in sorted(splice_cuts)}
    return rows.groupBy("participant_id").agg(*[c.alias(n) for n, c in made.items()])


def with_all_participants(participants: DataFrame, totals: DataFrame) -> DataFrame:
    """Every participant; those who carry nothing have zeros."""
    return participants.select("participant_id").distinct().join(totals, "participant_id", "left").fillna(0)


def term_counts(rows: DataFrame) -> DataFrame:
    t = rows.where("consequence is not null").select("participant_id", "dosage", F.explode(cq.terms("consequence")).alias("term"))
    return t.groupBy("participant_id", "term").agg(F.count("*").alias("n"), F.sum("dosage").alias("alt_burden"))


def consequence_matrix(participants: DataFrame, rows: DataFrame, terms: Sequence[str] = cq.REPORTED) -> DataFrame:
    """One row a participant, ``n_<term>`` and ``alt_burden_<term>`` of each of ``terms``, zero-filled.

    A sum a term over the carried rows themselves: a row of several terms counts for each of them, and
    no row is multiplied.
    """
    own = rows.where("consequence is not null").select("participant_id", "dosage", cq.terms("consequence").alias("_t"))
    made = [a for t in terms for a in (F.count_if(F.array_contains("_t", t)).alias(f"n_{t}"), _sum_if("dosage", F.array_contains("_t", t)).alias(f"alt_burden_{t}"))]
    return with_all_participants(participants, own.groupBy("participant_id").agg(*made))


def gene_burden(rows: DataFrame, weighted: bool = False) -> DataFrame:
    made = {
        "gene_symbol": F.min("gene_symbol"),
        "n_variants": F.count("*"),
        "n_alt_alleles": F.sum("dosage"),
        "n_missense": F.count_if(F.array_contains(cq.terms("consequence"), "missense_variant")),
        "n_lof": F.count_if("is_lof"),
        "n_splice": F.count_if("is_splice"),
        "n_damaging_missense": F.count_if("is_damaging_missense"),
        "max_alphamissense": F.max("alphamissense_score"),
        "max_spliceai": F.max("spliceai_max_score"),
        "min_gnomad_af": F.min("gnomad_af"),
    }
    if weighted:
        made["weighted_burden"] = F.sum(F.col("dosage") * F.col("burden_weight"))
    return rows.where("gene_id is not null").groupBy("participant_id", "gene_id").agg(*[c.alias(n) for n, c in made.items()])


def splice_summary(scores: DataFrame, cuts: Sequence[float] = cq.SPLICE_CUTS) -> DataFrame:
    """Highest score a variant and how many variants reach each cut-off, as one row."""
    top = scores.groupBy("variant_key").agg(F.max("score").alias("s"))
    return top.agg(F.count("*").alias("n_variants"), *[F.count_if(F.col("s") >= t).alias(f"n_ge_{str(t).replace('.', '_')}") for t in cuts])
