"""Score units: standard weight tables, one unit from weights to scores, quality and manifest, and the model catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from cohortix.functions.alleles import strip_chr
from cohortix.sources import files, parsers

from . import score
from .annotate import sized
from .cutpoint import cut
from .quantiles import quantiles

#: Columns of standard weights and features (fixed values).
WEIGHTS = (
    "model_id string, feature_id string, feature_name string, chromosome string, position bigint, variant_id string, effect_allele string, other_allele string, "
    "weight double, genome_build string, tissue string, validation_r2 double"
)
FEATURES = "model_id string, feature_id string, feature_name string, n_variants bigint, validation_r2 double, below_threshold boolean"
CATALOGUE = (
    "model_id string, provider string, provider_dataset_id string, modality string, feature_id string, feature_name string, tissue string, genome_build string, validation_r2 double, "
    "n_variants bigint, coverage_fraction double, status string"
)
UNIT_KEY = ("provider", "provider_dataset_id", "modality", "tissue")


def standardize(df: DataFrame, schema: str | StructType = WEIGHTS, **constants) -> DataFrame:
    """``df`` in the columns and types of ``schema``; one that is missing is the given constant or null.

    What cannot be cast is null. Alleles are upper-case and chromosomes have no ``chr``; text is not cast to text.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    cols = []
    for f in fields:
        c = F.col(f"`{f.name}`") if f.name in df.columns else F.lit(constants.get(f.name))
        if f.name in ("effect_allele", "other_allele", "ref", "alt"):
            c = F.upper(c)
        if f.name == "chromosome":
            c = strip_chr(c)
        cols.append((c.cast(f.dataType) if isinstance(f.dataType, StringType) else c.try_cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def load_weights(spark: SparkSession, path: str, model_id: str, declared_build: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(weights, features) of a SQLite model database or of a folder of Parquet weights, with ``features`` beside them.

    The declared build counts only where no weight names one. Features that are not given are made from the weights.
    """
    if path.endswith(".db"):
        w = standardize(parsers.read_predictdb(spark, path), WEIGHTS, model_id=model_id)
    else:
        at = f"{path.rstrip('/')}/weights"
        w = standardize(spark.read.parquet(at if files.exists(at) else path), WEIGHTS, model_id=model_id)
    if declared_build and w.where("genome_build is not null").isEmpty():
        w = w.withColumn("genome_build", F.lit(declared_build))
    if not path.endswith(".db") and files.exists(f"{path.rstrip('/')}/features"):
        return w, standardize(spark.read.parquet(f"{path.rstrip('/')}/features"), FEATURES, model_id=model_id)
    one = w.groupBy("model_id", "feature_id").agg(F.min("feature_name").alias("feature_name"), F.count("*").alias("n_variants"), F.max("validation_r2").alias("validation_r2"))
    return w, standardize(one, FEATURES)


def build_of(weights: DataFrame) -> str | None:
    """The one build of the weights; raises where they name several."""
    said = [r[0] for r in weights.select("genome_build").where("genome_build is not null").distinct().limit(2).collect()]
    if len(said) > 1:
        raise ValueError(f"weights are on several builds: {said}")
    return said[0] if said else None


def run_unit(weights: DataFrame, features: DataFrame, sites: DataFrame, calls: DataFrame, samples: DataFrame, genotype_build: str, least: float = score.MIN_COVERAGE, allow_low: bool = False, ord_col: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores, quality, manifest) of one unit.

    ``sites``: variant_id, chromosome, position, ref, alt; ``calls``: sample, variant (a site's variant_id), dosage;
    ``samples``: sample, native_id, participant_id. Builds must be known and equal. Scores are long: native_id (the
    sample where there is none), participant_id, model_id, feature_id, predicted_value. Only features that pass the
    coverage rule and are not below the provider's threshold are scored. The manifest is one row of counts and medians.
    """
    score.check_builds(build_of(weights), genotype_build)
    w = weights if ord_col else weights.withColumn("_ord", F.struct("weight"))
    h = cut(score.harmonize(w, sites, ord_col or "_ord").drop("_ord"))
    below = features.select("model_id", "feature_id", F.coalesce("below_threshold", F.lit(False)).alias("_below"), F.col("validation_r2").alias("_r2"))
    q = score.coverage_status(score.model_quality(h), least, allow_low).join(sized(below.dropDuplicates(["model_id", "feature_id"])), ["model_id", "feature_id"], "left")
    q = q.withColumns({"below_threshold": F.coalesce("_below", F.lit(False)), "validation_r2": F.col("_r2")})
    q = cut(q.withColumn("predict", F.col("predict") & ~F.col("below_threshold")).drop("_below", "_r2"))
    todo = h.where("outcome = 'matched'").join(sized(q.where("predict").select("model_id", "feature_id")), ["model_id", "feature_id"], "left_semi")
    got = score.with_samples(score.weighted_sum(calls, todo), samples.dropDuplicates(["sample"]))
    scores = got.select(F.coalesce("native_id", F.col("sample").cast("string")).alias("native_id"), "participant_id", "model_id", "feature_id", F.col("score").alias("predicted_value"))
    counts = q.agg(F.count("*").alias("features_in_model"), F.count_if("predict").alias("features_predicted"), F.count_if(F.col("status") == "LOW_COVERAGE").alias("low_coverage_features"))
    median = lambda c: quantiles(q, c, (0.5,)).agg(F.first("q")[0].alias(f"median_{c}"))
    manifest = counts.crossJoin(median("coverage_fraction")).crossJoin(median("validation_r2"))  # one row each
    return scores, q, manifest.withColumn("genome_build", F.lit(genotype_build))


def catalogue_rows(features: DataFrame, quality: DataFrame, provider: str, dataset: str, modality: str, tissue: str | None = None, genome_build: str | None = None) -> DataFrame:
    """A unit's rows of the model catalogue: features with their coverage and status."""
    f = features.select("model_id", "feature_id", "feature_name", "validation_r2", "n_variants")
    rows = f.join(sized(quality.select("model_id", "feature_id", "coverage_fraction", "status")), ["model_id", "feature_id"], "left")
    return standardize(rows, CATALOGUE, provider=provider, provider_dataset_id=dataset, modality=modality, tissue=tissue, genome_build=genome_build)


def replace_unit(catalogue: DataFrame, rows: DataFrame) -> DataFrame:
    """The catalogue with a unit's rows in place of its old ones; a null tissue and an empty one are the same."""
    key = lambda c: F.coalesce(F.col(c), F.lit("")) if c == "tissue" else F.col(c)
    gone = rows.select(*[key(c).alias(f"_{c}") for c in UNIT_KEY]).distinct()
    kept = catalogue.join(sized(gone), [key(c) == F.col(f"_{c}") for c in UNIT_KEY], "left_anti")
    return kept.unionByName(rows)


def atlas(variants: DataFrame, table: DataFrame) -> DataFrame:
    """Variants ⋈ an atlas of predicted effects on chromosome, position, reference and alternate."""
    key = ["chromosome", "position", "reference", "alternate"]
    a = table.withColumns({"chromosome": strip_chr("chromosome"), "position": F.col("position").cast("bigint")})
    return variants.select(*key).join(a, key)


def with_validation(scores: DataFrame, validation: DataFrame) -> DataFrame:
    """Rows a feature with its validation R², the first of those that a feature has; null where it has none."""
    v = validation.where("validation_r2 is not null").groupBy("feature_id").agg(F.max("validation_r2").alias("validation_r2"))
    return scores.join(sized(v), "feature_id", "left")


def resolve_genotype(artifacts: DataFrame, source_id: str, target_build: str, use_qc: bool = True) -> DataFrame:
    """The genotype artifact to use, one row or none: the newest after quality control, else lifted to the target build, else the source."""
    kind = F.col("artifact_type")
    lifted = (kind == "liftover_genotype") & (F.col("genome_build") == target_build)
    rank = F.when((kind == "qc_genotype") & F.lit(use_qc), 0).when(lifted, 1).when(kind == "source", 2)
    one = artifacts.where((F.col("source_id") == source_id) & (F.col("status") == "current"))
    # a newer lift to another build hides an older one to the target, as it is the latest of its kind
    newest = one.withColumn("_last", F.struct("created_at", "artifact_id")).groupBy("artifact_type").agg(F.max_by(F.struct(*artifacts.columns), "_last").alias("r")).select("r.*")
    return newest.withColumn("_rank", rank).where("_rank is not null").orderBy("_rank").limit(1).drop("_rank")


def write_multiqc(metrics: DataFrame, path: str, title: str = "Sample QC") -> None:
    """A sample table for MultiQC: ``#`` lines that describe it, then tab-separated columns; a row a sample."""
    head = [f"# id: '{title.lower().replace(' ', '_')}'", f"# section_name: '{title}'", "# plot_type: 'table'", "\t".join(metrics.columns)]
    rows = metrics.select(F.concat_ws("\t", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in metrics.columns]).alias("value"))
    spark = metrics.sparkSession
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(head)], "i int, value string").unionByName(rows.select(F.lit(len(head)).alias("i"), "value"))
    lines.orderBy("i", "value").select("value").coalesce(1).write.mode("overwrite").text(path)  # a row a sample
