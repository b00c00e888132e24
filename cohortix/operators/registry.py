"""Participants, events, assays, artifacts: the cohort's registry as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortix.functions.text import as_text, day_number

from .annotate import dealt, joined
from .coding import all_true
from .cutpoint import cut
from .dedup import insert_absent, keep_first, latest, refresh_source, upsert
from .quantiles import quantiles

# ---- participants -----------------------------------------------------------------------------


def resolve_aliases(ids: DataFrame, aliases: DataFrame, source: str) -> DataFrame:
    """native_id to participant_id: the source's own aliases, then wildcard ones (``*``), else itself."""
    a = aliases.select("source_id", as_text("native_id").alias("native_id"), as_text("participant_id").alias("participant_id"))
    a = a.where("native_id is not null and native_id <> '' and participant_id is not null and participant_id <> ''")
    pick = lambda s, n: a.where(F.col("source_id") == s).groupBy("native_id").agg(F.min("participant_id").alias(n))
    own = ids.select(as_text("native_id").alias("native_id")).where("native_id is not null and native_id <> ''").distinct()
    j = own.join(pick(source, "_own"), "native_id", "left").join(pick("*", "_any"), "native_id", "left")
    return j.select("native_id", F.coalesce("_own", "_any", "native_id").alias("participant_id"))


def register_mapping(participants: DataFrame, aliases: DataFrame, mapping: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """(participants, aliases) after a source's mapping: its aliases replaced, unseen people added."""
    new = mapping.select(F.lit(source).alias("source_id"), "native_id", "participant_id").distinct()
    people = new.groupBy("participant_id").agg(F.min("source_id").alias("first_source"))
    return insert_absent(participants, people, ["participant_id"]), refresh_source(aliases, new)


def master_list(df: DataFrame, participant: str) -> DataFrame:
    """participant_id and all other columns as JSON."""
    rest = [c for c in df.columns if c != participant]
    return df.select(F.col(participant).alias("participant_id"), F.to_json(F.struct(*rest)).alias("attributes"))


# ---- events and assays ------------------------------------------------------------------------


def events_of(df: DataFrame, participant: str, event: str, ord_col: str = "_ord", **columns: Column) -> DataFrame:
    """One row per participant and event, the first; null and empty events are none."""
    e = df.select(F.col(participant).alias("participant_id"), as_text(event).alias("event_id"), F.col(ord_col).alias("_ord"), *[c.alias(n) for n, c in columns.items()])
    e = e.where("participant_id is not null and event_id is not null and event_id <> ''")
    return keep_first(e, ["participant_id", "event_id"])


def add_events(old: DataFrame, new: DataFrame, authoritative: bool = False) -> DataFrame:
    """Absent events are added; an authoritative list also replaces those that are there."""
    keys = ["participant_id", "event_id"]
    return upsert(old, new, keys) if authoritative else insert_absent(old, new, keys)


def record_assays(old: DataFrame, source: str, rows: DataFrame) -> DataFrame:
    """A source's assays replaced: a row per participant and event, numbered within the participant."""
    one = rows.select("participant_id", "event_id", "artifact_id").distinct()
    w = Window.partitionBy("participant_id").orderBy(F.asc_nulls_last("event_id"), "artifact_id")
    new = one.select(F.concat_ws("/", F.lit(source), "participant_id", (F.row_number().over(w) - 1).cast("string")).alias("assay_id"), F.lit(source).alias("source_id"), "participant_id", "event_id", "artifact_id")
    return refresh_source(old, new)


def biospecimen_observations(obs: DataFrame, biospecimens: DataFrame) -> DataFrame:
    """Registered participant before the given one, the observation's own event before the registered."""
    b = biospecimens.select("biospecimen_id", F.col("participant_id").alias("_p"), F.col("event_id").alias("_e"))
    j = obs.join(b, "biospecimen_id", "left")
    return j.withColumns({"participant_id": F.coalesce("_p", "participant_id"), "event_id": F.coalesce("event_id", "_e")}).drop("_p", "_e")


def biospecimens_of(df: DataFrame, biospecimen: str, participant: str, ord_col: str = "_ord", **columns: Column) -> DataFrame:
    """One row per biospecimen, the first; rows without an id or a participant are none."""
    b = df.select(as_text(biospecimen).alias("biospecimen_id"), F.col(participant).alias("participant_id"), F.col(ord_col).alias("_ord"), *[c.alias(n) for n, c in columns.items()])
    return keep_first(b.where("biospecimen_id <> '' and participant_id is not null"), ["biospecimen_id"])


def biospecimen_summary(biospecimens: DataFrame) -> DataFrame:
    """Counts and distinct participants by tissue, material and event; unknown values are ``?``."""
    keys = [F.coalesce(F.col(c), F.lit("?")).alias(c) for c in ("tissue", "material", "event_id")]
    return biospecimens.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("participant_id").alias("n_participants"))


def biospecimens_per_event(biospecimens: DataFrame) -> DataFrame:
    return biospecimens.where("event_id is not null").groupBy("event_id").agg(F.count("*").alias("n"))


def phenotype_missingness(observations: DataFrame) -> DataFrame:
    return observations.groupBy("phenotype").agg((F.count_if("is_missing") / F.count("*")).alias("missing_fraction"))


def participants_per_source(aliases: DataFrame, participants: DataFrame) -> DataFrame:
    """(source_id, n_participants, n_first_seen)."""
    a = aliases.groupBy("source_id").agg(F.count_distinct("participant_id").alias("n_participants"))
    f = participants.groupBy(F.col("first_source").alias("source_id")).agg(F.count("*").alias("n_first_seen"))
    return a.join(f, "source_id", "left").fillna(0, ["n_first_seen"])


def availability_groups(assays: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Per source, modality and origin of artifacts in use: tissue, last artifact, participants.

    Superseded artifacts and those that failed quality control are not in use.
    """
    j = assays.where("participant_id is not null").join(artifacts.where("lower(status) not in ('superseded', 'qc_fail')").select("artifact_id", "modality", "origin", "tissue"), "artifact_id")
    return j.groupBy("source_id", "modality", "origin").agg(F.max("tissue").alias("tissue"), F.max("artifact_id").alias("artifact_id"), F.count_distinct("participant_id").alias("n_participants"))


def storage_mode(mode: str, modality: str, size: int, most: int = 1 << 30) -> str:
    """copy, link or reference; ``auto`` refers to genotypes and large files and copies the rest."""
    if mode != "auto":
        return mode
    return "reference" if modality == "genotype" or size >= most else "copy"


# ---- timeline ---------------------------------------------------------------------------------


def event_order(events: DataFrame) -> DataFrame:
    """(event_id, median_day, first_date, first_seen, event_no): by day, date and first appearance."""
    s = events.groupBy("event_id").agg(F.median("study_day").alias("median_day"), F.min("event_date").alias("first_date"), F.min("_ord").alias("first_seen"))
    w = Window.orderBy(F.asc_nulls_last("median_day"), F.asc_nulls_last("first_date"), "first_seen")  # a row an event kind
    return s.withColumn("event_no", F.row_number().over(w))


def per_event(events: DataFrame) -> DataFrame:
    return events.groupBy("event_id").agg(F.count_distinct("participant_id").alias("n_participants"))


def modalities_per_event(assays: DataFrame) -> DataFrame:
    return assays.groupBy("event_id", "modality", "tissue", "origin").agg(F.count_distinct("participant_id").alias("n_participants"))


def repeated_measures(assays: DataFrame) -> DataFrame:
    """Participants with more than one event, per modality and tissue."""
    per = assays.where("event_id is not null").groupBy("modality", "tissue", "participant_id").agg(F.count_distinct("event_id").alias("n"))
    return per.where("n > 1").groupBy("modality", "tissue").agg(F.count("*").alias("n_participants"))


def attrition(events: DataFrame) -> DataFrame:
    """Per event in order: who is present, who of the first event is retained, and the ratio."""
    order = event_order(events).select("event_id", "event_no")
    seen = events.select("participant_id", "event_id").distinct().join(order, "event_id")
    first = seen.where("event_no = 1").select("participant_id").withColumn("_first", F.lit(True))
    got = seen.join(first, "participant_id", "left").groupBy("event_no", "event_id").agg(F.count("*").alias("n_present"), F.count_if("_first").alias("n_retained"))
    base = got.where("event_no = 1").select(F.col("n_present").alias("_base"))
    return got.crossJoin(F.broadcast(base)).withColumn("retained_ratio", F.col("n_retained") / F.col("_base")).drop("_base")  # one row


def gaps(events: DataFrame) -> DataFrame:
    """Days since a participant's event before; study days where given, else days of the date."""
    t = F.coalesce(F.col("study_day").cast("double"), day_number("event_date").cast("double"))
    e = events.select("participant_id", t.alias("t")).where("t is not null").distinct()
    w = Window.partitionBy("participant_id").orderBy("t")
    return e.withColumn("gap", F.col("t") - F.lag("t").over(w))


def gap_statistics(events: DataFrame) -> DataFrame:
    g = gaps(events).where("gap is not null")
    s = g.agg(F.count("*").alias("n_gaps"), F.min("gap").alias("min_gap"), F.max("gap").alias("max_gap"))
    middle = quantiles(g, "gap", (0.5,)).agg(F.first("q")[0].alias("median_gap"))  # one row, null without gaps
    return s.crossJoin(F.broadcast(middle)).select("n_gaps", "median_gap", "min_gap", "max_gap")


# ---- availability -----------------------------------------------------------------------------


def availability_name(source: Column, modality: Column, origin: Column) -> Column:
    """Column name of a source: its id; omics that are not predicted end in their origin."""
    omics = F.lower(modality).isin("expression", "splicing", "proteomics", "metabolomics", "methylation")
    return F.concat_ws("_", source, F.when(omics & (F.lower(origin) != "predicted"), F.upper(origin)))


def availability_matrix(assays: DataFrame, participants: DataFrame, columns: Sequence[str], column: str = "column") -> DataFrame:
    """One boolean a source for every participant."""
    seen = assays.groupBy("participant_id").agg(*[F.bool_or(F.col(column) == c).alias(c) for c in columns])
    return participants.select("participant_id").distinct().join(seen, "participant_id", "left").fillna(False, list(columns))


def availability_patterns(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    return matrix.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)


def availability_pairwise(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n): participants with both, for every pair, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    one = matrix.agg(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.count_if(F.col(a) & F.col(b)).alias("n")) for a, b in pairs]).alias("p"))
    return one.select(F.inline("p"))


def key_intersections(matrix: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """(combination, n): participants with one column of each group, for every choice, in one pass."""
    combos: list[tuple[str, ...]] = [()]
    for cols in groups.values():
        combos = [(*c, x) for c in combos for x in cols]
    one = matrix.agg(F.array(*[F.struct(F.lit(" & ".join(c)).alias("combination"), F.count_if(all_true(c)).alias("n")) for c in combos]).alias("p"))
    return one.select(F.inline("p"))


def subsets(columns: Sequence[str], size: int) -> list[tuple[str, ...]]:
    return list(combinations(columns, size))


def select_participants(matrix: DataFrame, require: Sequence[str]) -> DataFrame:
    """Participants for whom every required column holds."""
    return matrix.where(all_true(require)).select("participant_id")


def summary_by_origin(long: DataFrame) -> DataFrame:
    return long.groupBy("origin", "modality").agg(F.count_distinct("participant_id").alias("n_participants"), F.count_distinct("tissue").alias("n_tissues"))


# ---- artifacts --------------------------------------------------------------------------------


def supersede(artifacts: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old current artifacts with the keys of ``new`` become superseded; all rows stay."""
    k = new.select(*keys).distinct().withColumn("_new", F.lit(True))
    old = artifacts.join(k, list(keys), "left").withColumn("status", F.when(F.col("_new") & (F.col("status") == "current"), "superseded").otherwise(F.col("status"))).drop("_new")
    return old.select(*artifacts.columns).unionByName(new)


def find_artifacts(artifacts: DataFrame, **equal: str) -> DataFrame:
    out = artifacts
    for c, v in equal.items():
        if v is not None:
            out = out.where(F.col(c) == v)
    return out


def latest_artifact(artifacts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return latest(artifacts.where("status = 'current'"), keys, ["created_at", "artifact_id"])


def lineage(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(start, ancestor, depth): all ancestors of each start, nearest depth.

    ``edges``: child, parent, ``start``: id; repeats count once. Edges whose child is neither asked for nor anybody's parent are
    never followed: one join drops them. While ids have less than half as many parents as they are, ancestors are
    found for the parents first and joined down, so that the many are joined once; the rest goes by ``_rounds``.
    """
    edges = edges.select("child", "parent").where("child is not null and parent is not null")
    asked = start.select(F.col("id").alias("child"), F.lit(True).alias("_start"))
    ids = edges.select(F.col("parent").alias("child"), F.lit(False).alias("_start")).unionByName(asked).groupBy("child").agg(F.max("_start").alias("_start"))
    edges = dealt(edges, edges.count(), "child").join(ids.hint("merge"), "child").distinct()
    edges = cut(edges.withColumn("_n", F.count("*").over(Window.partitionBy("child"))))
    own, levels, rows = edges.where("_start"), [], edges.count()
    n = round(own.agg(F.sum(1 / F.col("_n"))).first()[0] or 0)
    while n:
        up = cut(own.select(F.col("parent").alias("child")).distinct())
        if not (m := up.count()) or 2 * m > n:
            break
        levels.append(own)
        own, n = cut(joined(edges, up, ["child"], "left_semi", rows)), m
    out = _rounds(edges, own.select(F.col("child").alias("id")).distinct())
    for k, own in reversed(list(enumerate(levels))):
        out = _joined_down(own, out)
        if k:
            out = cut(out)
    return out


def _joined_down(edges: DataFrame, known: DataFrame) -> DataFrame:
    """``lineage`` of the children from that of their parents. Only children of several parents can meet an ancestor twice."""
    e = edges.select(F.col("child").alias("start"), "parent", "_n")
    far = joined(e, known.withColumnRenamed("start", "parent"), "parent").where("ancestor <> parent").withColumn("depth", F.col("depth") + 1)
    all_ = e.withColumns({"ancestor": F.col("parent"), "depth": F.lit(1)}).unionByName(far).where("ancestor <> start")
    rows = lambda few: all_.where(few).select("start", "ancestor", "depth")
    return rows("_n = 1").unionByName(rows("_n > 1").groupBy("start", "ancestor").agg(F.min("depth").alias("depth")))


def _rounds(edges: DataFrame, start: DataFrame) -> DataFrame:
    """``lineage`` by rounds of joins over distinct edges.

    A round extends only what the last round reached, and pairs that are known are not extended again, so cycles
    end and the rounds go on until nothing is new. Each round is cut, so a long chain of ancestors makes no long
    lineage of tasks.
    """
    out = start.select(F.col("id").alias("start"), F.col("id").alias("ancestor"), F.lit(0).alias("depth"))
    front, d = out, 0
    while True:
        d += 1
        step = front.join(edges, front["ancestor"] == edges["child"]).select("start", F.col("parent").alias("ancestor")).distinct()
        front = cut(step.join(out.select("start", "ancestor"), ["start", "ancestor"], "left_anti").withColumn("depth", F.lit(d)))
        if front.isEmpty():
            return out.where("depth > 0")
        out = out.unionByName(front)
        if d % 20 == 0:
            out = cut(out)


def with_parents(artifacts: DataFrame, edges: DataFrame) -> DataFrame:
    """Artifacts with their parents' ids, sorted and joined."""
    p = edges.groupBy(F.col("child").alias("artifact_id")).agg(F.array_join(F.sort_array(F.collect_list("parent")), ",").alias("parents"))
    return artifacts.join(p, "artifact_id", "left")


def flatten_metrics(df: DataFrame, keys: Sequence[str], metrics: str, ) -> DataFrame:
    """(keys, metric, value, text) of a struct column: dotted names, numbers apart from text."""
    from pyspark.sql import types as T

    def leaves(t: T.DataType, path: str):
        if isinstance(t, T.StructType):
            for f in t.fields:
                yield from leaves(f.dataType, f"{path}.{f.name}" if path else f.name)
        else:
            yield path

    names = list(leaves(df.schema[metrics].dataType, ""))
    items = [F.struct(F.lit(n).alias("metric"), F.col(f"{metrics}.{n}").cast("string").alias("text")) for n in names]
    long = df.select(*keys, F.inline(F.array(*items)))
    return long.select(*keys, "metric", F.col("text").try_cast("double").alias("value"), "text")


def phenopackets(observations: DataFrame) -> DataFrame:
    """(participant_id, packet): binary codes as features (controls excluded), numbers as measurements."""
    o = observations.where("value_numeric is not null").withColumn("is_binary", F.col("type") == "binary")
    feature = F.when(F.col("is_binary"), F.struct(F.col("phenotype").alias("label"), (F.col("value_numeric") == 0).alias("excluded")))
    measure = F.when(~F.col("is_binary"), F.struct(F.col("phenotype").alias("assay"), F.col("value_numeric").alias("value")))
    p = o.groupBy("participant_id").agg(F.sort_array(F.collect_list(feature)).alias("phenotypicFeatures"), F.sort_array(F.collect_list(measure)).alias("measurements"))
    subject = F.struct(F.col("participant_id").alias("id"))
    return p.select("participant_id", F.to_json(F.struct(F.col("participant_id").alias("id"), subject.alias("subject"), "phenotypicFeatures", "measurements")).alias("packet"))


def resources_in_use(resources: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Resource versions with whether a snapshot uses them; those must not be removed."""
    used = snapshots.select("resource_id", "version").distinct().withColumn("in_use", F.lit(True))
    return resources.join(used, ["resource_id", "version"], "left").fillna(False, ["in_use"])
