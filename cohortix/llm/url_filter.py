"""URL filter: host and path rules, then a character language-model ratio.

Rules come first. URLs that no rule settles are judged by two variable-order Markov models over
characters, one of the URLs that rules accept and one of those they reject. Orders 0 to ``order``
are interpolated by Witten-Bell smoothing: a context that has been followed by many different
characters leaves more weight to the shorter context. The score is the log-likelihood difference per
character; its cut-off is calibrated on ruled URLs that neither model has seen. DataFrame operations
only, and the only thing that reaches the driver is a histogram of bounded size.

Defined results: a null URL or one without ``://`` has an empty host and path, no rule, and the
verdict that an empty text gets: its score is 0. Repeated rows get a row each. Without ruled URLs of
both kinds the cut-off is 0. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, cut, shared_dir

#: (verdict, host and path prefix). The longest fitting rule wins.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_START, _END = "\x02", "\x03"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty for a null or one without ``://``."""
    u = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.substr(u, F.instr(u, "://") + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, both null where none fits."""
    name = kind = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        h, _, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        kind = F.when(fits, verdict) if kind is None else kind.when(fits, verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, kind)


def _grams(urls: DataFrame, order: int, *keep: str) -> DataFrame:
    """Every character of ``text`` with the ``order`` characters before it, as one string ``g``, and ``keep``.

    The start is padded and the end is a character. The text is taken apart once and does not go along
    with its grams, so work and size grow with its length alone.
    """
    apart = urls.select(*keep, F.split(F.concat(F.lit(_START * order), F.col("text"), F.lit(_END)), "").alias("_c"))
    windows = F.transform(F.sequence(F.lit(0), F.size("_c") - (order + 1)), lambda i: F.concat(*[F.get("_c", i + j) for j in range(order + 1)]))
    return apart.select(*keep, F.explode(windows).alias("g"))


def _probabilities(train: DataFrame, wanted: DataFrame, order: int, where: str, alphabet: int = 256) -> DataFrame:
    """(g, p): log of the probability ratio, accepted to rejected, of each of the ``wanted`` grams.

    ``train`` has text, n (how often) and yes (whether accepted).
    """
    full = cut(_grams(train, order, "yes", "n").groupBy("g", "yes").agg(F.sum("n").alias("n")), where)
    out = wanted.select("g")
    prob = {k: F.lit(1.0 / alphabet) for k in ("yes", "no")}
    for k in range(order + 1):
        # the last k + 1 characters of a gram: context of length k and the character
        own = full.withColumn("s", F.substring("g", order + 1 - k, k + 1)).groupBy("s").agg(
            F.sum(F.when(F.col("yes"), F.col("n"))).alias("yes"), F.sum(F.when(~F.col("yes"), F.col("n"))).alias("no")
        )
        own = own.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("yes", "no")}).withColumn("ctx", F.substring("s", 1, k))
        ctx = own.groupBy("ctx").agg(*[f(c).alias(f"{n}_{c}") for c in ("yes", "no") for n, f in (("all", F.sum), ("kinds", lambda x: F.count_if(F.col(x) > 0)))])
        out = out.withColumn("_s", F.substring("g", order + 1 - k, k + 1)).withColumn("_ctx", F.substring("_s", 1, k))
        out = out.join(own.select(F.col("s").alias("_s"), "yes", "no"), "_s", "left")
        if k:
            out = out.join(ctx.withColumnRenamed("ctx", "_ctx"), "_ctx", "left")
        else:  # one row, the whole alphabet's
            out = out.join(F.broadcast(ctx.drop("ctx")), F.lit(True), "left")
        new = {}
        for c in ("yes", "no"):
            lower = F.lit(1.0 / alphabet) if k == 0 else F.col(f"p_{c}")
            total, kinds = F.coalesce(f"all_{c}", F.lit(0)), F.coalesce(f"kinds_{c}", F.lit(0))
            new[f"p_{c}"] = F.when(total > 0, (F.coalesce(c, F.lit(0)) + kinds * lower) / (total + kinds)).otherwise(lower)
        out = out.withColumns(new).select("g", "p_yes", "p_no")
    return out.select("g", F.log(F.col("p_yes") / F.col("p_no")).alias("p"))


def lm_scores(urls: DataFrame, train: DataFrame, order: int, where: str) -> DataFrame:
    """(text, score) of the distinct ``urls``: log-likelihood difference per character."""
    keyed = cut(urls.select("text", F.monotonically_increasing_id().alias("k")), where)  # the key stands in the table
    grams = cut(_grams(keyed, order, "k"), where)
    ratio = cut(_probabilities(train, grams.select("g").distinct(), order, where), where)
    # while distinct grams are few, no URL's copy of a common one moves; beyond that, skewed keys are split
    ratio = F.broadcast(ratio) if ratio.count() <= 10 * BROADCAST_ROWS else ratio
    scores = grams.join(ratio, "g").groupBy("k").agg((F.sum("p") / F.count("*")).alias("score"))
    return keyed.join(scores, "k").select("text", "score")


def calibrated(scored: DataFrame, bins: int = 400, span: float = 4.0) -> float:
    """The cut-off of best balanced accuracy over (yes, score), from a histogram of ``bins`` rows."""
    b = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor((F.col("score") + span) / (2 * span) * bins))).cast("int")
    rows = scored.groupBy(b.alias("b")).agg(F.count_if("yes").alias("yes"), F.count_if(~F.col("yes")).alias("no")).collect()
    got = {r["b"]: (r["yes"], r["no"]) for r in rows}
    yes, no = (sum(v[i] for v in got.values()) for i in (0, 1))
    if not yes or not no:
        return 0.0
    best, at, below_yes, below_no = -1.0, bins // 2, 0, 0
    ties = []
    for i in range(bins + 1):
        rate = (yes - below_yes) / yes + below_no / no
        if rate > best + 1e-12:
            best, ties = rate, []
        if rate > best - 1e-12:
            ties.append(i)
        a, n = got.get(i, (0, 0))
        below_yes, below_no = below_yes + a, below_no + n
    at = min(ties, key=lambda i: abs(i - bins // 2))  # of equal cut-offs, the one nearest to an even ratio
    return at / bins * 2 * span - span


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple = RULES, order: int = 4) -> DataFrame:
    """page_id, host, path, rule, verdict and score (null where a rule decides) of every row."""
    where = shared_dir(pages.sparkSession)
    host, path = split_url(F.col(url))
    base = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    name, kind = rule_of(F.col("host"), F.col("path"), rules)
    rows = cut(base.withColumns({"rule": name, "said": kind, "text": F.concat("host", "path")}), where)

    ruled = rows.where(F.col("rule").isNotNull()).groupBy("text", (F.col("said") == "allow").alias("yes")).agg(F.count("*").alias("n"))
    ruled = cut(ruled.withColumn("held", F.pmod(F.xxhash64("text"), F.lit(5)) == 0), where)
    trial = lm_scores(ruled.where("held"), ruled.where("not held"), order, where)
    limit = calibrated(trial.join(ruled.where("held"), "text"))

    open_ = cut(rows.where(F.col("rule").isNull()).select("text").distinct(), where)
    scores = cut(lm_scores(open_.where("text <> ''"), ruled, order, where), where).withColumnRenamed("text", "_t")
    out = rows.join(scores, rows["text"] == scores["_t"], "left")
    score = F.when(F.col("rule").isNull(), F.coalesce("score", F.lit(0.0)))
    verdict = F.coalesce("said", F.when(score >= F.lit(limit), "allow").otherwise("block"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
