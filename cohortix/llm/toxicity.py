"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features are lexicon densities, the nearness of second-person words to lexicon words, capitals,
punctuation and obfuscation rates. The lexicon is a short list of common insults and at most ``most``
words and word beginnings that mark the toxic rows of a bounded sample of labelled rows. The sample has
``FOLDS`` parts by hash: the trees learn from features under the lexicon of the other parts, which
carry no memory of a row's own label, and the calibration from margins of trees that have not seen the
row either. So scores of new rows are made as those were that they are calibrated on.

Defined results: a null text is empty, and an empty text has a score like any other. Repeated rows
get a row each. Without labelled rows of both kinds every score is the share of label 1 (0 without
any). A null id is never held out. Extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out
from .quality import filter_rows, labelled_sample

INSULTS = frozenset("idiot idiots idiotic moron morons moronic stupid scum loser losers pathetic worthless trash disgusting clown filth imbecile bastard bitch asshole cretin trottel arschloch abschaum schwachkopf connard salaud abruti estúpido imbécil escoria idiota".split())
YOU = frozenset("you your yours you're yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú usted ustedes tuyo contigo".split())
_LEET = str.maketrans("013457@$!|", "oieastasil")
_EDGES = ".,;:!?\"'()[]{}<>«»„“”…-*_~#$%&@^+=|/\\"
_BROKEN = re.compile(r"(?<=\w)[*.\-_~+](?=\w)")
_SPACED = re.compile(r"(?<!\S)(?:\w[ .\-*_]){3,}\w(?!\S)")
_MIXED = re.compile(r"(?<!\S)(?=\S*[^\W\d_])\S*[0-9@$!*|](?=[^\W\d_])\S*")

#: Parts of the sample by hash of the text.
FOLDS = 4

FEATURES = (
    "log_words", "listed_share", "listed", "learned_share", "learned", "begin_share", "begin", "kinds",
    "hidden", "spaced", "near_you", "you_share", "upper", "shouted", "exclamations", "questions", "mixed", "learned_weight",
)


@dataclass
class Lexicon:
    words: dict[str, float]
    beginnings: dict[str, float]


def plain_words(text: str) -> list[str]:
    return [w for w in (x.strip(_EDGES) for x in text.lower().split()) if w]


def features(text: str, lex: Lexicon) -> tuple[float, ...]:
    raw = text.split()
    ws = [w.strip(_EDGES) for w in text.lower().split()]
    n = len(ws) or 1
    listed, learned, begun, you, weight, kinds = [], [], [], [], 0.0, set()
    known, starts = lex.words, lex.beginnings
    for i, w in enumerate(ws):
        if w in INSULTS:
            listed.append(i)
            kinds.add(w)
        if w in known:
            learned.append(i)
            weight += known[w]
            kinds.add(w)
        elif w[:4] in starts or w[:5] in starts:
            begun.append(i)
            kinds.add(w)
        if w in YOU:
            you.append(i)
    hits = sorted({*listed, *learned, *begun})
    near = 0
    if hits and you:
        at = np.searchsorted(you, hits)
        near = sum(1 for h, a in zip(hits, at, strict=True) if (a < len(you) and you[a] - h <= 5) or (a and h - you[a - 1] <= 5))
    bad = INSULTS | known.keys()
    mixed = _MIXED.findall(text)
    hidden = sum(1 for w in mixed if (v := _BROKEN.sub("", w.lower().translate(_LEET)).strip(_EDGES)) != w.lower().strip(_EDGES) and v in bad)
    hidden += sum(1 for w in raw if ("*" in w or "-" in w or "." in w[:-1]) and _BROKEN.sub("", w.lower()).strip(_EDGES) in bad)
    runs = (re.sub(r"[ .\-*_]", "", w).lower() for w in _SPACED.findall(text))
    spaced = sum(1 for r in runs if any(b in r for b in INSULTS))
    letters = sum(map(text.count, "aeinrst")) or 1
    upper = sum(map(text.count, "AEINRST"))
    return (
        float(np.log1p(len(ws))), len(listed) / n, min(len(listed), 10), len(learned) / n, min(len(learned), 10),
        len(begun) / n, min(len(begun), 10), min(len(kinds), 10), min(hidden, 5), min(spaced, 5), near / max(1, len(hits)),
        len(you) / n, upper / (letters + upper), sum(1 for w in raw if len(w) > 3 and w.isupper()) / n,
        text.count("!") / n, text.count("?") / n, len(mixed) / n, weight / n,
    )


# ---- lexicon ----------------------------------------------------------------------------------


def learn_lexicons(rows: DataFrame, most: int = 3_000, ratio: float = 12.0) -> list[Lexicon]:
    """Words and beginnings (of 4 and 5 letters) of ``rows`` (y, text, fold) that mark label 1.

    A lexicon of all rows but those of each fold, and then one of all; each has ``most`` entries at
    most. Texts are counted once however often they occur.
    """
    rows = rows.dropDuplicates(["text"])
    n = np.zeros((FOLDS, 2))
    for f, y, c in rows.groupBy("fold", "y").count().collect():
        n[f, int(y)] = c

    def terms(it):
        for b in it:
            out: dict[tuple[str, str, int], list[int]] = {}
            for y, t, f in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                ws = set(plain_words(t or ""))
                for k, w in {*(("w", w) for w in ws), *(("b", w[:4]) for w in ws if len(w) > 4), *(("b", w[:5]) for w in ws if len(w) > 5)}:
                    out.setdefault((k, w, f), [0, 0])[int(y)] += 1
            keys = list(out)
            yield pa.RecordBatch.from_pydict({"kind": [k for k, _, _ in keys], "term": [w for _, w, _ in keys], "fold": pa.array([f for *_, f in keys], pa.int32()), "no": [out[k][0] for k in keys], "yes": [out[k][1] for k in keys]})

    counts = rows.select("y", "text", "fold").mapInArrow(terms, "kind string, term string, fold int, no long, yes long").groupBy("kind", "term")
    counts = counts.agg(*[F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}") for c in ("no", "yes") for f in range(FOLDS)])
    sums = []  # for each lexicon the numbers of clean and toxic texts, and the columns of a term's counts
    for out in [*range(FOLDS), None]:
        own = [f for f in range(FOLDS) if f != out]
        clean, toxic = n[own].sum(0)
        no, yes = (sum((F.col(f"{c}{f}") for f in own), F.lit(0)) for c in ("no", "yes"))
        weight = F.log(((yes + 0.1) / F.lit(max(toxic, 1.0))) / ((no + 0.5) / F.lit(max(clean, 1.0))))
        fits = F.lit(bool(toxic and clean)) & (yes >= max(2, round(toxic * 0.015))) & (weight >= float(np.log(ratio)))
        sums.append((fits, yes, weight))
    every = sum((F.col(f"yes{f}") for f in range(FOLDS)), F.lit(0))
    cols = [F.when(fits, F.struct(yes.alias("n"), weight.alias("w"))).alias(f"s{i}") for i, (fits, yes, weight) in enumerate(sums)]
    kept = counts.where(F.greatest(*[f for f, _, _ in sums])).orderBy(F.desc(every), "kind", "term").limit(2 * most).select("kind", "term", *cols).collect()
    made = []
    for i in range(FOLDS + 1):
        top = sorted((r for r in kept if r[f"s{i}"]), key=lambda r: (-r[f"s{i}"]["n"], r["kind"], r["term"]))[:most]
        made.append(Lexicon(*({r["term"]: float(r[f"s{i}"]["w"]) for r in top if r["kind"] == kind} for kind in "wb")))
    return made


# ---- trees ------------------------------------------------------------------------------------


@dataclass
class Boosted:
    """Complete trees of one depth: features and cuts by inner node, values by leaf; a calibration."""

    lex: Lexicon
    base: float
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    steps: tuple[np.ndarray, np.ndarray]

    def margin(self, x: np.ndarray) -> np.ndarray:
        z, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            z += v[at - (2**self.depth - 1)]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.margin(x), *self.steps)


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 2.0) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Second-order boosting with histogram splits."""
    k, inner = x.shape[1], 2**depth - 1
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    edges = [np.unique(np.concatenate([e, np.quantile(x[x[:, j] > e[-1], j], [0, 0.25, 0.5, 0.75]) - 1e-12])) if len(e) and (x[:, j] > e[-1]).any() else e for j, e in enumerate(edges)]
    code = [np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)]
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    z = np.full(len(y), base)
    fs, cs, vs = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        q = 1 / (1 + np.exp(-z))
        g, h = y - q, q * (1 - q)
        at = np.zeros(len(y), np.int64)
        for d in range(depth):
            for node in range(2**d - 1, 2 ** (d + 1) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) < 4:
                    continue
                best = 1e-6
                for j in range(k):
                    if not len(edges[j]):
                        continue
                    cg, ch = (np.cumsum(np.bincount(code[j][rows], v[rows], len(edges[j]) + 1)) for v in (g, h))
                    tot = cg[-1] ** 2 / (ch[-1] + ridge)
                    gain = cg[:-1] ** 2 / (ch[:-1] + ridge) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + ridge) - tot
                    i = int(np.argmax(gain))
                    if gain[i] > best:
                        best, fs[t, node], cs[t, node] = gain[i], j, edges[j][i]
            at = 2 * at + 1 + (x[np.arange(len(x)), fs[t][at]] > cs[t][at])
        leaf = at - inner
        vs[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        z += vs[t][leaf]
    return base, fs, cs, vs


def isotonic(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising function from margins to probabilities."""
    order = np.argsort(z, kind="stable")
    blocks: list[list[float]] = []  # sum, weight, first and last margin
    for v, t in zip(z[order], y[order], strict=True):
        blocks.append([t, 1.0, v, v])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, w, _, hi = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += w
            blocks[-1][3] = hi
    xs = np.array([e for b in blocks for e in (b[2], b[3])])
    # four rows of the base rate in every block: a few rows alone don't make a score of 1
    ys = np.array([(b[0] + 4 * y.mean()) / (b[1] + 4) for b in blocks for _ in range(2)])
    return xs, np.maximum.accumulate(ys)


def train_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 20_000, **kw) -> Boosted:
    """A model from at most ``sample`` labelled rows; equal texts fall into one of its ``FOLDS`` parts."""
    rows = labelled_sample(docs, labels, label, sample, **kw).withColumn("fold", F.pmod(F.xxhash64("text", F.lit(3)), F.lit(FOLDS)).cast("int"))
    *others, lex = learn_lexicons(rows)
    bc = docs.sparkSession.sparkContext.broadcast(others)

    def make(it):
        for b in it:
            x = [features(t or "", bc.value[f]) for t, f in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))], names=["y", "fold", "x"])

    got = rows.select("y", "text", "fold").mapInArrow(make, "y double, fold int, x array<double>").toArrow()
    x, y, fold = np.array(got["x"].to_pylist(), float).reshape(got.num_rows, len(FEATURES)), np.asarray(got["y"], float), np.asarray(got["fold"], int)
    order = np.lexsort((fold, y, *x.T))  # the order in which rows arrive must not matter
    x, y, fold = x[order], y[order], fold[order]
    if not len(y) or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.0
        return Boosted(lex, 0.0, 1, np.zeros((0, 1), int), np.zeros((0, 1)), np.zeros((0, 2)), (np.array([0.0, 1.0]), np.array([p, p])))
    z = np.zeros(len(y))
    for f in np.unique(fold):
        own = fold == f
        z[own] = Boosted(lex, *_fitted(x[~own], y[~own])).margin(x[own])
    model = Boosted(lex, *_fitted(x, y))
    model.steps = isotonic(z, y)
    return model


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple:
    """What ``Boosted`` takes after its lexicon; no trees where there is one kind of label or none."""
    none = (np.array([0.0]), np.array([0.0]))
    if not len(y):
        return 0.0, 3, np.zeros((0, 7), int), np.zeros((0, 7)), np.zeros((0, 8)), none
    base, *trees = boost(x, y)
    return base, 3, *trees, none


def _scores(model: Boosted, column: pa.Array) -> np.ndarray:
    x = np.array([features(t or "", model.lex) for t in column.to_pylist()], float).reshape(len(column), len(FEATURES))
    return model.score(x)


def score_toxicity(docs: DataFrame, model: Boosted, doc_id: str = "doc_id", text: str = "text", cut: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    kind = dict(docs.dtypes)[doc_id]
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def score(it):
        for b in it:
            s = _scores(bc.value, b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id, 5, 0).alias("held_out"), F.col(text))
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Boosted, text: str = "text", cut: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are not judged toxic, with all columns they came with."""
    bc = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda column: _scores(bc.value, column) < cut, text)
