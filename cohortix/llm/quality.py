"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has a lookup table over quantile bins, learned by cyclic boosting: in turn, every
feature gets a small step from a shallow tree on its own bins. The feature pairs whose joint bins
explain most of what is left then get tables of their own. A score is the sum of looked-up values
through the logistic function. The model is fitted on a bounded sample of labelled rows (``sample``,
the ids of smallest hash); scoring reads whole texts and adds table entries for whole batches.

Defined results: a null text is empty, and an empty text has a score like any other. Repeated rows
get a row each. Without labelled rows of both kinds every score is the share of label 1 (0.5 without
any). A null id is never held out. Extra columns are ignored.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, small, texts_of

_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_MARKS = np.frombuffer(b"#$%&*|~^<>{}[]=+@\\_/", np.uint8)
_STOPS = np.frombuffer(b".,;:", np.uint8)
CHUNKS = 8

FEATURES = (
    "log_words", "distinct_words", "distinct_pairs", "repeats", "word_length", "least_distinct",
    "upper", "digits", "marks", "bars", "exclamations", "stops", "lines", "other_bytes", "spaces",
    "entropy", "most_upper", "most_marks", "most_exclamations", "least_stops", "line_copies", "longest_line",
)


def features(text: bytes) -> tuple[float, ...]:
    """The ``FEATURES`` of a whole text. Shares per byte, per word or per line; chunks are eighths."""
    ws = text.split()
    n = len(ws) or 1
    arr = np.frombuffer(text, np.uint8)
    size = len(arr) or 1
    chunk = np.minimum(np.arange(len(arr)) * CHUNKS // size, CHUNKS - 1) if len(arr) < 64 else np.repeat(np.arange(CHUNKS), np.diff(np.linspace(0, len(arr), CHUNKS + 1).astype(int)))
    hist = np.bincount(chunk * 256 + arr, minlength=CHUNKS * 256).reshape(CHUNKS, 256)
    all_, per = hist.sum(0), np.maximum(hist.sum(1), 1)
    letters = hist[:, _UPPER].sum(1) + hist[:, _LOWER].sum(1)
    up, marks = hist[:, _UPPER].sum(1) / np.maximum(letters, 1), hist[:, _MARKS].sum(1) / per
    used = all_[all_ > 0] / size
    lines = text.split(b"\n")
    step = max(1, -(-len(ws) // CHUNKS))
    return (
        float(np.log1p(len(ws))),
        len(set(ws)) / n,
        len(set(zip(ws, ws[1:], strict=False))) / n,
        sum(map(operator.eq, ws, ws[1:])) / n,
        (size - int(all_[32]) - int(all_[9:14].sum())) / n,
        min((len(set(ws[i : i + step])) / min(step, len(ws) - i) for i in range(0, len(ws), step)), default=0.0),
        float(all_[_UPPER].sum() / max(1, letters.sum())),
        float(all_[_DIGIT].sum() / size),
        float(all_[_MARKS].sum() / n),
        float(all_[124] / n),
        float(all_[33] / n),
        float(all_[_STOPS].sum() / n),
        float(all_[10] / n),
        float(all_[128:].sum() / size),
        float(all_[32] / size),
        float(-(used * np.log2(used)).sum()),
        float(up.max()),
        float(marks.max()),
        float((hist[:, 33] / per).max()),
        float((hist[:, _STOPS].sum(1) / per).min()),
        1 - len(set(lines)) / len(lines),
        max(map(len, lines)) / size,
    )


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Newton steps of a tree over ordered bins: the best cuts one after another, ``leaves`` at most."""
    value = lambda g, h: g * g / (h + ridge)
    cg, ch = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    parts = [(0, len(grad))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p in parts:
            a, b = p
            if b - a < 2:
                continue
            m = np.arange(a + 1, b)
            gl, hl, gr, hr = cg[m] - cg[a], ch[m] - ch[a], cg[b] - cg[m], ch[b] - ch[m]
            gain = value(gl, hl) + value(gr, hr) - value(cg[b] - cg[a], ch[b] - ch[a])
            gain[(hl < 1) | (hr < 1)] = 0
            i = int(np.argmax(gain))
            if gain[i] > best[0]:
                best = (gain[i], p, int(m[i]))
        if best[1] is None:
            break
        parts.remove(best[1])
        parts += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


@dataclass
class Additive:
    """Bin edges, one table a feature, and tables of feature pairs over coarser edges."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        for j, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, j], side="right")]
        for i, j, t in self.pairs:
            z += t[np.searchsorted(self.pair_edges[i], x[:, i], side="right"), np.searchsorted(self.pair_edges[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.15, bins: int = 32, pair_bins: int = 6, n_pairs: int = 5, pair_rounds: int = 20, leaves: int = 4, ridge: float = 2.0) -> Additive:
    """Cyclic boosting of the feature tables, then of the tables of the ``n_pairs`` best pairs."""
    p = (y.mean() if len(y) else 0.5).clip(1e-3, 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(p / (1 - p)))
    k = x.shape[1]
    cuts = lambda n: [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.empty(0) for j in range(k)]
    m = Additive(base, cuts(bins), [], cuts(pair_bins), [])
    m.tables = [np.zeros(len(e) + 1) for e in m.edges]
    if not len(y) or y.min() == y.max():
        return m
    at = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(m.edges)]
    z = np.full(len(y), base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        q = 1 / (1 + np.exp(-z))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for j in range(k):
            g, h = slope()
            size = len(m.tables[j])
            step = rate * _tree(np.bincount(at[j], g, size), np.bincount(at[j], h, size), leaves, ridge)
            m.tables[j] += step
            z += step[at[j]]
    coarse = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(m.pair_edges)]
    width = [len(e) + 1 for e in m.pair_edges]
    g, h = slope()
    gains = []
    for i in range(k):
        for j in range(i + 1, k):
            cell = coarse[i] * width[j] + coarse[j]
            cg, ch = np.bincount(cell, g, width[i] * width[j]), np.bincount(cell, h, width[i] * width[j])
            gains.append((float((cg * cg / (ch + ridge)).sum()), i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
    tables = {c: np.zeros(width[c[0]] * width[c[1]]) for c in chosen}
    for _ in range(pair_rounds):
        for i, j in chosen:
            g, h = slope()
            cell = coarse[i] * width[j] + coarse[j]
            size = width[i] * width[j]
            cg, ch = np.bincount(cell, g, size), np.bincount(cell, h, size)
            # a tree over the cells ordered by their mean slope is the best tree over cell groups
            order = np.argsort(cg / (ch + ridge), kind="stable")
            step = np.zeros(size)
            step[order] = rate * _tree(cg[order], ch[order], leaves, ridge)
            tables[i, j] += step
            z += step[cell]
    m.pairs = [(i, j, t.reshape(width[i], width[j])) for (i, j), t in tables.items()]
    return m


def feature_batches(column: pa.Array) -> np.ndarray:
    rows = [features(t) for t in texts_of(column)]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int, doc_id: str = "doc_id", text: str = "text", folds: int = 5, fold: int = 0, slots: int = 4096) -> DataFrame:
    """(y, text) of at most about ``sample`` labelled ids outside the held-out fold, those of smallest hash slot.

    A histogram of ``slots`` rows says how many slots fit, so no task sees more than its share. Where
    the first slot alone is larger than ``sample``, about ``sample`` of its ids are taken, by a second
    hash. A label that an id has several times is its largest, a text likewise, so an id is one row.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("y")).where(F.col("_id").isNotNull() & F.col("y").isNotNull())
    known = known.where(~held_out("_id", folds, fold)).groupBy("_id").agg(F.max("y").alias("y")).withColumn("_slot", F.pmod(F.xxhash64("_id"), F.lit(slots)))
    last, taken, counts = -1, 0, sorted(map(tuple, known.groupBy("_slot").count().collect()))
    for slot, many in counts:
        if taken + many > sample:
            break
        last, taken = slot, taken + many
    chosen = F.col("_slot") <= last
    if counts and last < 0:
        slot, many = counts[0]
        parts = 1 << 30
        chosen = (F.col("_slot") == slot) & (F.pmod(F.xxhash64("_id", F.lit("part")), F.lit(parts)) < int(parts * sample / many))
        taken = sample
    own = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).join(small(known.where(chosen).drop("_slot"), taken), "_id")
    return own.groupBy("_id").agg(F.max("y").alias("y"), F.max("text").alias("text")).select("y", "text")


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20_000, **kw) -> Additive:
    rows = labelled_sample(docs, labels, label, sample, **kw)

    def make(it):
        for b in it:
            x = feature_batches(b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float64()))], names=["y", "x"])

    got = rows.mapInArrow(make, "y double, x array<double>").toArrow()
    x = np.array(got["x"].to_pylist(), float).reshape(got.num_rows, len(FEATURES))
    order = np.lexsort(x.T)  # the order in which rows arrive must not matter
    return fit(x[order], np.asarray(got["y"])[order])


def score_quality(docs: DataFrame, model: Additive, doc_id: str = "doc_id", text: str = "text", cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    kind = dict(docs.dtypes)[doc_id]
    bc = docs.sparkSession.sparkContext.broadcast(model)

    def score(it):
        for b in it:
            s = bc.value.score(feature_batches(b.column(2)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= cut).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id, 5, 0).alias("held_out"), F.col(text))
    return rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def filter_rows(docs: DataFrame, keep, text: str = "text") -> DataFrame:
    """The rows of ``docs`` for whose batch of texts ``keep`` is true, with all columns they came with."""

    at = docs.columns.index(text)

    def go(it):
        for b in it:
            yield b.filter(pa.array(keep(b.column(at)), pa.bool_()))

    return docs.mapInArrow(go, docs.schema)


def keep_quality(docs: DataFrame, model: Additive, text: str = "text", cut: float = 0.3) -> DataFrame:
    bc = docs.sparkSession.sparkContext.broadcast(model)
    return filter_rows(docs, lambda column: bc.value.score(feature_batches(column)) >= cut, text)
