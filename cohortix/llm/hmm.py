"""LM scoring with a hidden Markov language model.

A token is emitted in two steps: the latent state emits a class, the class emits the word. The most
frequent ``n_words`` training words are classes of their own; every other word, seen or not, belongs
to one of ``n_buckets`` classes by its ending, and within such a class a word with count c has
probability ``(c + 1) / (N_class + V_class + 1)``, the last 1 being the share of unseen words. So the
classes are bounded while the word counts, which are gathered from the whole corpus, are not: they
stay a table that is joined.

Baum-Welch runs over all training texts: partitions add up expected counts, Spark sums them, the
driver normalises a table of states x classes. Training reads texts in windows of ``piece`` tokens.
A window after a text's first begins with the last token of the one before, in the stationary
distribution, so that every transition and emission counts once, and only the beginnings of texts
count as starts. The likelihood of a text is exact: a scaled forward recursion over all its tokens.

Defined results: a null text is empty; an empty text has one token, its end. Repeated rows get a
row each. A null id is never held out. Ids keep their type. Extra columns are ignored. Without training texts every count
is zero and scores come from the smoothing alone.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, cut, held_out, shared_dir, texts_of, to_batch, words

END = b""  # no word is empty


@dataclass
class HMM:
    """Parameters and the bounded part of the vocabulary. ``lexicon``: word to (class or -1, count)."""

    lexicon: dict[bytes, tuple[int, int]]
    n_words: int
    n_buckets: int
    train_tokens: int
    train_types: int
    bucket_total: np.ndarray
    start: np.ndarray = field(default_factory=lambda: np.ones(1))
    trans: np.ndarray = field(default_factory=lambda: np.ones((1, 1)))
    emit: np.ndarray = field(default_factory=lambda: np.ones((1, 1)))  # classes x states

    @property
    def n_classes(self) -> int:
        return self.n_words + self.n_buckets + 1


def bucket(word: bytes, n_buckets: int) -> int:
    """Class of a word that has none of its own, by its last three bytes."""
    return zlib.crc32(word[-3:]) % n_buckets


# ---- counts -----------------------------------------------------------------------------------


def token_counts(docs: DataFrame, text: str = "text", train: str = "_train", n_buckets: int = 512, held: int = 500_000) -> DataFrame:
    """(token binary, bucket int, c long) over rows whose ``train`` is true, ends included."""
    schema = pa.schema([("token", pa.binary()), ("bucket", pa.int32()), ("c", pa.int64())])

    def count(it):
        got: Counter = Counter()
        for b in it:
            for t in texts_of(b.column(0)):
                got.update(words(t))
                got[END] += 1
                if len(got) > held:
                    yield from batches(((w, bucket(w, n_buckets), c) for w, c in got.items()), schema, 50_000)
                    got.clear()
        yield from batches(((w, bucket(w, n_buckets), c) for w, c in got.items()), schema, 50_000)

    rows = docs.where(F.col(train)).select(text).mapInArrow(count, "token binary, bucket int, c long")
    return rows.groupBy("token", "bucket").agg(F.sum("c").alias("c"))


# ---- recursions over many sequences at once ---------------------------------------------------


def lanes(seqs: list[np.ndarray], most: int = 400_000):
    """Groups of sequences of like length: (indices, obs [time x lane], active lanes by time)."""
    order = np.argsort([-len(s) for s in seqs], kind="stable")
    at = 0
    while at < len(order):
        longest = max(len(seqs[order[at]]), 1)
        idx = order[at : at + max(1, most // longest)]
        obs = np.zeros((longest, len(idx)), np.int32)
        lens = np.array([len(seqs[i]) for i in idx])
        for j, i in enumerate(idx):
            obs[: lens[j], j] = seqs[i]
        yield idx, obs, np.searchsorted(-lens, -np.arange(longest), side="left")
        at += len(idx)


def forward(seqs: list[np.ndarray], m: HMM) -> np.ndarray:
    """Natural log-likelihood of each class sequence, by the scaled forward recursion."""
    out = np.zeros(len(seqs))
    for idx, obs, active in lanes(seqs):
        a, ll = m.start, np.zeros(len(idx))
        for t, n in enumerate(active):
            a = (a[:n] @ m.trans if t else np.broadcast_to(a, (n, len(a)))) * m.emit[obs[t, :n]]
            s = a.sum(1)
            a = a / s[:, None]
            ll[:n] += np.log(s)
        out[idx] = ll
    return out


def windows(seq: np.ndarray, piece: int) -> list[np.ndarray]:
    """``seq`` in windows of ``piece`` tokens; each but the first begins with the token before it."""
    return [seq[max(i - 1, 0) : i + piece] for i in range(0, len(seq), piece)]


def stationary(m: HMM, steps: int = 200) -> np.ndarray:
    """The distribution of states in running text, by powers of the transitions."""
    a = m.start
    for _ in range(steps):
        a = a @ m.trans
    return a


def expected_counts(seqs: list[np.ndarray], m: HMM, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch: expected starts, transitions and emissions (classes x states) of the sequences.

    Where ``first`` is false, a sequence goes on with a text: its first token, counted with the window
    before, is only what the next one follows, and is no start.
    """
    k, c = len(m.start), m.n_classes
    start, trans, emit = np.zeros(k), np.zeros((k, k)), np.zeros((c, k))
    first = np.ones(len(seqs), bool) if first is None else first
    running = stationary(m)
    for idx, obs, active in lanes(seqs):
        steps = len(active)
        alpha, scale = [], []
        begins = first[idx]
        for t, n in enumerate(active):
            a = (alpha[-1][:n] @ m.trans if t else np.where(begins[:n, None], m.start, running)) * m.emit[obs[t, :n]]
            s = a.sum(1)
            alpha.append(a / s[:, None])
            scale.append(s)
        beta = np.ones((active[-1], k)) if steps else None
        for t in range(steps - 1, -1, -1):
            n = active[t]
            if t < steps - 1:
                nxt = active[t + 1]
                back = m.emit[obs[t + 1, :nxt]] * beta / scale[t + 1][:, None]
                trans += alpha[t][:nxt].T @ back
                full = np.ones((n, k))
                full[:nxt] = back @ m.trans.T
                beta = full
            alpha[t] = alpha[t] * beta  # now the state's posterior
        if steps:
            alpha[0] = alpha[0] * begins[: active[0], None]
            start += alpha[0].sum(0)
        seen = np.concatenate([obs[t, :n] for t, n in enumerate(active)]) if steps else np.empty(0, int)
        post = np.concatenate(alpha) if steps else np.empty((0, k))
        for j in range(k):
            emit[:, j] += np.bincount(seen, post[:, j], minlength=c)
    return start, trans * m.trans, emit


# ---- training ---------------------------------------------------------------------------------


def _coarse(obs: np.ndarray, m: HMM, top: int, pools: int) -> np.ndarray:
    """The ``top`` most frequent words, then ``pools`` groups of the bucket classes, then the rest."""
    b = obs - m.n_words
    return np.where(obs < top, obs, np.where((b >= 0) & (b < m.n_buckets), top + b % pools, top + pools))


def initial(seqs: DataFrame, m: HMM, states: int, top: int = 240, pools: int = 79, alpha: float = 0.5) -> HMM:
    """First parameters: word classes clustered by what follows them, over all training texts.

    Partitions count pairs of neighbouring coarse classes (a bounded table); the driver clusters the
    singular vectors of the scaled table, and each cluster favours its own words.
    """
    n = top + pools + 1

    def pairs(it):
        acc = np.zeros(n * n)
        for b in it:
            for raw in b.column(0).to_pylist():
                o = _coarse(np.frombuffer(raw, np.uint16).astype(np.int64), m, top, pools)
                acc += np.bincount(o[:-1] * n + o[1:], minlength=n * n)
        at = np.flatnonzero(acc)
        yield pa.RecordBatch.from_pydict({"i": at.astype(np.int32), "v": acc[at]})

    got = seqs.select("obs").mapInArrow(pairs, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    x = np.zeros(n * n)
    x[got["i"].to_numpy(int)] = got["v"]
    x = x.reshape(n, n)
    freq = x.sum(1) + x.sum(0)
    z = (x + x.T) / np.sqrt(np.outer(freq + 1, freq + 1))
    u, s, _ = np.linalg.svd(z)
    v = u[:, :states] * s[:states]
    v = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-12)
    order = np.argsort(-freq, kind="stable")
    centre = [v[order[0]]]
    while len(centre) < states:  # farthest first among classes that occur often
        often = order[: max(states, n // 2)]
        centre.append(v[often[np.argmin(np.max(v[often] @ np.array(centre).T, axis=1))]])
    centre = np.array(centre)
    for _ in range(20):
        near = np.argmax(v @ centre.T, axis=1)
        for j in range(states):
            if (near == j).any():
                centre[j] = (v[near == j] * freq[near == j, None]).sum(0)
        centre = centre / (np.linalg.norm(centre, axis=1, keepdims=True) + 1e-12)
    soft = np.exp(4 * (v @ centre.T))
    soft = soft / soft.sum(1, keepdims=True)
    coarse = _coarse(np.arange(m.n_classes), m, top, pools)
    mass = np.array([max(c, 1) for c in _class_counts(m)], float)
    emit = soft[coarse] * mass[:, None] + alpha
    m.emit = emit / emit.sum(0)
    m.start = np.full(states, 1 / states)
    m.trans = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    return m


def _class_counts(m: HMM) -> np.ndarray:
    out = np.zeros(m.n_classes)
    for k, c in m.lexicon.values():
        if k >= 0:
            out[k] = c
    out[m.n_words : m.n_words + m.n_buckets] = m.bucket_total
    return out


def baum_welch(seqs: DataFrame, m: HMM, iterations: int, piece: int = 256, alpha: float = 0.05) -> HMM:
    """``iterations`` rounds over all rows of ``seqs`` (obs binary)."""
    k, c = len(m.start), m.n_classes
    for _ in range(iterations):
        bc = seqs.sparkSession.sparkContext.broadcast(m)

        def counts(it, bc=bc):
            model, acc = bc.value, None
            for b in it:
                cuts = [windows(np.frombuffer(raw, np.uint16), piece) for raw in b.column(0).to_pylist()]
                first = np.array([not i for w in cuts for i in range(len(w))], bool)
                got = expected_counts([s for w in cuts for s in w], model, first)
                acc = got if acc is None else tuple(x + y for x, y in zip(acc, got, strict=True))
            if acc is not None:
                flat = np.concatenate([x.ravel() for x in acc])
                at = np.flatnonzero(flat > 1e-9)
                yield pa.RecordBatch.from_pydict({"i": at.astype(np.int32), "v": flat[at]})

        got = seqs.select("obs").mapInArrow(counts, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        flat = np.zeros(k + k * k + c * k)
        flat[got["i"].to_numpy(int)] = got["v"]
        start, trans, emit = flat[:k] + 1, flat[k : k + k * k].reshape(k, k) + 1, flat[k + k * k :].reshape(c, k) + alpha
        m.start, m.trans, m.emit = start / start.sum(), trans / trans.sum(1, keepdims=True), emit / emit.sum(0)
        bc.unpersist()
    return m


def hmm_scores(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 7,
    fold: int = 2,
    states: int = 8,
    n_words: int = 4096,
    n_buckets: int = 512,
    lexicon: int = 50_000,
    iterations: int = 3,
) -> DataFrame:
    """Score every row of ``docs`` with a model trained on those not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).
    ``lexicon`` bounds the words that every task holds in memory; the others are joined.
    """
    spark, where = docs.sparkSession, shared_dir(docs.sparkSession)
    kind = dict(docs.dtypes)[doc_id]
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(doc_id, folds, fold).alias("held_out"))
    counts = cut(token_counts(d.withColumn("_train", ~F.col("held_out")), n_buckets=n_buckets), where)
    total = counts.agg(F.sum("c"), F.count("*")).first()
    n, v = total[0] or 0, total[1]
    # The most frequent words by bins of the logarithm of their counts, so that histograms of bounded
    # size and at most ``lexicon`` words reach the driver, however many tasks there are. Of the first
    # bin that has more words than fit, those of the first hash slots are taken.
    level, slot = F.floor(F.log2("c") * 32).cast("int"), F.pmod(F.xxhash64("token"), F.lit(1024)).cast("int")
    word = F.col("token") != F.lit(bytearray(END))
    held, room = F.lit(False), lexicon
    for bin_, many in counts.where(word).groupBy(level.alias("b")).count().orderBy(F.desc("b")).collect():
        whole = many <= room
        if whole:
            held, room = level >= bin_, room - many
            continue
        upto = 0
        for at, some in counts.where(word & (level == bin_)).groupBy(slot.alias("s")).count().orderBy("s").collect():
            if some > room:
                break
            upto, room = at + 1, room - some
        held = (level > bin_) | ((level == bin_) & (slot < upto))
        break
    frequent = counts.where(word & held).select("token", "c").collect()
    frequent.sort(key=lambda r: (-r["c"], bytes(r["token"])))
    own = {bytes(r["token"]): (i if i < n_words else -1, r["c"]) for i, r in enumerate(frequent)}
    n_words = min(n_words, len(own))
    m = HMM({}, n_words, n_buckets, n, v, np.zeros(n_buckets))
    n_end = counts.where(F.col("token") == F.lit(bytearray(END))).agg(F.sum("c")).first()[0] or 0
    m.lexicon = own | {END: (m.n_classes - 1, n_end)}
    # what the bucket classes hold besides the words that are classes of their own
    sums = counts.groupBy("bucket").agg(F.sum("c"), F.count("*")).collect()
    types, tokens = np.zeros(n_buckets), np.zeros(n_buckets)
    for b, c, t in sums:
        tokens[b], types[b] = c, t
    for w, (k, c) in m.lexicon.items():
        if k >= 0 and c:
            tokens[bucket(w, n_buckets)] -= c
            types[bucket(w, n_buckets)] -= 1
    m.bucket_total = tokens
    log_den = np.log10(tokens + types + 1)

    # One pass makes class sequences and what the bounded vocabulary can settle.
    bc = spark.sparkContext.broadcast((m.lexicon, m.n_words, n_buckets, log_den))
    id_type = "bigint" if kind in ("tinyint", "smallint", "int", "bigint") else "string"
    seq_schema = pa.schema([("doc_id", pa.int64() if id_type == "bigint" else pa.string()), ("th", pa.int64()), ("held_out", pa.bool_()), ("obs", pa.binary()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("log_c", pa.float64()), ("log_in_class", pa.float64())])
    d = d.withColumn("doc_id", F.col("doc_id").cast(id_type))

    def sequences(it):
        lex, nw, nb, den = bc.value
        log_c = {w: (k, np.log10(c + 1), c > 0) for w, (k, c) in lex.items()}
        memo: dict = {}
        for b in it:
            rows = []
            for i, th, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), texts_of(b.column(3)), strict=True):
                ws = words(t)
                ws.append(END)
                if len(memo) > 300_000:
                    memo.clear()
                for w in set(ws).difference(memo):
                    k, lc, kn = log_c.get(w, (-1, 0.0, False))
                    if k < 0:
                        g = bucket(w, nb)
                        memo[w] = (nw + g, kn, lc, lc - den[g])
                    else:
                        memo[w] = (k, kn, lc, 0.0)
                got = np.array([memo[w] for w in ws])
                rows.append((i, th, h, got[:, 0].astype(np.uint16).tobytes(), len(ws), int(got[:, 1].sum()), float(got[:, 2].sum()), float(got[:, 3].sum())))
            yield to_batch(rows, seq_schema)

    keyed = d.select("doc_id", F.xxhash64("text").alias("th"), "held_out", "text")
    seqs = cut(keyed.mapInArrow(sequences, f"doc_id {id_type}, th long, held_out boolean, obs binary, n_tokens long, known long, log_c double, log_in_class double"), where)

    # Words beyond the bounded vocabulary meet their counts in a join. A row that occurs m times adds
    # its sums m times, so they are divided by m.
    pair_schema = pa.schema([("doc_id", seq_schema.field("doc_id").type), ("th", pa.int64()), ("token", pa.binary()), ("tf", pa.int64())])

    def rare(it):
        lex = bc.value[0]
        for b in it:
            ids, ths, toks, tfs = [], [], [], []
            for i, th, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts_of(b.column(2)), strict=True):
                got = [(w, c) for w, c in Counter(words(t)).items() if w not in lex]
                ids.extend([i] * len(got))
                ths.extend([th] * len(got))
                toks.extend(w for w, _ in got)
                tfs.extend(c for _, c in got)
                if len(ids) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, ths, toks, tfs), pair_schema, strict=True)], schema=pair_schema)
                    ids, ths, toks, tfs = [], [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, ths, toks, tfs), pair_schema, strict=True)], schema=pair_schema)

    pairs = keyed.select("doc_id", "th", "text").mapInArrow(rare, f"doc_id {id_type}, th long, token binary, tf long")
    rest = counts.where(word & ~held).select("token", "c")
    met = pairs.join(rest, "token").select("doc_id", "th", (F.col("tf") * F.log10(F.col("c") + 1)).alias("x"), F.col("tf").alias("kn"), F.lit(0).alias("rep"))
    met = met.unionByName(d.select("doc_id", F.xxhash64("text").alias("th"), F.lit(0.0).alias("x"), F.lit(0).cast("long").alias("kn"), F.lit(1).alias("rep")))
    sums = met.groupBy("doc_id", "th").agg((F.sum("x") / F.sum("rep")).alias("x"), (F.sum("kn") / F.sum("rep")).cast("long").alias("kn"))

    train = seqs.where(~F.col("held_out"))
    m = baum_welch(train, initial(train, m, states), iterations) if n else _untrained(m, states)
    bm = spark.sparkContext.broadcast(m)
    fwd_schema = pa.schema([*[seq_schema.field(x) for x in ("doc_id", "th", "held_out", "n_tokens", "known", "log_c", "log_in_class")], ("fwd", pa.float64())])

    def score(it):
        for b in it:
            ll = forward([np.frombuffer(x, np.uint16) for x in b.column("obs").to_pylist()], bm.value)
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in list(fwd_schema)[:-1]], pa.array(ll / np.log(10))], schema=fwd_schema)

    fwd = seqs.mapInArrow(score, f"doc_id {id_type}, th long, held_out boolean, n_tokens long, known long, log_c double, log_in_class double, fwd double")
    s = sums.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    return fwd.join(s, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("th").eqNullSafe(F.col("_th"))).select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("kn")).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_c") + F.col("x") - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (F.col("fwd") + F.col("log_in_class") + F.col("x")).alias("score"),
    )


def _untrained(m: HMM, states: int) -> HMM:
    m.start, m.trans = np.full(states, 1 / states), np.full((states, states), 1 / states)
    m.emit = np.full((m.n_classes, states), 1 / m.n_classes)
    return m
