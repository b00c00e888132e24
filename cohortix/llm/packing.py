"""Best-fit packing of tokenized documents into sequences by bin completion.

What has to be packed is known by its histogram: pieces have ``capacity`` possible lengths. The
driver solves the histogram (bounded by ``capacity`` rows, whatever the corpus): around the largest
piece left it enumerates undominated fillings from the least waste up and branches on them, each used
as often as the histogram allows at first. The best-fit-decreasing solution is the first incumbent and
bounds the waste that a branch may have. The plan says which ranks of which length go to which
sequences; every piece gets its rank within its length, in buckets of bounded size, and so its place.
Nothing but the histogram reaches the driver.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, give_back, shared_dir

TOKENIZER = "byte_bpe_50k.json"


# ---- tokens -----------------------------------------------------------------------------------


@functools.cache
def _tokenizer(name: str):
    """Texts to lists of ids. The rank file of the same vocabulary gives the same ids several times
    faster; a text that holds an added token of the JSON file, or that the pattern engine refuses, goes
    to the JSON file's tokenizer."""
    import base64
    import json
    import os
    import re

    import public_tokenizers as P

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    ranks = P.path(name.replace(".json", ".tiktoken"))
    fast = None
    if name == TOKENIZER and os.path.exists(ranks):
        import tiktoken

        with open(ranks, "rb") as f:
            fast = tiktoken.Encoding(name, pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, special_tokens={})

    @functools.cache
    def slow():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(P.path(name))

    with open(P.path(name), encoding="utf-8") as f:
        added = [t["content"] for t in json.load(f)["added_tokens"]]
    special = re.compile("|".join(map(re.escape, added)) or r"(?!)").search

    def encode(text: str) -> list[int]:
        if fast is not None and not special(text):
            try:
                return fast.encode_ordinary(text)
            except BaseException as e:  # the engine's panics derive from BaseException
                if isinstance(e, (KeyboardInterrupt, SystemExit)):
                    raise
        return slow().encode(text, add_special_tokens=False).ids

    return encode


def token_pieces(docs: DataFrame, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, with_ids: bool = False, tokenizer: str = TOKENIZER) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids.

    A document is its ids and then ``end_id``; a null text is empty and so one token long. Only
    documents longer than ``capacity`` are cut, from the end, so that the first piece takes the rest.
    Repeated rows are packed as often as they occur. Extra columns are ignored.
    """
    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def cut_up(it):
        encode, memo = _tokenizer(tokenizer), {}
        for b in it:
            cols: list[list] = [[] for _ in range(6)]
            at = []
            for row, t in enumerate(b.column(1).to_pylist()):
                t = t or ""
                if (got := memo.get(t)) is None:
                    ids = np.array([*encode(t), end_id], "<u4")
                    first = len(ids) % capacity or capacity
                    ends = range(first, len(ids) + 1, capacity)
                    starts = [0, *ends][: len(ends)]
                    got = [(i, s, e - s, zlib.crc32(ids[s:e].tobytes()), ids[s:e] if with_ids else None) for i, (s, e) in enumerate(zip(starts, ends, strict=True))]
                    if len(t) < 4000 and not with_ids:
                        if len(memo) > 5000:
                            memo.clear()
                        memo[t] = got
                for p in got:
                    at.append(row)
                    for c, x in zip(cols, p, strict=False):
                        c.append(x)
            arrays = [b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, k) for c, k in zip(cols[:4], (pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)]]
            if with_ids:
                arrays.append(pa.array([x.astype(np.int32) for x in cols[4]], pa.list_(pa.int32())))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut_up, schema)


# ---- the histogram's packing ------------------------------------------------------------------


def fillings(room: int, counts: dict[int, int], waste: int) -> Iterator[list[int]]:
    """Undominated fillings of ``room`` that leave at most ``waste``, from the least waste up.

    A filling dominates another whose pieces fit into its pieces as into bins. So one piece of just
    ``room`` dominates all, and a filling is dominated where a piece left out could take the place of
    some of its pieces (or of none) that are together no longer, and still fit.
    """
    if not room or counts.get(room):
        yield [room] if room else []
        return
    sizes = sorted((s for s in counts if s < room), reverse=True)
    mask = (1 << room + 1) - 1
    sums = [1]  # as bits, what the pieces from i on can fill; read from the end
    for s in reversed(sizes):
        bits, left, k = sums[-1], min(counts[s], room // s), 1
        while left:  # so many of s, in powers of two
            k = min(k, left)
            bits |= bits << s * k & mask
            left, k = left - k, 2 * k
        sums.append(bits)
    sums.reverse()

    def go(i: int, fill: int, got: list[int]) -> Iterator[list[int]]:
        if not fill:
            yield got
            return
        while i < len(sizes) and sums[i] >> fill & 1:
            s = sizes[i]
            i += 1
            for k in range(min(counts[s], fill // s), 0, -1):
                if sums[i] >> fill - k * s & 1:
                    yield from go(i, fill - k * s, [*got, *[s] * k])

    for w in range(min(room, waste) + 1):
        for got in go(0, room - w, []):
            if not _dominated(got, w, counts, sizes):
                yield got


def _dominated(got: list[int], slack: int, counts: dict[int, int], sizes: list[int]) -> bool:
    one, more, used = 0, 0, Counter(got)  # sums of one piece and of several, as bits
    for s in got:
        more |= (one | more) << s
        one |= 1 << s
    for s in sizes:
        if counts[s] > used[s] and (more >> s & 1 or (1 | one | more) >> max(0, s - slack) & ((1 << min(slack, s)) - 1)):
            return True
    return False


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs, counting the room beside long pieces that no other can fill.

    For each length a: pieces longer than capacity - a fill a sequence alone as far as those of length
    a and more go; those over half a sequence have one each; the rest fills what these leave.
    """
    if not counts:
        return 0
    n = np.zeros(capacity + 2, np.int64)
    n[list(counts)] = list(counts.values())
    many, total = np.cumsum(n), np.cumsum(n * np.arange(capacity + 2))
    half = capacity // 2
    a = np.arange(half + 1)
    large, middle = many[-1] - many[capacity - a], many[capacity - a] - many[half]
    room = middle * capacity - (total[capacity - a] - total[half])
    small = total[half] - np.where(a > 0, total[a - 1], 0)
    return int((large + middle + np.maximum(0, -(-(small - room) // capacity))).max())


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit decreasing on the histogram: (pieces, how often) patterns. Bins alike are kept together."""
    open_bins: dict[int, Counter] = {}
    for s in sorted(counts, reverse=True):
        n = counts[s]
        while n:
            room = min((r for r in open_bins if r >= s), default=None)
            if room is None:
                per = capacity // s
                full, rest = divmod(n, per)
                for k, many in ((per, full), (rest, 1)):
                    if k and many:
                        open_bins.setdefault(capacity - k * s, Counter())[(s,) * k] += many
                n = 0
                continue
            pattern, many = next(iter(open_bins[room].items()))
            used = min(n, many)
            open_bins[room][pattern] -= used
            if not open_bins[room][pattern]:
                del open_bins[room][pattern]
                if not open_bins[room]:
                    del open_bins[room]
            open_bins.setdefault(room - s, Counter())[(*pattern, s)] += used
            n -= used
    return [(list(p), m) for bins in open_bins.values() for p, m in bins.items()]


def _less(c: dict[int, int], pieces: list[int], times: int = 1) -> dict[int, int]:
    out = dict(c)
    for s, k in Counter(pieces).items():
        out[s] -= k * times
        if not out[s]:
            del out[s]
    return out


def complete(counts: dict[int, int], capacity: int, most: int, nodes: int | None) -> list[tuple[list[int], int]] | None:
    """Bin completion: the best patterns (pieces, how often) found in at most ``most`` sequences.

    Depth first over fillings around the largest piece left. A branch ends where its waste, or the
    lower bound of what is left, can no longer reach ``most``, which falls below each solution found.
    ``nodes`` bounds the branches tried; None searches until the best is proved.
    """
    total, least = sum(s * n for s, n in counts.items()), lower_bound(counts, capacity)
    best = None
    path: list[tuple[list[int], int]] = []
    used, waste, spent = [0], [0], 0

    def branches(left: dict[int, int]) -> Iterator[tuple[list[int], int, dict[int, int]]]:
        top = max(left)
        rest = _less(left, [top])
        for p in fillings(capacity - top, rest, most * capacity - total - waste[-1]):
            if waste[-1] + capacity - top - sum(p) > most * capacity - total:  # ``most`` has fallen
                return
            pattern = [top, *p]
            for times in range(min(left[s] // k for s, k in Counter(pattern).items()), 0, -1):
                yield pattern, times, _less(left, pattern, times)

    stack = [branches(counts)] if counts else []
    while stack:
        step = next(stack[-1], None)
        spent += 1
        if step is None or (nodes is not None and spent > nodes):
            if step is not None:
                break
            stack.pop()
            if path:
                path.pop(), used.pop(), waste.pop()
            continue
        pattern, times, left = step
        bins, lost = used[-1] + times, waste[-1] + times * (capacity - sum(pattern))
        if lost > most * capacity - total or bins + (lower_bound(left, capacity) if left else 0) > most:
            continue
        if left:
            path.append((pattern, times)), used.append(bins), waste.append(lost)
            stack.append(branches(left))
            continue
        best, most = [*path, (pattern, times)], bins - 1
        if bins <= least:
            break
    return best


def solve(counts: dict[int, int], capacity: int, nodes: int | None = 20_000) -> list[tuple[list[int], int]]:
    """Patterns (pieces, how often) that pack the histogram, each piece once, by bin completion.

    Best fit's solution is the incumbent: it bounds the search, and stands where ``nodes`` branches
    find none that needs as few sequences.
    """
    counts = {int(s): int(n) for s, n in counts.items() if n}
    incumbent = best_fit(counts, capacity)
    return complete(counts, capacity, sum(m for _, m in incumbent), nodes) or incumbent


def _solved(spark: SparkSession, hist: dict[int, int], capacity: int, nodes: int | None) -> list[tuple[list[int], int]]:
    """``solve`` in a task, as its search takes much memory that the driver need not have; patterns come back."""

    def search(it):
        counts = {s: n for b in it for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
        if counts:
            plan = solve(counts, capacity, nodes)
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in plan], pa.list_(pa.int32())), pa.array([m for _, m in plan], pa.int64())], names=["pieces", "times"])

    rows = spark.createDataFrame([(int(s), int(n)) for s, n in hist.items()], "length int, n long").coalesce(1)  # at most ``capacity`` rows
    return [(list(r["pieces"]), r["times"]) for r in rows.mapInArrow(search, "pieces array<int>, times long").collect()]


# ---- the packing of a table -------------------------------------------------------------------


def pack(docs: DataFrame, capacity: int = 2048, per_bucket: int = 2_000, nodes: int | None = 20_000, **kw) -> DataFrame:
    """Pieces of all documents with sequence_id and offset, in as few sequences as the solver finds.

    ``per_bucket`` bounds the rows that are ranked together, so a length that a third of all pieces
    share is ranked in many tasks. ``nodes`` bounds the solver's search; None proves the fewest.
    Null ids are packed like others, null and empty texts are one end token, repeated rows are packed
    as often as they occur, empty tables give no rows and extra columns are ignored.
    """
    where = shared_dir(docs.sparkSession)
    pieces = cut(token_pieces(docs, capacity, **kw), where)
    hist = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = _solved(docs.sparkSession, hist, capacity, nodes)
    # For each length, ranks [first, last) go to a slot of a run of equal sequences.
    used: Counter = Counter()
    rows, base = [], 0
    for pattern, times in plan:
        offset = 0
        for s in pattern:
            rows.append((s, used[s], base, offset))
            used[s] += times
            offset += s
        base += times
    slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    for s in hist:
        own = sorted(r[1:] for r in rows if r[0] == s)
        slots[int(s)] = tuple(np.array(x, np.int64) for x in zip(*own, strict=True))
    bc = docs.sparkSession.sparkContext.broadcast(slots)
    del plan, rows
    give_back()  # the search leaves much behind on the driver

    if not hist:
        return pieces.withColumns({"sequence_id": F.lit(None).cast("long"), "offset": F.lit(None).cast("long")})
    n_buckets = F.array(*[F.lit(-(-hist.get(s, 1) // per_bucket)) for s in range(capacity + 1)])
    # what spreads repeated rows is their place in the written table
    salted = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.get(n_buckets, F.col("length").cast("int"))))
    salted = cut(salted, where)
    sizes = salted.groupBy("length", "_b").count()
    before = sizes.withColumn("_before", F.sum("count").over(Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    keys = before.select("length", "_b", F.coalesce("_before", F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = salted.withColumn("_rank", rank).join(keys, ["length", "_b"]).withColumn("_rank", (F.col("_rank") - 1 + F.col("_before")).cast("long")).drop("_b", "_before")

    names = [c for c in ranked.columns if c != "_rank"]

    def place(it):
        slot = bc.value
        for b in it:
            lengths, ranks = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for s in np.unique(lengths):
                first, start, offset = slot[int(s)]
                at = np.flatnonzero(lengths == s)
                j = np.searchsorted(first, ranks[at], side="right") - 1
                seq[at], off[at] = start[j] + ranks[at] - first[j], offset[j]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], pa.array(seq), pa.array(off)], names=[*names, "sequence_id", "offset"])

    cols = [f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name in names]
    return ranked.mapInArrow(place, ", ".join([*cols, "sequence_id long", "offset long"])).select(*pieces.columns, "sequence_id", "offset")
