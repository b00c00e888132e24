"""Alignment of two tokenizers over a corpus: each distinct text is tokenised and aligned once.

Texts are told apart in full by a shuffle on the text itself, and carry their number of rows. A task aligns its texts
in chunks of bounded size and stores, for each chunk, the distinct pairs of linked ids and, for each text, which of
them it holds and how often. Counts of pairs are sums over chunks, weighted by the texts' rows; a chunk is then given
the counts of its own pairs, computes its texts' measures, and these are joined to the documents by the text's SHA-256.

A link is a pair of token occurrences whose byte ranges overlap. Between two neighbouring ends, of either tokenizer,
lies one link, so links are as many as distinct ends, and groups as many as common ends.

Defined results: null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens:
zeros and an empty string. A document counts once for a pair however often it is linked there; repeated rows are
documents of their own. Null ids stay null; an empty table gives no rows; extra columns are ignored. Texts of any
length are aligned whole, one at a time.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

A_NAME, B_NAME = "byte_bpe_50k", "piece_bpe_32k.model"
#: Pairs of its texts after which a chunk is closed; a text is never split.
CHUNK_PAIRS = 1_000_000
CHUNKS = "chunk string, keys binary, sizes binary, held binary, times binary, shas binary, pairs binary, weights binary"
MEASURES = "sha binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Tokenizers:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_name: str = A_NAME, b_name: str = B_NAME):
        import public_tokenizers as P
        import sentencepiece
        import tiktoken

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(P.path(f"{a_name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(x): int(i) for x, i in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(a_name, pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_json = P.path(f"{a_name}.json")
        self.piece = sentencepiece.SentencePieceProcessor(model_file=P.path(b_name))
        by_id = {i: x for x, i in ranks.items()}
        self.a_bytes = np.array([by_id.get(i, b"") for i in range(max(by_id) + 1)], object)
        p = self.piece
        named = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        self.b_bytes = np.array([bytes([int(x[3:5], 16)]) if p.is_byte(i) else x.replace("\u2581", " ").encode() for i, x in enumerate(named)], object)
        self.a_len, self.b_len = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        # what stands for a token in the text that is digested: inside a group, or last in it
        said = lambda n, end: [b"%d%c" % (i, end) for i in range(n)]
        na, nb = len(self.a_bytes), len(self.b_bytes)
        self.said = np.array(said(na, 44) + said(na, 124) + said(nb, 44) + said(nb, 59), object)

    @functools.cached_property
    def slow(self):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(self.a_json)
        t.encode_special_tokens = True
        return t

    def a(self, text: str) -> list[int]:
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as e:  # the engine's panics derive from BaseException
            if isinstance(e, (KeyboardInterrupt, SystemExit)):
                raise
            return self.slow.encode(text, add_special_tokens=False).ids

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray, int] | None:
        """Ids of both and the number of bytes of space and text; None where the bytes do not come back."""
        raw = b" " + text.encode()
        a, b = (np.array(x, np.int64) for x in (self.a(" " + text), self.piece.encode(text)))
        if any(b"".join(t[i].tolist()) != raw for t, i in ((self.a_bytes, a), (self.b_bytes, b))):
            return None
        return a, b, len(raw)


class Aligned(NamedTuple):
    """Numbers of tokens, groups and links; the distinct linked pairs in order with their numbers; the groups as text."""

    sizes: tuple[int, int, int, int]
    pairs: np.ndarray
    times: np.ndarray
    said: bytes


def align(t: Tokenizers, text: str) -> Aligned | None:
    """Both tokenizers over one text; a pair of ids is a << 32 | b. None where a tokenizer loses bytes."""
    if (got := t.tokens(text)) is None:
        return None
    a, b, n = got
    ea, eb = np.cumsum(t.a_len[a]), np.cumsum(t.b_len[b])
    mark = np.zeros(n + 1, np.uint8)
    mark[ea] = 1
    mark[eb] += 2
    kind = mark[np.flatnonzero(mark)]
    ia, ib = np.cumsum(kind & 1, dtype=np.int64), np.cumsum(kind >> 1, dtype=np.int64)  # tokens that have ended there
    links = a[ia - (kind & 1)] << 32 | b[ib - (kind >> 1)]
    common = kind == 3
    a_last, b_last = mark[ea] == 3, mark[eb] == 3
    ga, gb = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    b_before = np.concatenate([[0], ib[common]])
    code = np.empty(len(a) + len(b), np.int64)
    na, nb = len(t.a_bytes), len(t.b_bytes)
    code[np.arange(len(a)) + b_before[ga]] = a + na * a_last
    code[np.arange(len(b)) + ia[common][gb]] = 2 * na + b + nb * b_last
    return Aligned((len(a), len(b), int(common.sum()), len(links)), *np.unique(links, return_counts=True), b"".join(t.said[code].tolist())[:-1])


@functools.cache
def _tokenizers() -> Tokenizers:
    return Tokenizers()


def _chunks(most_pairs: int):
    def chunks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, held = _tokenizers(), []

        def out() -> pa.RecordBatch:
            """Pairs of the chunk in order; for each text the places of its pairs, as steps, and how often each is linked."""
            every = np.concatenate([h[2].pairs for h in held])
            own = np.array([len(h[2].pairs) for h in held], np.int64)
            pairs, at = np.unique(every, return_inverse=True)
            weights = np.zeros(len(pairs), np.int64)
            np.add.at(weights, at, np.repeat(np.array([h[1] for h in held], np.int64), own))
            steps = np.diff(at, prepend=0)
            starts = np.cumsum(own) - own
            steps[starts] = at[starts]
            sizes = np.array([(*h[2].sizes, len(h[2].pairs)) for h in held], np.int64)
            times = np.concatenate([h[2].times for h in held])
            row = [uuid.uuid4().hex, b"".join(h[0] for h in held), sizes.tobytes(), steps.astype(np.uint32).tobytes(), times.astype(np.uint32).tobytes(), b"".join(h[3] for h in held), pairs.tobytes(), weights.tobytes()]
            held.clear()
            names = [c.split()[0] for c in CHUNKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], pa.string() if isinstance(x, str) else pa.binary()) for x in row], names=names)

        size = 0
        for b in it:
            for text, rows in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                text = text.as_py()
                if (got := align(t, text)) is None:
                    continue
                held.append((hashlib.sha256(text.encode()).digest(), rows, got._replace(said=b""), hashlib.sha256(got.said).digest()))
                size += len(got.pairs)
                if size >= most_pairs:
                    yield out()
                    size = 0
        if held:
            yield out()

    return chunks


def _unpacked(with_weights: bool):
    """Rows of the chunks' pairs, with the weight or with the chunk's name."""

    def unpack(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(len(b)):
                pairs = np.frombuffer(b.column(1)[i].as_buffer(), np.int64)
                for lo in range(0, len(pairs), 50_000):
                    p = pairs[lo : lo + 50_000]
                    other = pa.array(np.frombuffer(b.column(0)[i].as_buffer(), np.int64)[lo : lo + 50_000]) if with_weights else pa.array([b.column(0)[i].as_py()] * len(p), pa.string())
                    yield pa.RecordBatch.from_arrays([other, pa.array(p)], names=["weight" if with_weights else "chunk", "pair"])

    return unpack


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no other pair of its A id has more."""
    rows = chunks.select("weights", "pairs").mapInArrow(_unpacked(True), "weight long, pair long")
    n = cut(rows.groupBy("pair").agg(F.sum("weight").alias("n")))
    # a row an id of the vocabulary at most, so its size is bounded whatever the corpus
    top = n.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("top"))
    return n.join(F.broadcast(top), F.shiftright("pair", 32) == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _measure(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """Measures of one chunk's texts from the counts of its pairs."""
    names = [c.split()[0] for c in MEASURES.split(", ")]
    got = chunk.combine_chunks().to_batches()
    ints = lambda c, k: np.frombuffer(got[0].column(c)[0].as_buffer(), k)
    shas, digests = ints("keys", np.uint8).tobytes(), ints("shas", np.uint8).tobytes()
    sizes = ints("sizes", np.int64).reshape(-1, 5)
    own = sizes[:, 4]
    starts = np.cumsum(own) - own
    steps, times = ints("held", np.uint32).astype(np.int64), ints("times", np.uint32).astype(np.int64)
    at = np.cumsum(steps)
    at -= np.repeat(at[starts] - steps[starts], own)
    order = np.argsort(counts.column("pair").to_numpy())
    n = counts.column("n").to_numpy()[order][at]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order][at]
    sums = [np.add.reduceat(x, starts) for x in (times * best, times * n)]
    part = lambda x: [x[i : i + 32] for i in range(0, len(x), 32)]
    cols = [pa.array(part(shas), pa.binary()), *[pa.array(sizes[:, i]) for i in range(4)], *map(pa.array, sums), pa.array([x.hex() for x in part(digests)])]
    return pa.table(cols, names=names)


def cross_align(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """A row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair is held by as many documents as any pair of its A id; ``count_sum`` sums
    the pairs' counts over the links. A link's counts are those of the whole table.
    """
    texts = docs.select(F.col(text).cast("string").alias("text")).where("text <> ''").groupBy("text").agg(F.count("*").alias("n"))
    chunks = cut(texts.mapInArrow(_chunks(chunk_pairs), CHUNKS), options={"compression": "zstd"})
    wanted = chunks.select("chunk", "pairs").mapInArrow(_unpacked(False), "chunk string, pair long")
    counts = wanted.join(pair_counts(chunks), "pair").select("chunk", "pair", "n", "best")
    measures = chunks.drop("pairs", "weights").groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_measure, MEASURES)
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)).alias("sha"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    return ids.join(measures.hint("merge"), "sha", "left").select("doc_id", *zero, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
