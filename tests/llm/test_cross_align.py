"""Cross-tokenizer alignment against a plain reckoning over byte ranges, with the JSON tokenizer."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from cohortix.llm import cross_align as C

TEXTS = [
    "plain words, and more words", "plain words, and more words", "  two  spaces ", "\n\nline\tends\r\n", "<|endoftext|> </s> <s> <unk>", "café 日本語 \U0001f44d\U0001f3fd naïve",
    "▁held", "zero\x00byte", "�", "don't it's WE'LL", "12345 67,890.12", "x" * 5_000, "the the the " * 700, None, "", " ", "a", "‍​", "การ אב", "\x1c\x85\xa0",
]


def brute(rows):
    """Ranges of all tokens and every overlapping pair, one text after another."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    byte = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in byte} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in byte)}
    a_bytes = lambda i: bytes(byte_of[c] for c in a_tok.id_to_token(i))

    def b_bytes(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode()

    def ranges(ids, of):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(of(i)), i))
            at += len(of(i))
        return out

    seen, holds = [], Counter()
    for i, text in rows:
        raw = b" " + (text or "").encode()
        a, b = (a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)) if text else ([], [])
        if not text or b"".join(map(a_bytes, a)) != raw or b"".join(map(b_bytes, b)) != raw:
            seen.append((i, [], [], [], ""))
            continue
        ra, rb = ranges(a, a_bytes), ranges(b, b_bytes)
        links, lo = [], 0
        for x in ra:
            while rb[lo][1] <= x[0]:
                lo += 1
            j = lo
            while j < len(rb) and rb[j][0] < x[1]:
                links.append((x[2], rb[j][2]))
                j += 1
        ends, groups, last = sorted({x[1] for x in ra} & {x[1] for x in rb}), [], 0
        for e in ends:
            groups.append("|".join(",".join(str(x[2]) for x in r if last < x[1] <= e) for r in (ra, rb)))
            last = e
        seen.append((i, ra, rb, links, ";".join(groups)))
        holds.update(set(links))
    top = Counter()
    for (a, _), n in holds.items():
        top[a] = max(top[a], n)
    return sorted(
        (i, len(ra), len(rb), g.count(";") + 1 if g else 0, len(links), sum(holds[p] == top[p[0]] for p in links), sum(holds[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for i, ra, rb, links, g in seen
    )


@pytest.mark.parametrize("chunk_pairs", [1, 60, C.CHUNK_PAIRS])
def test_equals_a_plain_reckoning(spark, docs, chunk_pairs):
    rows = list(enumerate(TEXTS)) + [(500, TEXTS[0]), (3, TEXTS[0])]
    out = C.cross_align(docs(rows).repartition(3), chunk_pairs=chunk_pairs)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect())) == brute(rows)


def test_documents_equal_a_plain_reckoning(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars < 600")
    assert sorted(map(tuple, C.cross_align(d).collect())) == brute([(r.doc_id, r.text) for r in d.collect()])


def test_an_empty_table_and_null_ids(spark, docs):
    assert C.cross_align(docs([])).collect() == []
    assert sorted(r.n_a for r in C.cross_align(docs([(None, "a b"), (None, None)])).collect()) == [0, 2]
