"""Streaming exact deduplication against plain grouping, across runs, and with equal digests of different texts."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest

from cohortix.llm import stream_dedup as S

SCHEMA = "doc_id long, text string, keep_id string, sha string, at double"
ROWS = [
    (5, "Same Text"), (9, "same tEXT"), (2, "same text"), (7, "\u00c9t\u00e9"), (8, "\u00e9t\u00e9"), (1, None), (3, ""), (4, " "), (10, "same text "),
    (None, "no id"), (11, "No id"), (None, "alone"), (12, "repeated"), (12, "repeated"), (13, "long " * 50_000), (14, "LONG " * 50_000),
]


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    keep = {t: max((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted(((i, keep[lower(t)], len(groups[lower(t)]), i == keep[lower(t)], hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


def write(spark, rows, path, parts=3):
    spark.createDataFrame([(i, t, "x", "y", 1.0) for i, t in rows], SCHEMA).repartition(parts).write.mode("append").parquet(path)


@pytest.mark.parametrize("bits", [256, 1])
def test_equals_grouping_of_whole_texts(spark, tmp_path, bits):
    """One bit of digest makes nearly all texts hits whose bytes differ: they take slots of their own."""
    write(spark, ROWS, str(tmp_path / "in"))
    out = S.stream_dedup(S.stream_of(spark, str(tmp_path / "in")), f"file://{tmp_path}/state", bits=bits, buckets=3)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert got(out) == brute(ROWS)


def test_a_later_run_goes_on_from_the_state(spark, tmp_path):
    where, more = f"file://{tmp_path}/state", [(20, "SAME text"), (21, "new"), (0, "long " * 50_000), (22, "alone")]
    write(spark, ROWS, str(tmp_path / "in"))
    S.stream_dedup(S.stream_of(spark, str(tmp_path / "in")), where, bits=2)
    write(spark, more, str(tmp_path / "in"), 1)
    out = S.stream_dedup(S.stream_of(spark, str(tmp_path / "in")), where, bits=2)
    assert got(out) == brute(ROWS + more)
    again = S.stream_dedup(S.stream_of(spark, str(tmp_path / "in")), where, bits=2)  # nothing new
    assert got(again) == brute(ROWS + more)


def test_small_batches(spark, tmp_path):
    write(spark, ROWS, str(tmp_path / "in"), 4)
    out = S.stream_dedup(S.stream_of(spark, str(tmp_path / "in"), batch=1), f"file://{tmp_path}/state")
    assert got(out) == brute(ROWS)


def test_a_single_file_and_text_ids(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"doc_id": ["b", "a", None], "text": ["x", "X", "x"]}), tmp_path / "one.parquet")
    out = S.stream_dedup(S.stream_of(spark, str(tmp_path / "one.parquet")), f"file://{tmp_path}/state")
    sha = hashlib.sha256(b"x").hexdigest()
    assert got(out) == sorted([("b", "b", 3, True, sha), ("a", "b", 3, False, sha), (None, "b", 3, False, sha)], key=str)


def test_an_empty_table(spark, tmp_path):
    write(spark, [], str(tmp_path / "in"), 1)
    assert got(S.stream_dedup(S.stream_of(spark, str(tmp_path / "in")), f"file://{tmp_path}/state")) == []


def test_settings_of_the_session_stay(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in S.STATE_CONF}
    write(spark, ROWS[:2], str(tmp_path / "in"))
    S.stream_dedup(S.stream_of(spark, str(tmp_path / "in")), f"file://{tmp_path}/state").collect()
    assert {k: spark.conf.get(k, None) for k in S.STATE_CONF} == before
