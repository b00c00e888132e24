"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import cross_align, decontamination, flac, hmm, html_text, near_dup, packing, quality, spelling, stream_dedup, toxicity, url_filter, warc
from .common import table


def op1_hmm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.hmm_scores(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op7_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.media_column(table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.train_quality(docs, table(spark, sf_dir, "labels")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, table(spark, sf_dir, "labels")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_align.cross_align(table(spark, sf_dir, "documents"))


def op13_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_dedup.stream_dedup(stream_dedup.stream_of(spark, f"{sf_dir}/documents.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_hmm_scores, op2_packing, op3_decontamination, op4_url_filter, op5_warc, op6_html_text, op7_flac, op8_near_duplicates, op9_quality, op10_toxicity, op11_spelling, op12_cross_align, op13_stream_dedup)
    }


def oracle_sql() -> dict[str, str]:
    """SQL cannot express training, branch and bound or chosen paths; containment and exact copies it can."""
    return {"op3_decontamination": OP3_SQL, "op13_stream_dedup": OP13_SQL}


OP3_SQL = r"""
WITH d AS (SELECT doc_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM documents),
b AS (SELECT item_id, [x for x in regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM benchmark),
bs AS (SELECT DISTINCT item_id, least(len(w), 5) AS width, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s FROM b, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
widths AS (SELECT DISTINCT width FROM bs),
ds AS (SELECT DISTINCT doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS s FROM d, widths, unnest(range(1, len(w) - width + 2)) t(i)),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (width, s) WHERE doc_id IS NOT NULL AND item_id IS NOT NULL GROUP BY doc_id, item_id)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_item_shingles, CAST(n_shared AS BIGINT) AS n_shared, n_shared / n AS containment
FROM m JOIN n USING (item_id) WHERE n_shared >= ceil(0.75 * n)
"""

OP13_SQL = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""
