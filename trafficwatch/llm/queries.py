"""The registered ``opN_<name>`` queries: each operator on its whole table."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trafficwatch.llm.base import table
from trafficwatch.llm.bpe_replay import round_trip_digests
from trafficwatch.llm.chat_format import chat_report
from trafficwatch.llm.exact_dedup import dedup_report
from trafficwatch.llm.langid import identify
from trafficwatch.llm.line_dedup import line_report
from trafficwatch.llm.merkle import manifest_report
from trafficwatch.llm.packing import pack_documents
from trafficwatch.llm.recompression import run_report
from trafficwatch.llm.repair import round_trip
from trafficwatch.llm.simhash import near_duplicates
from trafficwatch.llm.toxicity import score_documents
from trafficwatch.llm.warc import derivative_report
from trafficwatch.llm.winnow import edit_report


def op1_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(table(spark, sf_dir, "documents"),
                              public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivative_report(table(spark, sf_dir, "pages"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


def op8_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_report(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op11_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_replay": op1_bpe_replay,
    "op2_langid": op2_langid,
    "op3_simhash": op3_simhash,
    "op4_toxicity": op4_toxicity,
    "op5_warc": op5_warc,
    "op6_packing": op6_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_repair": op8_repair,
    "op9_winnowing": op9_winnowing,
    "op10_line_dedup": op10_line_dedup,
    "op11_recompression": op11_recompression,
    "op12_merkle": op12_merkle,
    "op13_chat_format": op13_chat_format,
}

#: DuckDB statements of the queries that SQL can express on the whole tables.
SQL: dict[str, str] = {
    "op7_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op10_line_dedup": """
        WITH lines AS (
            SELECT doc_id, line, place,
                   translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
                  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
        ), frequent AS (
            SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
        FROM lines LEFT JOIN frequent f USING (key)
        GROUP BY doc_id
    """,
}
