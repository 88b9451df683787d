"""The text operators over the shared tables, one query each, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm.common import table


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.suffix_dedup import removed_bytes

    return removed_bytes(table(spark, folder, "documents")).drop("starts", "ends")


def op2_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.fingerprints import edited_fingerprints

    return edited_fingerprints(table(spark, folder, "documents"))


def op3_mixing_sources(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.mixing import mix_sources

    weights = {"clean": 0.9, "junk": 0.08, "toxic": 0.02}
    return mix_sources(table(spark, folder, "documents"), table(spark, folder, "labels"), weights)


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.secrets import secret_scan

    return secret_scan(table(spark, folder, "documents"))


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.quality import fit_quality, judge_quality

    docs = table(spark, folder, "documents")
    return judge_quality(docs, fit_quality(docs, table(spark, folder, "labels")))


def op7_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.licenses import license_passages

    return license_passages(table(spark, folder, "documents"))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.packing import pack_sequences

    return pack_sequences(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.pii import personal_data

    return personal_data(table(spark, folder, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.near_dedup import Plan, near_duplicates

    return near_duplicates(table(spark, folder, "documents"), Plan(words=2))


def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.ranked import build_index, ranked_search

    return ranked_search(build_index(table(spark, folder, "documents")), table(spark, folder, "benchmark"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.byte_bpe import decode, encode

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = encode(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)
    return decode(found, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    from martwright.llm.alignment import link_statistics

    a, b = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return link_statistics(table(spark, folder, "documents"), a, b)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_document_fingerprints": op2_document_fingerprints,
    "op3_mixing_sources": op3_mixing_sources,
    "op4_secret_scans": op4_secret_scans,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_license_scans": op7_license_scans,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_pii": op9_pii,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_token_alignment": op13_token_alignment,
}
# Links by counting common shingles, then everything that can be reached. The other queries decide by
# trained models, tokenizers or hashes; their tests compare with plain Python.
ORACLE_SQL: dict[str, str] = {
    "op10_minhash_near_dedup": r"""
        WITH RECURSIVE worded AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        shingled AS (
            SELECT doc_id, unnest(w[:-2]) AS one, unnest(w[2:]) AS two FROM worded WHERE len(w) > 1
            UNION ALL
            SELECT doc_id, w[1], NULL FROM worded WHERE len(w) = 1),
        sets AS (SELECT DISTINCT * FROM shingled),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY ALL),
        common AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
            FROM sets a JOIN sets b
              ON a.one = b.one AND a.two IS NOT DISTINCT FROM b.two AND a.doc_id <> b.doc_id
            GROUP BY ALL),
        links AS (
            SELECT x, y FROM common JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
            WHERE 100 * shared >= 80 * (s.n + t.n - shared)),
        reached AS (
            SELECT doc_id AS x, doc_id AS y FROM worded
            UNION
            SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
        named AS (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY ALL)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM named LEFT JOIN sizes USING (doc_id)""",
    "op11_ranked_search": r"""
        WITH cut AS (
            SELECT doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents),
        postings AS (SELECT doc_id, term, count(*) AS tf FROM cut GROUP BY ALL),
        lengths AS (SELECT doc_id, sum(tf)::BIGINT AS size FROM postings GROUP BY ALL),
        totals AS (SELECT count(*) AS documents, sum(size)::BIGINT AS terms FROM lengths),
        held AS (SELECT term, count(*) AS df FROM postings GROUP BY ALL),
        weights AS (
            SELECT term, floor(1000 * ln((2 * documents + 2) / (2 * df + 1)))::BIGINT AS w FROM held, totals),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        scored AS (
            SELECT item_id, doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * size * documents) // terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), totals
            GROUP BY ALL),
        ranked AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
                doc_id, score
            FROM scored WHERE score > 0)
        SELECT * FROM ranked WHERE rank <= 10""",
}
