"""Thin registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embed_dup, hamming, line_dedup, lm_score, mixing, near_dup, packing, quality, revisits, token_count
from .common import documents

#: Where the public tokenizer files are; None takes the installed package's own folder.
TOKENIZERS: str | None = None


def tokenizer(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return str(public_tokenizers.path(name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and its SQL where SQL can express it."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


@query("op1_pq_near_dup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


_CODE = " | ".join(f"(CASE WHEN embedding[{i + 1}] > 0 THEN (1::UBIGINT << {i}) ELSE 0::UBIGINT END)" for i in range(64))


@query(
    "op4_multi_index_hamming",
    f"""
    WITH c AS (SELECT vec_id, {_CODE} AS code FROM embeddings),
    d AS (
        SELECT q.vec_id AS query_id, b.vec_id AS id, bit_count(xor(q.code, b.code))::BIGINT AS distance
        FROM c q JOIN c b ON q.vec_id % 50 = 0 AND q.vec_id <> b.vec_id
    )
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::BIGINT AS rank, id, distance
    FROM d QUALIFY rank <= 10
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code"))
    return hamming.top_k(codes, codes.where("id % 50 = 0"))


@query("op2_rule_quality")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(documents(spark, sf_dir, "doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality"))


@query("op3_context_mixing")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(documents(spark, sf_dir, "doc_id", "text"))


@query("op5_target_mix")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source")).drop("source")


_CANON = r"""
    regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(c, '^([^/?]*)', 1)), '^.*@', ''), '^www[0-9]*\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(c, '^[^/?]*([^?]*)', 1), '/+$', '')
    || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END
"""


@query(
    "op6_revisit_asof",
    rf"""
    WITH r AS (
        SELECT page_id * 2 AS record_id, true AS is_full, url, page_id AS captured_at, md5(coalesce(html, '')) AS etag, page_id::VARCHAR AS modified,
               page_id AS d, octet_length(encode(html)) AS n, html FROM pages
        UNION ALL
        SELECT page_id * 2 + 1, false, url || '#again', CASE WHEN page_id % 11 = 0 THEN page_id - 5 ELSE page_id + 1 + page_id % 7 END AS t,
               CASE WHEN page_id % 3 <> 0 THEN md5(coalesce(html, '') || CASE WHEN page_id % 5 = 0 THEN 'x' ELSE '' END) END,
               CASE WHEN page_id % 3 = 0 THEN (page_id + page_id % 2)::VARCHAR END, t, NULL, NULL FROM pages
    ),
    s AS (
        SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS c,
               list_sort(list_filter(string_split(regexp_extract(c, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^({revisits.TRACKING})(=|$)', 'i'))) AS parts
        FROM r
    ),
    u AS (SELECT *, {_CANON} AS canonical_url FROM s),
    f AS (
        SELECT canonical_url AS fu, captured_at AS fat, max(record_id) AS response_id, arg_max(etag, record_id) AS fe, arg_max(modified, record_id) AS fm, arg_max(n, record_id) AS fn
        FROM u WHERE is_full GROUP BY 1, 2
    ),
    j AS (SELECT u.*, f.* FROM (SELECT * FROM u WHERE NOT is_full) u ASOF LEFT JOIN f ON u.canonical_url = f.fu AND u.captured_at > f.fat),
    k AS (SELECT *, response_id IS NOT NULL AND CASE WHEN etag IS NOT NULL THEN etag = fe ELSE modified = fm END AS ok FROM j)
    SELECT record_id, canonical_url, 'response' AS state, record_id AS response_id, n AS payload_bytes, 'max-age=60' AS cache_control, d::VARCHAR AS date, n::VARCHAR AS content_length
    FROM u WHERE is_full
    UNION ALL
    SELECT record_id, canonical_url, CASE WHEN response_id IS NULL THEN 'no_earlier_response' WHEN ok THEN 'resolved' ELSE 'validator_mismatch' END, response_id, CASE WHEN ok THEN fn END,
           'no-cache', d::VARCHAR, CASE WHEN ok THEN fn::VARCHAR ELSE '0' END
    FROM k
    """,
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(revisits.captures(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")))
    head = [F.col("headers")[k].alias(k.replace("-", "_")) for k in ("cache-control", "date", "content-length")]
    return found.select("record_id", "canonical_url", "state", "response_id", "payload_bytes", *head)


@query("op7_setsketch_near_dup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query("op8_line_edit_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(documents(spark, sf_dir, "doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_repeated", "n_near", F.length("text").cast("long").alias("kept_chars"), F.crc32(F.col("text").cast("binary")).alias("kept_crc32"))


@query("op9_certified_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir, "doc_id", "text"), tokenizer("byte_bpe_50k.json"))


@query("op10_transducer_tokens")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf_dir, "doc_id", "text"), tokenizer("word_bpe_49k.json"))
