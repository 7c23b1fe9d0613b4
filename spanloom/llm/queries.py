"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import divergence, warc
from spanloom.llm.alignment import align_tokenizers
from spanloom.llm.common import table
from spanloom.llm.decontaminate import leaks
from spanloom.llm.exact_dedup import exact_dedup
from spanloom.llm.near_dedup import near_dedup
from spanloom.llm.online_packing import pack_online
from spanloom.llm.packing import pack_documents
from spanloom.llm.pii import find_pii
from spanloom.llm.quality import score_documents
from spanloom.llm.sharding import shard_documents
from spanloom.llm.suffix_dedup import remove_repeats
from spanloom.llm.token_counts import token_counts
from spanloom.llm.tokens import tokenizer_path
from spanloom.llm.warc import derivatives, responses


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark, table(spark, sf_dir, "documents")).drop("spans", "kept")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(spark, table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), 40)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(spark, table(spark, sf_dir, "documents"), words=2)


def op10_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(responses(table(spark, sf_dir, "pages")))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(spark, table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_online(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(spark, table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_suffix_array_dedup, op2_exact_dedup, op3_pii, op4_benchmark_decontamination, op5_quality_classifier, op6_best_fit_packing, op7_sharding,
        op8_token_counts, op9_near_dedup, op10_warc_derivatives, op11_tokenizer_alignment, op12_online_packing, op13_source_divergence,
    ]
    return {f.__name__: f for f in found}


_CRLF = "chr(13) || chr(10)"


def _sql_id(key: str) -> str:
    h = f"md5({key})"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"{h}[{a}:{b}]" for a, b in ((1, 8), (9, 12), (13, 16), (17, 20), (21, 32))) + " || '>'"


def _sql_text(html: str) -> str:
    """The plain text of a page, as DuckDB SQL."""
    text = f"regexp_replace({html}, '{warc.HIDDEN}', ' ', 'g')"
    text = f"regexp_replace({text}, '{warc.BLANKS}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{warc.BREAK}', chr(10), 'g'), '{warc.TAG}', '', 'g')"
    for name, char in warc.ENTITIES:
        name, char = (x.replace("'", "''") for x in (name, char))
        text = f"replace({text}, '{name}', '{char}')"
    return f"trim(regexp_replace(regexp_replace({text}, ' *\\n[ \\n]*', chr(10), 'g'), '  +', ' ', 'g'), ' ' || chr(10))"


ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
        FROM d""",
    "op10_warc_derivatives": rf"""
        WITH source AS (
            SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS html FROM pages),
        stripped AS (
            SELECT *, {_sql_text("html")} AS body, 'sha256:' || sha256(html) AS payload_digest,
                   {_sql_id("'response|' || page_id || '|' || uri")} AS response_id
            FROM source),
        made AS (
            SELECT *, {_sql_id("'metadata|' || response_id")} AS meta_id,
                   {_sql_id("'conversion|' || response_id")} AS text_id,
                   'sourceStatus: HTTP/1.1 200 OK' || {_CRLF} || 'source-Content-Type: text/html; charset=utf-8' || {_CRLF}
                   || 'source-Content-Length: ' || strlen(html) || {_CRLF} || 'sourcePayloadDigest: ' || payload_digest || {_CRLF}
                   || 'conversionCharacters: ' || length(body) || {_CRLF} AS meta
            FROM stripped),
        derived AS (
            SELECT page_id, uri, payload_digest, response_id, 'metadata' AS record_type, meta_id AS record_id,
                   text_id AS concurrent_to, 'application/warc-fields' AS content_type, meta AS block FROM made
            UNION ALL
            SELECT page_id, uri, payload_digest, response_id, 'conversion', text_id, meta_id, 'text/plain; charset=utf-8', body
            FROM made)
        SELECT page_id, record_type, record_id, response_id AS refers_to, uri AS refers_to_target_uri,
               '2024-01-01T00:00:00Z' AS date, content_type, strlen(block) AS content_length, block,
               'sha256:' || sha256(block) AS block_digest, payload_digest AS source_payload_digest, concurrent_to
        FROM derived""",
    "op13_source_divergence": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{divergence.TERM}') AS terms
            FROM documents),
        t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
        kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        n AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
        groups AS (SELECT DISTINCT lang, source FROM d),
        sums AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM n GROUP BY lang, source),
        q AS (
            SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(n) + 5) // (any_value(total) + 5 * any_value(v)) AS q
            FROM n JOIN v USING (lang) JOIN (SELECT lang, sum(total) AS total FROM sums GROUP BY lang) USING (lang) GROUP BY lang, term),
        p AS (
            SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n, q.q,
                   1 + 1000000000::HUGEINT * (coalesce(n.n, 0) + 5) // (coalesce(sums.total, 0) + 5 * v.v) AS p
            FROM groups AS g JOIN kept AS k USING (lang) JOIN v USING (lang) JOIN q ON q.lang = g.lang AND q.term = k.term
            LEFT JOIN sums ON sums.lang = g.lang AND sums.source = g.source
            LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
        f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term GROUP BY ALL),
        found AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
            FROM groups AS a JOIN groups AS b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM found)
        SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
