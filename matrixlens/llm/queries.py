"""The registered queries of this package, each one operator over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from matrixlens.llm.decontaminate import contaminated
from matrixlens.llm.divergence import source_divergence
from matrixlens.llm.exact_dedup import exact_groups
from matrixlens.llm.katz import fit_and_score
from matrixlens.llm.near_dedup import near_duplicate_groups
from matrixlens.llm.packing import pack
from matrixlens.llm.personal_data import personal_data
from matrixlens.llm.perspectives import rotate_perspectives
from matrixlens.llm.quality import quality_scores
from matrixlens.llm.repair import repair_damaged
from matrixlens.llm.sentencepieces import encode_documents
from matrixlens.llm.tables import in_fold, table
from matrixlens.llm.url_filter import filter_urls
from matrixlens.llm.warc import archive_round_trip

#: Rules of the URL filter's query: host, path, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


#: Where the installed package of public tokenizers keeps the models; nothing is copied.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op3_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf, "pages"), rules)


def op4_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return personal_data(table(spark, sf, "documents"))


def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return encode_documents(table(spark, sf, "documents"), str(PIECE_MODEL), digest=True)


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_groups(table(spark, sf, "documents"))


def op7_chat_perspectives(spark: SparkSession, sf: str) -> DataFrame:
    return rotate_perspectives(table(spark, sf, "conversations"))


def op8_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf, "documents"))


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    return archive_round_trip(table(spark, sf, "pages"))


def op10_katz(spark: SparkSession, sf: str) -> DataFrame:
    return fit_and_score(table(spark, sf, "documents"), in_fold("doc_id", 5, 1)).scores


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    return pack(table(spark, sf, "documents"), str(BYTE_MODEL))


def op12_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair_damaged(table(spark, sf, "conversations"))


def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence(table(spark, sf, "documents"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    chosen = (
        op1_quality, op2_decontaminate, op3_url_filters, op4_personal_data, op5_sentencepiece, op6_exact_dedup, op7_chat_perspectives, op8_simhash, op9_warc, op10_katz,
        op11_packing, op12_repair, op13_source_divergence,
    )
    return {query.__name__: query for query in chosen}


def oracles() -> dict[str, str]:
    return dict(ORACLES)


_RULES_SQL = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

ORACLES = {
    "op3_url_filters": f"""
        WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
        split AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        fitting AS (
            SELECT *, row_number() OVER (PARTITION BY page_id, host, path
                       ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC, rule_verdict DESC) AS place
            FROM split LEFT JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT page_id, host, path, rule_host || rule_path AS rule, coalesce(rule_verdict, 'allow') AS verdict
        FROM fitting WHERE place = 1""",
    "op6_exact_dedup": """
        WITH plain AS (
            SELECT doc_id, coalesce(text, '') AS original, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS plain FROM documents),
        placed AS (
            SELECT doc_id, plain, first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(original) DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY plain) AS group_size
            FROM plain)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM placed""",
    "op7_chat_perspectives": """
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS place
            FROM conversations),
        speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM turns WHERE role != 'system'),
        said AS (
            SELECT t.conv_id, perspective, place // 1024 AS part, place, role, text, role = perspective AS own,
                   CASE WHEN role = perspective THEN '<|assistant|>' || chr(10)
                        WHEN role = 'system' THEN '<|system|>' || chr(10)
                        ELSE '<|user name=' || replace(role, '<|', '< |') || '|>' || chr(10) END AS head,
                   replace(text, '<|', '< |') || '<|end|>' AS body
            FROM turns t JOIN speakers s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
        placed AS (
            SELECT *, sum(length(head) + length(body) + 1) OVER (
                       PARTITION BY conv_id, perspective, part ORDER BY place) - length(body) - 1 AS begins
            FROM said)
        SELECT conv_id, perspective, part, CAST(count(*) AS INTEGER) AS n_turns,
               string_agg(head || body || chr(10), '' ORDER BY place) AS text,
               coalesce(string_agg(begins || '-' || (begins + length(body)), ',' ORDER BY place) FILTER (own), '') AS mask
        FROM placed GROUP BY conv_id, perspective, part""",
    "op9_warc": """
        WITH sized AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        kept AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS first
            FROM sized)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN page_id < first THEN first END AS refers_to
        FROM kept""",
    "op13_source_divergence": """
        WITH docs AS MATERIALIZED (
            SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        words AS MATERIALIZED (
            SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
        sizes AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
        sources AS (SELECT DISTINCT lang, source FROM docs),
        counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY lang, source, term),
        cells AS (
            SELECT g.lang, g.source, k.term, k.total, coalesce(c.n, 0) AS n
            FROM sources g JOIN kept k ON g.lang = k.lang
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        shares AS MATERIALIZED (
            SELECT c.*, CAST(1 + (CAST(1000000000 AS HUGEINT) * (c.n + 5)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source) + 5 * s.v) AS BIGINT) AS p,
                   CAST(1 + (CAST(1000000000 AS HUGEINT) * (c.total + 5)) // (s.n + 5 * s.v) AS BIGINT) AS q
            FROM cells c JOIN sizes s ON c.lang = s.lang),
        apart AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY ALL),
        parts AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
            FROM sources a JOIN sources b ON a.lang = b.lang AND a.source != b.source
            LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50""",
}
