"""Queries of the operators in this package over the driver's tables, with SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from occspark.llm import (
    align,
    bpe,
    chat_tree,
    decontaminate,
    embedding_dedup,
    filter_audit,
    langid,
    mixing,
    secrets,
    simhash,
    token_files,
    toxicity,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, folder, "embeddings"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.count_tokens(table(spark, folder, "documents"))


def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_tree.format_conversations(table(spark, folder, "conversations"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents").select("doc_id", "text", "source", "lang"), budget=1.0)


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))


def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align.alignments(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": op1_toxicity,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_simhash": op3_simhash,
    "op4_token_counts": op4_token_counts,
    "op5_chat_format": op5_chat_format,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_decontamination": op8_decontamination,
    "op9_secret_scan": op9_secret_scan,
    "op10_language_id": op10_language_id,
    "op11_filter_audit": op11_filter_audit,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_alignment": op13_alignment,
    "pipeline": corpus_pipeline.run,
}

#: Words of the decontamination operator.
_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z\x{80}-\x{10FFFF}]+')"
_SHINGLES = "unnest(list_transform(range(1, len(ws) - k + 2), lambda x: array_to_string(ws[x:x + k - 1], ' '))) AS g"
_ESCAPED = r"replace(replace({}, '\', '\\'), '<|', '<\|')"
_PROBE = "'<|im_end|><|im_start|>assistant ok'"

ORACLES: dict[str, str] = {
    "op2_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            AND list_cosine_similarity(a.e, b.e) >= 0.9),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, c AS component_id, vec_id = c AS kept
        FROM embeddings JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a""",
    "op5_chat_format": f"""
        WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', {_PROBE} UNION ALL SELECT -1, 1, 'assistant', {_PROBE}),
        c AS (SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn), '') AS learnt,
            sum(24 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::BIGINT AS formatted_chars
            FROM t GROUP BY conv_id)
        SELECT conv_id, n_turns, turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
            formatted_chars FROM c""",
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        m AS (SELECT page_id, html, strlen(html) AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS last FROM p)
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to FROM m""",
    "op8_decontamination": f"""
        WITH w AS (SELECT doc_id, row_number() OVER () AS r, {_WORDS} AS ws FROM documents),
        i AS (SELECT *, least(5, len(ws)) AS k FROM
            (SELECT item_id, row_number() OVER () AS n, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
        s AS (SELECT DISTINCT n, item_id, k, g FROM (SELECT n, item_id, k, {_SHINGLES} FROM i)),
        t AS (SELECT n, count(*) AS total FROM s GROUP BY n),
        d AS (SELECT DISTINCT r, doc_id, k, g FROM
            (SELECT r, doc_id, k, {_SHINGLES} FROM w, (SELECT DISTINCT k FROM i)))
        SELECT d.doc_id, s.item_id, count(*)::DOUBLE / any_value(total) AS containment
        FROM d JOIN s ON d.k = s.k AND d.g = s.g JOIN t ON s.n = t.n
        GROUP BY d.r, d.doc_id, s.n, s.item_id HAVING count(*)::DOUBLE / any_value(total) >= 0.8""",
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
        l AS (SELECT doc_id, coalesce(bool_or(quality = 1), FALSE) AS good, coalesce(bool_or(toxic = 1), FALSE) AS toxic
            FROM labels GROUP BY doc_id),
        f AS (SELECT w.doc_id, part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, [
                len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
                100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * len(t),
                regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > first, FALSE)] AS x
            FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
        n AS (SELECT part, x, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY part, x),
        c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        o AS (SELECT [c1.c, c2.c, c3.c, c4.c, c5.c] AS o FROM c AS c1, c AS c2, c AS c3, c AS c4, c AS c5
            WHERE len(list_distinct([c1.c, c2.c, c3.c, c4.c, c5.c])) = 5),
        s AS (SELECT array_to_string(o, '') AS filter_order, step::INT AS step, o[step] AS own, o[1:step - 1] AS earlier
            FROM o, (SELECT unnest(range(1, 6)) AS step)),
        y AS (SELECT n.*, filter_order, step, own, x[instr('ABCDE', own)] AS fails, len(list_filter(x, lambda v: v)) AS failed,
                len(list_filter(earlier, lambda e: x[instr('ABCDE', e)])) > 0 AS gone FROM n, s),
        r AS (SELECT part, filter_order, step, own,
                coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
                coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
                coalesce(sum(n) FILTER (fails AND failed = 1), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
                coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
            FROM y GROUP BY part, filter_order, step, own)
        SELECT * EXCLUDE own, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r""",
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
