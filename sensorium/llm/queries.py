"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import BODY, END, TURN, format_conversations, read_back
from .common import table
from .decontaminate import contamination
from .exact_dedup import exact_groups
from .filter_audit import filter_audit
from .hard_negatives import mine
from .html_text import extract
from .licenses import PHRASES, TEMPLATES, block_words, needed, scan_licenses, words
from .packing import pack
from .quality import score_quality
from .sharding import shard
from .repeats import repeated_strings
from .simhash import simhash_components
from .warc import archive


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_strings(table(spark, sf_dir, "documents")).drop("spans")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("matches")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages")).drop("record_id", "date", "uri")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("matches")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), lambda vec_id: vec_id % 100 == 0)


#: The conversation that the query adds: texts made of control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(CONTROL_TEXT))
    return read_back(format_conversations(rows.union(more)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')"

QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_sharding, op3_exact_dedup, op4_html_text, op5_quality, op6_decontamination, op7_warc,
                                   op8_license_scan, op9_simhash, op10_packing, op11_hard_negatives, op12_chat_format, op13_filter_audit)}

ORACLE_SQL = {
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents),
        g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(norm) AS text_sha256, md5(norm) AS content_hash
        FROM d JOIN g USING (norm)""",
    "op6_decontamination": rf"""
        WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        iw AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        win AS (SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
                FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS s FROM iw WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT k FROM win),
        places AS (SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS g
                   FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM dw, sizes WHERE len(w) >= k)),
        hits AS (SELECT doc_id, item_id, p, k FROM places JOIN win USING (k, g)),
        covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
                  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op7_warc": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
        t AS (SELECT h, max(page_id) AS top FROM d GROUP BY h)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM d JOIN t USING (h)""",
    "op8_license_scan": rf"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        phrases(label, v) AS (VALUES {', '.join(f"('{v}', {p.split()})" for p, v in PHRASES.items())}),
        places AS (SELECT doc_id, label, p FROM (SELECT doc_id, label, w, v, unnest(range(0, len(w) - len(v) + 1)) AS p
                                                 FROM d, phrases WHERE len(w) >= len(v)) WHERE w[p + 1:p + len(v)] = v),
        base AS (SELECT doc_id, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
                 FROM places GROUP BY doc_id),
        templates(label, v, need, size, req, bad) AS (VALUES {', '.join(
            f"('{t.label}', {sorted(set(words(t.wording)))}, {needed(t)}, {block_words(t)}, {words(t.required)}, {words(t.excluded) or ['']})" for t in TEMPLATES)}),
        blocks AS (SELECT doc_id, label, v, need, req, bad, w[s:s + size - 1] AS b
                   FROM (SELECT *, unnest(range(1, greatest(len(w) - size + 1, 1) + 1)) AS s FROM d, templates WHERE list_has_all(w, req))),
        matched AS (SELECT doc_id, label, len(list_intersect(v, b)) / CAST(len(v) AS DOUBLE) AS containment FROM blocks
                    WHERE len(list_intersect(v, b)) >= need AND list_has_all(b, req) AND NOT list_has_any(b, bad)),
        every AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
                  FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM matched) GROUP BY doc_id),
        best AS (SELECT doc_id, max(containment) AS best FROM matched GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
               coalesce(labels, '') AS labels, CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN best USING (doc_id)""",
    "op11_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
              FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
        p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) QUALIFY row_number() OVER w <= 5""",
    "op12_chat_format": rf"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-1, 0, 'user', '{CONTROL_TEXT}'), (-1, 1, 'assistant', '{CONTROL_TEXT}')),
        e AS (SELECT *, len(regexp_extract_all(role || chr(10) || text, '<\\*(\||/?s>)|\[\\*/?INST\]')) AS escapes FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum({len(TURN + BODY + END)} + length(role) + length(text) + escapes) AS BIGINT) AS formatted_chars,
               CAST(sum(octet_length(encode(text))) AS BIGINT) AS expanded_tokens, CAST(0 AS BIGINT) AS n_attachments
        FROM e GROUP BY conv_id""",
    "op13_filter_audit": r"""
        WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        low AS (SELECT t, min(doc_id) AS low FROM t GROUP BY t),
        w AS (SELECT doc_id, part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, low FROM t JOIN low USING (t)),
        m AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        f AS (SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
                            regexp_matches(t, '[#$%&*|]'), coalesce(low < doc_id, false)] AS fails,
                     coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
              FROM w LEFT JOIN m USING (doc_id) GROUP BY ALL),
        l(i) AS (VALUES (1), (2), (3), (4), (5)),
        orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
        steps AS (SELECT o, list_aggregate(list_transform(o, lambda i: substr('ABCDE', i, 1)), 'string_agg', '') AS filter_order,
                         unnest([1, 2, 3, 4, 5]) AS step FROM orders),
        hit AS (SELECT *, len(list_filter(o[1:step - 1], lambda i: fails[i])) > 0 AS earlier, fails[o[step]] AS here,
                       len(list_filter([1, 2, 3, 4, 5], lambda i: fails[i])) = 1 AS alone FROM f, steps),
        r AS (SELECT part, filter_order, step, o[step] AS filter, sum(CASE WHEN NOT earlier AND NOT here THEN n ELSE 0 END) AS kept,
                     sum(CASE WHEN NOT earlier AND here THEN n ELSE 0 END) AS removed, sum(CASE WHEN earlier AND here THEN n ELSE 0 END) AS redundant,
                     sum(CASE WHEN here AND alone THEN n ELSE 0 END) AS unique_fails,
                     sum(CASE WHEN NOT earlier AND here AND good THEN n ELSE 0 END) AS good_lost,
                     sum(CASE WHEN NOT earlier AND here AND toxic THEN n ELSE 0 END) AS toxic_lost FROM hit GROUP BY ALL)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM r""",
}
