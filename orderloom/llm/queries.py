"""One query per operator over its whole table, and the SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    chat,
    collocations,
    embeddings,
    fingerprints,
    language,
    mixing,
    neardup,
    negatives,
    packing,
    pii,
    repeats,
    sharding,
    token_files,
)
from orderloom.llm.common import scratch_uri, table

SHARDS = 8


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.shard_documents(spark, table(spark, folder, "documents"), SHARDS)
    return rows.withColumn("law", F.lit("key"))


def op2_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeats_digest(spark, table(spark, folder, "documents"))


def op3_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    talks = chat.conversations(table(spark, folder, "conversations"))
    pairs = chat.format_preferences(chat.replaced_replies(talks))
    return pairs.withColumns({c: chat.spans_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprint_documents(spark, table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, folder, "documents"))


def op6_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_digest(spark, table(spark, folder, "documents"), width=2, percent=80)


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_digest(spark, table(spark, folder, "documents"))


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = scratch_uri(spark)
    files = token_files.write_token_files(spark, table(spark, folder, "documents"), target)
    return token_files.read_token_files(files, target)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_digest(spark, table(spark, folder, "documents"))


def op10_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(spark, table(spark, folder, "embeddings"))


def op11_private_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.private_digest(spark, table(spark, folder, "documents"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(spark, table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mined_digest(spark, table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_repeats": op2_repeats,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_fingerprints": op4_fingerprints,
    "op5_packing": op5_packing,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language": op7_language,
    "op8_token_files": op8_token_files,
    "op9_mixing": op9_mixing,
    "op10_embeddings": op10_embeddings,
    "op11_private_data": op11_private_data,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

OP3_SQL = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), last_reply AS (
    SELECT conv_id, max(pos) AS pos FROM turns WHERE role = 'assistant' GROUP BY conv_id
), reply AS (
    SELECT t.* FROM turns t JOIN last_reply l USING (conv_id, pos)
), pair AS (
    SELECT a.conv_id AS pair_id, a.pos AS at_pos, a.text AS good, b.text AS bad
    FROM reply a JOIN reply b ON b.conv_id = a.conv_id + 1
), cut AS (
    SELECT *, CASE WHEN good = bad THEN at_pos ELSE at_pos - 1 END AS shared FROM pair
)
SELECT c.pair_id, CAST(c.shared AS INTEGER) AS shared_turns,
       coalesce((SELECT string_agg('<|' || t.role || '|>' || chr(10) || t.text || chr(10), '' ORDER BY t.pos)
                 FROM turns t WHERE t.conv_id = c.pair_id AND t.pos <= c.shared), '') AS prompt,
       CASE WHEN good = bad THEN '' ELSE '<|assistant|>' || chr(10) || good || chr(10) END AS chosen,
       CASE WHEN good = bad THEN '' ELSE '<|assistant|>' || chr(10) || bad || chr(10) END AS rejected,
       CASE WHEN good = bad THEN '' ELSE '14+' || (length(good) + 1) END AS chosen_mask,
       CASE WHEN good = bad THEN '' ELSE '14+' || (length(bad) + 1) END AS rejected_mask
FROM cut c
"""

OP9_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM sources
), leveled AS (
    SELECT *, CAST((SELECT sum(source_size) FROM sources) - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
              / CAST((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
    FROM weighed
    WINDOW before AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
           CASE WHEN (SELECT max(level) FROM leveled) * weight >= 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
                ELSE (SELECT max(level) FROM leveled) * weight END AS target
    FROM leveled
), rated AS (
    SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
           CAST('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), 'null') || ':9'), 1, 8) AS BIGINT) / 4294967296.0 AS u
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * (CAST(floor(rate) AS BIGINT) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM rated
"""

OP12_SQL = r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang,
                 unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents) cut
), starts AS (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM pieces, (VALUES (1), (2), (3), (4), (5)) lengths(k)
), f AS (
    SELECT lang, CAST(k AS BIGINT) AS k, array_to_string(w[pos:pos + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f FROM starts GROUP BY ALL
), totals AS (
    SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), candidate AS (
    SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2 AND f >= 100
), cuts AS (
    SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS pos FROM candidate
), scored AS (
    SELECT c.lang, c.phrase, c.a, l.f AS l, r.f AS r, t.n, c.pos,
           (CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS score
    FROM cuts c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.pos], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.pos + 1:c.k], ' ')
    JOIN totals t ON t.lang = c.lang
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, pos) = 1
), sizes AS (
    SELECT lang, w, k, a, unnest(range(2, k)) AS size FROM candidate
), places AS (
    SELECT lang, w, a, size, unnest(range(1, k - size + 2)) AS pos FROM sizes
), longer AS (
    SELECT lang, array_to_string(w[pos:pos + size - 1], ' ') AS phrase, max(a) AS a FROM places GROUP BY ALL
), kept AS (
    SELECT s.* FROM lowest s LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase WHERE o.a IS NULL OR 100 * o.a < 100 * s.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, CAST(a AS BIGINT) AS a,
       CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""

OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) for x in embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
           CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 100 = 0
), p AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike
WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

ORACLES: dict[str, str] = {
    "op3_chat_formatting": OP3_SQL,
    "op9_mixing": OP9_SQL,
    "op12_collocations": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
