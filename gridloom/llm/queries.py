"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import public_tokenizers

from gridloom.llm import (
    bpe,
    conversations,
    embedding_dedup,
    exact_dedup,
    extraction,
    lexical_search,
    ngram_join,
    packing,
    quality,
    sharding,
    token_counts,
    toxicity,
    warc,
)
from gridloom.llm.common import table


def op1_extraction(spark, sf_dir):
    return extraction.main_texts(table(spark, sf_dir, "pages"))


def op2_packing(spark, sf_dir):
    return packing.packed_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False
    )


def op3_bpe(spark, sf_dir):
    return bpe.round_trip_digests(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def op4_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op8_ngram_join(spark, sf_dir):
    return ngram_join.shingle_components(table(spark, sf_dir, "documents"))


def op9_warc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op10_sharding(spark, sf_dir):
    return sharding.shard_table(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark, sf_dir):
    return conversations.repaired_conversations(table(spark, sf_dir, "conversations"))


def op12_lexical_search(spark, sf_dir):
    return lexical_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_token_counts(spark, sf_dir):
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


QUERIES = {f.__name__: f for f in (
    op1_extraction, op2_packing, op3_bpe, op4_toxicity, op5_quality, op6_exact_dedup, op7_embedding_dedup,
    op8_ngram_join, op9_warc, op10_sharding, op11_conversation_repair, op12_lexical_search,
    op13_token_counts,
)}

SQL = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op9_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html,
                   max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keeper
            FROM pages
        )
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda x: substr(
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(sha1(html), (x // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (x % 4))) & 31),
                   1)), '') AS payload_digest,
               CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> keeper THEN keeper END AS refers_to
        FROM p
    """,
    "op10_sharding": """
        WITH RECURSIVE polynomial AS (
            SELECT list(v ORDER BY i) AS crc FROM (
                SELECT i, list_reduce([i] || range(8), lambda c, k:
                    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) t(i))
        ), walk AS (
            SELECT row_number() OVER () AS r, doc_id, text,
                   coalesce(doc_id, 0)::HUGEINT AS k, 0::BIGINT AS shard, 0::BIGINT AS grown, 0::BIGINT AS j
            FROM documents
            UNION ALL
            SELECT r, doc_id, text, n, CASE WHEN j < 24 THEN j ELSE shard END, j,
                   CAST(floor((j + 1) * (2147483648::DOUBLE / CAST((n >> 33) + 1 AS DOUBLE))) AS BIGINT)
            FROM (SELECT *, CAST((((CASE WHEN k < 0 THEN k + 18446744073709551616 ELSE k END)::UHUGEINT
                      * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT) AS HUGEINT) AS n
                  FROM walk WHERE j < 25)
        ), placed AS (
            SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size,
                   xor(list_reduce([4294967295::BIGINT] || list_transform(
                           regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT),
                       lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32,
                   shard, grown
            FROM walk, polynomial WHERE j >= 25
        )
        SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32) - 1 AS slot,
               CAST(grown AS INTEGER) AS grown_shard
        FROM placed
    """,
    "op12_lexical_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), sizes AS (
            SELECT count(*) AS documents, sum(len(words)) AS length FROM d WHERE len(words) > 0
        ), postings AS (
            SELECT r, doc_id, n, term, count(*) AS tf
            FROM (SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM d) GROUP BY ALL
        ), wanted AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, sizes GROUP BY term
        ), scored AS (
            SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) //
                       (1000 * tf + 20 * (50 + (50 * n * documents) // length)))) AS score
            FROM wanted JOIN weights USING (term) JOIN postings USING (term), sizes
            GROUP BY item_id, doc_id, r
        )
        SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
        FROM scored WHERE score > 0
        WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)
        QUALIFY row_number() OVER w <= 50
    """,
    "op11_conversation_repair": r"""
        WITH RECURSIVE polynomial AS (
            SELECT list(v ORDER BY i) AS crc FROM (
                SELECT i, list_reduce([i] || range(8), lambda c, k:
                    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                FROM range(256) t(i))
        ), given AS (
            SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce([4294967295::BIGINT] || list_transform(
                           regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))),
                                              '..'), lambda x: ('0x' || x)::BIGINT),
                       lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS harm
            FROM conversations, polynomial
        ), damaged AS (
            SELECT c, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
            FROM given WHERE harm <> 0
        ), ordered AS (
            SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS k,
                   right(regexp_replace(text, '[\x20\x09-\x0D]+\z', ''), 1) AS ending
            FROM damaged
        ), faulty AS (
            SELECT *, CASE WHEN ending = '' THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY k) > 1 THEN 'duplicate'
                           WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY c ORDER BY k) || left(role, 1) AS pair
            FROM ordered
        ), inserts(s, cost, letters, lines, t) AS (
            VALUES ('', 0, '', [], ''), ('', 3, 'I', ['user:'], 'u'), ('', 6, 'II', ['user:', 'assistant:'], 'a'),
                   ('s', 0, '', [], 's'), ('s', 3, 'I', ['user:'], 'u'), ('s', 6, 'II', ['user:', 'assistant:'], 'a'),
                   ('u', 0, '', [], 'u'), ('u', 3, 'I', ['assistant:'], 'a'),
                   ('a', 0, '', [], 'a'), ('a', 3, 'I', ['user:'], 'u')
        ), edits(letter, s, initial, t, cost) AS (
            SELECT 'D', s, NULL, s, 4 FROM (VALUES (''), ('s'), ('u'), ('a')) v(s)
            UNION ALL VALUES ('K', '', 's', 's', 0), ('K', '', 'u', 'u', 0), ('K', 's', 'u', 'u', 0), ('K', 'u', 'a', 'a', 0),
                             ('K', 'a', 'u', 'u', 0)
            UNION ALL VALUES ('R', '', NULL, 'u', 3), ('R', 's', NULL, 'u', 3), ('R', 'u', NULL, 'a', 3), ('R', 'a', NULL, 'u', 3)
        ), walk AS (
            SELECT DISTINCT c, 0::BIGINT AS k, '' AS s, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS lines FROM given
            UNION ALL
            SELECT c, k, s, cost, audit, lines FROM (
                SELECT w.c, r.k, e.t AS s,
                       w.cost + i.cost + e.cost + CASE WHEN r.fault = 'truncated' AND e.letter <> 'D' THEN 3 ELSE 0 END AS cost,
                       w.audit || i.letters || e.letter AS audit,
                       w.lines || i.lines || CASE e.letter WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text]
                           ELSE [CASE e.t WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text] END AS lines
                FROM walk w JOIN inserts i ON i.s = w.s JOIN faulty r ON r.c = w.c AND r.k = w.k + 1
                JOIN edits e ON e.s = i.t AND (e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
                            AND (e.initial IS NULL OR e.initial = left(r.role, 1)))
            QUALIFY row_number() OVER (PARTITION BY c, k, s ORDER BY cost, audit) = 1
        ), facts AS (
            SELECT c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) AS n,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulty GROUP BY c
        ), repaired AS (
            SELECT w.c, w.cost + i.cost AS cost, w.audit || i.letters AS audit, array_to_string(w.lines || i.lines, chr(10)) AS written
            FROM walk w JOIN inserts i ON i.s = w.s AND i.t IN ('', 'a') LEFT JOIN facts f ON f.c = w.c
            WHERE w.k = coalesce(f.n, 0)
            QUALIFY row_number() OVER (PARTITION BY w.c ORDER BY w.cost + i.cost, w.audit || i.letters) = 1
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit,
               sha256(coalesce(written, '')) AS repaired_sha256
        FROM (SELECT DISTINCT c, conv_id FROM given) JOIN repaired USING (c) LEFT JOIN facts USING (c)
    """,
}
