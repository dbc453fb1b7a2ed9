"""Check SQL for the corpus queries, where DuckDB can express them.

Most rest on hashes (XXH64, CRC-32), a tokenizer, a trained model or byte strings that DuckDB's
SQL does not have. The tests compare those with brute force.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op12_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), h AS (
            SELECT page_id, octet_length(payload) AS payload_bytes,
                   sha256(payload) AS payload_digest FROM p
        ), k AS (
            SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS head FROM h
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> head THEN 'revisit'
                    ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> head THEN head END AS refers_to
        FROM k
    """,
    "op13_negatives": """
        WITH r AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
        ), s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
            FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
        ), p AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                                       ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                                   ORDER BY s.score DESC, s.vec_id) <= 5
    """,
}
