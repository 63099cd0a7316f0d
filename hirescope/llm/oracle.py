"""DuckDB SQL for the registered queries that SQL can express."""

# CRC-32 of the bytes of a text, folded over its hexadecimal digits; the
# table of 256 remainders follows from the polynomial.
_CRC = """
crc_table AS (
    SELECT list_transform(range(0, 256), lambda b: list_reduce(range(0, 8),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b::BIGINT)) AS t),
crcs AS (
    SELECT h, xor(list_reduce(
        list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS crc
    FROM (SELECT DISTINCT hex(encode(coalesce(text, ''))) AS h FROM documents), crc_table)
"""

# Components of documents whose sets of {size}-word shingles are alike.
_COMPONENTS = r"""
WITH RECURSIVE doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
    FROM documents),
grams AS (
    SELECT DISTINCT doc_id, list_slice(words, i, i + least({size}, len(words)) - 1) AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - least({size}, len(words)) + 2)) AS i FROM doc WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_ FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * both_ >= 80 * (p.n + q.n - both_)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS root FROM documents
          UNION SELECT e.y, r.root FROM reach r JOIN both_ways e ON e.x = r.x WHERE r.root < e.y)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(root, doc_id) AS component_id
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT x AS doc_id, min(root) AS root FROM reach GROUP BY x) USING (doc_id)
"""

SQL = {
    "op1_sharding": f"""
WITH {_CRC},
rows_ AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS stratum,
           md5('17:' || coalesce(doc_id::VARCHAR, '')) AS ord,
           (octet_length(encode(coalesce(text, ''))) + 1)::BIGINT AS size, crc::BIGINT AS text_crc32
    FROM documents JOIN crcs ON crcs.h = hex(encode(coalesce(text, '')))),
ranked AS (
    SELECT *, (2 * row_number() OVER (PARTITION BY stratum ORDER BY ord, doc_id, size, text_crc32) - 1)::DOUBLE
              / (2 * count(*) OVER (PARTITION BY stratum))::DOUBLE AS frac
    FROM rows_),
placed AS (
    SELECT *, row_number() OVER (ORDER BY frac, stratum, ord, doc_id, size, text_crc32) - 1 AS place, count(*) OVER () AS total
    FROM ranked),
cut AS (SELECT *, (place * 16 // total)::INTEGER AS shard FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM cut
""",
    "op6_decontamination": r"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
item AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
held AS (
    SELECT DISTINCT item, len, list_slice(words, pos, pos + len - 1) AS win
    FROM (SELECT item, words, least(10, len(words)) AS len, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
          FROM item WHERE len(words) > 0)),
lens AS (SELECT DISTINCT len FROM held),
spots AS (
    SELECT doc_id, words, len, unnest(range(1, len(words) - len + 2)) AS pos FROM doc, lens WHERE len(words) >= len),
hits AS (
    SELECT doc_id, pos, len, win FROM (SELECT doc_id, pos, len, list_slice(words, pos, pos + len - 1) AS win FROM spots) s
    WHERE win IN (SELECT win FROM held)),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + len)) AS place FROM hits) GROUP BY doc_id),
found AS (
    SELECT doc_id, list_sort(list(DISTINCT item)) AS items FROM hits JOIN held USING (win) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit,
       coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op5_warc": """
WITH rows_ AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(encode(coalesce(html, ''))) AS payload_digest
    FROM pages),
top AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS response FROM rows_)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response IS NOT NULL AND page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM top
""",
    "op8_top_k": """
WITH vecs AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM vecs q JOIN vecs c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""",
    "op10_jaccard": _COMPONENTS.replace("{size}", "5"),
    "op12_circulant": "SELECT *, doc_id IS NOT DISTINCT FROM component_id AS kept FROM (" + _COMPONENTS.replace("{size}", "4") + ")",
}
