"""DuckDB SQL with the same rows as the registered queries, where SQL can say it."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

WARC = f"""
WITH p AS (
  SELECT CAST(page_id AS BIGINT) AS page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
         max(page_id) OVER (PARTITION BY payload) AS owner
  FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('{_BASE32}',
    1 + CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT)
      >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS BIGINT), 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM owner THEN NULL ELSE owner END AS refers_to
FROM d"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*\|)', '<\\\1', 'g')) + 1
    + length(regexp_replace(text, '<(\\*\|)', '<\\\1', 'g')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce({_WORDS.format(_LOWER.format('text'))}, []) AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(_LOWER.format('text'))} AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL
), phrases AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, list_aggregate(w[i : i + least(10, len(w)) - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), windows AS (
  SELECT r, n, i, list_aggregate(w[i : i + n - 1], 'string_agg', ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)
), found AS (
  SELECT windows.r, windows.n, windows.i, item FROM windows JOIN phrases USING (n, phrase)
), hits AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r
), items AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM found GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""

JACCARD = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, row_number() OVER () AS r,
    coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), s AS (
  SELECT DISTINCT r, list_aggregate(w[i : i + 4], 'string_agg', ' ') AS shingle
  FROM (SELECT r, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT r, count(*) AS n FROM s GROUP BY r
), pairs AS (
  SELECT a.r AS a, b.r AS b, count(*) AS o FROM s a JOIN s b USING (shingle) WHERE a.r < b.r GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * o >= 75 * (x.n + y.n - o)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT r, r AS m FROM n UNION SELECT reach.r, edges.b FROM reach JOIN edges ON reach.m = edges.a
), label AS (
  SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.m GROUP BY reach.r
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, CASE WHEN n.n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN label USING (r)"""

HAMMING = """
WITH c AS (
  SELECT vec_id, list_transform(range(1, 65), lambda i: coalesce(embedding[i] > 0 AND NOT isnan(embedding[i]), false)) AS code
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), p AS (
  SELECT q.vec_id AS query_id, n.vec_id AS neighbour_id,
    CAST(len(list_filter(range(1, 65), lambda i: q.code[i] <> n.code[i])) AS BIGINT) AS distance
  FROM c q JOIN c n ON q.vec_id <> n.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank,
  neighbour_id, distance
FROM p QUALIFY rank <= 10"""

FIM = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT *, list_transform([0, 1, 2, 3], lambda i: CAST('0x' || substr(h, CAST(1 + 8 * i AS BIGINT), 8) AS BIGINT)) AS u FROM d
), c AS (
  SELECT *, least(u[1] % (n + 1), u[2] % (n + 1)) AS a, greatest(u[1] % (n + 1), u[2] % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR u[3] % 100 >= 90 THEN 'plain'
      WHEN u[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u
), p AS (
  SELECT *, '<P>' || substring(text, 1, a) AS p, '<M>' || substring(text, a + 1, b - a) AS m, '<S>' || substring(text, b + 1) AS s FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p"""

# crc32 of a text of ASCII characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
    list_transform(string_split({}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
    lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

TRIE = f"""
WITH t AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, length(coalesce(text, '')) AS size,
    substr(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS code
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'code': code, 'size': size}} ORDER BY turn NULLS FIRST, code, size) AS l,
    {_CRC32.format('CAST(conv_id AS VARCHAR)')} % 6 AS h FROM t GROUP BY conv_id
), r AS (
  SELECT o.conv_id, list_concat(coalesce(s.l[1 : o.h], []), o.l[o.h + 1 :]) AS l
  FROM own o LEFT JOIN own s ON s.conv_id = o.conv_id - o.conv_id % 100
), p AS (
  SELECT conv_id, coalesce(list_aggregate(list_transform(l, lambda x: x.code), 'string_agg', ''), '') AS path, l FROM r
), n AS (
  SELECT substr(path, 1, 32 * d) AS k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(l[d].size) AS size,
    string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(l) = d) AS ends
  FROM (SELECT *, unnest(range(0, len(l) + 1)) AS d FROM p) GROUP BY ALL
), kids AS (
  SELECT substr(k, 1, 32 * (d - 1)) AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), sums AS (
  SELECT substr(k, 1, 32 * e) AS k, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT n.k, unnest(range(0, d + 1)) AS e, CAST(kids.k IS NULL AS INT) AS leaf,
    CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * size END AS saved FROM n LEFT JOIN kids ON kids.k = n.k) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM n JOIN sums ON sums.k = n.k LEFT JOIN kids ON kids.k = n.k
LEFT JOIN n up ON n.d > 0 AND up.k = substr(n.k, 1, 32 * (n.d - 1))"""

ORACLE_SQL = {
    "op5_warc": WARC,
    "op8_chat": CHAT,
    "op6_jaccard": JACCARD,
    "op9_decontaminate": DECONTAMINATE,
    "op10_hamming": HAMMING,
    "op11_fim": FIM,
    "op13_trie": TRIE,
}
