"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op3_chat_windows"] = """
WITH rows AS (
  SELECT conv_id, coalesce(turn, 9223372036854775807) AS turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, 4 + (length(text) + 3) // 4 AS tok,
         length(text) + length(text) - length(replace(replace(replace(text, '\\', ''), '<', ''), '[', ''))
         + length(role) + length(role)
         - length(replace(replace(replace(replace(role, '\\', ''), '<', ''), '[', ''), chr(10), ''))
         + length('<|turn|>') + 1 + length('<|end|>') AS width
  FROM rows),
placed AS (
  SELECT *, row_number() OVER w AS idx, sum(tok) OVER w - tok AS pos
  FROM sized WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)),
first_system AS (
  SELECT conv_id, min(idx) AS idx, arg_min(tok, idx) AS tok, arg_min(width, idx) AS width
  FROM placed WHERE role = 'system' GROUP BY conv_id),
strided AS (
  SELECT p.*, greatest(1, 1024 - 256 - coalesce(s.tok, 0)) AS stride
  FROM placed p LEFT JOIN first_system s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
cut AS (
  SELECT *, CASE WHEN pos // stride = (pos + tok - 1) // stride THEN 2 * (pos // stride)
            ELSE 2 * (pos // stride) + 1 END AS win FROM strided),
wins AS (
  SELECT c.conv_id, win, min(pos) AS pos, min(c.idx) AS idx,
         least(256, 1024 - sum(c.tok) - CASE WHEN any_value(s.idx) < min(c.idx) THEN any_value(s.tok) ELSE 0 END) AS room
  FROM cut c LEFT JOIN first_system s ON c.conv_id IS NOT DISTINCT FROM s.conv_id GROUP BY c.conv_id, win),
context AS (
  SELECT w.conv_id, w.win, p.idx, p.width FROM wins w JOIN placed p
    ON w.conv_id IS NOT DISTINCT FROM p.conv_id AND p.idx < w.idx AND w.pos - p.pos <= w.room
  UNION
  SELECT w.conv_id, w.win, s.idx, s.width FROM wins w JOIN first_system s
    ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND s.idx < w.idx),
again AS (SELECT conv_id, sum(width) AS width FROM context GROUP BY conv_id),
per_conv AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY idx) FILTER (role = 'assistant'), '') AS loss,
         sum(width) AS width FROM placed GROUP BY conv_id)
SELECT c.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       (c.width + coalesce(a.width, 0))::BIGINT AS formatted_chars
FROM per_conv c LEFT JOIN again a ON c.conv_id IS NOT DISTINCT FROM a.conv_id
"""

SQL["op4_seed_and_extend"] = r"""
WITH worded AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, rid, i, array_to_string(w[i:i + 12], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM worded WHERE len(w) >= 13)),
firsts AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY win HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p
  FROM windows JOIN firsts USING (win) WHERE doc_id > first),
kept AS (
  SELECT a.rid, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM worded) a
  ANTI JOIN gone g ON a.rid = g.rid AND a.p = g.p GROUP BY a.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (rid)
"""

SQL["op6_itq_links"] = """
WITH RECURSIVE sound AS (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0),
linked AS (
  SELECT a.r, a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.r != b.r
    AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.98),
counts AS (SELECT r, count(*) AS n FROM linked GROUP BY r),
reach(a, b) AS (
  SELECT DISTINCT a, b FROM linked
  UNION SELECT reach.a, l.b FROM reach JOIN linked l ON reach.b = l.a),
lows AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(low, e.vec_id) AS kept
FROM embeddings e LEFT JOIN sound s ON e.vec_id = s.vec_id LEFT JOIN counts c ON s.r = c.r LEFT JOIN lows ON lows.a = e.vec_id
"""

#: CRC-32 by table, the table by its polynomial.
SQL["op10_interleaved_shards"] = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
sums AS (
  SELECT text, xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(0, octet_length(encode(text))),
      lambda j: ('0x' || substr(hex(encode(text)), 2 * j + 1, 2))::UBIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT AS crc
  FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL), crc_table),
sized AS (
  SELECT doc_id, source, coalesce(octet_length(encode(d.text)), 0) + 1 AS size, coalesce(crc, 0) AS text_crc32,
         md5('interleave:' || coalesce(doc_id::VARCHAR, '-')) AS ord
  FROM documents d LEFT JOIN sums s ON d.text = s.text),
ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY source ORDER BY ord, text_crc32, size) - 1)
            / (2 * count(*) OVER (PARTITION BY source)) AS fraction FROM sized),
lined AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST, ord, text_crc32, size) - 1 AS rank,
         count(*) OVER () AS total FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (rank * 8 // total)::INT AS shard,
       rank - (rank * 8 // total * total + 7) // 8 AS slot, NULL::INT AS grown_shard
FROM lined
"""

SQL["op11_euler_tour_trie"] = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::UBIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM bits WHERE k = 8),
said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, turn, role, length(text) AS chars,
         md5(octet_length(encode(role))::VARCHAR || ':' || role || text) AS said FROM said),
own AS (
  SELECT conv_id, list(said ORDER BY turn NULLS FIRST, role, said) AS said,
         list(chars ORDER BY turn NULLS FIRST, role, said) AS chars FROM turns GROUP BY conv_id),
headed AS (
  SELECT o.*, (xor(list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(range(1, len(conv_id::VARCHAR) + 1),
      lambda j: ord(substr(conv_id::VARCHAR, j, 1))::UBIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) % 6)::BIGINT AS h
  FROM own o, crc_table),
rebuilt AS (
  SELECT o.conv_id, coalesce(b.said, [])[1:h] || o.said[h + 1:] AS said, coalesce(b.chars, [])[1:h] || o.chars[h + 1:] AS chars
  FROM headed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
begun AS (
  SELECT conv_id, d, said[1:d] AS path, coalesce(chars[d], 0) AS chars
  FROM (SELECT *, unnest(range(0, len(said) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM begun GROUP BY path, d),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
told AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.path = k.path),
trees AS (
  SELECT path[1:k] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * chars) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM told) GROUP BY 1),
ended AS (SELECT said AS path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM rebuilt GROUP BY said)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves,
       t.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM told n JOIN trees t ON n.path = t.path LEFT JOIN nodes p ON n.d > 0 AND p.path = n.path[1:n.d - 1]
LEFT JOIN ended e ON e.path = n.path
"""
