"""DuckDB SQL for the queries that SQL can express on whole tables."""

OP1 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n,
         17 + length(regexp_replace(role, '([<\[])(\\*(?:/?s>|/?TURN\]|/?INST\]|/?SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>))', '\1\\\2', 'g'))
            + length(regexp_replace(text, '([<\[])(\\*(?:/?s>|/?TURN\]|/?INST\]|/?SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>))', '\1\\\2', 'g')) AS written
  FROM c
), s AS (
  SELECT *, sum(written) OVER (PARTITION BY conv_id ORDER BY k) AS so_far FROM o
)
SELECT conv_id, max(n)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(so_far) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""

OP2 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS l, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), ls AS (SELECT DISTINCT l FROM iw),
dw AS (
  SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS win
  FROM (SELECT doc_id, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM d, ls WHERE len(w) >= l)
), hit AS (
  SELECT doc_id, i, dw.l, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.l = iw.l
), cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + l)) AS p FROM (SELECT DISTINCT doc_id, i, l FROM hit)) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

ORACLE = {"op1_chat_format": OP1, "op2_decontaminate": OP2}
