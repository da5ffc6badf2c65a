"""SQL that gives the rows of those queries which SQL can express, for DuckDB."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

ORACLES: dict[str, str] = {}

# A turn is "[INST" + star + " " + role + "]" + body + "[/INST]". Only a text with "[/INST]"
# spoils a conversation; there, texts with "[INST" or "[/INST" have backslashes doubled and
# one more after the bracket of each of the two.
ORACLES["op4_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, contains(text, '[INST') OR contains(text, '[/INST') AS quoted,
    replace(replace(replace(text, '\', '\\'), '[INST', '[\INST'), '[/INST', '[\/INST') AS escaped
  FROM rows
), spoiled AS (
  SELECT conv_id, bool_or(contains(text, '[/INST]')) AS bad FROM turns GROUP BY conv_id
)
SELECT t.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + CASE WHEN bad AND quoted THEN 1 + length(escaped) ELSE length(text) END) AS BIGINT) AS formatted_chars,
  CASE WHEN any_value(bad) THEN 1 ELSE 0 END AS escape_level
FROM turns t JOIN spoiled s ON s.conv_id IS NOT DISTINCT FROM t.conv_id
GROUP BY t.conv_id
"""

ORACLES["op5_decontamination"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS ws FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORD}) AS ws FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(10, len(ws)) AS size, array_to_string(ws[i : i + least(10, len(ws)) - 1], ' ') AS run
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)
), runs AS (
  SELECT row_id, size, i, array_to_string(ws[i : i + size - 1], ' ') AS run
  FROM (SELECT row_id, ws, size, unnest(generate_series(1, len(ws) - size + 1)) AS i
        FROM d, (SELECT DISTINCT size FROM windows) WHERE len(ws) >= size)
), hits AS (
  SELECT row_id, r.i, r.size, item FROM runs r JOIN windows w USING (size, run)
), words AS (
  SELECT row_id, count(DISTINCT p) AS n_hit
  FROM (SELECT row_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY row_id
), items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT row_id, item FROM hits) GROUP BY row_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row_id) LEFT JOIN items USING (row_id)
"""

# crc32 bit by bit: every eighth step takes in the next byte. Words with another letter at one
# place are equal without it; of words one letter apart in length, one is the other without a letter.
ORACLES["op13_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, run, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[A-Za-zÀ-ÿ]{{6,}}')) AS run FROM documents
  ) GROUP BY ALL
), bytes AS (
  SELECT *, list_transform(range(0, CAST(length(hex(encode(doc_id || ':' || run))) / 2 AS BIGINT)),
    lambda i: CAST('0x' || substr(hex(encode(doc_id || ':' || run)), 2 * i + 1, 2) AS BIGINT)) AS b FROM runs
), hashed AS (
  SELECT run, c, doc_id, xor(list_reduce(range(0, 8 * len(b)), lambda a, k:
    xor((CASE WHEN k % 8 = 0 THEN xor(a, b[k // 8 + 1]) ELSE a END) >> 1,
        3988292384 * ((CASE WHEN k % 8 = 0 THEN xor(a, b[k // 8 + 1]) ELSE a END) & 1)), 4294967295), 4294967295) AS h
  FROM bytes
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT c, CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
      ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5
), less AS (
  SELECT DISTINCT word, n, place, substr(word, 1, place) || substr(word, place + 2) AS piece
  FROM (SELECT word, n, unnest(range(0, length(word))) AS place FROM words)
), replaced AS (
  SELECT x.word, y.word AS other, y.n AS m FROM less x JOIN less y USING (place, piece) WHERE x.word != y.word
), dropped AS (
  SELECT DISTINCT x.word, x.n, y.word AS other, y.n AS m FROM less x JOIN words y ON y.word = x.piece
), near AS (
  SELECT word, other, m FROM replaced
  UNION ALL SELECT word, other, m FROM dropped
  UNION ALL SELECT other, word, n FROM dropped
), told AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n
  FROM words w LEFT JOIN told USING (word)
), chain AS (
  SELECT word, word AS at FROM words
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.at WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f
JOIN chain c ON c.word = f.word JOIN formed e ON e.word = c.at AND e.form IS NULL
"""
