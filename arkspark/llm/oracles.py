"""DuckDB SQL for the rows of the training-data queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Distinct 3-word shingles, pairs that share 90 % of their union, and what can be reached by them.
NGRAM_JOIN = f"""WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '{_WORD}'), []) AS ws FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END)) AS g FROM w),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, c.component_id, CASE WHEN len(s.g) = 0 THEN s.doc_id ELSE min(s.doc_id) OVER (PARTITION BY s.g) END AS class_id FROM s JOIN c USING (doc_id)"""

#: Turns in order, and the length of each with its escapes and marks.
CHAT_FORMATTING = r"""WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -7, t.turn, t.role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
e AS (SELECT *, replace(replace(replace(text, '\', '\0'), '</turn>', '\1'), '###', '\2') AS to_text, replace(replace(replace(replace(role, '\', '\0'), '</turn>', '\1'), '###', '\2'), ':', '\3') AS to_role FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
 coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss, sum(4 + length(to_role) + 2 + length(to_text) + 8) AS chars FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM g"""

#: Words, symbols, repeated lines and windows of each text; lines that over 1 % and over 5 of the host's distinct texts hold.
QUALITY_RULES = f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, coalesce('h' || source, '') AS host, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS ws FROM documents),
lines AS (SELECT r, host, i, line, {_LOWER.format(f"array_to_string(regexp_extract_all(line, '{_WORD}'), ' ')")} AS normal, len(regexp_extract_all(line, '{_WORD}')) AS n
 FROM (SELECT r, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d WHERE text IS NOT NULL)),
held AS (SELECT * FROM lines WHERE n > 0),
bodies AS (SELECT r, host, array_to_string(ws, ' ') AS body FROM d),
texts AS (SELECT host, count(DISTINCT body) AS texts FROM bodies GROUP BY host),
frequent AS (SELECT host, normal FROM held JOIN bodies USING (r, host) JOIN texts USING (host) GROUP BY host, normal, texts HAVING count(DISTINCT body) > 5 AND count(DISTINCT body) > 0.01 * texts),
gone AS (SELECT r, sum(n) AS words, count(*) AS lines FROM held SEMI JOIN frequent USING (host, normal) GROUP BY r),
rest AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS left_text FROM lines ANTI JOIN frequent USING (host, normal) GROUP BY r),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM held GROUP BY r),
windows AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS w FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
repeats AS (SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(8) t(k) GROUP BY r),
base AS (SELECT d.*, len(ws) AS n_words, coalesce(length(array_to_string(ws, '')), 0) AS word_chars, coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0) AS n_symbols,
 coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(gone.words, 0) AS gone_words, coalesce(gone.lines, 0) AS frequent_lines
 FROM d LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r) LEFT JOIN gone USING (r)),
verdict AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_words - gone_words AS left_words FROM base)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
 base_failed, NOT base_failed AND NOT (left_words < 20 AND left_words < 0.2 * n_words) AS kept, CAST(frequent_lines AS BIGINT) AS frequent_lines, CAST(left_words AS BIGINT) AS left_words,
 CASE WHEN text IS NOT NULL THEN coalesce(left_text, '') END AS left_text FROM verdict LEFT JOIN rest USING (r)"""

#: Digests in base32, by groups of 40 bits.
WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), h AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS hex FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first_id FROM h)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST('0x' || substr(hex, 10 * (i // 8) + 1, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) AS BIGINT), 1)), '') AS payload_digest,
CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f"""

#: Every order's steps over the documents of each part by what they fail.
FILTER_AUDIT = f"""WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS ws FROM documents),
m AS (SELECT doc_id, part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws), 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text),
 regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, fails),
f AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS ord FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT ord, step, ord[step] AS f, ord[1:step - 1] AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, array_to_string(list_transform(ord, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step, f, n, good, toxic, fails[f] AS hit, NOT list_bool_or([false] || list_transform(before, lambda i: fails[i])) AS there,
 len(list_filter(fails, lambda x: x)) = 1 AS alone FROM c, s),
g AS (SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (there AND NOT hit), 0) AS kept, coalesce(sum(n) FILTER (there AND hit), 0) AS removed, coalesce(sum(n) FILTER (hit AND NOT there), 0) AS redundant,
 coalesce(sum(n) FILTER (hit AND alone), 0) AS unique_fails, coalesce(sum(good) FILTER (there AND hit), 0) AS good_lost, coalesce(sum(toxic) FILTER (there AND hit), 0) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM g"""
