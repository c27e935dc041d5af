"""DuckDB texts for the operators whose results SQL can express, written independently."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES = {
    "op4_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT item_id, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i, w FROM b WHERE len(w) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bw),
lengths AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d JOIN lengths ON len(w) >= n),
hits AS MATERIALIZED (SELECT doc_id, item_id, i, dw.n FROM dw JOIN windows ON dw.n = windows.n AND array_to_string(w[i:i + dw.n - 1], ' ') = s),
words AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op5_url_filters": rf"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), {_UPPER}) AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h) DESC, length(p) DESC) AS k
  FROM u, r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM u LEFT JOIN (SELECT * FROM m WHERE k = 1) USING (page_id)""",
    "op6_ngram_jaccard": rf"""
WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}), '{_WORDS}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, greatest(len(w) - 2, 2))]) AS shingle
  FROM d WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
meet AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS size FROM s a JOIN s b USING (shingle) GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM meet JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * meet.size >= 85 * (a.size + b.size - meet.size)),
reach(doc_id, root) AS (SELECT x, y FROM links UNION SELECT reach.doc_id, y FROM reach JOIN links ON root = x)
SELECT doc_id, coalesce(any_value(n.size), 0) AS n_shingles, coalesce(min(root), doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY doc_id""",
    "op8_warc": """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
c AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS newest FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < newest THEN newest END AS refers_to FROM c""",
    "op10_source_mix": rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1]::DOUBLE AS w
  FROM d GROUP BY source),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(source_size) OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 2.0::DOUBLE)
  / sum(w) OVER (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
t AS (SELECT source, source_size, least(source_size * 2.0::DOUBLE, max(level) OVER () * w) AS target,
  CAST('0x' || substr(md5('mix|' || coalesce(source, chr(0))), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM l),
k AS (SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
  CAST(row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS DOUBLE) AS n FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(floor(n * rate + u) - floor((n - 1) * rate + u) AS BIGINT) * size AS taken FROM k""",
    "op7_chat_formatting": """
WITH RECURSIVE m AS (SELECT *, length(text) AS n FROM conversations),
e AS (SELECT conv_id, turn, text, n, n % 3 AS last, unnest(range(0, n % 3 + 1)) AS p FROM m WHERE role = 'assistant'),
a AS (SELECT *, n + p AS k, NOT (n % 13 = 0 AND p = 1) AS first, conv_id || '/' || turn || '-' || p AS key,
  'c' || turn || '-' || CASE WHEN n % 13 = 0 AND p = 1 THEN 0 ELSE p END AS id,
  CASE WHEN (n + p) % 11 = 0 THEN 'none' WHEN (n + p) % 2 = 0 THEN 'find' ELSE 'count' END AS tool,
  CASE WHEN n % 19 = 0 THEN ['c' || turn || '-' || CASE p WHEN 0 THEN last ELSE p - 1 END]
       WHEN n % 17 = 0 AND p < last THEN ['c' || turn || '-' || (p + 1)] WHEN n % 17 = 0 THEN []
       WHEN p > 0 THEN ['c' || turn || '-' || (p - 1), 'c' || turn || '-0']
       WHEN n % 23 = 0 THEN ['c' || (turn + 2) || '-0'] ELSE ['c' || (turn - 2) || '-0', 'c' || (turn - 1) || '-0'] END AS links FROM e),
links AS (SELECT DISTINCT a.conv_id, a.id, b.id AS before FROM (SELECT conv_id, id, unnest(links) AS before FROM a WHERE first) a
  JOIN a b ON b.conv_id = a.conv_id AND b.id = a.before AND b.first),
sizes AS (SELECT conv_id, count(*) AS calls FROM a WHERE first GROUP BY conv_id),
-- A chain as long as there are calls has a circle in it.
v AS (SELECT conv_id, id, 0 AS level FROM a WHERE first
  UNION SELECT links.conv_id, links.id, v.level + 1 FROM v JOIN links ON links.conv_id = v.conv_id AND links.before = v.id
    JOIN sizes ON sizes.conv_id = v.conv_id WHERE v.level < calls),
levels AS (SELECT v.conv_id, id, CASE WHEN max(level) < any_value(calls) THEN max(level) END AS level FROM v JOIN sizes USING (conv_id) GROUP BY v.conv_id, id),
c AS (SELECT a.*, CASE WHEN first THEN level END AS level,
  CASE WHEN first AND ((p = 0 AND n % 7 <> 0) OR (p = 1 AND n % 5 <> 0)) THEN CAST(to_json(text) AS VARCHAR) ELSE 'null' END AS result,
  CASE WHEN NOT first THEN 'repeated' WHEN tool = 'none' THEN 'unknown_tool' WHEN tool = 'find' AND k % 3 <> 0 THEN 'bad_arguments'
       WHEN level IS NULL THEN 'circular' WHEN NOT ((p = 0 AND n % 7 <> 0) OR (p = 1 AND n % 5 <> 0)) THEN 'no_result' ELSE 'ok' END AS status,
  CASE WHEN k % 2 = 0 THEN '{' || CASE k % 3 WHEN 0 THEN '"exact":true,' WHEN 1 THEN '"exact":"yes",' ELSE '' END || '"letters":' || k || '}'
       ELSE '{"letters":' || k || CASE WHEN k % 3 = 0 THEN ',"unit":"letter"' ELSE '' END || '}' END AS args
  FROM a LEFT JOIN levels ON levels.conv_id = a.conv_id AND levels.id = a.id),
made AS (SELECT conv_id, turn, count(*) AS n_calls, count(*) FILTER (status = 'ok') AS n_ok,
  string_agg('{"arguments":' || args || ',"id":"' || id || '","level":' || coalesce(CAST(level AS VARCHAR), 'null') || ',"name":"' || tool
    || '","result":' || result || ',"status":"' || status || '"}', ',' ORDER BY level NULLS LAST, p) AS calls FROM c GROUP BY conv_id, turn),
-- A result of a second call is lost where the id of that call is given to the first.
lost AS (SELECT conv_id, count(DISTINCT id) AS n_lost FROM (
    SELECT conv_id, 'lost' || turn AS id FROM m WHERE role = 'assistant' AND n % 29 = 0
    UNION ALL SELECT conv_id, 'c' || turn || '-1' FROM m WHERE role = 'assistant' AND n % 5 <> 0 AND n % 3 > 0 AND n % 13 = 0) GROUP BY conv_id),
lines AS (SELECT m.conv_id, m.turn, n_calls, n_ok, '{"content":' || CAST(to_json(m.text) AS VARCHAR) || ',"role":"' || m.role || '"'
  || coalesce(',"tool_calls":[' || calls || ']', '') || ',"turn":' || m.turn || '}' AS line
  FROM m LEFT JOIN made ON made.conv_id = m.conv_id AND made.turn = m.turn)
SELECT conv_id, count(*) AS n_messages, CAST(coalesce(sum(n_calls), 0) AS BIGINT) AS n_calls, CAST(coalesce(sum(n_ok), 0) AS BIGINT) AS n_ok,
  coalesce(any_value(n_lost), 0) AS n_lost, '{"messages":[' || string_agg(line, ',' ORDER BY turn, line) || ']}' AS chat
FROM lines LEFT JOIN lost USING (conv_id) GROUP BY conv_id""",
    "op11_conversation_repair": r"""
WITH RECURSIVE c AS (SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
-- The checksum bit by bit: a byte is mixed in, then eight shifts.
f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce([4294967295] || flatten(list_transform(
    string_split(key, ''), lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END), 4294967295) % 20 AS fault FROM c),
m AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE fault <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM m),
r AS MATERIALIZED (SELECT conv_id, turn, role, text, i, substr(role, 1, 1) AS letter,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
         WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM o),
-- States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
ins(q, letters, p) AS (VALUES (0, '', 0), (0, 'I', 2), (0, 'II', 3), (1, '', 1), (1, 'I', 2), (1, 'II', 3), (2, '', 2), (2, 'I', 3), (3, '', 3), (3, 'I', 2)),
edit(p, letter, e, price, t) AS (VALUES (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2), (1, 'u', 'K', 0, 2), (3, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3),
    (0, NULL, 'R', 2, 2), (1, NULL, 'R', 2, 2), (3, NULL, 'R', 2, 2), (2, NULL, 'R', 2, 3),
    (0, NULL, 'D', 3, 0), (1, NULL, 'D', 3, 1), (2, NULL, 'D', 3, 2), (3, NULL, 'D', 3, 3)),
dp AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, {'cost': CAST(0 AS BIGINT), 'audit': ''} AS best FROM r
  UNION ALL SELECT r.conv_id, r.i, edit.t AS q,
    min({'cost': CAST(best.cost + 2 * length(letters) + price + CASE WHEN fault = 'truncated' AND e <> 'D' THEN 1 ELSE 0 END AS BIGINT), 'audit': best.audit || letters || e}) AS best
  FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1 JOIN ins ON ins.q = dp.q JOIN edit ON edit.p = ins.p
  WHERE (edit.letter IS NULL OR edit.letter = r.letter) AND (e = 'D' OR fault NOT IN ('blank', 'duplicate')) GROUP BY r.conv_id, r.i, edit.t),
sizes AS (SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM r GROUP BY conv_id),
pairs AS (SELECT conv_id, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, lag(letter) OVER (PARTITION BY conv_id ORDER BY i) || letter AS pair FROM r) GROUP BY conv_id),
done AS (SELECT dp.conv_id, gaps, blank, duplicate, truncated,
    min({'cost': best.cost + CASE q WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'audit': best.audit || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS best
  FROM dp JOIN sizes ON sizes.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = n GROUP BY ALL),
letters AS (SELECT conv_id, unnest(string_split(best.audit, '')) AS e, generate_subscripts(string_split(best.audit, ''), 1) AS spot FROM done),
counted AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS k FROM letters WHERE e <> '' WINDOW w AS (PARTITION BY conv_id ORDER BY spot)),
kept AS (SELECT counted.*, r.role, r.text, max(CASE WHEN k = 1 AND e = 'K' AND letter = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY counted.conv_id) AS s
  FROM counted LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM counted.conv_id AND r.i = counted.i AND e <> 'I' WHERE e <> 'D'),
lines AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (k - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY spot) AS repaired
  FROM kept GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN pairs ON pairs.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN lines ON lines.conv_id IS NOT DISTINCT FROM a.conv_id""",
    "op12_fill_in_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
n AS (SELECT doc_id, text, w, CAST(len(w) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(h, k, 8) AS BIGINT)) AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
         WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM n),
p AS (SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:n], '') AS suf FROM c),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output FROM p)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(output) AS output_sha256, sha256(CASE WHEN form = 'plain' THEN output ELSE
    split_part(split_part(output, '<P>', 2), CASE form WHEN 'psm' THEN '<S>' ELSE '<M>' END, 1) || split_part(output, '<M>', 2)
    || split_part(split_part(output, '<S>', 2), CASE form WHEN 'psm' THEN '<M>' ELSE '<P>' END, 1) END) AS restored_sha256
FROM o""",
}
