"""The queries that SQL can express, for DuckDB."""

from __future__ import annotations

PLAIN = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
SPACED = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+')"""

OP1 = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {PLAIN} AS ws FROM benchmark),
cuts AS (SELECT item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item, list_slice(ws, i, i + 9) AS w FROM cuts),
docs AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN} AS ws FROM documents),
sizes AS (SELECT DISTINCT len(w) AS n FROM windows),
spots AS (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes WHERE len(ws) >= n),
hits AS (SELECT r, i, n, item FROM (SELECT r, i, n, list_slice(ws, i, i + n - 1) AS w FROM spots) JOIN windows USING (w)),
marked AS (SELECT r, count(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)) GROUP BY r),
listed AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
    FROM hits GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN marked USING (r) LEFT JOIN listed USING (r)
"""

OP4 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {SPACED} AS ws FROM documents),
cuts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM docs WHERE len(ws) > 0),
sets AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + 4) AS s FROM cuts),
sized AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b USING (s)
    WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
    WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
FROM docs LEFT JOIN sized USING (doc_id) LEFT JOIN least_of ON a = doc_id
"""

OP10 = """
WITH pages AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
cut AS (SELECT r, source, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM pages),
counts AS (SELECT source, l, count(DISTINCT r) AS k FROM cut WHERE trim(l) <> '' GROUP BY source, l),
totals AS (SELECT source, count(*) AS t FROM pages GROUP BY source),
bad AS (SELECT counts.source, l FROM counts JOIN totals ON counts.source IS NOT DISTINCT FROM totals.source
    WHERE k >= 2 AND k > 0.1 * t),
judged AS (SELECT r, i, cut.l, bad.l IS NOT NULL AS drop
    FROM cut LEFT JOIN bad ON cut.l = bad.l AND cut.source IS NOT DISTINCT FROM bad.source),
kept AS (SELECT r, string_agg(l, chr(10) ORDER BY i) FILTER (NOT drop) AS t, count(*) FILTER (drop) AS d,
    count(*) FILTER (NOT drop AND trim(l) <> '') AS solid FROM judged GROUP BY r)
SELECT doc_id, source, CASE WHEN solid > 0 THEN t ELSE text END AS text, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines,
    CAST(CASE WHEN solid > 0 THEN d ELSE 0 END AS BIGINT) AS n_dropped
FROM pages LEFT JOIN kept USING (r)
"""

OP5 = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    coalesce(CAST(floor(turn / 256) AS BIGINT), -1) AS block FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
pieces AS (SELECT t.conv_id, perspective, block, turn, role = perspective AS own,
    '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN 'system'
        ELSE 'user name=' || replace(role, '<|', '< |') END || chr(10) AS head,
    replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS body
    FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (SELECT *, CAST(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, perspective, block ORDER BY turn
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM pieces)
SELECT conv_id, perspective, block, CAST(0 AS BIGINT) AS slice, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
    string_agg(head || body, '' ORDER BY turn) AS text,
    coalesce(string_agg((stop - length(body)) || ':' || stop, ',' ORDER BY turn) FILTER (own), '') AS spans
FROM placed GROUP BY conv_id, perspective, block
"""

OP11 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents),
cut AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (SELECT lang, m, list_slice(ws, i, i + m - 1) AS w FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
    FROM cut, (SELECT unnest([1, 2, 3]) AS m) WHERE len(ws) >= m)),
f AS (SELECT lang, m, w, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE m > 1 AND a >= 10),
held AS (SELECT lang, w, max(a) AS around FROM (SELECT lang, w[1:2] AS w, a FROM cand WHERE m = 3
    UNION ALL SELECT lang, w[2:3], a FROM cand WHERE m = 3) GROUP BY ALL),
cuts AS (SELECT c.lang, c.w, c.a, k, x.a AS l, y.a AS r,
    CAST(CAST(1000000 AS HUGEINT) * c.a * c.a // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM cand) c
    JOIN f x ON x.lang = c.lang AND x.w = c.w[1:k] JOIN f y ON y.lang = c.lang AND y.w = c.w[k + 1:]),
chosen AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
kept AS (SELECT chosen.lang, array_to_string(chosen.w, ' ') AS phrase, a, l, r, score FROM chosen
    LEFT JOIN held ON held.lang = chosen.lang AND held.w = chosen.w WHERE around IS NULL OR 100 * around < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

OP12 = r"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
    FROM documents),
spots AS (SELECT d, doc_id, i, list_slice(ws, i, i + 12) AS w
    FROM (SELECT *, unnest(range(1, len(ws) - 11)) AS i FROM docs WHERE len(ws) >= 13)),
firsts AS (SELECT w, min(doc_id) AS least FROM spots GROUP BY w HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT d, unnest(range(i, i + 13)) AS i FROM spots JOIN firsts USING (w) WHERE doc_id > least),
cut AS (SELECT d, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM docs),
kept AS (SELECT cut.d, string_agg(x, ' ' ORDER BY cut.i) FILTER (gone.d IS NULL) AS t, count(gone.d) AS k
    FROM cut LEFT JOIN gone ON gone.d = cut.d AND gone.i = cut.i GROUP BY cut.d)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(k, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (d)
"""

ORACLES = {
    "op1_decontamination": OP1,
    "op4_jaccard_join": OP4,
    "op5_chat_perspectives": OP5,
    "op10_line_dedup": OP10,
    "op11_collocations": OP11,
    "op12_substring_dedup": OP12,
}
