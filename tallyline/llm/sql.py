"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = r"""
WITH cut AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
line AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM cut
),
keyed AS (
    SELECT doc_id, line, pos,
        translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM line
),
repeated AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
marked AS (
    SELECT k.doc_id, k.line, k.pos, (r.key IS NOT NULL AND k.doc_id <> r.keeper) AS gone
    FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS BIGINT)) AS BIGINT) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

CHAT = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -1, n, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS extra (n, r)
),
turns AS (
    SELECT *,
        replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;') AS name,
        (contains(text, '<s>') OR contains(text, '</s>') OR contains(text, '[INST]') OR contains(text, '[/INST]')) AS clash,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS no
    FROM given
),
marked AS (
    SELECT *,
        '<s>' || name || (CASE WHEN clash THEN '<e>' ELSE '' END) || chr(10)
        || (CASE WHEN role = 'user' THEN '[INST] ' ELSE '' END)
        || (CASE WHEN clash THEN replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;') ELSE text END)
        || (CASE WHEN role = 'user' THEN ' [/INST]' ELSE '' END) || '</s>' AS mark
    FROM turns
),
chats AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY no) AS lines,
        coalesce(string_agg(text, '' ORDER BY no) FILTER (WHERE role = 'assistant'), '') AS loss,
        CAST(sum(length(mark)) AS BIGINT) AS formatted_chars
    FROM marked GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    formatted_chars
FROM chats
"""

# A run's matches at its period are at least six words long, so equal stretches of six words are paired.
PERIODIC = r"""
WITH cut AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
hashed AS (
    SELECT doc_id, words, len(words) AS n, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))
    )) AS h
    FROM cut
),
planned AS (
    SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM hashed
),
planted AS (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN words ELSE list_transform(range(n), lambda i:
        words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) END AS words
    FROM planned
),
word AS (
    SELECT doc_id, n, unnest(words) AS w, unnest(range(n)) AS i FROM planted
),
six AS (
    SELECT doc_id, n, i, string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS s
    FROM word QUALIFY count(*) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) = 6
),
pair AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM six x JOIN six y
    ON x.doc_id = y.doc_id AND x.s = y.s AND y.i > x.i AND 2 * (y.i - x.i) <= x.n
),
stretch AS (
    SELECT doc_id, q, min(i) AS s, max(i) + 6 + q AS e
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pair)
    GROUP BY doc_id, q, island HAVING count(*) + 5 >= greatest(12 - q, q)
),
run AS (
    SELECT doc_id, s, e, min(q) AS q FROM stretch GROUP BY doc_id, s, e
),
top AS (
    SELECT doc_id, count(*) AS n_runs, arg_min({s: s, l: e - s, q: q}, {l: s - e, s: s, q: q}) AS best,
        string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS listed
    FROM run GROUP BY doc_id
),
kept AS (
    SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS collapsed FROM word
    WHERE NOT EXISTS (SELECT 1 FROM run WHERE run.doc_id = word.doc_id AND i >= s + q AND i < e) GROUP BY doc_id
)
SELECT cut.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
    1000 * best.l // best.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
    sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM cut LEFT JOIN top ON top.doc_id = cut.doc_id LEFT JOIN kept ON kept.doc_id = cut.doc_id
"""

FIM = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || doc_id) AS hex,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
    FROM documents
),
hashed AS (
    SELECT *, len(units) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
        CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
    FROM cut
),
placed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS one, greatest(h1 % (n + 1), h2 % (n + 1)) AS two,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
             THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
),
made AS (
    SELECT doc_id, n, form, text, array_to_string(units[1:one], '') AS prefix,
        array_to_string(units[one + 1:two], '') AS middle, array_to_string(units[two + 1:], '') AS suffix
    FROM placed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
           ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM made
"""

MINHASH = r"""
WITH RECURSIVE cut AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
sets AS (
    SELECT doc_id, CASE len(words) WHEN 0 THEN [] WHEN 1 THEN words WHEN 2 THEN [words[1] || ' ' || words[2]]
        WHEN 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i:
            words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3])) END AS shingles
    FROM cut
),
sized AS (SELECT doc_id, len(shingles) AS n FROM sets),
held AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
pair AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM held x JOIN held y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
    GROUP BY ALL
),
link AS (
    SELECT a, b FROM pair JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)
),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
    SELECT a AS doc_id, b AS other FROM edge
    UNION
    SELECT reach.doc_id, edge.b FROM reach JOIN edge ON edge.a = reach.other
),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT sized.doc_id, n AS n_shingles, least(sized.doc_id, coalesce(other, sized.doc_id)) AS component_id,
    sized.doc_id <= coalesce(other, sized.doc_id) AS kept
FROM sized LEFT JOIN least ON least.doc_id = sized.doc_id
"""
