"""The SQL that op12 must agree with: the same edits found turn by turn, without a grammar."""

ORACLE = r"""
WITH RECURSIVE
crc_bits(n, k, v) AS (
    SELECT range::BIGINT, 0, range::BIGINT FROM range(256)
    UNION ALL
    SELECT n, k + 1, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc_bits WHERE k < 8
),
crc_table AS (SELECT n, v AS entry FROM crc_bits WHERE k = 8),
given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
),
crc(key, byte, v) AS (
    SELECT DISTINCT key, 0, 4294967295::BIGINT FROM given
    UNION ALL
    SELECT c.key, c.byte + 1, xor(c.v >> 8, t.entry)
    FROM crc c JOIN crc_table t ON t.n = (xor(c.v, ascii(substr(c.key, c.byte + 1, 1))::BIGINT) & 255)
    WHERE c.byte < length(c.key)
),
kinds AS (SELECT key, xor(v, 4294967295) % 20 AS kind FROM crc WHERE byte = length(key)),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM given JOIN kinds USING (key), (SELECT range AS copy FROM range(2))
    WHERE kind <> 0 AND (copy = 0 OR kind = 3)
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
           rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen
    FROM damaged
),
faulty AS (
    SELECT *, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair,
           CASE WHEN seen = '' THEN 'blank'
                WHEN place > min(place) OVER (PARTITION BY conv_id, role, text) THEN 'duplicate'
                WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM placed
),
inserts(p, q, paid, edits, added) AS (
    VALUES ('', '', 0, '', ''), ('', 'u', 2, 'I', 'user:' || chr(10)), ('', 'a', 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
           ('s', 's', 0, '', ''), ('s', 'u', 2, 'I', 'user:' || chr(10)), ('s', 'a', 4, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
           ('u', 'u', 0, '', ''), ('u', 'a', 2, 'I', 'assistant:' || chr(10)), ('a', 'a', 0, '', ''), ('a', 'u', 2, 'I', 'user:' || chr(10))
),
follows(p, q, name) AS (
    VALUES ('', 's', ''), ('', 'u', 'user'), ('s', 'u', 'user'), ('a', 'u', 'user'), ('u', 'a', 'assistant')
),
moves AS (
    SELECT p, p AS q, 'D' AS edit, 3 AS paid, '' AS name FROM (VALUES (''), ('s'), ('u'), ('a')) v(p)
    UNION ALL SELECT p, q, 'K', 0, '' FROM follows
    UNION ALL SELECT p, q, 'R', 2, name FROM follows WHERE name <> ''
),
ways(conv_id, place, state, cost, audit, lines) AS (
    SELECT conv_id, 0::BIGINT, '', 0, '', '' FROM (SELECT DISTINCT conv_id FROM faulty)
    UNION ALL
    SELECT conv_id, place, q, min(paid), arg_min(edits, lpad(paid::VARCHAR, 10, '0') || edits),
           arg_min(written, lpad(paid::VARCHAR, 10, '0') || edits)
    FROM (
        SELECT w.conv_id, f.place, m.q,
               w.cost + i.paid + m.paid + CASE WHEN f.fault = 'truncated' AND m.edit <> 'D' THEN 1 ELSE 0 END AS paid,
               w.audit || i.edits || m.edit AS edits,
               w.lines || i.added || CASE m.edit WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10)
                                     ELSE m.name || ':' || f.text || chr(10) END AS written
        FROM ways w
        JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.place = w.place + 1
        JOIN inserts i ON i.p = w.state
        JOIN moves m ON m.p = i.q
        WHERE m.edit = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (m.edit = 'R' OR left(f.role, 1) = m.q))
    ) steps
    GROUP BY conv_id, place, q
),
ends AS (
    SELECT w.conv_id, w.cost + i.paid AS paid, w.audit || i.edits AS edits, w.lines || i.added AS written
    FROM ways w JOIN inserts i ON i.p = w.state
    JOIN (SELECT conv_id, max(place) AS top FROM faulty GROUP BY conv_id) t
      ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.top = w.place
    WHERE i.q IN ('', 'a')
),
best AS (
    SELECT conv_id, min(paid) AS cost, arg_min(edits, lpad(paid::VARCHAR, 10, '0') || edits) AS audit,
           arg_min(written, lpad(paid::VARCHAR, 10, '0') || edits) AS written
    FROM ends GROUP BY conv_id
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           sum(CASE WHEN fault = 'blank' THEN 1 ELSE 0 END) AS blank, sum(CASE WHEN fault = 'duplicate' THEN 1 ELSE 0 END) AS duplicate,
           sum(CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END) AS truncated,
           sum(CASE WHEN pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal
    FROM faulty GROUP BY conv_id
)
SELECT a.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit,
       sha256(coalesce(left(b.written, length(b.written) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""
