"""DuckDB SQL of the operators on shards, conversations and manifests: the same rows by other means
(windows, recursive queries and bit arithmetic), for tables of test size."""

from __future__ import annotations


def crc32(text: str) -> str:
    """SQL for the crc32 of a text, by half bytes; a table `low` holds the 16 remainders."""
    halves = f"string_split(regexp_replace(hex(encode({text})), '(.)(.)', '\\2\\1', 'g'), '')"
    value = f"list_transform(list_filter({halves}, lambda x: x <> ''), lambda x: (strpos('0123456789ABCDEF', x) - 1)::UBIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {value}), "
            "lambda c, v: xor(c >> 4, low[(xor(c, v) & 15)::BIGINT + 1])), 4294967295::UBIGINT)::BIGINT")


_LOW = """low AS (SELECT list_transform(range(16), lambda n: list_reduce([n::UBIGINT, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS low)"""

SHARDS = f"""
WITH {_LOW},
sizes AS (SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents, low),
summed AS (SELECT *, sum(size) OVER w - size AS before, sum(size) OVER () AS total, row_number() OVER w AS place
           FROM sizes WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING)),
placed AS (SELECT *, least(15, (2 * before + size) * 16 // (2 * total))::INTEGER AS shard FROM summed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
       (row_number() OVER (PARTITION BY shard ORDER BY place) - 1)::BIGINT AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""


def _field(x: str) -> str:
    return f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_CHANGED = f"CASE WHEN {crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"


def _steps(tree: str, units: str) -> str:
    """For every unit (g, place) of a tree its siblings: level, those on the left and on the right."""
    return f"""SELECT u.g, u.place, t.level, coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos < u.place // t.width), '') AS l,
       coalesce(string_agg(t.digest, '' ORDER BY t.pos) FILTER (t.pos > u.place // t.width), '') AS r
FROM {units} u JOIN {tree} t ON t.g IS NOT DISTINCT FROM u.g AND t.pos // 3 = u.place // t.width // 3 AND t.n > 1
GROUP BY u.g, u.place, t.level, t.width"""


def _tree(units: str) -> str:
    return f"""SELECT g, place AS pos, n, 0 AS level, 1::BIGINT AS width, digest FROM {units}
UNION ALL SELECT g, pos // 3, (n + 2) // 3, level + 1, 3 * width, sha256(string_agg(digest, '' ORDER BY pos))
FROM %s WHERE n > 1 GROUP BY g, pos // 3, n, level, width"""


MERKLE = f"""
WITH RECURSIVE {_LOW},
hashed AS (SELECT doc_id, source AS g, {_leaf('text')} AS digest, {_leaf('(' + _CHANGED + ')')} AS changed FROM documents, low),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS place, count(*) OVER (PARTITION BY g) AS n FROM hashed),
tree AS ({_tree('leaves') % 'tree'}),
tops AS (SELECT g AS source, 0 AS g, digest, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1),
upper_tree AS ({_tree('tops') % 'upper_tree'}),
low_steps AS ({_steps('tree', 'leaves')}),
high_steps AS ({_steps('upper_tree', 'tops')}),
steps AS (SELECT g, place, level, l, r FROM low_steps
          UNION ALL SELECT v.g, v.place, 1000 + h.level, h.l, h.r FROM leaves v JOIN tops t ON t.source IS NOT DISTINCT FROM v.g JOIN high_steps h ON h.place = t.place),
proofs AS (SELECT g, place, sha256(string_agg(l || r, '' ORDER BY level)) AS proof, list(l || '.' || r ORDER BY level) AS path FROM steps GROUP BY g, place),
found AS (SELECT v.doc_id, v.digest AS leaf, t.digest AS subroot, (SELECT digest FROM upper_tree WHERE n = 1) AS root,
                 coalesce(p.proof, sha256('')) AS proof_sha256,
                 list_reduce(list_prepend(v.changed, coalesce(p.path, [])),
                             lambda d, s: sha256(split_part(s, '.', 1) || d || split_part(s, '.', 2))) AS folded_root
          FROM leaves v JOIN tops t ON t.source IS NOT DISTINCT FROM v.g LEFT JOIN proofs p ON p.g IS NOT DISTINCT FROM v.g AND p.place = v.place)
SELECT *, folded_root = root AS verified FROM found
"""

#: Outputs by what they end with: 0 nothing yet, s, u or a. Grammar steps, and what up to two insertions give.
_MOVES = "moves(a, x, b) AS (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u'))"
_ADDED = """added(a, b, k, lines) AS (VALUES ('0', '0', 0, ''), ('s', 's', 0, ''), ('u', 'u', 0, ''), ('a', 'a', 0, ''),
    ('0', 'u', 1, chr(10) || 'user:'), ('s', 'u', 1, chr(10) || 'user:'), ('a', 'u', 1, chr(10) || 'user:'), ('u', 'a', 1, chr(10) || 'assistant:'),
    ('0', 'a', 2, chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 2, chr(10) || 'user:' || chr(10) || 'assistant:'))"""
_SPACE = r"\x20\x09-\x0D"

CONVERSATIONS = f"""
WITH RECURSIVE {_LOW}, {_MOVES}, {_ADDED},
kinds AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations, low),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                 count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
marked AS (SELECT *, left(role, 1) AS x, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
                  CASE WHEN NOT regexp_matches(text, '[^{_SPACE}]') THEN 'b'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                       WHEN NOT regexp_matches(text, '[.!?][{_SPACE}]*\\z') THEN 't' ELSE '' END AS fault FROM turns),
choices AS (SELECT conv_id, i, NULL AS x, 4 AS cost, 'D' AS edit, '' AS line FROM marked
            UNION ALL SELECT conv_id, i, x, CASE fault WHEN 't' THEN 3 ELSE 0 END, 'K', chr(10) || role || ':' || text FROM marked WHERE fault IN ('', 't')
            UNION ALL SELECT conv_id, i, left(r, 1), CASE fault WHEN 't' THEN 6 ELSE 3 END, 'R', chr(10) || r || ':' || text
            FROM marked, (VALUES ('user'), ('assistant')) roles(r) WHERE fault IN ('', 't')),
walk AS (SELECT conv_id, 0::BIGINT AS i, b AS state, {{'cost': 3 * k, 'audit': repeat('I', k), 'lines': lines}} AS v
         FROM (SELECT DISTINCT conv_id FROM marked), added WHERE a = '0'
         UNION ALL
         SELECT w.conv_id, w.i + 1, p.b, min({{'cost': w.v.cost + c.cost + 3 * p.k, 'audit': w.v.audit || c.edit || repeat('I', p.k), 'lines': w.v.lines || c.line || p.lines}})
         FROM walk w JOIN choices c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.i = w.i + 1
              LEFT JOIN moves m ON m.a = w.state AND m.x = c.x
              JOIN added p ON p.a = CASE WHEN c.edit = 'D' THEN w.state ELSE m.b END
         GROUP BY w.conv_id, w.i + 1, p.b),
ended AS (SELECT w.conv_id, min(w.v) AS v FROM walk w JOIN (SELECT conv_id, max(i) AS n FROM marked GROUP BY conv_id) e
          ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.n = w.i WHERE w.state IN ('0', 'a') GROUP BY w.conv_id),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                  count(*) FILTER (i > 1 AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v.cost, 0)::BIGINT AS cost,
       coalesce(v.audit, '') AS audit, sha256(coalesce(substr(v.lines, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
