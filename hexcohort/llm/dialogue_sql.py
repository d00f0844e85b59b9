"""DuckDB SQL of the queries on conversations, written from their definitions; it shares no constant with the operators."""

from __future__ import annotations

from hexcohort.llm.crc_sql import CRC_TABLE, crc32


def _add(state: str, cost: str, letter: str) -> str:
    """A state is its cost, in nine digits, and its audit; the least string is the cheapest, then ASCII-least."""
    return f"(lpad(CAST(CAST(left({state}, 9) AS INT) + {cost} AS VARCHAR), 9, '0') || substr({state}, 10) || '{letter}')"


def _open(letter: str, *states: str) -> str:
    """Keeps and reroles of a row that need not go, into the state that ``letter`` reaches from ``states``."""
    keeps = [f"CASE WHEN NOT gone AND ini = '{letter}' THEN {_add(s, 'extra', 'K')} END" for s in states]
    return ", ".join(keeps + [f"CASE WHEN NOT gone THEN {_add(s, 'extra + 1', 'R')} END" for s in states])


OP11 = rf"""
WITH RECURSIVE {CRC_TABLE},
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
kinds AS (SELECT s, {crc32('s')} % 20 AS kind FROM (SELECT DISTINCT s FROM named), crc_table),
spoiled AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
              CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
              unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
            FROM named JOIN kinds USING (s) WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM spoiled),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS last, left(role, 1) AS ini,
           regexp_matches(text, '[^\x20\x09-\x0D]') AS solid, regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS ended FROM placed),
faults AS (SELECT *, NOT solid AS blank, solid AND again AS duplicate, solid AND NOT again AND NOT ended AS truncated FROM seen),
r AS (SELECT conv_id, i, role, text, ini, blank OR duplicate AS gone, CASE WHEN truncated THEN 5 ELSE 0 END AS extra FROM faults),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
             count(*) FILTER (last IS NOT NULL AND (last || ini) NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
dp(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), '000000005I', '000000010II' FROM counts
  UNION ALL
  SELECT conv_id, i, n0, n1, least(b2, {_add('n0', '5', 'I')}, {_add('n1', '5', 'I')}, {_add('b3', '5', 'I')}),
    least(b3, {_add(f"least(b2, {_add('n0', '5', 'I')}, {_add('n1', '5', 'I')})", '5', 'I')})
  FROM (SELECT dp.conv_id, r.i, {_add('s0', '2', 'D')} AS n0,
          least({_add('s1', '2', 'D')}, CASE WHEN NOT gone AND ini = 's' THEN {_add('s0', 'extra', 'K')} END) AS n1,
          least({_add('s2', '2', 'D')}, {_open('u', 's0', 's1', 's3')}) AS b2, least({_add('s3', '2', 'D')}, {_open('a', 's2')}) AS b3
        FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1)),
best AS (SELECT dp.conv_id, least(s0, s3) AS s, c.n FROM dp JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.n = dp.i),
letters AS (SELECT conv_id, j, substr(s, 9 + j, 1) AS e FROM (SELECT conv_id, s, unnest(range(1, length(s) - 8)) AS j FROM best)),
steps AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o FROM letters
          WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
said AS (SELECT steps.*, r.role, r.text, r.ini FROM steps LEFT JOIN r ON steps.e <> 'I' AND r.conv_id IS NOT DISTINCT FROM steps.conv_id
         AND r.i = steps.i WHERE e <> 'D'),
head AS (SELECT *, max(CASE WHEN o = 1 AND e = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS systems FROM said),
texts AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - systems) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
            || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS said FROM head GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(CAST(left(s, 9) AS INT), 0) AS BIGINT) AS cost,
  coalesce(substr(s, 10), '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS a
LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN best AS b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN texts AS t ON t.conv_id IS NOT DISTINCT FROM a.conv_id
"""

OP13 = f"""
WITH {CRC_TABLE},
own AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
          struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS u FROM conversations WHERE conv_id IS NOT NULL),
lists AS (SELECT conv_id, list(u ORDER BY i) AS us FROM own GROUP BY conv_id),
heads AS (SELECT l.*, {crc32('CAST(conv_id AS VARCHAR)')} % 6 AS h FROM lists AS l, crc_table),
built AS (SELECT a.conv_id, list_concat(coalesce(b.us[1:a.h], []), coalesce(a.us[a.h + 1:], [])) AS us
          FROM heads AS a LEFT JOIN lists AS b ON b.conv_id = a.conv_id - a.conv_id % 100),
starts AS (SELECT conv_id, us, unnest(range(0, len(us) + 1)) AS d FROM built),
nodes AS (SELECT us[1:d] AS p, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
            string_agg(CASE WHEN d = len(us) THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id) AS ends FROM starts GROUP BY us[1:d]),
linked AS (SELECT n.*, m.conv_id AS parent_conv_id FROM nodes AS n LEFT JOIN nodes AS m ON n.depth > 0 AND m.p = n.p[1:n.depth - 1]),
children AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY p[1:depth - 1]),
counted AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked AS l LEFT JOIN children AS c ON c.p = l.p),
ups AS (SELECT p, p[1:unnest(range(0, depth + 1))] AS up, n_children, (n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE length(p[depth].t) END AS saved
        FROM counted),
sums AS (SELECT up, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens FROM ups GROUP BY up)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM counted AS c JOIN sums AS s ON s.up = c.p
"""
