"""The expected results in SQL, where SQL can state them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op10_exact_dedup"] = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS body,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare FROM documents),
w AS (
  SELECT doc_id, sha256(bare) AS text_sha256, row_number() OVER p AS place,
         first_value(doc_id) OVER p AS keep_id, count(*) OVER (PARTITION BY bare) AS group_size
  FROM t WINDOW p AS (PARTITION BY bare ORDER BY length(body) DESC, doc_id NULLS FIRST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM w
"""

ORACLE["op3_line_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
w AS (
  SELECT doc_id, i, ls[i:i+2] AS k FROM d, unnest(range(1, len(ls) - 1)) AS r(i)),
rep AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS place FROM w) WHERE place > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM rep, unnest([0, 1, 2]) AS s(j)),
facts AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE apart) AS n_runs FROM (
    SELECT doc_id, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1) > 1 AS apart FROM gone) GROUP BY doc_id),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.p) AS stay
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS p FROM d) l
  LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.p = g.p WHERE g.p IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, len(ls) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs,
       sha256(coalesce(stay, '')) AS kept_sha256
FROM d LEFT JOIN facts f ON d.doc_id = f.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

#: Unsigned CRC-32 of a column of ASCII text, from the table ``t`` of the polynomial's 256 remainders.
_CRC_TABLE = """
crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, b:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t)"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda ch: CAST(ascii(ch) AS BIGINT))"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


def _to(state: int, sources: dict[int, int], edit: str) -> str:
    """Costs and audits that reach a state from others by one kind of edit; ``sources``: cost by state."""
    return ", ".join(f"{{'c': s{p}.c + {cost}, 'a': s{p}.a || '{edit}'}}" for p, cost in sources.items())


ORACLE["op12_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC_TABLE},
filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
         {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault
  FROM conversations, crc_table),
hurt AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body
  FROM filled, unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS u(copy) WHERE fault <> 0),
numbered AS (
  SELECT *, row_number() OVER c AS i, substr(role, 1, 1) AS r, lag(substr(role, 1, 1)) OVER c AS before,
         trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM hurt WINDOW c AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(body))),
known AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, body ORDER BY i) > 1 AS seen FROM numbered),
marked AS (
  SELECT *, bare = '' AS is_blank, bare <> '' AND seen AS is_again,
         bare <> '' AND NOT seen AND right(bare, 1) NOT IN ('.', '!', '?') AS is_cut FROM known),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (WHERE is_blank) AS blank, count(*) FILTER (WHERE is_again) AS duplicate,
         count(*) FILTER (WHERE is_cut) AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id),
steps AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}} AS s0, {{'c': 1000000000, 'a': ''}} AS s1,
         {{'c': 1000000000, 'a': ''}} AS s2, {{'c': 1000000000, 'a': ''}} AS s3 FROM facts
  UNION ALL
  SELECT g.conv_id, m.i,
    {{'c': s0.c + 4, 'a': s0.a || 'D'}},
    least({_to(1, {1: 4}, "D")}, CASE WHEN r = 's' AND NOT gone THEN {_to(1, {0: 0}, "K").replace("c + 0", "c + more")}
      ELSE {{'c': 2000000000, 'a': ''}} END),
    least({_to(2, {2: 4}, "D")}, CASE WHEN gone THEN {{'c': 2000000000, 'a': ''}} WHEN r = 'u'
      THEN least({_to(2, {0: 0, 1: 0, 3: 0}, "K").replace("c + 0", "c + more")})
      ELSE least({_to(2, {0: 3, 1: 3, 3: 3}, "R").replace("c + 3", "c + 3 + more")}) END),
    least({_to(3, {3: 4}, "D")}, CASE WHEN gone THEN {{'c': 2000000000, 'a': ''}} WHEN r = 'a'
      THEN {_to(3, {2: 0}, "K").replace("c + 0", "c + more")} ELSE {_to(3, {2: 3}, "R").replace("c + 3", "c + 3 + more")} END)
  FROM (SELECT conv_id, i, s0, s1, least(s2, {_to(2, {0: 3, 1: 3, 3: 3}, "I")}) AS s2,
               least(s3, {_to(3, {2: 3}, "I")}, {_to(3, {0: 6, 1: 6}, "II")}) AS s3 FROM steps) g
  JOIN (SELECT *, is_blank OR is_again AS gone, CASE WHEN is_cut THEN 3 ELSE 0 END AS more FROM marked) m
    ON g.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = g.i + 1),
ends AS (
  SELECT s.conv_id, least(s0, s3, {_to(3, {2: 3}, "I")}, {_to(3, {1: 6}, "II")}) AS best
  FROM steps s JOIN facts f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.i = f.n),
letters AS (
  SELECT conv_id, k, substr(best.a, k, 1) AS edit, length(replace(substr(best.a, 1, k), 'I', '')) AS i
  FROM ends, unnest(range(1, length(best.a) + 1)) AS u(k)),
emitted AS (
  SELECT l.conv_id, l.k, l.edit, m.role, m.body, count(*) FILTER (WHERE l.edit <> 'K' OR m.r <> 's') OVER p AS turns
  FROM letters l LEFT JOIN marked m ON l.edit <> 'I' AND l.conv_id IS NOT DISTINCT FROM m.conv_id AND l.i = m.i
  WHERE l.edit <> 'D' WINDOW p AS (PARTITION BY l.conv_id ORDER BY l.k)),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN turns % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
    || CASE WHEN edit = 'I' THEN '' ELSE body END, chr(10) ORDER BY k) AS joined FROM emitted GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(joined, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON o.conv_id IS NOT DISTINCT FROM f.conv_id LEFT JOIN ends e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN lines l ON o.conv_id IS NOT DISTINCT FROM l.conv_id
"""

#: A run of period q has a multiple k * q in its first period, and the 2 q words from there on stand q words later again. Only those
#: (q, k) are followed up; a run is then a maximal stretch of places whose word stands q places later again.
ORACLE["op11_periodic_runs"] = rf"""
WITH {_CRC_TABLE},
split AS (
  SELECT row_number() OVER () AS id, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sums AS (SELECT *, len(w) AS n, {_crc32("CAST(doc_id AS VARCHAR)")} AS h FROM split, crc_table),
places AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM sums),
planned AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - a) // (3 + g % 8) END AS p FROM places),
final AS MATERIALIZED (
  SELECT id, doc_id, n, CASE WHEN p IS NULL THEN w ELSE list_transform(range(n), lambda i:
    w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM planned),
hits AS (
  SELECT DISTINCT id, q FROM (
    SELECT id, w, q, unnest(range(0, n - 3 * q + 1, q)) AS x FROM (SELECT id, w, n, unnest(range(1, n // 4 + 1)) AS q FROM final))
  WHERE w[x + 1] = w[x + q + 1] AND w[x + 1] = w[x + 2 * q + 1] AND w[x + 1:x + 2 * q] = w[x + q + 1:x + 3 * q]),
same AS (
  SELECT id, q, i, i - row_number() OVER (PARTITION BY id, q ORDER BY i) AS island FROM (
    SELECT f.id, q, w, unnest(range(0, n - q)) AS i FROM final f JOIN hits ON f.id = hits.id)
  WHERE w[i + 1] = w[i + q + 1]),
stretches AS (SELECT id, q, min(i) AS s, count(*) + q AS l FROM same GROUP BY id, q, island),
runs AS (SELECT id, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY id, s, l),
told AS (
  SELECT id, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS lines,
         first({{'s': s, 'l': l, 'q': q}} ORDER BY l DESC, s, q) AS best FROM runs GROUP BY id),
gone AS (SELECT DISTINCT id, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT x.id, string_agg(word, ' ' ORDER BY x.i) AS body
  FROM (SELECT id, unnest(w) AS word, unnest(range(n)) AS i FROM final) x LEFT JOIN gone ON x.id = gone.id AND x.i = gone.i
  WHERE gone.i IS NULL GROUP BY x.id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.l AS length, best.q AS period,
       CAST(1000 * best.l // best.q AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(body, '')) AS collapsed_sha256
FROM final f LEFT JOIN told ON f.id = told.id LEFT JOIN kept ON f.id = kept.id
"""
