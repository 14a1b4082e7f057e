"""SQL for the operators that SQL can express."""

from __future__ import annotations

from tidewire.llm.chat_windows import BUDGET, ESCAPE, HISTORY, MARKS, OTHER
from tidewire.llm.filter_audit import FILTERS, LEAST_DISTINCT, LEAST_WORDS as AUDIT_WORDS, MOST_CAPITALS
from tidewire.llm.mixture import BLOCK_DOCS
from tidewire.llm.secrets import ACCESS, ASSIGN, ASSIGN_CHARS, FEW_OWNERS, HEX, MANY_REPOS
from tidewire.llm.sentence_spans import LEAST_WORDS, LONE_WORDS

_ASSIGN = ASSIGN.replace("'", "''")

#: Places follow from the lengths of the pieces between the matches, as in the operator.
SECRET_SCANS = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT rid, doc_id, source, 'assign' AS kind, 1 AS ord, string_split_regex(t, '{_ASSIGN}') AS gap, regexp_extract_all(t, '{_ASSIGN}', 0) AS w, regexp_extract_all(t, '{_ASSIGN}', 2) AS v FROM d WHERE regexp_matches(t, '{_ASSIGN}')
  UNION ALL SELECT rid, doc_id, source, 'access', 2, string_split_regex(t, '{ACCESS}'), regexp_extract_all(t, '{ACCESS}', 0), regexp_extract_all(t, '{ACCESS}', 0) FROM d WHERE regexp_matches(t, '{ACCESS}')
  UNION ALL SELECT rid, doc_id, source, 'hex', 3, string_split_regex(t, '{HEX}'), regexp_extract_all(t, '{HEX}', 0), regexp_extract_all(t, '{HEX}', 0) FROM d WHERE regexp_matches(t, '{HEX}')
  UNION ALL SELECT rid, doc_id, source, 'owned', 4, string_split_regex(t, '[A-Za-z0-9+/_-]+'), regexp_extract_all(t, '[A-Za-z0-9+/_-]+', 0), regexp_extract_all(t, '[A-Za-z0-9+/_-]+', 0) FROM d WHERE regexp_matches(t, '[A-Za-z0-9+/_-]{{20}}')),
i AS (SELECT rid, doc_id, source, kind, ord, unnest(gap[:len(w)]) AS gap, unnest(w) AS w, unnest(v) AS v, generate_subscripts(w, 1) AS k FROM m),
s AS (SELECT rid, doc_id, source, kind, ord, v, CAST(sum(length(gap) + length(w)) OVER (PARTITION BY rid, kind ORDER BY k) AS BIGINT) AS e, length(w) AS n FROM i),
f AS (SELECT *, e - n AS a FROM s WHERE CASE kind WHEN 'assign' THEN length(v) >= {ASSIGN_CHARS} WHEN 'owned' THEN n >= 20 AND regexp_full_match(v, '[A-Za-z0-9_-]+') AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') ELSE true END),
c AS (SELECT * FROM f x WHERE kind <> 'owned' OR NOT EXISTS (SELECT 1 FROM f y WHERE y.rid = x.rid AND y.kind <> 'owned' AND x.a < y.e AND y.a < x.e)),
o AS (SELECT v, count(DISTINCT coalesce(source, chr(1))) AS owners FROM c GROUP BY v),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, ord) FILTER (kind <> 'owned') AS base,
  string_agg(kind || ':' || a || ':' || e, ',' ORDER BY a, ord) FILTER (kind <> 'owned' OR owners <= {FEW_OWNERS}) AS spans,
  count(*) FILTER (owners <= {FEW_OWNERS}) AS n_live, count(*) FILTER (owners > {FEW_OWNERS}) AS n_example FROM c JOIN o USING (v) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN g USING (rid)
"""

#: The same candidates, counted by distinct owners and repositories.
SECRET_OWNERSHIP = SECRET_SCANS.split(",\no AS")[0] + rf""",
h AS (SELECT sha256(v) AS hash, count(DISTINCT coalesce(source, chr(1))) AS n_owners, count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), chr(1))) AS n_repos FROM c GROUP BY v)
SELECT hash, n_owners, n_repos, CASE WHEN n_owners > {FEW_OWNERS} THEN 'example' WHEN n_repos > {MANY_REPOS} THEN 'copied' ELSE 'live' END AS verdict FROM h
"""

_WORDS = r"CASE WHEN trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = '' THEN 0 ELSE len(string_split_regex(trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+')) END"

#: Water filling by the order of cap over weight; first fit walks each block's documents in order.
SOURCE_MIXTURE = rf"""
WITH RECURSIVE d0 AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
d AS (SELECT rid, doc_id, source, CAST({_WORDS} AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|17|' || t) AS h FROM d0),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n, CAST(1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS DOUBLE) AS w FROM d GROUP BY source),
s1 AS (SELECT *, 3.0::DOUBLE * source_size / w AS r, (SELECT CAST(sum(source_size) AS DOUBLE) FROM s0) AS total FROM s0 WHERE source_size > 0),
s2 AS (SELECT *, (total - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY r, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY r, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s1),
lv AS (SELECT coalesce(max(level) FILTER (level <= r), 1e300) AS level FROM s2),
s AS (SELECT s0.source, source_size, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE least(w * lv.level, 3.0::DOUBLE * source_size) END AS target, greatest(1, CAST(ceil(n / {BLOCK_DOCS}.0) AS BIGINT)) AS blocks FROM s0, lv),
q AS (SELECT *, CASE WHEN source_size > 0 THEN least(CAST(floor(target / source_size) AS INTEGER), 3) ELSE 0 END AS full_passes, CASE WHEN source_size > 0 THEN target / source_size - least(floor(target / source_size), 3) ELSE 0.0::DOUBLE END AS part FROM s),
b AS (SELECT d.*, source_size, target, full_passes, part, CAST('0x' || substr(h, 1, 15) AS BIGINT) % blocks AS block FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source),
o AS (SELECT *, row_number() OVER (PARTITION BY source, block ORDER BY substr(h, 16), h, size) AS k, CAST(sum(size) OVER (PARTITION BY source, block) AS BIGINT) AS words FROM b),
z AS (SELECT *, part > 0.5 AS inverse, CAST(CASE WHEN part > 0.5 THEN words - round(words * part) ELSE round(words * part) END AS BIGINT) AS quota FROM o),
f AS (
  SELECT rid, source, block, k, size, inverse, CASE WHEN size > 0 AND size <= quota THEN quota - size ELSE quota END AS remaining, size > 0 AND size <= quota AS fits FROM z WHERE k = 1
  UNION ALL
  SELECT z.rid, z.source, z.block, z.k, z.size, z.inverse, CASE WHEN z.size > 0 AND z.size <= remaining THEN remaining - z.size ELSE remaining END, z.size > 0 AND z.size <= remaining FROM f JOIN z ON z.source IS NOT DISTINCT FROM f.source AND z.block = f.block AND z.k = f.k + 1),
g AS (SELECT rid, inverse, fits, size, row_number() OVER (PARTITION BY source, block ORDER BY NOT fits AND size > 0 DESC, size, k) AS s, min(remaining) OVER (PARTITION BY source, block) AS remaining FROM f),
t AS (SELECT rid, (fits OR (s = 1 AND NOT fits AND size > 0 AND size < 2 * remaining)) <> inverse AS taken_in FROM g)
SELECT doc_id, size, source_size, round(target, 6) AS target, CAST(CASE WHEN size = 0 THEN 0 ELSE size * (full_passes + CAST(taken_in AS INTEGER)) END AS BIGINT) AS taken FROM z JOIN t USING (rid)
"""

_SENTENCE = r"[^.!?\n]*[.!?\n]+[\x20\x09-\x0D]*|[^.!?\n]+"

#: Runs end where the running word count first reaches the least words, found by as-of joins in both directions.
SENTENCE_SPANS = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT rid, doc_id, unnest(regexp_extract_all(t, '{_SENTENCE}')) AS s, generate_subscripts(regexp_extract_all(t, '{_SENTENCE}'), 1) AS i FROM d),
w AS (SELECT *, list_filter(string_split_regex(translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM p),
c AS (SELECT rid, doc_id, i, s, array_to_string(ws, ' ') AS norm, CAST(len(ws) AS BIGINT) AS n, CAST(sum(len(ws)) OVER (PARTITION BY rid ORDER BY i) AS BIGINT) AS upto, count(*) OVER (PARTITION BY rid) AS total FROM w),
e AS (SELECT rid, upto, min(i) AS j FROM c GROUP BY rid, upto),
b AS (SELECT rid, upto - n AS before, max(i) AS k FROM c GROUP BY rid, upto - n),
x AS (SELECT rid, i, n, total, upto - n + {LEAST_WORDS} AS least, upto - {LEAST_WORDS} AS most FROM c),
runs AS (
  SELECT x.rid, i AS a, CASE WHEN n >= {LONE_WORDS} THEN i ELSE greatest(j, i + 1) END AS z, total FROM x ASOF JOIN e ON x.rid = e.rid AND x.least <= e.upto
  UNION SELECT x.rid, CASE WHEN n >= {LONE_WORDS} THEN i ELSE least(k, i - 1) END, i, total FROM x ASOF JOIN b ON x.rid = b.rid AND x.most >= b.before),
h AS (SELECT r.rid, c.doc_id, r.a, r.z, md5(string_agg(c.norm, chr(1) ORDER BY c.i)) AS h FROM runs r JOIN c ON r.rid = c.rid AND c.i BETWEEN r.a AND r.z WHERE r.a >= 1 AND r.z <= r.total GROUP BY ALL),
later AS (SELECT rid, a, z FROM (SELECT *, rank() OVER (PARTITION BY h ORDER BY doc_id NULLS FIRST, a) AS k FROM h) WHERE k > 1),
gone AS (SELECT DISTINCT rid, unnest(range(a, z + 1)) AS i FROM later),
o AS (SELECT c.rid, count(*) AS n_sentences, count(gone.i) AS n_removed, string_agg(c.s, '' ORDER BY c.i) FILTER (gone.i IS NULL) AS text FROM c LEFT JOIN gone ON c.rid = gone.rid AND c.i = gone.i GROUP BY c.rid)
SELECT doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed, coalesce(o.text, '') AS text FROM d LEFT JOIN o USING (rid)
"""

#: Every document passes through every order, without counting equal documents first.
FILTER_AUDIT = rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (SELECT doc_id, part, len(ws) < {AUDIT_WORDS} AS a, 100 * len(list_distinct(ws)) < {LEAST_DISTINCT} * len(ws) AS b, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, coalesce(doc_id > first, false) AS e FROM w),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails FROM f LEFT JOIN l ON f.doc_id = l.doc_id),
x AS (SELECT unnest(string_split('{FILTERS}', '')) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
k AS (SELECT part, good, bad, fails, filter_order, step, filter_order[step] AS letter, contains(fails, filter_order[step]) AS hit, regexp_matches(fails, '[' || filter_order[1:step] || ']') AS gone, step > 1 AND regexp_matches(fails, '[' || filter_order[1:step - 1] || '0]') AS before FROM m, s),
g AS (SELECT part, filter_order, step, letter, count(*) FILTER (NOT gone) AS kept, count(*) FILTER (hit AND NOT before) AS removed, count(*) FILTER (hit AND before) AS redundant, count(*) FILTER (fails = letter) AS unique_fails, count(*) FILTER (hit AND NOT before AND good) AS good_lost, count(*) FILTER (hit AND NOT before AND bad) AS toxic_lost FROM k GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM g
"""

_esc = lambda c: f"regexp_replace({c}, '{ESCAPE[0]}', '\\1\\\\\\2\\3', 'g')"
_chars = " ".join(f"WHEN '{role}' THEN {sum(map(len, marks))} + length({_esc('text')})" for role, marks in MARKS.items())

#: Windows by running sums over whole conversations, history by position; only lengths of formatted texts are built.
CHAT_WINDOWS = rf"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, CAST(ceil(length(text) / 4.0) AS BIGINT) + 4 AS tok, CASE role {_chars} ELSE {sum(map(len, OTHER))} + length({_esc('role')}) + length({_esc('text')}) END AS len FROM r),
p AS (SELECT *, row_number() OVER o AS i, CAST(sum(tok) OVER o AS BIGINT) - tok AS pos FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, tok, text ROWS UNBOUNDED PRECEDING)),
c AS (SELECT conv_id, coalesce(max(tok) FILTER (i = 1 AND role = 'system'), 0) AS sys, coalesce(max(tok) FILTER (role <> 'system'), 0) AS longest, max(len) FILTER (i = 1 AND role = 'system') AS sys_len,
  string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS said, coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '') AS learned, count(*) AS n FROM p GROUP BY conv_id),
k AS (SELECT *, greatest(greatest({BUDGET - HISTORY} - sys, sys, {2 * HISTORY}, 2) - longest, greatest({BUDGET - HISTORY} - sys, sys, {2 * HISTORY}, 2) // 2) AS stride FROM c),
s AS (SELECT p.conv_id, i, len, stride, i = 1 AND sys > 0 AS is_sys, pos - CASE WHEN i = 1 AND sys > 0 THEN 0 ELSE sys END AS a, tok FROM p JOIN k ON p.conv_id IS NOT DISTINCT FROM k.conv_id),
w AS (SELECT *, a + tok AS b, CASE WHEN is_sys THEN 0 ELSE a // stride END AS span FROM s),
own AS (SELECT conv_id, span, CAST(sum(len) AS BIGINT) AS len, count(*) AS n, min(a) FILTER (NOT is_sys) AS a FROM w GROUP BY ALL),
hist AS (SELECT conv_id, span + 1 AS span, CAST(sum(len) AS BIGINT) AS len, count(*) AS n, max(b) AS b FROM w WHERE NOT is_sys AND a >= (span + 1) * stride - {HISTORY} AND b <= (span + 1) * stride + {HISTORY} GROUP BY ALL),
f AS (SELECT own.conv_id, own.len + own.n - 1 + CASE WHEN hist.b = own.a THEN hist.len + hist.n ELSE 0 END + CASE WHEN own.span > 0 AND sys > 0 THEN sys_len + 1 ELSE 0 END AS len
  FROM own JOIN k ON own.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN hist ON own.conv_id IS NOT DISTINCT FROM hist.conv_id AND own.span = hist.span),
z AS (SELECT conv_id, CAST(sum(len) AS BIGINT) AS len FROM f GROUP BY conv_id)
SELECT k.conv_id, n AS n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, z.len AS formatted_chars FROM k JOIN z ON k.conv_id IS NOT DISTINCT FROM z.conv_id
"""
