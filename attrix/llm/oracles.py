"""DuckDB SQL of the numbered queries that SQL can express, over the whole tables."""

OP1 = r"""
WITH planted(conv_id, turn, role, text) AS (VALUES
  (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
src AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM planted)),
marked AS (SELECT *, bool_or(regexp_matches(text, '<\|im_(start|end)\|>|<\\+\|')
                             OR regexp_matches(role, '<\|im_(start|end)\|>|<\\+\||\n|\\n|\\b'))
                     OVER (PARTITION BY conv_id) AS esc FROM src),
shown AS (SELECT *, CASE WHEN esc THEN regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') ELSE text END AS out_text,
                 CASE WHEN esc THEN regexp_replace(replace(replace(role, '\', '\b'), chr(10), '\n'),
                                                   '<(\\*)\|', '<\\\1|', 'g') ELSE role END AS out_role FROM marked)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
       CAST(sum(length(out_role) + length(out_text) + 24) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""

OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, payload, sha1(payload) AS hx,
             row_number() OVER (PARTITION BY payload ORDER BY page_id DESC) AS k,
             max(page_id) OVER (PARTITION BY payload) AS keep FROM p),
d AS (SELECT *, list_transform(range(40), lambda i: instr('0123456789abcdef', substr(hx, CAST(i + 1 AS INTEGER), 1)) - 1) AS v FROM h)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + list_sum(
    list_transform(range(5), lambda j: ((CAST(v[((5 * g + j) // 4) + 1] AS INTEGER) >> CAST(3 - (5 * g + j) % 4 AS INTEGER)) & 1)
                                  * CAST(pow(2, 4 - j) AS INTEGER))) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN k > 1 THEN keep END AS refers_to
FROM d
"""

_REACH = """
reach(node, other) AS (SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
comp AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node)"""

OP4 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT vec_id, label, e, list_sum(list_transform(e, lambda x: x * x)) AS nn FROM v
       WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y
          ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
          AND list_dot_product(x.e, y.e) / sqrt(x.nn * y.nn) >= 0.98),
{_REACH},
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component, vec_id) AS component_id,
       coalesce(component, vec_id) = vec_id AS kept
FROM v LEFT JOIN n ON n.a = vec_id LEFT JOIN comp ON comp.node = vec_id
"""

OP6 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(len(ws) - 4), lambda i: array_to_string(ws[i + 1:i + 5], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
         GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * k >= 80 * (na.n + nb.n - k)),
{_REACH}
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.node = w.doc_id
"""

_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
s AS (SELECT r, doc_id, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS l FROM s),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000e0 * ln((2e0 * docs + 2e0) / (2e0 * count(*) + 1e0))) AS BIGINT) AS w
      FROM tf, g GROUP BY term, docs),
q AS (SELECT item_id, term, count(*) AS k
      FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
m AS (SELECT r, doc_id, 75 + (25 * n * docs) // l AS m FROM s, g),
v AS (SELECT tf.r, doc_id, term, w.w * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS v
      FROM tf JOIN w USING (term) JOIN m ON m.r = tf.r),
sc AS (SELECT item_id, r, any_value(doc_id) AS doc_id, CAST(sum(k * v) AS BIGINT) AS score
       FROM q JOIN v USING (term) GROUP BY item_id, r),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM sc WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

# one cell of the state vector: cost and edits so far
def _least(*ways: str) -> str:
    return "list_min([" + ", ".join(ways) + "])"


def _way(state: str, cost: str, edits: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || {edits}}}"


_CRC = """(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(k, ''),
          lambda ch: [CAST(unicode(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
          lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END))"""
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP11 = f"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
coded AS (SELECT *, xor({_CRC}, 4294967295) % 20 AS code FROM src),
rows_ AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN code = 1 THEN '' WHEN code = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy FROM coded WHERE code <> 0)),
named AS (SELECT coalesce('1' || CAST(conv_id AS VARCHAR), '0') AS id, *, substr(role, 1, 1) AS ini,
                 rtrim(text, {_BLANKS}) AS bare,
                 sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS rk FROM rows_),
ordered AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, rk) AS i FROM named),
placed AS (SELECT *, row_number() OVER (PARTITION BY id, role, text ORDER BY i) AS seen FROM ordered),
marked AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                          WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  lag(CASE WHEN ini IN ('s', 'u', 'a') THEN ini ELSE 'o' END) OVER (PARTITION BY id ORDER BY i) AS prev FROM placed),
step(id, i, s0, s1, s2, s3) AS (
  SELECT DISTINCT id, CAST(0 AS BIGINT), {{'c': CAST(0 AS BIGINT), 'a': ''}}, {{'c': CAST(1000000000 AS BIGINT), 'a': ''}},
         {{'c': CAST(1000000000 AS BIGINT), 'a': ''}}, {{'c': CAST(1000000000 AS BIGINT), 'a': ''}} FROM marked
  UNION ALL
  SELECT id, i,
         {_way('s0', '4', "'D'")},
         {_least(_way('s1', '4', "'D'"), _way('s0', "(CASE WHEN live AND ini = 's' THEN more ELSE 1000000000 END)", "'K'"))},
         {_least(_way('j2', '4', "'D'"), *[_way(q, "(CASE WHEN NOT live THEN 1000000000 WHEN ini = 'u' THEN more ELSE 3 + more END)",
                                             "(CASE WHEN ini = 'u' THEN 'K' ELSE 'R' END)") for q in ('s0', 's1', 'j3')])},
         {_least(_way('j3', '4', "'D'"), _way('j2', "(CASE WHEN NOT live THEN 1000000000 WHEN ini = 'a' THEN more ELSE 3 + more END)",
                                            "(CASE WHEN ini = 'a' THEN 'K' ELSE 'R' END)"))}
  FROM (SELECT m.id, m.i, m.ini, m.fault NOT IN ('blank', 'duplicate') AS live, CASE WHEN m.fault = 'truncated' THEN 3 ELSE 0 END AS more,
               s0, s1,
               {_least('s2', *[_way(q, '3', "'I'") for q in ('s0', 's1', 's3')])} AS j2,
               {_least('s3', _way('s0', '6', "'II'"), _way('s1', '6', "'II'"), _way('s2', '3', "'I'"))} AS j3
        FROM step JOIN marked m ON m.id = step.id AND m.i = step.i + 1)),
best AS (SELECT id, {_least('s0', _way('s1', '6', "'II'"), _way('s2', '3', "'I'"), 's3')} AS b
         FROM step WHERE (id, i) IN (SELECT id, max(i) FROM marked GROUP BY id)),
edits AS (SELECT id, p, substr(a, CAST(p AS BIGINT), 1) AS e FROM (SELECT id, b.a AS a, unnest(range(1, length(b.a) + 1)) AS p FROM best)),
lined AS (SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY p) AS i,
                 sum(CASE WHEN e <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY p) AS o FROM edits),
shown AS (SELECT l.*, m.role, m.text, m.ini FROM lined l LEFT JOIN marked m ON m.id = l.id AND m.i = l.i AND l.e <> 'I' WHERE e <> 'D'),
headed AS (SELECT *, max(CASE WHEN o = 1 AND e = 'K' AND ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY id) AS h FROM shown),
final AS (SELECT id, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - h) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY o) AS t FROM headed GROUP BY id),
facts AS (SELECT id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                 count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                 count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0) AS cost, coalesce(b.a, '') AS audit,
       sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('1' || CAST(conv_id AS VARCHAR), '0') AS id FROM conversations)
LEFT JOIN facts USING (id) LEFT JOIN best USING (id) LEFT JOIN final USING (id)
"""
