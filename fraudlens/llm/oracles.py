"""The same questions in SQL of another engine, for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The smallest id that links (a, b), in both directions, reach from each id.
REACH = """reach(id, c) AS (SELECT id, id FROM ids UNION SELECT l.b, r.c FROM reach r JOIN both_ways l ON l.a = r.id),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)"""

USABLE = """vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)"""

HOST, PATH = r"translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{}', '{}')".format(UPPER, LOWER), r"coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '')"
LISTED_SQL = "(VALUES ('ads-track'), ('adult-x'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')) names(name), (VALUES ('example.com'), ('example.net'), ('example.org')) below(domain)"


def crc32(text: str) -> str:
    """The checksum of an ASCII text: its bytes, each followed by eight steps, from a register of ones."""
    steps = f"flatten([[ascii(b), -1, -1, -1, -1, -1, -1, -1, -1] for b in string_split({text}, '')])"
    step = "CASE WHEN x >= 0 THEN xor(r, x) WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END"
    return f"xor(list_reduce(list_prepend(4294967295, [CAST(s AS BIGINT) for s in {steps}]), lambda r, x: {step}), 4294967295)"


# States: 0 nothing yet, 1 after s, 2 after u, 3 after a; what turns, or none, may follow, after what inserts.
MADE = "(VALUES (0, 2), (1, 2), (2, 3), (3, 2)) made(state, next)"
FITS = "(VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) fits(state, initial, next)"

ORACLES = {
    "op3_substring_dedup": f"""WITH w AS (SELECT doc_id, coalesce({WORDS}, []) AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
first AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM (SELECT w.doc_id, w.i, unnest(range(13)) AS j FROM windows w JOIN first USING (k) WHERE d < w.doc_id)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, (SELECT count(*) FROM gone g WHERE g.doc_id = w.doc_id) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op4_near_dedup": f"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS.replace('text', f"translate(text, '{UPPER}', '{LOWER}')")} AS ws FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, CASE WHEN len(ws) = 0 THEN 1 ELSE greatest(len(ws) - 3, 2) END)) AS i FROM w)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
both_ways AS (SELECT a, b FROM pairs p JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
ids AS (SELECT doc_id AS id FROM documents), {REACH}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c AS component_id, d.doc_id = c AS kept
FROM documents d JOIN least ON least.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id""",
    "op8_topk": f"""WITH {USABLE}, whole AS (SELECT vec_id, list_transform(v, lambda x: floor(256 * x)) AS v FROM vectors),
scores AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM whole q JOIN whole r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores) WHERE rank <= 5""",
    "op10_embedding_dedup": f"""WITH RECURSIVE {USABLE}, nonzero AS (SELECT * FROM vectors WHERE len(list_filter(v, lambda x: x <> 0)) > 0),
both_ways AS (SELECT x.vec_id AS a, y.vec_id AS b FROM nonzero x JOIN nonzero y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.9),
ids AS (SELECT vec_id AS id FROM embeddings), {REACH}
SELECT e.vec_id, (SELECT count(*) FROM both_ways l WHERE l.a = e.vec_id) AS n_links, c AS component_id, e.vec_id = c AS kept
FROM embeddings e JOIN least ON least.id = e.vec_id""",
    "op11_url_filter": f"""WITH u AS (SELECT page_id, {HOST} AS host, {PATH} AS path FROM pages),
rules AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(h, p, v)),
fit AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id),
listed AS (SELECT name || '.' || domain AS d FROM {LISTED_SQL}),
hit AS (SELECT page_id, max(d || '/') AS listed FROM u JOIN listed ON host = d OR ends_with(host, '.' || d) GROUP BY page_id)
SELECT u.page_id, host, path, rule, listed, coalesce(v, CASE WHEN listed IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM u LEFT JOIN fit USING (page_id) LEFT JOIN hit USING (page_id)""",
    "op12_prefix_trie": f"""WITH own AS (SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
    sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS ts FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
told AS (SELECT *, CAST({crc32('CAST(conv_id AS VARCHAR)')} % 6 AS BIGINT) AS h FROM own),
built AS (SELECT a.conv_id AS c, list_concat(coalesce(b.ts, [])[1:a.h], a.ts[a.h + 1:]) AS ts FROM told a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
met AS (SELECT c, unnest(range(0, len(ts) + 1)) AS d, ts FROM built),
nodes AS (SELECT ts[:d] AS node, d, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(CASE WHEN len(ts) = d THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '') AS ends
  FROM met GROUP BY ts[:d], d),
named AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n - 1) * length(node[d].t) END AS saved, sha256(ends) AS ends_sha256 FROM nodes),
kids AS (SELECT node[:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
below AS (SELECT node[:up] AS top, saved, leaf FROM (SELECT x.node, x.saved, k.node IS NULL AS leaf, unnest(range(0, x.d + 1)) AS up FROM named x LEFT JOIN kids k ON k.node = x.node)),
sums AS (SELECT top, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM below GROUP BY top)
SELECT x.conv_id, CAST(x.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(k.n_children, 0) AS n_children, n_leaves, saved_tokens, x.ends_sha256
FROM named x LEFT JOIN named p ON x.d > 0 AND p.node = x.node[:x.d - 1] AND p.d = x.d - 1 LEFT JOIN kids k ON k.node = x.node JOIN sums s ON s.top = x.node""",
    "op13_structure_repair": f"""WITH RECURSIVE filled AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind FROM conversations),
hurt AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  sha256(length(role) || ':' || role || text) AS was, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM filled WHERE kind <> 0),
placed AS (SELECT *, left(role, 1) AS initial, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, was, copy) AS seen, lead(left(role, 1)) OVER w AS following
  FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, was, copy)),
rows AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM placed),
told AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY conv_id),
one AS (SELECT conv_id, i, n, state, next, edit, cost, role, text FROM (
  SELECT r.*, made.state, made.state AS next, 'D' AS edit, 2 AS cost FROM rows r, {MADE} UNION ALL BY NAME
  SELECT r.* REPLACE (CASE next WHEN 2 THEN 'user' ELSE 'assistant' END AS role), made.state, next, 'R' AS edit, CASE fault WHEN '' THEN 1 ELSE 6 END AS cost
    FROM rows r, {MADE} WHERE fault IN ('', 'truncated') UNION ALL BY NAME
  SELECT r.*, fits.state, next, 'K' AS edit, CASE fault WHEN '' THEN 0 ELSE 5 END AS cost FROM rows r JOIN {FITS} ON r.initial = fits.initial WHERE fault IN ('', 'truncated'))),
chains AS (SELECT state AS origin, state, '' AS ins, '' AS said, 0 AS cost FROM {MADE} UNION ALL
  SELECT c.origin, made.next, c.ins || 'I', c.said || CASE made.next WHEN 2 THEN 'user:' ELSE 'assistant:' END || chr(10), c.cost + 5
  FROM chains c JOIN {MADE} ON made.state = c.state WHERE length(c.ins) < 3),
steps AS (SELECT conv_id, i, n, origin, next, ins || edit AS edits, c.cost + o.cost AS cost, said || CASE edit WHEN 'D' THEN '' ELSE role || ':' || text || chr(10) END AS said
  FROM one o JOIN chains c USING (state)),
walk AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, n, 0 AS state, 0 AS cost, '' AS audit, '' AS said FROM rows UNION ALL
  SELECT conv_id, i, n, state, cost, audit, said FROM (SELECT w.conv_id, s.i, w.n, s.next AS state, w.cost + s.cost AS cost, w.audit || s.edits AS audit, w.said || s.said AS said,
    row_number() OVER (PARTITION BY w.conv_id, s.next ORDER BY w.cost + s.cost, w.audit || s.edits) AS k
    FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 AND s.origin = w.state) WHERE k = 1),
ends AS (SELECT w.conv_id, w.cost + c.cost AS cost, audit || ins AS audit, w.said || c.said AS said, row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + c.cost, audit || ins) AS k
  FROM walk w JOIN chains c ON c.origin = w.state WHERE w.i = w.n AND c.state IN (0, 3)),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(b.cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(left(said, length(said) - 1), '')) AS repaired_sha256
FROM every e LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN (SELECT * FROM ends WHERE k = 1) b ON b.conv_id IS NOT DISTINCT FROM e.conv_id""",
}
