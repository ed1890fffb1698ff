"""DuckDB SQL for the queries that SQL can express on whole tables."""

JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT gram FROM g GROUP BY gram HAVING count(*) > 1),
c AS (SELECT g.* FROM g SEMI JOIN common USING (gram)),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM c a JOIN c b ON a.gram = b.gram AND a.doc_id <> b.doc_id
         GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(id, r) AS (SELECT a, b FROM links UNION SELECT id, links.b FROM reach JOIN links ON links.a = r),
top AS (SELECT id, min(r) AS r FROM reach GROUP BY id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(top.r, doc_id)) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN top ON top.id = doc_id"""

TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))
  AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""

MERKLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
    list_reduce(range(0, 8 * strlen(CAST(doc_id AS VARCHAR))), lambda c, i: CASE WHEN (CASE WHEN i % 8 = 0
      THEN xor(c, ord(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS INTEGER), 1))) ELSE c END) % 2 = 1
      THEN xor((CASE WHEN i % 8 = 0 THEN xor(c, ord(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS INTEGER), 1))) ELSE c END) >> 1, 3988292384)
      ELSE (CASE WHEN i % 8 = 0 THEN xor(c, ord(substr(CAST(doc_id AS VARCHAR), CAST(i // 8 + 1 AS INTEGER), 1))) ELSE c END) >> 1 END,
      CAST(4294967295 AS BIGINT)) AS c,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail FROM documents),
l AS (SELECT doc_id, tree, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS other,
    coalesce(xor(c, 4294967295) % 7 = 0, false) AS tampered FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
t(tree, lvl, idx, digest) AS (SELECT tree, 0, pos, leaf FROM p UNION ALL
  SELECT tree, lvl + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM
    (SELECT *, count(*) OVER (PARTITION BY tree) AS m FROM t) WHERE m > 1 GROUP BY tree, lvl, idx // 2),
top AS (SELECT tree, max(lvl) AS h, arg_max(digest, lvl) AS subroot FROM t GROUP BY tree),
u(lvl, idx, digest) AS (SELECT 0, row_number() OVER (ORDER BY tree) - 1, subroot FROM top UNION ALL
  SELECT lvl + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM
    (SELECT *, count(*) OVER () AS m FROM u) WHERE m > 1 GROUP BY lvl, idx // 2),
r AS (SELECT max(lvl) AS h, arg_max(digest, lvl) AS root FROM u),
ranked AS (SELECT tree, h, subroot, row_number() OVER (ORDER BY tree) - 1 AS pos FROM top),
path AS (
  SELECT tree, pos, lvl, CAST(pos >> lvl AS BIGINT) AS idx FROM (SELECT p.tree, p.pos, unnest(range(0, h)) AS lvl FROM p JOIN top USING (tree))),
steps AS (SELECT a.tree, a.pos, list(CASE WHEN s.digest IS NULL THEN '' WHEN a.idx % 2 = 1 THEN 'L' || s.digest ELSE 'R' || s.digest END
    ORDER BY a.lvl) AS steps FROM path a LEFT JOIN t s ON s.tree = a.tree AND s.lvl = a.lvl AND s.idx = xor(a.idx, CAST(1 AS BIGINT)) GROUP BY a.tree, a.pos),
upath AS (SELECT tree, lvl, CAST(pos >> lvl AS BIGINT) AS idx FROM (SELECT ranked.tree, ranked.pos, unnest(range(0, r.h)) AS lvl FROM ranked, r)),
usteps AS (SELECT a.tree, list(CASE WHEN s.digest IS NULL THEN '' WHEN a.idx % 2 = 1 THEN 'L' || s.digest ELSE 'R' || s.digest END
    ORDER BY a.lvl) AS steps FROM upath a LEFT JOIN u s ON s.lvl = a.lvl AND s.idx = xor(a.idx, CAST(1 AS BIGINT)) GROUP BY a.tree),
f AS (SELECT p.doc_id, p.leaf, ranked.subroot, r.root,
    list_concat(coalesce(steps.steps, CAST([] AS VARCHAR[])), coalesce(usteps.steps, CAST([] AS VARCHAR[]))) AS steps,
    CASE WHEN tampered THEN other ELSE leaf END AS given
  FROM p JOIN ranked USING (tree) CROSS JOIN r LEFT JOIN steps ON steps.tree = p.tree AND steps.pos = p.pos
  LEFT JOIN usteps ON usteps.tree = p.tree),
g AS (SELECT *, list_reduce(steps, lambda d, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || d ELSE d || s[2:] END), given) AS folded_root FROM f)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(list_concat([''], steps), lambda s: s[2:]), 'string_agg', '')) AS proof_sha256,
  folded_root, folded_root = root AS verified FROM g"""

FIM = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
k AS (SELECT *, len(u) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
    CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM h),
c AS (SELECT doc_id, text, n, u, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE text END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
