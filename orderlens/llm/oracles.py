"""DuckDB SQL of the operators that SQL can express in full."""

#: A-Z in lower case, nothing else changed
_LOW = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS s
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
spot AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
         FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
hit AS (SELECT a.doc_id, a.p, a.k, win.item_id
        FROM (SELECT doc_id, p, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM spot) a
        JOIN win ON win.k = a.k AND win.s = a.s),
n AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS x FROM hit) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id"""

NEAR_DUP = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT doc_id, n, md5(string_agg(g, chr(10) ORDER BY g)) AS m FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
r AS (SELECT m, n, min(doc_id) AS rep FROM c GROUP BY m, n),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
      WHERE a.doc_id IN (SELECT rep FROM r) AND b.doc_id IN (SELECT rep FROM r) GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * x >= 85 * (na.n + nb.n - x)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(id, low) AS (SELECT rep, rep FROM r UNION SELECT e.b, reach.low FROM reach JOIN e ON e.a = reach.id),
k AS (SELECT id, min(low) AS low FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(k.low, d.doc_id) AS component_id,
  coalesce(k.low, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
LEFT JOIN r ON r.m = c.m AND r.n = c.n LEFT JOIN k ON k.id = r.rep"""

#: crc32: a table of 256 remainders of the polynomial 0xEDB88320, then one step per UTF-8 byte
VARIANTS = rf"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8), lambda c, k:
    CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END, b) AS c FROM range(256) x(b))),
runs AS (SELECT doc_id, r, count(*) AS n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || r)) AS x
         FROM (SELECT doc_id, unnest(regexp_extract_all({_LOW}, '[a-zÀ-ÿ]+')) AS r FROM documents)
         WHERE length(r) >= 7 GROUP BY ALL),
hashed AS (SELECT r, n, xor(4294967295, list_reduce(
    list_transform(range(0, length(x), 2), lambda i: CAST('0x' || substr(x, i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), 4294967295)) AS h FROM runs, tab),
words AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word,
            CAST(sum(n) AS BIGINT) AS n FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
holes AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS s
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.s = b.s AND a.word <> b.word
         UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.s
         UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.s),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS top, max(m) AS top_n FROM near GROUP BY word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * w.n THEN top END AS form,
            CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
path(word, root) AS (SELECT word, word FROM forms UNION ALL
  SELECT p.word, f.form FROM path p JOIN forms f ON f.word = p.root WHERE f.form IS NOT NULL),
roots AS (SELECT p.word, p.root FROM path p JOIN forms f ON f.word = p.root WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON r.word = f.word"""

EMBEDDINGS = r"""
WITH RECURSIVE v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (SELECT * FROM v WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
       AND len(list_filter(x, lambda c: c <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id < b.vec_id
      WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(id, low) AS (SELECT vec_id, vec_id FROM v UNION SELECT e.b, reach.low FROM reach JOIN e ON e.a = reach.id),
k AS (SELECT id, min(low) AS low FROM reach GROUP BY id),
n AS (SELECT a AS id, count(*) AS n FROM e GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, k.low AS component_id, k.low = v.vec_id AS kept
FROM v JOIN k ON k.id = v.vec_id LEFT JOIN n ON n.id = v.vec_id"""
