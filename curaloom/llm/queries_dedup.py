"""Queries of the near-duplicate operator."""

from curaloom.llm import neardup
from curaloom.llm.runtime import table


def op9_minhash_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


SQL = {
    "op9_minhash_neardup": r"""
WITH RECURSIVE
t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS g FROM t),
c AS (SELECT g, min(doc_id) AS id FROM (SELECT doc_id, list_sort(g) AS g FROM s WHERE len(g) > 0) GROUP BY g),
e AS (SELECT id, len(g) AS n, unnest(g) AS x FROM c),
p AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b ON a.x = b.x AND a.id < b.id AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
      GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT id, id AS c FROM c UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id WHERE r.c < l.b),
k AS (SELECT id, min(c) AS c FROM r GROUP BY id)
SELECT s.doc_id, len(s.g) AS n_shingles, coalesce(k.c, s.doc_id) AS component_id, coalesce(k.c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.g = list_sort(s.g) AND len(s.g) > 0 LEFT JOIN k ON k.id = c.id
"""
}
