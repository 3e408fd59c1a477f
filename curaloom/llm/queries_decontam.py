"""Queries of benchmark decontamination."""

from curaloom.llm import decontam
from curaloom.llm.runtime import table


def op8_simhash_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Every start of every window of an item's length is weighed that holds any of the item's shingles; others have similarity 0.
SQL = {
    "op8_simhash_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w FROM benchmark),
i AS (SELECT item_id, w, len(w) AS n, least(5, len(w)) AS k FROM b WHERE len(w) > 0),
x AS (SELECT item_id, n, k, g, count(*) AS c FROM (SELECT item_id, n, k, unnest(list_transform(range(1, n - k + 2), lambda o: array_to_string(w[o:o + k - 1], ' '))) AS g FROM i) GROUP BY ALL),
z AS (SELECT DISTINCT k FROM i),
a AS (SELECT doc_id, len(w) AS total, k, p, array_to_string(w[p + 1:p + k], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM d JOIN z ON len(d.w) >= z.k)),
h AS (SELECT a.doc_id, x.item_id, a.p, a.g, x.c, least(x.n, a.total) - x.k + 1 AS m, x.n - x.k + 1 AS size, greatest(0, a.total - x.n) AS latest FROM a JOIN x ON a.g = x.g AND a.k = x.k),
s AS (SELECT doc_id, item_id, g, c, m + size AS both_sizes, unnest(range(greatest(0, p - m + 1), least(p, latest) + 1)) AS start FROM h),
v AS (SELECT doc_id, item_id, both_sizes, start, least(count(*), c) AS shared FROM s GROUP BY doc_id, item_id, g, c, both_sizes, start),
r AS (SELECT doc_id, item_id, start, both_sizes, sum(shared) AS common FROM v GROUP BY doc_id, item_id, start, both_sizes),
t AS (SELECT doc_id, item_id, common::DOUBLE / (both_sizes - common)::DOUBLE AS similarity, start FROM r WHERE 4 * common >= 3 * (both_sizes - common))
SELECT doc_id, item_id, similarity, start FROM t QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1
"""
}
