"""Queries of the mixing operator."""

from curaloom.llm import mixing
from curaloom.llm.runtime import table


def op4_source_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents"))


SQL = {
    "op4_source_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(concat('1:', doc_id)) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, source_size * 2 AS most, (sum(source_size) OVER ())::DOUBLE * 1.5 AS total FROM s),
o AS (SELECT *, coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS before,
             (sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS left_w FROM w),
f AS (SELECT *, most::DOUBLE * left_w <= weight * (total - before) AS is_full FROM o),
t AS (SELECT source, source_size, CASE WHEN is_full THEN most::DOUBLE
        ELSE weight * (total - coalesce(sum(most) FILTER (is_full) OVER (), 0)::DOUBLE) / (sum(weight) FILTER (NOT is_full) OVER ())::DOUBLE END AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, floor(e.target)::BIGINT - e.epochs * e.source_size AS rest,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS ahead
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(rest - ahead, size)))::BIGINT AS taken FROM p
"""
}
