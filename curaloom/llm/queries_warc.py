"""Queries of the WARC operator."""

from curaloom.llm import warc
from curaloom.llm.runtime import table


def op1_warc_archives(spark, sf_dir):
    return warc.summary(warc.read_archives(warc.write_archives(table(spark, sf_dir, "pages"))))


SQL = {
    "op1_warc_archives": """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p),
r AS (SELECT *, payload_bytes >= 100 AND first IS NOT NULL AND page_id IS DISTINCT FROM first AS again FROM m)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM r
"""
}
