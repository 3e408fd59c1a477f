"""Queries of chat formatting."""

from curaloom.llm import chat
from curaloom.llm.runtime import table

#: A text that holds every control string of common templates.
TRAP = r"\### Assistant: </turn> ok"


def op6_chat_fingerprint_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-7, 0, "user", TRAP), (-7, 1, "assistant", TRAP)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.formatted(chat.records(rows.unionByName(trap))))


SQL = {
    "op6_chat_fingerprint_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(role) + (CASE WHEN role IN ('system', 'user', 'assistant') THEN 0 ELSE 1 + len(regexp_extract_all(role, '\\|###|</turn>|:')) END)
           + 2 + length(text) + len(regexp_extract_all(text, '\\|###|</turn>')) + 8)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
}
