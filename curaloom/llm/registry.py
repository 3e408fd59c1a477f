"""All queries of this subpackage and their SQL, and the pipeline's."""

import corpus_pipeline
from curaloom.llm import queries_warc, queries_media, queries_lm, queries_chat, queries_mixing, queries_pii, queries_quality, queries_decontam, queries_dedup, queries_tokens

_MODULES = (queries_warc, queries_media, queries_lm, queries_chat, queries_mixing, queries_pii, queries_quality, queries_decontam, queries_dedup, queries_tokens)

QUERIES = {name: f for m in _MODULES for name, f in vars(m).items() if name.startswith("op")} | {"pipeline": corpus_pipeline.run}
ORACLE_SQL = {k: q for m in _MODULES for k, q in m.SQL.items()} | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
