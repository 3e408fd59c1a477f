"""Queries of the token counts."""

from curaloom.llm import token_counts
from curaloom.llm.runtime import table


def op10_token_histogram(spark, sf_dir):
    return token_counts.histogram(token_counts.lengths(table(spark, sf_dir, "documents")))


SQL: dict[str, str] = {}
