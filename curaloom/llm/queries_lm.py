"""Queries of language-model scoring."""

from curaloom.llm import lm_scoring
from curaloom.llm.runtime import table


def op3_deleted_interpolation(spark, sf_dir):
    return lm_scoring.scores(table(spark, sf_dir, "documents"))


SQL: dict[str, str] = {}
