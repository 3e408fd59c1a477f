"""Queries of the quality classifier."""

from curaloom.llm import quality
from curaloom.llm.runtime import table


def op7_quality_classifier(spark, sf_dir):
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL: dict[str, str] = {}
