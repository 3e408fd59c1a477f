"""Queries of the personal-data operator."""

from curaloom.llm import pii
from curaloom.llm.runtime import table


def op5_pii_deobfuscation(spark, sf_dir):
    return pii.personal_data(table(spark, sf_dir, "documents"))


SQL: dict[str, str] = {}
