"""Queries of the media operator."""

from curaloom.llm import ogg
from curaloom.llm.runtime import table, written


def op2_ogg_media(spark, sf_dir):
    return ogg.media_features(written(ogg.media_column(table(spark, sf_dir, "documents")), "media"))


SQL: dict[str, str] = {}
