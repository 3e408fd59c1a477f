"""The cleaning funnel: one drop reason per row, first copy wins.

Pairs are rows of vulnerable_code, fixed_code, cwe, source_id, kind and ord, a unique number that stands
for the input order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.functions import text as t
from curaloom.storage import written


def decided(pairs: DataFrame, max_chars: int = 6000) -> DataFrame:
    """(ord, cwe, drop_reason) of every row: the canonical cwe and the reason, null to keep.

    A row is a duplicate if an earlier row of its fingerprint fits the cap; a too long first copy doesn't
    shadow a later one. Texts are looked at once: what is decided on is a narrow written table. Only
    fingerprints that occur more than once are looked up, so a group of copies costs a partial aggregate
    and a join that can be split, never a task of its own.
    """
    v, f = (F.coalesce(x, F.lit("")) for x in ("vulnerable_code", "fixed_code"))
    label = t.cwe_label(F.col("cwe"))
    early = F.when(label.isNull(), "cwe_out_of_scope").when((t.strip(v) == "") | (t.strip(f) == ""), "empty")
    long = F.coalesce(t.prompt_chars(v, label, f) > max_chars, F.lit(False))
    rows = pairs.select("ord", F.coalesce(label, "cwe").alias("cwe"), early.alias("early"), long.alias("long"), F.when(early.isNull(), t.fingerprint(v, f)).alias("print"))
    rows = written(rows, "prints")
    copies = rows.where("print is not null").groupBy("print").agg(F.min(F.when(~F.col("long"), F.col("ord"))).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = rows.join(copies.select("print", "first"), "print", "left")
    reason = F.coalesce("early", F.when(F.col("first") < F.col("ord"), "duplicate").when(F.col("long"), "too_long"))
    return rows.select("ord", "cwe", reason.alias("drop_reason"))


def judged(pairs: DataFrame, max_chars: int = 6000) -> DataFrame:
    """pairs with the canonical cwe and drop_reason (null: kept), before any external tool."""
    reasons = decided(pairs, max_chars)
    texts = {x: F.coalesce(pairs[x], F.lit("")).alias(x) for x in ("vulnerable_code", "fixed_code")}
    rows = pairs.join(reasons, pairs["ord"] == reasons["ord"])
    return rows.select(*(reasons["cwe"] if x == "cwe" else texts.get(x, pairs[x]) for x in pairs.columns), "drop_reason")


def kept(judgement: DataFrame) -> DataFrame:
    return judgement.where("drop_reason is null").drop("drop_reason")


def drop_counts(judgement: DataFrame) -> DataFrame:
    """drop_reason, n for every known reason, zeros included."""
    spark = judgement.sparkSession
    counts = judgement.where("drop_reason is not null").groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))
    known = spark.createDataFrame([(r,) for r in c.DROP_REASONS], "drop_reason string")
    return known.join(counts, "drop_reason", "left").select("drop_reason", F.coalesce("n", F.lit(0)).alias("n"))
