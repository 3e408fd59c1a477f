"""The whole dataset build: read, clean, verify, split, negatives, replay."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.operators import clean, similar, splitting, verify
from curaloom.sources import pairs, records
from curaloom.storage import written


@dataclass
class Prepared:
    """Records with split, and every input row's drop reason."""

    records: DataFrame
    judged: DataFrame


def built(raw: DataFrame, prep: c.PrepConfig = c.PrepConfig(), harness: c.HarnessConfig = c.HarnessConfig(), replay: DataFrame | None = None, rules: str | None = None) -> Prepared:
    """From raw pairs to records; tools run on what the cheap filters keep."""
    judged = written(clean.judged(raw, prep.max_chars), "judged")
    checked = written(verify.verified(clean.kept(judged), prep, harness, rules), "checked")
    judged = judged.where("drop_reason is not null").unionByName(checked)
    kept = clean.kept(checked)
    groups = similar.clusters(kept.select(F.col("ord").alias("id"), F.col("vulnerable_code").alias("text")), prep.near_dup_jaccard)
    placed = splitting.split(groups, prep.seed, prep.fractions).select(F.col("id").alias("ord"), "split")
    rows = written(kept.join(placed, "ord"), "placed")
    out = splitting.triplets(splitting.negatives(rows, prep.negatives_frac, prep.seed + 1))
    if replay is not None:
        out = splitting.with_replay(out, replay, prep.replay_frac, prep.seed + 1)
    return Prepared(out, judged)


def prepare(spark: SparkSession, raw_dir: str, out_dir: str, reader: str = "auto", replay_file: str | None = None, prep: c.PrepConfig | None = None, harness: c.HarnessConfig | None = None, rules: str | None = None) -> dict:
    """built over files, written to out_dir; returns the stats with drops and added rows."""
    raw = written(pairs.read_pairs(spark, raw_dir, reader), "raw")
    if raw.isEmpty():
        raise ValueError(f"no input pairs in {raw_dir}")
    replay = records.replay_records(spark, replay_file) if replay_file else None
    done = built(raw, prep or c.PrepConfig.from_env(), harness or c.HarnessConfig.from_env(), replay, rules)
    drops = {r["drop_reason"]: r["n"] for r in clean.drop_counts(done.judged).collect()}
    rows = written(done.records, "records")
    if rows.isEmpty():
        raise ValueError(f"all pairs were dropped during cleaning: {drops}")
    stats = records.write_splits(rows, out_dir)
    added = rows.agg(F.count_if(F.col("kind") == "no_change").alias("negatives_added"), F.count_if(F.col("kind") == "replay").alias("replay_added")).first().asDict()
    return stats | {"drops": drops} | added
