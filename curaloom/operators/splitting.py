"""Leakage-safe splits, negatives and replay.

Random order is the order of a hash of seed and key, so every run, partitioning and engine agrees on it.
Ranks within large groups are prefix sums over buckets of the hash's leading digits.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curaloom import config as c
from curaloom.storage import written


def hash_key(seed: int, *keys: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def ranked(rows: DataFrame, group: list[str], key: str, tie: list[str], weight: str | None = None) -> DataFrame:
    """rows with rank: each row's place, from 1, in its group by the hexadecimal key, then tie.

    With weight, a column of numbers of equal rows, rank is the place of the last of them. rows should be
    narrow: they are written, and their number sets how many buckets share the work.
    """
    rows = written(rows, "ranked")
    digits = max(1, math.ceil(math.log(max(1.0, math.sqrt(rows.count())), 16)))
    rows = rows.withColumn("_bucket", F.substring(key, 1, digits))
    each = F.col(weight) if weight else F.lit(1)
    totals = rows.groupBy(*group, "_bucket").agg(F.sum(each).alias("_size"))
    ahead = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = totals.select(*group, "_bucket", (F.sum("_size").over(ahead) - F.col("_size")).alias("_offset"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(key, *tie).rowsBetween(Window.unboundedPreceding, 0)
    return rows.join(offsets, [*group, "_bucket"]).withColumn("rank", F.col("_offset") + F.sum(each).over(inside)).drop("_bucket", "_offset")


def _shares(deficits: list[int], size: int, count: int) -> list[int]:
    """How many of count clusters of equal size each split gets if one after the other goes to the largest deficit, ties to the first.

    Those are the count largest of the values deficit - j * size; a search for the level that cuts them off
    replaces the one by one walk.
    """
    above = lambda level: [max(0, -((level - d) // size)) if d > level else 0 for d in deficits]  # noqa: E731  values > level
    low, high = min(deficits) - size * (count + 1), max(deficits)
    while low < high:
        middle = (low + high) // 2
        if sum(above(middle)) <= count:
            high = middle
        else:
            low = middle + 1
    out = above(low)
    left = count - sum(out)
    for i, d in enumerate(deficits):  # the values equal to the level, in order of the splits
        if left and (d - low) % size == 0 and d >= low:
            out[i] += 1
            left -= 1
    return out


def plan(sizes: dict[int, int], fractions: tuple = (0.8, 0.1, 0.1)) -> list[tuple[int, int, int, str]]:
    """(size, first rank, last rank, split) of the clusters, from the number of clusters of each size.

    With three clusters or more the smallest goes to test and the next to val, ranks 1 and 2 of the
    smallest sizes; the others go by size, largest first, to the split with the largest remaining deficit.
    """
    exact = [Fraction(str(x)) for x in fractions]
    scale = math.lcm(*(x.denominator for x in exact))
    total = sum(s * n for s, n in sizes.items())
    deficits = [int(x * scale * total) for x in exact]
    first = dict.fromkeys(sizes, 0)
    out = []
    if sum(sizes.values()) >= 3:
        for split in ("test", "val"):
            size = min(s for s, n in sizes.items() if n > first[s])
            first[size] += 1
            out.append((size, first[size], first[size], split))
            deficits[c.SPLITS.index(split)] -= size * scale
    for size in sorted(sizes, reverse=True):
        at = first[size]
        for i, n in enumerate(_shares(deficits, size * scale, sizes[size] - at)):
            if n:
                out.append((size, at + 1, at + n, c.SPLITS[i]))
                deficits[i] -= n * size * scale
                at += n
    return out


def split(members: DataFrame, seed: int = 42, fractions: tuple = (0.8, 0.1, 0.1)) -> DataFrame:
    """id, cluster_id, split for (id, cluster_id): whole clusters, close to the fractions.

    Only the histogram of cluster sizes reaches the driver.
    """
    groups = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    groups = written(groups.withColumn("key", hash_key(seed, F.col("cluster_id"))), "groups")
    sizes = {r["size"]: r["n"] for r in groups.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return members.select("id", "cluster_id", F.lit(None).cast("string").alias("split"))
    ranges = members.sparkSession.createDataFrame(plan(sizes, fractions), "size long, low long, high long, split string")  # five rows a size at most
    placed = ranked(groups.select("cluster_id", "size", "key"), ["size"], "key", ["cluster_id"])
    placed = placed.join(F.broadcast(ranges), "size").where(F.col("rank").between(F.col("low"), F.col("high")))
    return members.join(placed.select("cluster_id", "split"), "cluster_id").select("id", "cluster_id", "split")


def negatives(rows: DataFrame, fraction: float = 0.10, seed: int = 43) -> DataFrame:
    """rows (pairs with split) and the negatives drawn from each split: the fixed side on both, kind no_change.

    Of n rows max(1, round(n * fraction)) are drawn, halves to even, n at most; with a fraction of 0 none.
    """
    if fraction <= 0:
        return rows
    quota = rows.groupBy("split").agg(F.count(F.lit(1)).alias("_n")).select("split", F.least("_n", F.greatest(F.lit(1), F.bround(F.col("_n") * fraction, 0).cast("long"))).alias("_quota"))
    keyed = rows.withColumn("_key", hash_key(seed, F.col("source_id")))
    drawn = ranked(keyed.select("split", "source_id", "_key", "ord"), ["split"], "_key", ["source_id", "ord"]).join(F.broadcast(quota), "split").where("rank <= _quota")
    chosen = rows.join(drawn.select("ord"), "ord", "left_semi")
    made = chosen.withColumn("vulnerable_code", F.col("fixed_code")).withColumn("kind", F.lit("no_change")).withColumn("source_id", F.concat("source_id", F.lit("#neg")))
    return rows.unionByName(made.select(*rows.columns))


def with_replay(records: DataFrame, replay: DataFrame, fraction: float = 0.15, seed: int = 43) -> DataFrame:
    """records (with split) and, in train only, at most int(train rows * fraction) replay records.

    The ids of the pool go in hash order, each with all its rows; of the id at the cap, those rows go that a hash
    of their contents puts first. So the cap holds for repeated ids and rows, too.
    """
    cap = records.where("split = 'train'").agg(F.floor(F.count(F.lit(1)) * F.lit(fraction)).alias("cap")).first()["cap"]
    pool = written(replay, "pool")
    ids = pool.groupBy("source_id").agg(F.count(F.lit(1)).alias("n")).withColumn("_key", hash_key(seed, F.col("source_id"))).withColumn("_all", F.lit(1))
    places = written(ranked(ids.select("_all", "source_id", "_key", "n"), ["_all"], "_key", ["source_id"], "n").select("source_id", "n", "rank"), "places")
    whole = places.where(F.col("rank") <= cap).select(F.col("source_id").alias("_id"))
    chosen = pool.join(whole, pool["source_id"].eqNullSafe(whole["_id"]), "left_semi")
    cut = places.where((F.col("rank") > cap) & (F.col("rank") - F.col("n") < cap)).first()  # at most one id
    if cut:
        mine = pool.where(F.col("source_id").eqNullSafe(F.lit(cut["source_id"])))
        contents = F.sha2(F.to_json(F.struct(*pool.columns)), 256)
        chosen = chosen.unionByName(mine.orderBy(contents).limit(cap - (cut["rank"] - cut["n"])))
    return records.unionByName(chosen.withColumn("split", F.lit("train")).select(*records.columns))


def leaks(rows: DataFrame) -> DataFrame:
    """Negatives whose source isn't in their split; empty if the invariant holds."""
    source = rows.where("kind = 'fix'").select(F.concat("source_id", F.lit("#neg")).alias("source_id"), "split")
    return rows.where("kind = 'no_change'").join(source, ["source_id", "split"], "left_anti")


def split_stats(records: DataFrame) -> DataFrame:
    """split, total, no_change, replay and a column for every cwe that occurs, absent ones 0."""
    wide = records.groupBy("split").pivot("cwe").agg(F.count(F.lit(1))).na.fill(0)
    tall = records.groupBy("split").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("kind") == "no_change").alias("no_change"), F.count_if(F.col("kind") == "replay").alias("replay"))
    return tall.join(wide, "split")


def triplets(rows: DataFrame) -> DataFrame:
    """Instruction records of pairs: system, input, output, cwe, vulnerable_code, source_id, kind, and split if there."""
    from curaloom.functions import text as t

    extra = [x for x in ("split",) if x in rows.columns]
    return rows.select(F.lit(c.SYSTEM_PROMPT).alias("system"), t.user_prompt(F.col("vulnerable_code"), F.col("cwe")).alias("input"), t.fenced(F.col("fixed_code")).alias("output"), "cwe", "vulnerable_code", "source_id", "kind", *extra)
