"""Near-duplicates by a set-similarity join on shingles with prefix, position and length filters, and their clusters.

Shingles travel as 64-bit hashes; that two different ones of a pair of 10,000 shingles each agree has a chance of
one in 10^11. Everything else is exact.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curaloom.functions import text as t
from curaloom.operators.components import components
from curaloom.storage import written


def shingled(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """classes (rep, grams, n) of equal shingle sets, grams as sorted hashes, and members (id, rep) of rows (id, text); both written."""
    grams = F.sort_array(t.shingle_hashes(F.coalesce("text", F.lit(""))))
    sets = rows.select("id", t.bound(grams, lambda g: F.struct(F.xxhash64(g).alias("k"), F.xxhash64(F.lit("again"), g).alias("l"), g.alias("grams"))).alias("s"))
    sets = written(sets.select("id", "s.k", "s.l", "s.grams"), "shingles")
    reps = sets.groupBy("k", "l").agg(F.min("id").alias("rep"))
    members = written(sets.select("id", "k", "l").join(reps, ["k", "l"]).select("id", "rep"), "members")
    firsts = members.where("id = rep").select("id")
    classes = sets.join(firsts, "id", "left_semi").select(F.col("id").alias("rep"), "grams", F.size("grams").alias("n"))
    return written(classes, "classes"), members


def similar_classes(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of class pairs a < b at or above the threshold, which must be above 0.

    The shingles of a class stand in order of rarity; its prefix are, of n, all but the last ceil(threshold * n) - 1.
    Two sets that are similar enough share a shingle of both prefixes. At the first one that they share, no more
    shingles can be common than remain in either, so only pairs for which these are enough are verified.
    Shingles of one class only need no place of their own: they come first, and their number is known.
    The join's key holds a band of lengths, too; sets of similar lengths lie in the same or the next band.
    """
    grams = classes.select("rep", "n", F.explode_outer("grams").alias("gram"))
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = grams.join(common, "gram")
    mine = Window.partitionBy("rep")
    shared = shared.withColumn("later", F.row_number().over(mine.orderBy("df", "gram"))).withColumn("m", F.count(F.lit(1)).over(mine))
    rank = F.col("n") - F.col("m") + F.col("later")
    prefix = shared.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    band = F.floor(F.log(F.col("n").cast("double")) / max(1e-9, -math.log(min(threshold, 1 - 1e-9))) + 1e-9)
    prefix = written(prefix.select("rep", "n", "gram", "rank", band.alias("band")), "prefixes")
    # the shorter set, or of equal ones the one of the smaller id, joins its own band and the one above
    left = prefix.select(F.col("rep").alias("x"), F.col("n").alias("nx"), F.col("rank").alias("i"), "gram", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    right = prefix.select(F.col("rep").alias("y"), F.col("n").alias("ny"), F.col("rank").alias("j"), "gram", "band")
    close = (F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y")))
    close &= F.col("nx") >= F.col("ny") * threshold - 1e-9
    enough = 1 + F.least(F.col("nx") - F.col("i"), F.col("ny") - F.col("j")) >= (F.col("nx") + F.col("ny")) * (threshold / (1 + threshold)) - 1e-9
    pairs = left.join(right, ["gram", "band"]).where(close & enough)
    pairs = pairs.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count(F.lit(1)).alias("shared")).select("a", "b")
    sides = pairs.join(classes.select(F.col("rep").alias("a"), F.col("grams").alias("x")), "a").join(classes.select(F.col("rep").alias("b"), F.col("grams").alias("y")), "b")
    scored = sides.select("a", "b", t.jaccard(F.col("x"), F.col("y")).alias("similarity"))
    return written(scored.where(F.col("similarity") >= threshold), "similar")


def clusters(rows: DataFrame, threshold: float = 0.85) -> DataFrame:
    """id, cluster_id for every row of (id, text): the smallest id that similar texts connect it with."""
    classes, members = shingled(rows)
    roots = components(similar_classes(classes, threshold).select("a", "b"))
    return members.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").select("id", F.coalesce("root", "rep").alias("cluster_id"))
