"""Mixing sources to target weights.

Every document gets a hash-random key; within a source the keys are range-sorted. The leading digits of
the key split the range into buckets of even size, however large the source; bucket totals give each
bucket's offset and a running sum within the bucket does the rest: a distributed prefix sum. A source is
cut at its exact budget of words; budgets above its size repeat it, the same order in every epoch.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curaloom.llm import runtime

WEIGHTS = (5, 2, 1)
SHARE, MOST_EPOCHS, SEED = 1.5, 2, 1

_SPACE = r"[\x20\x09-\x0D]+"
_EDGES = " \t\n\x0b\x0c\r"
#: Repeated rows are written out by so many at a time.
_BLOCK = 65_536


def _trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(_EDGES))


def n_words(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.when(_trimmed(text) == "", F.lit(0)).otherwise(F.size(F.split(_trimmed(text), _SPACE))).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The first n words, joined by one space."""
    return F.array_join(F.slice(F.split(_trimmed(text), _SPACE), F.lit(1), n.cast("int")), " ")


def random_key(doc_id: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sizes: DataFrame) -> DataFrame:
    """source and source_size to target: the share by weight, the excess over the cap reshared by weight until none is left.

    In order of cap / weight the capped sources come first, so running sums over this order find them.
    A null source takes its weight as the last one; a source of size 0 gets 0. No sources give no rows.
    One row a source; the windows run over these only, in one task.
    """
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * MOST_EPOCHS)
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("total", F.sum("source_size").over(every) * SHARE)
    rows = rows.withColumn("before", F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("most"))
    rows = rows.withColumn("left", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("full", F.col("most").cast("double") * F.col("left") <= F.col("weight") * (F.col("total") - F.col("before")))
    held = F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(every), F.lit(0))
    free = F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(every), F.lit(1))
    share = F.col("weight") * (F.col("total") - held) / free
    return rows.select("source", "source_size", F.when(F.col("full"), F.col("most").cast("double")).otherwise(share).alias("target"))


def _ranked(docs: DataFrame) -> DataFrame:
    """One narrow row per source, id and size: doc_id, source, size, source_size, target, epochs, rest, key, n, before.

    n rows agree in these; before is the number of words ahead of the first of them. Rows of one id thus never
    make a hot key: a bucket holds at most one row for every size that occurs.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    sized = runtime.written(sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("part")
    rows = sized.select("doc_id", "size", "n", named, random_key(F.col("doc_id")).alias("key"))
    digits = max(1, math.ceil(math.log(max(1.0, math.sqrt(sized.count())), 16)))
    rows = rows.withColumn("bucket", F.substring("key", 1, digits))
    totals = rows.groupBy("part", "bucket").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    ahead = Window.partitionBy("part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = totals.select("part", "bucket", (F.sum("words").over(ahead) - F.col("words")).alias("offset"))
    plan = targets(sized.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0))
    plan = plan.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    plan = plan.select(named, "source", "source_size", "target", "epochs", "rest")
    offsets = offsets.join(plan, "part")
    inside = Window.partitionBy("part", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(offsets, ["part", "bucket"])
    words = F.col("size") * F.col("n")
    return rows.withColumn("before", F.col("offset") + F.sum(words).over(inside) - words)


def _repeated(rows: DataFrame, times: str) -> DataFrame:
    """Every row as often as its column times says, by blocks, so that no array grows with it."""
    blocks = rows.where(F.col(times) > 0).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / _BLOCK))))
    inside = F.least(F.lit(_BLOCK), F.col(times) - F.col("block") * _BLOCK)
    return blocks.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), inside))).select(*rows.columns)


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs (doc_id, source, text).

    A null source is a source of its own, the last; a null or empty text has size 0 and is never taken.
    Rows that repeat an id sort by size and count each for itself. Empty tables give an empty mix.
    """
    room = F.greatest(F.lit(0).cast("long"), F.col("rest") - F.col("before"))
    whole = F.when(F.col("size") > 0, F.least(F.col("n"), F.floor(room / F.greatest(F.col("size"), F.lit(1))))).otherwise(F.lit(0)).cast("long")
    rows = _ranked(docs).withColumn("room", room).withColumn("whole", whole)
    part = F.when((F.col("whole") < F.col("n")) & (F.col("size") > 0), F.col("room") - F.col("whole") * F.col("size")).otherwise(F.lit(0)).cast("long")
    cut = F.when(F.col("whole") < F.col("n"), F.lit(1)).otherwise(F.lit(0)).cast("long")
    kinds = F.array(
        F.struct(F.col("size").alias("last"), F.col("whole").alias("times")),
        F.struct(part.alias("last"), cut.alias("times")),
        F.struct(F.lit(0).cast("long").alias("last"), (F.col("n") - F.col("whole") - cut).alias("times")),
    )
    rows = rows.select("doc_id", "size", "source_size", "target", "epochs", F.explode(kinds).alias("k"))
    rows = rows.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("k.last")).cast("long").alias("taken"), F.col("k.times").alias("times"))
    return _repeated(rows, "times").select("doc_id", "size", "source_size", "target", "taken")


def _ordinals(rows: DataFrame, part: str) -> DataFrame:
    """rows as a written table with ordinal, each row's place from 1 in its part, by the order of that table.

    Counts of the table's partitions give each partition's offset, so that a part of any size is numbered by many tasks.
    """
    rows = runtime.written(rows, "ties").withColumn("at", F.spark_partition_id()).withColumn("line", F.monotonically_increasing_id())
    counts = rows.groupBy(F.col(part).alias("part"), F.col("at").alias("chunk")).agg(F.count(F.lit(1)).alias("m"))
    ahead = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.select("part", "chunk", (F.sum("m").over(ahead) - F.col("m")).alias("offset"))
    numbered = rows.withColumn("place", F.row_number().over(Window.partitionBy(part, "at").orderBy("line")))
    joined = numbered.join(counts, (F.col(part) == F.col("part")) & (F.col("at") == F.col("chunk")))
    return joined.withColumn("ordinal", F.col("offset") + F.col("place")).drop("part", "chunk", "offset", "place", "line", "at")


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of docs once for each epoch that takes them, with epoch (from 1) and taken words,
    which replace columns of these names.

    The document at a source's cut keeps its first words, joined by a space; its n_chars, if there, follows.
    Texts are not shuffled: one row a source says where its order is cut. Only where several rows that agree in
    id and size lie at the cut are those written, and numbered in the order of that table, to take as many as fit.
    """
    ranked = _ranked(docs)
    at_cut = F.struct("key", F.coalesce("doc_id", F.lit(-(2**63))).alias("id"), "size", "before", "n")
    over = F.col("before") + F.col("size") * F.col("n") > F.col("rest")
    cuts = ranked.groupBy("part").agg(F.min(F.when(over, at_cut)).alias("cut"), F.first("epochs").alias("epochs"), F.first("rest").alias("rest"))
    cuts = runtime.written(cuts, "cuts")
    ties = not cuts.where("cut.n > 1 and rest > 0").isEmpty()
    if cuts.count() <= 100_000:  # one row a source
        cuts = F.broadcast(cuts)

    def given(name: str) -> Column:
        return F.col(f"row.`{name}`")

    # the columns of docs travel in one struct, so that no name clashes
    rows = docs.select(F.struct(*(F.col(f"`{x}`") for x in docs.columns)).alias("row"))
    rows = rows.withColumn("mine_part", F.coalesce(F.concat(F.lit("="), given("source").cast("string")), F.lit(""))).join(cuts, F.col("mine_part") == F.col("part")).drop("part")
    size = n_words(given("text"))
    mine = F.struct(random_key(given("doc_id")).alias("key"), F.coalesce(given("doc_id").cast("long"), F.lit(-(2**63))).alias("id"), size.alias("size"))
    rows = rows.withColumn("mine", mine)
    cut = F.struct(F.col("cut.key").alias("key"), F.col("cut.id").alias("id"), F.col("cut.size").alias("size"))
    at = F.coalesce(F.col("mine") == cut, F.lit(False))
    rows = rows.withColumn("size", F.col("mine.size"))
    tied = at & (F.col("cut.n") > 1) & (F.col("rest") > 0)
    room = F.col("rest") - F.col("cut.before")
    none = F.lit(0).cast("long")
    last = F.when(F.col("cut").isNull() | (F.col("mine") < cut), F.col("size")).when(at, F.greatest(none, room)).otherwise(none)
    once = rows.where(~tied) if ties else rows
    once = once.select("row", "size", "epochs", F.when(F.col("rest") > 0, last).otherwise(none).alias("last"))
    if ties:
        several = _ordinals(rows.where(tied).select("row", "size", "epochs", room.alias("room"), "mine_part"), "mine_part")
        left = F.col("room") - (F.col("ordinal") - 1) * F.col("size")
        once = once.unionByName(several.select("row", "size", "epochs", F.greatest(none, F.least(left, F.col("size"))).alias("last")))
    parts = F.concat(F.array_repeat(F.col("size"), F.col("epochs").cast("int")), F.array(F.col("last")))
    out = once.select("row", "size", F.posexplode_outer(parts).alias("turn", "take")).where("take > 0")
    text = F.when(F.col("take") < F.col("size"), first_words(given("text"), F.col("take"))).otherwise(given("text"))
    new = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    columns = [x for x in docs.columns if x not in ("epoch", "taken")]
    return out.select(*(new.get(x, given(x).alias(x)) for x in columns), (F.col("turn") + 1).alias("epoch"), F.col("take").alias("taken"))
