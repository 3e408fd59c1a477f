"""Benchmark decontamination with DataFrame operations only.

Windows as long as a benchmark item are fingerprinted by SimHash (64 bits over the window's words,
weighted by how often they occur). Multi-index Hamming blocks find every item whose fingerprint is
within RADIUS: with BLOCKS blocks, one of them differs in at most RADIUS // BLOCKS bits, and the item
side is indexed under all values that near. Candidates are verified by the exact weighted Jaccard
similarity of the shingles (weight: number of occurrences) at every start, whatever the order of the words.

Shingles have five words. An item of fewer has its whole sequence as one shingle, as has a window of its length.

Which windows need a fingerprint: bags of m and M shingles with a similarity of at least 3/4 share at
least 3/7 * (m + M). So many positions of the window must hold a shingle that some item of that length has;
their running count rules out all other windows, and none that the verification would pass. Documents are
first scanned at every third position: a bag of equal size shares 6/7 of its shingles, so one such position
at least is a hit (with items of under seven words: every position).
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaloom.llm import runtime

WIDTH, NUMERATOR, DENOMINATOR = 5, 3, 4
RADIUS, BLOCKS = 23, 8
#: The items' shingles and the ids of documents to look at are broadcast up to so many rows; beyond, joins shuffle.
BROADCAST_ROWS = 1_000_000

_SPACE = r"[\x20\x09-\x0D]+"
_EDGES = " \t\n\x0b\x0c\r"
_BITS = [range(b * 64 // BLOCKS, (b + 1) * 64 // BLOCKS) for b in range(BLOCKS)]
def _words(text: Column) -> Column:
    trimmed = F.btrim(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(_EDGES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE))


def _bound(value: Column, body) -> Column:
    """body(value) with value computed once, also where the optimizer merges projections."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hashes(words: Column, stride: int = 1, width: int = WIDTH) -> Column:
    """Hashes of the shingles at every stride-th position; empty for fewer words than a shingle has."""
    return F.when(F.size(words) < width, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1), F.lit(stride)), lambda i: F.xxhash64(F.slice(words, i, width)))
    )


def _shingles(words: Column, width: Column) -> Column:
    """The bag of shingles; empty for fewer words than a shingle has."""
    many = F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda i: F.array_join(F.slice(words, i, width), " "))
    return F.when(F.size(words) < width, F.array().cast("array<string>")).otherwise(many)


def _lanes(hashes: Column, width: int) -> Column:
    """For each bit, whether most of the hashes have it, as a long; sums of `width` bits are packed into longs."""
    lanes = 64 // width
    low = sum(1 << (width * k) for k in range(lanes))
    sums = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda b: F.aggregate(hashes, F.lit(0).cast("long"), lambda acc, h: acc + F.call_function("shiftrightunsigned", h, b).bitwiseAND(F.lit(low))),
    )

    def bits(packed: Column, b: Column) -> Column:
        out = F.lit(0).cast("long")
        for lane in range(lanes):
            count = F.shiftrightunsigned(packed, width * lane).bitwiseAND(F.lit((1 << width) - 1))
            bit = F.when(count * 2 > F.size(hashes), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
            out = out.bitwiseOR(F.call_function("shiftleft", F.shiftleft(bit, width * lane), b))
        return out

    return F.aggregate(F.transform(sums, bits), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))


def simhash(words: Column) -> Column:
    """The 64-bit SimHash of a nonempty array of words; ties give 0. Sums of 16 bits, or of 32 where there are more words than fit."""
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return _bound(hashed, lambda h: F.when(F.size(h) < 1 << 16, _lanes(h, 16)).otherwise(_lanes(h, 32)))


def _blocks(fp: Column) -> Column:
    """The values of a fingerprint's blocks, as structs (block, value)."""
    return F.array(*(F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, r.start).bitwiseAND(F.lit((1 << len(r)) - 1)).alias("value")) for i, r in enumerate(_BITS)))


def _struct_of(block: int, value: Column):
    return lambda mask: F.struct(F.lit(block).alias("block"), value.bitwiseXOR(mask).alias("value"))


def _near_blocks(fp: Column) -> Column:
    """As _blocks, with every value that differs in at most RADIUS // BLOCKS bits."""
    out = []
    for i, r in enumerate(_BITS):
        masks = [sum(1 << b for b in c) for k in range(RADIUS // BLOCKS + 1) for c in combinations(range(len(r)), k)]
        value = F.shiftrightunsigned(fp, r.start).bitwiseAND(F.lit((1 << len(r)) - 1))
        out.append(F.transform(F.array(*(F.lit(m).cast("long") for m in masks)), _struct_of(i, value)))
    return F.concat(*out)


def _numbered(bag: Column) -> Column:
    """A bag as a set: every shingle with its number among its equals."""
    return _bound(F.array_sort(bag), lambda x: F.transform(x, lambda g, i: F.concat_ws("\n", g, (i + 1 - F.array_position(x, g)).cast("string"))))


def _common(a: Column, b: Column) -> Column:
    """Size of the intersection of two bags of shingles."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(F.size(F.array_intersect(_numbered(a), _numbered(b))))


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, len, width) of the items with words; width is that of their shingles."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), _words(F.col("text")).alias("words")).where(F.size("words") > 0)
    return rows.withColumn("len", F.size("words")).withColumn("width", F.least(F.lit(WIDTH), F.size("words")))


def _every_hash(words: Column, widths: list[int], stride: int = 1) -> Column:
    """Hits of a document's words: structs (width, place, h) for every width."""

    def of(width: int) -> Column:
        at = lambda h, i: F.struct(F.lit(width).alias("width"), (i * stride).alias("place"), h.alias("h"))
        return F.transform(_hashes(words, stride, width), at)

    return F.concat(*(of(w) for w in widths))


def dense_starts(places: Column, total: Column, length: Column, width: Column) -> Column:
    """Ranges (low, high) of the starts of all windows of length words that hold enough of the sorted places.

    Of places p[0] < p[1] < ..., a window holds c if it starts at p[i] at the latest and ends with p[i + c - 1] or later;
    the ranges are cut where the one before ends, so that no start is given twice.
    """
    m = F.least(length, total) - width + 1
    c = F.ceil((m + length - width + 1) * NUMERATOR / (NUMERATOR + DENOMINATOR)).cast("int")
    last = F.greatest(F.lit(0), total - length)

    def span(i: Column) -> Column:
        free = F.when(i > 0, F.element_at(places, i) + 1).otherwise(F.lit(0))  # element_at counts from 1: the place before
        low = F.greatest(F.element_at(places, i + c) - m + 1, free, F.lit(0))
        return F.struct(low.alias("low"), F.least(F.element_at(places, i + 1), last).alias("high"))

    spans = F.when(F.size(places) >= c, F.transform(F.sequence(F.lit(0), F.size(places) - c), span))
    return F.filter(spans, lambda x: x["low"] <= x["high"])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, start): for each document and item, its best window at or above the threshold.

    start counts words from 0; of equal windows the first counts. Null or empty texts match nothing, and documents
    of fewer words than a shingle no longer items; repeated rows are searched like one another, rows without an id
    are reported with a null one, and items that repeat an id count as one.
    """
    items = runtime.written(items_of(benchmark), "items")
    own = F.transform(F.sequence(F.lit(1), F.col("len") - (F.col("width") - 1)), lambda i: F.xxhash64(F.slice("words", i, F.col("width"))))
    index = items.select("len", "width", F.explode_outer(own).alias("h")).groupBy("h", "len", "width").agg(F.count(F.lit(1)).alias("n")).select("h", "len", "width")
    index = runtime.written(index, "index")
    bounds = index.agg(F.count(F.lit(1)).alias("n"), F.min("len").alias("shortest"), F.sort_array(F.collect_set("width")).alias("widths")).first()  # WIDTH widths at most
    few = bounds["n"] <= BROADCAST_ROWS
    widths = bounds["widths"] or [WIDTH]
    stride = 3 if (bounds["shortest"] or 0) >= WIDTH + 2 else 1

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    near = index.select("h").distinct()
    hashes = _bound(_words(F.col("text")), lambda w: F.concat(*(_hashes(w, stride, x) for x in widths)))
    probes = keyed.select("doc_id", F.explode_outer(hashes).alias("h"))
    hit = probes.join(F.broadcast(near) if few else near, "h", "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("hits"))
    hit = runtime.written(hit.select(F.coalesce("doc_id", F.lit(-(2**63))).alias("k")), "hit")
    small = hit.count() <= BROADCAST_ROWS
    looked = keyed.withColumn("k", F.coalesce("doc_id", F.lit(-(2**63)))).join(F.broadcast(hit) if small else hit, "k", "left_semi")
    row = F.sha2(F.concat_ws("\n", F.col("doc_id").cast("string"), F.col("text").cast("string")), 256)
    looked = looked.select(F.unhex(row).alias("row"), "doc_id", _words(F.col("text")).alias("words")).dropDuplicates(["row", "doc_id"])
    looked = runtime.written(looked, "looked")

    hits = looked.select("row", F.size("words").alias("total"), F.explode_outer(_bound(F.col("words"), lambda w: _every_hash(w, widths))).alias("x"))
    hits = hits.select("row", "total", "x.width", "x.place", "x.h").join(F.broadcast(index) if few else index, ["h", "width"])
    dense = hits.groupBy("row", "len", "width").agg(F.first("total").alias("total"), F.sort_array(F.collect_list("place")).alias("places"))  # a document's words at most
    spans = dense.select("row", "len", "width", F.explode(dense_starts(F.col("places"), F.col("total"), F.col("len"), F.col("width"))).alias("x"))
    starts = spans.select("row", "len", "width", F.explode(F.sequence("x.low", "x.high")).alias("start"))
    windows = starts.join(looked, "row").select("row", "doc_id", "start", "len", "width", F.slice("words", F.col("start") + 1, F.col("len")).alias("window"))
    windows = runtime.written(windows.withColumn("fp", simhash(F.col("window"))), "windows")

    prints = items.select("item_id", "len", simhash(F.col("words")).alias("item_fp"))
    blocks = prints.select("item_id", "len", "item_fp", F.explode_outer(_near_blocks(F.col("item_fp"))).alias("b")).select("item_id", "len", "item_fp", "b.block", "b.value")
    probe = windows.select("row", "start", "len", "fp", F.explode_outer(_blocks(F.col("fp"))).alias("b")).select("row", "start", "len", "fp", "b.block", "b.value")
    found = probe.join(blocks, ["len", "block", "value"]).where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
    found = found.groupBy("row", "start", "len", "item_id").agg(F.count(F.lit(1)).alias("blocks")).select("row", "start", "len", "item_id")

    sides = found.join(windows.select("row", "doc_id", "start", "len", "width", "window"), ["row", "start", "len"]).join(items.select("item_id", "len", "words"), ["item_id", "len"])
    sides = sides.select("doc_id", "item_id", "start", _shingles(F.col("window"), F.col("width")).alias("a"), _shingles(F.col("words"), F.col("width")).alias("b"))
    scored = sides.select("doc_id", "item_id", "start", (F.size("a") + F.size("b")).alias("both"), _common(F.col("a"), F.col("b")).alias("common"))
    passed = scored.where(F.col("common") * (NUMERATOR + DENOMINATOR) >= F.col("both") * NUMERATOR)
    best = passed.select("doc_id", "item_id", (F.col("common") / (F.col("both") - F.col("common"))).alias("similarity"), F.col("start").cast("long").alias("start"))
    top = best.groupBy("doc_id", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("t"))
    return top.select("doc_id", "item_id", F.col("t.similarity").alias("similarity"), (-F.col("t.back")).alias("start"))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no leak."""
    bad = leaks(docs, benchmark).select("doc_id").distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["doc_id"]), "left_anti")
