"""MinHash near-duplicates with tensored banding, verified on full shingle sets.

Two small collections of half-keys (each made of HALF minhashes) are drawn per document; a table's key
combines one half-key of either collection, so SIDE * SIDE tables need only 2 * SIDE * HALF minhashes.
A pair of similarity s misses all tables with probability of about 2 * (1 - s**HALF)**SIDE: at the
threshold of 0.75 one in 10,000, at 0.85 one in two million.

Documents with equal shingle sets are one class. Buckets of up to three classes give all their pairs, from
partial aggregates of their ids. Larger ones are crowded: their classes are dealt to sub-buckets by a hash,
where each is paired with the first and with the one before, and so are the first ones of the sub-buckets, so
neither a task nor a set meets more than about the square root of a bucket. Only the SIDE tables that combine
equally numbered half-keys are paired so: a class gets no more than 2 * SIDE partners, however large its
buckets. One partner of each class is verified first; pairs that those links already connect need no check.
While crowded buckets hold several components, every component of a bucket sends one random member a round,
paired in the same way, until a round links less than one in YIELD of its pairs. The classes of buckets, of
any table, that hold several components even then are joined exactly on their rarest shingles, and what is
close enough is verified: no link between classes that meet in a bucket depends on the tables paired or on the
rounds. Before, up to DRAWN rows of a component stand for it at each shingle, as each late member of a large
component would meet all its others. The sets of all classes that meet others are written once; every check
reads those it needs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from curaloom.llm import runtime, words
from curaloom.operators.components import components

WIDTH, PERCENT = 5, 75
SIDE, HALF = 12, 2
#: Rounds end where fewer than one in so many pairs is a link; the exact join finds the rest.
YIELD = 100
#: Before that join is made in full, so many rows of a component stand for it at each shingle.
DRAWN = 128
#: Up to so many ids are broadcast to pick texts out of the scan (8 bytes each); beyond, a shuffled join does.
BROADCAST_IDS = 1_000_000
TASK_ROWS = 1 << 20

_SEEDS = words.spread(2 * SIDE * HALF, 501)
_ODD = words.spread(2 * SIDE * HALF, 502) | np.uint64(1)
_SLOT = words.spread(2 * SIDE, 503)


def half_keys(shingles: np.ndarray) -> np.ndarray:
    """The 2 * SIDE half-keys of a nonempty set: the first SIDE for one collection, the rest for the other."""
    low = np.full(_SEEDS.size, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, shingles.size, 4096):
        part = (shingles[at : at + 4096, None] ^ _SEEDS) * _ODD
        np.minimum(low, part.min(axis=0), out=low)
    low = low.reshape(2 * SIDE, HALF)
    key = _SLOT.copy()
    for k in range(HALF):
        key = words.mix(key ^ low[:, k])
    return key


def _signature(s: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return words.mix(s).sum(dtype=np.uint64).tobytes() + words.mix(s ^ np.uint64(0x5DEECE66D1234567)).sum(dtype=np.uint64).tobytes()


def _sketches(batches):
    for batch in batches:
        texts = [t or b"" for t in batch.column(1).to_pylist()]
        sets = words.shingle_sets(texts, WIDTH)
        keys = [half_keys(s).view(np.int64) if s.size else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([s.size for s in sets], pa.int64()),
                pa.array([_signature(s) if s.size else None for s in sets], pa.binary()),
                pa.array([k[:SIDE] if k is not None else None for k in keys], pa.list_(pa.int64())),
                pa.array([k[SIDE:] if k is not None else None for k in keys], pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "sig", "left", "right"],
        )


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, sig, left, right) per row; the last three null for an empty set."""
    runtime.bound_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(_sketches, "doc_id long, n_shingles long, sig binary, left array<long>, right array<long>")


def _few(ids: DataFrame) -> DataFrame:
    """ids, broadcast where their number allows it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _checked(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs that are near-duplicates by their full sets, as a written table."""

    def side(end: str, name: str) -> DataFrame:
        ids = pairs.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias("k")).select("id")
        ids = runtime.written(ids, "ids", pairs.count())
        return sets.join(_few(ids), "id", "left_semi").select(F.col("id").alias(end), F.col("shingles").alias(name))

    rows = pairs.select("a", "b").join(side("a", "s"), "a").join(side("b", "t"), "b")
    rows = rows.select("a", "b", (F.size("s") + F.size("t")).alias("sizes"), F.size(F.array_intersect("s", "t")).alias("both"))
    return runtime.written(rows.where(f"100 * both >= {PERCENT} * (sizes - both)").select("a", "b"), "links")


def _dealt(classes: DataFrame) -> DataFrame:
    """classes over so many tasks that each makes about TASK_ROWS rows of tables, which its partial aggregate can hold."""
    return classes.select("id", "left", "right").repartition(max(1, -(-classes.count() * SIDE * SIDE // TASK_ROWS)))


def _tables(classes: DataFrame) -> DataFrame:
    """(key, id, diagonal) for every class and table; diagonal where i = j."""
    sides = _dealt(classes).select("id", "right", F.posexplode_outer("left").alias("i", "l"))
    tables = sides.select("id", "i", "l", F.posexplode_outer("right").alias("j", "r"))
    return tables.select(F.xxhash64("i", "l", "j", "r").alias("key"), "id", (F.col("i") == F.col("j")).alias("diagonal"))


def _buckets(classes: DataFrame) -> DataFrame:
    """(key, size, low, high, every) of the buckets of more than one class, as a written table; every is the exclusive or of their ids."""
    tables = _tables(classes).groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"), F.max("id").alias("high"), F.bit_xor("id").alias("every"))
    return runtime.written(tables.where("size > 1"), "buckets")


def _small(buckets: DataFrame) -> DataFrame:
    """All pairs (a, b), a < b, of the buckets of up to three classes."""
    middle = F.col("every").bitwiseXOR(F.col("low")).bitwiseXOR(F.col("high"))
    ends = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    two = ends(F.col("low"), F.col("high"))
    listed = F.when(F.col("size") == 2, F.array(two)).otherwise(F.array(two, ends(F.col("low"), middle), ends(middle, F.col("high"))))
    return buckets.where("size <= 3").select(F.explode(listed).alias("x")).select("x.a", "x.b")


def _crowded(classes: DataFrame, buckets: DataFrame) -> DataFrame:
    """(key, id, diagonal) of the classes in buckets of more than three, as a written table."""
    keys = buckets.where("size > 3").select("key")
    return runtime.written(_tables(classes).join(_few(keys), "key", "left_semi"), "crowded")


def _ends(rows: DataFrame, within: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """Of rows (key, id, ...): each id with c, the first of its group, and p, the one before; and the first rows."""
    w = Window.partitionBy(*within).orderBy(order, "id")
    seen = rows.withColumn("c", F.first("id").over(w)).withColumn("p", F.lag("id", 1).over(w))
    return seen.where("p is not null").select("id", "c", "p"), seen.where("p is null").select(*rows.columns)


def _paired(rows: DataFrame, salts: int, turn: int = 0) -> DataFrame:
    """Pairs (a, b), a < b, that connect all ids of every bucket of rows (key, id), in two levels of groups.

    With turn 0 the order is that of the ids, so that tables with the same members give the same pairs; else a random one.
    An id has the same neighbours in many tables: they are told apart before they become pairs.
    """
    order = F.xxhash64("id", F.lit(turn)) if turn else F.col("id")
    dealt = rows.select("key", "id", order.alias("order"), F.pmod(F.xxhash64("id", F.lit(-1 - turn)), F.lit(salts)).alias("salt"))
    inner, heads = _ends(dealt, ["key", "salt"], "order")
    outer, _ = _ends(heads.drop("salt"), ["key"], "order")
    near = inner.unionByName(outer).groupBy("id", "c", "p").agg(F.count(F.lit(1)).alias("tables"))
    pairs = near.select("id", F.explode(F.array_distinct(F.array("c", "p"))).alias("o"))
    return pairs.select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b"))


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("tables")).select("a", "b")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose ends aren't connected yet, with the roots of their ends, ra and rb."""
    left = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    right = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    rows = pairs.join(left, "a", "left").join(right, "b", "left")
    return rows.select("a", "b", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb")).where("ra <> rb")


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, root) after more links; only the components that these connect are worked on."""
    if roots is None:
        return components(links)
    upper = components(_apart(links, roots).select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    moved = roots.join(upper.select(F.col("node").alias("root"), F.col("root").alias("upper")), "root", "left").select("node", F.coalesce("upper", "root").alias("root"))
    return runtime.written(moved.unionByName(upper.select("node", "root")), "roots")


def _delegates(crowded: DataFrame, roots: DataFrame, turn: int) -> DataFrame:
    """One random member (key, id) of every component in every crowded bucket."""
    rows = crowded.join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    drawn = rows.groupBy("key", F.coalesce("root", "id").alias("root")).agg(F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("draw"), "id")).alias("d"))
    return drawn.select("key", "d.id")


def _unresolved(crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, root) of the classes of crowded buckets that hold several components, as a written table."""
    rows = crowded.select("key", "id").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("key", "id", F.coalesce("root", "id").alias("root"))
    several = rows.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most").select("key")
    ids = rows.join(several, "key", "left_semi").groupBy("id").agg(F.min("root").alias("root"))
    return runtime.written(ids, "unresolved")


def _sets(batches):
    for batch in batches:
        sets = words.shingle_sets(batch.column(1).to_pylist(), WIDTH)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_signature(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "sig", "shingles"])


def _sets_of(docs: DataFrame, rows: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, shingles) of the classes of these ids, as a written table; their texts are read once."""
    names = runtime.written(classes.join(_few(ids), "id", "left_semi").select("id", "doc_id", "sig", "n"), "wanted")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")).where("text is not null")
    read = texts.join(_few(names.select("doc_id")), "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, sig binary, shingles array<long>")
    found = read.join(names, ["doc_id", "sig"]).select("id", "n", "shingles")
    again = rows.groupBy("doc_id", "sig").agg(F.count(F.lit(1)).alias("k")).where("k > 1").join(names, ["doc_id", "sig"], "left_semi")
    return runtime.written(found if again.isEmpty() else found.dropDuplicates(["id"]), "sets")


def _reached(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The rows whose size n some row of others of their shingle, but of another component, reaches."""
    best = others.groupBy("gram", "root").agg(F.max("reach").alias("reach"))
    top = best.groupBy("gram").agg(F.max(F.struct("reach", "root")).alias("top")).select("gram", F.col("top.reach").alias("most"), F.col("top.root").alias("own"))
    rest = best.join(top, "gram").where("root <> own").groupBy("gram").agg(F.max("reach").alias("next"))
    two = top.join(rest, "gram", "left")
    return rows.join(two, "gram").where("n <= if(root = own, next, most)").select(*rows.columns)


def _prefixes(sets: DataFrame, unresolved: DataFrame) -> DataFrame:
    """(id, n, gram, reach) of the shingles by which the sets of these ids can have partners, as a written table.

    The shingles of a set stand in order of rarity. If the first that two sets share stands at a rank, no more than
    n - rank + 1 are shared, which is enough for partners of up to a size, its reach, only. The larger set thus has the
    shingle where it reaches the smaller one, and the smaller where it reaches the larger, so at least its own size.
    """
    grams = sets.join(_few(unresolved.select("id")), "id", "left_semi").select("id", "n", F.explode_outer("shingles").alias("gram"))
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    mine = Window.partitionBy("id")
    shared = grams.join(common, "gram").withColumn("later", F.row_number().over(mine.orderBy("df", "gram"))).withColumn("m", F.count(F.lit(1)).over(mine))
    reach = F.expr(f"(n - rank + 1) * {100 + PERCENT} div {PERCENT} - n")
    prefix = shared.withColumn("rank", F.expr("n - m + later")).withColumn("reach", reach).where(f"reach * 100 >= n * {PERCENT}")
    return runtime.written(prefix.select("id", "n", "gram", "reach"), "prefixes")


def _drawn(rows: DataFrame, turn: int) -> DataFrame:
    """Up to DRAWN random rows of every component of every shingle."""
    part = F.pmod(F.xxhash64("id", F.lit(-turn)), F.lit(DRAWN))
    draw = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("draw"), "id", "n", "reach")).alias("d")
    return rows.groupBy("gram", "root", part).agg(draw).select("d.id", "d.n", "gram", "d.reach", "root")


def _across(prefix: DataFrame, roots: DataFrame, turn: int = 0) -> DataFrame:
    """Pairs (a, b), a < b, of different components: all that can be near-duplicates, and few others; with a turn, of drawn rows only."""
    named = prefix.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    short = named.where("reach >= n")
    if turn:
        named, short = _drawn(named, turn), _drawn(short, turn)
    left, right = _reached(short, named).alias("x"), _reached(named, short).alias("y")
    close = f"x.n * 100 >= y.n * {PERCENT} and y.n <= x.reach and x.n <= y.reach and (x.n < y.n or x.n = y.n and x.id < y.id)"
    pairs = left.join(right, F.expr(f"x.gram = y.gram and x.root <> y.root and {close}"))
    return _distinct(pairs.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")))


def _classes(rows: DataFrame) -> DataFrame:
    """(id, doc_id, sig, n, left, right) of the distinct sets, as a written table.

    id is the smallest doc_id with that set. Where sets share their smallest doc_id, as rows of one id with different
    texts do, all but the first of them get an id of their own above all doc_ids, so that no link runs through the doc_id.
    """
    found = rows.where("sig is not null and doc_id is not null").groupBy("sig").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("left").alias("left"), F.first("right").alias("right")
    )
    found = runtime.written(found, "classes")
    clash = found.groupBy("doc_id").agg(F.min("sig").alias("least"), F.count(F.lit(1)).alias("k")).where("k > 1").select("doc_id", "least")
    others = found.select("doc_id", "sig").join(clash, "doc_id").where("sig <> least").select("sig")
    others = runtime.written(others.withColumn("line", F.monotonically_increasing_id()), "clashing")
    if others.isEmpty():
        return found.withColumn("id", F.col("doc_id"))
    top = rows.agg(F.max("doc_id").alias("top")).first()["top"]
    named = found.join(others, "sig", "left").withColumn("id", F.coalesce(F.lit(top) + 1 + F.col("line"), "doc_id")).drop("line")
    return runtime.written(named, "classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs (doc_id, text, and any other columns).

    Null text counts as empty; an empty set links with nothing and is its own component. Rows that
    repeat an id and its text are linked like copies; rows that repeat an id with another text are not linked
    by the id, and each counts for itself. A row without an id gets no component and is kept.
    """
    return _labelled(docs).drop("sig", "root")


def _labelled(docs: DataFrame) -> DataFrame:
    """near_duplicates with the signature of each row's set and the root of its class, which tells apart components of the same smallest doc_id."""
    rows = runtime.written(sketches(docs), "sketches")
    classes = _classes(rows)
    buckets = _buckets(classes)
    most = buckets.agg(F.max("size").alias("most")).first()["most"]
    if most is None:
        return _with_components(rows, classes, None)
    salts = math.ceil(math.sqrt(most))
    crowded = _crowded(classes, buckets)
    paired = crowded.where("diagonal")
    pairs = runtime.written(_distinct(_small(buckets).unionByName(_paired(paired, salts))), "pairs")
    meeting = pairs.select(F.explode(F.array("a", "b")).alias("id")).unionByName(crowded.select("id"))
    sets = _sets_of(docs, rows, classes, runtime.written(meeting.distinct(), "ids"))

    # one partner for each class first; most of what remains is then connected already
    one = runtime.written(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "one", pairs.count())
    roots = _joined(None, _checked(sets, one))
    rest = runtime.written(_apart(pairs.join(one, ["a", "b"], "left_anti"), roots).select("a", "b"), "rest", pairs.count())
    turn = 0
    while True:
        tried, found = rest.count(), 0
        if tried:
            more = _checked(sets, rest)
            found = more.count()
            if found:
                roots = _joined(roots, more)
        if turn and found * YIELD <= tried:
            break
        turn += 1
        again = _distinct(_paired(_delegates(paired, roots, turn), salts, turn))
        rest = runtime.written(again.join(pairs, ["a", "b"], "left_anti"), "rest")
        pairs = pairs.unionByName(rest)
    unresolved = _unresolved(crowded, roots)
    if not unresolved.isEmpty():
        prefix = _prefixes(sets, unresolved)
        some = runtime.written(_across(prefix, roots, turn + 1).join(pairs, ["a", "b"], "left_anti"), "some")
        roots = _joined(roots, _checked(sets, some))
        pairs = pairs.unionByName(some)
        last = runtime.written(_across(prefix, roots).join(pairs, ["a", "b"], "left_anti"), "last")
        roots = _joined(roots, _checked(sets, last))
    return _with_components(rows, classes, roots)


def _with_components(rows: DataFrame, classes: DataFrame, roots: DataFrame | None) -> DataFrame:
    """rows with component_id, the smallest doc_id of the component, and kept."""
    named = classes.select("sig", "id", "doc_id")
    if roots is None:
        named = named.select("sig", F.col("doc_id").alias("component"), F.col("id").alias("root"))
    else:
        named = named.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("sig", F.coalesce("root", "id").alias("root"), "id", "doc_id")
        # roots are smallest doc_ids, but for classes with an id of their own
        own = named.where("id <> doc_id").groupBy("root").agg(F.min("doc_id").alias("lower"))
        named = named.join(own, "root", "left").select("sig", F.when(F.col("lower") < F.col("root"), F.col("lower")).otherwise(F.col("root")).alias("component"), "root")
    out = rows.select("doc_id", "n_shingles", "sig").join(named, "sig", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"), "sig", "root")


def _named(docs: DataFrame) -> list:
    return [F.col(f"`{x}`") for x in docs.columns]


def _chosen(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """docs semi- or anti-joined with ids, broadcast where few."""
    return docs.join(_few(ids), "doc_id", how).select(*_named(docs))


def _signed(docs: DataFrame, name: str) -> DataFrame:
    """docs with the signature of each row's set under name, null for an empty one."""
    def run(columns):
        sets = words.shingle_sets([t or b"" for t in columns[-1].to_pylist()], WIDTH)
        return [*columns[:-1], pa.array([_signature(s) if s.size else None for s in sets], pa.binary())]

    rows = docs.withColumn(runtime.free_name(docs, "utf8"), F.col("text").cast("string").cast("binary"))
    return runtime.map_in_arrow(rows, run, StructType([*docs.schema.fields, StructField(name, BinaryType())]))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay: of each component the document of the smallest id, once; rows without an id stay.

    Rows that repeat an id are decided on by their sets of shingles; of those in one component one stays.
    """
    rows = runtime.written(_labelled(docs).select("doc_id", "sig", "root", "kept"), "kept")
    per_id = rows.where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    per_id = runtime.written(per_id.where("not kept or n > 1"), "decided")
    out = _chosen(docs, per_id.select("doc_id"), "left_anti")
    twice = per_id.where("n > 1 and kept").select("doc_id")
    if twice.isEmpty():
        return out
    name = runtime.free_name(docs, "sig")
    stay = rows.where("kept").join(_few(twice), "doc_id", "left_semi").groupBy("doc_id", "root").agg(F.min("sig").alias("sig"))
    stay = stay.select(F.col("doc_id").alias("stay_id"), F.col("sig").alias("stay_sig"))
    mine = _signed(_chosen(docs, twice, "left_semi"), name).dropDuplicates(["doc_id", name])
    mine = mine.join(stay, (mine["doc_id"] == stay["stay_id"]) & mine[name].eqNullSafe(stay["stay_sig"]), "left_semi")
    return out.unionByName(mine.select(*_named(docs)))
