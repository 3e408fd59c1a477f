"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network.

Every word has a sparse ternary index vector drawn from its hash; no vocabulary decides which words count.
Context vectors sum the index vectors of the words up to WINDOW places away, rotated by side, over all
documents. They lie in a table of SLOTS rows, addressed by the word's hash, so the table is as large for any
corpus and the words of a slot share its context; their index vectors still tell them apart. A word's shape
(case, ending, length, and whether it repeats the word before) has an index vector, too. A document is pooled
as mean and deviation of these three vectors over all its words. A two-layer numpy network gives a logit,
which a temperature fitted on documents that the training left out turns into a probability.

The network is fitted on a bounded sample of labelled rows: PER_CLASS of each class, those of lowest hash,
among the rows that may be learned from. Contexts come from all documents, and everything is scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from curaloom.llm import runtime, words

PER_CLASS = 2500
SLOTS, WINDOW, DIM, NONZERO = 8192, 2, 64, 4
HIDDEN, STEPS, RATE, DECAY = 32, 400, 0.01, 1e-3
ACCEPT = 0.7

#: Slots whose sums travel together, and words that are looked at together.
_BLOCK, _AT_ONCE = 64, 1 << 17
_SPAN = DIM // NONZERO

_CASES, _ENDS, _LENGTHS = 4, 12, 4
_KINDS = _CASES * _ENDS * _LENGTHS
#: Shapes, and the shape of repeated words.
SHAPES = _KINDS + 1
_END = np.zeros(256, np.int64)
for _i, _chars in enumerate((b".", b",", b"!", b"?", b";:", b"0123456789", b"\"')]}", b"*", b"$%&#@", b"|-_/\\<>=+~^`"), start=1):
    _END[list(_chars)] = _i
_END[0x80:] = 11
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True


def _shapes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A number below _KINDS for each word, by its case, last byte and length."""
    if not start.size:
        return np.empty(0, np.int64)
    ups, lows = (np.zeros(data.size + 1, np.uint32) for _ in range(2))  # a batch is far smaller than 2**32 bytes
    np.cumsum(_UPPER[data], out=ups[1:])
    np.cumsum(_LOWER[data], out=lows[1:])
    stop = start + length
    up, low = ups[stop] - ups[start], lows[stop] - lows[start]
    case = np.where(up == 0, np.where(low == 0, 3, 0), np.where((up == 1) & _UPPER[data[start]], 1, 2))
    size = np.digitize(length, (3, 7, 13))
    return (case * _ENDS + _END[data[stop - 1]]) * _LENGTHS + size


def index_vectors(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the NONZERO entries of each seed's vector, one in every span of DIM // NONZERO."""
    place, sign = np.empty((seeds.size, NONZERO), np.int64), np.empty((seeds.size, NONZERO), np.int8)
    for k in range(NONZERO):
        h = words.mix(seeds + np.uint64(k * 1_000_003 + 1))
        place[:, k] = k * _SPAN + (h % np.uint64(_SPAN)).astype(np.int64)
        sign[:, k] = np.where(h >> np.uint64(63), 1, -1)
    return place, sign


def _shape_vectors() -> np.ndarray:
    place, sign = index_vectors(words.spread(SHAPES, 77))
    out = np.zeros((SHAPES, DIM), np.float32)
    np.put_along_axis(out, place, sign.astype(np.float32), 1)
    return out


SHAPE_VECTORS = _shape_vectors()


def terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of every word, and each text's bounds."""
    data, start, length, word, bounds = words.word_spans(texts, cased=True)
    shape = _shapes(data, start, length)
    again = np.zeros(word.size, bool)
    np.equal(word[1:], word[:-1], out=again[1:])
    again[bounds[:-1][bounds[:-1] < word.size]] = False
    shape[again] = _KINDS
    return word, shape, bounds


def _slot(word: np.ndarray) -> np.ndarray:
    return (word % np.uint64(SLOTS)).astype(np.int64)


def contexts(texts: list[bytes]) -> np.ndarray:
    """Sum over all words of their neighbours' index vectors, by the word's slot; exact integers."""
    word, _, bounds = terms(texts)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out = np.zeros(SLOTS * DIM, np.int64)
    for far in range(1, WINDOW + 1):
        near = np.flatnonzero(doc[far:] == doc[:-far])
        for at in range(0, near.size, _AT_ONCE):
            left = near[at : at + _AT_ONCE]
            for mine, other, turn in ((left, left + far, far), (left + far, left, -far)):
                place, sign = index_vectors(word[other])
                cell = _slot(word[mine])[:, None] * DIM + (place + turn) % DIM
                out += np.bincount(cell.ravel(), weights=sign.ravel(), minlength=out.size).astype(np.int64)
    return out.reshape(SLOTS, DIM)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Context vectors of the slots, of length 1; zeros where nothing was seen."""
    norm = np.sqrt((sums.astype(np.float64) ** 2).sum(1, keepdims=True))
    return (sums / np.maximum(norm, 1e-9)).astype(np.float32)


def _spread(mean: np.ndarray, square: np.ndarray) -> np.ndarray:
    return np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0))])


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Mean and deviation of index, context and shape vectors over the words of each text; zeros for a text without words."""
    word, shape, bounds = terms(texts)
    out = np.zeros((len(texts), 6 * DIM), np.float32)
    for at in range(0, len(texts), 128):
        edge = bounds[at : at + 129]
        n, count = len(edge) - 1, np.maximum(np.diff(edge), 1)[:, None]
        doc = np.repeat(np.arange(n), np.diff(edge))
        total, square = np.zeros(n * DIM), np.zeros(n * DIM)
        bag, kinds = np.zeros(n * SLOTS, np.float32), np.zeros(n * SHAPES)
        for a in range(0, doc.size, _AT_ONCE):
            mine, here = doc[a : a + _AT_ONCE], slice(edge[0] + a, edge[0] + min(a + _AT_ONCE, doc.size))
            place, sign = index_vectors(word[here])
            cell = (mine[:, None] * DIM + place).ravel()
            total += np.bincount(cell, weights=sign.ravel(), minlength=n * DIM)
            square += np.bincount(cell, minlength=n * DIM)
            bag += np.bincount(mine * SLOTS + _slot(word[here]), minlength=n * SLOTS)
            kinds += np.bincount(mine * SHAPES + shape[here], minlength=n * SHAPES)
        bag, kinds = bag.reshape(n, SLOTS) / count.astype(np.float32), kinds.reshape(n, SHAPES) / count
        columns = [_spread(total.reshape(n, DIM) / count, square.reshape(n, DIM) / count)]
        columns += [_spread(x @ v, x @ (v * v)) for x, v in ((bag, vectors), (kinds, SHAPE_VECTORS))]
        out[at : at + n] = np.hstack(columns)
    return out


def _forward(x: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray]:
    h = np.tanh(((x - net["centre"]) / net["scale"]) @ net["w1"] + net["b1"])
    return h, (h @ net["w2"] + net["b2"])[:, 0]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, seed: int = 7) -> dict:
    """The network by Adam on four fifths of the rows, the temperature on the last fifth."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(x))
    fit, held = order[: max(1, len(x) * 4 // 5)], order[len(x) * 4 // 5 :]
    net = {
        "centre": x[fit].mean(0),
        "scale": x[fit].std(0) + 1e-3,
        "w1": draw.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        "b1": np.zeros(HIDDEN),
        "w2": draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 1)),
        "b2": np.zeros(1),
    }
    xs, ys, ws = x[fit], y[fit], weight[fit] / weight[fit].sum()
    scaled = (xs - net["centre"]) / net["scale"]
    moment = {k: [np.zeros_like(net[k]), np.zeros_like(net[k])] for k in ("w1", "b1", "w2", "b2")}
    for step in range(1, STEPS + 1):
        h, z = _forward(xs, net)
        error = ((_sigmoid(z) - ys) * ws)[:, None]
        back = (error @ net["w2"].T) * (1 - h * h)
        slopes = {"w1": scaled.T @ back + DECAY * net["w1"] / HIDDEN, "b1": back.sum(0), "w2": h.T @ error + DECAY * net["w2"], "b2": error.sum(0)}
        for k, g in slopes.items():
            m, v = moment[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            net[k] = net[k] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net["temperature"] = 1.0
    if held.size:
        z, t, w = _forward(x[held], net)[1], y[held], weight[held]
        loss = lambda heat: -(w * (t * np.log(_sigmoid(z / heat) + 1e-12) + (1 - t) * np.log(1 - _sigmoid(z / heat) + 1e-12))).sum()
        net["temperature"] = float(min(np.geomspace(0.02, 50, 200), key=loss))
    return net


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text")


class Model:
    """What scoring needs: a few MB, fixed by SLOTS and DIM."""

    def __init__(self, vectors: np.ndarray, net: dict | None):
        self.vectors, self.net = vectors, net

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), 0.5)
        return _sigmoid(_forward(pooled(texts, self.vectors).astype(np.float64), self.net)[1] / self.net["temperature"])


def _gathered(batches):
    """A partition's context sums, by blocks of slots."""
    total = np.zeros((SLOTS, DIM), np.int64)
    for batch in batches:
        total += contexts(batch.column(0).to_pylist())
    used = [b for b in range(0, SLOTS, _BLOCK) if total[b : b + _BLOCK].any()]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([total[b : b + _BLOCK].tobytes() for b in used], pa.binary())], names=["block", "part"])


def _merged(batches):
    """The sums of the blocks that meet here; one block's memory each, however many partitions sent it."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[block] = total.get(block, 0) + np.frombuffer(part, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "part"])


def context_sums(docs: DataFrame) -> np.ndarray:
    """contexts of all rows of docs: summed by partition, then by block; one row a block reaches the driver."""
    runtime.bound_batches(docs.sparkSession)
    sent = docs.select(_text(docs)).mapInArrow(_gathered, "block int, part binary")
    sums = np.zeros((SLOTS, DIM), np.int64)
    for row in sent.repartition("block").mapInArrow(_merged, "block int, part binary").collect():  # SLOTS * DIM integers, whatever the corpus
        sums[row["block"] : row["block"] + _BLOCK] = np.frombuffer(row["part"], np.int64).reshape(-1, DIM)
    return sums


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier of labels.quality, learned from the rows that aren't held out.

    Labels other than 0 and 1 are left; of several for a document the smallest counts. Without rows of
    both classes the model scores 0.5 throughout. Of rows that repeat an id one text is learned from.
    """
    spark = docs.sparkSession
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("int")).alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(np.empty((0, 0)), None)
    lowest = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS) for y in (0, 1)]
    sample = runtime.written(lowest[0].unionByName(lowest[1]), "labelled", 2 * PER_CLASS)
    vectors = word_vectors(context_sums(docs))
    shipped = spark.sparkContext.broadcast(vectors)

    def measured(batches):
        for batch in batches:
            x = pooled(batch.column(2).to_pylist(), shipped.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "y", "x"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text(docs)).join(F.broadcast(sample), "doc_id")  # 2 * PER_CLASS rows at most
    rows = rows.select("doc_id", "y", "text").mapInArrow(measured, "doc_id long, y int, x binary")
    data = sorted(rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("x").alias("x")).collect())  # at most 2 * PER_CLASS
    if len({r["y"] for r in data}) < 2:
        return Model(vectors, None)
    x = np.array([np.frombuffer(r["x"], np.float32) for r in data], np.float64)
    y = np.array([r["y"] for r in data], np.float64)
    share = np.array([counts[0], counts[1]], float) / np.array([(y == 0).sum(), (y == 1).sum()])
    return Model(vectors, train(x, y, share[y.astype(int)]))


def _scorer(docs: DataFrame, model: Model):
    """A function from an Arrow column of texts to one of scores, for workers; nulls score as empty texts."""
    spark = docs.sparkSession
    runtime.bound_batches(spark)
    shipped = spark.sparkContext.broadcast((model.vectors, model.net))
    return lambda texts: pa.array(Model(*shipped.value)([t or b"" for t in texts.cast(pa.binary()).to_pylist()]), pa.float64())


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with the score appended under name, which must be free; nulls score as empty texts, and texts come out as strings."""
    score, at = _scorer(docs, model), docs.columns.index("text")
    rows = docs.withColumn("text", F.col("text").cast("string"))
    return runtime.map_in_arrow(rows, lambda columns: [*columns, score(columns[at])], StructType([*rows.schema.fields, StructField(name, DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs."""
    score = _scorer(docs, fit(docs, labels))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = runtime.map_in_arrow(rows, lambda columns: [columns[0], score(columns[1])], StructType([rows.schema["doc_id"], StructField("score", DoubleType())]))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier accepts, with their columns as they are, whatever their names; null texts score as empty ones."""
    name = runtime.free_name(docs, "quality")
    return scored(docs, fit(docs, labels), name).where(F.col(name) >= ACCEPT).drop(name)
