"""Language-model scores by deleted interpolation of bigrams.

P(w | v) mixes the maximum-likelihood estimates of the bigram and the word with a uniform share over the
vocabulary and one unknown word. The mixture weights belong to the frequency bucket of the context v and
are learned by expectation-maximisation: counts come from one part of the training documents, the weights
from how well they predict the other, deleted part. The scores then use the counts of both.

Counts never sit in one place. Documents are packed into chunks; each chunk sends its distinct keys, sorted
and delta-coded, to slots of the key range, which add up the counts of all chunks and send every chunk
the counts of its own keys. What moves is a few bytes for each distinct bigram of a chunk.

Words have 64-bit hashes, bigrams 56-bit ones: two of a billion words collide with a chance of 3 %, and of a
trillion bigrams one in 70,000 shares its count.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaloom.llm import runtime, words

CHUNK_BYTES = 4_000_000
#: Bytes of text whose keys share a slot: few on small inputs for even tasks, more (some 300 MB of keys and counts a
#: slot) on large ones. Text is what counts, not its number of documents, so a slot's memory is bounded.
SLOT_BYTES, LARGE_SLOT_BYTES, EVEN_SLOTS = 4_000_000, 40_000_000, 1024
BUCKETS = 24
#: The mixture weights are learned from ratios in steps of 1/FINE octaves.
FINE, ROUNDS = 8, 200
HELD, FITTED, DELETED = 0, 1, 2

_END, _START = words.spread(2, 901)
_GAP = re.compile(rb"[ \t-\r]")
_STEP = np.uint64(0x9FB21C651E98DF25)
_NONE = 10_000


def held_out(doc_id: Column) -> Column:
    return _crc(doc_id) % 5 == 1


def _crc(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def _role(doc_id: Column) -> Column:
    """Held out, or of the training documents one eighth deleted and the rest fitted."""
    return F.when(held_out(doc_id), HELD).when(F.floor(_crc(doc_id) / 5) % 8 == 0, DELETED).otherwise(FITTED)


_COLUMNS = {"doc_id": pa.int64(), "role": pa.int32(), "text": pa.large_binary(), "row": pa.int64(), "lead": pa.bool_(), "open": pa.bool_()}


def _pieces(text: bytes) -> list[tuple[bytes, bool, bool]]:
    """A text as pieces (text, lead, open) of about CHUNK_BYTES, cut between words.

    A piece but the first leads with the word before it, which is context only; one but the last is open, without the end.
    """
    out, at, word = [], 0, b""
    while True:
        cut = _GAP.search(text, at + CHUNK_BYTES) if len(text) - at > CHUNK_BYTES else None
        piece = text[at : cut.start()] if cut else text[at:]
        out.append((word + b" " + piece if word else piece, bool(word), cut is not None))
        if cut is None:
            return out
        word = (piece.rsplit(None, 1) or [word])[-1]
        at = cut.start()


def _packed(rows: list[tuple]) -> bytes:
    """Rows of _COLUMNS as compressed Arrow."""
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _COLUMNS.values(), strict=True)], names=list(_COLUMNS))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> tuple[pa.Table, np.ndarray, Grams]:
    """The rows of a chunk, their roles, and the tokens of their texts."""
    t = pa.ipc.open_stream(blob).read_all()
    lead, open_ = (t.column(c).to_numpy(zero_copy_only=False) for c in ("lead", "open"))
    return t, t.column("role").to_numpy(), Grams(t.column("text").to_pylist(), lead, open_)


def _chunks(batches):
    """Packs a partition's documents into chunks, the deleted ones apart; numbers of chunks and rows are unique over partitions."""
    held: dict[bool, tuple[list, list]] = {False: ([], [0]), True: ([], [0])}
    made = seen = 0
    names = ["chunk", "deleted", "bytes", "split", "docs"]

    def close(deleted: bool):
        nonlocal made
        rows, size = held[deleted]
        number = (TaskContext.get().partitionId() << 24) + made
        split = any(r[4] or r[5] for r in rows)
        out = pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([deleted]), pa.array([size[0]], pa.int64()), pa.array([split]), pa.array([_packed(rows)], pa.binary())], names=names)
        made += 1
        rows.clear()
        size[0] = 0
        return out

    for batch in batches:
        for doc_id, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows, size = held[role == DELETED]
            row = (TaskContext.get().partitionId() << 40) + seen
            seen += 1
            for piece, lead, more in _pieces(text or b""):
                rows.append((doc_id, role, piece, row, lead, more))
                size[0] += len(piece) + 16
                if size[0] >= CHUNK_BYTES:
                    yield close(role == DELETED)
    for deleted in (False, True):
        if held[deleted][0]:
            yield close(deleted)


class Grams:
    """Tokens and bigrams of a chunk: distinct keys in order, each token's place in them, and the rows' bounds.

    own tells the tokens that count: not the word that a piece leads with, nor the end of an open one.
    """

    def __init__(self, texts: list[bytes], lead: np.ndarray | None = None, open_: np.ndarray | None = None):
        word, bounds = words.word_hashes(texts)
        n = len(texts)
        self.edge = bounds + np.arange(n + 1)
        token = np.full(word.size + n, _END, np.uint64)
        token[np.arange(word.size) + np.repeat(np.arange(n), np.diff(bounds))] = word
        self.own = np.ones(token.size, bool)
        if lead is not None:
            self.own[self.edge[:-1][lead]] = False
            self.own[self.edge[1:][open_] - 1] = False
        before = np.empty_like(token)
        before[1:] = token[:-1]
        before[self.edge[:-1]] = _START
        pair = words.mix(before * _STEP + token) >> np.uint64(8)
        self.words, self.word_at = np.unique(token, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pair, return_inverse=True)

    def per_token(self, values: np.ndarray) -> np.ndarray:
        return np.repeat(values, np.diff(self.edge))

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sums of the values of the tokens that count."""
        return np.add.reduceat(np.where(self.own, values, 0), self.edge[:-1])


def _slots(keys: np.ndarray, bits: int, slots: int) -> np.ndarray:
    """Bounds of the slots, equal parts of the key range, in sorted keys."""
    part = (keys >> np.uint64(bits - 24)) * np.uint64(slots) >> np.uint64(24)
    return np.searchsorted(part, np.arange(slots + 1).astype(np.uint64))


def _code_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences of the least sufficient width."""
    step = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(step[1:].max()).bit_length() + 7) // 8) if keys.size > 1 else 1
    first = int(keys[0]).to_bytes(8, "little") if keys.size else b""
    return bytes([width]) + first + step[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _decode_keys(blob: bytes) -> np.ndarray:
    if len(blob) < 9:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, blob[0])
    full = np.zeros((len(raw) + 1, 8), np.uint8)
    full[1:, : blob[0]] = raw
    step = full.reshape(-1).view("<u8").astype(np.uint64)
    step[0] = int.from_bytes(blob[1:9], "little")
    return np.cumsum(step, dtype=np.uint64)


def _code_counts(counts: np.ndarray) -> bytes:
    """Counts, most of which are small, compressed."""
    large = counts >= 255
    body = np.where(large, 255, counts).astype(np.uint8).tobytes() + counts[large].astype("<u8").tobytes()
    return len(counts).to_bytes(8, "little") + len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _decode_counts(blob: bytes) -> np.ndarray:
    n, size = int.from_bytes(blob[:8], "little"), int.from_bytes(blob[8:16], "little")
    body = pa.decompress(blob[16:], decompressed_size=size, codec="zstd", asbytes=True) if size else b""
    out = np.frombuffer(body, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(body, "<u8", offset=n)
    return out


_ASKED = ("words", "word_all", "word_fitted", "pairs", "pair_all", "pair_fitted")


def _asks(slots: int):
    """Of each chunk and slot, the distinct keys with their counts in all training documents and in the fitted ones."""

    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, role, g = _unpacked(blob)
                trained, fitted = g.own & g.per_token(role != HELD), g.own & g.per_token(role == FITTED)
                columns = []
                edges = [_slots(g.words, 64, slots), _slots(g.pairs, 56, slots)]
                used = np.flatnonzero(np.diff(edges[0]) + np.diff(edges[1])).tolist()  # at most one row a key, however many slots
                for keys, at, edge in ((g.words, g.word_at, edges[0]), (g.pairs, g.pair_at, edges[1])):
                    parts = [keys, np.bincount(at[trained], minlength=keys.size), np.bincount(at[fitted], minlength=keys.size)]
                    for code, part in zip((_code_keys, _code_counts, _code_counts), parts, strict=True):
                        columns.append(pa.array([code(part[edge[s] : edge[s + 1]]) for s in used], pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(used), pa.int64()), pa.array(used, pa.int32()), *columns], names=["chunk", "slot", *_ASKED])

    return run


def _answers(table: pa.Table) -> pa.Table:
    """Of one slot: every chunk's keys' counts over all chunks; in the row of chunk -1 the number and sum of counts."""
    chunks = table.column("chunk").to_pylist()
    out = {k: [] for k in ("word_all", "word_fitted", "pair_all", "pair_fitted")}
    totals = []
    for kind, (keys, every, fitted) in (("word", _ASKED[:3]), ("pair", _ASKED[3:])):
        sent = [_decode_keys(b) for b in table.column(keys).to_pylist()]
        edge = np.cumsum([0] + [len(s) for s in sent])
        distinct, at = np.unique(np.concatenate(sent), return_inverse=True)
        for name, column in ((f"{kind}_all", every), (f"{kind}_fitted", fitted)):
            asked = np.concatenate([_decode_counts(b) for b in table.column(column).to_pylist()])
            sums = np.bincount(at, weights=asked, minlength=distinct.size).astype(np.int64)  # exact up to 2**53
            out[name] = [_code_counts(sums[at[a:b]]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
            totals += [int(np.count_nonzero(sums)), int(sums.sum())]
    n = len(chunks) + 1
    return pa.table(
        {
            "chunk": pa.array([*chunks, -1], pa.int64()),
            "slot": pa.array([table.column("slot")[0].as_py()] * n, pa.int32()),
            **{k: pa.array([*v, None], pa.binary()) for k, v in out.items()},
            "totals": pa.array([None] * (n - 1) + [totals], pa.list_(pa.int64())),
        }
    )


_ANSWER = "chunk long, slot int, word_all binary, word_fitted binary, pair_all binary, pair_fitted binary, totals array<long>"


class Model:
    """Training tokens and vocabulary, of all training documents and of the fitted ones, and the weights by bucket."""

    def __init__(self, totals: list[int]):
        self.vocabulary, self.tokens, self.fitted_vocabulary, self.fitted_tokens = totals
        self.weights = np.tile([0.2, 0.7, 0.1], (BUCKETS, 1))
        self.weights[0] = [0, 0.9, 0.1]


def bucket(context: np.ndarray) -> np.ndarray:
    """The frequency bucket of a context's count: 0, 1, 2-3, 4-7 and so on."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1)


def _counted(g: Grams, word: list[bytes], pair: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of each token's word, bigram and context; the slots' answers in order."""
    w = np.concatenate([_decode_counts(b) for b in word])
    ends = int(w[np.searchsorted(g.words, _END)])
    mine = w[g.word_at]
    context = np.empty_like(mine)
    context[1:] = mine[:-1]
    context[g.edge[:-1]] = ends
    return mine, np.concatenate([_decode_counts(b) for b in pair])[g.pair_at], context


def _answered(batch):
    for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        yield row[1], sorted((r["slot"], *(r[k] for k in r if k != "slot")) for r in row[2])


def _evidence(model: Model):
    """How often each combination of bucket, bigram and word estimate predicts a deleted token."""

    def step(ratio: np.ndarray) -> np.ndarray:
        out = np.full(ratio.shape, -_NONE, np.int64)
        np.rint(np.log2(ratio, where=ratio > 0, out=np.full(ratio.shape, -_NONE / FINE)) * FINE, casting="unsafe", out=out)
        return out + _NONE

    def run(batches):
        for batch in batches:
            for blob, slots in _answered(batch):
                _, _, g = _unpacked(blob)
                word, pair, context = (x[g.own] for x in _counted(g, [s[1] for s in slots], [s[2] for s in slots]))
                uniform = 1 / (model.fitted_vocabulary + 1)
                cell = (bucket(context) * (2 * _NONE) + step(pair / np.maximum(context, 1) / uniform)) * (2 * _NONE) + step(word / max(model.fitted_tokens, 1) / uniform)
                cells, n = np.unique(cell, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(n, pa.int64())], names=["cell", "n"])

    return run


def learned(cells: np.ndarray, n: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The weights by expectation-maximisation; start stays for buckets without evidence."""
    out = start.copy()
    where = cells // (4 * _NONE * _NONE)
    value = lambda x: np.where(x == 0, 0.0, np.exp2((x - _NONE) / FINE))
    p = np.stack([value(cells // (2 * _NONE) % (2 * _NONE)), value(cells % (2 * _NONE)), np.ones(cells.size)], 1)
    for b in np.unique(where):
        mine, count = p[where == b], n[where == b, None]
        w = start[b].copy()
        for _ in range(ROUNDS):
            share = mine * w
            share /= share.sum(1, keepdims=True)
            w = (share * count).sum(0) + [0, 1e-3, 1e-3]
            w /= w.sum()
        out[b] = w
    out[0] = [0, *(out[0, 1:] / out[0, 1:].sum())]  # an unseen context has no bigrams
    return out


def _scores(model: Model):
    def run(batches):
        for batch in batches:
            for blob, slots in _answered(batch):
                rows, role, g = _unpacked(blob)
                word, pair, context = _counted(g, [s[1] for s in slots], [s[2] for s in slots])
                w = model.weights[bucket(context)]
                p = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(model.tokens, 1) + w[:, 2] / (model.vocabulary + 1)
                base = np.log10((word + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
                split = np.logical_or(*(rows.column(c).to_numpy(zero_copy_only=False) for c in ("lead", "open")))
                columns = [
                    rows.column("doc_id").combine_chunks(),
                    pa.array(role == HELD),
                    pa.array(g.per_row(np.ones(word.size, np.int64)), pa.int64()),
                    pa.array(g.per_row((word > 0).astype(np.int64)), pa.int64()),
                    pa.array(np.full(len(role), model.tokens), pa.int64()),
                    pa.array(g.per_row(base), pa.float64()),
                    pa.array(g.per_row(np.log10(np.where(g.own, p, 1))), pa.float64()),
                    pa.array(np.where(split, rows.column("row").to_numpy(), -1), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*_SCORED, "row"])

    return run


_SCORED = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs (doc_id, text).

    Null text counts as empty: its one token is the end. Repeated rows count once each. Without training
    documents every word is unknown. A long text is worked on in pieces and its sums are added up.
    """
    return fitted(docs)[1]


def fitted(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of docs and the scores with it."""
    spark = docs.sparkSession
    runtime.bound_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _role(docs["doc_id"]).cast("int").alias("role"), F.col("text").cast("string").cast("binary").alias("text"))
    chunks = runtime.written(rows.mapInArrow(_chunks, "chunk long, deleted boolean, bytes long, split boolean, docs binary"), "chunks")
    seen = chunks.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n"), F.coalesce(F.max("split"), F.lit(False)).alias("split")).first()
    n = seen["n"]
    slots = max(32, min(EVEN_SLOTS, math.ceil(n / SLOT_BYTES)), math.ceil(n / LARGE_SLOT_BYTES))
    asked = chunks.select("chunk", "docs").mapInArrow(_asks(slots), "chunk long, slot int, " + ", ".join(f"{k} binary" for k in _ASKED))
    answers = runtime.written(asked.groupBy("slot").applyInArrow(_answers, _ANSWER), "answers")
    sums = answers.where("chunk = -1").agg(*(F.coalesce(F.sum(F.col("totals")[i]), F.lit(0)).alias(f"t{i}") for i in range(4))).first()
    model = Model(list(sums))

    def answered(part: DataFrame, which: str) -> DataFrame:
        sent = answers.where("chunk >= 0").select("chunk", F.struct("slot", f"word_{which}", f"pair_{which}").alias("a"))
        sent = sent.join(part.select("chunk"), "chunk", "left_semi") if which == "fitted" else sent
        return part.select("chunk", "docs").join(sent.groupBy("chunk").agg(F.collect_list("a").alias("a")), "chunk")

    cells = answered(chunks.where("deleted"), "fitted").mapInArrow(_evidence(model), "cell long, n long")
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS * steps**2 cells, steps being FINE a doubling of the corpus: 3 million of 16 bytes at 10**13 words
    if found:
        model.weights = learned(np.array([r["cell"] for r in found]), np.array([r["n"] for r in found], float), model.weights)
    out = answered(chunks, "all").mapInArrow(_scores(model), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, row long")
    if seen["split"]:
        out = runtime.written(out, "scored")
        added = [F.first(c).alias(c) if c in ("doc_id", "held_out", "train_tokens") else F.sum(c).alias(c) for c in _SCORED]
        out = out.where("row < 0").select(*_SCORED).unionByName(out.where("row >= 0").groupBy("row").agg(*added).select(*_SCORED))
    return model, out.select(*_SCORED)
