import random
import zlib

import numpy as np

from curaloom.llm import quality


def corpus(n=700):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randrange(2, 8)))
    docs, labels = [], []
    for i in range(n):
        good = r.random() < 0.7
        w = [word() for _ in range(r.randrange(5, 80))]
        if not good:
            w = r.choice([[x.upper() + "!!" for x in w], [x + "$$$" for x in w], [w[k // 7] for k in range(len(w))]])
        docs.append((i, " ".join(w), "s"))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy_and_edges(spark):
    docs, labels = corpus()
    docs += [(9000, None, "s"), (9001, "", "s"), (None, "abc", None), (0, docs[0][1], "s")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    known = spark.createDataFrame([*labels, (None, 1, 0), (9000, None, 0), (9001, 7, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality(frame, known).collect()
    assert len(rows) == len(docs)
    truth = {i: y for i, y, _ in labels}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 4 == 2) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert frame.columns == ["doc_id", "text", "score"] and len(frame.schema) == 3
    kept = quality.accepted(frame, known)
    assert kept.columns == frame.columns and kept.count() == sum(r.predicted for r in rows)


def test_without_labels_all_score_a_half(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in quality.quality(frame, none).collect()] == [(1, False, 0.5, 0)]
    assert quality.quality(frame.limit(0), none).count() == 0


def _vector(word: bytes) -> np.ndarray:
    """A word's index vector, from its own hash."""
    h = quality.words.word_spans([word], cased=True)[3]
    place, sign = quality.index_vectors(h)
    out = np.zeros(quality.DIM)
    for p, s in zip(place[0], sign[0], strict=True):
        out[p] += s
    return out


def _slot_of(word: bytes) -> int:
    return int(quality.words.word_spans([word], cased=True)[3][0]) % quality.SLOTS


def _shape_of(word: bytes) -> int:
    """Case, ending and length of a word, looked up one by one."""
    ups, lows = sum(65 <= c <= 90 for c in word), sum(97 <= c <= 122 for c in word)
    case = (3 if not lows else 0) if not ups else 1 if ups == 1 and 65 <= word[0] <= 90 else 2
    ends = (b".", b",", b"!", b"?", b";:", b"0123456789", b"\"')]}", b"*", b"$%&#@", b"|-_/\\<>=+~^`")
    end = 11 if word[-1] >= 0x80 else next((i for i, x in enumerate(ends, start=1) if word[-1] in x), 0)
    size = sum(len(word) >= n for n in (3, 7, 13))
    return (case * 12 + end) * 4 + size


TEXTS = [b"a B cc a a", "Été $$$ x!! x!! x!!  die ETE. 12 a|".encode(), b"", b" \n", b"one", b"very-long-hyphened-word yes? no; (so) A1 Ab"]


def test_contexts_against_a_loop():
    want = np.zeros((quality.SLOTS, quality.DIM))
    for text in TEXTS:
        w = text.split()
        for i in range(len(w)):
            for far in range(1, quality.WINDOW + 1):
                if i + far < len(w):
                    want[_slot_of(w[i])] += np.roll(_vector(w[i + far]), far)
                    want[_slot_of(w[i + far])] += np.roll(_vector(w[i]), -far)
    assert np.array_equal(quality.contexts(TEXTS), want) and want.any()


def test_pooling_against_a_loop():
    vectors = quality.word_vectors(quality.contexts(TEXTS))
    got = quality.pooled(TEXTS, vectors)
    for text, row in zip(TEXTS, got, strict=True):
        w, want = text.split(), np.zeros(6 * quality.DIM)
        if w:
            shapes = [quality.SHAPES - 1 if i and w[i] == w[i - 1] else _shape_of(w[i]) for i in range(len(w))]
            parts = [np.array([_vector(x) for x in w]), np.array([vectors[_slot_of(x)] for x in w]), quality.SHAPE_VECTORS[shapes]]
            want = np.concatenate([f for x in parts for f in (x.mean(0), x.std(0))])
        assert np.allclose(row, want, atol=1e-3)


def test_scores_do_not_depend_on_batches_or_pieces(monkeypatch):
    docs, _ = corpus(300)
    texts = [t.encode() for _, t, _ in docs]
    sums = quality.contexts(texts)
    vectors = quality.word_vectors(sums)
    whole = quality.pooled(texts, vectors)
    monkeypatch.setattr(quality, "_AT_ONCE", 13)  # a long text is looked at in pieces
    assert np.array_equal(sums, sum(quality.contexts([t]) for t in texts))
    assert np.allclose(whole, np.vstack([quality.pooled([t], vectors) for t in texts]), atol=1e-3)
    assert not quality.pooled([b"", b" "], vectors).any()


def test_context_sums_are_of_all_rows(spark):
    docs, _ = corpus(200)
    frame = spark.createDataFrame([(t,) for _, t, _ in docs] + [(None,), ("",)], "text string").repartition(5)
    assert np.array_equal(quality.context_sums(frame), quality.contexts([t.encode() for _, t, _ in docs]))


def test_clashing_columns_tied_labels_and_repeated_ids(spark):
    docs, labels = corpus(120)
    names = ["utf8", "_utf8", "quality", "_quality", "Quality", "score", "y"]
    docs = [(*d[:2], *names) for d in docs]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        frame = spark.createDataFrame([*docs, docs[0], docs[0]], ["doc_id", "text", *names])
        twice = spark.createDataFrame([*labels, *((i, 1 - y, t) for i, y, t in labels[:3])], "doc_id long, quality int, toxic int")
        lower = spark.createDataFrame([(i, 0 if i < 3 else y, t) for i, y, t in labels], "doc_id long, quality int, toxic int")
        kept = quality.accepted(frame, twice)
        assert kept.columns == frame.columns and all([r[n] for n in names] == names for r in kept.collect())
        assert sorted(map(str, kept.collect())) == sorted(map(str, quality.accepted(frame, lower).collect()))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_temperature_calibrates():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 6))
    p = 1 / (1 + np.exp(-2 * x[:, 0]))
    y = (r.random(4000) < p).astype(float)
    net = quality.train(x, y, np.ones(4000))
    z = quality._forward(x, net)[1] / net["temperature"]
    q = 1 / (1 + np.exp(-z))
    for low in (0.1, 0.3, 0.5, 0.7):
        mine = (q >= low) & (q < low + 0.2)
        assert abs(q[mine].mean() - y[mine].mean()) < 0.08
