import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from curaloom.llm import lm_scoring as lm


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def test_codes():
    r = random.Random(1)
    for n in (0, 1, 2, 1000):
        keys = np.array(sorted(r.sample(range(2**56), n)), np.uint64)
        assert (lm._decode_keys(lm._code_keys(keys)) == keys).all()
        counts = np.array([r.choice([0, 1, 254, 255, 256, 10**12]) for _ in range(n)], np.int64)
        assert (lm._decode_counts(lm._code_counts(counts)) == counts).all()


def test_weights_are_the_maximum():
    """On evidence drawn from a known mixture the weights come back."""
    r = np.random.default_rng(3)
    truth, a, b = np.array([0.5, 0.3, 0.2]), np.array([4.0, 0.25, 0]), np.array([1.0, 2.0, 0.5])
    p = np.stack([a, b, np.ones(3)], 1)
    base = np.array([0.2, 0.6, 0.2])  # of the uniform share
    n = r.multinomial(2_000_000, (p @ truth) * base / ((p @ truth) * base).sum()).astype(float)
    step = lambda x: np.where(x > 0, np.rint(np.log2(np.maximum(x, 1e-9)) * lm.FINE) + lm._NONE, 0).astype(np.int64)
    cells = (5 * 2 * lm._NONE + step(a)) * 2 * lm._NONE + step(b)
    w = lm.learned(cells, n, lm.Model([1, 1, 1, 1]).weights)[5]
    like = lambda x: (n * np.log(p @ x)).sum()
    for d in ([1, -1, 0], [0, 1, -1], [1, 0, -1]):
        for s in (0.01, -0.01):
            if (w + s * np.array(d)).min() >= 0:
                assert like(w) >= like(w + s * np.array(d)) - 1e-6 * abs(like(w))


def test_pieces_hold_the_words_once(monkeypatch):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 7)
    r = random.Random(4)
    for _ in range(500):
        text = "".join(r.choice("ab é \t\n") for _ in range(r.randrange(60))).encode()
        pieces = lm._pieces(text)
        found, last = [], b""
        for i, (piece, lead, more) in enumerate(pieces):
            w = piece.split()
            assert more == (i < len(pieces) - 1) and (not lead or w[0] == last)
            found += w[1:] if lead else w
            last = (found or [b""])[-1]
        assert found == text.split()
    assert lm._pieces(b"") == [(b"", False, False)]


@pytest.mark.parametrize(("n", "piece"), [(0, 0), (300, 0), (300, 40)])
def test_scores_against_brute_force(spark, monkeypatch, n, piece):
    if piece:  # every text in many pieces
        monkeypatch.setattr(lm, "CHUNK_BYTES", piece)
    r = random.Random(7)
    vocabulary = ["".join(r.choice("abcdE") for _ in range(r.randrange(1, 4))) for _ in range(60)]
    docs = []
    for i in range(n):
        w = r.choice(vocabulary)
        text = [w]
        for _ in range(r.randrange(60)):
            w = vocabulary[(vocabulary.index(w) * 7 + r.randrange(4)) % 60]
            text.append(w)
        docs.append((i, " ".join(text)))
    docs += [(9001, None), (9002, ""), (9003, "Entirely\tunknown words"), (5, "a b"), (None, "a b")][: 5 if n else 0]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, score string")
    model, out = lm.fitted(frame)
    got = sorted(((x.doc_id is None, x.doc_id or 0, x.n_tokens), x) for x in out.collect())
    crc = lambda d: zlib.crc32(b"" if d is None else str(d).encode())
    train = [tokens(t) for d, t in docs if crc(d) % 5 != 1]
    one = Counter(w for t in train for w in t)
    two = Counter(p for t in train for p in zip(["START", *t], t, strict=False))
    context = Counter(p[0] for t in train for p in zip(["START", *t], t, strict=False))
    total, size = sum(one.values()), len(one)
    assert (model.tokens, model.vocabulary) == (total, size)
    assert np.allclose(model.weights.sum(1), 1)
    want = []
    for d, t in docs:
        base = score = known = 0
        for v, w in zip(["START", *tokens(t)], tokens(t), strict=False):
            base += math.log10((one[w] + 0.5) / (total + 0.5 * (size + 1)))
            x = model.weights[min(context[v].bit_length(), lm.BUCKETS - 1)]
            score += math.log10(x[0] * two[v, w] / max(context[v], 1) + x[1] * one[w] / total + x[2] / (size + 1))
            known += one[w] > 0
        want.append(((d is None, d or 0, len(tokens(t))), known, crc(d) % 5 == 1, base, score))
    assert len(got) == len(want)
    for (key, x), y in zip(got, sorted(want), strict=True):
        assert key == y[0] and (x.n_known, x.held_out, x.train_tokens) == (y[1], y[2], total)
        assert abs(x.base_score - y[3]) < 1e-6 and abs(x.score - y[4]) < 1e-6
    if n:
        held = [x for _, x in got if x.held_out]
        assert sum(x.score for x in held) > sum(x.base_score for x in held)


def test_slots_follow_bytes_and_long_texts_score_alike(spark, monkeypatch):
    """A very long text, more chunks and more slots change nothing."""
    r = random.Random(2)
    docs = [(i, " ".join(r.choice("abcdefgh") for _ in range(30))) for i in range(60)] + [(100, "a b c d e f g h " * 20_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    one = sorted((x.doc_id, round(x.score, 6), round(x.base_score, 6)) for x in lm.scores(frame).collect())
    for name, value in (("SLOT_BYTES", 2000), ("CHUNK_BYTES", 500)):
        monkeypatch.setattr(lm, name, value)
    two = sorted((x.doc_id, round(x.score, 6), round(x.base_score, 6)) for x in lm.scores(frame.repartition(3)).collect())
    assert [x[0] for x in one] == [x[0] for x in two]
    assert all(abs(a[1] - b[1]) <= 1e-5 * max(1, abs(a[1])) and abs(a[2] - b[2]) <= 1e-5 * max(1, abs(a[2])) for a, b in zip(one, two, strict=True))
