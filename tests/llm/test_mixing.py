import random
import re
from collections import Counter

from curaloom.llm import mixing


def water(sizes):
    """Targets by repeated sharing of the excess."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / w for s in names}
        over = {s for s in names if s not in capped and target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def corpus():
    r = random.Random(2)
    docs = []
    for i in range(400):
        source = r.choice(["hot"] * 6 + ["b", "é", "Z", "c", None])
        docs.append((i, r.choice([None, "", " \n", "w " * r.randrange(40), "a\tb\x0bc"]), source))
    return [*docs, (7, "x y", "b"), (7, "x y", "b"), (None, "x y z", "b"), (None, None, None), (900, "", "empty")]


def test_mix(spark):
    docs = corpus()
    frame = spark.createDataFrame([(*d, "t") for d in docs], "doc_id long, text string, source string, target string")
    rows = mixing.mix(frame).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _ in docs)
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = water(sizes)
    taken = {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
    for s, n in sizes.items():
        mine = [r for r in rows if r.source_size == n and abs(r.target - want[s]) < 1e-6]
        assert mine
        taken[s] = sum(r.taken for r in mine)
        assert taken[s] == int(want[s] + 1e-9)
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_mixed_emits_what_mix_takes(spark):
    frame = spark.createDataFrame([(*d, 0) for d in corpus()], "doc_id long, text string, source string, n_chars int")
    plan = Counter()
    for r in mixing.mix(frame).collect():
        plan[r.doc_id] += r.taken
    got = Counter()
    for r in mixing.mixed(frame).collect():
        got[r.doc_id] += r.taken
        assert r.taken == len(r.text.split()) and r.n_chars == len(r.text)
    assert got == +plan


def test_empty_tables(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(frame).count() == 0 and mixing.mixed(frame).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0, 0.0, 0)] * 2 and mixing.mixed(blank).count() == 0


def test_repeated_rows_at_the_cut(spark):
    rows = [(1, "w " * 100, "a")] + [(5, "x " * 50, "b")] * 20
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = sum(r.taken for r in mixing.mix(frame).collect() if r.doc_id == 5)
    emitted = [r.taken for r in mixing.mixed(frame).collect() if r.doc_id == 5]
    assert plan == sum(emitted) == 1450 and Counter(emitted) == {50: 29}


def test_one_id_for_all_rows_and_none(spark):
    r = random.Random(8)
    for doc_id in (3, None):
        rows = [(doc_id, " ".join(r.choice("abc") for _ in range(r.randrange(6))), r.choice("st")) for _ in range(300)]
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
        plan, sizes = mixing.mix(frame).collect(), Counter()
        assert len(plan) == 300 and sum(x.taken for x in plan) == sum(x.taken for x in mixing.mixed(frame).collect())
        for _, t, s in rows:
            sizes[s] += len(t.split())
        assert sum(x.taken for x in plan) == sum(int(t + 1e-9) for t in water(sizes).values())


def test_clashing_columns_survive(spark):
    names = ["_cut", "_size", "size", "part", "row", "mine", "mine_part", "last", "rest", "epochs", "cut", "turn", "take", "ordinal", "a.b"]
    frame = spark.createDataFrame([(1, "a b", "s", *names), (2, "c d e", "t", *names)] + [(3, "x y", "t", *names)] * 4, ["doc_id", "text", "source", *names])
    out = mixing.mixed(frame)
    assert out.columns == [*frame.columns, "epoch", "taken"]
    assert all([r[n] for n in names] == names for r in out.collect())
