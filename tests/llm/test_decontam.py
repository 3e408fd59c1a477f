import random
from collections import Counter

from pyspark.sql import functions as F

from curaloom.llm import decontam


def grams(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def brute(docs, items):
    """Best similarity over all windows of the item's length."""
    out = {}
    for d, text in docs:
        w = (text or "").lower().split()
        for j, t in items:
            v = (t or "").lower().split()
            k = min(5, len(v))
            if not k:
                continue
            best = 0
            for s in range(max(1, len(w) - len(v) + 1)):
                a, b = grams(w[s : s + len(v)], k), grams(v, k)
                if a:
                    best = max(best, sum((a & b).values()) / sum((a | b).values()))
            if best >= 0.75:
                out[d, j] = max(best, out.get((d, j), 0))
    return out


def corpus():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    items = [(j, " ".join(word() for _ in range(r.randrange(5, 70)))) for j in range(25)] + [(90, "one two three"), (91, None), (92, "x y " * 10)]
    docs = []
    for i in range(150):
        w = [word() for _ in range(r.randrange(120))]
        if i % 2:
            v = r.choice(items[:25])[1].split()
            for _ in range(r.choice([0, 0, 0, 1, 2, 4])):
                k = r.randrange(len(v))
                v[k : k + r.choice([0, 1])] = [word()] * r.choice([0, 1])
            if i % 5 == 0 and len(v) > 30:  # the same words in another order: halves swapped, or rolled
                cut = r.choice([len(v) // 2, r.randrange(len(v))])
                v = v[cut:] + v[:cut]
            at = r.randrange(len(w) + 1)
            w[at:at] = [x.upper() for x in v] if i % 3 else v
        docs.append((i, r.choice([" ", "\n", " \t"]).join(w)))
    return docs + [(900, None), (901, ""), (902, "X y " * 12), (903, "one two three")], items


def test_leaks_against_brute_force(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(d, t, "s") for d, t in docs], "doc_id long, text string, item_id string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(frame, spark.createDataFrame([(j, t, 0) for j, t in items], "item_id long, text string, doc_id int")).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and len(want) > 40
    assert all(abs(got[k] - v) < 1e-12 for k, v in want.items())
    clean = {r.doc_id for r in decontam.decontaminated(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert clean == {d for d, _ in docs} - {d for d, _ in want}


def test_simhash_follows_its_definition(spark):
    rows = spark.createDataFrame([(i, [f"w{(i * j) % 7}" for j in range(1 + i)]) for i in range(20)], "i long, w array<string>")
    for r in rows.select("w", decontam.simhash(F.col("w")).alias("fp"), F.transform("w", lambda x: F.xxhash64(x)).alias("h")).collect():
        bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r.h) > len(r.h))
        assert r.fp & (2**64 - 1) == bits


def test_blocks_find_every_fingerprint_in_the_radius(spark):
    r = random.Random(1)
    rows = []
    for i in range(60):
        a, b = r.getrandbits(64) - 2**63, 0
        for k in r.sample(range(64), r.randrange(decontam.RADIUS + 1)):
            b |= 1 << k
        rows.append((i, a, (a & (2**64 - 1) ^ b) - (2**64 if (a & (2**64 - 1) ^ b) >> 63 else 0)))
    frame = spark.createDataFrame(rows, "i long, a long, b long")
    both = frame.select("i", F.size(F.array_intersect(decontam._blocks(F.col("a")), decontam._near_blocks(F.col("b")))).alias("n"))
    assert both.where("n = 0").count() == 0


def test_reordered_words_are_found(spark):
    item = [f"w{i}" for i in range(100)]
    filler = [f"f{i}" for i in range(60)]
    swapped = filler[:30] + item[50:] + item[:50] + filler[30:]
    docs = spark.createDataFrame([(1, " ".join(swapped)), (2, " ".join(item)), (3, " ".join(filler))], "doc_id long, text string")
    got = {r.doc_id: (r.similarity, r.start) for r in decontam.leaks(docs, spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")).collect()}
    assert got == {1: (92 / 100, 30), 2: (1.0, 0)}


def test_short_items_are_whole_sequences(spark):
    docs = [(1, "z One two THREE z"), (2, "one two"), (3, "two three one"), (4, "answer"), (5, None), (6, "one two three four")]
    items = [(10, "one two three"), (11, "answer"), (12, ""), (13, "one two three four"), (14, "q w e r t y u i o p")]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items) == {(1, 10): 1.0, (4, 11): 1.0, (6, 10): 1.0, (6, 13): 1.0}


def test_long_texts_and_frequent_shingles(spark):
    r = random.Random(9)
    item = [r.choice(["x", "y"]) for _ in range(40)]
    long = [r.choice(["x", "y"]) for _ in range(3000)] + item + ["x"] * 500
    docs, items = [(1, " ".join(long)), (2, "x " * 33), (3, " ".join(item * 20))], [(1, " ".join(item)), (2, "x " * 40), (3, "y x " * 9)]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(docs, items)
    assert set(got) == set(want) and all(abs(got[k] - v) < 1e-12 for k, v in want.items()) and len(want) >= 4


def test_simhash_of_more_words_than_sixteen_bits_count(spark):
    n = 70_000
    fp = spark.range(1).select(decontam.simhash(F.concat(F.array_repeat(F.lit("a"), n), F.array(F.lit("b")))).alias("fp"), F.xxhash64(F.lit("a")).alias("a")).first()
    assert fp.fp == fp.a


def test_fingerprints_of_windows_that_pass_lie_in_the_radius(spark):
    """Items of 18 to 60 words with other words at an edge, so that the similarity is just 0.75 and up: the worst case."""
    r = random.Random(11)
    rows = []
    for i in range(1500):
        n = r.randrange(18, 61)
        item = [f"{r.getrandbits(40)}" for _ in range(n)]
        changed = (n - 4) // 7  # shingles of a bag that may differ
        rows.append((i, item, [f"{r.getrandbits(40)}" for _ in range(changed)] + item[changed:]))
    frame = spark.createDataFrame(rows, "i long, a array<string>, b array<string>")
    far = frame.select(F.bit_count(decontam.simhash(F.col("a")).bitwiseXOR(decontam.simhash(F.col("b")))).alias("far"))
    assert far.where(F.col("far") > decontam.RADIUS).count() <= 1


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    out = decontam.leaks(docs, spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string"))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 1


def test_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (1, "a b c d e f g h"), (None, "z a b c d e f g"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, "A b c d e f g"), (7, "A b c d e f g"), (8, None)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id, r.similarity, r.start) for r in decontam.leaks(docs, items).collect()) == [(0, 7, 1.0, 1), (1, 7, 1.0, 0)]
    assert [r.doc_id for r in decontam.decontaminated(docs, items).collect()] == [2]
    assert decontam.leaks(docs.limit(0), items).count() == 0 and decontam.leaks(docs, items.limit(0)).count() == 0
